"""Declared contracts of header/line documents, and extraction specs (C-01, C-02)."""

from __future__ import annotations

import re
from dataclasses import dataclass
from importlib import resources

KINDS = ("text", "date", "money", "qty", "rate", "int", "gstin", "hsn", "hash64")
TEXT_KINDS = ("text", "date", "date_range", "money", "int", "gstin", "hsn")
DIRECTIONS, COUNTERPARTIES = ("INWARD", "OUTWARD", "INTERNAL"), ("REQUIRED", "OPTIONAL", "FOREIGN")
REQUIRED = ("doc_number", "doc_date", "line_number", "hsn_sac", "quantity", "unit_price", "taxable_value", "gst_rate")
OPTIONAL = ("counterparty_gstin", "counterparty_name", "currency", "description", "uom", "cgst_amount", "sgst_amount", "igst_amount", "cess_amount", "itc_amount")
#: Kinds of the cells that documents of every contract have: of the document, and of its lines.
ENVELOPE_KINDS = {"doc_number": "text", "doc_date": "date", "counterparty_gstin": "gstin", "counterparty_name": "text", "currency": "text"}
LINE_KINDS = {"line_number": "int", "hsn_sac": "hsn", "quantity": "qty", "unit_price": "money", "taxable_value": "money", "gst_rate": "rate", "cgst_amount": "money", "sgst_amount": "money", "igst_amount": "money", "cess_amount": "money", "itc_amount": "money", "description": "text", "uom": "text"}


@dataclass(frozen=True)
class Attribute:
    name: str
    kind: str
    required: bool
    label: str | None = None


@dataclass(frozen=True)
class Contract:
    direction: str
    counterparty: str
    doc: tuple[Attribute, ...]
    line: tuple[Attribute, ...]


@dataclass(frozen=True)
class Extraction:
    authority: str | None
    fields: tuple[Attribute, ...]
    pattern: str | None
    columns: tuple[tuple[str, str], ...]


def _attributes(text: str) -> tuple[Attribute, ...]:
    out = []
    for token in filter(None, (t.strip() for t in text.split(","))):
        m = re.fullmatch(r"([a-z][a-z0-9_]*):(\w+)(!?)", token)
        if not m or m[2] not in KINDS:
            raise ValueError(f"not an attribute: {token!r}")
        out.append(Attribute(m[1], m[2], bool(m[3])))
    return tuple(out)


def contract(text: str) -> Contract:
    """``direction=..;counterparty=..;doc=name:kind!,..;line=..``; anything else is an error."""
    parts: dict[str, str] = {}
    for clause in filter(None, (c.strip() for c in text.split(";"))):
        name, sign, value = clause.partition("=")
        if not sign or name.strip() not in ("direction", "counterparty", "doc", "line"):
            raise ValueError(f"unknown clause: {clause!r}")
        if name.strip() in parts:
            raise ValueError(f"clause given twice: {name!r}")
        parts[name.strip()] = value.strip()
    if parts.get("direction") not in DIRECTIONS or parts.get("counterparty") not in COUNTERPARTIES:
        raise ValueError(f"direction and counterparty are needed: {text!r}")
    out = Contract(parts["direction"], parts["counterparty"], _attributes(parts.get("doc", "")), _attributes(parts.get("line", "")))
    names = [a.name for a in out.doc + out.line]
    if len(set(names)) != len(names) or set(names) & set(REQUIRED + OPTIONAL):
        raise ValueError(f"an attribute is declared twice: {names}")
    return out


def extraction(text: str) -> Extraction:
    """``authority=..;fields=name:kind!:"Label",..;table_pattern="..";table_columns=name:kind,..``."""
    clauses = dict(re.findall(r'(?:^|;)(authority|fields|table_pattern|table_columns)=((?:"(?:[^"\\]|\\.)*"|[^;"])*)', text))
    if "fields" not in clauses:
        raise ValueError("fields is needed")
    fields = []
    rest = clauses["fields"].strip()
    for m in re.finditer(r'([a-z][a-z0-9_]*):(\w+)(!?):"([^"]+)"(?:,|$)', rest):
        if m[2] not in TEXT_KINDS:
            raise ValueError(f"unknown kind: {m[2]!r}")
        fields.append(Attribute(m[1], m[2], bool(m[3]), m[4]))
    if rest and (not fields or re.sub(r'([a-z][a-z0-9_]*):(\w+)(!?):"([^"]+)"(?:,|$)', "", rest)):
        raise ValueError(f"not fields: {rest!r}")
    if ("table_pattern" in clauses) != ("table_columns" in clauses):
        raise ValueError("a table needs both its pattern and its columns")
    pattern = clauses["table_pattern"].strip().strip('"') if "table_pattern" in clauses else None
    cols = tuple((n, k) for n, k in (c.split(":") for c in clauses.get("table_columns", "").split(",") if c))
    if pattern and (lost := {n for n, _ in cols} - set(re.compile(pattern).groupindex)):
        raise ValueError(f"the pattern lacks {sorted(lost)}")
    return Extraction(clauses.get("authority"), tuple(fields), pattern, cols)


def _rows(name: str) -> list[list[str]]:
    """The rows of a data file of this package."""
    lines = resources.files(__package__).joinpath(name).read_text("utf-8").splitlines()
    n = 1 if name.startswith("contracts") else 2
    return [[x.strip() for x in line.split("|", n)] for line in lines if line and not line.startswith("#")]


#: The contracts of the transaction types.
CONTRACTS = {name: contract(text) for name, text in _rows("contracts.txt")}
#: Document type -> (archetype, spec) of the types that are read from text.
EXTRACTIONS = {name: (archetype, extraction(text)) for name, archetype, text in _rows("extractions.txt")}
