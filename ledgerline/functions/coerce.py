"""Coercion of untrusted text cells to types, as Column expressions (P-01 to P-14, P-25).

Each coercion is a pair: the value, null where the cell is blank or bad, and a
predicate that says whether a cell that isn't blank is bad. Shapes are guarded
before ``try_cast``, so what is accepted doesn't hang on a cast's leniency.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
#: What a cell is trimmed of.
BLANKS = " \t\n\x0b\f\r"
WHOLE = r"^[+-]?\d+$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"
HSN, HASH64 = r"^[0-9]{4,8}$", r"^[0-9a-fA-F]{64}$"
#: Three rules for GSTINs are in use; which one holds is a parameter of each caller.
GSTIN = {"domain": r"^[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][0-9A-Z]{3}$", "file": r"^[0-9]{2}[A-Z0-9]{13}$", "text": r"^[0-9]{2}[A-Z]{5}[0-9]{4}[A-Z][1-9A-Z]Z[0-9A-Z]$"}
TRUE, FALSE = ("true", "t", "yes", "y", "1"), ("false", "f", "no", "n", "0")


def cell(c: Column | str) -> Column:
    """P-01: trimmed of white space; empty is null."""
    c = F.col(c) if isinstance(c, str) else c
    trimmed = F.btrim(c, F.lit(BLANKS))
    return F.when(trimmed != "", trimmed)


def number(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """P-03: blank is null."""
    return F.when(c.rlike(NUMBER), c.try_cast(f"decimal({precision},{scale})"))


def number_or_zero(c: Column, precision: int = 18, scale: int = 2) -> Column:
    """P-10: blank is zero; a bad cell is null."""
    return F.when(cell(c).isNull(), F.lit(0).cast(f"decimal({precision},{scale})")).otherwise(number(cell(c), precision, scale))


def whole(c: Column) -> Column:
    """P-04."""
    return F.when(c.rlike(WHOLE), c.try_cast("int"))


def iso_date(c: Column) -> Column:
    """P-05: strictly yyyy-MM-dd."""
    return F.when(c.rlike(ISO_DATE), F.try_to_date(c, "yyyy-MM-dd"))


def any_date(c: Column) -> Column:
    """P-09: yyyy-MM-dd, dd/MM/yyyy or dd-MM-yyyy."""
    slash = F.when(c.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(c, "d/M/yyyy"))
    dash = F.when(c.rlike(r"^\d{1,2}-\d{1,2}-\d{4}$"), F.try_to_date(c, "d-M-yyyy"))
    return F.coalesce(iso_date(c), slash, dash)


def boolean(c: Column) -> Column:
    """P-06: blank is false; other words are null."""
    word = F.lower(c)
    return F.when(c.isNull() | word.isin(*FALSE), False).when(word.isin(*TRUE), True)


def gstin(c: Column) -> Column:
    """P-11: upper case without blanks."""
    number = F.upper(F.regexp_replace(c, r"\s", ""))
    return F.when(number != "", number)


def currency(c: Column) -> Column:
    """P-25."""
    return F.coalesce(cell(c), F.lit("INR"))


#: Register kinds: value of a trimmed cell.
KINDS: dict[str, Callable[[Column], Column]] = {
    "text": lambda c: c,
    "date": iso_date,
    "boolean": boolean,
    "int": whole,
    "money": lambda c: number(c, 18, 2),
    "qty": lambda c: number(c, 18, 3),
    "price": lambda c: number(c, 18, 4),
    "rate": lambda c: number(c, 6, 3),
}

SQL_TYPES = {"text": "string", "date": "date", "boolean": "boolean", "int": "int", "money": "decimal(18,2)", "qty": "decimal(18,3)", "price": "decimal(18,4)", "rate": "decimal(6,3)", "gstin": "string", "hsn": "string", "hash64": "string"}


def bad(kind: str, c: Column) -> Column:
    """A cell that isn't blank and doesn't coerce."""
    return F.lit(False) if kind == "text" else c.isNotNull() & KINDS[kind](c).isNull()


#: P-08: contract kinds: (value, predicate for a bad cell) of a trimmed cell.
def attribute(kind: str, c: Column) -> tuple[Column, Column]:
    if kind == "text":
        return c, F.lit(False)
    value = {
        "date": any_date(c),
        "money": number(c, 18, 2),
        "qty": number(c, 18, 3),
        "rate": F.when(number(c, 6, 3).between(0, 100), number(c, 6, 3)),
        "int": whole(c),
        "gstin": F.when(gstin(c).rlike(GSTIN["file"]), gstin(c)),
        "hsn": F.when(c.rlike(HSN), c),
        "hash64": F.when(c.rlike(HASH64), c),
    }[kind]
    return value, c.isNotNull() & value.isNull()


def tax_heads_clash(igst: Column, cgst: Column, sgst: Column) -> Column:
    """P-14: IGST excludes CGST and SGST."""
    zero = F.lit(0)
    return (F.coalesce(igst, zero) > 0) & ((F.coalesce(cgst, zero) > 0) | (F.coalesce(sgst, zero) > 0))


def gst_rate(amount: Column, base: Column) -> Column:
    """P-24: amount / base in per cent, half up to two places; 0 for a zero base."""
    return F.when(base == 0, F.lit(0).cast("decimal(5,2)")).otherwise(F.round(amount.cast("decimal(20,4)") * 100 / base.cast("decimal(20,4)"), 2).cast("decimal(5,2)"))


def dated_status(c: Column) -> tuple[Column, Column]:
    """P-27: 'Cancelled (31-Jul-2025)' -> the word before the bracket, and the date in it."""
    return F.trim(F.split_part(c, F.lit("("), F.lit(1))), F.try_to_date(F.nullif(F.regexp_extract(c, r"\((\d{2}-[A-Za-z]{3}-\d{4})\)", 1), F.lit("")), "dd-MMM-yyyy")
