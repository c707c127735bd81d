"""The tables' CHECK rules, each stated once as a Spark SQL condition (C-04, C-05, P-28).

The schema catalogue reads what a rule says about one field (pattern, values, bounds,
length); a load refuses rows for which the same text is false. A null keeps every rule.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from ledgerline.functions.coerce import GSTIN, HSN
from ledgerline.plans.registers import BY_TABLE, SALES_HEADER, SALES_LINE, VOCABULARIES, Column


@dataclass(frozen=True)
class Check:
    name: str
    columns: tuple[str, ...]
    text: str


#: Rules that a column's domain brings with it; VALUE is the column.
DOMAINS = {
    "gstin": f"VALUE RLIKE '{GSTIN['domain']}'",
    "tax_rate": "VALUE >= 0 AND VALUE <= 100",
}

#: Rules of single tables: (columns, condition).
TABLES = {
    "sales_register": (
        ("place_of_supply", "place_of_supply RLIKE '^[0-9]{2}$'"),
        ("currency", "currency RLIKE '^[A-Z]{3}$'"),
    ),
    "sales_register_line": (
        ("line_number", "line_number > 0"),
        ("hsn_sac", f"hsn_sac RLIKE '{HSN}'"),
        ("igst cgst sgst", "igst = 0 OR (igst > 0 AND cgst = 0 AND sgst = 0)"),
    ),
    "transaction_document": (
        ("counterparty_gstin", f"counterparty_gstin RLIKE '{GSTIN['file']}'"),
        ("total_value total_taxable_value total_tax_value", "total_value = total_taxable_value + total_tax_value"),
    ),
    "transaction_line": (
        ("line_number", "line_number > 0"),
        ("hsn_sac", f"hsn_sac RLIKE '{HSN}'"),
        ("gst_rate", "gst_rate >= 0 AND gst_rate <= 100"),
        ("igst_amount cgst_amount sgst_amount", "igst_amount = 0 OR (igst_amount > 0 AND cgst_amount = 0 AND sgst_amount = 0)"),
    ),
    "bank_statement_inward_forex": (("currency", "char_length(currency) <= 3"),),
    "foreign_currency_payment_register": (("currency", "char_length(currency) <= 3"),),
}


def domain_of(column: Column) -> str | None:
    return "tax_rate" if column.kind == "rate" else "gstin" if column.name.endswith("_gstin") else None


def _declared(table: str) -> tuple[Column, ...]:
    own = {"sales_register": SALES_HEADER, "sales_register_line": SALES_LINE}
    return own[table] if table in own else BY_TABLE[table].columns if table in BY_TABLE else ()


def checks_of(table: str) -> tuple[Check, ...]:
    """A table's rules: of its columns' domains, its closed vocabularies, its own."""
    out = []
    for c in _declared(table):
        if domain := domain_of(c):
            out.append(Check(f"{table}_{c.name}_{domain}", (c.name,), re.sub(r"\bVALUE\b", c.name, DOMAINS[domain])))
    for (t, c), values in VOCABULARIES.items():
        if t == table:
            out.append(Check(f"{table}_{c}_vocabulary", (c,), f"{c} IN ({', '.join(repr(v) for v in values)})"))
    for columns, text in TABLES.get(table, ()):
        names = tuple(columns.split())
        out.append(Check(f"{table}_{names[0]}_check" if len(names) == 1 else f"{table}_{names[0]}_rule", names, text))
    return tuple(out)
