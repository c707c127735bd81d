"""The published views by name, over a tenant's store (V-07 to V-13, V-18, V-20)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import load, readers
from ledgerline.plans.registers import BY_TABLE
from ledgerline.sources.store import TenantStore

#: View -> (table, header table if it is a view of lines).
SIMPLE = {
    "v1_transaction_document": ("transaction_document", None),
    "v1_transaction_line": ("transaction_line", "transaction_document"),
    "v1_sales_register_line": ("sales_register_line", "sales_register"),
    "v1_gstr_2b": ("gstr_2b", None),
    "v1_gstr_2b_line": ("gstr_2b_line", "gstr_2b"),
    "v1_gstr_2b_summary": ("gstr_2b_summary", "gstr_2b"),
    "v1_gstr_3b": ("gstr_3b", None),
    "v1_gstr_3b_line": ("gstr_3b_line", "gstr_3b"),
    "v1_gstr_3b_inward_supply": ("gstr_3b_inward_supply", "gstr_3b"),
    "v1_rejected_row": ("rejected_row", None),
    "v1_entitlement_instrument": ("entitlement", None),
    "v1_proceeding_event": ("proceeding", None),
    "v1_entity_master_record": ("master", None),
    "v1_shareholding_pattern_holder": ("shareholding_pattern_holder", None),
    "v1_gstin_register_entry": ("gstin_register_entry", None),
    "v1_director_list_din": ("director_list_din", None),
    "v1_kmp_list_member": ("kmp_list_member", None),
    "v1_financial_statement_extract": ("statement", None),
    "v1_narrative_contract": ("narrative", None),
}
#: Full histories; what is approved and in force is the reader's to resolve.
HISTORY_VIEWS = {"v1_reconciliation_tenant_setting": "tenant_setting", "v1_reconciliation_category_bridge": "gl_category_bridge", "v1_ref02_notified_rcm_category": "ref02_notified_rcm_category"}
#: Tables that are appended and never closed.
_PLAIN = ("rejected_row",)


def names() -> list[str]:
    return sorted([*SIMPLE, *HISTORY_VIEWS, "v1_ingest_batch", "v1_purchase_invoice", "v1_sales_register", "v1_quarantined_artefact", *(f"v1_{t}" for t in BY_TABLE)])


def view(store: TenantStore, name: str) -> DataFrame | None:
    """A view's rows; null while its table has none. Lines carry their header's version: id, batch and times."""
    if name == "v1_ingest_batch":
        return store.manifests().drop("attempt", "schemas")
    if name in HISTORY_VIEWS:
        return store.history(HISTORY_VIEWS[name])
    if name == "v1_quarantined_artefact":
        return quarantined_artefacts(store)
    table = name.removeprefix("v1_")
    if name == "v1_purchase_invoice":
        rows = store.rows("purchase_register")
        return None if rows is None else readers.purchase_invoices(rows)
    if name == "v1_sales_register":
        rows = store.rows("sales_register")
        return None if rows is None else readers.sales_register(rows)
    if table in BY_TABLE:
        rows = store.rows(table)
        return None if rows is None else readers.register_view(rows, BY_TABLE[table].names)
    if name not in SIMPLE:
        raise LookupError(f"no view {name}")
    table, header = SIMPLE[name]
    rows = store.raw(table) if header or table in _PLAIN else store.rows(table)
    if rows is None or not header:
        return rows
    return rows.join(store.rows(header).select(F.col("id").alias("header_id"), "recorded_at", "superseded_at"), "header_id")


def quarantined_artefacts(store: TenantStore) -> DataFrame | None:
    """V-12: uploads that were refused whole, with the first reason and all of them."""
    rows = load.quarantine(store)
    return None if rows is None else rows.select("ingest_id", "document_type", F.col("quarantined_at").alias("rejected_at"), F.get("reasons", F.lit(0)).alias("reason"), "reasons")


def counts_agree(before: DataFrame, after: DataFrame, *key: str) -> DataFrame:
    """A-08: keys whose row counts differ between two tables."""
    a, b = (x.groupBy(*key).agg(F.count(F.lit(1)).alias(n)) for x, n in ((before, "n_before"), (after, "n_after")))
    out = a.join(b, list(key), "full_outer")
    return out.where(~F.col("n_before").eqNullSafe(F.col("n_after")))
