"""Records from document text, one transform for each archetype (X-06 to X-10, U-10, U-11).

Each takes documents with the outcome of ``functions.text`` (doc_id, entity_id,
outcome, missing, failed, facts) and gives the archetype's rows; what can't be a
record goes to ``quarantined``. Period and identity come from the caller.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import coerce, fiscal
from ledgerline.functions import text as tx
from ledgerline.plans.contracts import EXTRACTIONS
from ledgerline.plans.dispatch import AD_BANKS

GTA_SAC = "996791"
ARCHETYPE_KEYS = {
    "entitlement": ("entity_id", "instrument_type", "instrument_number"),
    "proceeding": ("entity_id", "event_type", "reference_number"),
    "master": ("entity_id", "record_type"),
    "statement": ("entity_id", "statement_type", "as_of_date"),
    "narrative": ("entity_id", "contract_type", "doc_id"),
}


def extracted(docs: DataFrame, doc_type: str, pages: str = "pages") -> DataFrame:
    """X-01 for a type's spec; with its table's rows where it has one (a table without rows is a missing fact)."""
    _, spec = EXTRACTIONS[doc_type]
    out = tx.label_outcome(docs, [(f.name, f.kind, f.required, f.label) for f in spec.fields], pages)
    if spec.pattern:
        out = tx.table_rows(out, spec.pattern, list(spec.columns), pages)
        none = (F.size("rows") == 0) & (F.col("outcome") != "NO_TEXT_LAYER")
        out = out.withColumns({"missing": F.when(none, F.array_append("missing", F.lit("rows"))).otherwise(F.col("missing")), "outcome": F.when(none, "PARTIAL").otherwise(F.col("outcome"))})
    return out


def quarantined(docs: DataFrame, narrative: bool = False) -> DataFrame:
    """U-12's input: what can't be a record, with its reasons. A narrative is kept if something merely failed."""
    bad = F.col("outcome") != "EXTRACTED"
    if narrative:
        bad = (F.col("outcome") == "NO_TEXT_LAYER") | (F.size("missing") > 0)
    reasons = F.concat(F.transform("missing", lambda m: F.concat(F.lit("missing: "), m)), F.transform("failed", lambda m: F.concat(F.lit("failed: "), m)))
    return docs.where(bad).select("doc_id", "outcome", F.slice(reasons, 1, 20).alias("reasons"))


def _fact(name: str) -> Column:
    return F.col("facts")[name]


def _range(name: str, at: int) -> Column:
    return F.try_to_date(F.split_part(_fact(name), F.lit("/"), F.lit(at)), "yyyy-MM-dd")


def entitlements(docs: DataFrame, doc_type: str) -> DataFrame:
    authority = EXTRACTIONS[doc_type][1].authority
    start = F.coalesce(_range("validity", 1), F.try_to_date(_fact("valid_from"), "yyyy-MM-dd"))
    end = F.coalesce(_range("validity", 2), F.lit("9999-12-31").cast("date"))
    return docs.where("outcome = 'EXTRACTED'").select("doc_id", "entity_id", F.lit(doc_type).alias("instrument_type"), F.lit(authority).alias("issuing_authority"), _fact("instrument_number").alias("instrument_number"), start.alias("valid_from"), end.alias("valid_to"), F.lit("ACTIVE").alias("status"))


def proceedings(docs: DataFrame, doc_type: str) -> DataFrame:
    authority = EXTRACTIONS[doc_type][1].authority
    return docs.where("outcome = 'EXTRACTED'").select("doc_id", "entity_id", F.lit(doc_type).alias("event_type"), F.lit(authority).alias("authority"), _fact("reference_number").alias("reference_number"), F.try_to_date(_fact("event_date"), "yyyy-MM-dd").alias("event_date"), _fact("amount").try_cast("decimal(14,2)").alias("amount"))


def masters(docs: DataFrame, doc_type: str) -> DataFrame:
    return docs.where("outcome = 'EXTRACTED'").select("doc_id", "entity_id", F.lit(doc_type).alias("record_type"), _fact("reference_number").alias("reference_number"), F.try_to_date(_fact("as_of_date"), "yyyy-MM-dd").alias("as_of_date"))


def statements(docs: DataFrame, doc_type: str, as_of: Column) -> DataFrame:
    return docs.where("outcome = 'EXTRACTED'").select("doc_id", "entity_id", F.lit(doc_type).alias("statement_type"), as_of.alias("as_of_date"), F.col("facts"))


def narratives(docs: DataFrame, doc_type: str) -> DataFrame:
    kept = (F.col("outcome") != "NO_TEXT_LAYER") & (F.size("missing") == 0)
    return docs.where(kept).select("doc_id", "entity_id", F.lit(doc_type).alias("contract_type"), F.col("facts"))


def shareholdings(docs: DataFrame, start: int = fiscal.START) -> DataFrame:
    """X-07: two facts for each holder's row: this fiscal year's share and the last one's."""
    low, high = fiscal.containing(F.try_to_date(_fact("as_of_date"), "yyyy-MM-dd"), start)
    rows = docs.where("outcome = 'EXTRACTED'").select("doc_id", "entity_id", low.alias("low"), high.alias("high"), F.posexplode("rows").alias("at", "r"))
    both = F.explode(
        F.array(
            F.struct(F.col("r")["pct_current_fy"].alias("pct"), F.col("low").alias("valid_from"), F.col("high").alias("valid_to")),
            F.struct(F.col("r")["pct_prior_fy"].alias("pct"), F.add_months("low", -12).alias("valid_from"), F.date_sub("low", 1).alias("valid_to")),
        )
    )
    out = rows.select("doc_id", "entity_id", "at", "r", both.alias("x"))
    return out.select("doc_id", "entity_id", "at", F.trim(F.col("r")["holder_name"]).alias("holder_name"), F.col("r")["shares"].try_cast("decimal(18,0)").alias("shares"), F.col("x.pct").try_cast("decimal(5,2)").alias("pct_holding"), (F.lower(F.col("r")["pledged"]) == "yes").alias("pledged"), "x.valid_from", "x.valid_to").where("pct_holding is not null")


def listed(docs: DataFrame, doc_type: str) -> DataFrame:
    """The rows that a master record's document lists, typed by its spec: doc_id, entity_id, at, the columns; the document's day is valid_from."""
    columns = EXTRACTIONS[doc_type][1].columns
    rows = docs.where("outcome = 'EXTRACTED'").select("doc_id", "entity_id", F.try_to_date(_fact("as_of_date"), "yyyy-MM-dd").alias("valid_from"), F.posexplode("rows").alias("at", "r"))
    return rows.select("doc_id", "entity_id", "at", *[F.col("r")[n].try_cast(coerce.SQL_TYPES[k]).alias(n) for n, k in columns], "valid_from", F.lit(None).cast("date").alias("valid_to"))


def register_rows(docs: DataFrame, doc_type: str) -> tuple[DataFrame, DataFrame]:
    """X-05, X-08: a register's rows in document text as cells (path, line, cells), and what can't be one; a document without rows is refused."""
    if doc_type in EXTRACTIONS:
        found = extracted(docs, doc_type)
        facts = found.where("outcome = 'EXTRACTED'").select("doc_id", F.explode(F.array("facts")).alias("facts"))  # explode: the look-ups are not repeated for each cell
        rows = facts.select("doc_id", F.lit(0).alias("line"), tx.remittance_row(F.col("facts")).alias("_row")).select("doc_id", "line", "_row.*")
    else:
        found = tx.label_outcome(docs, [], "pages")
        text = found.where("outcome <> 'NO_TEXT_LAYER'").select("doc_id", "pages")
        rows = tx.payroll_rows(text, place="line") if doc_type == "PAYROLL_TDS_REGISTER" else tx.realisation_rows(text, list(AD_BANKS), place="line")
        rows = rows.drop("pages")
        none = (F.col("outcome") != "NO_TEXT_LAYER") & F.col("_some").isNull()
        found = found.join(rows.select("doc_id").distinct().withColumn("_some", F.lit(True)), "doc_id", "left")
        found = found.withColumns({"missing": F.when(none, F.array(F.lit("rows"))).otherwise(F.col("missing")), "outcome": F.when(none, "PARTIAL").otherwise(F.col("outcome"))})
    names = [c for c in rows.columns if c not in ("doc_id", "line")]
    pairs = F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("value")) for n in names])
    return rows.select(F.col("doc_id").cast("string").alias("path"), (F.col("line") + 1).alias("line"), F.explode(F.array(F.map_from_entries(pairs))).alias("cells")), quarantined(found)


def transaction_row(docs: DataFrame, doc_type: str) -> DataFrame:
    """X-06: the one-line transaction of a consignment note or a bill of entry; the rate is computed, not read."""
    tax = _fact("gst_amount" if doc_type == "GTA_INVOICE_CONSIGNMENT_NOTE" else "igst_amount").try_cast("decimal(18,2)")
    base = _fact("taxable_value").try_cast("decimal(18,2)")
    hsn = F.lit(GTA_SAC) if doc_type == "GTA_INVOICE_CONSIGNMENT_NOTE" else _fact("hsn_sac")
    cells = {
        "doc_number": _fact("doc_number"), "doc_date": _fact("doc_date"), "counterparty_gstin": _fact("counterparty_gstin"), "counterparty_name": _fact("counterparty_name"),
        "line_number": F.lit("1"), "hsn_sac": hsn, "quantity": F.lit("1"), "unit_price": base.cast("string"), "taxable_value": base.cast("string"), "gst_rate": coerce.gst_rate(tax, base).cast("string"),
        "igst_amount": tax.cast("string"), "cgst_amount": F.lit("0"), "sgst_amount": F.lit("0"),
    }
    if doc_type == "GTA_INVOICE_CONSIGNMENT_NOTE":
        cells |= {"consignment_note_number": _fact("doc_number"), "consignment_note_date": _fact("doc_date"), "rcm_applicable": F.lit("YES")}
    else:
        cells |= {"be_number": _fact("doc_number"), "be_date": _fact("doc_date"), "port_code": _fact("port_code")}
    pairs = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in cells.items()])
    found = docs.where("outcome = 'EXTRACTED'").select("doc_id", F.explode(F.array("facts")).alias("facts"))  # explode: the look-ups are not repeated for each cell
    return found.select(F.col("doc_id").alias("path"), F.lit(2).alias("line"), F.map_from_entries(pairs).alias("cells"))


def single_document_batches(records: DataFrame, document_type: str, day: str) -> DataFrame:
    """X-10: a batch of one document; its period is the document's day."""
    return records.select(F.concat(F.lit(f"{document_type}:"), F.col("doc_id").cast("string")).alias("batch_id"), "entity_id", F.lit(document_type).alias("document_type"), F.col(day).alias("period_start"), F.col(day).alias("period_end"), F.lit(1).cast("long").alias("row_count"))


#: X-08, X-09: archetype -> transform of (documents, document type).
WRITERS: dict[str, Callable[..., DataFrame]] = {"entitlement": entitlements, "proceeding": proceedings, "master": masters, "statement": statements, "narrative": narratives, "transaction": transaction_row}
