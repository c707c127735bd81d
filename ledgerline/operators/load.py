"""Loading a file end to end: scan, coerce, hash, collapse, upsert, stage, publish (S-19, U-02, U-03, U-07 to U-09, U-12, U-13, D-01).

A load computes its versions once, stages from them the new versions, the
closures of live rows and the rejected rows under its attempt, and publishes the
manifest last, so it shows whole or not at all. Loads may run at the same time: one
that another has overtaken on a key is done again. It can be repeated after any
failure; a batch that is already published is UNCHANGED and nothing is written.
A file that can't be read, or that its type refuses whole, leaves a quarantine
row and no batch; so does one with a row that breaks a rule of its table (INVALID).
A load that changes nothing publishes no batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import hashing
from ledgerline.operators import archetypes, documents, upsert
from ledgerline.plans.contracts import CONTRACTS, EXTRACTIONS
from ledgerline.plans.dispatch import PDF_FED, require
from ledgerline.plans.registers import BY_TYPE, SALES_HEADER, SALES_LINE, Register
from ledgerline.session import kept, scratch
from ledgerline.sources import registers, returns
from ledgerline.sources.commitlog import CODEC, Conflict
from ledgerline.sources.store import TenantStore, folder_of

HOLDERS = "shareholding_pattern_holder"
#: Tables of the rows that a master record's document lists.
CHILDREN = {"SHAREHOLDING_PATTERN": HOLDERS, "GSTIN_REGISTER": "gstin_register_entry", "DIRECTOR_LIST_WITH_DIN": "director_list_din", "KMP_LIST": "kmp_list_member"}
#: The order of a batch's rows where several files come in together.
ORDER = ("path", "line")
#: A file of fewer rows than the live set by this factor cuts the live set by its keys before anything is moved.
FEW = 10


QUARANTINE = "ingest_id string, document_type string, reasons array<string>, quarantined_at timestamp"


@dataclass(frozen=True)
class Upload:
    """What the caller knows of a file."""

    document_type: str
    entity_id: str
    gstin: str | None
    ingest_id: str
    batch_id: str
    now: datetime
    period_start: date | None = None
    period_end: date | None = None
    form: str = "CSV"


@dataclass
class Outcome:
    """ACCEPTED, PARTIAL, UNCHANGED or QUARANTINED, and the counters of the load."""

    status: str
    counts: dict[str, int] = field(default_factory=dict)
    reasons: list[str] = field(default_factory=list)


def _envelope(rows: DataFrame, up: Upload, table: str) -> DataFrame:
    key = ["entity_id", "gstin", "row_hash", *[c for c in ORDER if c in rows.columns]]
    return rows.withColumns(
        {
            "id": hashing.surrogate(f"{table}:{up.batch_id}", *key),
            "doc_type_code": F.lit(up.document_type),
            "bronze_ingest_id": F.lit(up.ingest_id),
            "recorded_at": F.lit(up.now),
        }
    )


def _owned(rows: DataFrame, up: Upload) -> DataFrame:
    return rows.withColumns({"entity_id": F.lit(up.entity_id), "gstin": F.lit(up.gstin).cast("string")})


def _quarantined(store: TenantStore, up: Upload, reasons: list[str]) -> Outcome:
    """U-12: the last verdict on an upload wins; at most 20 reasons are kept with it."""
    store.abandon(up.batch_id)
    row = store.spark.createDataFrame([(up.ingest_id, up.document_type, reasons[:20], up.now)], QUARANTINE)
    row.write.mode("overwrite").parquet(f"{store.path}/quarantine/{folder_of(up.ingest_id)}")
    return Outcome("QUARANTINED", reasons=reasons)


def quarantine(store: TenantStore) -> DataFrame | None:
    place = f"{store.path}/quarantine"
    return store.spark.read.schema(QUARANTINE).option("recursiveFileLookup", "true").parquet(place) if store._exists(place) else None


def _finish(store: TenantStore, up: Upload, table: str, key: list[str], versions: DataFrame, wrong: DataFrame | None, *lines: tuple[str, DataFrame, list[str]], count_lines: bool = True, dealt: bool = False) -> Outcome:
    """Computes what an upsert made once, by action; stages what follows from it, and the new versions as they lie; publishes it if it changes anything.

    lines: (table, rows, the columns that lead to their header). Lines carry the id of
    their header's version; those of headers that made no version are left out.
    """
    ended = F.when(~F.col("is_live"), F.lit(up.now)) if "is_live" in versions.columns else F.lit(None)
    made = store.staged(_envelope(versions, up, table).withColumn("superseded_at", ended.cast("timestamp")), up.batch_id)
    held = store.work(up.batch_id, "versions", made, "action")
    bad = store.work(up.batch_id, "rejected", wrong) if wrong is not None else None
    counts = upsert.counters(held, bad).first().asDict()
    n = counts["inserted"] + counts["superseded"]
    if n or counts["rejected"]:
        made = held.where(F.col("action").isin("inserted", "superseded"))
        if counts["rejected"]:
            store.stage("rejected_row", up.batch_id, bad.withColumn("ingest_id", F.lit(up.ingest_id)))
        if "live_id" in versions.columns:
            shut = held.where("action = 'closed'").select(F.col("live_id").alias("id"), F.lit(up.now).alias("superseded_at"), "valid_to")
            store.stage_closures(table, up.batch_id, shut)
        store.stage_live(table, up.batch_id, key, _live_run(held, key), dealt=dealt)
        total = 0
        for name, rows, to_header in lines:
            link = "record_id" if name in CHILDREN.values() else "header_id"
            heads = made.select(F.col("id").alias(link), F.col("superseded_at").alias("_ended"), *[F.col(c).alias(f"_{c}") for c in to_header])
            same = F.lit(True)
            for c in to_header:
                same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
            own = rows.join(heads, same)
            if "superseded_at" in rows.columns:
                own = own.withColumn("superseded_at", F.col("_ended"))
            total += store.stage(name, up.batch_id, own.drop("path", "_ended", *[f"_{c}" for c in to_header])).count()
        store.adopt(table, up.batch_id, "versions", ("action=inserted", "action=superseded"), made.drop("action", "next_from", "prior", "is_live", "live_id", "copies", "path").schema)
        store.publish({"batch_id": up.batch_id, "entity_id": up.entity_id, "document_type": up.document_type, "period_start": up.period_start, "period_end": up.period_end, "row_count": total if lines and count_lines else n, "status": "READY", "ready_at": up.now, "content_hash": up.ingest_id})
    store.abandon(up.batch_id)
    return Outcome("PARTIAL" if counts["rejected"] else "ACCEPTED" if n else "UNCHANGED", counts)


def _live_run(held: DataFrame, key: list[str]) -> DataFrame:
    """What an upsert changes of the live set: its live new versions, and the live rows that it closed."""
    new, closed = F.col("action").isin("inserted", "superseded"), F.lit(False)
    if "live_id" in held.columns:
        new, closed = new & F.col("is_live"), F.col("action") == "closed"
    rows = held.where(new | closed).withColumn("_removed", closed)
    if "live_id" in held.columns:
        rows = rows.withColumn("id", F.when(closed, F.col("live_id")).otherwise(F.col("id")))
    return rows.select(*dict.fromkeys([*key, "row_hash", "valid_from", "valid_to", "id"]), F.col("_removed").alias("removed"))


def _invalid(rows: DataFrame, *tables: str) -> list[str]:
    """P-28, P-30: a row that breaks a rule of its table: the file is refused as INVALID."""
    return [f"{documents.INVALID}: line {r.line}: {r.column_name}: {r.value}" for r in documents.broken_checks(rows, *tables).limit(20).collect()]


def _live(store: TenantStore, up: Upload, table: str, key: list[str], like: DataFrame) -> DataFrame:
    """The live rows that the incoming rows ``like`` may meet, or none with the columns that an upsert needs; ``Conflict`` if the load would come too late."""
    store.look_ahead(table, up.batch_id, like, key)
    rows = store.live_for(table, up.batch_id, like, key)
    want = [*dict.fromkeys([*key, "row_hash", "valid_from", "valid_to", "id"])]
    if rows is not None:
        return rows.select(*want)
    empty = like.limit(0)
    for c, kind in (("valid_to", "date"), ("id", "string")):
        empty = empty.withColumn(c, F.lit(None).cast(kind))
    return empty.select(*want)


def load_register(store: TenantStore, files: DataFrame, up: Upload, register: Register | None = None) -> Outcome:
    register = register or BY_TYPE[up.document_type]
    found = _parsed(store, up, registers.cells(files, list(register.names), up.form))
    if reasons := _fatal(found):
        return _quarantined(store, up, reasons)
    return _register(store, *_collapsed(store, up, found, register), up, register)


def _collapsed(store: TenantStore, up: Upload, cells: DataFrame, register: Register) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, typed and collapsed once for the rules, the look-up of live rows and the upsert; and the rejected ones."""
    good, bad = registers.accepted(cells, register)
    return store.work(up.batch_id, "rows", good), bad


def _parsed(store: TenantStore, up: Upload, rows: DataFrame) -> DataFrame:
    """A load's input, read and parsed once; what follows starts from a short plan."""
    return store.work(up.batch_id, "parsed", rows)


def _fatal(found: DataFrame) -> list[str]:
    return [r.fatal for r in found.where("fatal is not null").limit(20).collect()]


def _register(store: TenantStore, good: DataFrame, bad: DataFrame | None, up: Upload, register: Register) -> Outcome:
    start, end = F.lit(up.period_start), F.lit(up.period_end)
    if reasons := _invalid(good, register.table):
        return _quarantined(store, up, reasons)
    rows = registers.with_period(_owned(good, up), register, start, end).withColumn("valid_to", F.lit(upsert.OPEN_END).cast("date"))
    if register.natural:
        key = list(register.key_columns)
        made = _upserted(store, up, register.table, key, rows)
    else:
        key = ["entity_id", "gstin", register.period, "row_hash"]
        made = upsert.content(rows, _live(store, up, register.table, key, rows), register.period)
    return _finish(store, up, register.table, key, made, bad, dealt=register.natural)


def _upserted(store: TenantStore, up: Upload, table: str, key: list[str], rows: DataFrame) -> DataFrame:
    """A natural upsert of rows that are held; of the live rows only those move that are met, and all lie by the live index's buckets then."""
    live, held = _live(store, up, table, key, rows), store.live_size(table, up.batch_id)
    small = FEW * rows.count() < held
    if held and not small:
        live = store.met(up.batch_id, live, rows, key)
    return upsert.natural(rows.drop("valid_to"), live, key, ORDER, small=small, spread=store.spread(key))


def load_sales(store: TenantStore, files: DataFrame, up: Upload) -> Outcome:
    """U-07: whole documents compare by their hash; the period isn't part of the key."""
    found = registers.cells(files, [c.name for c in SALES_HEADER + SALES_LINE], up.form, flat=True)
    typed = store.work(up.batch_id, "typed", registers.typed(found, SALES_HEADER + SALES_LINE).drop("row_hash", "problem"))
    if reasons := _fatal(typed):
        return _quarantined(store, up, reasons)
    typed = typed.where("fatal is null").drop("fatal")
    wrong = documents.sales_problems(typed, hold=lambda rows: store.work(up.batch_id, "doubtful", rows))
    if reasons := [f"line {r.line}: {r.message}" for r in wrong.orderBy("line", "message").limit(20).collect()]:
        return _quarantined(store, up, reasons)
    if reasons := _invalid(typed, "sales_register", "sales_register_line"):
        return _quarantined(store, up, reasons)
    heads, lines = documents.sales_documents(typed)  # nothing is wrong, so all rows count
    rows = _owned(store.work(up.batch_id, "heads", heads), up).withColumns({"valid_from": F.col("invoice_date"), "tax_period": F.lit(up.period_start)})
    key = ["entity_id", "gstin", "invoice_no"]
    made = _upserted(store, up, "sales_register", key, rows)
    return _finish(store, up, "sales_register", key, made, None, ("sales_register_line", lines, ["path", "invoice_no"]), dealt=True)


def load_transactions(store: TenantStore, files: DataFrame, up: Upload) -> Outcome:
    """U-08: a document always supersedes the live one with its number."""
    found = _parsed(store, up, registers.cells(files, ["doc_number", "doc_date", "line_number"], up.form, lower=True))
    if reasons := _fatal(found):
        return _quarantined(store, up, reasons)
    return _transactions(store, found.where("fatal is null").select("path", "line", "cells"), up)


def _transactions(store: TenantStore, cells: DataFrame, up: Upload) -> Outcome:
    heads, lines, wrong = documents.transactions(cells, CONTRACTS[up.document_type], hold=lambda rows: store.work(up.batch_id, "typed", rows))
    if reasons := [f"line {r.line}: {r.message}" for r in wrong.orderBy("line", "message").limit(20).collect()]:
        return _quarantined(store, up, reasons)
    if reasons := _invalid(lines, "transaction_document", "transaction_line"):
        return _quarantined(store, up, reasons)
    contract = CONTRACTS[up.document_type]
    rows = _gathered(heads, contract.doc).withColumns({"entity_id": F.lit(up.entity_id), "gstin": F.coalesce("counterparty_gstin", F.lit("")), "document_type": F.lit(up.document_type), "direction": F.lit(contract.direction), "valid_from": F.col("doc_date"), "line": F.col("first_line")})
    rows = rows.withColumn("row_hash", hashing.row_hash("doc_number", "doc_date", "total_value", "row_count"))
    key = ["entity_id", "document_type", "gstin", "doc_number"]
    made = upsert.natural(rows, _live(store, up, "transaction_document", key, rows), key, ORDER, compare=False)
    lines = _gathered(lines.drop(*[a.name for a in contract.doc]), contract.line)
    return _finish(store, up, "transaction_document", key, made, None, ("transaction_line", lines, ["path", "doc_number", "counterparty_gstin"]))


def _gathered(rows: DataFrame, declared: tuple) -> DataFrame:
    """A contract's own columns as one map of text, so that the table has one layout for all document types."""
    pairs = [F.struct(F.lit(a.name).alias("key"), F.col(a.name).cast("string").alias("value")) for a in declared]
    filled = F.map_from_entries(F.filter(F.array(*pairs), lambda x: x["value"].isNotNull())) if pairs else F.create_map().cast("map<string,string>")
    return rows.withColumn("attributes", filled).drop(*[a.name for a in declared])


def load_return(store: TenantStore, path: str, up: Upload) -> Outcome:
    """U-09: a whole statement supersedes the one of its party and month; the same again changes nothing."""
    period = F.lit(up.period_start)
    if up.document_type == "GSTR_2B":
        heads, lines, more, refused = returns.gstr_2b(returns.payloads(store.spark, path, returns.GSTR_2B), period)
        second = "gstr_2b_summary"
    else:
        payloads = returns.payloads(store.spark, path, returns.GSTR_3B)
        heads, lines, refused = returns.gstr_3b(payloads, period)
        more, second = returns.inward_supply(payloads, period), "gstr_3b_inward_supply"
    if reasons := [r.reason for r in refused.limit(20).collect()]:
        return _quarantined(store, up, reasons)
    table = up.document_type.lower()
    rows = heads.withColumns({"entity_id": F.lit(up.entity_id), "tax_period": period, "valid_from": period, "line": F.lit(1)})
    key = ["entity_id", "gstin", "tax_period"]
    made = upsert.natural(rows, _live(store, up, table, key, rows), key, ORDER)
    return _finish(store, up, table, key, made, None, (f"{table}_line", lines, ["path"]), (second, more, ["path"]))


def load_text(store: TenantStore, docs: DataFrame, up: Upload) -> Outcome:
    """X-08, U-10: the record of a text document supersedes the live one with its key. docs: doc_id, entity_id, pages."""
    if up.document_type in PDF_FED:
        cells, bad = archetypes.register_rows(docs, up.document_type)
        cells = store.work(up.batch_id, "parsed", cells)
        if reasons := [", ".join(r.reasons) or r.outcome for r in bad.limit(20).collect()]:
            return _quarantined(store, up, reasons)
        return _register(store, *_collapsed(store, up, cells, BY_TYPE[up.document_type]), up, BY_TYPE[up.document_type])
    archetype, _ = EXTRACTIONS[up.document_type]
    found = _parsed(store, up, archetypes.extracted(docs, up.document_type))
    bad = archetypes.quarantined(found, narrative=archetype == "narrative")
    if reasons := [", ".join(r.reasons) or r.outcome for r in bad.limit(20).collect()]:
        return _quarantined(store, up, reasons)
    if archetype == "transaction":
        rows = archetypes.transaction_row(found, up.document_type).withColumn("path", F.lit(up.ingest_id))
        return _transactions(store, store.work(up.batch_id, "cells", rows), up)
    if archetype == "statement":
        rows = archetypes.statements(found, up.document_type, F.lit(up.period_start))
    else:
        rows = archetypes.WRITERS[archetype](found, up.document_type)
    if "facts" in rows.columns:
        rows = rows.withColumn("facts", F.to_json("facts"))
    start = F.col("valid_from") if "valid_from" in rows.columns else F.lit(up.period_start or up.now.date())
    rows = rows.withColumns({"line": F.lit(1), "valid_from": start, "row_hash": hashing.row_hash(*[c for c in rows.columns if c != "doc_id"])}).drop("valid_to") if archetype != "entitlement" else rows.withColumns({"line": F.lit(1), "instrument_valid_to": F.col("valid_to"), "row_hash": hashing.row_hash("instrument_number", "valid_from", "valid_to")}).drop("valid_to")
    key = list(archetypes.ARCHETYPE_KEYS[archetype])
    made = upsert.natural(rows, _live(store, up, archetype, key, rows), key, "line" if "path" not in rows.columns else ORDER, compare=False)
    made = made.withColumn("gstin", F.lit(up.gstin).cast("string")) if "gstin" not in made.columns else made
    children = [(CHILDREN[up.document_type], _children(store, found, made, up), ["doc_id"])] if up.document_type in CHILDREN else []
    return _finish(store, up, archetype, key, made, None, *children, count_lines=False)


def _children(store: TenantStore, found: DataFrame, made: DataFrame, up: Upload) -> DataFrame:
    """X-07, U-11: the rows that a master record lists, with ids of their own; those of closed records are closed with them."""
    table = CHILDREN[up.document_type]
    closed = made.where("action = 'closed'").select(F.col("live_id").alias("record_id"), F.lit(up.now).cast("timestamp").alias("superseded_at"))
    live = store.live(table)
    if live is not None:
        shut = upsert.children_of_closed(live, closed).where("superseded_at is not null")
        store.stage_closures(table, up.batch_id, shut)
    rows = archetypes.shareholdings(found) if table == HOLDERS else archetypes.listed(found, up.document_type)
    same = hashing.surrogate(f"{table}:{up.batch_id}", "doc_id", "at", "valid_from")
    return rows.withColumns({"id": same, "doc_type_code": F.lit(up.document_type), "bronze_ingest_id": F.lit(up.ingest_id), "recorded_at": F.lit(up.now), "superseded_at": F.lit(None).cast("timestamp")})


#: How often a load is done again after a conflict before the caller is told.
TRIES = 5


def load(store: TenantStore, source: DataFrame | str, up: Upload) -> Outcome:
    """D-01: loads an upload by its type's mechanism; again from the new state if another load touched one of its keys meanwhile."""
    way = require(up.document_type, entity_id=up.entity_id, gstin=up.gstin, period_start=up.period_start, period_end=up.period_end)
    run = {"REGISTER_LOADER": load_register, "SALES_REGISTER": load_sales, "TRANSACTION": load_transactions, "GSTN_JSON": load_return, "PDF_EXTRACTION": load_text}[way]
    return again(store, up, lambda: run(store, source, up))


def again(store: TenantStore, up: Upload, run: Callable[[], Outcome]) -> Outcome:
    """Runs a load until it commits or finds its batch published."""
    for n in range(TRIES):
        if store.published(up.batch_id):
            store.abandon(up.batch_id)
            return Outcome("UNCHANGED")
        try:
            return run()
        except Conflict:
            if n == TRIES - 1:
                raise
    raise AssertionError


def load_rows(store: TenantStore, rows: DataFrame, up: Upload) -> Outcome:
    """A register's rows that are typed already (path, line, its columns, row_hash), as ``load`` would take them from a file."""
    register = BY_TYPE[up.document_type]
    place = scratch(store.spark, "rows")
    rows = kept(rows, place, compression=CODEC)  # whatever is done again starts from here
    try:
        return again(store, up, lambda: _register(store, rows, None, up, register))
    finally:
        store.log.files.delete(place)
