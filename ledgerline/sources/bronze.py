"""Intake of files as they arrived: gate, dedup, objects, ledger, and checked re-reads (S-11 to S-18).

``receive`` takes arrivals as rows with their bytes. Gates refuse before anything is
written, cheapest first; bytes that the tenant's ledger holds are recognised by their
hash and neither scanned nor stored again; new ones are scanned, written once as an
object, and only then entered in the ledger. Objects are rows of a Parquet table in a
folder of the attempt, written by the executors and never touched again; the ledger is
an indexed table of the store's commit log, keyed by content hash. So of two intakes of
the same bytes at the same time one commits and the other is done again and finds them
held, and what a crashed intake wrote is in no ledger and never read. A later reader
gets bytes only after their place and hash are checked.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import hashing
from ledgerline.sources import intake
from ledgerline.sources.commitlog import Conflict
from ledgerline.sources.store import TenantStore

LEDGER = "artefact_ledger"
COLUMNS = ("ingest_id", "ref", "entity_id", "document_type", "filename", "received_at", "content_hash", "object_key", "size_bytes")
OBJECTS = "content_hash string, content binary, attempt string"
HELD = "content_hash string, ingest_id string, held_by string, object_key string"
TRIES = 5


def ledger(store: TenantStore) -> DataFrame | None:
    """The tenant's ledger: one row for each distinct content; null while it is empty."""
    rows = store.index.read(store.log.state().runs.get(LEDGER, ()))
    return None if rows is None else store.index.current(rows).select(*COLUMNS)


def receive(store: TenantStore, arrivals: DataFrame, registry: DataFrame | None = None, scanner: intake.NullScanner | None = None) -> DataFrame:
    """A receipt for each arrival (ref, entity_id, document_type, filename, received_at, content): ref, refusal, ingest_id, held_by, content_hash, object_key, size_bytes, deduplicated.

    refusal: the gate's, the type's (with a registry: doc_type_code, in_scope) or the scan's
    (INFECTED); then there is no object and no ledger row. Of equal new bytes the first
    (received_at, ref) is stored; held_by is the ref that brought them. Null bytes are an
    empty file. An arrival that is given again is deduplicated.
    """
    for n in range(TRIES):
        try:
            return _receive(store, arrivals, registry, scanner or intake.NullScanner(), f"intake-{uuid.uuid4().hex}")
        except Conflict:
            if n == TRIES - 1:
                raise
    raise AssertionError


def _receive(store: TenantStore, arrivals: DataFrame, registry: DataFrame | None, scanner: intake.NullScanner, batch: str) -> DataFrame:
    bytes_ = F.coalesce("content", F.lit("").cast("binary"))
    rows = arrivals.select("ref", "entity_id", "document_type", "filename", "received_at", F.length(bytes_).cast("long").alias("size_bytes"), F.sha2(bytes_, 256).alias("content_hash"))
    rows = rows.withColumn("refusal", intake.refusal(F.coalesce("filename", F.lit("")), F.col("size_bytes")))
    if registry is not None:
        typed = intake.type_gate(rows.withColumn("doc_type_code", F.col("document_type")), registry)
        rows = typed.withColumn("refusal", F.coalesce("refusal", "type_refusal")).drop("doc_type_code", "type_refusal")
    gated = store.work(batch, "gated", rows)  # hashes and sizes; no bytes
    passed, attempt = gated.where("refusal is null"), store.attempt(batch)
    known = store.live_for(LEDGER, batch, passed, ["content_hash"])
    known = store.spark.createDataFrame([], HELD) if known is None else known.select("content_hash", "ingest_id", F.col("ref").alias("held_by"), "object_key")
    # of equal bytes one row, by sums that combine: a file that is sent a million times is one object
    first = passed.join(known.select("content_hash"), "content_hash", "left_anti").groupBy("content_hash").agg(F.min(F.struct("received_at", "ref", "entity_id", "document_type", "filename", "size_bytes")).alias("x"))
    first = store.work(batch, "first", first.select("content_hash", "x.*"))
    fresh = arrivals.select("ref", bytes_.alias("content")).withColumn("content_hash", F.sha2("content", 256))
    fresh = fresh.join(first.select("ref", "content_hash"), ["ref", "content_hash"]).dropDuplicates(["content_hash"])
    place = f"{store.path}/bronze/objects/{attempt}"
    clean = scanner.verdicts(fresh).where("scan = 'CLEAN'")
    clean.select("content_hash", "content", F.lit(attempt).alias("attempt")).write.mode("errorifexists").parquet(place)
    stored = store.spark.read.schema(OBJECTS).parquet(place).select("content_hash")
    made = first.join(stored, "content_hash").withColumns({"ref": F.col("ref").cast("string"), "ingest_id": hashing.surrogate(f"bronze:{batch}", "content_hash"), "object_key": F.concat(F.lit(f"{place}/"), "content_hash")})
    new = store.work(batch, "new", made.select(*COLUMNS, F.col("ingest_id").alias("id"), F.lit(False).alias("removed")))
    store.stage_live(LEDGER, batch, ["content_hash"], new)
    held = known.unionByName(new.select("content_hash", "ingest_id", F.col("ref").alias("held_by"), "object_key"))
    own = gated.join(held, "content_hash", "left")
    refusal = F.coalesce("refusal", F.when(F.col("ingest_id").isNull(), "INFECTED"))
    taken = lambda c: F.when(refusal.isNull(), c if not isinstance(c, str) else F.col(c))
    brought = (F.col("held_by") == F.col("ref").cast("string")) & F.startswith("object_key", F.lit(f"{place}/"))
    receipts = own.select("ref", refusal.alias("refusal"), *[taken(c).alias(c) for c in ("ingest_id", "held_by", "object_key")], "content_hash", "size_bytes", taken(~brought).alias("deduplicated"))
    path = f"{store.path}/bronze/receipts/{attempt}"
    receipts.write.parquet(path)
    store.commit(batch)
    return store.spark.read.schema(receipts.schema).parquet(path)


def reread(store: TenantStore, rows: DataFrame) -> DataFrame:
    """S-16: ledger rows with their bytes and a verdict: OK, FOREIGN (a place outside the tenant's store), MISSING or CORRUPT; only OK rows have content."""
    root = f"{store.path}/bronze/objects/"
    inside = F.startswith("object_key", F.lit(root)) & ~F.contains("object_key", F.lit(".."))
    asked = rows.withColumns({"_inside": F.coalesce(inside, F.lit(False)), "attempt": F.element_at(F.split("object_key", "/"), -2)})
    if not store.log.files.exists(root):
        held = store.spark.createDataFrame([], OBJECTS)
    else:
        held = store.spark.read.schema(OBJECTS).option("recursiveFileLookup", "true").parquet(root)
    found = asked.join(held.select("attempt", "content_hash", F.col("content").alias("_content")), ["attempt", "content_hash"], "left")
    verdict = F.when(~F.col("_inside"), "FOREIGN").when(F.col("_content").isNull(), "MISSING").when(F.sha2("_content", 256) != F.col("content_hash"), "CORRUPT").otherwise("OK")
    return found.withColumn("verdict", verdict).withColumn("content", F.when(F.col("verdict") == "OK", F.col("_content"))).drop("_inside", "_content", "attempt")


def files(store: TenantStore, rows: DataFrame) -> DataFrame:
    """(path, content) of ledger rows, for a load; fails if any can't be vouched for."""
    checked = reread(store, rows)
    wrong = F.raise_error(F.concat(F.lit("not loaded: "), F.coalesce("object_key", F.lit("")), F.lit(": "), "verdict"))
    return checked.select(F.col("object_key").alias("path"), F.when(F.col("verdict") == "OK", F.col("content")).otherwise(wrong.cast("binary")).alias("content"))
