"""Intake: repeated, concurrent and crashed uploads leave one object and one ledger row; re-reads are checked."""

import datetime as dt
import hashlib

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline.operators import load
from ledgerline.sources import bronze
from ledgerline.sources.store import TenantStore
from tests.test_load import HEAD, ROW, up

ARRIVAL = "ref string, entity_id string, document_type string, filename string, received_at timestamp, content binary"


def arrivals(spark, *rows):
    return spark.createDataFrame([(ref, "e", kind, name, dt.datetime(2024, 5, 1, hour), None if data is None else bytearray(data)) for ref, kind, name, hour, data in rows], ARRIVAL)


class Scanner:
    def __init__(self):
        self.seen = 0

    def verdicts(self, rows):
        self.seen = rows.count()
        return rows.withColumn("scan", F.when(F.contains("content", F.lit(b"EICAR")), "INFECTED").otherwise("CLEAN"))


def test_gates_dedup_and_scan(spark, tmp_path):
    store, scanner = TenantStore(spark, str(tmp_path), "acme"), Scanner()
    registry = spark.createDataFrame([("A", True), ("B", False)], "doc_type_code string, in_scope boolean")
    rows = [("r1", "A", "x.csv", 2, b"one"), ("r2", "A", "y.csv", 1, b"one"), ("r3", "A", "z.csv", 3, b"two"), ("r4", "A", "z.exe", 1, b"three"), ("r5", "A", "n.csv", 1, None), ("r6", "B", "b.csv", 1, b"four"), ("r7", "C", "c.csv", 1, b"five"), ("r8", "A", "v.csv", 1, b"an EICAR sign"), ("r9", "A", None, 1, b"six")]
    got = {r.ref: r for r in bronze.receive(store, arrivals(spark, *rows), registry, scanner).collect()}
    assert {k: r.refusal for k, r in got.items() if r.refusal} == {"r4": "UNSUPPORTED_EXTENSION", "r5": "EMPTY_FILE", "r6": "OUT_OF_SCOPE", "r7": "UNKNOWN_TYPE", "r8": "INFECTED", "r9": "UNSUPPORTED_EXTENSION"}
    assert (got["r1"].held_by, got["r1"].deduplicated, got["r2"].deduplicated) == ("r2", True, False) and got["r1"].ingest_id == got["r2"].ingest_id
    assert scanner.seen == 3 and got["r3"].content_hash == hashlib.sha256(b"two").hexdigest()
    again = {r.ref: r for r in bronze.receive(store, arrivals(spark, *rows[:3], ("r10", "A", "q.csv", 9, b"new")), registry, scanner).collect()}
    assert {k: r.deduplicated for k, r in again.items()} == {"r1": True, "r2": True, "r3": True, "r10": False}
    assert again["r2"].ingest_id == got["r2"].ingest_id and scanner.seen == 1  # held bytes aren't scanned again
    assert sorted(r.ref for r in bronze.ledger(store).collect()) == ["r10", "r2", "r3"]
    assert bronze.receive(store, arrivals(spark, *rows).limit(0)).count() == 0


def test_two_intakes_at_once_and_a_crash(spark, tmp_path, monkeypatch):
    one, two = (TenantStore(spark, str(tmp_path), "acme") for _ in range(2))
    commit = one.commit

    def late(batch):
        """Another intake of the same bytes commits first."""
        monkeypatch.setattr(one, "commit", commit)
        bronze.receive(two, arrivals(spark, ("b", "A", "x.csv", 1, b"same")))
        return commit(batch)

    monkeypatch.setattr(one, "commit", late)
    row = bronze.receive(one, arrivals(spark, ("a", "A", "x.csv", 2, b"same"), ("c", "A", "x.csv", 2, b"other"))).where("ref = 'a'").first()
    assert (row.held_by, row.deduplicated) == ("b", True)

    def crash(batch):
        raise OSError("lost")

    monkeypatch.setattr(one, "commit", crash)
    with pytest.raises(OSError):
        bronze.receive(one, arrivals(spark, ("d", "A", "x.csv", 3, b"third")))
    assert sorted(r.ref for r in bronze.ledger(two).collect()) == ["b", "c"]
    assert [r.deduplicated for r in bronze.receive(two, arrivals(spark, ("d", "A", "x.csv", 3, b"third"))).collect()] == [False]
    checked = bronze.reread(two, bronze.ledger(two)).collect()
    assert {r.ref: (r.verdict, bytes(r.content)) for r in checked} == {"b": ("OK", b"same"), "c": ("OK", b"other"), "d": ("OK", b"third")}


def test_rereads_are_checked_and_feed_a_load(spark, tmp_path):
    store = TenantStore(spark, str(tmp_path), "acme")
    text = f"{HEAD}\n{ROW.format(no='A', day='2024-04-03', value=100)}".encode()
    bronze.receive(store, arrivals(spark, ("u", "PURCHASE_REGISTER", "f.csv", 1, text)))
    rows = bronze.ledger(store)
    assert load.load(store, bronze.files(store, rows), up("PURCHASE_REGISTER", 1)).status == "ACCEPTED"
    foreign = rows.withColumn("object_key", F.lit(f"{tmp_path}/beta/bronze/objects/x/y"))
    outside = rows.withColumn("object_key", F.concat(F.lit(f"{store.path}/bronze/objects/../../beta/"), "content_hash"))
    lost = rows.withColumn("object_key", F.lit(f"{store.path}/bronze/objects/gone/y"))
    for bad, verdict in ((foreign, "FOREIGN"), (outside, "FOREIGN"), (lost, "MISSING")):
        assert [(r.verdict, r.content) for r in bronze.reread(store, bad).collect()] == [(verdict, None)]
    key = rows.first().object_key.rsplit("/", 1)[0]
    attempt = key.rsplit("/", 1)[1]
    spark.createDataFrame([(rows.first().content_hash, bytearray(b"other bytes"), "forged")], bronze.OBJECTS).write.parquet(key.replace(attempt, "forged"))
    forged = rows.withColumn("object_key", F.regexp_replace("object_key", attempt, "forged"))
    assert [r.verdict for r in bronze.reread(store, forged).collect()] == ["CORRUPT"]
    with pytest.raises(PySparkException):
        bronze.files(store, forged).collect()
