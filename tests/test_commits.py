"""The commit log, the live index, and loads that run at the same time."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import load, upsert
from ledgerline.sources import commitlog
from ledgerline.sources.commitlog import BUCKETS, EVERY, CommitLog, Conflict, LiveIndex, Run
from ledgerline.sources.store import TenantStore
from tests.test_load import HEAD, ROW, files, up

KEY = ["entity_id", "gstin", "supplier_gstin", "invoice_no"]


def test_one_writer_gets_a_number_and_snapshots_equal_a_replay(spark, tmp_path):
    log, other = CommitLog(spark, str(tmp_path / "log")), CommitLog(spark, str(tmp_path / "log"))
    assert log.append(1, "a") and not other.append(1, "b") and other.append(2, "b")
    for v in range(3, 2 * EVERY + 6):
        old = [r.path for r in log.state().runs.get("t", ())][:1] if v % 3 == 0 else []
        assert (log, other)[v % 2].append(v, f"b{v}", [Run("t", f"p{v}", 0, (1, v % BUCKETS), "{}")], old)
    state = log.state()
    plain = commitlog.State()
    for entry in log.entries(0):
        plain = plain.then(entry)
    assert state == plain and state.version == 2 * EVERY + 5
    assert log.state(2 * EVERY + 1).version == 2 * EVERY + 1
    assert len(log.files.names(str(tmp_path / "log/snapshots"))) == 3  # two, and which is last
    assert not [n for n in log.files.names(str(tmp_path / "log")) if n.startswith(".") and not n.endswith(".crc")]


def _row(no, day="2024-04-03", value=100):
    return ROW.format(no=no, day=day, value=value)


def test_interleaved_loads_leave_one_live_version(spark, tmp_path):
    """Both loads read the empty store; the second to commit meets the first one's key and is done again on top of it."""
    one, two = (TenantStore(spark, str(tmp_path), "acme") for _ in range(2))
    one.attempt("b1"), two.attempt("b2")
    assert load.load(one, files(spark, f"{HEAD}\n{_row('B1')}\n{_row('B2')}"), up("PURCHASE_REGISTER", 1)).counts["inserted"] == 2
    out = load.load(two, files(spark, f"{HEAD}\n{_row('B1', '2024-04-09', 7)}\n{_row('B3')}"), up("PURCHASE_REGISTER", 2))
    assert (out.counts["inserted"], out.counts["superseded"]) == (1, 1)
    rows = one.rows("purchase_register")
    assert upsert.duplicate_live_keys(rows, KEY).isEmpty()
    assert sorted((r.invoice_no, int(r.taxable_value)) for r in one.live("purchase_register").collect()) == [("B1", 7), ("B2", 100), ("B3", 100)]
    assert rows.where("invoice_no = 'B1' and superseded_at is not null").first().valid_to == dt.date(2024, 4, 9)


def test_a_conflict_is_told_and_other_keys_are_none(spark, tmp_path):
    store = TenantStore(spark, str(tmp_path), "acme")
    rows = lambda k: spark.createDataFrame([(k, "h", f"id{k}", False)], "k string, row_hash string, id string, removed boolean")
    manifest = lambda b: {"batch_id": b, "entity_id": "e", "document_type": "T", "status": "READY", "ready_at": dt.datetime(2024, 5, 1)}
    for b in ("x", "y", "z"):
        store.attempt(b)
    for b, k in (("x", "1"), ("y", "2"), ("z", "1")):
        store.stage_live("t", b, ["k"], rows(k))
    assert store.publish(manifest("x")) and store.publish(manifest("y"))
    with pytest.raises(Conflict):
        store.publish(manifest("z"))
    assert {r.batch_id for r in store.manifests().collect()} == {"x", "y"}
    assert not store.publish(manifest("x"))


def test_the_same_batch_twice_at_once_commits_once(spark, tmp_path):
    one, two = (TenantStore(spark, str(tmp_path), "acme") for _ in range(2))
    one.attempt("b1"), two.attempt("b1")
    text = f"{HEAD}\n{_row('A')}"
    assert load.load(one, files(spark, text), up("PURCHASE_REGISTER", 1)).status == "ACCEPTED"
    assert load.load(two, files(spark, text), up("PURCHASE_REGISTER", 1)).status == "UNCHANGED"
    assert one.rows("purchase_register").count() == 1 and len(one.log.entries(0)) == 1


def test_a_lost_writer_leaves_a_commit_that_recovers(spark, tmp_path):
    """The log entry is the commit: a writer that is lost before it wrote the manifest table has committed."""
    store = TenantStore(spark, str(tmp_path), "acme")
    store.log.append(1, "lost", manifest={"batch_id": "lost", "entity_id": "e", "attempt": "a", "schemas": {}, "period_start": "2024-04-01", "ready_at": "2024-05-01T10:00:00"})
    assert store.manifests().isEmpty()
    assert TenantStore(spark, str(tmp_path), "acme").recover() == 1 and store.recover() == 0
    row = store.manifest("lost").first()
    assert (row.period_start, row.ready_at) == (dt.date(2024, 4, 1), dt.datetime(2024, 5, 1, 10))


def test_live_index_against_a_plain_set(spark, tmp_path):
    """Sixty commits that add, replace and remove keys; runs stay few, and so do the bytes that a small load reads."""
    log = CommitLog(spark, str(tmp_path / "log"))
    index = LiveIndex(spark, log, str(tmp_path / "index"))
    rng, live, n = random.Random(3), {}, 0
    kind = "k string, row_hash string, id string, removed boolean"
    most = []
    for v in range(60):
        rows = []
        for k in rng.sample(range(40), 4):
            if k in live:
                rows.append((f"k{k}", None, live.pop(k), True))
            if rng.random() < 0.8:
                live[k] = f"id{n}"
                rows.append((f"k{k}", f"h{n}", f"id{n}", False))
                n += 1
        state = log.state()
        run = index.write("t", spark.createDataFrame(rows, kind).coalesce(1).withColumn("key_hash", commitlog.key_hash(["k"])))
        assert log.append(state.version + 1, f"b{v}", [run])
        index.compact("t")
        if v % 15 == 14:
            state = log.state()
            got = index.live(state, "t", spark.createDataFrame([(f"k{k}",) for k in range(40)], "k string"), ["k"])
            assert {r.k: r.id for r in got.collect()} == {f"k{k}": i for k, i in live.items()}
            asked = index.live(state, "t", spark.createDataFrame([("k1",)], "k string"), ["k"])
            assert {r.k for r in asked.collect()} >= {f"k{k}" for k in live if k == 1} and asked.count() < len(live)
            most.append(len(asked.inputFiles()))
    levels = [r.level for r in log.state().runs["t"]]
    assert max(levels) >= 1 and all(levels.count(x) < commitlog.FANOUT for x in levels)
    assert max(most) <= commitlog.FANOUT * (max(levels) + 1)
    assert index.vacuum("t") > 0 and index.vacuum("t") == 0
    assert index.current(index.read(log.state().runs["t"])).count() == len(live)


def test_key_hash_tells_nulls_apart(spark):
    rows = spark.createDataFrame([("a", None), (None, "a"), ("a", "")], "x string, y string")
    assert rows.select(commitlog.key_hash(["x", "y"])).distinct().count() == 3
    assert rows.select(commitlog.bucket(F.lit(-5).cast("long"))).first()[0] == BUCKETS - 5


def test_as_of_on_both_axes(spark, tmp_path):
    """A bill of April that May's load ends on the 10th: what was known before May still has its open end."""
    store = TenantStore(spark, str(tmp_path), "acme")
    load.load(store, files(spark, f"{HEAD}\n{_row('A')}"), up("PURCHASE_REGISTER", 1))
    load.load(store, files(spark, f"{HEAD}\n{_row('A', '2024-04-10', 150)}"), up("PURCHASE_REGISTER", 20))
    seen = lambda known, valid=None: [(int(r.taxable_value), str(r.valid_to)) for r in store.as_of("purchase_register", known, valid).collect()]
    assert seen("2024-04-30") == []
    assert seen("2024-05-10") == [(100, "9999-12-31")] == seen("2024-05-10", "2024-04-12")
    assert seen("2024-05-21") == [(150, "9999-12-31")] == seen("2024-05-21", "2024-04-10")
    assert seen("2024-05-21", "2024-04-05") == [(100, "2024-04-10")]  # it still speaks for the days before its successor
    assert seen("2024-05-10", "2024-04-02") == []
    load.load(store, files(spark, f"{HEAD}\n{_row('A', '2024-04-06', 120)}"), up("PURCHASE_REGISTER", 25))  # comes in late: the 150 is corrected as a whole
    assert sorted(seen("2024-05-26", "2024-04-08")) == [(100, "2024-04-10"), (120, "9999-12-31")]
    assert store.as_of("purchase_register", "2024-05-26", "2024-04-08", KEY).first().taxable_value == 120
    assert store.as_of("purchase_register", "2024-05-26", "2024-04-04", KEY).first().taxable_value == 100
