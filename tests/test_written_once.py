"""Loads write each new version once, move only live rows that are met, and leave no work behind."""

from pyspark.sql import functions as F

from ledgerline.operators import load, upsert
from ledgerline.sources import commitlog
from ledgerline.sources.store import TenantStore
from tests.test_commits import _row
from tests.test_load import HEAD, files, up


def test_new_versions_are_moved_to_their_place(spark, tmp_path, monkeypatch):
    staged, stage = [], TenantStore.stage
    monkeypatch.setattr(TenantStore, "stage", lambda *a: staged.append(a[1]) or stage(*a))
    store = TenantStore(spark, str(tmp_path), "acme")
    for n, rows in ((1, [_row("B1"), _row("B2"), _row("B3")]), (2, [_row("B1"), _row("B2", "2024-04-09", 7), _row("B4")])):
        load.load(store, files(spark, "\n".join([HEAD, *rows])), up("PURCHASE_REGISTER", n))
    place = f"{store.path}/silver/purchase_register"
    names = store.log.files.names
    assert not staged and not names(f"{store.path}/work")
    assert sorted(tuple(names(f"{place}/{a}")) for a in names(place)) == [("action=inserted",), ("action=inserted", "action=superseded")]
    rows = store.rows("purchase_register")
    assert not {"action", "prior", "copies", "live_id", "is_live", "path", "attempt"} & set(rows.columns)
    assert sorted((r.invoice_no, r.batch_id, r.superseded_at is None) for r in rows.collect()) == [("B1", "b1", True), ("B2", "b1", False), ("B2", "b2", True), ("B3", "b1", True), ("B4", "b2", True)]


def test_only_live_rows_that_are_met_come_in(spark, tmp_path, monkeypatch):
    store = TenantStore(spark, str(tmp_path), "acme")
    make = lambda *ks: spark.createDataFrame([(k,) for k in ks], "k string")
    live, new = make("a", "b", None, "c"), make("b", None, "x")
    assert {r.k for r in store.met("1", live, new, ["k"]).collect()} == {"b", None}
    monkeypatch.setattr(TenantStore, "MET", 1)
    assert store.met("2", live, new, ["k"]).count() == 4  # past the bound: all of them


def test_rows_lie_by_buckets_without_a_shuffle_of_their_own(spark):
    day = F.lit("2024-01-01").cast("date")
    new = spark.range(500).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("line"), F.col("id").cast("string").alias("row_hash"), day.alias("valid_from"))
    old = new.limit(0).select("k", "row_hash", "valid_from", day.alias("valid_to"), F.col("k").alias("id"))
    made = upsert.natural(new, old, ["k"], small=False, spread=commitlog.part(["k"]))
    assert made.columns == upsert.natural(new, old, ["k"]).columns
    at = made.select(commitlog.part(["k"]).alias("p"), F.spark_partition_id().alias("n")).distinct().collect()
    assert len(at) == len({r.p for r in at})  # each part in one place
    assert all(r.p % commitlog.BUCKETS == r.b for r in new.select(commitlog.part(["k"]).alias("p"), commitlog.bucket(commitlog.key_hash(["k"])).alias("b")).collect())


def test_rows_that_were_held_for_another_try_are_gone(spark, tmp_path, monkeypatch):
    kept, own = [], load.kept
    monkeypatch.setattr(load, "kept", lambda rows, place, **o: kept.append(place) or own(rows, place, **o))
    store = TenantStore(spark, str(tmp_path), "acme")
    day = F.lit("2024-04-01").cast("date")
    rows = spark.range(3).select(F.lit("f").alias("path"), F.col("id").alias("line"), F.lit(None).cast("string").alias("supplier_gstin"), F.col("id").cast("string").alias("invoice_no"), day.alias("invoice_date"), F.lit(1).cast("decimal(18,2)").alias("taxable_value"), F.col("id").cast("string").alias("row_hash"))
    assert load.load_rows(store, rows, up("PURCHASE_REGISTER", 1)).counts["inserted"] == 3
    assert len(kept) == 1 and not store._exists(kept[0])
