"""Store, cursor, stream, views and reconciliation on small hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import readers, recon
from ledgerline.sources.store import NoDoorbell, TenantStore
from ledgerline.streaming import cursor

V = {"rule_catalog_version": "r", "corpus_version": "c", "tenant_pack_version": "t"}


def manifest(i, ready="2024-05-01 00:00:00", status="READY"):
    return {"batch_id": f"b{i}", "entity_id": "e", "document_type": "T", "status": status, "ready_at": dt.datetime.fromisoformat(ready), "row_count": 1}


def rows(spark, *ids):
    return spark.createDataFrame([(i, "x") for i in ids], "id string, v string").withColumns({"valid_to": F.lit("9999-12-31").cast("date"), "recorded_at": F.lit("2024-05-01").cast("timestamp"), "superseded_at": F.lit(None).cast("timestamp")})


def test_a_batch_is_seen_with_its_manifest_only(spark, tmp_path):
    store = TenantStore(spark, str(tmp_path), "acme")
    store.stage("t", "b1", rows(spark, "1", "2"))
    assert store.rows("t").count() == 0
    assert store.publish(manifest(1)) and not store.publish(manifest(1))
    assert store.rows("t").count() == 2 and store.manifest("b1").count() == 1
    store.stage("t", "b2", rows(spark, "3"))
    shut = spark.createDataFrame([("1",)], "id string").withColumns({"superseded_at": F.lit("2024-06-01").cast("timestamp"), "valid_to": F.lit("2024-06-01").cast("date")})
    store.stage_closures("t", "b2", shut)
    assert store.live("t").count() == 2
    store.publish(manifest(2))
    assert sorted(r.id for r in store.live("t").collect()) == ["2", "3"]
    assert store.rows("t").where("id = '1'").first().valid_to == dt.date(2024, 6, 1)
    assert sorted(r.id for r in store.as_of("t", "2024-05-15").collect()) == ["1", "2", "3"]
    NoDoorbell().ring(manifest(2))


def test_tenants_stay_apart(spark, tmp_path):
    TenantStore(spark, str(tmp_path), "acme")
    (tmp_path / "acme").rename(tmp_path / "beta")
    with pytest.raises(PermissionError):
        TenantStore(spark, str(tmp_path), "beta")
    with pytest.raises(ValueError):
        TenantStore(spark, str(tmp_path), "")
    assert TenantStore(spark, str(tmp_path), "gamma").rows("t") is None


def test_stream_equals_batch_and_late_batches_come_once(spark, tmp_path):
    store = TenantStore(spark, str(tmp_path / "s"), "acme")
    seen: list[str] = []

    def handle(batches, epoch):
        seen.extend(r.batch_id for r in batches.collect())

    def wake(versions=V, name="q"):
        stream = cursor.arrivals(spark, f"{store.path}/manifest", files_per_trigger=1)
        cursor.poll(stream, str(tmp_path / "ran"), versions, handle, str(tmp_path / name)).awaitTermination()

    store.publish(manifest(1))
    store.publish(manifest(2, status="SUPERSEDED"))
    wake()
    store.publish(manifest(3, ready="2024-04-30 23:30:00"))  # commits late
    wake()
    wake()
    assert seen == ["b1", "b3"]
    ran = spark.read.parquet(str(tmp_path / "ran"))
    assert readers.pending_batches(store.manifests(), ran, V, since="2024-05-01 00:00:00").count() == 0
    seen.clear()
    wake(name="other")  # a second consumer without a checkpoint is offered all, and nothing runs again
    assert seen == []
    wake(V | {"corpus_version": "c2"}, "third")
    assert sorted(seen) == ["b1", "b3"]


def test_duplicates_within_the_watermark(spark, tmp_path):
    store = TenantStore(spark, str(tmp_path / "s"), "acme")
    for i in (1, 2):
        store.publish(manifest(i))
    place = str(tmp_path / "out")
    q = cursor.once(cursor.arrivals(spark, f"{store.path}/manifest")).select("batch_id").writeStream.format("parquet").option("path", place).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.batch_id for r in spark.read.parquet(place).collect()) == ["b1", "b2"]


def test_entitlement_cases(spark):
    day = lambda d: dt.date.fromisoformat(d)
    base = ("i1", "e", "LUT", "N1", day("2024-04-01"), day("2025-03-31"), "ACTIVE", ["8471"], None)
    made = [base, ("i2", "e", "LUT", "N2", day("2024-06-01"), day("2025-03-31"), "ACTIVE", None, None), ("i3", "e", "LUT", "N3", *base[4:6], "SUSPENDED", None, None), ("i4", "e", "LUT", "N4", *base[4:6], "ACTIVE", None, dt.datetime(2024, 5, 1)), ("i5", "f", "LUT", "N5", *base[4:6], "ACTIVE", None, None)]
    instruments = spark.createDataFrame(made, "instrument_id string, entity_id string, instrument_type string, instrument_number string, valid_from date, valid_to date, status string, scope_hsn array<string>, superseded_at timestamp")
    asked = [(1, "84713010", "2024-05-01"), (2, "84713010", "2024-07-01"), (3, "9999", "2024-05-01"), (4, None, "2024-07-01"), (5, "8471", "2025-04-01")]
    supplies = spark.createDataFrame([(i, "e", "LUT", h, day(d)) for i, h, d in asked], "supply_id int, entity_id string, instrument_type string, hsn string, day date")
    got = {(r.supply_id, r["rank"]): r.instrument_id for r in readers.entitlements(supplies, instruments).collect()}
    assert got == {(1, 1): "i1", (2, 1): "i2", (2, 2): "i1", (4, 1): "i2"}
    assert {r.supply_id: r.entitled for r in readers.is_entitled(supplies, instruments).collect()} == {1: True, 2: True, 3: False, 4: True, 5: False}
    plan = readers.entitlements(supplies, instruments)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_upserts_and_as_of_joins_shuffle_once(spark):
    e = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("t"))
    s = e.withColumn("v", F.col("t"))
    plan = readers.as_of(e, s, ["k"], "t", "t", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_director_references_always_hold_three(spark):
    d = spark.createDataFrame([("f", "e", "1", "n", "u1"), ("g", "h", "2", "m", "u2")], "fact_id string, entity_id string, din string, name string, bronze_ingest_id string")
    c = spark.createDataFrame([("e", "BOARD_RESOLUTION_DIRECTOR_APPOINTMENT", "c1", "u3", 1, None), ("e", "BOARD_RESOLUTION_DIRECTOR_APPOINTMENT", "c2", "u4", 2, None), ("e", "BOARD_RESOLUTION_DIRECTOR_APPOINTMENT", "c3", "u5", 3, 9)], "entity_id string, contract_type string, contract_id string, bronze_ingest_id string, recorded_at int, superseded_at int")
    got = {r.fact_id: (r.board_resolution_reference, r.evidence_status, r.source_record_references) for r in readers.director_evidence(d, c).collect()}
    assert got == {"f": ("c2", "BOARD_RESOLUTION_ON_FILE", ["u1", "u4", None]), "g": (None, "CLIENT_LIST_ONLY", ["u2", None, None])}


def frame(spark, text):
    lines = [line.split(",") for line in text.strip().split("\n")]
    return spark.createDataFrame([tuple(x.strip() or None for x in r) for r in lines[1:]], ", ".join(f"{c.strip()} string" for c in lines[0]))


def test_checks_on_portal_rows(spark):
    day = lambda d: F.lit(d).cast("date")
    f = lambda t: frame(spark, t)
    amended = f("recipient_gstin,supplier_gstin,original_invoice_no,itc_delta\nr,s,1,-10\nr,s,2,0\nr,s,3,5")
    assert [r.original_invoice_no for r in recon.amended_after_credit(amended, f("recipient_gstin,supplier_gstin,original_invoice_no\nr,s,1\nr,s,2")).collect()] == ["1"]
    bills = f("shipping_bill_no,shipping_bill_date,fob_value_inr,gstr1_table6a_value\n1,2024-04-01,100,100\n2,2023-01-01,100,90\n,2024-04-01,5,5")
    assert {r.shipping_bill_no for r in recon.unfiled_manifest(bills, f("shipping_bill_no,egm_status\n1,Filed\n2,Pending")).collect()} == {"2", None}
    assert [r.shipping_bill_no for r in recon.value_variance(bills).collect()] == ["2"]
    assert [r.shipping_bill_no for r in recon.unrealised(bills, f("shipping_bill_no,realisation_status\n1,Realised"), day("2024-06-01")).collect()] == ["2"]
    assert recon.export_without_bill(bills).count() == 1
    assert [r.arn for r in recon.slow_refunds(f("arn,status,days_pending\n1,Pending,61\n2,Sanctioned,90\n3,Pending,60")).collect()] == ["1"]
    lic = recon.expired_obligation(f("licence_no,export_obligation_inr,eo_fulfilled_inr,eo_due_date\n1,100,40,2024-01-01\n2,100,100,2024-01-01\n3,100,0,2030-01-01"), day("2024-06-01")).collect()
    assert [(r.licence_no, str(r.shortfall)) for r in lic] == [("1", "60.00")]
    assert [r.be_no for r in recon.import_tax_missing(f("be_no,igst_paid\n1,5\n2,5\n3,0"), f("section,doc_number\nIMPG,1\nB2B,2")).collect()] == ["2"]
    codes = spark.createDataFrame([("I", [("1", "g"), ("2", " ")])], "iec string, branches array<struct<branch_sl_no:string,gstin:string>>")
    assert [r.branch_sl_no for r in recon.branch_without_gstin(codes).collect()] == ["2"]
    isd = spark.createDataFrame([("g", dt.date(2024, 1, 1)), ("g", dt.date(2024, 3, 1))], "gstin string, credit_date date")
    assert recon.credit_before_registration(isd, f("gstin,effective_date_of_registration\ng,2024-02-01")).count() == 1
    tcs = recon.collected_base_differs(f("gstin,operator,tax_period,net_value\ng,o,p,100\ng,o,q,5"), f("gstin,operator,tax_period,taxable_value\ng,o,p,100\ng,o,r,7"))
    assert {r.tax_period for r in tcs.collect()} == {"q", "r"}
    open_ = recon.open_demands(f("notice_no\n1\n2\n3"), f("demand_reference\n1"), f("notice_no\n2"))
    assert [r.notice_no for r in open_.collect()] == ["3"]


def test_every_query_has_an_oracle_or_a_reason():
    import __spark_entry__ as entry

    names, sql = set(entry.queries()), set(entry.oracle_sql())
    assert sql <= names
    assert {n for n in names - sql if not n.startswith(("op", "pipeline"))} == set()
