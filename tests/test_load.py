"""Files loaded end to end into a tenant's store."""

import datetime as dt
import json

import pytest

from ledgerline.operators import load, readers, views
from ledgerline.operators.load import Upload
from ledgerline.plans.registers import BY_TABLE, SALES_HEADER, SALES_LINE
from ledgerline.sources.store import TenantStore

HEAD = ",".join(BY_TABLE["purchase_register"].names)
ROW = "27AAAAA0000A1Z5,{no},{day},8471,{value},18,9,9,0,,GL,CC,ELIGIBLE,"


def files(spark, text, name="f.csv"):
    return spark.createDataFrame([(name, bytearray(text.encode()))], "path string, content binary")


def up(kind, n, **more):
    given = dict(document_type=kind, entity_id="e", gstin="29A", ingest_id=f"i{n}", batch_id=f"b{n}", now=dt.datetime(2024, 5, n), period_start=dt.date(2024, 4, 1), period_end=dt.date(2024, 4, 30))
    return Upload(**(given | more))


@pytest.fixture
def store(spark, tmp_path):
    return TenantStore(spark, str(tmp_path), "acme")


def test_register_life(spark, store):
    text = "\n".join([HEAD, ROW.format(no="A", day="2024-04-03", value=100), ROW.format(no="B", day="2024-04-03", value=200), ROW.format(no="B", day="2024-04-03", value=200), ROW.format(no="C", day="x", value=1)])
    first = load.load(store, files(spark, text), up("PURCHASE_REGISTER", 1))
    assert first.status == "PARTIAL" and (first.counts["inserted"], first.counts["collapsed"], first.counts["rejected"]) == (2, 1, 1)
    again = load.load(store, files(spark, text.rsplit("\n", 1)[0]), up("PURCHASE_REGISTER", 2))
    assert again.status == "UNCHANGED" and store.manifests().count() == 1
    third = load.load(store, files(spark, "\n".join([HEAD, ROW.format(no="A", day="2024-04-10", value=150), ROW.format(no="A", day="2024-04-12", value=175)])), up("PURCHASE_REGISTER", 3))
    assert third.counts["superseded"] == 2
    live = {r.invoice_no: r for r in store.live("purchase_register").collect()}
    assert set(live) == {"A", "B"} and live["A"].taxable_value == 175
    history = sorted((r.valid_from, r.valid_to, r.superseded_at is None) for r in store.rows("purchase_register").where("invoice_no = 'A'").collect())
    assert history == [(dt.date(2024, 4, 3), dt.date(2024, 4, 10), False), (dt.date(2024, 4, 10), dt.date(2024, 4, 12), False), (dt.date(2024, 4, 12), dt.date(9999, 12, 31), True)]
    assert views.view(store, "v1_purchase_invoice").count() == 4 and views.view(store, "v1_rejected_row").first().column_name == "invoice_date"
    fatal = load.load(store, files(spark, "a,b\n1,2"), up("PURCHASE_REGISTER", 4))
    assert fatal.status == "QUARANTINED" and load.quarantine(store).first().ingest_id == "i4" and store.manifests().count() == 2
    with pytest.raises(ValueError):
        load.load(store, files(spark, text), up("PURCHASE_REGISTER", 5, gstin=None))
    ledger = spark.createDataFrame([("i1",), ("i4",), ("i9",)], "ingest_id string")
    done = store.manifests().withColumnRenamed("content_hash", "bronze_manifest_ref")
    rejected = views.view(store, "v1_rejected_row")
    out = {r.ingest_id: (r.outcome, r.row_count) for r in readers.artefact_outcomes(ledger, done, rejected, load.quarantine(store)).collect()}
    assert out == {"i1": ("PARTIAL", 3), "i4": ("QUARANTINED", None), "i9": ("PENDING", None)}


def test_content_register_and_fiscal_year(spark, store):
    head = ",".join(BY_TABLE["audited_pl_account"].names)
    year = dict(period_start=dt.date(2024, 4, 1), period_end=dt.date(2025, 3, 31))
    for n, body, inserted in ((1, "1,Sales,,REVENUE,10,CR,\n2,Rent,,EXPENSE,5,DR,", 2), (2, "1,Sales,,REVENUE,11,CR,\n2,Rent,,EXPENSE,5,DR,", 1)):
        assert load.load(store, files(spark, f"{head}\n{body}"), up("AUDITED_PROFIT_AND_LOSS", n, **year)).counts["inserted"] == inserted
    assert {r.fy for r in store.live("audited_pl_account").collect()} == {"2024-25"} and store.live("audited_pl_account").count() == 3


def sales_text(*rows):
    names = [c.name for c in SALES_HEADER + SALES_LINE]
    base = dict(invoice_no="S1", invoice_date="2024-04-03", invoice_type="B2B", line_number="1", taxable_value="90")
    return "\n".join([",".join(names), *(",".join((base | r).get(n, "") for n in names) for r in rows)])


def test_sales_life(spark, store):
    assert load.load(store, files(spark, sales_text({}, {"line_number": "2"})), up("SALES_REGISTER", 1)).status == "ACCEPTED"
    assert load.load(store, files(spark, sales_text({"line_number": "2"}, {})), up("SALES_REGISTER", 2)).status == "UNCHANGED"
    changed = load.load(store, files(spark, sales_text({"taxable_value": "95"}, {"invoice_no": "S2"})), up("SALES_REGISTER", 3))
    assert (changed.counts["superseded"], changed.counts["inserted"]) == (1, 1)
    assert store.live("sales_register").count() == 2
    lines = views.view(store, "v1_sales_register_line")
    assert lines.count() == 4 and lines.where("superseded_at is null").count() == 2
    bad = load.load(store, files(spark, sales_text({}, {"line_number": "2", "irn": "z"})), up("SALES_REGISTER", 4))
    assert bad.status == "QUARANTINED" and bad.reasons == ["line 2: irn: rows disagree"]


def test_transactions_always_supersede(spark, store):
    text = "Doc_Number, DOC_DATE,line_number,hsn_sac,quantity,unit_price,taxable_value,gst_rate,irn,ack_number,ack_date\nD1,03/04/2024,1,8471,1,100,100,18," + "a" * 64 + ",7,2024-04-03"
    for n in (1, 2):
        assert load.load(store, files(spark, text), up("IRN_IRP_REGISTER", n)).status == "ACCEPTED"
    assert store.live("transaction_document").count() == 1 and store.rows("transaction_document").count() == 2
    assert views.view(store, "v1_transaction_line").count() == 2


def test_returns_supersede_whole(spark, store, tmp_path):
    def statement(igst):
        place = tmp_path / f"s{igst}"
        place.mkdir()
        payload = {"gstin": "29A", "ret_period": "042024", "arn": "A", "itc_elg": {"itc_avl": [{"ty": "OTH", "iamt": igst, "camt": 0, "samt": 0, "csamt": 0}]}}
        (place / "r.json").write_text(json.dumps(payload))
        return str(place)

    assert load.load(store, statement(1), up("GSTR_3B", 1)).status == "ACCEPTED"
    assert load.load(store, str(tmp_path / "s1"), up("GSTR_3B", 2)).status == "UNCHANGED"
    assert load.load(store, statement(2), up("GSTR_3B", 3)).counts["superseded"] == 1
    live = views.view(store, "v1_gstr_3b_line").where("superseded_at is null").collect()
    assert [int(r.iamt) for r in live] == [2]
    wrong = load.load(store, str(tmp_path / "s1"), up("GSTR_3B", 4, period_start=dt.date(2024, 5, 1)))
    assert wrong.reasons == ["return period differs"]


def test_text_records(spark, store):
    def doc(number):
        return spark.createDataFrame([("d", "e", [f"UNDERTAKING\nLUT ARN: {number}\nValidity: 01 April 2024 to 31 March 2025"])], "doc_id string, entity_id string, pages array<string>")

    assert load.load(store, doc("N1"), up("LUT", 1)).status == "ACCEPTED"
    assert load.load(store, doc("N1"), up("LUT", 2)).counts["superseded"] == 1
    assert load.load(store, doc("N2"), up("LUT", 3)).counts["inserted"] == 1
    assert store.live("entitlement").count() == 2 and store.rows("entitlement").count() == 3
    none = spark.createDataFrame([("d", "e", ["short"])], "doc_id string, entity_id string, pages array<string>")
    assert load.load(store, none, up("LUT", 4)).status == "QUARANTINED"
    gta = spark.createDataFrame([("d", "e", ["Consignment Note (LR) No.: LR1\nConsignment Note Date: 03 April 2024\nGTA GSTIN: 24AAAAA0000A1Z5\nGTA Name: Fast\nFreight Charges: 40,000\nGST Payable under RCM: 2,000"])], "doc_id string, entity_id string, pages array<string>")
    assert load.load(store, gta, up("GTA_INVOICE_CONSIGNMENT_NOTE", 5)).status == "ACCEPTED"
    assert store.live("transaction_document").first().doc_number == "LR1"


def test_tenants_with_the_same_keys_never_mix(spark, tmp_path):
    text = "\n".join([HEAD, ROW.format(no="A", day="2024-04-03", value=100)])
    other = text.replace("100", "300")
    a, b = (TenantStore(spark, str(tmp_path), t) for t in ("acme", "beta"))
    assert load.load(a, files(spark, text), up("PURCHASE_REGISTER", 1)).counts["inserted"] == 1
    assert load.load(b, files(spark, other), up("PURCHASE_REGISTER", 1)).counts["inserted"] == 1
    assert [int(s.live("purchase_register").first().taxable_value) for s in (a, b)] == [100, 300]
    assert views.counts_agree(a.rows("purchase_register"), b.rows("purchase_register"), "invoice_no").count() == 0
