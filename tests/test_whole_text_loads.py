"""Registers and holders loaded from document text."""

import datetime as dt

import pytest

from ledgerline.operators import load, views
from ledgerline.sources.store import TenantStore
from tests.test_load import up


@pytest.fixture
def store(spark, tmp_path):
    return TenantStore(spark, str(tmp_path), "acme")


def docs(spark, *texts):
    return spark.createDataFrame([(f"d{i}", "e", [t]) for i, t in enumerate(texts)], "doc_id string, entity_id string, pages array<string>")


def test_payroll(spark, store):
    text = "Payroll\nEMP0001 Asha Rao Manager Employee\n192 12,00,000 {}\nCONS0002 B. Das\n(Director) Professional 194J 5,00,000 50,000\nNote: EMP9999 x"
    assert load.load(store, docs(spark, text.format("1,20,000")), up("PAYROLL_TDS_REGISTER", 1)).counts["inserted"] == 2
    again = load.load(store, docs(spark, text.format("1,30,000")), up("PAYROLL_TDS_REGISTER", 2)).counts
    assert (again["superseded"], again["unchanged"]) == (1, 1)
    live = {r.ref_no: (r.person_name, int(r.tds_deducted)) for r in store.live("payroll_tds_register").collect()}
    assert live == {"EMP0001": ("Asha Rao Manager", 130000), "CONS0002": ("B. Das (Director)", 50000)}
    none = load.load(store, docs(spark, "Payroll of a month without any row"), up("PAYROLL_TDS_REGISTER", 3))
    assert none.status == "QUARANTINED" and none.reasons == ["missing: rows"]
    with pytest.raises(ValueError):
        load.load(store, docs(spark, text), up("PAYROLL_TDS_REGISTER", 4, period_start=None))


def test_realisations(spark, store):
    text = "INV/EXP/24-\n25/0001 05-Apr-2024 USD 24,000 HDFC Bank, Fort Branch FIRC/2024/HD/ 77 Realised\nINV/EXP/24-25/0002 06-Apr-2024 EUR10 Other Bank Pend- ing\nBoth bank-issued INV/EXP/24-25/0003"
    out = load.load(store, docs(spark, text), up("FIRC_BRC_REGISTER", 1))
    assert (out.status, out.counts["inserted"], out.counts["rejected"]) == ("PARTIAL", 1, 1)  # an unknown bank is a blank required cell
    row = store.live("firc_brc_register").first()
    assert (row.export_invoice_no, row.valid_from, row.amount_foreign, row.firc_no) == ("INV/EXP/24-25/0001", dt.date(2024, 4, 5), "USD 24,000", "FIRC/2024/HD/77")
    assert views.view(store, "v1_rejected_row").first().column_name == "ad_bank"


def test_remittance(spark, store):
    text = "Form 15CA Acknowledgement No.: 123\nRemittee: Acme GmbH\nRemittance Amount: USD 24,000 ( 19,92,000 equivalent)"
    assert load.load(store, docs(spark, text), up("FORM_15CA_15CB", 1)).status == "ACCEPTED"
    assert load.load(store, docs(spark, text), up("FORM_15CA_15CB", 2)).status == "UNCHANGED"
    row = store.live("form_15ca_15cb").first()
    assert (row.form_15ca_ack_no, int(row.remittance_amount_inr), row.tax_period) == ("123", 1992000, dt.date(2024, 4, 1))
    assert load.load(store, docs(spark, "Remittee: Acme GmbH and others"), up("FORM_15CA_15CB", 3)).status == "QUARANTINED"


def test_holders(spark, store):
    text = "Financial Year: 2024-25 (as on 31 March 2025)\nName Shares % %\nArvind Rao\nDeshmukh 18,50,000\n{}% 36.50% No\nMeera Nair 10 1.5% 2% Yes\nTotal 100%"
    for n, share in ((1, "37.00"), (2, "38.00")):
        assert load.load(store, docs(spark, text.format(share)), up("SHAREHOLDING_PATTERN", n)).status == "ACCEPTED"
    facts = views.view(store, "v1_shareholding_pattern_holder")
    assert facts.count() == 8 and facts.select("id").distinct().count() == 8
    live = facts.where("superseded_at is null")
    record = store.live("master").first()
    assert {r.record_id for r in live.collect()} == {record.id} and live.count() == 4
    assert sorted(float(r.pct_holding) for r in live.where("valid_from = date'2024-04-01'").collect()) == [1.5, 38.0]
    assert {r.superseded_at for r in facts.where("superseded_at is not null").collect()} == {dt.datetime(2024, 5, 2)}
