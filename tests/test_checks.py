"""Rules of the tables: stated once, published in the catalogue and enforced on load."""

import pytest

from ledgerline.operators import documents, load
from ledgerline.plans import catalogue
from ledgerline.plans.checks import TABLES, checks_of
from ledgerline.plans.registers import REGISTERS, VOCABULARIES
from ledgerline.sources.store import TenantStore
from tests.test_load import HEAD, ROW, files, up

ALL = sorted({*TABLES, *(t for t, _ in VOCABULARIES), *(r.table for r in REGISTERS), "sales_register", "sales_register_line"})


def test_every_rule_is_published_as_facets_or_whole():
    whole = {r[1] for r in catalogue.derived_rules()}
    for table in ALL:
        for check in checks_of(table):
            shape = len(check.columns) == 1 and catalogue.check_shape(check.text, check.columns[0], check.columns[0] == "line_number")
            assert shape or check.name in whole or check.name == "transaction_document_total_value_rule", check
    assert {"sales_register_line_igst_rule", "transaction_line_igst_amount_rule"} <= whole


def test_facets(spark):
    found = {(r.document_type, r.field): r for r in catalogue.fields(spark).collect()}
    rate = found["PURCHASE_REGISTER", "gst_rate"]
    assert (rate.domain, rate.min, rate.max) == ("tax_rate", "0", "100")
    party = found["PURCHASE_REGISTER", "supplier_gstin"]
    assert party.domain == "gstin" and party.pattern.startswith("^[0-9]{2}[A-Z]{5}")
    assert found["SALES_REGISTER", "line_number"].min == "1" and found["BANK_STATEMENT_INWARD_FX", "currency"].max_length == 3
    assert found["CREDIT_DEBIT_NOTE_REGISTER", "note_type"].allowed == ["CN", "DN"]
    assert found["PURCHASE_REGISTER", "gl_code"].pattern is None and catalogue.rules(spark).count() == len(catalogue.derived_rules())
    assert catalogue.merged([{"min": 1, "allowed": ["b", "a"]}, {"min": 0, "max": 9, "allowed": ["a", "c"]}]) == {"min": 1, "max": 9, "allowed": ["a"]}


@pytest.mark.parametrize("table", ALL)
def test_rules_are_conditions_that_spark_takes(spark, table):
    names = sorted({c for check in checks_of(table) for c in check.columns})
    money = lambda n: n.endswith(("_value", "_amount", "_rate", "line_number")) or n in ("igst", "cgst", "sgst")
    rows = spark.createDataFrame([], ", ".join(["line int", *[f"{n} {'decimal(18,2)' if money(n) else 'string'}" for n in names]]))
    assert documents.broken_checks(rows, table).columns == ["line", "constraint_name", "column_name", "value"]
    assert spark.createDataFrame([(1, *[None] * len(names))], rows.schema).transform(documents.broken_checks, table).count() == 0


def test_a_file_that_breaks_a_rule_is_refused_whole(spark, tmp_path):
    store = TenantStore(spark, str(tmp_path), "acme")
    good = ROW.format(no="A", day="2024-04-03", value=100)
    for n, (row, reason) in enumerate(
        [
            (good.replace("27AAAAA0000A1Z5", "27AAAAA"), "INVALID: line 3: supplier_gstin: 27AAAAA"),
            (good.replace(",18,9,9", ",180,9,9"), "INVALID: line 3: gst_rate: 180.000"),
            (good.replace("ELIGIBLE", "PERHAPS"), "INVALID: line 3: itc_eligibility: PERHAPS"),
        ],
        1,
    ):
        done = load.load(store, files(spark, "\n".join([HEAD, good, row])), up("PURCHASE_REGISTER", n))
        assert done.status == "QUARANTINED" and done.reasons == [reason]
    assert store.manifests() is None or store.manifests().count() == 0
    blank = good.replace("27AAAAA0000A1Z5", "").replace(",18,9,9", ",,9,9")
    assert load.load(store, files(spark, "\n".join([HEAD, blank])), up("PURCHASE_REGISTER", 9)).status == "ACCEPTED"
