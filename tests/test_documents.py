"""Header/line documents, portal returns, text documents, contracts and the catalogue."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import text
from ledgerline.operators import archetypes, documents
from ledgerline.plans import catalogue, dispatch
from ledgerline.plans.contracts import CONTRACTS, contract, extraction
from ledgerline.plans.registers import SALES_HEADER, SALES_LINE
from ledgerline.sources import registers, returns

LINE = dict(doc_number="D1", doc_date="03/04/2024", line_number="1", hsn_sac="8471", quantity="2", unit_price="50", taxable_value="100", gst_rate="18", counterparty_gstin="27AAAAA0000A1Z5", cgst_amount="9", sgst_amount="9", igst_amount="", cess_amount="", itc_amount="")


def cells(spark, rows, file="f"):
    return spark.createDataFrame([(r.get("_file", file), i + 2, {k: v for k, v in r.items() if k != "_file"}) for i, r in enumerate(rows)], "path string, line int, cells map<string,string>")


def messages(spark, row, contract_name="PURCHASE_REGISTER"):
    return sorted(r.message for r in documents.transactions(cells(spark, [row]), CONTRACTS[contract_name])[2].collect())


def test_contract_rules(spark):
    assert messages(spark, LINE) == []
    assert messages(spark, LINE | {"counterparty_gstin": " "}) == ["counterparty_gstin: required"]
    assert messages(spark, LINE | {"counterparty_gstin": "x"}) == ["counterparty_gstin: wrong shape"]
    assert messages(spark, LINE | {"igst_amount": "5"}) == ["igst excludes cgst and sgst"]
    assert messages(spark, LINE | {"gst_rate": "101", "hsn_sac": "12"}) == ["gst_rate: not a rate: 101", "hsn_sac: not a hsn: 12"]
    assert messages(spark, LINE | {"doc_date": "2024/04/03"}) == ["doc_date: not a date: 2024/04/03"]
    boe = LINE | {"be_number": "1", "be_date": "2024-04-03", "port_code": "P"}
    assert messages(spark, boe, "BILL_OF_ENTRY") == ["counterparty_gstin: a foreign party has none", "counterparty_name: required"]
    assert messages(spark, boe | {"counterparty_gstin": "", "counterparty_name": "Acme", "port_code": ""}, "BILL_OF_ENTRY") == ["port_code: required"]


def test_documents_are_refused_whole_files(spark):
    rows = [LINE, LINE | {"line_number": "2", "taxable_value": "50.25"}, LINE | {"_file": "g"}, LINE | {"_file": "g", "doc_number": "D2"}, LINE | {"_file": "g", "doc_number": "D2"}]
    heads, lines, wrong = documents.transactions(cells(spark, rows), CONTRACTS["PURCHASE_REGISTER"])
    head = heads.collect()
    assert [(h.path, h.doc_number, h.total_taxable_value, h.total_tax_value, h.row_count, h.currency, h.doc_date) for h in head] == [("f", "D1", Decimal("150.25"), Decimal("36.00"), 2, "INR", dt.date(2024, 4, 3))]
    assert lines.count() == 2 and {(r.path, r.message) for r in wrong.collect()} == {("g", "line_number: given twice: 1")}


def sales_rows(spark, *changes):
    base = {c.name: "" for c in SALES_HEADER + SALES_LINE} | dict(invoice_no="S1", invoice_date="2024-04-03", invoice_type="B2B", invoice_taxable_value="100000", line_number="1", taxable_value="90000")
    return registers.typed(cells(spark, [base | c for c in changes]).withColumn("problem", F.lit(None).cast("string")), SALES_HEADER + SALES_LINE)


def test_sales_documents(spark):
    heads, lines, wrong = documents.sales(sales_rows(spark, {}, {"line_number": "2"}))
    head = heads.first()
    assert head.row_count == 2 and head.invoice_cgst is None and wrong.count() == 0 and head.currency == "INR"
    other = documents.sales(sales_rows(spark, {"line_number": "2"}, {}))[0].first()
    assert head.row_hash == other.row_hash
    assert documents.sales(sales_rows(spark, {}, {"line_number": "2", "taxable_value": "1"}))[0].first().row_hash != head.row_hash
    assert [r.message for r in documents.sales(sales_rows(spark, {}, {"line_number": "2", "irn": "z"}))[2].collect()] == ["irn: rows disagree"]
    assert [r.message for r in documents.sales(sales_rows(spark, {}, {}))[2].collect()] == ["line_number: given twice"]
    assert documents.header_disagrees(heads.select("invoice_no", "invoice_taxable_value"), lines, "invoice_no", "invoice_taxable_value", "taxable_value").count() == 1
    odd = documents.outside_vocabulary(sales_rows(spark, {"invoice_type": "B2X"}), "sales_register").collect()
    assert [(r.column_name, r.value) for r in odd] == [("invoice_type", "B2X")]


TWO_B = {"data": {"gstin": "29A", "rtnprd": "042024", "gendt": "14-05-2024", "docdata": {"b2b": [{"ctin": "27B", "trdnm": "T", "inv": [{"inum": "I1", "idt": "03-04-2024", "val": 118, "itcavl": "Y", "items": [{"num": 1, "rt": 18, "txval": 100.0, "igst": 0, "cgst": 9, "sgst": 9.0, "cess": 0}, {"num": 2, "rt": 5, "txval": 10, "igst": 0, "cgst": 1, "sgst": 1, "cess": 0}]}]}], "cdnr": [], "impg": [{"boenum": "B1", "boedt": "05-04-2024", "portcode": "P", "txval": 500, "igst": 90, "cess": 0}], "isd": [{"ctin": "29C", "docnum": "N1", "docdt": "06-04-2024", "igst": 7, "cgst": 0, "sgst": 0, "cess": 0}]}, "itcsumm": {"itcavl": {"b2b": {"igst": 0, "cgst": 10, "sgst": 10, "cess": 0}, "impg": {"igst": 90, "cgst": 0, "sgst": 0, "cess": 0}}, "itcnotavl": {"x": {"igst": 1}}}}}


def write_json(path, *payloads):
    for i, p in enumerate(payloads):
        (path / f"p{i}.json").write_text(p if isinstance(p, str) else json.dumps(p))
    return str(path)


def test_gstr_2b(spark, tmp_path):
    other = json.loads(json.dumps(TWO_B))
    other["data"]["docdata"]["cdnr"] = [{"a": "b"}]
    wrong = json.loads(json.dumps(TWO_B))
    wrong["data"]["rtnprd"] = "052024"
    rows = returns.payloads(spark, write_json(tmp_path, TWO_B, other, wrong, "nope"), returns.GSTR_2B)
    heads, lines, summary, refused = returns.gstr_2b(rows, F.lit("2024-04-01").cast("date"))
    assert heads.count() == 1 and heads.first().generated_on == dt.date(2024, 5, 14)
    assert sorted((r.section, r.doc_number, r.line_number, r.igst) for r in lines.collect()) == [("B2B", "I1", 1, Decimal("0.00")), ("B2B", "I1", 2, Decimal("0.00")), ("IMPG", "B1", 1, Decimal("90.00")), ("ISD", "N1", 1, Decimal("7.00"))]
    assert {(r.availability, r.category) for r in summary.collect()} == {("AVAILABLE", "b2b"), ("AVAILABLE", "impg"), ("NOT_AVAILABLE", "x")}
    assert sorted(r.reason for r in refused.collect()) == ["not a GSTR-2B payload", "return period differs", "unverified section: cdnr"]
    assert documents.summary_disagrees(summary, lines).count() == 1  # the distributed credit isn't in the summary


THREE_B = {"gstin": "29A", "ret_period": "042024", "arn": "A", "filing_date": "20-05-2024", "filing_status": "Filed", "sup_details": {"osup_det": {"txval": 1000, "iamt": 0, "camt": 90, "samt": 90, "csamt": 0}}, "inter_sup": {"unreg_details": [], "comp_details": [], "uin_details": []}, "itc_elg": {"itc_avl": [{"ty": "IMPG", "iamt": 90, "camt": 0, "samt": 0, "csamt": 0}, {"ty": "OTH", "iamt": 0, "camt": 10, "samt": 10, "csamt": 0}], "itc_rev": [{"ty": "RUL", "iamt": 1, "camt": 0, "samt": 0, "csamt": 0}], "itc_inelg": []}, "inward_sup": {"isup_details": [{"ty": "GST", "inter": 0, "intra": 0}]}}


def test_gstr_3b(spark, tmp_path):
    stray, inter = (json.loads(json.dumps(THREE_B)) for _ in range(2))
    stray["itc_elg"]["itc_rev"][0]["ty"] = "ZZZ"
    inter["inter_sup"]["comp_details"] = [{"pos": "27"}]
    heads, details, refused = returns.gstr_3b(returns.payloads(spark, write_json(tmp_path, THREE_B, stray, inter), returns.GSTR_3B), F.lit("2024-04-01").cast("date"))
    assert heads.first().outward_taxable_value == Decimal("1000.00") and heads.count() == 1
    assert sorted((r.box, r.ty) for r in details.collect()) == [("4A", "IMPG"), ("4A", "OTH"), ("4B", "RUL")]
    assert sorted(r.reason for r in refused.collect()) == ["unknown ty", "unverified section: inter_sup"]


def pages(spark, *docs):
    return spark.createDataFrame([(i, "e", list(p)) for i, p in enumerate(docs)], "doc_id int, entity_id string, pages array<string>")


def test_entitlement_text(spark):
    good = ["LETTER OF UNDERTAKING\nlut arn : AD2904240000001\nValidity: 01 April 2024 to 31 March 2025 (one year)"]
    part = ["LETTER OF UNDERTAKING\nLUT ARN: AD29\nValidity: until further notice"]
    out = archetypes.extracted(pages(spark, good, part, ["  "]), "LUT")
    assert [(r.outcome, r.missing, r.failed) for r in out.orderBy("doc_id").collect()] == [("EXTRACTED", [], []), ("PARTIAL", [], ["validity"]), ("NO_TEXT_LAYER", [], [])]
    row = archetypes.WRITERS["entitlement"](out, "LUT").first()
    assert (row.instrument_number, row.valid_from, row.valid_to, row.issuing_authority) == ("AD2904240000001", dt.date(2024, 4, 1), dt.date(2025, 3, 31), "GSTN")
    assert {r.doc_id: r.reasons for r in archetypes.quarantined(out).collect()} == {1: ["failed: validity"], 2: []}
    assert {r.doc_id for r in archetypes.quarantined(out, narrative=True).collect()} == {2}


def test_money_and_dates_without_colons(spark):
    page = "Particulars Amount\nAssessable (Customs) Value 1,24,50,000\nIGST @ 18% (on value + BCD) 22,41,000.50\nStatus (as on 31-\nMar-2025) x"
    out = text.label_outcome(pages(spark, [page]), [("v", "money", True, "Assessable (Customs) Value"), ("i", "money", True, "IGST"), ("d", "date", True, "Status")]).first()
    assert out.facts == {"v": "12450000", "i": "2241000.50", "d": "2025-03-31"}


def test_shareholdings(spark):
    page = "Financial Year: 2024-25 (as on 31 March 2025)\nName Shares % %\nArvind Rao\nDeshmukh 18,50,000\n37.00% 36.50% No\nMeera Nair 10 1.5% 2% Yes\nTotal 100%"
    out = archetypes.extracted(pages(spark, [page], ["Financial Year: 2024-25 (as on 31 March 2025)\nno rows"]), "SHAREHOLDING_PATTERN")
    facts = sorted((r.holder_name, r.valid_from, r.valid_to, r.pct_holding, r.shares, r.pledged) for r in archetypes.shareholdings(out).collect())
    assert [f[1:4] for f in facts if f[0].endswith("Deshmukh")] == [(dt.date(2023, 4, 1), dt.date(2024, 3, 31), Decimal("36.50")), (dt.date(2024, 4, 1), dt.date(2025, 3, 31), Decimal("37.00"))]
    assert len(facts) == 4 and facts[-1][5] is True and facts[0][4] == 1850000
    assert out.where("doc_id = 1").first().missing == ["rows"]


def test_register_text(spark):
    payroll = pages(spark, ["Payroll\nEMP0001 Asha Rao Manager Employee\n192 12,00,000 1,20,000\nCONS0002 B. Das\n(Director) Professional 194J 5,00,000 50,000\nNote: EMP9999 x"])
    got = sorted(tuple(r)[3:] for r in text.payroll_rows(payroll).collect())
    assert got == [("CONS0002", "B. Das (Director)", "Professional", "194J", "500000", "50000"), ("EMP0001", "Asha Rao Manager", "Employee", "192", "1200000", "120000")]
    firc = pages(spark, ["INV/EXP/24-\n25/0001 05-Apr-2024 USD 24,000 HDFC Bank, Fort Branch FIRC/2024/HD/ 77 Realised\nINV/EXP/24-25/0002 06-Apr-2024 EUR10 Other Bank Pend- ing\nBoth bank-issued INV/EXP/24-25/0003"])
    got = sorted(tuple(r)[3:] for r in text.realisation_rows(firc, ["HDFC Bank, Fort Branch"]).collect())
    assert got == [("INV/EXP/24-25/0001", "2024-04-05", "USD 24,000", "HDFC Bank, Fort Branch", "FIRC/2024/HD/77", "Realised"), ("INV/EXP/24-25/0002", "2024-04-06", "EUR 10", "", "", "Other Bank Pend-ing")]
    cert = archetypes.extracted(pages(spark, ["Form 15CA Acknowledgement No.: 123\nRemittee: Acme GmbH\nRemittance Amount: USD 24,000 ( 19,92,000 equivalent)"]), "FORM_15CA_15CB")
    row = cert.select(text.remittance_row(F.col("facts")).alias("r")).first().r
    assert (row.form_15ca_ack_no, row.remittance_amount_inr, row.classification) == ("123", "1992000", "")


def test_transaction_text(spark):
    page = "Consignment Note (LR) No.: LR1\nConsignment Note Date: 03 April 2024\nGTA GSTIN: 24aaaaa0000a1z5\nGTA Name: Fast\nFreight Charges: 40,000\nGST Payable under RCM: 2,000 (5%)"
    row = archetypes.transaction_row(archetypes.extracted(pages(spark, [page]), "GTA_INVOICE_CONSIGNMENT_NOTE"), "GTA_INVOICE_CONSIGNMENT_NOTE")
    heads, _, wrong = documents.transactions(row.withColumn("path", F.col("path").cast("string")), CONTRACTS["GTA_INVOICE_CONSIGNMENT_NOTE"])
    assert wrong.count() == 0 and heads.first().total_tax_value == Decimal("2000.00")
    assert row.first().cells["gst_rate"] == "5.00" and row.first().cells["hsn_sac"] == "996791"


def test_grammars():
    c = contract("direction=INWARD;counterparty=FOREIGN;doc=a:text!,b:date;line=c:money")
    assert [a.required for a in c.doc] == [True, False] and c.line[0].kind == "money"
    for bad in ("direction=UP;counterparty=FOREIGN", "direction=INWARD;counterparty=FOREIGN;doc=a:blob", "direction=INWARD;counterparty=FOREIGN;doc=a:text,a:text", "direction=INWARD;counterparty=FOREIGN;x=1", "direction=INWARD;counterparty=FOREIGN;doc=doc_number:text"):
        with pytest.raises(ValueError):
            contract(bad)
    e = extraction('authority=X;fields=a:text!:"La, bel",d:date:"Day";table_pattern="(?P<h>.+?);(?P<n>\\d+)";table_columns=h:text,n:int')
    assert (e.authority, [f.label for f in e.fields], e.columns) == ("X", ["La, bel", "Day"], (("h", "text"), ("n", "int")))
    for bad in ("authority=X", 'fields=a:blob!:"x"', 'fields=;table_pattern="(?P<a>x)"', 'fields=;table_pattern="(?P<a>x)";table_columns=b:text'):
        with pytest.raises(ValueError):
            extraction(bad)


def test_check_shapes():
    shape = catalogue.check_shape
    assert shape("CHECK ((fy ~ '^[0-9]{4}-[0-9]{2}$'::text))", "fy") == {"pattern": "^[0-9]{4}-[0-9]{2}$"}
    assert shape("CHECK (((note_type IS NULL) OR (note_type = ANY (ARRAY['CN'::text, 'DN'::text]))))", "note_type") == {"allowed": ["CN", "DN"]}
    assert shape("CHECK (((rate >= (0)::numeric) AND (rate <= (100)::numeric)))", "rate") == {"min": Decimal(0), "max": Decimal(100)}
    assert shape("CHECK ((n > 0))", "n", whole=True) == {"min": Decimal(1)} and shape("CHECK ((n > 0))", "n") is None
    assert shape("CHECK ((a > b))", "a") is None and shape("CHECK ((other >= 1))", "a") is None


def test_catalogue_and_dispatch(spark):
    assert catalogue.release() == catalogue.release() and len(catalogue.release()[1]) == 64
    found = catalogue.fields(spark)
    assert found.where("document_type = 'PURCHASE_REGISTER' and field = 'invoice_no' and required").count() == 1
    assert found.where("kind = 'UNSPECIFIED' and field is null").count() >= 1
    assert dispatch.mechanism("SALES_REGISTER") == "SALES_REGISTER" and dispatch.mechanism("GSTR_2B") == "GSTN_JSON"
    assert dispatch.mechanism("LUT") == "PDF_EXTRACTION" and dispatch.mechanism("TRIAL_BALANCE") == "REGISTER_LOADER" and dispatch.mechanism("IRN_IRP_REGISTER") == "TRANSACTION"
    with pytest.raises(LookupError):
        dispatch.mechanism("NOPE")
    with pytest.raises(ValueError, match="gstin"):
        dispatch.require("TRIAL_BALANCE", entity_id="e", period_start="a", period_end="b")
