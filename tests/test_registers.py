"""Register files: scanning, coercion, hashing, collapse and upserts, against a row-by-row model."""

import datetime as dt
import hashlib
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import coerce, fiscal
from ledgerline.operators import upsert
from ledgerline.plans import registers as plans
from ledgerline.sources import intake, registers

PURCHASE = plans.BY_TABLE["purchase_register"]
HEADER = ",".join(PURCHASE.names)


def files(spark, *contents):
    return spark.createDataFrame([(f"f{i}.csv", bytearray(c)) for i, c in enumerate(contents)], "path string, content binary")


def test_specs_are_sound():
    assert len(plans.REGISTERS) == 26 and sum(r.natural for r in plans.REGISTERS) == 13
    assert len(plans.BY_TYPE) == 32
    assert plans.BY_TABLE["trial_balance"].key_columns == ("entity_id", "gstin", "gl_code")
    assert plans.BY_TABLE["rcm_register"].key_columns == ("entity_id", "gstin", "tax_period", "row_hash")
    with pytest.raises(ValueError):
        plans.Register("t", ("T",), plans.columns("a a"))
    with pytest.raises(ValueError):
        plans.Register("t", ("T",), plans.columns("gstin"))
    with pytest.raises(ValueError):
        plans.Register("t", ("T",), plans.columns("a_date"), valid_from="a_date")
    with pytest.raises(ValueError):
        plans.Register("t", ("T",), plans.columns("a"), key=("b",))


def test_csv_rows_rejections_and_fatal_files(spark):
    good = (
        "﻿" + HEADER + ",extra\n"
        '27AAAAA0000A1Z5,INV-1,2024-04-03,8471," 1000.50 ",18,90.05,90.05,0,,GL1,"CC\nA",ELIGIBLE,yes,x\n'
        "\n"
        ",INV-2,2024-04-04,,200,,,,,,GL1,CC,,\n"
        ",INV-2,2024-04-04,,200,,,,,,GL1,CC,,\n"
        ",,2024-04-04,,,,,,,,GL1,CC,,\n"
        ",INV-3,04/04/2024,,1,,,,,,GL1,CC,,\n"
        ",INV-4,2024-04-04,,NaN,,,,,,GL1,CC,,\n"
        ",INV-5,2024-04-04,,1_000,,,,,,GL1,CC,,perhaps\n"
        ",INV-6\n"
    ).encode()
    lost = b"invoice_no\nX\n"
    ok, bad, fatal = registers.read(spark, files(spark, good, lost, b"\xff\xfe", b""), PURCHASE)
    rows = {r.invoice_no: r for r in ok.collect()}
    assert set(rows) == {"INV-1", "INV-2"}
    first = rows["INV-1"]
    assert first.taxable_value == Decimal("1000.50") and first.cess is None and first.rcm_flag is True and first.cost_centre == "CC\nA" and first.line == 2
    assert rows["INV-2"].copies == 2 and rows["INV-2"].rcm_flag is False and rows["INV-2"].supplier_gstin is None
    cells = ["27AAAAA0000A1Z5", "INV-1", "2024-04-03", "8471", "1000.50", "18", "90.05", "90.05", "0", "", "GL1", "CC\nA", "ELIGIBLE", "yes"]
    assert first.row_hash == hashlib.sha256("\x1f".join(cells).encode()).hexdigest()
    wrong = {r.source_line: (r.column_name, r.message) for r in bad.collect()}
    assert wrong == {
        5: ("invoice_no", "required: invoice_no, taxable_value"),
        6: ("invoice_date", "invoice_date: not a date: 04/04/2024"),
        7: ("taxable_value", "taxable_value: not a money: NaN"),
        8: ("taxable_value", "taxable_value: not a money: 1_000"),
        9: ("invoice_date", "required: invoice_date, taxable_value, gl_code, cost_centre"),
    }
    reasons = {r.path: r.reason for r in fatal.collect()}
    assert set(reasons) == {"f1.csv", "f2.csv", "f3.csv"} and reasons["f1.csv"].startswith("missing columns: supplier_gstin")


def test_ndjson_equals_csv_and_rejects_by_line(spark):
    spec = plans.BY_TABLE["trial_balance"]
    text = b'{"gl_code":"1","account_description":"a","opening_balance":18.0,"closing_balance":-5,"dr_cr":"DR","gst_treatment":null}\n\nnot json\n[1]\n{"gl_code":"2"}\n'
    csv = b"gl_code,account_description,opening_balance,closing_balance,dr_cr,gst_treatment\n1,a,18.0,-5,DR,\n"
    ok, bad, fatal = registers.read(spark, files(spark, text), spec, "NDJSON")
    same, _, _ = registers.read(spark, files(spark, csv), spec)
    assert [r.row_hash for r in ok.collect()] == [r.row_hash for r in same.collect()]
    assert {r.source_line: r.message for r in bad.collect()} == {3: "not JSON", 4: "not an object", 5: "required: account_description"}
    assert fatal.count() == 0
    assert registers.read(spark, files(spark, b'{"a":1}\n'), spec, "NDJSON")[2].count() == 1


@pytest.mark.parametrize(("kind", "cell", "value"), [("money", "1e3", Decimal("1000.00")), ("money", "-.5", Decimal("-0.50")), ("money", "1,000", None), ("money", "99999999999999999999", None), ("int", "12", 12), ("int", "1_2", None), ("date", "2024-2-3", None), ("date", "2024-02-30", None), ("date", "2024-02-29", dt.date(2024, 2, 29)), ("boolean", "Y", True), ("boolean", "maybe", None), ("rate", "12.345", Decimal("12.345"))])
def test_coercion(spark, kind, cell, value):
    row = spark.createDataFrame([(cell,)], "c string").select(coerce.KINDS[kind](F.col("c")).alias("v"), coerce.bad(kind, F.col("c")).alias("b")).first()
    assert row.v == value and row.b == (value is None)


def test_fiscal_years(spark):
    row = spark.range(1).select(
        fiscal.label(F.lit("2024-03-31").cast("date")).alias("a"),
        fiscal.label(F.lit("2099-04-01").cast("date")).alias("b"),
        fiscal.straddles(F.lit("2024-03-31").cast("date"), F.lit("2024-04-01").cast("date")).alias("c"),
        F.struct(*fiscal.bounds(F.lit("FY 2024-25"))).alias("d"),
        F.struct(*fiscal.bounds(F.lit("2024-26"))).alias("e"),
        F.struct(*fiscal.bounds(F.lit("2024-2025"), 1)).alias("f"),
    ).first()
    assert (row.a, row.b, row.c) == ("2023-24", "2099-00", True)
    assert tuple(row.d) == (dt.date(2024, 4, 1), dt.date(2025, 3, 31)) and tuple(row.e) == (None, None) and tuple(row.f) == (dt.date(2024, 1, 1), dt.date(2024, 12, 31))


def test_a_period_in_two_fiscal_years_is_refused(spark):
    spec = plans.BY_TABLE["trial_balance"]
    rows = spark.range(1).select(F.lit("1").alias("gl_code"))
    day = lambda d: F.lit(d).cast("date")
    assert registers.with_period(rows, spec, day("2024-04-01"), day("2025-03-31")).first().fy == "2024-25"
    with pytest.raises(Exception, match="straddles"):
        registers.with_period(rows, spec, day("2024-03-01"), day("2024-04-30")).collect()


def model(live, rows):
    """The upsert row by row: versions as [key, hash, from, to, live, action]."""
    versions = [[k, h, f, "9999-12-31", True, "kept"] for k, h, f in live]
    out = []
    for key, h, f in rows:
        old = next((v for v in versions if v[0] == key and v[4]), None)
        if old and old[1] == h:
            out.append([key, h, f, None, False, "unchanged"])
            continue
        if old:
            old[4] = False
            if f > old[2]:
                old[3] = f
            if old[5] == "kept":
                old[5] = "closed"
        versions.append([key, h, f, "9999-12-31", True, "superseded" if old else "inserted"])
    keys = {k for k, _, _ in rows}
    return sorted(map(str, [[v[0], v[1], v[2], v[3], v[4], v[5]] for v in versions if v[0] in keys])), sorted(str([o[0], o[1]]) for o in out)


@pytest.mark.parametrize("seed", range(4))
def test_natural_upsert_equals_the_loop(spark, seed):
    r = random.Random(seed)
    keys = ["a", "b", "c", None]
    day = lambda: f"2024-01-{r.randint(1, 28):02d}"
    live = [(k, r.choice("xyz"), day()) for k in keys if r.random() < 0.7]
    rows, seen = [], set()
    for _ in range(12):
        k, h = r.choice(keys), r.choice("xyzuvw")
        if (k, h) not in seen:
            seen.add((k, h))
            rows.append((k, h, day()))
    inc = spark.createDataFrame([(k, i, h, f) for i, (k, h, f) in enumerate(rows)], "k string, line int, row_hash string, f string").select("k", "line", "row_hash", F.to_date("f").alias("valid_from"))
    old = spark.createDataFrame([(k, h, f, str(i)) for i, (k, h, f) in enumerate(live)], "k string, row_hash string, f string, id string").select("k", "row_hash", F.to_date("f").alias("valid_from"), F.lit("9999-12-31").cast("date").alias("valid_to"), "id")
    got = upsert.natural(inc, old, ["k"]).collect()
    versions, unchanged = model(live, rows)
    assert sorted(str([g.k, g.row_hash, str(g.valid_from), str(g.valid_to), g.is_live, g.action]) for g in got if g.action != "unchanged") == versions
    assert sorted(str([g.k, g.row_hash]) for g in got if g.action == "unchanged") == unchanged
    again = upsert.natural(inc.limit(0), old, ["k"])
    assert again.count() == 0


def test_reloading_changes_nothing(spark):
    inc = spark.createDataFrame([("a", 1, "h1"), (None, 2, "h2")], "k string, line int, row_hash string").withColumn("valid_from", F.lit("2024-01-01").cast("date"))
    live = upsert.natural(inc, inc.limit(0).withColumns({"valid_to": F.lit(None).cast("date"), "id": F.lit("")}), ["k"]).where("is_live").select("k", "row_hash", "valid_from", "valid_to", F.col("row_hash").alias("id"))
    counts = upsert.counters(upsert.natural(inc, live, ["k"])).first()
    assert (counts.inserted, counts.superseded, counts.unchanged) == (0, 0, 2)


def test_content_upsert_appends_corrections(spark):
    row = lambda h, p: ("e", None, p, h)
    schema = "entity_id string, gstin string, tax_period string, row_hash string"
    got = upsert.content(spark.createDataFrame([row("1", "p"), row("2", "p"), row("1", "q")], schema), spark.createDataFrame([row("1", "p")], schema)).collect()
    assert {(r.row_hash, r.tax_period): r.action for r in got} == {("1", "p"): "unchanged", ("2", "p"): "inserted", ("1", "q"): "inserted"}


def test_children_follow_their_record(spark):
    kids = spark.createDataFrame([("r1", "a", None), ("r2", "b", None)], "record_id string, v string, superseded_at string")
    closed = spark.createDataFrame([("r1", "t")], "record_id string, superseded_at string")
    assert {(r.record_id, r.superseded_at) for r in upsert.children_of_closed(kids, closed).collect()} == {("r1", "t"), ("r2", None)}


def test_gates_and_fixture_choice(spark, tmp_path):
    for name in ("29AAA_042024.csv", "29AAA_042024.json", "29AAA_052024.csv", "27BBB_042024.pdf", "note.exe"):
        (tmp_path / name).write_bytes(b"x")
    found = intake.files(spark, str(tmp_path))
    out = {r["name"]: r.refusal for r in found.select("name", intake.refusal(F.col("name"), F.col("length")).alias("refusal")).collect()}
    assert out["note.exe"] == "UNSUPPORTED_EXTENSION" and sum(v is None for v in out.values()) == 4
    sizes = spark.createDataFrame([("a.exe", 0), ("a.exe", intake.MAX_BYTES + 1), ("a.CSV", intake.MAX_BYTES), ("csv", 1)], "name string, length long")
    assert [r[0] for r in sizes.select(intake.refusal(F.col("name"), F.col("length"))).collect()] == ["EMPTY_FILE", "FILE_TOO_LARGE", None, "UNSUPPORTED_EXTENSION"]
    picked = intake.preferred(found.withColumn("ref", F.lit("B1.03")), "29AAA", "042024").collect()
    assert [r["name"] for r in picked] == ["29AAA_042024.json"]
    kinds = spark.createDataFrame([("A", True), ("B", False)], "doc_type_code string, in_scope boolean")
    rows = spark.createDataFrame([("A",), ("B",), ("C",)], "doc_type_code string")
    assert {r.doc_type_code: r.type_refusal for r in intake.type_gate(rows, kinds).collect()} == {"A": None, "B": "OUT_OF_SCOPE", "C": "UNKNOWN_TYPE"}
    with pytest.raises(RuntimeError):
        intake.CONNECTORS["GSTN"].fetch(spark, "g", "p")


def test_mock_rows_repeat(spark):
    a, b = (registers.mock_transactions(spark, 20).repartition(n).orderBy("doc_number", "line_number").collect() for n in (1, 3))
    assert a == b and len(a) == 60
    assert a != registers.mock_transactions(spark, 20, seed=8).orderBy("doc_number", "line_number").collect()
