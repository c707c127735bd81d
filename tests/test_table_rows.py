"""Rows of flattened tables: against every window tried, on texts that wrap anywhere."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest

from ledgerline.functions import text
from ledgerline.functions.text import WINDOW, RowForm
from ledgerline.plans.contracts import EXTRACTIONS

SPECS = {t: spec for t, (_, spec) in EXTRACTIONS.items() if spec.pattern}
WORDS = "Arvind Rao Holder Name Active Suspended Regular Yes No 37.00% 18,50,000 27AABCM4521F1 Z5 27AABCM4521F1Z5 07123456 Director Whole-time 12-Apr-2021 12 April 2021 31-Jul-2025 (31-Jul-2025) Haryana CFO Company Secretary ABCDE1234F 01/04/2020 2024-04-01 - &".split(" ")


def every_window(pages, pattern, columns):
    """The rows by definition: at each line all windows are tried, shortest first."""
    lines = [x for x in (line.strip() for line in "\n".join(pages).splitlines()) if x]
    at, form, readers = 0, re.compile(pattern), [(n, text._reader(k)) for n, k in columns]
    while at < len(lines):
        for n in range(1, min(WINDOW, len(lines) - at) + 1):
            m = form.fullmatch(" ".join(lines[at : at + n]))
            row = m and [read(m[name]) for name, read in readers]
            if row and None not in row:
                yield row
                at += n
                break
        else:
            at += 1


CASES = {t: (s.pattern, list(s.columns)) for t, s in SPECS.items()} | {
    "lookahead": (r"(?!Name\b)(?P<a>[A-Z][a-z]+(?: [A-Z][a-z]+)?)\s+(?P<b>\d[\d,]*)(?: (?!No)(?P<c>\S+))?\s+(?P<d>Yes|No)", [("a", "text"), ("b", "money"), ("d", "text")]),
    "dates": (r"(?P<a>[A-Z][a-z]+)\s+(?P<d>.{8,14})", [("a", "text"), ("d", "date")]),
    "one": (r"(?P<n>\d[\d,]+)", [("n", "int")]),
}


@pytest.mark.parametrize("name", CASES)
def test_rows_are_those_of_every_window(name):
    pattern, columns = CASES[name]
    form, draw, found = RowForm(pattern, columns), random.Random(7), 0
    for _ in range(400):
        pages = ["".join(draw.choice(WORDS) + draw.choice(["\n", "\n", " ", "  ", "\n\n "]) for _ in range(draw.randrange(40))) for _ in range(draw.randrange(3))]
        want = list(every_window(pages, pattern, columns))
        assert list(form.rows(pages)) == want
        found += len(want)
    assert found or name in SPECS


def test_wrapped_rows_in_frames(spark):
    docs = spark.createDataFrame([(1, ["Name Shares\nAnn Lee\n1,200 Yes\nx"]), (2, None), (3, []), (4, [None, "Bo 7 No"])], "id int, pages array<string>")
    pattern, columns = r"(?P<name>[A-Z][a-z]+(?: [A-Z][a-z]+)?)\s+(?P<shares>[\d,]+)\s+(?P<pledged>Yes|No)", [("name", "text"), ("shares", "money"), ("pledged", "text")]
    got = {r.id: r.rows for r in text.table_rows(docs, pattern, columns).collect()}
    assert got == {1: [{"name": "Ann Lee", "shares": "1200", "pledged": "Yes"}], 2: [], 3: [], 4: [{"name": "Bo", "shares": "7", "pledged": "No"}]}


def test_table_function(spark):
    text.register(spark)
    spark.createDataFrame([(1, ["Ann 1,200.505 12-Apr-2021\nBo\n9 1-May-2020"]), (2, None)], "id int, pages array<string>").createOrReplaceTempView("docs_of_test")
    ask = "SELECT id, r.* FROM docs_of_test, LATERAL document_rows(pages, '(?P<who>[A-Z][a-z]+) (?P<paid>[0-9,.]+) (?P<day>\\\\S+)', '{}') r ORDER BY id, place"
    rows = spark.sql(ask.format("who text, paid money, day date"))
    assert rows.schema["paid"].dataType.simpleString() == "decimal(18,2)"
    assert [tuple(r) for r in rows.collect()] == [(1, 1, "Ann", Decimal("1200.50"), dt.date(2021, 4, 12)), (1, 2, "Bo", Decimal("9.00"), dt.date(2020, 5, 1))]
    for bad in ("who blob", "lost text", "who"):
        with pytest.raises(Exception, match="name and a kind|without a group"):
            spark.sql(ask.format(bad)).collect()
