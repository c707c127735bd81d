"""Sales files: cells by place, records without a parser where nothing is quoted, and column-wise comparison of doubtful documents alone."""

import csv
import random

from ledgerline.operators import documents
from ledgerline.sources import registers
from tests.test_documents import sales_rows


def test_plain_records_are_those_of_the_parser():
    r = random.Random(5)
    for _ in range(400):
        data = "".join(r.choice(["a", ",", "\n", "\r", '"', " ", "é", "\x00", " ", "\x0b", "bc"]) for _ in range(r.randrange(40))).encode()
        data = r.choice([b"", b"\xef\xbb\xbf"]) + data
        assert [x for x in registers._records(data) if x] == [x for x in csv.reader(registers._text(data)) if x]
    assert not isinstance(registers._records(b"a,b\n1,2"), type(csv.reader([])))
    assert isinstance(registers._records(b"a," + b"b" * 200_000), type(csv.reader([])))


def test_flat_cells_are_the_cells_of_the_map(spark):
    texts = ["a,b,c\n1,2,3\n\n4\n5,,6,7", 'b,a,a\n"1\n2",x,y\n', "﻿a,b\n1,2", "a,c\n1,2", "", "a,b\n", "c,b,a\r\n1,2,3\r\n"]
    files = spark.createDataFrame([(str(i), bytearray(t.encode())) for i, t in enumerate(texts)] + [("bad", bytearray(b"a,b\n\xff,1"))], "path string, content binary")
    for form in ("CSV", "NDJSON"):
        if form == "NDJSON":
            files = spark.createDataFrame([("f", bytearray(b'{"a": 1, "b": null}\nnot\n{"b": "x"}\n[1]'))], files.schema)
        mapped, flat = (registers.cells(files, ["a", "b"], form, flat=f).collect() for f in (False, True))
        want = {(r.path, r.line, None if r.cells is None else (r.cells.get("a"), r.cells.get("b")), r.problem, r.fatal) for r in mapped if r.path != "1"}
        assert {(r.path, r.line, None if r.cells is None else tuple(r.cells), r.problem, r.fatal) for r in flat if r.path != "1"} == want and len(flat) == len(mapped)
        if form == "CSV":
            assert [(tuple(r.cells)) for r in flat if r.path == "1"] == [("x", "1\n2")]  # the first of two columns of a name


def test_documents_that_agree_are_not_compared_by_column(spark):
    held = []
    rows = sales_rows(spark, {}, {"line_number": "2"})
    assert documents.sales_problems(rows, hold=lambda r: held.append(r) or r).count() == 0 and held[0].count() == 0
    for more, messages in (({"line_number": "2", "irn": "z"}, ["irn: rows disagree"]), ({}, ["line_number: given twice"]), ({"irn": "z", "currency": "USD"}, ["currency: rows disagree", "irn: rows disagree", "line_number: given twice"])):
        got = documents.sales_problems(sales_rows(spark, {}, more), hold=lambda r: held.append(r) or r)
        assert sorted(r.message for r in got.collect()) == messages and held[-1].count() == 1
    shifted = sales_rows(spark, {"irn": "\x1f0\x1f", "ewb_no": ""}, {"line_number": "2", "irn": "", "ewb_no": "\x1f0\x1f"})  # cells that hold the digest's separator
    assert {r.message for r in documents.sales_problems(shifted).collect()} == {"irn: rows disagree", "ewb_no: rows disagree"}
