"""Small files share batches, large ones don't stand in memory several times, and payloads are parsed once."""

import tracemalloc

from pyspark.sql import functions as F

from ledgerline.sources import registers, returns


def test_small_files_share_batches(spark, monkeypatch):
    """Rows of the batches that come out of one task of 200 files."""
    files = spark.range(200).select(F.col("id").cast("string").alias("path"), F.concat(F.lit("a,b\n"), F.col("id").cast("string"), F.lit(',"x\ny"\nonly\n')).cast("binary").alias("content")).coalesce(1)
    out = registers.cells(files, ["a"])
    batches = out.mapInArrow(lambda bs: (b.slice(0, 1) for b in bs), out.schema).count()
    assert batches == 1
    rows = {(r.path, r.line): r.cells for r in out.collect()}
    assert len(rows) == 400 and rows["7", 2] == {"a": "7", "b": "x\ny"} and rows["7", 3] == {"a": "only"}


def test_a_large_file_is_decoded_as_it_is_read():
    data = b"\xef\xbb\xbfa,b\r\n" + b"1,\xc3\xa9\r\n" * 400_000
    tracemalloc.start()
    n = sum(1 for _ in registers._csv(data, ["a"], False))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 400_000 and peak < 8 * (registers._PIECE + 1)  # the text as a whole takes four times its length


def test_bad_bytes_are_refused_with_their_place():
    data = b"a\n" + b"1\n" * registers._PIECE + b"\xff\n"
    assert [r[3] for r in registers._csv(data, ["a"], False)] == [f"not UTF-8 at byte {len(data) - 2}"]
    assert [r[3] for r in registers._ndjson(b"\xc3", ["a"])] == ["not UTF-8 at byte 0"]
    assert [r[0] for r in registers._ndjson(b'\xef\xbb\xbf{"a": 1}\r\n\n{"a": "\xe2\x80\xa8"}', ["a"])] == [1, 3]


def test_payloads_are_parsed_once(spark):
    rows = spark.range(3).select(F.col("id").cast("string").alias("path"), F.from_json(F.concat(F.lit('{"gstin":"'), F.col("id").cast("string"), F.lit('","ret_period":"042024"}')), returns.GSTR_3B).alias("p"))
    day = F.lit("2024-04-01").cast("date")
    lines = returns.gstr_3b(rows, day)[1]
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
