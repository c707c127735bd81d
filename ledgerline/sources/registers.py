"""Register and transaction files as rows of text cells with record numbers (S-01 to S-04, S-23).

Record numbers of CSV files count records, and a quoted cell may hold line ends,
so a file is parsed in order by one task, on Arrow batches; uploads are at most
200 MiB and are dealt out over tasks (``large_csv`` splits larger files). A file
without data rows is refused. What follows is column expressions.
"""

from __future__ import annotations

import codecs
import csv
import io
import json
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import coerce, hashing
from ledgerline.plans.registers import Column as Spec
from ledgerline.plans.registers import Register

ROWS = "path string, line int, cells map<string,string>, problem string, fatal string"
_BATCH = 10_000
_PIECE = 1 << 20


def _not_utf8(data: bytes) -> str | None:
    """Why a file isn't text; it is decoded piece by piece, so that a large file doesn't stand in memory several times."""
    decoder = codecs.getincrementaldecoder("utf-8-sig")()
    try:
        for at in range(0, len(data), _PIECE):
            decoder.decode(data[at : at + _PIECE])
        decoder.decode(b"", final=True)
    except UnicodeDecodeError:
        try:
            data.decode("utf-8-sig")
        except UnicodeDecodeError as e:
            return f"not UTF-8 at byte {e.start}"
    return None


def _text(data: bytes, newline: str = "") -> io.TextIOWrapper:
    return io.TextIOWrapper(io.BytesIO(data), encoding="utf-8-sig", newline=newline)


def _records(data: bytes) -> Iterable[list[str]]:
    """What ``csv.reader`` gives; without quotes and carriage returns that is what stands between line ends and commas."""
    if len(data) <= _PIECE and b'"' not in data and b"\r" not in data:
        lines = data.decode("utf-8-sig").split("\n")
        if max(map(len, lines)) <= csv.field_size_limit():
            return (line.split(",") if line else [] for line in lines)
    return csv.reader(_text(data))


def _csv(data: bytes, wanted: list[str], lower: bool) -> Iterator[tuple]:
    if wrong := _not_utf8(data):
        yield None, None, None, wrong
        return
    reader = iter(_records(data))
    header = next((r for r in reader if r), None)
    if header is None:
        yield None, None, None, "no header"
        return
    if lower:
        header = [h.strip().lower() for h in header]
    if lost := [w for w in wanted if w not in header]:
        yield None, None, None, f"missing columns: {', '.join(lost)}"
        return
    number = 1
    for record in reader:
        if not record:
            continue
        number += 1
        yield number, (header[: len(record)], record[: len(header)]), None, None
    if number == 1:
        yield None, None, None, "no data rows"


def _ndjson(data: bytes, wanted: list[str]) -> Iterator[tuple]:
    if wrong := _not_utf8(data):
        yield None, None, None, wrong
        return
    checked, rows = False, 0
    for number, line in enumerate(_text(data, "\n"), 1):
        if not line.strip():
            continue
        rows += 1
        try:
            record = json.loads(line, parse_float=str, parse_int=str)  # a number keeps its text
        except ValueError:
            yield number, None, "not JSON", None
            continue
        if not isinstance(record, dict):
            yield number, None, "not an object", None
            continue
        if not checked and (lost := [w for w in wanted if w not in record]):
            yield None, None, None, f"missing columns: {', '.join(lost)}"
            return
        checked = True
        cell = lambda v: None if v is None else v if isinstance(v, str) else str(v).lower() if isinstance(v, bool) else json.dumps(v)
        yield number, (list(record), [cell(v) for v in record.values()]), None, None
    if not rows:
        yield None, None, None, "no data rows"


def cells(files: DataFrame, wanted: list[str], form: str = "CSV", lower: bool = False, flat: bool = False) -> DataFrame:
    """(path, line, cells, problem, fatal): a row per record; a file that can't be read gives one fatal row.

    flat: cells are a struct of the wanted columns instead of a map of all, so a cell is found by its place, not by a search.
    """
    laid = (lambda rows: _columns(rows, wanted)) if flat else _batch

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []  # filled across files, since a batch costs as much as hundreds of rows
        for batch in batches:
            for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for row in _csv(data.as_py(), wanted, lower) if form == "CSV" else _ndjson(data.as_py(), wanted):
                    out.append((path, *row))
                    if len(out) == _BATCH:
                        yield laid(out)
                        out = []
        if out:
            yield laid(out)

    own = f"struct<{','.join(f'`{w}`:string' for w in wanted)}>"
    return files.select("path", "content").mapInArrow(run, ROWS.replace("map<string,string>", own) if flat else ROWS)


def _columns(rows: list[tuple], wanted: list[str]) -> pa.RecordBatch:
    """cells come as (names, values) and are laid out by column; of a name that is given twice the first counts, as in a map."""
    path, line, given, problem, fatal = zip(*rows, strict=True)
    found, names, places = [], None, ()
    for g in given:
        if g is None:
            found.append((None,) * len(wanted))
            continue
        if g[0] != names:
            names = g[0]
            at = dict(zip(reversed(names), range(len(names) - 1, -1, -1), strict=True))
            places = [at.get(w) for w in wanted]
        values = g[1]
        found.append([None if p is None else values[p] for p in places])
    arrays = [pa.array(c, pa.string()) for c in zip(*found, strict=True)]
    none = pa.array([g is None for g in given])
    struct = pa.StructArray.from_arrays(arrays, names=wanted, mask=none)
    plain = [pa.array(c, k) for c, k in zip((path, line, problem, fatal), (pa.string(), pa.int32(), pa.string(), pa.string()), strict=True)]
    return pa.RecordBatch.from_arrays([*plain[:2], struct, *plain[2:]], ["path", "line", "cells", "problem", "fatal"])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    """cells come as (names, values) and are laid out as one flat map column."""
    path, line, given, problem, fatal = zip(*rows, strict=True)
    names, values, ends = [], [], [0]
    for g in given:
        if g is not None:
            names += g[0]
            values += g[1]
        ends.append(len(names))
    starts = pa.array(ends, pa.int32(), mask=np.array([*(g is None for g in given), False]))  # a null offset is a null map
    maps = pa.MapArray.from_arrays(starts, pa.array(names, pa.string()), pa.array(values, pa.string()))
    plain = [pa.array(c, k) for c, k in zip((path, line, problem, fatal), (pa.string(), pa.int32(), pa.string(), pa.string()), strict=True)]
    return pa.RecordBatch.from_arrays([*plain[:2], maps, *plain[2:]], ["path", "line", "cells", "problem", "fatal"])


def typed(rows: DataFrame, columns: tuple[Spec, ...], cell=lambda name: F.col("cells")[name]) -> DataFrame:
    """P-01 to P-07, U-01: the typed columns, row_hash, and ``reject`` (column, message) for the first failure.

    Required cells come first (the message lists all blank ones), then coercions in column order.
    """
    raw = {c.name: coerce.cell(cell(c.name)) for c in columns}
    trimmed = rows.withColumns({f"_t_{n}": v for n, v in raw.items()})
    trimmed = trimmed.withColumns({f"_v_{c.name}": coerce.KINDS[c.kind](F.col(f"_t_{c.name}")) for c in columns if c.kind != "text"})
    t = lambda c: F.col(f"_t_{c.name}")
    v = lambda c: F.col(f"_v_{c.name}") if c.kind != "text" else t(c)
    needed = [c for c in columns if c.required]
    problem = F.col("problem") if "problem" in rows.columns else F.lit(None).cast("string")
    tests: list[Column] = [F.when(problem.isNotNull(), F.struct(F.lit(None).cast("string").alias("column"), problem.alias("message")))]
    if needed:
        blank = F.array_compact(F.array(*[F.when(t(c).isNull(), F.lit(c.name)) for c in needed]))
        tests.append(F.when(F.size(blank) > 0, F.struct(blank[0].alias("column"), F.concat(F.lit("required: "), F.array_join(blank, ", ")).alias("message"))))
    for c in columns:
        if c.kind != "text":
            message = F.concat(F.lit(f"{c.name}: not a {c.kind}: "), t(c))
            tests.append(F.when(t(c).isNotNull() & v(c).isNull(), F.struct(F.lit(c.name).alias("column"), message.alias("message"))))
    out = trimmed.withColumn("reject", F.coalesce(*tests)).withColumn("row_hash", hashing.row_hash(*[f"_t_{c.name}" for c in columns]))
    return out.withColumns({c.name: v(c) for c in columns}).drop(*[f"_{x}_{c.name}" for c in columns for x in "tv"])


def collapsed(rows: DataFrame, file: str = "path", hashed: Sequence[str] = ()) -> DataFrame:
    """A-04, U-06: of a file's rows with equal hash the first, with ``copies``; before any upsert.

    hashed: columns that the hash covers, so that they make no further groups; rows that are
    dealt out by them already aren't moved again.
    """
    group = [file, "row_hash", *hashed]
    first = rows.groupBy(*group).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in group]), "line").alias("_row"), F.count(F.lit(1)).alias("copies"))
    return first.select(*group, "_row.*", "copies").select(*rows.columns, "copies")


def read(spark: SparkSession, files: DataFrame, register: Register, form: str = "CSV") -> tuple[DataFrame, DataFrame, DataFrame]:
    """A register's files: accepted rows (collapsed), rejected rows, and files that can't be read."""
    found = cells(files, list(register.names), form)
    good, bad = accepted(found.where("fatal is null"), register)
    return good, bad, found.where("fatal is not null").select("path", F.col("fatal").alias("reason"))


def accepted(found: DataFrame, register: Register) -> tuple[DataFrame, DataFrame]:
    """Accepted rows (collapsed) and rejected rows of cells."""
    rows = typed(found, register.columns)
    good = rows.where("reject is null").drop("cells", "problem", "fatal", "reject")
    bad = rows.where("reject is not null").select("path", F.col("line").alias("source_line"), F.col("reject.column").alias("column_name"), F.col("reject.message").alias("message"))
    return collapsed(good), bad


def with_period(rows: DataFrame, register: Register, start: Column, end: Column) -> DataFrame:
    """P-21: the register's period column; a fiscal-year register's period must lie in one year."""
    from ledgerline.functions import fiscal

    if register.period == "tax_period":
        out = rows.withColumn("tax_period", start)
    else:
        out = rows.withColumn("fy", F.when(fiscal.straddles(start, end), F.raise_error(F.lit("the period straddles two fiscal years"))).otherwise(fiscal.label(start)))
    return out.withColumn("valid_from", F.col(register.valid_from) if register.valid_from else start)


def mock_transactions(spark: SparkSession, n: int, seed: int = 7, lines: int = 3) -> DataFrame:
    """S-23: a seeded transaction file: the same rows for the same arguments, on any number of tasks."""
    pick = lambda salt, m: F.pmod(F.xxhash64(F.lit(seed), F.lit(salt), F.col("id")), F.lit(m))
    base = spark.range(n * lines).withColumns({"doc": F.expr(f"id div {lines}"), "k": F.expr(f"id % {lines} + 1")})
    value = (pick("value", 90_000_00) + 1000_00).cast("decimal(18,2)") / 100
    rate = F.element_at(F.array(*[F.lit(x) for x in ("5", "12", "18", "28")]), (pick("rate", 4) + 1).cast("int"))
    return base.select(
        F.format_string("DOC-%06d", "doc").alias("doc_number"),
        F.date_add(F.lit("2024-04-01").cast("date"), F.pmod(F.xxhash64(F.lit(seed), F.col("doc")), F.lit(365)).cast("int")).cast("string").alias("doc_date"),
        F.col("k").cast("string").alias("line_number"),
        F.format_string("%04d", pick("hsn", 9000) + 1000).alias("hsn_sac"),
        (pick("qty", 50) + 1).cast("string").alias("quantity"),
        value.cast("decimal(18,2)").cast("string").alias("unit_price"),
        value.cast("decimal(18,2)").cast("string").alias("taxable_value"),
        rate.alias("gst_rate"),
    )
