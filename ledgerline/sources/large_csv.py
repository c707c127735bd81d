"""S-01, S-04 for CSV files that one task shouldn't read: a prefix scan over blocks.

Spark's text source cuts a file into blocks of whole physical lines. Whether a line end
ends a record depends on all quotes before it, so a block's first pass gives a map: for
either state that it may start in (outside or inside quotes), the state that it ends in
and how many records start in it. Maps compose, so running them over a file's blocks
gives each block its state and its first record's number. The second pass parses all
records that lie in one block where they stand; the pieces of those that cross blocks,
one or two for a block, are brought together by their number. Nothing but the maps, a row for each block, is gathered.

Records, their numbers and refusals are those of ``registers.cells``, which follows
Python's ``csv``: a quote opens a field only at its start, a lone carriage return ends a
record, blank lines aren't counted. One thing differs: if a quote is never closed, the line
end at the very end of the file isn't part of its cell. Spark's readers skip files without
bytes; the intake gate refuses these by their length.
"""

from __future__ import annotations

import csv
import io
import itertools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.session import held
from ledgerline.sources.commitlog import SharedFiles

_INSIDE, _REST = re.compile(r'[^"]*(?:""[^"]*)*'), re.compile(r"[^,\r]*")
_BATCH = 10_000
MAPS = "path string, block long, out_quoted boolean, out_records long, in_quoted boolean, in_records long, bad boolean"
PARTS = "path string, line long, cells array<string>, block long, piece string"


def ends(line: str, quoted: bool) -> tuple[list[int], bool]:
    """Where records end within a physical line (its own end isn't listed), and whether it ends inside quotes."""
    if '"' not in line and "\r" not in line:
        return [], quoted
    at, cuts, n = 0, [], len(line)
    while True:
        if not quoted and line.startswith('"', at):
            at, quoted = at + 1, True
        if quoted:
            at = _INSIDE.match(line, at).end()
            if at == n:
                return cuts, True
            at, quoted = at + 1, False
        at = _REST.match(line, at).end()  # after its quotes a field goes on as it is
        if at == n:
            return cuts, False
        at += 1
        if line[at - 1] == "\r":
            if at == n:
                return cuts, False
            cuts.append(at)


def segments(line: str, quoted: bool) -> tuple[list[str], bool]:
    """A physical line cut at the ends of records, and whether it ends inside quotes."""
    cuts, after = ends(line, quoted)
    return [line[a:b] for a, b in zip([0, *cuts], [*cuts, len(line)], strict=True)], after


def block_map(lines: Iterable[str]) -> tuple[tuple[bool, int], tuple[bool, int]]:
    """For a block that starts outside and one that starts inside quotes: whether it ends inside, and how many records start in it."""
    ways = [(False, 0), (True, 0)]
    for line in lines:
        seen = {}
        for quoted in {q for q, _ in ways}:  # once the two ways meet they are one
            parts, after = segments(line, quoted)
            seen[quoted] = after, sum(bool(p.strip("\r")) for p in parts[quoted:])  # inside quotes the first part isn't a start
        ways = [(seen[q][0], n + seen[q][1]) for q, n in ways]
    return ways[0], ways[1]


def compose(first: tuple, second: tuple) -> tuple:
    """The map of two blocks in a row."""
    return tuple((second[q][0], n + second[q][1]) for q, n in first)


def parse(lines: Iterable[str], quoted: bool, number: int) -> Iterator[tuple[int, list[str] | None, str | None]]:
    """(record number, its cells, None) for records in the block, (number, None, piece) for those that cross its bounds.

    ``number``: how many records started before the block.
    """
    whole: list[str] = []  # complete records, for the reader
    open_: list[str] = []  # of the record under way
    ours = not quoted  # it started here
    inside = quoted

    def flush() -> Iterator[tuple]:
        nonlocal first
        for cells in csv.reader(iter(whole)):
            if cells:
                first += 1
                yield first, cells, None
        whole.clear()

    first = number  # the last number that was given
    for line in lines:
        parts, after = segments(line, inside)
        for i, part in enumerate(parts):
            last = i == len(parts) - 1
            open_.append(part + "\n" if last else part)
            if last and after:
                break
            if ours:
                whole += open_
            else:
                yield number, None, "".join(open_).removesuffix("\n")
            open_, ours = [], True
        inside = after
        if len(whole) >= _BATCH:
            yield from flush()
    yield from flush()
    if open_:
        text = "".join(open_).removesuffix("\n")
        yield (first + 1 if ours else number), None, text


def _text(block: int, data: bytes) -> str:
    """A line's text; a byte order mark may stand at the file's start."""
    text = data.decode("utf-8")
    return text.removeprefix("\ufeff") if block == 0 else text


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """The rows (path, block, line's bytes, ...) of a task by block, in the order of the file."""
    rows = (row for batch in batches for row in zip(*[batch.column(i).to_pylist() for i in range(batch.num_columns)], strict=True))
    return itertools.groupby(rows, key=lambda r: r[:2])


def _pack(rows: list[tuple], schema: str, kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in schema.split(", ")])


def _mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []
    for (path, block), rows in _blocks(batches):
        bad = False

        def texts(rows: Iterator[tuple] = rows, block: int = block) -> Iterator[str]:
            nonlocal bad
            for i, row in enumerate(rows):
                try:
                    yield _text(block + i, row[2])  # only the file's first line has number 0
                except UnicodeDecodeError:
                    bad = True

        (a, n), (b, m) = block_map(texts())
        out.append((path, block, a, n, b, m, bad))
    yield _pack(out, MAPS, [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_()])


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds, out = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.int64(), pa.string()], []
    for (path, block), rows in _blocks(batches):
        head = next(rows)
        lines = (_text(block + i, r[2]) for i, r in enumerate(itertools.chain((head,), rows)))
        for number, found, piece in parse(lines, head[3], head[4]):
            out.append((path, number, found, block, piece))
            if len(out) >= _BATCH:
                yield _pack(out, PARTS, kinds)
                out = []
    yield _pack(out, PARTS, kinds)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [next(csv.reader(io.StringIO(t, newline="")), []) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.string()))], ["path", "line", "cells"])


def placed(maps: DataFrame) -> DataFrame:
    """Maps with the state that each block starts in (quoted) and the number of records that start before it.

    A map of two states is constant, the identity or a swap: the state is that of the last
    constant map, swapped as often as swaps follow it.
    """
    w = Window.partitionBy("path").orderBy("block")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("out_quoted") == F.col("in_quoted")
    swap = (F.col("out_quoted") & ~F.col("in_quoted")).cast("int")
    rows = maps.withColumn("_swaps", F.sum(swap).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last(F.when(fixed, F.struct("out_quoted", "_swaps")), ignorenulls=True).over(before)
    rows = rows.withColumns({"_last": last, "_swapped": F.coalesce(F.sum(swap).over(before), F.lit(0))})
    odd = F.pmod(F.col("_swapped") - F.coalesce("_last._swaps", F.lit(0)), F.lit(2)) == 1
    rows = rows.withColumn("quoted", F.coalesce("_last.out_quoted", F.lit(False)) != odd)
    rows = rows.withColumn("_own", F.when(F.col("quoted"), F.col("in_records")).otherwise(F.col("out_records")))
    return rows.withColumn("number", F.coalesce(F.sum("_own").over(before), F.lit(0)))


#: Blocks whose states are sent to all tasks: 2**20 blocks of 128 MB are 128 TB.
MOST_BLOCKS = 1 << 20


def _header(files: SharedFiles, path: str) -> list[str]:
    """The first record, from as many bytes of the file as it takes."""
    size = 1 << 16
    while True:
        data = files.head(path, size)
        text = data.decode("utf-8", "ignore").removeprefix("\ufeff")
        state, whole = False, ""
        for line in text.split("\n")[: None if len(data) < size else -1]:
            parts, after = segments(line, state)
            for i, part in enumerate(parts):
                whole += part
                if i == len(parts) - 1 and after:
                    whole += "\n"
                elif whole.strip("\r"):
                    return next(csv.reader(io.StringIO(whole, newline="")))
                else:
                    whole = ""
            state = after
        if len(data) < size:
            return next(csv.reader(io.StringIO(whole, newline="")), [])
        size *= 4


def cells(spark: SparkSession, paths: str | list[str], wanted: list[str], lower: bool = False) -> DataFrame:
    """(path, line, cells, problem, fatal) of CSV files, as ``registers.cells`` gives them, each file read by many tasks.

    Two passes over the files: the maps, then the records. A file without a header, with a
    column missing, without data rows or that isn't UTF-8 gives one fatal row.
    """
    listed = spark.read.format("binaryFile").load(paths).select("path")  # contents aren't read
    raw = spark.read.option("lineSep", "\n").text(paths).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))
    maps = held(raw.mapInArrow(_mapped, MAPS), "csv_blocks")
    if maps.count() > MOST_BLOCKS:
        raise ValueError("too many blocks: raise spark.sql.files.maxPartitionBytes")
    starts = held(placed(maps), "csv_starts")
    facts = {r.path: r for r in starts.groupBy("path").agg(F.sum("_own").alias("n"), F.max("bad").alias("bad")).collect()}  # a row for each file
    fatal, heads, files = [], [], SharedFiles(spark)
    for (path,) in listed.select("path").collect():
        fact = facts.get(path)
        header = [] if fact is None or fact.bad else [h.strip().lower() if lower else h for h in _header(files, path)]
        lost = [w for w in wanted if w not in header]
        reason = "not UTF-8" if fact is not None and fact.bad else "no header" if not header else f"missing columns: {', '.join(lost)}" if lost else "no data rows" if fact.n < 2 else None
        (fatal if reason else heads).append((path, reason or header))
    state = starts.select("path", "block", "quoted", "number")
    names = spark.createDataFrame(heads, "path string, names array<string>")
    parts = raw.join(F.broadcast(state.join(names, "path", "left_semi")), ["path", "block"]).select("path", "block", "value", "quoted", "number").mapInArrow(_parsed, PARTS)
    order = F.sort_array(F.collect_list(F.struct("block", "piece")))
    crossing = parts.where("piece is not null").groupBy("path", "line").agg(F.array_join(F.transform(order, lambda x: x["piece"]), "\n").alias("text"))  # the pieces of one record
    records = parts.where("piece is null").select("path", "line", "cells").unionByName(crossing.mapInArrow(_joined, "path string, line long, cells array<string>"))
    n = F.least(F.size("names"), F.size("cells"))
    pairs = F.arrays_zip(F.slice("names", F.lit(1), n).alias("k"), F.slice("cells", F.lit(1), n).alias("v"))
    # the last of columns that share a name holds, as in a dictionary
    mapped = F.aggregate(pairs, F.create_map().cast("map<string,string>"), lambda m, x: F.map_concat(F.map_filter(m, lambda k, _: k != x["k"]), F.create_map(x["k"], x["v"])))
    distinct = F.size(F.array_distinct(F.slice("names", F.lit(1), n))) == n
    made = F.when(distinct, F.map_from_arrays(F.slice("names", F.lit(1), n), F.slice("cells", F.lit(1), n))).otherwise(mapped)
    none = F.lit(None).cast("string")
    rows = records.where("line > 1").join(F.broadcast(names), "path").select("path", F.col("line").cast("int").alias("line"), made.alias("cells"), none.alias("problem"), none.alias("fatal"))
    refused = spark.createDataFrame(fatal, "path string, fatal string").select("path", F.lit(None).cast("int").alias("line"), F.lit(None).cast("map<string,string>").alias("cells"), none.alias("problem"), "fatal")
    return rows.unionByName(refused)
