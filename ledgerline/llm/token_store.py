"""Operator 8: token ids as binary segments, bit- or byte-plane shuffled.

Documents are range-partitioned and sorted by id, so segment after segment the
ids stand in ascending doc_id order. A segment is one byte image:

    magic "LTS1", plane kind (1 bit, 8 byte), ids in a block, number of ids, number of blocks
    chunk index: for each block and plane the length of its chunk (0: the plane is all zero)
    chunks: each plane of each block, compressed with zstandard

A block is a fixed number of 32-bit ids, transposed so that a plane holds one
bit (or byte) of every id. Segments are rows of a Parquet table with the ids
and lengths of their documents; any store that Spark writes can hold it, and a
segment is read without its neighbours. A segment ends with the document that
brings it to SEGMENT ids, so memory is bounded by that and the longest text.

A null text counts as empty: just the end id. Null doc_ids come first, repeated
doc_ids are ordered by text; extra columns aren't stored; an empty table gives
an empty table.
"""

from __future__ import annotations

import functools
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm import common, words

MAGIC, HEAD = b"LTS1", struct.Struct("<4sBIQI")
BLOCK, SEGMENT = 65_536, 1_000_000


def pack(ids: np.ndarray, planes: str = "byte", block: int = BLOCK) -> bytes:
    """A segment's image."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    kind = {"bit": 1, "byte": 8}[planes]
    lengths, chunks = [], []
    for at in range(0, len(ids), block):
        part = np.ascontiguousarray(ids[at : at + block], dtype="<u4").view(np.uint8).reshape(-1, 4)
        rows = part.T if kind == 8 else np.unpackbits(part, axis=1, bitorder="little").T
        for row in rows:
            chunk = b"" if not row.any() else squeeze((row if kind == 8 else np.packbits(row, bitorder="little")).tobytes())
            lengths.append(len(chunk))
            chunks.append(chunk)
    blocks = -(-len(ids) // block)
    return b"".join([HEAD.pack(MAGIC, kind, block, len(ids), blocks), np.array(lengths, "<u4").tobytes(), *chunks])


def unpack(image: bytes) -> np.ndarray:
    """The ids of a segment's image."""
    magic, kind, block, n, blocks = HEAD.unpack_from(image)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    planes = 32 // kind
    lengths = np.frombuffer(image, "<u4", blocks * planes, HEAD.size)
    ends = np.cumsum(lengths, dtype=np.int64) + HEAD.size + lengths.nbytes
    expand = zstandard.ZstdDecompressor().decompress
    out = []
    for b in range(blocks):
        size = min(block, n - b * block)
        rows = np.zeros((planes, size), np.uint8)
        for p in range(planes):
            k = b * planes + p
            if lengths[k]:
                raw = np.frombuffer(expand(image[ends[k] - lengths[k] : ends[k]]), np.uint8)
                rows[p] = raw if kind == 8 else np.unpackbits(raw, count=size, bitorder="little")
        flat = np.ascontiguousarray(rows.T)
        out.append((flat if kind == 8 else np.packbits(flat, axis=1, bitorder="little")).reshape(-1).view("<u4"))
    return np.concatenate(out) if out else np.zeros(0, "<u4")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> words.TextMap:
    """The tokenizers library's ids of a text as little-endian bytes.

    The library's model is asked once for each pre-token that a worker remembers.
    """
    split = words.Splitter(path)
    model, special = words.library(path).model, split.special
    letters = {b: letter for letter, b in words.byte_letters().items()}

    def ids(word: str) -> bytes:
        if word in special:
            return struct.pack("<I", special[word])
        return array("I", [t.id for t in model.tokenize(word.encode().decode("latin-1").translate(letters))]).tobytes()

    return words.TextMap(split, ids, b"".join)


SEGMENTS = "part int, seq int, n_ids long, docs binary, null_docs long, lengths binary, image binary"


def write(docs: DataFrame, path: str, end_id: int = 0, planes: str = "byte", vocabulary: str | None = None) -> None:
    """Encodes all texts with ``end_id`` after each and writes the segments to ``path``."""
    file = vocabulary or words.default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end, part, seq = encoder(file), struct.pack("<I", end_id), TaskContext.get().partitionId(), 0
        ids, names, sizes, nulls, held = [], [], [], 0, 0

        def segment() -> pa.RecordBatch:
            image = pack(np.frombuffer(b"".join(ids), "<u4"), planes)
            row = [part, seq, held, np.array(names, "<i8").tobytes(), nulls, np.array(sizes, "<i8").tobytes(), image]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], [c.split()[0] for c in SEGMENTS.split(", ")])

        for batch in common.lean(batches, "token_store", encoder.cache_clear):
            for name, text in zip(batch.column(0), batch.column(1), strict=True):
                name, raw = name.as_py(), encode(text.as_py() or "") + end
                nulls += name is None
                names.append(name or 0)  # nulls come first, so their number tells them
                sizes.append(len(raw) // 4)
                ids.append(raw)
                held += sizes[-1]
                if held >= SEGMENT:
                    yield segment()
                    ids, names, sizes, nulls, held, seq = [], [], [], 0, 0, seq + 1
        if names:
            yield segment()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, SEGMENTS).write.parquet(path)


def _placed(spark: SparkSession, path: str, *columns) -> DataFrame:
    """doc_id, start, and ``columns`` made of its ids; ids that no column keeps aren't moved."""
    table = spark.read.parquet(path)
    # one row per segment, a million ids each: this window stays small
    earlier = F.sum("n_ids").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1))
    before = table.select("part", "seq", F.coalesce(earlier, F.lit(0)).alias("before"))
    own = _documents(table).select("part", "seq", "doc_id", "at", *columns)
    return own.join(before, ["part", "seq"]).withColumn("start", F.col("before") + F.col("at")).drop("part", "seq", "before", "at")


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), ids as little-endian bytes."""
    return _placed(spark, path, "ids").select("doc_id", "start", "ids")


def _documents(table: DataFrame) -> DataFrame:

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["image"]).tobytes()
                names, sizes = np.frombuffer(row["docs"], "<i8"), np.frombuffer(row["lengths"], "<i8")
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["part"]] * len(names), pa.int32()),
                        pa.array([row["seq"]] * len(names), pa.int32()),
                        pa.array(names, pa.int64(), mask=np.arange(len(names)) < row["null_docs"]),
                        pa.array(ends - sizes, pa.int64()),
                        pa.array([ids[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)], pa.binary()),
                    ],
                    ["part", "seq", "doc_id", "at", "ids"],
                )

    return table.select("part", "seq", "docs", "null_docs", "lengths", "image").mapInArrow(run, "part int, seq int, doc_id long, at long, ids binary")


def summaries(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32."""
    own = _placed(spark, path, (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    return own.select("doc_id", "start", "n_tokens", "ids_crc32")


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.scratch(spark, "token_store")
    write(common.table(spark, sf_dir, "documents"), path)
    return summaries(spark, path)
