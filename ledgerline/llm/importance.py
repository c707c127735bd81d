"""Operator 12: resampling documents by importance towards a target distribution of hashed n-grams.

Features are words and pairs of neighbouring words, hashed into BUCKETS by CRC-32
(Xie et al., "Data Selection for Language Models via Importance Resampling", 2023).
A document's weight is the mean of its features' gains, the log ratio of a bucket's
share in the target to its share in the corpus; documents are drawn without
replacement by the largest weight plus Gumbel noise that depends on the id alone.

Hashing is a byte automaton over the UTF-8 buffer of an Arrow batch. One look-up
classifies and lower-cases all bytes, word boundaries are where the class differs
from its neighbour's, and the CRC registers of all words of a block advance together,
byte by byte, each word leaving when it ends. A pair's register goes on from the
register of its first word. Blocks of BLOCK bytes end between words and hand the last
register on, so memory doesn't grow with a text's length, and words past LONG bytes
are finished by zlib's CRC-32 alone.

Texts are read twice (counts, then weights); counts are BUCKETS rows at most for each
task, and the gains, BUCKETS numbers, are the only thing that goes to the driver and
to all tasks. Ranks need a total order: narrow rows are dealt out by range, numbered
where they stand, and shifted by the counts of the ranges before.

Null texts have no words: weight 0. A null doc_id draws like the empty text and comes
last of equal scores; rows that tie in score and doc_id get ranks of their own in any
order. Repeated rows are documents of their own. Extra columns aren't read. Without
documents there are no rows; without a target all gains follow from the corpus alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm import common

BUCKETS, MIN_WORDS, SHARE, SEED = 10_000, 20, 25, 7
BLOCK, LONG = 1 << 21, 64
_POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    rows = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        rows = np.where(rows & 1, (rows >> 1) ^ np.uint32(_POLYNOMIAL), rows >> 1).astype(np.uint32)
    return rows


def _byte_table() -> np.ndarray:
    """Byte -> itself in lower case, or 0 where no word goes on."""
    out = np.zeros(256, np.uint8)
    for lo, hi in ((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)):
        out[lo : hi + 1] = np.arange(lo, hi + 1)
    out[0x41:0x5B] = np.arange(0x61, 0x7B)
    return out


CRC, BYTE = _crc_table(), _byte_table()
_FULL, _BLANK = np.uint32(0xFFFFFFFF), np.uint32(0x20)


def advance(registers: np.ndarray, low: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC registers after each has read ``lengths`` bytes of ``low`` from its start on."""
    longest_first = np.argsort(np.iinfo(np.uint8).max - np.minimum(lengths, 255).astype(np.uint8), kind="stable")
    r, at, left = registers[longest_first], starts[longest_first], lengths[longest_first]
    reading = len(r) - np.cumsum(np.bincount(np.minimum(left, LONG), minlength=LONG + 1))
    for j in range(LONG):
        n = int(reading[j])  # words longer than j
        if not n:
            break
        r[:n] = CRC[(r[:n] ^ low[at[:n] + j]) & 0xFF] ^ (r[:n] >> np.uint32(8))
    for i in np.flatnonzero(left > LONG).tolist():
        r[i] = zlib.crc32(low[at[i] + LONG : at[i] + left[i]], int(r[i] ^ _FULL)) ^ 0xFFFFFFFF
    out = np.empty_like(r)
    out[longest_first] = r
    return out


def _blocks(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of bytes that end between words or texts."""
    a, size = 0, len(data)
    while a < size:
        b = min(a + BLOCK, size)
        if b < size:
            cut = np.flatnonzero(BYTE[data[a:b]] == 0)
            if len(cut):
                b = a + int(cut[-1]) + 1
            else:  # one word, or texts without a blank: on to the next end
                end = int(bounds[np.searchsorted(bounds, b, "left")])
                while b < end and BYTE[data[b : b + BLOCK]].all():
                    b = min(end, b + BLOCK)
                b = min(end, b + int(np.argmin(BYTE[data[b:end]] != 0))) if b < end else end
        yield a, b
        a = b


def features(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For blocks of a batch: the texts of the words, the texts of the features, and the features' buckets."""
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    whole = texts.buffers()[2]
    data = np.frombuffer(whole, np.uint8)[offsets[0] : offsets[-1]] if whole is not None and len(texts) else np.empty(0, np.uint8)
    bounds = offsets - offsets[0]
    last_text, last_register = -1, _FULL
    for a, b in _blocks(data, bounds):
        low = BYTE[data[a:b]]
        word = np.zeros(b - a + 2, bool)
        word[1:-1] = low != 0
        fresh = np.zeros(b - a + 1, bool)  # a text starts here
        inner = bounds[np.searchsorted(bounds, a, "left") : np.searchsorted(bounds, b, "right")] - a
        fresh[inner] = True
        starts = np.flatnonzero(word[1:-1] & (~word[:-2] | fresh[:-1]))
        ends = np.flatnonzero(word[1:-1] & (~word[2:] | fresh[1:])) + 1
        if not len(starts):
            continue
        text = np.searchsorted(bounds, starts + a, "right") - 1
        lengths = ends - starts
        registers = advance(np.full(len(starts), _FULL), low, starts, lengths)
        before, before_text = np.concatenate([[last_register], registers[:-1]]).astype(np.uint32), np.concatenate([[last_text], text[:-1]])
        pair = before_text == text
        joined = CRC[(before[pair] ^ _BLANK) & 0xFF] ^ (before[pair] >> np.uint32(8))
        pairs = advance(joined, low, starts[pair], lengths[pair])
        yield text, np.concatenate([text, text[pair]]), ((np.concatenate([registers, pairs]) ^ _FULL) % np.uint32(BUCKETS)).astype(np.int64)
        last_text, last_register = text[-1], registers[-1]


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(bucket, n): the features of all texts, where there are any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for batch in common.lean(batches):
            for _, _, buckets in features(batch.column(0)):
                n += np.bincount(buckets, minlength=BUCKETS)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(n[some], pa.int64())], ["bucket", "n"])

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> np.ndarray:
    """Bucket -> floor(1000 ln((t + 1)(S + BUCKETS) / ((s + 1)(T + BUCKETS)))), from two tables of counts."""
    spark = corpus.sparkSession
    both = corpus.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    both = both.unionByName(spark.range(BUCKETS).select(F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t")))
    held = common.stored(both.groupBy("bucket").agg(F.sum("s").cast("double").alias("s"), F.sum("t").cast("double").alias("t")), "gains")
    whole = held.agg(F.sum("s").alias("S"), F.sum("t").alias("T")).first()
    ratio = (F.col("t") + 1) * F.lit(whole.S + BUCKETS) / ((F.col("s") + 1) * F.lit(whole.T + BUCKETS))
    out = np.zeros(BUCKETS, np.int64)
    for row in held.select("bucket", F.floor(1000 * F.log(ratio)).alias("gain")).collect():  # BUCKETS rows
        out[row.bucket] = row.gain
    common.release(held)
    return out


def noise(doc_id: Column) -> Column:
    """Gumbel noise in thousandths, from the id alone."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weighed(docs: DataFrame, table: np.ndarray) -> DataFrame:
    """Adds n_words, n_features, weight and score to documents."""
    sent = docs.sparkSession.sparkContext.broadcast(table.tobytes())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        gain = np.frombuffer(sent.value, np.int64)
        for texts in common.lean(batches):
            words, n, total = (np.zeros(len(texts), np.int64) for _ in range(3))
            for of_words, of_features, buckets in features(texts):
                words += np.bincount(of_words, minlength=len(texts))
                n += np.bincount(of_features, minlength=len(texts))
                total += np.bincount(of_features, gain[buckets], len(texts)).astype(np.int64)  # whole numbers: exact below 2^53
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (words, n, weight)], ["n_words", "n_features", "weight"])

    facts = F.arrow_udf(run, "struct<n_words: long, n_features: long, weight: long>")(F.col("text"))
    rows = docs.withColumn("_facts", facts)
    rows = rows.withColumns({c: F.col(f"_facts.{c}") for c in ("n_words", "n_features", "weight")}).drop("_facts")
    return rows.withColumn("score", F.col("weight") + noise(F.col("doc_id")))


def ranked(rows: DataFrame, drawn: int) -> DataFrame:
    """Adds rank (1, 2, 3 ...) by score, largest first, then by doc_id; null past ``drawn``.

    Rows are numbered within ranges; equal rows are told apart by where they stand in
    the stored table, so that a range never holds more than its share of them.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_copy")]
    placed = rows.withColumn("_copy", F.monotonically_increasing_id()).repartitionByRange(n, *order).sortWithinPartitions(*order).drop("_copy")
    at = F.monotonically_increasing_id()  # the number of the partition and, in 33 bits, of the row in it
    numbered = common.stored(placed.withColumn("_at", at).withColumns({"_range": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))}), "ranked")
    sizes = numbered.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    earlier = F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))  # a row for each partition
    before = sizes.select("_range", F.coalesce(earlier, F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_at") + 1
    return numbered.join(F.broadcast(before), "_range").withColumn("rank", F.when(rank <= drawn, rank)).drop("_range", "_at", "_before")


def resampled(docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank of those drawn: ``share`` in a hundred of those with ``min_words`` words."""
    table = gains(counts(docs), counts(target))
    rows = weighed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), table).drop("text")
    held = common.stored(rows, "weighed")
    able = held.where(F.col("n_words") >= min_words)
    out = ranked(able, share * able.count() // 100)
    rest = held.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return out.unionByName(rest).drop("n_words")


def sample(docs: DataFrame, target: DataFrame, share: int = SHARE, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents that are drawn, with all their columns; rows that tie with the last in score and id come with it."""
    last = resampled(docs, target, share, min_words).where("rank is not null").agg(F.max_by(F.struct("score", "doc_id"), "rank")).first()[0]
    if last is None:
        return docs.limit(0)
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = weighed(rows, gains(counts(docs), counts(target)))
    tied = F.lit(True) if last.doc_id is None else F.coalesce(F.col("doc_id") <= last.doc_id, F.lit(False))
    return scored.where((F.col("n_words") >= min_words) & ((F.col("score") > last.score) | ((F.col("score") == last.score) & tied))).select("row.*")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
