"""Operator 2: toxicity by FTRL-proximal logistic regression over hashed word n-grams.

Features of a text are the hashes of its words and of their stems (the first
four, five and six letters, which stand for inflected forms), of pairs of
neighbouring words and of skip-grams (two words with one between), each counted
once. Training follows
McMahan et al. (2013): a learning rate for every coordinate and L1 sparsity, so
most weights are exactly zero and the model that goes to the tasks is compact;
2**BITS weights bound it at any input size.

The classifier is fitted on at most ``max_train`` labelled documents of the table,
those with the smallest hashes of their ids; scoring covers every row and whole text.
Only texts are inputs of a score. Null texts count as empty and get the bias
alone. Null labels are ignored; of repeated labels of an id the largest counts,
and of rows that repeat a labelled id one text is learned (the smallest hash), so
the one task that fits holds ``max_train`` rows of at most 2**BITS features each,
whatever the tables repeat. Without labels of both kinds the score is the share of
label 1 (0 without any). A very long text has no more than 2**BITS features.
Repeated rows and null ids are scored like others; extra columns don't matter; an
empty table gives an empty table.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common, words

BITS, MAX_TRAIN, EPOCHS = 20, 10_000, 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 8.0, 1.0
_WORD = re.compile(r"\w+")
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


_STEMS = (4, 5, 6)


class _Hashes:
    """Word -> number of its row of hashes (of the word and its stems), in bounded memory."""

    def __init__(self, limit: int = 300_000):
        self.rows, self.used = np.zeros((limit, 1 + len(_STEMS)), np.uint64), 0
        self.known = words.WordMemory(self._add, limit, longest=1 << 30)

    def _add(self, word: str) -> int:
        # a stem that is the word itself or shorter counts as the word
        self.rows[self.used] = [xxhash.xxh3_64_intdigest(word), *(xxhash.xxh3_64_intdigest(word[:n], seed=n * (len(word) > n)) for n in _STEMS)]
        self.used += 1
        return self.used - 1

    def of(self, found: list[str]) -> np.ndarray:
        parts, step = [], len(self.rows) // 2
        for i in range(0, len(found), step):
            part = found[i : i + step]
            if self.used + len(part) > len(self.rows):
                self.known.clear()
                self.used = 0
            parts.append(self.rows[np.fromiter(map(self.known.__getitem__, part), np.int64, len(part))])
        return np.concatenate(parts) if parts else self.rows[:0]


@functools.cache
def _hashes() -> _Hashes:
    return _Hashes()


def features(text: str | None) -> np.ndarray:
    """Hashed features, repeats included."""
    rows = _hashes().of(_WORD.findall((text or "").lower()))
    h, stems = np.ascontiguousarray(rows[:, 0]), rows[:, 1:].reshape(-1)
    a, b, c, d, e = _ODD
    grams = np.concatenate([h * a, stems * a, h[:-1] * b ^ h[1:] * c, h[:-2] * d ^ h[2:] * e])
    return ((grams ^ (grams >> np.uint64(29))) * a >> np.uint64(64 - BITS)).astype(np.int32)


class Ftrl:
    """FTRL-proximal for presence features; the bias is a coordinate of its own without L1."""

    def __init__(self):
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        self.zb = self.nb = 0.0

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return -np.sign(z) * np.maximum(np.abs(z) - L1, 0) / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def bias(self) -> float:
        return -self.zb / ((BETA + self.nb**0.5) / ALPHA)

    def learn(self, at: np.ndarray, label: int) -> None:
        w, b = self.weights(at), self.bias()
        g = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35))) - label
        n = self.n[at]
        more = n + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(n)) / ALPHA * w
        self.n[at] = more
        self.zb += g - ((self.nb + g * g) ** 0.5 - self.nb**0.5) / ALPHA * b
        self.nb += g * g


def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic) rows in, the one row of the model out."""
    rows = [(np.unique(features(x.as_py())), y.as_py()) for batch in batches for x, y in zip(batch.column(0), batch.column(1), strict=True)]
    ones = sum(y for _, y in rows)
    model = Ftrl()
    if 0 < ones < len(rows):
        for _ in range(EPOCHS):
            for at, label in rows:
                model.learn(at, label)
        bias = model.bias()
    else:
        bias = 35.0 if rows and ones else -35.0
    weights = model.weights(slice(None)).astype(np.float32)
    at = np.flatnonzero(weights).astype(np.int32)
    del rows, model
    _hashes.cache_clear()
    common.give_back()
    yield pa.RecordBatch.from_arrays([pa.array([at.tobytes()]), pa.array([weights[at].tobytes()]), pa.array([float(bias)])], ["at", "weights", "bias"])


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[bytes, bytes, float]:
    """Fits on labelled documents outside the held-out fold."""
    mark = F.xxhash64("doc_id")
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (common.fold("doc_id", 5) != 0))
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # labels of other tables' documents mustn't use up the sample
    here = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    known = common.stored(known.join(here, "doc_id", "left_semi"), "labels")
    share = min(1.0, 2 * max_train / max(1, known.count()))
    chosen = known.where(F.pmod(mark, F.lit(1_000_003)) <= share * 1_000_003).orderBy(mark, "doc_id").limit(max_train)
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    sample = sample.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("doc_id", "toxic", "t.text")
    model = sample.repartition(1).sortWithinPartitions(mark, "doc_id", "text").select("text", "toxic").mapInArrow(fit, "at binary, weights binary, bias double").first()
    return (bytes(model["at"]), bytes(model["weights"]), model["bias"]) if model else (b"", b"", -35.0)


def score(docs: DataFrame, model: tuple[bytes, bytes, float], into: str = "score") -> DataFrame:
    """Adds the score of each text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        at, weights, bias = sent.value
        table = np.zeros(1 << BITS, np.float32)
        table[np.frombuffer(at, np.int32)] = np.frombuffer(weights, np.float32)
        for batch in common.lean(batches):
            out = []
            for text in batch:
                found = features(text.as_py())
                found = np.unique(found[table[found] != 0])
                out.append(1 / (1 + np.exp(-np.clip(table[found].sum(dtype=np.float64) + bias, -35, 35))))
            yield pa.array(out, pa.float64())
        _hashes.cache_clear()  # the worker is reused, and the next task warms up in a second

    return docs.withColumn(into, F.arrow_udf(run, "double")(F.col("text")))


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), train(docs, labels))
    return scored.select("doc_id", (common.fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame, limit: float = 0.5) -> DataFrame:
    """The documents that score under ``limit``, with their columns."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text"))
    kept = score(rows, train(docs, labels), "_score").where(F.col("_score") < limit)
    return kept.select("row.*")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
