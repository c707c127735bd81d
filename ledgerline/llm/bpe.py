"""Operator 1: byte-pair encoding and decoding.

A pre-token's symbols form a doubly linked list; a priority queue holds the
possible merges by (rank, position). The best entry is taken, skipped when its
two symbols have changed since it was queued (stale), and otherwise merged,
which queues the pairs with the new neighbours: O(n log n) for n bytes, so a
word of a megabyte is fine. Words are remembered per worker in bounded memory.
Decoding concatenates vocabulary strings and reads the bytes as UTF-8.

A null text counts as empty and gives no ids. Rows are independent: repeated
rows, any id, null or not, and extra columns pass unchanged; an empty table
gives an empty table. A column that has the result's name stays too: the result
takes the next free name, with underscores appended.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common, words


class BytePairs:
    """The merges and vocabulary of a tokenizer file."""

    def __init__(self, path: str):
        self.split = words.Splitter(path)
        letters, model = words.byte_letters(), self.split.model["model"]
        vocab: dict[str, int] = model["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in s) for s, i in vocab.items()}
        self.bytes_of |= {i: s.encode() for s, i in self.split.special.items()}
        self.first = [0] * 256
        for letter, b in letters.items():
            self.first[b] = vocab[letter]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        #: left << 32 | right -> (rank, merged id)
        self.merges = {vocab[a] << 32 | vocab[b]: (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        self._encode = words.TextMap(self.split, lambda w: array("I", self.merge(w)).tobytes(), b"".join)

    def merge(self, word: str) -> list[int]:
        """The ids of one pre-token."""
        if word in self.split.special:
            return [self.split.special[word]]
        ids = [self.first[b] for b in word.encode()]
        n = len(ids)
        if n < 2:
            return ids
        get, push, pop = self.merges.get, heapq.heappush, heapq.heappop
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for i in range(n - 1):
            if found := get(ids[i] << 32 | ids[i + 1]):
                queue.append((found[0], i, ids[i], ids[i + 1], found[1]))
        heapq.heapify(queue)
        while queue:
            _, i, left, right, merged = pop(queue)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # stale: one of the two symbols is gone or has grown
            ids[i], ids[j] = merged, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := get(merged << 32 | ids[k]):
                    push(queue, (found[0], i, merged, ids[k], found[1]))
            h = before[i]
            if h >= 0 and (found := get(ids[h] << 32 | merged)):
                push(queue, (found[0], h, ids[h], merged, found[1]))
        return [i for i in ids if i >= 0]

    def encode(self, text: str | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        return self._encode(text or "")

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def pairs(path: str) -> BytePairs:
    return BytePairs(path)


def _free(docs: DataFrame, name: str) -> str:
    """``name``, or the first that the table doesn't have, as Spark compares names."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def encode(docs: DataFrame, text: str = "text", into: str = "ids", vocabulary: str | None = None) -> DataFrame:
    """Adds column ``into``, array<int>: the ids of each text."""
    into = _free(docs, into)
    path = vocabulary or words.default_vocabulary()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bp = pairs(path)
        for batch in common.lean(batches, "bpe", pairs.cache_clear):
            ids = [bp.encode(x.as_py()) for x in batch]
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int64) // 4
            yield pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(ids), np.int32)))

    return docs.withColumn(into, F.arrow_udf(run, "array<int>")(F.col(text)))


def decode(docs: DataFrame, ids: str = "ids", into: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """Adds column ``into``, string: the text of each list of ids; null counts as an empty list."""
    into = _free(docs, into)
    path = vocabulary or words.default_vocabulary()

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bp = pairs(path)
        for batch in common.lean(batches, "bpe", pairs.cache_clear):
            yield pa.array([bp.decode(array("I", x.as_py() or []).tobytes()) for x in batch], pa.string())

    return docs.withColumn(into, F.arrow_udf(run, "string")(F.col(ids)))


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trips(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Encodes each text, decodes the ids, and returns the digests of both."""
    path = vocabulary or words.default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bp, sha = pairs(path), hashlib.sha256
        for batch in common.lean(batches, "bpe", pairs.cache_clear):
            rows = []
            for text in batch.column(1):
                ids = bp.encode(text.as_py())
                rows.append((len(ids) // 4, sha(ids).hexdigest(), sha(bp.decode(ids).encode()).hexdigest()))
            n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.selectExpr("cast(doc_id as bigint) as doc_id", "text").mapInArrow(run, DIGESTS)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trips(common.table(spark, sf_dir, "documents"))
