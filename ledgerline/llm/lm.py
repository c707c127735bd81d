"""Operator 5: language-model scores by a weighted backoff automaton.

Smoothed n-grams become an automaton: a state for each seen history, an arc for
each n-gram seen after it, and a failure arc to the empty history that costs
the state's backoff weight. One left-to-right traversal carries the state and
accumulates log10 probabilities. Words have absolute discounting, whose mass
goes to the unknown word; bigrams are Dirichlet-smoothed towards words:

    p(w) = (c(w) - D) / N      p(unknown) = D V / N      p(w | h) = (c(h w) + MU p(w)) / (c(h) + MU)

Counts of a large corpus fit no single machine, so none holds them. Documents
are handled in blocks of about a million tokens. A block sends each n-gram it has
once, with its training count, to the bucket of the n-gram's hash; a bucket sums
the counts of all blocks and answers each block with the totals of its
n-grams, from which the block compiles its part of the automaton and scores its
documents. What is shuffled grows with the distinct n-grams of the blocks, a
frequent n-gram costs one entry a block, and all steps are keyed by hashes or
blocks, so there are no hot keys. There are as many buckets as keep one at about
BUCKET_MB, whatever the size of the corpus: a worker holds one bucket or one block
at a time. Hashes of n-grams have 56 bits: of V distinct n-grams V * V / 2**57 pairs
share a hash (7 of a billion n-grams), and such n-grams share their counts.

A null text counts as empty: one end token. Null ids count as the empty text
for the fold. Repeated rows are scored alike; extra columns don't matter; an
empty table gives an empty table. Without training tokens every token has
probability 1 under the model (the unknown word is all there is).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common

MU, BLOCK_TOKENS = 1000.0, 1_000_000
#: Aim for the compressed n-grams of one bucket and order; packed n-grams take about GRAMS times the bytes of their text.
BUCKET_MB, GRAMS = 32, 1.3
KEY_BITS = np.uint64(56)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD))
END = b" "  # no word holds a blank


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words and the end."""
    return [*(text or "").encode().lower().split(), END]


def word_keys(h: np.ndarray) -> np.ndarray:
    return h >> (np.uint64(64) - KEY_BITS)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    x = (first * _MIX[0]) ^ (second + _MIX[1])
    return ((x ^ (x >> np.uint64(31))) * _MIX[1]) >> (np.uint64(64) - KEY_BITS)


def _planes(a: np.ndarray) -> bytes:
    """Byte planes, compressed."""
    a = np.ascontiguousarray(a)
    return zstandard.compress(np.ascontiguousarray(a.view(np.uint8).reshape(-1, a.itemsize).T).tobytes(), 1)


def _array(blob: bytes, kind: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).reshape(-1).view(kind)


def pairs_of(codes: np.ndarray, starts: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct neighbouring pairs in order of first appearance: places of second tokens, their pair's number, and the pairs."""
    inner = np.ones(len(codes), bool)
    inner[starts] = False
    at = np.flatnonzero(inner)
    joint = codes[at - 1].astype(np.uint64) * np.uint64(n_words) + codes[at]
    number, distinct = pd.factorize(joint)
    return at, number, distinct


BLOCKS = "block long, n int, grams int, bucket int, keys binary, counts binary, ids binary, id_nulls binary, held binary, lengths binary, codes binary, hashes binary"


def blocks(docs: DataFrame, buckets: int, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Cuts (doc_id, text, held_out) into blocks: a row with each block's documents, and rows with its n-grams by bucket."""
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 8]

    def row(**given) -> list:
        return [given.get(n) for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids, held, hashes, size = [], [], [], 0

        def block() -> Iterator[pa.RecordBatch]:
            name = part << 32 | seq
            lengths = np.fromiter(map(len, hashes), np.int64, len(hashes))
            flat = np.concatenate(hashes)
            hashes.clear()
            codes, distinct = pd.factorize(flat)
            del flat
            codes, starts = codes.astype(np.uint32), np.cumsum(lengths) - lengths
            train = np.repeat(~np.array(held, bool), lengths)
            nulls = np.array([x is None for x in ids], bool)
            yield sent([row(block=name, n=0, ids=_planes(np.array([x or 0 for x in ids], np.int64)), id_nulls=_planes(nulls), held=_planes(np.array(held, bool)), lengths=_planes(lengths), codes=_planes(codes), hashes=distinct.tobytes())])
            yield sent(grams(name, 1, word_keys(distinct), np.bincount(codes[train], minlength=len(distinct))))
            at, number, pairs = pairs_of(codes, starts, len(distinct))
            counts = np.bincount(number[train[at]], minlength=len(pairs))
            del codes, train, at, number
            if len(pairs):
                first, second = np.divmod(pairs, np.uint64(len(distinct)))
                keys = pair_keys(distinct[first], distinct[second])
                del pairs, first, second, distinct
                yield sent(grams(name, 2, keys, counts))

        def grams(name: int, n: int, keys: np.ndarray, counts: np.ndarray) -> list:
            """A row with each bucket's n-grams."""
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order].astype(np.uint32)
            edges = [(b << int(KEY_BITS)) // buckets for b in range(1, buckets)]
            cuts = [0, *np.searchsorted(keys, np.array(edges, np.uint64)).tolist(), len(keys)]
            return [
                row(block=name, n=n, grams=j - i, bucket=b, keys=_planes(np.diff(keys[i:j], prepend=np.uint64(0))), counts=_planes(counts[i:j]))
                for b, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False))
                if j > i
            ]

        def sent(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in common.lean(batches, "lm"):
            for i in range(batch.num_rows):
                found = tokens(batch.column(1)[i].as_py())
                ids.append(batch.column(0)[i].as_py())
                held.append(batch.column(2)[i].as_py())
                hashes.append(np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)))
                size += len(found)
                if size >= block_tokens:
                    yield from block()
                    common.give_back()
                    ids, held, hashes, size, seq = [], [], [], 0, seq + 1
        if ids:
            yield from block()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "held_out").mapInArrow(run, BLOCKS)


TOTALS = "n int, bucket int, block long, totals binary, kinds long, tokens long, once long, twice long"


def totals(grams: DataFrame) -> DataFrame:
    """Sums the training counts of each bucket's n-grams: an answer for each block, and one row of statistics (block null)."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [np.cumsum(_array(r["keys"], "<u8"), dtype=np.uint64) for r in rows]
        number, distinct = pd.factorize(np.concatenate(keys))
        # counts below 2**53 are exact in bincount's doubles
        sums = np.bincount(number, np.concatenate([_array(r["counts"], "<u4") for r in rows]), len(distinct)).astype(np.int64)
        ends = np.cumsum([len(k) for k in keys])
        out = [(key[0].as_py(), key[1].as_py(), r["block"], _planes(sums[number[e - len(k) : e]]), None, None, None, None) for r, k, e in zip(rows, keys, ends, strict=True)]
        out.append((key[0].as_py(), key[1].as_py(), None, None, int((sums > 0).sum()), int(sums.sum()), int((sums == 1).sum()), int((sums == 2).sum())))
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
        del rows, keys, number, distinct, sums
        common.give_back()
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], [c.split()[0] for c in TOTALS.split(", ")])

    return grams.groupBy("n", "bucket").applyInArrow(run, TOTALS)


class Automaton:
    """States 0 (empty history) and 1 + word for each word with training count; log10 weights."""

    def __init__(self, seen: np.ndarray, pairs: np.ndarray, pair_seen: np.ndarray, n_train: int, discount: float, kinds: int, mu: float = MU):
        self.n_words = len(seen)
        n = max(n_train, 1)
        p = np.where(seen > 0, seen - discount, discount * kinds) / n if n_train else np.ones(len(seen))
        self.root = np.log10(p)
        self.after = np.where(seen > 0, np.arange(len(seen)) + 1, 0)  # the state that a word leads to
        self.fail = np.concatenate([[0.0], np.log10(mu / (seen + mu))])
        use = pair_seen > 0
        h, w = np.divmod(pairs[use], np.uint64(len(seen)))
        h, w = h.astype(np.int64), w.astype(np.int64)
        arcs = (h + 1) * len(seen) + w
        order = np.argsort(arcs)
        self.arcs = arcs[order]
        self.weights = np.log10((pair_seen[use] + mu * p[w]) / (seen[h] + mu))[order]

    def traverse(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each text's log10 probability; all texts of a block step together, the longest first."""
        order = np.argsort(-lengths, kind="stable")
        begin, left = starts[order], lengths[order]
        state, total = np.zeros(len(order), np.int64), np.zeros(len(order))
        running = len(order)
        for step in range(int(left[0]) if len(left) else 0):
            while left[running - 1] <= step:
                running -= 1
            w, s = codes[begin[:running] + step].astype(np.int64), state[:running]
            want = s * self.n_words + w
            at = np.minimum(np.searchsorted(self.arcs, want), max(0, len(self.arcs) - 1))
            hit = self.arcs[at] == want if len(self.arcs) else np.zeros(running, bool)
            total[:running] += np.where(hit, self.weights[at] if len(self.arcs) else 0.0, self.fail[s] + self.root[w])
            state[:running] = self.after[w]
        out = np.empty(len(order))
        out[order] = total
        return out


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def scored(documents: DataFrame, answers: DataFrame, stats: dict[str, float], mu: float = MU) -> DataFrame:
    n_train, kinds, discount = int(stats["tokens"]), int(stats["kinds"]), stats["discount"]

    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        found: dict[int, list] = {1: [], 2: []}
        for r in sorted(answers.to_pylist(), key=lambda r: r["bucket"]):
            found[r["n"]].append(_array(r["totals"], "<i8"))
        out = []
        for r in docs.to_pylist():
            hashes, codes, lengths = np.frombuffer(r["hashes"], np.uint64), _array(r["codes"], "<u4"), _array(r["lengths"], "<i8")
            starts = np.cumsum(lengths) - lengths
            _, _, pairs = pairs_of(codes, starts, len(hashes))
            first, second = np.divmod(pairs, np.uint64(len(hashes)))
            seen = _aligned(word_keys(hashes), found[1])
            machine = Automaton(seen, pairs, _aligned(pair_keys(hashes[first], hashes[second]), found[2]), n_train, discount, kinds, mu)
            base = np.log10((seen + 1) / (n_train + kinds + 1))
            rows = [
                pa.array(_array(r["ids"], "<i8"), pa.int64(), mask=_array(r["id_nulls"], "?")),
                pa.array(_array(r["held"], "?")),
                pa.array(lengths),
                pa.array(np.add.reduceat((seen > 0).astype(np.int64)[codes], starts)),
                pa.array(np.full(len(lengths), n_train)),
                pa.array(np.add.reduceat(base[codes], starts)),
                pa.array(machine.traverse(codes, starts, lengths)),
            ]
            out.append(pa.Table.from_arrays(rows, [c.split()[0] for c in SCORES.split(", ")]))
        return pa.concat_tables(out) if out else _NONE

    return documents.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, SCORES)


_NONE = pa.table({"doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()), "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()), "train_tokens": pa.array([], pa.int64()), "base_score": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})


def _aligned(keys: np.ndarray, totals: list[np.ndarray]) -> np.ndarray:
    """The totals come in ascending order of keys, ties in order of appearance."""
    out = np.empty(len(keys), np.int64)
    out[np.argsort(keys, kind="stable")] = np.concatenate(totals) if totals else 0
    return out


def score(docs: DataFrame, mu: float = MU, buckets: int | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Learns from the rows of (doc_id, text, held_out) that aren't held out and scores all."""
    spark = docs.sparkSession
    if not buckets:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        # both orders share the bytes; at least a bucket for each task that could run
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size * GRAMS / 2 / (BUCKET_MB << 20)) + 1)
    cut = common.stored(blocks(docs, buckets, block_tokens), "lm_blocks", by="n")
    sums = common.stored(totals(cut.where("n > 0").select("n", "bucket", "block", "keys", "counts")), "lm_totals")
    for n in (1, 2):
        common.release(cut, part=f"n={n}")  # the n-grams are summed; the documents stay
    stats = sums.where("n = 1 and block is null").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "kinds", "once", "twice")]).first().asDict()
    stats["discount"] = stats["once"] / (stats["once"] + 2 * stats["twice"]) if stats["once"] else 0.5
    answers = sums.where("block is not null").select("block", "n", "bucket", "totals")
    own = cut.where("n = 0")
    if not docs.isEmpty():  # read again without the deleted files
        own = spark.read.schema(cut.drop("n").schema).parquet(f"{cut._stored_at}/n=0")
    own = own.select("block", "ids", "id_nulls", "held", "lengths", "codes", "hashes")
    return scored(own, answers, stats, mu)


def op5_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    return score(docs.select("doc_id", "text", (common.fold("doc_id", 7) == 2).alias("held_out")))
