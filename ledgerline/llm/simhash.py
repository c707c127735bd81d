"""Operator 4: SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints within ``radius`` bits agree on at least one of ``radius + 1``
segments, so the top nodes of the index are masked bit patterns: a segment and
its value. Each node's fingerprints, rotated so that its segment leads, are
sorted by Gray rank, where neighbours share long prefixes. Runs of them form
lower nodes that hold the bits common to all their members (mask and value).
A search descends pairs of nodes: the bits in which two masked patterns differ
are a lower bound, and a pair over the radius is pruned with all its members.
The search is exact.

Node sizes: a top node with more than NODE fingerprints (a large group of near
copies) is split again by segments of its other bits. Near copies that agree in
such a segment too meet again; a node that is still too large is cut into tiles
of NODE fingerprints, and each pair of tiles is a node of its own. So a node
holds about 2 * NODE fingerprints at most, whatever the copies. Gray order holds within a node; the segment split above it
takes the place of one global order. Equal fingerprints are collapsed before, and a task returns a spanning
forest of the links it finds, at most one link per fingerprint, not all pairs.

Texts: A-Z lower-cased, words are runs of other than blanks, 4-word shingles
with repeats, XXH64 with seed 42; a bit is set if set in over half the hashes.
Fewer words make one shingle; no words (null, empty) give fingerprint zero,
linked like any other. Components carry the smallest doc_id; null ids take part
in links, carry no label of their own, and a component of null ids has label
null. Rows that repeat a doc_id are kept and get the same answer per text.
Extra columns don't matter; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common
from ledgerline.llm.components import components

SHINGLE, SEED, RADIUS, NODE, FANOUT = 4, 42, 4, 4096, 16


def fingerprint(text: str | None) -> int:
    """The unsigned 64-bit SimHash of a text."""
    words = (text or "").encode().lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    line, n = b" ".join(words), max(1, len(words) - SHINGLE + 1)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    starts = ends - sizes + 1
    last = min(SHINGLE, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    step = 1 << 16
    for at in range(0, n, step):
        m = min(step, n - at)
        spans = zip(starts[at : at + m].tolist(), ends[at + last : at + last + m].tolist(), strict=True)
        h = np.fromiter((digest(line[a:b], SEED) for a, b in spans), np.uint64, m)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): fp holds the fingerprint's bits as a signed long; a column ``digest`` is kept."""
    kept = ["digest"] if "digest" in docs.columns else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.lean(batches):
            fps = np.array([fingerprint(x.as_py()) for x in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), *batch.columns[2:]], ["doc_id", "fp", *kept])

    schema = "doc_id long, fp long" + (", digest binary" if kept else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *kept).mapInArrow(run, schema)


def _rotated(fps: np.ndarray, by: int) -> np.ndarray:
    return fps if by == 0 else (fps << np.uint64(by)) | (fps >> np.uint64(64 - by))


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """The place of each code in Gray order: the binary number whose Gray code it is."""
    out = fps.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


class GrayIndex:
    """Nodes over fingerprints in Gray order; level 0 is the sorted fingerprints."""

    def __init__(self, fps: np.ndarray):
        self.fps = fps[np.argsort(gray_rank(fps), kind="stable")]
        self.root = np.arange(len(fps))
        self.levels = [(self.fps, ~np.zeros_like(self.fps))]
        all_ones, any_ones = self.fps, self.fps
        while len(all_ones) > 1:
            cuts = np.arange(0, len(all_ones), FANOUT)
            all_ones, any_ones = np.bitwise_and.reduceat(all_ones, cuts), np.bitwise_or.reduceat(any_ones, cuts)
            self.levels.append((all_ones, ~(all_ones ^ any_ones)))  # value and mask of the common bits

    def _join(self, i: np.ndarray, j: np.ndarray) -> None:
        """Union of the trees of linked members, smallest place as root."""
        while len(i):
            a, b = self.root[i], self.root[j]
            hi, lo = np.maximum(a, b), np.minimum(a, b)
            apart = hi != lo
            if not apart.any():
                return
            i, j, hi, lo = i[apart], j[apart], hi[apart], lo[apart]
            np.minimum.at(self.root, hi, lo)
            while not np.array_equal(self.root, up := self.root[self.root]):
                self.root = up

    def link(self, radius: int, budget: int = 1 << 16) -> None:
        """Joins all members within the radius; pairs of nodes go depth first in bounded pieces."""
        top = len(self.levels) - 1
        work = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))] if len(self.fps) > 1 else []
        while work:
            level, i, j = work.pop()
            if len(i) > budget:
                work += [(level, i[:budget], j[:budget]), (level, i[budget:], j[budget:])]
                continue
            value, mask = self.levels[level]
            near = np.bitwise_count((value[i] ^ value[j]) & mask[i] & mask[j]) <= radius
            i, j = i[near], j[near]
            if level == 0:
                self._join(i, j)
                continue
            if level == 1 and len(i):
                # a pair of nodes whose members are all in one tree has nothing to add
                cuts = np.arange(0, len(self.root), FANOUT)
                low, high = np.minimum.reduceat(self.root, cuts), np.maximum.reduceat(self.root, cuts)
                open_ = ~((low[i] == high[i]) & (low[j] == high[j]) & (low[i] == low[j]))
                i, j = i[open_], j[open_]
            if not len(i):
                continue
            below = len(self.levels[level - 1][0])
            step = max(1, budget // (FANOUT * FANOUT))
            for at in range(0, len(i), step):
                a = (i[at : at + step, None, None] * FANOUT + np.arange(FANOUT)[:, None]) + np.zeros((FANOUT, FANOUT), np.int64)
                b = (j[at : at + step, None, None] * FANOUT + np.arange(FANOUT)[None, :]) + np.zeros((FANOUT, FANOUT), np.int64)
                a, b = a.reshape(-1), b.reshape(-1)
                use = (a < below) & (b < below) & ((a < b) if level == 1 else (a <= b))
                work.append((level - 1, a[use], b[use]))


def _segments(bits: int, parts: int) -> list[tuple[int, int]]:
    """(start, length) of ``parts`` segments of nearly equal length."""
    cuts = [bits * k // parts for k in range(parts + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _top(fp: str, rotation: str, start: int, length: int) -> str:
    """SQL: the bits of a segment of the rotated fingerprint."""
    turned = f"(shiftleft({fp}, {rotation}) | CASE WHEN {rotation} = 0 THEN 0L ELSE shiftrightunsigned({fp}, 64 - {rotation}) END)"
    return f"(shiftrightunsigned({turned}, {64 - start - length}) & {(1 << length) - 1}L)"


def _nodes(fps: DataFrame, radius: int, node: int) -> DataFrame:
    """(key, turn, fp): each fingerprint under the top nodes it belongs to; large nodes are split, and tiled if still large."""
    parts = _segments(64, radius + 1)
    options = ", ".join(f"struct({k} AS part, {a} AS turn, {_top('fp', str(a), 0, n)} AS bits)" for k, (a, n) in enumerate(parts))
    first = common.stored(fps.selectExpr("fp", f"inline(array({options}))"), "nodes")
    sizes = first.groupBy("part", "bits").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > node).select("part", "bits", "n")
    sizes = common.stored(sizes, "large_nodes")
    key = F.xxhash64("part", "bits", F.lit(-1), F.lit(0)).alias("key")
    if sizes.isEmpty():
        return first.select(key, "turn", "fp")
    # at most (radius + 1) * fingerprints / node large nodes; each is joined by its pattern
    small = first.join(sizes.select("part", "bits"), ["part", "bits"], "left_anti").select(key, "turn", "fp")
    large = first.join(sizes.select("part", "bits"), ["part", "bits"], "left_semi")
    length = max(n for _, n in parts)  # bits after the leading segment, whatever its length
    rest = _segments(64 - length, radius + 1)
    more = ", ".join(f"struct({k} AS sub, {_top('fp', 'turn', length + a, n)} AS sub_bits)" for k, (a, n) in enumerate(rest))
    split = large.selectExpr("part", "bits", "turn", "fp", f"inline(array({more}))")
    split = common.stored(split.select(F.xxhash64("part", "bits", "sub", "sub_bits").alias("key"), "turn", "fp"), "split_nodes")
    still = split.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > node)
    still = common.stored(still.withColumn("cuts", F.ceil(F.col("n") / node).cast("int")), "tiled_nodes")
    if still.isEmpty():
        return small.unionByName(split)
    # at most 25 * fingerprints / node of them; a fingerprint meets every other tile of its node
    rest = split.join(still.select("key"), "key", "left_anti")
    tiled = split.join(still.select("key", "cuts"), "key").withColumn("own", F.pmod(F.xxhash64("fp"), "cuts").cast("int"))
    tiled = tiled.withColumn("other", F.explode(F.filter(F.sequence(F.lit(0), F.col("cuts") - 1), lambda x: x != F.col("own"))))
    tiled = tiled.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "turn", "fp")
    return small.unionByName(rest).unionByName(tiled)


def links(fps: DataFrame, radius: int = RADIUS, node: int = NODE) -> DataFrame:
    """(a, b): a spanning forest of the links among the distinct fingerprints ``fps`` (column fp) of each index node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def found(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            keys, turns, fps = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            out_a, out_b = [], []
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                if b - a < 2:
                    continue
                index = GrayIndex(_rotated(fps[a:b].view(np.uint64), int(turns[a])))
                index.link(radius)
                child = np.flatnonzero(index.root != np.arange(b - a))
                if len(child):
                    back = (64 - int(turns[a])) % 64
                    out_a.append(_rotated(index.fps[child], back))
                    out_b.append(_rotated(index.fps[index.root[child]], back))
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (out_a, out_b)], ["a", "b"])

        for batch in batches:  # rows come sorted by key; the last key of a batch may go on in the next
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut or (held and held[-1].column(0)[-1].as_py() != keys[0]):
                yield from found(_together([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from found(_together(held))

    rows = common.spread(_nodes(fps, radius, node), "key").sortWithinPartitions("key")
    return rows.mapInArrow(run, "a long, b long")


def _together(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _pick() -> Column:
    """The order in which rows stand for their component: ids first, nulls last, then fingerprint and text."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), "fp", "digest")


def groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row per document: doc_id, fp (signed), component_id; of documents with a ``digest`` also that and ``best``, the row that stands for the component."""
    prints = common.stored(fingerprints(docs), "fingerprints")
    total = prints.count()
    chosen = "digest" in prints.columns
    pick = lambda c, name: [F.min(c).alias(name)] if chosen else []
    own = common.stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n"), *pick(_pick(), "pick")), "distinct_fp")
    found = common.stored(links(own.select("fp"), radius), "fp_links")
    linked = common.stored(components(found), "fp_components")
    common.release(found)
    # a fingerprint's label is the smallest id of its component's fingerprints
    rooted = own.join(linked, own.fp == linked.node, "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"), *(["pick"] if chosen else []))
    rooted = common.stored(rooted, "rooted")
    label = rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m"), *pick("pick", "best"))
    labelled = common.keyed_join(rooted.drop("pick"), common.stored(label, "labels"), "root", "m", total)
    more = ["best"] if chosen else []
    return common.keyed_join(prints, labelled.select("fp", "component_id", "n", *more), "fp", "n", total).select("doc_id", "fp", "component_id", *(["digest", *more] if chosen else []))


def fingerprint_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    return groups(docs, radius).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One document of each component, with all its columns: the smallest id (nulls last), of equal ids the smallest fingerprint, then text digest."""
    names = docs.columns
    clean = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_col, text_col = f"c{names.index('doc_id')}", f"c{names.index('text')}"
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256))
    out = groups(clean.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), digest.alias("digest")), radius)
    out = common.stored(out.select("doc_id", "fp", "digest", "best"), "chosen")
    drop = out.where(_pick() != F.col("best")).select(common.row_key("digest", "doc_id")).distinct()
    # rows that agree in id and text are one document; texts meet a hash table of their partition's keys and aren't sorted
    one = common.one_each(clean.withColumn("row_key", common.row_key(digest, F.col(id_col).cast("long"))), out.select(common.row_key("digest", "doc_id")))
    return one.join(drop.hint("shuffle_hash"), "row_key", "left_anti").drop("row_key").toDF(*names)


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_groups(common.table(spark, sf_dir, "documents"))
