"""Operator 6: embedding near-duplicates by lattice hashing.

In each of several tables a unit vector is projected to eight dimensions at
random and decoded to the nearest point of the E8 lattice, the densest packing
there. A vector is put into that cell and into its nearest neighbouring cells
among the 240 around it; vectors of a label that meet in a cell are compared by
cosine in double precision. Pairs below the limit never link; of those above,
more than 99 in 100 meet (the tests measure recall against brute force).

Equal vectors of a label are one node with a multiplicity, so copies aren't
compared with each other. Cells of one node are dropped before any vector is
moved. A cell of more than TILE nodes is cut into tiles of TILE nodes, each pair
of tiles a group of its own, so whatever meets in a cell is compared, however
crowded the cell is. A pair is counted only in the first cell in which it meets,
and a group returns sums per node and a spanning forest, never all pairs.

Vectors that are null, empty, zero, or hold null or non-finite components, and
rows with a null label, link with nothing. Vectors of different lengths never
link. Rows that repeat a vec_id count as vectors of their own; a null vec_id
never names a component that has another id. Extra columns don't matter; an
empty table gives an empty table.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common
from ledgerline.llm.components import components

LIMIT, TABLES, PROBES, SCALE, TILE, SEED = 0.98, 5, 4, 1.5, 2048, 8


@functools.cache
def neighbours() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(v) for v in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


def _even(y: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and where the sum is odd move the worst coordinate the other way."""
    near = np.rint(y)
    rest = y - near
    rows = np.flatnonzero(near.sum(axis=1) % 2)
    worst = np.abs(rest[rows]).argmax(axis=1)
    near[rows, worst] += np.where(rest[rows, worst] >= 0, 1.0, -1.0)
    return near


def nearest(y: np.ndarray) -> np.ndarray:
    """Nearest E8 points: E8 is the even-sum integers and their shift by one half."""
    whole, half = _even(y), _even(y - 0.5) + 0.5
    closer = ((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


@functools.lru_cache(maxsize=16)
def projection(table: int, length: int) -> np.ndarray:
    return np.random.default_rng([SEED, table, length]).normal(size=(length, 8)) * SCALE


_MIX = (2 * np.random.default_rng(SEED).integers(1, 1 << 62, size=(8,), dtype=np.uint64) + np.uint64(1)).astype(np.uint64)


def cells(units: np.ndarray, table: int) -> np.ndarray:
    """Of each unit vector the keys of its cell and of PROBES neighbouring cells, nearest first."""
    y = units @ projection(table, units.shape[1])
    point = nearest(y)
    order = np.argsort(-((y - point) @ neighbours().T), axis=1, kind="stable")[:, :PROBES]
    points = np.concatenate([point[:, None, :], point[:, None, :] + neighbours()[order]], axis=1)
    x = ((2 * points).astype(np.int64).view(np.uint64) * _MIX).sum(axis=2, dtype=np.uint64) + np.uint64(table)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def _units(column: pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x /= np.abs(x).max(axis=1)[:, None]  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1)[:, None]


def _by_length(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    sizes = pa.compute.list_value_length(batch.column(at)).to_numpy()
    for size in np.unique(sizes):
        yield batch.filter(pa.array(sizes == size))


def _nodes(vectors: DataFrame) -> DataFrame:
    """Rows with id, label, v (null if the vector can't link) and k, which equal vectors of a label share."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists(v, lambda x: x != 0)
    usable = F.col("label").isNotNull() & v.isNotNull() & ~bad
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), F.when(usable, v).alias("v"))
    return rows.withColumn("k", F.when(F.col("v").isNotNull(), F.md5(F.concat_ws("|", F.col("label"), F.xxhash64("v"), F.hash("v"), F.size("v")).cast("binary"))))


def _placed(nodes: DataFrame) -> DataFrame:
    """(node, cell, slot): the cells of each node; a cell's key covers label and length, slots count a node's cells table by table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _by_length(batch, 2):
                units = _units(part.column(2))
                found = np.concatenate([cells(units, t) for t in range(TABLES)], axis=1)
                ids = np.repeat(part.column(0).to_numpy(), found.shape[1])
                labels = np.repeat(part.column(1).to_numpy(), found.shape[1])
                slots = np.tile(np.arange(found.shape[1], dtype=np.int32), len(part))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found.reshape(-1) ^ labels), pa.array(slots)], ["node", "cell", "slot"])

    return nodes.select("node", "group", "v").mapInArrow(run, "node long, cell long, slot int")


def _places(placed: DataFrame) -> DataFrame:
    """Where nodes meet others, as (cell, n, node, slot): the cells of more than one node, whole."""
    counts = common.stored(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "cells")
    return common.keyed_join(placed, counts, "cell", "n", placed.count()).select("cell", "n", "node", "slot")


def _tiles(places: DataFrame) -> DataFrame:
    """Places cut into tiles: (tile, side, ...); side 0 compares with itself, 1 with 2."""
    cut = F.ceil(F.col("n") / TILE).cast("int")
    rows = places.withColumn("cuts", cut).withColumn("own", F.pmod(F.xxhash64("node", "cell"), "cuts").cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    tile = F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other"))
    return rows.select(tile.alias("tile"), side.alias("side"), "node", "cell", "slot")


class _Meetings:
    """Tells which pairs of a tile meet in no earlier cell than the tile's; the cells of nodes without links are never computed."""

    def __init__(self, units: np.ndarray, group: int, cell: int, table: int):
        self.units, self.group, self.cell, self.table = units, group, cell, table
        self.known = np.zeros(len(units), bool)
        self.cells = np.zeros((table + 1, len(units), PROBES + 1), np.int64)

    def first(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        new = np.unique(np.concatenate([i, j]))
        new = new[~self.known[new]]
        self.known[new] = True
        for t in range(self.table + 1) if len(new) else ():
            self.cells[t, new] = cells(self.units[new], t) ^ self.group
        out = np.ones(len(i), bool)
        for t in range(self.table + 1):
            for p, q in itertools.product(range(PROBES + 1), repeat=2):
                met = self.cells[t, i, p] == self.cells[t, j, q]
                out &= ~(met & ((self.cells[t, i, p] < self.cell) if t == self.table else True))
        return out


def _compared(rows: DataFrame, limit: float) -> DataFrame:
    """(node, other, n): per tile, the copies that a node links with (other null) and a forest of the links (n null)."""

    def found(table: pa.Table) -> pa.RecordBatch | None:
        side, node = table["side"].to_numpy(), table["node"].to_numpy()
        copies = table["copies"].to_numpy()
        units = _units(table["v"].combine_chunks())
        at = [table[c][0].as_py() for c in ("group", "cell", "slot")]
        meetings = _Meetings(units, at[0], at[1], at[2] // (PROBES + 1))
        left, right = (np.flatnonzero(side != 2), np.flatnonzero(side != 1))
        linked, root = np.zeros(len(node), np.int64), np.arange(len(node))
        for at in range(0, len(left), 512):
            a = left[at : at + 512]
            i, j = np.nonzero(units[a] @ units[right].T >= limit)
            i, j = a[i], right[j]
            use = (i < j) if not side.any() else (side[i] != side[j])
            i, j = i[use], j[use]
            if not len(i):
                continue
            first = meetings.first(i, j)
            i, j = i[first], j[first]
            np.add.at(linked, i, copies[j])
            np.add.at(linked, j, copies[i])
            while len(i):
                hi, lo = np.maximum(root[i], root[j]), np.minimum(root[i], root[j])
                apart = hi != lo
                i, j = i[apart], j[apart]
                np.minimum.at(root, hi[apart], lo[apart])
                while not np.array_equal(root, up := root[root]):
                    root = up
        some, child = np.flatnonzero(linked), np.flatnonzero(root != np.arange(len(node)))
        if not len(some):
            return None
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([node[some], node[child]])),
                pa.array(np.concatenate([np.zeros(len(some), np.int64), node[root[child]]]), mask=np.arange(len(some) + len(child)) < len(some)),
                pa.array(np.concatenate([linked[some], np.zeros(len(child), np.int64)])),
            ],
            ["node", "other", "n"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def closed() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            tiles = table["tile"].to_numpy()
            cuts = [0, *(np.flatnonzero(tiles[1:] != tiles[:-1]) + 1).tolist(), len(tiles)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if (out := found(table.slice(a, b - a))) is not None:
                    yield out

        for batch in batches:  # sorted by tile; the last tile of a batch may go on
            tiles = batch.column(0).to_numpy()
            if not len(tiles):
                continue
            cut = int(np.searchsorted(tiles, tiles[-1]))
            if cut or (held and held[-1].column(0)[-1].as_py() != tiles[0]):
                held.append(batch.slice(0, cut))
                yield from closed()
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from closed()

    sorted_rows = common.spread(rows.select("tile", "side", "node", "cell", "slot", "copies", "group", "v"), "tile").sortWithinPartitions("tile")
    return sorted_rows.mapInArrow(run, "node long, other long, n long")


def near_duplicates(vectors: DataFrame, limit: float = LIMIT) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = common.stored(_nodes(vectors), "vectors")
    total = rows.count()
    nodes = rows.where("v is not null").groupBy("k").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("v").alias("v"))
    nodes = common.stored(nodes.withColumn("node", F.xxhash64("k")), "nodes")
    facts = nodes.select("node", "copies", F.xxhash64("label", F.size("v")).alias("group"), "v")
    places = _places(common.stored(_placed(facts), "placed"))
    found = common.stored(_compared(_tiles(places).join(facts, "node"), limit), "found")
    linked = found.where("other is null").groupBy("node").agg(F.sum("n").alias("linked"))
    parts = common.stored(components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))), "parts")
    own = nodes.join(linked, "node", "left").join(parts, "node", "left")
    own = common.stored(own.select("k", "least", "copies", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("root", "node").alias("root")), "own")
    named = common.stored(own.groupBy("root").agg(F.min("least").alias("component_id"), F.count(F.lit(1)).alias("m")), "named")
    answers = common.keyed_join(own, named, "root", "m", total).select("k", "copies", (F.col("linked") + F.col("copies") - 1).alias("n_links"), "component_id")
    out = common.keyed_join(rows.where("k is not null").select("vec_id", "k"), answers, "k", "copies", total)
    alone = rows.where("k is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = out.select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op6_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "embeddings"))
