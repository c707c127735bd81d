"""Helpers that the training-data operators share.

Scratch data goes to the folder named by ``spark.checkpoint.dir``, which driver
and executors share; without it nothing runs, unless Spark itself is local.
Everything written there is a committed Parquet table, so a lost executor costs
a re-read and no recomputation.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column | str) -> Column:
    """Lower-cases A-Z only; null counts as empty."""
    text = F.col(text) if isinstance(text, str) else text
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; a null id counts as the empty text."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: short lineage, one computation. by: a column to partition the files by."""
    path = scratch(df.sparkSession, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def release(*tables: DataFrame, part: str = "") -> None:
    """Deletes tables that ``stored`` wrote and that nothing reads any more, or a part of them (like n=1); others are left alone."""
    for df in tables:
        if path := getattr(df, "_stored_at", None):
            path = f"{path}/{part}" if part else path
            place = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partitions by ``keys`` into the session's number of shuffle partitions."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


_held: dict[str, Callable[[], None]] = {}


def lean(batches: Iterator, name: str = "", drop: Callable[[], None] | None = None) -> Iterator:
    """The batches of a task, with memory that is no longer used given back after each.

    A Python worker is reused: what it remembers for ``name`` (``drop`` forgets it)
    goes when it comes to work for another operator.
    """
    for other in [k for k in _held if k != name]:
        _held.pop(other)()
    if drop:
        _held[name] = drop
    for batch in batches:
        yield batch
        del batch
        give_back()


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own counsel
        pass


#: Keys that hold more than 1/HOT_PARTS of all rows are joined by broadcast; there are at most HOT_PARTS of them.
HOT_PARTS = 10_000


def hot_limit(total: int) -> int:
    """More rows than this make a key hot."""
    return max(1000, total // HOT_PARTS)


def keyed_join(rows: DataFrame, facts: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Joins each of ``rows`` with the one row of ``facts`` that has its key, for any skew.

    ``facts`` holds in ``size`` how many of the ``total`` rows share the key. Keys
    with more than ``max(1000, total / HOT_PARTS)`` rows number at most HOT_PARTS,
    so broadcasting them is bounded; the others are small and are joined by a shuffle.
    """
    limit = hot_limit(total)
    facts = facts.withColumnRenamed(key, "_key")
    hot = F.broadcast(facts.where(F.col(size) > limit))
    cold = facts.where(F.col(size) <= limit)
    same = F.col(key) == F.col("_key")
    first = rows.join(hot, same).drop("_key")
    rest = rows.join(hot.select("_key"), same, "left_anti").join(cold, same).drop("_key")
    return first.unionByName(rest)


def keyed_left(rows: DataFrame, facts: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``keyed_join`` that keeps the rows without facts, which get nulls."""
    limit = hot_limit(total)
    facts = facts.withColumnRenamed(key, "_key")
    hot = F.broadcast(facts.where(F.col(size) > limit))
    cold = facts.where(F.col(size) <= limit)
    same = F.col(key) == F.col("_key")
    first = rows.join(hot, same).drop("_key")
    rest = rows.join(hot.select("_key"), same, "left_anti").join(cold, same, "left").drop("_key")
    return first.unionByName(rest)


def row_key(digest: Column | str, doc_id: Column | str) -> Column:
    """A key of (digest, id) with null ids equal, as column ``row_key``."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.struct((F.col(digest) if isinstance(digest, str) else digest).alias("digest"), F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("no_id")).alias("row_key")


def one_each(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """One of the rows of each ``row_key``; ``keys`` are the same rows' keys in a narrow table.

    Keys that repeat are counted on the narrow table, mostly there are none. Rows of
    a key that holds many are found by a bounded broadcast and reduced where they
    stand before any shuffle; all other rows pass as they are.
    """
    again = stored(keys.groupBy("row_key").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1"), "repeated")
    if again.isEmpty():
        return rows
    total = again.agg(F.sum("copies")).first()[0]
    twice = keyed_join(rows, again, "row_key", "copies", total).drop("copies").dropDuplicates(["row_key"])
    hot = again.where(F.col("copies") > hot_limit(total)).select("row_key")
    cold = again.where(F.col("copies") <= hot_limit(total)).select("row_key")
    once = rows.join(F.broadcast(hot), "row_key", "left_anti").join(cold, "row_key", "left_anti")
    return once.unionByName(twice.select(*rows.columns))
