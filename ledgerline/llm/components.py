"""Connected components of a link table, by alternating large-star and small-star rounds.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Links
are rows (a, b) of longs; only nodes with links appear. Each round is a
grouping with map-side combining and an equi-join; links stay distributed, and
every round is written to the shared folder, so lineage stays short. Nothing
but two numbers per round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import common


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Hangs neighbours on the smallest node around: the larger neighbours, or the smaller ones and the node itself."""
    a, b = F.col("a"), F.col("b")
    if large:
        near = links.unionByName(links.select(b.alias("a"), a.alias("b")))
    else:
        near = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = near.groupBy("a").agg(F.min("b").alias("m"), F.count(F.lit(1)).alias("n")).withColumn("m", F.least("m", "a"))
    least = common.stored(least, "least")
    total = least.agg(F.sum("n")).first()[0] or 0
    joined = common.keyed_join(near, least, "a", "n", total)
    moved = joined.where(b > a if large else F.lit(True)).select(b.alias("a"), F.col("m").alias("b"))
    if not large:
        moved = moved.unionByName(least.select("a", F.col("m").alias("b")))
    out = common.stored(moved.where(a != b).distinct(), "links")
    common.release(links, least)
    return out


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each linked node's component."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    links, before = common.stored(links, "links"), None
    while True:
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        links = _star(_star(links, True), False)
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
