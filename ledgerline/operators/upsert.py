"""Set-based upserts that equal a row-by-row loop (U-02 to U-15, A-04, A-05).

One window per key does the work of the loop: a key's live row and its incoming
rows stand in order (the live row first, then by line), and each row's
predecessor is the row before it. Grouping treats null keys as equal, as the
NULL-safe key asks, so there is one shuffle and no null-safe join. The live set
is first cut to the keys that come in, so a small file doesn't move it; where the
two are alike in size (``small=False``), the window itself tells which keys come in,
and the incoming rows are computed and moved once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OPEN_END = "9999-12-31"


def touching(live: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """The live rows whose key comes in."""
    keys = incoming.select(*[F.col(k).alias(f"_{k}") for k in key]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return live.join(keys, condition, "left_semi")


def natural(incoming: DataFrame, live: DataFrame, key: Sequence[str], order: str | Sequence[str] = "line", compare: bool = True, small: bool = True, spread: Column | None = None) -> DataFrame:
    """U-02, U-04 to U-08: every version that the batch makes or touches.

    incoming: key, ``order``, row_hash, valid_from (duplicates by hash collapsed).
    live: key, id, row_hash, valid_from, valid_to. Adds action: inserted,
    superseded (a new version with a predecessor), unchanged (an incoming row
    equal to the live row), closed (the live row got a successor) or kept; next_from
    and prior (id of a live predecessor). ``compare=False`` supersedes even equal rows (U-08).
    spread: a function of the key by which the rows are dealt out, for what comes after.
    """
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in incoming.columns if c not in {*key, *order, "row_hash", "valid_from"}]
    old = (touching(live, incoming, key) if small else live).select(*key, *[F.lit(None).cast(incoming.schema[c].dataType).alias(c) for c in order], "row_hash", "valid_from", "valid_to", F.col("id").alias("live_id"), F.lit(0).alias("_new"))
    new = incoming.select(*key, *order, "row_hash", "valid_from", *rest, F.lit(OPEN_END).cast("date").alias("valid_to"), F.lit(None).cast(live.schema["id"].dataType).alias("live_id"), F.lit(1).alias("_new"))
    rows = new.unionByName(old, allowMissingColumns=True)
    by = list(key)
    if spread is not None:
        rows, by = rows.withColumn("_spread", spread).repartition("_spread"), ["_spread", *key]
    w = Window.partitionBy(*by).orderBy("_new", *order)
    if not small:
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rows = rows.withColumn("_met", F.max("_new").over(whole)).where("_met = 1").drop("_met")
    rows = rows.withColumns({"_prev": F.lag("row_hash").over(w), "_has_prev": F.lag(F.lit(True), 1, False).over(w), "_prev_id": F.lag("live_id").over(w)})
    same = (F.col("_new") == 1) & F.col("_has_prev") & F.col("_prev").eqNullSafe(F.col("row_hash")) if compare else F.lit(False)
    rows = rows.withColumn("_same", same)
    # an unchanged row makes no version, so the version after it succeeds the live row
    w2 = Window.partitionBy(*by).orderBy("_new", *order).rowsBetween(1, Window.unboundedFollowing)
    rows = rows.withColumn("next_from", F.first(F.when(~F.col("_same"), F.col("valid_from")), ignorenulls=True).over(w2))
    rows = rows.withColumn("_followed", F.coalesce(F.max(~F.col("_same")).over(w2), F.lit(False)))
    action = (
        F.when(F.col("_new") == 0, F.when(F.col("_followed"), "closed").otherwise("kept"))
        .when(F.col("_same"), "unchanged")
        .when(F.col("_has_prev"), "superseded")
        .otherwise("inserted")
    )
    rows = rows.withColumn("action", action)
    ends = F.when(F.col("_followed") & (F.col("next_from") > F.col("valid_from")), F.col("next_from")).otherwise(F.col("valid_to"))
    return rows.withColumn("valid_to", ends).withColumn("is_live", ~F.col("_followed") & (F.col("action") != "unchanged")).withColumn("prior", F.col("_prev_id")).drop("_new", "_prev", "_has_prev", "_prev_id", "_same", "_followed", "_spread")


def content(incoming: DataFrame, live: DataFrame, period: str = "tax_period") -> DataFrame:
    """U-03: adds action: unchanged where the period holds the same content live, else inserted."""
    key = ["entity_id", "gstin", period, "row_hash"]
    held = live.select(*[F.col(k).alias(f"_{k}") for k in key]).distinct()
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    return incoming.join(held, same, "left").withColumn("action", F.when(F.col("_row_hash").isNotNull(), "unchanged").otherwise("inserted")).drop(*[f"_{k}" for k in key])


def counters(result: DataFrame, rejected: DataFrame | None = None) -> DataFrame:
    """A-05: inserted, unchanged, superseded, collapsed and rejected, as one row of sums over both tables."""
    count = lambda a: F.count_if(F.col("action") == a).alias(a)
    copies = F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)) if "copies" in result.columns else F.lit(0)
    out = result.agg(count("inserted"), count("unchanged"), count("superseded"), copies.cast("long").alias("collapsed"))
    names = [*out.columns, "rejected"]
    if rejected is None:
        return out.withColumn("rejected", F.lit(0).cast("long"))
    n = rejected.agg(F.count(F.lit(1)).alias("rejected"))
    return out.unionByName(n, allowMissingColumns=True).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names])


def live_versions(rows: DataFrame, key: Sequence[str], by: Sequence[Column]) -> DataFrame:
    """U-12, W-01: the last row of each key."""
    w = Window.partitionBy(*key).orderBy(*by)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def chained(rows: DataFrame, key: Sequence[str], by: str, doc_id: str) -> DataFrame:
    """U-08, W-06: always supersede: each version with the one before (supersedes) and the time it was superseded."""
    w = Window.partitionBy(*key).orderBy(by, doc_id)
    return rows.withColumns({"supersedes": F.lag(doc_id).over(w), "superseded_at": F.lead(by).over(w)})


def children_of_closed(children: DataFrame, closed: DataFrame, record: str = "record_id") -> DataFrame:
    """U-11: child facts with superseded_at set where their record was closed. closed: record, superseded_at."""
    ends = closed.select(record, F.col("superseded_at").alias("_at"))
    return children.join(ends, record, "left").withColumn("superseded_at", F.coalesce("superseded_at", "_at")).drop("_at")


def duplicate_live_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """U-15, Q-03: keys with more than one live row; nulls are equal."""
    return rows.where("superseded_at is null").groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
