"""Settings in force by the most specific scope (W-04, V-18).

A setting has rows for a whole tenant (entity_id and gstin null), for an entity (gstin null)
and for a GSTIN, each from ``effective_from`` to before ``effective_to`` (null: no end). At
each level the row that began last holds the level until the next one begins, the higher
``version`` of two that begin together; after its own end it says nothing and the next
wider level is asked. Superseded rows count: a day asks what was in force on that day.

The levels are merged on the side of the settings: each scope that has rows of its own gets
a timeline of disjoint segments, made by one sort of its changes and of those above it.
A point finds its finest such scope by key and then its segment by an interval join,
so points are never sorted or grouped, and a setting that all ask for is spread over cells.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.operators import intervals
from ledgerline.session import held

#: Scopes up to this count go to all tasks; more are joined by a shuffle.
SCOPES = 100_000
_SCOPE = ("entity_id", "gstin")


def _node(entity: Column, gstin: Column) -> Column:
    """A scope's name; nulls and empty strings stay apart."""
    said = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("*"))
    return F.to_json(F.array(said(entity), said(gstin)))


def timelines(settings: DataFrame, values: Sequence[str], key: str = "setting_id") -> DataFrame:
    """(key, entity_id, gstin, level, held_from, held_to, the values): a scope's disjoint segments; held_to is its last day, or null.

    ``level`` tells whose row holds: 2 for a GSTIN's, 1 for an entity's, 0 for the tenant's. One scope's
    changes are sorted in one task: as many as people have made to it and to the two scopes above it.
    """
    state = F.struct(F.col("effective_to").alias("until"), *values)
    level = F.when(F.col("gstin").isNotNull(), 2).when(F.col("entity_id").isNotNull(), 1).otherwise(0)
    ok = settings.where(F.col("effective_from").isNotNull() & ~(F.col("gstin").isNotNull() & F.col("entity_id").isNull()))
    ok = ok.where(F.col("effective_to").isNull() | (F.col("effective_to") > F.col("effective_from")))
    rows = ok.groupBy(key, *_SCOPE, "effective_from").agg(F.max_by(state, F.struct("version", state)).alias("_state")).withColumn("level", level)
    nodes = rows.select(F.col(key).alias("_key"), F.col("entity_id").alias("_e"), F.col("gstin").alias("_g"), F.col("level").alias("_own")).distinct()

    def under(n: int, same: Column) -> DataFrame:
        """What the rows of a level change for their own scopes and those below."""
        return rows.where(F.col("level") == n).join(nodes.where(F.col("_own") >= n), (F.col(key) == F.col("_key")) & same).select("_key", "_e", "_g", "_own", "level", "effective_from", "_state")

    mine, whole = F.col("entity_id") == F.col("_e"), F.lit(True)
    found = under(0, whole).unionByName(under(1, mine)).unionByName(under(2, mine & (F.col("gstin") == F.col("_g"))))
    scope = ["_key", "_e", "_g", "_own"]
    began = found.select(*scope, "level", F.col("effective_from").alias("held_from"), "_state")
    ended = found.where("_state.until is not null").select(*scope, "level", F.col("_state.until").alias("held_from"), F.lit(None).cast(found.schema["_state"].dataType).alias("_state"))
    # a day's changes as one row: of each level at most one row begins on it
    days = began.unionByName(ended).groupBy(*scope, "held_from").agg(*[F.max_by("_state", F.when((F.col("level") == n) & F.col("_state").isNotNull(), 1)).alias(f"_s{n}") for n in range(3)])
    order = Window.partitionBy(*scope).orderBy("held_from")
    now = {f"_s{n}": F.last(f"_s{n}", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)) for n in range(3)}
    days = days.withColumns(now | {"_next": F.lead("held_from").over(order)})
    live = lambda n: F.when(F.col(f"_s{n}").isNotNull() & (F.col(f"_s{n}.until").isNull() | (F.col(f"_s{n}.until") > F.col("held_from"))), F.struct(F.lit(n).alias("level"), F.col(f"_s{n}").alias("s")))
    out = days.withColumn("_in", F.coalesce(live(2), live(1), live(0))).where("_in is not null")
    return out.select(F.col("_key").alias(key), F.col("_e").alias("entity_id"), F.col("_g").alias("gstin"), F.col("_own").alias("scope_level"), F.col("_in.level").alias("level"), "held_from", F.date_sub("_next", 1).alias("held_to"), *[F.col(f"_in.s.{v}").alias(v) for v in values])


def in_force(points: DataFrame, settings: DataFrame, day: str, values: Sequence[str], key: str = "setting_id") -> DataFrame:
    """The points (with key, entity_id, gstin and a day) for which some row of their setting is in force, with ``level`` and the values.

    A point whose key or day is null, or whose setting says nothing on its day, isn't returned.
    """
    lines = held(timelines(settings, values, key), "timelines")  # classes, scopes and segments come from them
    scopes = settings.select(key, *_SCOPE).distinct()
    few = scopes.limit(SCOPES + 1).count() <= SCOPES
    hint = F.broadcast if few else (lambda df: df)
    fine = scopes.where("gstin is not null and entity_id is not null").withColumn("_fine", F.lit(True))
    wide = scopes.where("entity_id is not null and gstin is null").select(key, "entity_id", F.lit(True).alias("_wide"))
    # a scope without a valid row has no timeline of its own: it must not hide the one above it
    lasting = lines.select(key, *_SCOPE).distinct()
    fine = fine.join(lasting.where("gstin is not null"), [key, *_SCOPE], "left_semi")
    wide = wide.join(lasting.where("gstin is null and entity_id is not null"), [key, "entity_id"], "left_semi")
    known = points.join(hint(fine), [key, *_SCOPE], "left").join(hint(wide), [key, "entity_id"], "left")
    none = F.lit(None).cast("string")
    node = F.when(F.col("_fine"), _node(F.col("entity_id"), F.col("gstin"))).when(F.col("_wide"), _node(F.col("entity_id"), none)).otherwise(_node(none, none))
    segments = lines.withColumn("_node", _node(F.col("entity_id"), F.col("gstin"))).select(key, "_node", "level", "held_from", "held_to", *values)
    return intervals.stabbed(known.withColumn("_node", node), segments, [key, "_node"], day, "held_from", "held_to").drop("_node", "_fine", "_wide", "held_from", "held_to")
