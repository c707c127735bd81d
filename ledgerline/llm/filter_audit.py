"""Operator 11: an audit of how filters interact, by running every order of them as a trie of permutations.

The trie's nodes are prefixes of orders. What survives a prefix depends on its set
of filters alone, so nodes of equal sets share one state: 32 states and 80 edges for
five filters instead of 325 nodes. States are visited depth first. A state is a
persisted DataFrame of survivors; its edges, one for each filter not applied yet,
count by part what they remove, and only then are its child states made, each from
its survivors, unless another prefix has made them before (memoisation keeps their
counts). A state's files go once its subtree is done, so at most one state for each
filter stands on disk, however many orders there are.

Texts are read once: ``failing`` turns a document into one boolean per filter, and
survivors are these narrow rows. Counts are sums with map-side combining, so a part
with a third of all rows costs one row per task; rows of a repeated text or id are
dealt out by ``common.keyed_left``. The driver sees no rows.

Null texts are empty, null parts the empty string. A text fails ``E`` if a smaller
doc_id has the same text anywhere in the table, removed or not; a null doc_id is
neither smaller nor larger than another, so it never fails E, and has no labels.
Of repeated labels a 1 counts. Repeated rows are documents of their own. Very long
texts are read whole, in the JVM. Extra columns are never read; columns that clash
don't either. An empty table has no parts and gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm import common

WORD = r"[^\x20\x09-\x0D]+"
FILTERS = "ABCDE"
#: Least words; least share of distinct words and largest share of capitals, in hundredths; signs that no text may hold.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SIGNS = 200, 50, 2, "#$%&*|"
COUNTS = ("removed", "good_lost", "toxic_lost")


def failing(docs: DataFrame) -> DataFrame:
    """doc_id, part, a boolean for each of the filters A to D, and the text's digest."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    n, capitals = F.size("words"), F.regexp_count("text", F.lit("[A-Z]"))
    return rows.select(
        "doc_id",
        "part",
        (n < LEAST_WORDS).alias("A"),
        (100 * F.size(F.array_distinct("words")) < LEAST_DISTINCT * n).alias("B"),
        (100 * capitals.cast("long") > MOST_CAPITALS * F.length("text")).alias("C"),
        F.col("text").rlike(f"[{SIGNS}]").alias("D"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
    )


def with_copies(rows: DataFrame) -> DataFrame:
    """``failing`` rows with E: whether a smaller doc_id has the same text. Only digests that repeat are joined."""
    again = rows.groupBy("digest").agg(F.min("doc_id").alias("_first"), F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    again = common.stored(again, "audit_copies")
    total = again.agg(F.sum("_copies")).first()[0] or 0
    out = common.keyed_left(rows, again, "digest", "_copies", total)
    return out.withColumn("E", F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False))).drop("digest", "_first", "_copies")


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds good (quality 1) and toxic (toxic 1). The join is by doc_id; one that repeats is split by adaptive execution."""
    marks = [(F.max(F.coalesce(F.col(c).cast("int") == 1, F.lit(False)))).alias(name) for c, name in (("quality", "good"), ("toxic", "toxic"))]
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(*marks).where("good or toxic")
    out = rows.join(known, "doc_id", "left")
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})


def edges(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Runs the trie over rows (part, good, toxic, a boolean per filter).

    One row per part, state (the filters applied before, sorted) and filter, where
    the part still has rows: kept, removed, good_lost, toxic_lost.
    """
    found, made = [], {""}
    lost = [F.count_if(F.col(f) & also).alias(f"{f}_{name}") for f in filters for name, also in zip(COUNTS, (F.lit(True), F.col("good"), F.col("toxic")), strict=True)]
    each = F.array(*[F.struct(F.lit(f).alias("filter"), (F.col("held") - F.col(f"{f}_removed")).alias("kept"), *[F.col(f"{f}_{name}").alias(name) for name in COUNTS]) for f in filters])

    def visit(state: str, survivors: DataFrame) -> None:
        # the same expressions for all states, so that their code is compiled once; an applied filter removes nothing more
        counted = survivors.groupBy("part").agg(F.count(F.lit(1)).alias("held"), *lost)
        found.append(common.stored(counted.select("part", F.lit(state).alias("state"), F.inline(each)), "audit_edges"))
        for f in filters:
            child = "".join(sorted(state + f))
            if f in state or child in made or len(child) == len(filters):
                continue
            made.add(child)
            left = survivors.where(~F.col(f))
            if len(child) < len(filters) - 1:  # a state with one edge is read once
                left = common.stored(left, "audit_state")
            visit(child, left)
            common.release(left)

    visit("", rows)
    out = reduce(DataFrame.unionByName, found).where(~F.contains("state", "filter"))
    held = common.stored(out.coalesce(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "audit_trie")
    common.release(*found)
    return held


def orders(edge_rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row per part, order and step, read off the trie's edges; zeros where nothing was left.

    The orders are a literal array of fixed size; each part is one row before it is exploded.
    """
    step = F.explode(F.sequence(F.lit(1), F.lit(len(filters))))
    grid = edge_rows.where("state = ''").select("part").distinct().select("part", F.explode(F.lit(_permutations(filters))).alias("filter_order")).select("part", "filter_order", step.alias("step"))
    before = F.substr("filter_order", F.lit(1), F.col("step") - 1)
    grid = grid.withColumns({"filter": F.substr("filter_order", F.col("step"), F.lit(1)), "state": F.array_join(F.array_sort(F.split(before, "")), "")})
    out = grid.join(edge_rows, ["part", "state", "filter"], "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("kept", *COUNTS)})
    w = Window.partitionBy("part", "filter")
    all_of_it = F.max(F.when(F.length("state") == 0, F.col("removed"))).over(w)
    alone = F.max(F.when(F.length("state") == len(filters) - 1, F.col("removed"))).over(w)
    return out.select(
        "part", "filter_order", "step", "kept", "removed",
        (all_of_it - F.col("removed")).alias("redundant"), alone.alias("unique_fails"), "good_lost", "toxic_lost", F.sum("removed").over(w).alias("shapley"),
    )


def _permutations(filters: str) -> list[str]:
    out = [""]
    for _ in filters:
        out = [p + f for p in out for f in filters if f not in p]
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The whole audit of documents by their source."""
    seen = common.stored(failing(docs), "audit_rows")
    rows = common.stored(with_labels(with_copies(seen), labels).select("part", *FILTERS, "good", "toxic"), "audit_state")
    common.release(seen)
    found = edges(rows)
    common.release(rows)
    return orders(found)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


def _sql() -> str:
    fails = lambda f, k: f"position('{f}' IN substr(o, 1, {k})) > 0 AND {f}"
    gone = lambda k: "(" + " OR ".join(f"({fails(f, k)})" for f in FILTERS) + ")"
    own = "CASE substr(o, step, 1) " + " ".join(f"WHEN '{f}' THEN {f}" for f in FILTERS) + " END"
    n_fails = " + ".join(f"{f}::INT" for f in FILTERS)
    return f"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
f AS (
  SELECT doc_id, part, len(w) < {LEAST_WORDS} AS A, 100 * len(list_distinct(w)) < {LEAST_DISTINCT} * len(w) AS B,
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {MOST_CAPITALS} * length(t) AS C,
         regexp_matches(t, '[{SIGNS}]') AS D, coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS E FROM t),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY 1),
g AS (
  SELECT part, A, B, C, D, E, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
s AS (
  SELECT part, o, step, n, good, toxic, {gone("step - 1")} AS gone_before, {own} AS fails, {n_fails} AS n_fails
  FROM g, (SELECT unnest({_permutations(FILTERS)}) AS o), (SELECT unnest(range(1, {len(FILTERS) + 1})) AS step)),
r AS (
  SELECT part, o AS filter_order, step, coalesce(sum(n) FILTER (NOT gone_before AND NOT fails), 0) AS kept,
         coalesce(sum(n) FILTER (NOT gone_before AND fails), 0) AS removed, coalesce(sum(n) FILTER (gone_before AND fails), 0) AS redundant,
         coalesce(sum(n) FILTER (fails AND n_fails = 1), 0) AS unique_fails, coalesce(sum(good) FILTER (NOT gone_before AND fails), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (NOT gone_before AND fails), 0) AS toxic_lost FROM s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, substr(filter_order, step, 1)))::BIGINT AS shapley FROM r"""


OP11_SQL = _sql()
