"""Operator 9: mixing sources to target weights by iterative proportional fitting.

Tokens are summed by cell (source, language, topic). Each cell has a sampling
probability, KEEP at first; the probabilities are raked to the target share of
each source, language and topic in turn, round by round, so that the expected
tokens of the sample meet all three margins. A probability never exceeds 1: a
margin whose target is more than there is gets all there is. Raking stops when
no probability moves by more than TOLERANCE in a round, or after ROUNDS rounds;
``residuals`` tells how far each margin is from its target. Documents are drawn
by a hash of the doc_id: the same on every run and cluster.

All of it is DataFrame operations. Texts are described once. A round is three
window sums over the stored cells; a count decides whether at most CELLS cells
stand in one partition, where windows need no exchange, or are dealt out by
margin value. The same count decides whether cells are broadcast to documents
or joined by a shuffle.

Targets default to tempered shares, tokens ** TEMPER, which lift small margins.
Null source or lang is a value of its own, "(none)"; null text has no tokens.
Cells without tokens keep probability KEEP. A null doc_id draws like the empty text.
A very long text is a row like any other: its tokens are counted in one pass.
Repeated rows are drawn alike; extra columns pass unchanged; an empty table
gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm import common

DIMENSIONS, TEMPER, KEEP, CELLS = ("source", "lang", "topic"), 0.8, 0.8, 100_000
#: Rounds at most, and how many of them are planned and stored together, after which the change is looked at.
ROUNDS, TOGETHER, TOLERANCE = 24, 3, 1e-9
#: Signs that a text is mostly figures, symbols or a listing: characters, and of how many characters they are at least one.
TOPICS = (("symbols", "#$%&*<>{}[]|=~^", 20), ("figures", "0123456789", 12), ("listing", "\n", 60))
WORD = r"[^\x20\x09-\x0D]+"


def topic(text: Column) -> Column:
    out = F.when(F.length(text) == 0, "empty")
    for name, letters, share in TOPICS:
        signs = "[" + "".join(f"\\x{ord(c):02X}" for c in letters) + "]"
        out = out.when(F.regexp_count(text, F.lit(signs)) * share >= F.length(text), name)
    return out.otherwise("prose")


def described(docs: DataFrame, *kept: Column) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, and the columns ``kept``."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("source", F.lit("(none)")).alias("source"),
        F.coalesce("lang", F.lit("(none)")).alias("lang"),
        topic(text).alias("topic"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"),
        *kept,
    )


def _few(cells: DataFrame) -> bool:
    return cells.limit(CELLS + 1).count() <= CELLS


def _tempered(dimension: str) -> Column:
    """The default target share of a cell's value: its tokens to the power TEMPER, over those of all values."""
    power = F.pow(F.sum("n_tokens").over(Window.partitionBy(dimension)).cast("double"), F.lit(TEMPER))
    return F.when(F.row_number().over(Window.partitionBy(dimension).orderBy(*DIMENSIONS)) == 1, power)


def _with_shares(cells: DataFrame, targets: dict[str, DataFrame] | None) -> DataFrame:
    """Cells with the target share of their value in each dimension; null where a value has no target."""
    if targets:
        for d in DIMENSIONS:
            wanted = targets[d].groupBy(F.col("value").alias(d)).agg(F.first("share").alias(f"share_{d}"))
            cells = cells.join(wanted, d, "left")
        return cells
    once = cells.withColumns({f"power_{d}": _tempered(d) for d in DIMENSIONS})
    whole = once.agg(*[F.sum(f"power_{d}").alias(d) for d in DIMENSIONS]).first()
    # a value's power stands in one of its cells
    return once.withColumns({f"share_{d}": F.try_divide(F.max(f"power_{d}").over(Window.partitionBy(d)), F.lit(whole[d])) for d in DIMENSIONS}).drop(*[f"power_{d}" for d in DIMENSIONS])


def _rounds(cells: DataFrame, wanted: float) -> DataFrame:
    """TOGETHER rounds of raking: a round scales the probability to each dimension's targets in turn.

    One SQL statement, since a long chain of DataFrame calls is analysed anew at each call.
    """
    keep = [*DIMENSIONS, "n_tokens", *[f"share_{d}" for d in DIMENSIONS]]
    query = "SELECT * FROM {cells}"
    for _ in range(TOGETHER):
        query = f"SELECT {', '.join(keep)}, probability AS before, probability FROM ({query})"
        for d in DIMENSIONS:
            now = f"sum(n_tokens * probability) OVER (PARTITION BY {d})"
            # a value without a target isn't wanted
            scaled = f"CASE WHEN share_{d} IS NULL AND n_tokens > 0 THEN 0D ELSE probability * coalesce(try_divide(share_{d} * :wanted, {now}), 1D) END"
            query = f"SELECT {', '.join(keep)}, before, least(1D, {scaled}) AS probability FROM ({query})"
    return cells.sparkSession.sql(query, {"wanted": wanted}, cells=cells)


def raked(cells: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP) -> DataFrame:
    """Cells (source, lang, topic, n_tokens) with their shares and the probability by which their expected tokens meet each target share of ``keep`` of all tokens."""
    few = _few(cells)
    near = lambda df: df.coalesce(1) if few else df
    wanted = keep * float(cells.agg(F.sum("n_tokens")).first()[0] or 0)
    held = common.stored(_with_shares(near(cells), targets).withColumns({"probability": F.lit(keep), "before": F.lit(keep)}), "raked")
    for _ in range(ROUNDS // TOGETHER):
        moved = common.stored(_rounds(near(held), wanted), "raked")
        common.release(held)
        held = moved
        change = held.agg(F.max(F.abs(F.col("probability") - F.col("before")))).first()[0]
        if change is None or change <= TOLERANCE:
            break
    return held.drop("before")


def residuals(cells: DataFrame, keep: float = KEEP) -> DataFrame:
    """(dimension, value, share, reached): each margin's target share of the wanted tokens and the share that raked cells reach."""
    wanted = keep * float(cells.agg(F.sum("n_tokens")).first()[0] or 0)
    sides = [cells.select(F.lit(d).alias("dimension"), F.col(d).alias("value"), F.col(f"share_{d}").alias("share"), (F.col("n_tokens") * F.col("probability")).alias("expected")) for d in DIMENSIONS]
    return sides[0].unionByName(sides[1]).unionByName(sides[2]).groupBy("dimension", "value").agg(F.first("share").alias("share"), F.try_divide(F.sum("expected"), F.lit(wanted)).alias("reached"))


def plan(rows: DataFrame, targets: dict[str, DataFrame] | None = None, keep: float = KEEP) -> DataFrame:
    """The raked cells of ``described`` rows: source, lang, topic, n_tokens, shares, probability."""
    return raked(common.stored(rows.groupBy(*DIMENSIONS).agg(F.sum("n_tokens").alias("n_tokens")), "cells"), targets, keep)


def draw(doc_id: Column) -> Column:
    """A number from 0 to 1 that depends on the id alone."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":mix")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16**13)


def joined(rows: DataFrame, cells: DataFrame) -> DataFrame:
    small = _few(cells)
    cells = cells.select(*DIMENSIONS, "probability")
    return rows.join(F.broadcast(cells) if small else cells, list(DIMENSIONS))


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, n_tokens, probability, kept."""
    rows = common.stored(described(docs), "described")
    out = joined(rows, plan(rows, targets))
    return out.select("doc_id", *DIMENSIONS, "n_tokens", F.round("probability", 6).alias("probability"), (draw(F.col("doc_id")) < F.col("probability")).alias("kept"))


def sample(docs: DataFrame, targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """The documents that are drawn, with all their columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = common.stored(described(docs, row), "described")
    out = joined(rows, plan(rows, targets))
    return out.where(draw(F.col("doc_id")) < F.col("probability")).select("row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(common.table(spark, sf_dir, "documents"))


def _sql() -> str:
    """The same fit with its rounds written out; cells stay as they are once a group of rounds has changed nothing."""
    kinds = "\n".join(f"WHEN (length(t) - length(translate(t, '{x}', ''))) * {n} >= length(t) THEN '{name}'" for name, x, n in TOPICS)
    parts = [f"""
d AS (SELECT doc_id, source, lang, CASE WHEN length(t) = 0 THEN 'empty' {kinds} ELSE 'prose' END AS topic,
        len(regexp_extract_all(t, '{WORD}'))::BIGINT AS n_tokens
      FROM (SELECT doc_id, coalesce(source, '(none)') AS source, coalesce(lang, '(none)') AS lang, coalesce(text, '') AS t FROM documents)),
c0 AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS n, {KEEP}::DOUBLE AS w FROM d GROUP BY ALL)"""]
    for x in DIMENSIONS:
        parts.append(f"t_{x} AS MATERIALIZED (SELECT {x}, pow(s, {TEMPER}) / sum(pow(s, {TEMPER})) OVER () AS share, sum(s) OVER () AS total FROM (SELECT {x}, sum(n) AS s FROM c0 GROUP BY 1))")
    last, done = "c0", "false"
    for group in range(ROUNDS // TOGETHER):
        first = last
        for k in range(TOGETHER):
            start = last
            for x in DIMENSIONS:
                parts.append(f"c{group}_{k}_{x} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, n, least(1.0, w * coalesce(share * {KEEP} * total / nullif(sum(n * w) OVER (PARTITION BY c.{x}), 0), 1)) AS w FROM {last} c JOIN t_{x} t ON c.{x} = t.{x})")
                last = f"c{group}_{k}_{x}"
        both = "SELECT a.*, b.w AS {0} FROM {1} a JOIN {2} b ON a.source = b.source AND a.lang = b.lang AND a.topic = b.topic"
        parts.append(f"g{group} AS MATERIALIZED (SELECT source, lang, topic, n, CASE WHEN {done} THEN was ELSE w END AS w FROM ({both.format('was', last, first)}))")
        parts.append(f"s{group} AS MATERIALIZED (SELECT {done} OR max(abs(w - was)) <= {TOLERANCE} AS done FROM ({both.format('was', last, start)}))")
        last, done = f"g{group}", f"(SELECT done FROM s{group})"
    return f"""WITH {", ".join(parts)}
SELECT d.doc_id, d.source, d.lang, d.topic, d.n_tokens, round(w, 6) AS probability,
       ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':mix'), 1, 13))::BIGINT::DOUBLE / pow(16, 13) < w AS kept
FROM d JOIN {last} c ON d.source = c.source AND d.lang = c.lang AND d.topic = c.topic"""


OP9_SQL = _sql()
