"""Operator 3: exact deduplication over a persistent digest index.

The index is a Parquet table bucketed and sorted by SHA-256 digest. A batch is
reduced to one row per digest (with map-side combining, so a digest that holds
a third of all rows costs one row per task), anti-joined by sort-merge with the
index, and appended. Only DataFrame operations are used.

Texts are equal when identical after lower-casing A-Z; null counts as empty.
Of equal texts in a batch the largest doc_id stays; null ids are smallest. Rows
that repeat a doc_id with an equal text are one document and share a verdict.
A text that an earlier batch has indexed keeps that batch's document, so a batch
that is given again gets the same verdicts. ``group_size`` counts the rows of the
batch at hand. An empty batch changes nothing, and a very long text costs its
hash. Extra columns are never read, so their names can't clash.

What is broadcast depends on the batch alone, whatever the index holds: the
index is first cut to the batch's digests by a merge join with its buckets, and
``common.keyed_join`` sends only digests that many rows of the batch share.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import common


class DigestIndex:
    """Digests seen so far: (digest binary, keep_id), bucketed and sorted by digest."""

    def __init__(self, spark: SparkSession, name: str, path: str | None = None, buckets: int | None = None):
        self.spark, self.name = spark, name
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        place = f"LOCATION '{path}'" if path else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (digest BINARY, keep_id BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS {place}"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def append(self, digests: DataFrame) -> DataFrame:
        """Adds the digests of (digest, doc_id) rows that the index lacks; returns the batch's facts, stored: digest, keep_id, group_size."""
        batch = digests.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        batch = common.stored(batch, "digest_batch")  # else the anti-join moves below the aggregate and meets every copy
        new = batch.select("digest", "keep_id").join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        new.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.name)
        held = batch.select("digest", "group_size").join(self.rows().hint("merge"), "digest")
        facts = common.stored(held.select("digest", "keep_id", "group_size"), "digest_facts")
        common.release(batch)
        return facts

    def drop(self) -> None:
        """Takes the table out of the catalogue; an external table's files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    sha = F.unhex(F.sha2(common.ascii_lower(text).cast("binary"), 256))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), sha.alias("digest"))


def verdicts(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Adds ``docs`` to the index; one row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    seen = common.stored(digests(docs), "digests")
    joined = common.keyed_join(seen, index.append(seen), "digest", "group_size", seen.count())
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def keep_distinct(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The documents that stay, with all their columns, and one of each repeated row.

    Digests are sorted and merged; texts are dealt out by key once and looked up in
    a hash table of their partition's keys, which is small beside the texts, instead
    of being sorted.
    """
    names = docs.columns
    clean = docs.toDF(*[f"c{i}" for i in range(len(names))])
    id_col, text_col = f"c{names.index('doc_id')}", f"c{names.index('text')}"
    seen = common.stored(digests(clean, id_col, text_col), "digests")
    facts = index.append(seen)
    stays = facts.select(common.row_key("digest", "keep_id"))
    sha = F.unhex(F.sha2(common.ascii_lower(text_col).cast("binary"), 256))
    one = common.one_each(clean.withColumn("row_key", common.row_key(sha, F.col(id_col).cast("long"))), seen.select(common.row_key("digest", "doc_id")))
    return one.join(stays.hint("shuffle_hash"), "row_key", "left_semi").drop("row_key").toDF(*names)


def new_index(spark: SparkSession) -> DigestIndex:
    """An empty index of its own, in the shared folder."""
    path = common.scratch(spark, "digest_index")
    return DigestIndex(spark, "digest_index_" + path.rsplit("-", 1)[1], path)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = new_index(spark)
    out = verdicts(common.table(spark, sf_dir, "documents"), index)
    index.drop()  # the batch's facts are stored apart from it
    return out


OP3_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
