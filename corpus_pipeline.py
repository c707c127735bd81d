"""A corpus pipeline: rejects toxic documents, removes exact and near duplicates, mixes sources, and encodes.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor
kept; its result is written as Parquet and read again as the next stage's docs.
All but the last return the columns of documents, whatever others there are.

Null texts count as empty everywhere: they are one text for the exact and the near
stage, so one of them stays, and encode to no ids. Null ids are documents too: of
equal texts one with an id stays before one without. Rows that repeat id and text
are one document. Null source or lang is a value of its own. Very long texts are
read whole. Of ties the largest id stays in the exact stage, the smallest in the
near stage. An empty table passes all stages; without labels nothing is rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import bpe, common, exact_dedup, mixing, simhash
from ledgerline.llm import toxicity as tox


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tox.reject(docs, common.table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_distinct(docs, exact_dedup.new_index(spark))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids (array<int>), n_tokens."""
    return bpe.encode(docs.select("doc_id", "lang", "source", "text")).drop("text").withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("toxicity", toxicity), ("exact_dedup", exact), ("simhash", near), ("mixing", mix), ("bpe", encode)]

#: SQL can't express the learned scores, the index or the merges; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, common.stored(stage(spark, docs, sf_dir), f"stage_{name}")
        common.release(before)  # the tables that it was read from stay
    return STAGES[-1][1](spark, docs, sf_dir)
