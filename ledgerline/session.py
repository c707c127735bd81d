"""Session defaults: UTC, ANSI, adaptive execution. Anything a caller has set stays."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def session(app: str = "ledgerline", **settings: str) -> SparkSession:
    return SparkSession.builder.appName(app).config(map=DEFAULTS | settings).getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (``spark.checkpoint.dir``); only a local session does without one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="ledgerline-")
        spark.sparkContext.setCheckpointDir(root)
    path = f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """For writes of rows with many computed columns: one generated method for all of them passes the 8,000 bytes
    above which the JVM doesn't compile, and is interpreted. Under this limit Spark splits such a projection instead."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def held(rows: DataFrame, name: str = "held") -> DataFrame:
    """Writes rows to the shared folder and reads them back: what several results come from is computed once."""
    return kept(rows, scratch(rows.sparkSession, name))


def kept(rows: DataFrame, path: str, by: tuple[str, ...] = (), **options: str) -> DataFrame:
    """As ``held``, at a given place; ``by``: columns that become folders."""
    with wide_rows(rows.sparkSession):
        rows.write.partitionBy(*by).parquet(path, **options)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
