"""The polling cursor as a stream (T-01 to T-06).

Batches arrive as Parquet manifests. ``poll`` offers each micro-batch to a
consumer once for each version tuple: what ran is anti-joined out, so a batch
offered again, after a crash or by a doorbell, changes nothing. Started with
``availableNow`` it ends when it has seen what there is and equals a batch read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ledgerline.operators.readers import VERSION
from ledgerline.sources.store import MANIFEST


def arrivals(spark: SparkSession, path: str, files_per_trigger: int = 100, schema: str = MANIFEST) -> DataFrame:
    """The manifests under ``path`` as a stream; T-06: so many files a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("recursiveFileLookup", "true").parquet(path)


def once(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """T-02, T-03: each batch once, with state for late ones kept as long as the overlap."""
    return stream.withWatermark("ready_at", delay).dropDuplicatesWithinWatermark(["batch_id"])


def poll(stream: DataFrame, executions: str, versions: dict[str, str], handle: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Runs ``handle(batches, epoch)`` on batches that these versions haven't run, then records them in ``executions``.

    Should a run be lost after ``handle`` and before its batches are recorded, they are
    offered again under the same epoch: what ``handle`` writes must bear that.
    """
    values = tuple(versions[v] for v in VERSION)

    def each(batches: DataFrame, epoch: int) -> None:
        spark = batches.sparkSession
        schema = "batch_id string, rule_catalog_version string, corpus_version string, tenant_pack_version string"
        place = spark._jvm.org.apache.hadoop.fs.Path(executions)
        ran = spark.read.schema(schema).parquet(executions) if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place) else spark.createDataFrame([], schema)
        for name, value in zip(VERSION, values, strict=True):
            ran = ran.where(F.col(name) == F.lit(value))
        fresh = batches.where("status = 'READY' and superseded_by is null").dropDuplicates(["batch_id"]).join(ran.select("batch_id"), "batch_id", "left_anti")
        fresh = fresh.persist()  # a micro-batch of manifests
        try:
            handle(fresh, epoch)
            done = fresh.select("batch_id", *[F.lit(v).alias(n) for n, v in zip(VERSION, values, strict=True)])
            done.write.mode("append").parquet(executions)
        finally:
            fresh.unpersist()

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()



# polling with state (T-02, T-03): what ran is remembered by the stream itself

OFFERED = "batch_id string, rule_catalog_version string, corpus_version string, tenant_pack_version string, entity_id string, document_type string, source_stream string, period_start date, period_end date, row_count long, content_hash string, ready_at timestamp"
RAN = "batch_id string, rule_catalog_version string, corpus_version string, tenant_pack_version string, ready_at timestamp"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class FirstOnly(StatefulProcessor):
    """Lets the first row of a batch and version tuple through, and forgets it once the watermark has left its overlap behind."""

    def __init__(self, overlap: float):
        self.overlap = overlap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.seen = handle, handle.getValueState("seen", "ready_at timestamp")

    def _remember(self, ready: pd.Timestamp) -> None:
        self.seen.update((None if pd.isna(ready) else ready.to_pydatetime(),))
        if not pd.isna(ready):  # without a time it is remembered for good
            self.handle.registerTimer(int(ready.timestamp() * 1000 + self.overlap * 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = pd.concat(list(rows))  # the copies of one batch's manifest in a micro-batch
        if not self.seen.exists():
            first = found.sort_values(["ready_at", "content_hash"], kind="stable").head(1)
            self._remember(first["ready_at"].iloc[0])
            yield first

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        self._remember(initialState["ready_at"].max())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def executions(spark: SparkSession, path: str) -> DataFrame:
    """The executions recorded under ``path``, by ``poll`` or ``poll_with_state``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)
    return spark.read.schema(RAN).option("recursiveFileLookup", "true").parquet(path) if there else spark.createDataFrame([], RAN)


def poll_with_state(stream: DataFrame, path: str, versions: dict[str, str], handle: Callable[[DataFrame, int], None], checkpoint: str, overlap: float = 3600, trigger: dict | None = None) -> StreamingQuery:
    """``poll`` without reading what ran in each micro-batch: the stream keeps it as state, by batch and version tuple.

    A new query's state starts from the executions recorded under ``path``; after a restart
    the checkpoint has it. A batch's state goes when the watermark, ``overlap`` seconds behind
    the newest batch, has passed its time by the overlap; a batch that comes in later than the
    watermark isn't offered. ``handle(batches, epoch)`` may run again for an epoch whose end was
    not recorded, with the same batches: executions are written once for each epoch, and what
    ``handle`` writes should be too. Needs the RocksDB state store, which it asks for.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    key = ["batch_id", *VERSION]
    values = {v: F.lit(versions[v]) for v in VERSION}
    ready = stream.where("status = 'READY' and superseded_by is null").withColumns(values).withWatermark("ready_at", f"{int(overlap)} seconds")
    names = [c.split()[0] for c in OFFERED.split(", ")]
    mine = executions(spark, path)
    for name, value in values.items():
        mine = mine.where(F.col(name) == value)
    fresh = ready.select(*names).groupBy(*key).transformWithStateInPandas(FirstOnly(overlap), OFFERED, "Append", "EventTime", initialState=mine.groupBy(*key))

    def each(batches: DataFrame, epoch: int) -> None:
        held = batches.persist()  # a micro-batch of manifests
        try:
            handle(held, epoch)
            # a folder for each query and epoch: writing it again replaces it
            held.select(*[c.split()[0] for c in RAN.split(", ")]).write.mode("overwrite").parquet(f"{path}/{_name(checkpoint)}-{epoch}")
        finally:
            held.unpersist()

    return fresh.writeStream.foreachBatch(each).outputMode("append").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def _name(checkpoint: str) -> str:
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
