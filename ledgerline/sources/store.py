"""A Parquet store committed by manifest (S-18 to S-21, U-14, C-08).

A load stages its rows in folders of its attempt, which no other attempt shares,
then publishes a manifest that names the attempt; readers take the rows of
published attempts, so a batch is seen whole or not at all. What a failed attempt
left stays unseen, and a batch that is published is never written again. Closures
of live rows are appended as rows of their own, so nothing is rewritten.

The commit itself is an entry of an ordered log (``sources.commitlog``). An attempt
remembers the version it started from, and ``publish`` refuses with ``Conflict`` if a
commit since then touched one of its keys, so of loads that interleave each sees the
others' rows or is done again. The entry holds the manifest; should a writer be lost
between the two, the next one that publishes writes the manifest from the entry. Ids are
stored columns, never parts of paths that a reader would have to guess types from,
and a manifest keeps the schemas that its batch was written with, so all columns of
all batches are read without opening a file. A tenant is a directory that carries
the tenant's name; opening it under another name fails. This keeps mistakes apart;
it is not an authorization boundary.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgerline.session import kept
from ledgerline.sources.commitlog import CODEC, CommitLog, Conflict, LiveIndex, Run, State, key_hash, part

MANIFEST = "batch_id string, entity_id string, document_type string, source_stream string, period_start date, period_end date, row_count long, content_hash string, status string, ready_at timestamp, superseded_by string, attempt string, schemas map<string,string>"
CLOSURE = "id string, superseded_at timestamp, valid_to date, batch_id string, attempt string"
#: Append-only histories that readers resolve themselves: approvals and effective dates are theirs to judge.
HISTORIES = {
    "tenant_setting": "setting_row_id string, setting_id string, entity_id string, gstin string, value_type string, value_numeric decimal(18,4), value_text string, value_boolean boolean, value_json string, unit string, version int, approval_state string, approved_by string, approved_at timestamp, effective_from date, effective_to date, source_reference string, recorded_at timestamp, superseded_at timestamp",
    "gl_category_bridge": "bridge_id string, entity_id string, gstin string, gl_code string, ref02_category_code string, match_mode string, normalized_narration_pattern string, inclusion_terms array<string>, exclusion_terms array<string>, priority int, effective_from date, effective_to date, approval_state string, bridge_version string, source_reference string, recorded_at timestamp, superseded_at timestamp",
    "ref02_notified_rcm_category": "category_code string, applicability_test string, conditions_json string, approval_state string, effective_from date, effective_to date, reference_version string, source_record_id string, source_version string, citation_reference string, recorded_at timestamp, superseded_at timestamp",
}


@dataclass
class Attempt:
    """A load under way: its name, the state it reads, the schemas it wrote, and its runs of the live index."""

    name: str
    state: State
    schemas: dict[str, str] = field(default_factory=dict)
    runs: list[Run] = field(default_factory=list)


class TenantStore:
    def __init__(self, spark: SparkSession, root: str, tenant: str):
        if not tenant or not tenant.replace("_", "").isalnum():
            raise ValueError("a tenant is needed")
        self.spark, self.path, self.tenant = spark, f"{root.rstrip('/')}/{tenant}", tenant
        self._attempts: dict[str, Attempt] = {}
        self.log = CommitLog(spark, f"{self.path}/log")
        self.index = LiveIndex(spark, self.log, f"{self.path}/index")
        mark = f"{self.path}/tenant"
        if self._exists(mark):
            found = self.spark.read.text(mark).first()[0]
            if found != tenant:
                raise PermissionError(f"this is the store of {found}")
        else:
            spark.createDataFrame([(tenant,)], "value string").coalesce(1).write.text(mark)

    def _exists(self, path: str) -> bool:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(place)

    def own(self, path: str) -> str:
        """S-16: a path that is read again must lie in this tenant's store, whatever a row says."""
        if not path.startswith(f"{self.path}/") or ".." in path.split("/"):
            raise PermissionError(f"{path} is not in the store of {self.tenant}")
        return path

    def _attempt(self, batch_id: str) -> Attempt:
        if batch_id not in self._attempts:
            self._attempts[batch_id] = Attempt(uuid.uuid4().hex, self.log.state())
        return self._attempts[batch_id]

    def attempt(self, batch_id: str) -> str:
        """The name of the current attempt to load a batch; a new one after a failure or a publication. It reads the state as of its start."""
        return self._attempt(batch_id).name

    def live_for(self, table: str, batch_id: str, incoming: DataFrame, key: Sequence[str]) -> DataFrame | None:
        """The live rows, as of the attempt's start, among which are all that have an incoming key; null if the table has none.

        Only the incoming keys' buckets of the live index are read; a table without an
        index (written row by row, not by loads) is read whole.
        """
        found = self.index.live(self._attempt(batch_id).state, table, incoming, key)
        return self.live(table) if found is None else found

    def live_size(self, table: str, batch_id: str) -> int:
        """How many rows the runs of a table's live index hold, as of the attempt's start; a count of files' footers."""
        found = self.index.read(self._attempt(batch_id).state.runs.get(table, ()))
        return 0 if found is None else found.count()

    #: Keys that are sent to all tasks.
    MET = 1_000_000

    def met(self, batch_id: str, live: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
        """The live rows that have an incoming key, and at most a few more: keys are held against each other by their hashes, so
        only live rows that are met are moved. Where more than MET are, all live rows come back."""
        hashes = lambda rows: rows.select(key_hash(key).alias("key_hash"))
        both = self.work(batch_id, "met", hashes(live).join(hashes(incoming), "key_hash", "left_semi").distinct())
        if both.count() > self.MET:
            return live
        return live.withColumn("key_hash", key_hash(key)).join(F.broadcast(both), "key_hash", "left_semi").drop("key_hash")

    def look_ahead(self, table: str, batch_id: str, incoming: DataFrame, key: Sequence[str]) -> None:
        """``Conflict`` if a commit since the attempt's start touched an incoming key: a load that ``publish`` would refuse isn't computed first."""
        since = [e for e in self.log.entries(self._attempt(batch_id).state.version) if e["batch_id"]]
        runs = [Run(**r) for e in since for r in e["runs"] if r["table"] == table]
        if not runs or batch_id in {e["batch_id"] for e in since}:
            return
        theirs = self.index.read(runs).select("key_hash")
        if not theirs.join(incoming.select(key_hash(key).alias("key_hash")), "key_hash", "left_semi").isEmpty():
            self.abandon(batch_id)
            raise Conflict(f"batch {batch_id} met a key of a batch since its start")

    @staticmethod
    def spread(key: Sequence[str]) -> Column:
        """By what a load's rows are dealt out, so that they lie by key and by the live index's buckets."""
        return part(key)

    def stage_live(self, table: str, batch_id: str, key: Sequence[str], rows: DataFrame, dealt: bool = False) -> None:
        """Stages a run of the live index: new live versions, and the ids of closed ones (removed). rows: key, row_hash, valid_from, valid_to, id, removed; dealt by ``spread`` or not."""
        run = self.index.write(table, rows.withColumn("key_hash", key_hash(key)), dealt=dealt)
        if run:
            self._attempt(batch_id).runs.append(run)

    def stage(self, table: str, batch_id: str, rows: DataFrame) -> DataFrame:
        """Writes a batch's rows, which nobody sees before ``publish``, and reads them back."""
        attempt = self.attempt(batch_id)
        rows = rows.drop("attempt").withColumns({"batch_id": F.lit(batch_id), "attempt": F.lit(attempt)})
        place = f"{self.path}/silver/{table}/{attempt}"
        rows.write.mode("errorifexists").parquet(place, compression=CODEC)
        self._attempts[batch_id].schemas[table] = rows.schema.json()
        return self.spark.read.schema(rows.schema).parquet(place)

    def staged(self, rows: DataFrame, batch_id: str) -> DataFrame:
        """Rows with the columns that ``adopt`` asks for."""
        return rows.drop("attempt").withColumns({"batch_id": F.lit(batch_id), "attempt": F.lit(self.attempt(batch_id))})

    def adopt(self, table: str, batch_id: str, name: str, folders: Sequence[str], schema: T.StructType) -> None:
        """Stages folders of an intermediate table as a batch's rows: they are moved as they are, and columns that ``schema`` hasn't aren't read."""
        attempt = self.attempt(batch_id)
        work, place = f"{self.path}/work/{attempt}/{name}", f"{self.path}/silver/{table}/{attempt}"
        there = self.log.files.names(work)
        for folder in folders:
            if folder in there:
                self.log.files.move(f"{work}/{folder}", f"{place}/{folder}")
        if not self._exists(place):  # a batch without rows of its own
            self.spark.createDataFrame([], schema).coalesce(1).write.parquet(place)
        self._attempts[batch_id].schemas[table] = schema.json()

    def stage_closures(self, table: str, batch_id: str, closures: DataFrame) -> None:
        attempt = self.attempt(batch_id)
        rows = closures.select(F.col("id").cast("string").alias("id"), F.col("superseded_at").cast("timestamp").alias("superseded_at"), F.col("valid_to").cast("date").alias("valid_to"))
        rows.withColumns({"batch_id": F.lit(batch_id), "attempt": F.lit(attempt)}).write.mode("errorifexists").parquet(f"{self.path}/closures/{table}/{attempt}")

    def work(self, batch_id: str, name: str, rows: DataFrame, *by: str) -> DataFrame:
        """A load's intermediate table, computed once, in folders by some columns if asked; ``abandon`` or ``publish`` removes it."""
        return kept(rows, f"{self.path}/work/{self.attempt(batch_id)}/{name}", by, compression=CODEC)

    def abandon(self, batch_id: str) -> None:
        """Ends an attempt: its intermediate tables go, and whatever it staged stays unseen."""
        attempt = self._attempts.pop(batch_id, None)
        if attempt:
            self.log.files.delete(f"{self.path}/work/{attempt.name}")

    def published(self, batch_id: str) -> bool:
        return self._exists(f"{self.path}/manifest/{folder_of(str(batch_id))}")

    def publish(self, manifest: dict) -> bool:
        """The commit: a batch is published once; False when it was already there, ``Conflict`` when it must be loaded again."""
        batch = str(manifest["batch_id"])
        if self.published(batch):
            self.abandon(batch)
            return False
        own = self._attempt(batch)
        given = _to_json(manifest | {"batch_id": batch, "attempt": own.name, "schemas": own.schemas})
        if not self._commit(batch, manifest=given):
            return False
        self._materialize({"batch_id": batch, "manifest": given})
        self._settle(batch)
        return True

    def commit(self, batch_id: str) -> bool:
        """A commit of rows that live in the index alone, such as the intake ledger's; as ``publish``, but no batch for readers."""
        if not self._commit(batch_id):
            return False
        self._settle(batch_id)
        return True

    def _settle(self, batch_id: str) -> None:
        for table in {r.table for r in self._attempt(batch_id).runs}:
            self.index.compact(table)
        self.abandon(batch_id)

    def _commit(self, batch: str, **more: object) -> bool:
        """Appends the attempt's entry behind all commits since its start, none of which may have its batch (False) or its keys (Conflict)."""
        own = self._attempt(batch)
        seen = own.state.version
        while True:
            for entry in self.log.entries(seen):
                seen = entry["version"]
                if entry.get("manifest"):
                    self._materialize(entry)
                if entry["batch_id"] == batch:
                    self.abandon(batch)
                    return False
                if entry["batch_id"] and self.index.clash(own.runs, [Run(**r) for r in entry["runs"]]):
                    self.abandon(batch)
                    raise Conflict(f"batch {batch} met a key of batch {entry['batch_id']}")
            if self.log.append(seen + 1, batch, own.runs, **more):
                return True

    def recover(self) -> int:
        """Writes the manifests of commits whose writer was lost before it wrote them; all entries are looked at."""
        return sum(self._materialize(e) for e in self.log.entries(0) if e.get("manifest"))

    def _materialize(self, entry: dict) -> bool:
        """The manifest table's row of a commit, from its log entry."""
        place = f"{self.path}/manifest/{folder_of(entry['batch_id'])}"
        if self._exists(place):
            return False
        schema = T._parse_datatype_string(MANIFEST)
        given = _from_json(entry["manifest"], schema)
        self.spark.createDataFrame([tuple(given.get(f.name) for f in schema.fields)], schema).coalesce(1).write.mode("ignore").parquet(place)
        return True

    def manifests(self) -> DataFrame:
        if not self._exists(f"{self.path}/manifest"):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").parquet(f"{self.path}/manifest")

    def manifest(self, batch_id: str) -> DataFrame:
        """S-20."""
        return self.manifests().where(F.col("batch_id") == str(batch_id))

    def schema(self, table: str) -> T.StructType | None:
        """All columns that published batches of a table have; a handful of distinct schemas, one for each layout."""
        found = self.manifests().select(F.col("schemas")[table].alias("s")).where("s is not null").distinct().orderBy("s").collect()
        columns: dict[str, T.StructField] = {}
        for row in found:
            for f in T.StructType.fromJson(json.loads(row.s)).fields:
                if columns.setdefault(f.name, f).dataType != f.dataType:
                    raise TypeError(f"{table}.{f.name} was written as {columns[f.name].dataType.simpleString()} and as {f.dataType.simpleString()}")
        return T.StructType([T.StructField(f.name, f.dataType) for f in columns.values()]) if found else None

    def raw(self, table: str) -> DataFrame | None:
        """The rows of published batches as they were written; empty if there are only rows staged here, null without any."""
        schema = self.schema(table)
        if schema is None:
            staged = [a.schemas[table] for a in self._attempts.values() if table in a.schemas]
            return self.spark.createDataFrame([], T.StructType.fromJson(json.loads(staged[0]))).drop("attempt") if staged else None
        rows = self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{self.path}/silver/{table}")
        return rows.join(self.manifests().select("batch_id", "attempt"), ["batch_id", "attempt"], "left_semi").drop("attempt")

    def rows(self, table: str, schema: str | T.StructType | None = None, known: str | None = None) -> DataFrame | None:
        """All versions in published batches with their closures applied, those known at a time if one is given; null if the table has none."""
        own = self.raw(table)
        if own is None:
            return self.spark.createDataFrame([], schema) if schema else None
        if known is not None:  # what a later closure says of a row wasn't known
            later = F.col("superseded_at") > F.to_timestamp(F.lit(known))
            own = own.withColumn("superseded_at", F.when(~F.coalesce(later, F.lit(False)), F.col("superseded_at")))
        shut = f"{self.path}/closures/{table}"
        if not self._exists(shut):
            return own
        done = self.manifests().select("batch_id", "attempt")
        ends = self.spark.read.schema(CLOSURE).option("recursiveFileLookup", "true").parquet(shut)
        few = ends.count() <= self.MET  # as footers tell: all versions stay where they are
        ends = ends.join(done, ["batch_id", "attempt"], "left_semi")
        if known is not None:
            ends = ends.where(F.col("superseded_at") <= F.to_timestamp(F.lit(known)))
        ends = ends.groupBy("id").agg(F.min_by("valid_to", "superseded_at").alias("_to"), F.min("superseded_at").alias("_at"))
        out = own.join(F.broadcast(ends) if few else ends, "id", "left")
        return out.withColumns({"superseded_at": F.coalesce("superseded_at", "_at"), "valid_to": F.coalesce("_to", "valid_to")}).drop("_to", "_at")

    def live(self, table: str) -> DataFrame | None:
        rows = self.rows(table)
        return None if rows is None else rows.where("superseded_at is null")

    def as_of(self, table: str, known: str, valid: str | None = None, key: Sequence[str] = ()) -> DataFrame | None:
        """An extension, on both axes: what the store held at a time of system time, as it was written then; with ``valid``, what held on that day.

        A version that a later load ended has the end that was known then: the open one.
        On the axis of validity a superseded version still speaks for the days up to the end
        that its successor gave it; one whose end wasn't shortened was corrected as a whole
        and speaks for none. Where versions of a ``key`` both speak for a day, since one came
        in late, the one recorded last does.
        """
        rows = self.rows(table, known=known)
        if rows is None:
            return None
        rows = rows.where(F.col("recorded_at") <= F.to_timestamp(F.lit(known)))
        if valid is None:
            return rows.where("superseded_at is null")
        day, open_end = F.to_date(F.lit(valid)), F.col("valid_to").isNull() | (F.col("valid_to") == F.lit("9999-12-31").cast("date"))
        spoke = F.col("superseded_at").isNull() | ~open_end
        rows = rows.where(spoke & (F.col("valid_from") <= day) & (open_end | (F.col("valid_to") > day)))
        if not key:
            return rows
        last = Window.partitionBy(*key).orderBy(F.desc("recorded_at"), F.desc("valid_from"), "id")
        return rows.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")

    def record(self, history: str, rows: DataFrame) -> None:
        """Appends rows to one of HISTORIES; columns that are not given are null."""
        schema = T._parse_datatype_string(HISTORIES[history])
        none = {f.name: F.lit(None) for f in schema.fields if f.name not in rows.columns}
        rows.withColumns(none).select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.mode("append").parquet(f"{self.path}/gold/{history}")

    def history(self, name: str) -> DataFrame:
        place = f"{self.path}/gold/{name}"
        return self.spark.read.schema(HISTORIES[name]).parquet(place) if self._exists(place) else self.spark.createDataFrame([], HISTORIES[name])


def folder_of(batch_id: str) -> str:
    """A folder name for any id: it holds neither separators nor the sign of a partition value."""
    return "batch-" + batch_id.encode().hex()


def _to_json(manifest: dict) -> dict:
    """Dates and times as ISO text."""
    return {k: v.isoformat() if isinstance(v, dt.date) else v for k, v in manifest.items()}


def _from_json(manifest: dict, schema: T.StructType) -> dict:
    read = {"date": dt.date.fromisoformat, "timestamp": dt.datetime.fromisoformat}
    kinds = {f.name: f.dataType.typeName() for f in schema.fields}
    return {k: read[kinds[k]](v) if v is not None and kinds.get(k) in read else v for k, v in manifest.items()}


class NoDoorbell:
    """S-21: the default publisher; readers poll, so nothing is lost without it."""

    def ring(self, manifest: dict) -> None:
        return None


class KafkaDoorbell:
    """S-21: a JSON manifest to a topic, where a broker is configured; it never raises."""

    def __init__(self, spark: SparkSession, servers: str, topic: str):
        self.spark, self.servers, self.topic = spark, servers, topic

    @staticmethod
    def message(manifest: dict) -> tuple[str, str]:
        """Key and JSON value; dates and times as ISO text."""
        return str(manifest["batch_id"]), json.dumps(manifest, default=lambda v: v.isoformat() if hasattr(v, "isoformat") else str(v), sort_keys=True)

    def ring(self, manifest: dict) -> None:
        try:
            row = self.spark.createDataFrame([self.message(manifest)], "key string, value string")
            row.write.format("kafka").option("kafka.bootstrap.servers", self.servers).option("topic", self.topic).save()
        except Exception:  # noqa: BLE001  a doorbell is a hint
            return None
