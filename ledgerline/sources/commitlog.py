"""An ordered log of commits in the shared file system, and the live index whose runs it names (S-19, S-20, U-15, J-02).

An entry is a numbered JSON file. It is written under a temporary name and renamed onto
its number, which fails if the number is taken, so of two writers one commits and the
other reads what came in between. The file system must refuse to rename onto a file that
exists, as HDFS does; a store without this needs a lock of its own around ``append``.
Every EVERY entries the state is kept as a snapshot, so opening a log reads one snapshot
and fewer than EVERY + 1 entries, however long it is.

A table's live index is a log-structured merge tree of runs: Parquet tables of live
rows that a commit adds and of ids that it removes, in BUCKETS folders by the hash of
the key. A commit adds a run of level 0. When FANOUT runs stand on a level, they and
those below are merged into one of the next level, in which added and removed rows
cancel; removals whose rows lie deeper stay. So a table has FANOUT runs a level at most
and a logarithmic number of levels, and a load reads the buckets of its own keys only.
Merged runs stay on disk for readers of earlier states until ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EVERY, BUCKETS, FANOUT = 16, 64, 4
#: Of the store's tables: hashes and ids are hex text, of which it keeps about half.
CODEC = "zstd"


class Conflict(RuntimeError):
    """A commit since the state that a load has read touched one of its keys: the load has to be done again."""


class SharedFiles:
    """Small files in the file system that Spark uses."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        place, fs = self._at(path)
        return fs.exists(place)

    def names(self, folder: str) -> list[str]:
        place, fs = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []

    def read(self, path: str) -> str:
        place, fs = self._at(path)
        stream = fs.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def head(self, path: str, size: int) -> bytes:
        """The first bytes of a file, which may be given as a URI."""
        place = self._jvm.org.apache.hadoop.fs.Path(self._jvm.java.net.URI(path))
        stream = place.getFileSystem(self._conf).open(place)
        try:
            return bytes(stream.readNBytes(size))
        finally:
            stream.close()

    def move(self, path: str, to: str) -> None:
        """Gives a folder another place in the same file system; nothing is copied."""
        place, fs = self._at(path)
        folder, _ = self._at(to.rpartition("/")[0])
        if not fs.mkdirs(folder) or not fs.rename(place, self._at(to)[0]):
            raise OSError(f"{path} can't be moved to {to}")

    def delete(self, path: str) -> None:
        place, fs = self._at(path)
        fs.delete(place, True)

    def put(self, path: str, text: str, replace: bool = False) -> bool:
        """A file that is there whole or not at all; False if it exists already."""
        folder, name = path.rsplit("/", 1)
        draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
        place, fs = self._at(draft)
        out = fs.create(place, False)
        out.write(bytearray(text.encode()))
        out.close()
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        ways = self._jvm.java.lang.reflect.Array.newInstance(self._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 1)
        ways[0] = rename.OVERWRITE if replace else rename.NONE
        try:
            self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), self._conf).rename(place, self._at(path)[0], ways)
            return True
        except Py4JJavaError as e:
            fs.delete(place, False)
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                return False
            raise


@dataclass(frozen=True)
class Run:
    """Rows of a table's live index; schema: JSON, without the bucket, which is the folder."""

    table: str
    path: str
    level: int
    buckets: tuple[int, ...]
    schema: str


@dataclass(frozen=True)
class State:
    """What is committed up to a version: the runs of each table."""

    version: int = 0
    runs: dict[str, tuple[Run, ...]] = field(default_factory=dict)

    def then(self, entry: dict) -> State:
        gone = set(entry["merged"])
        runs = {t: tuple(r for r in rs if r.path not in gone) for t, rs in self.runs.items()}
        for r in entry["runs"]:
            run = _run(r)
            runs[run.table] = (*runs.get(run.table, ()), run)
        return State(entry["version"], runs)


def _run(row: dict) -> Run:
    return Run(**(row | {"buckets": tuple(row["buckets"])}))


class CommitLog:
    def __init__(self, spark: SparkSession, path: str):
        self.files, self.path = SharedFiles(spark), path

    def _entry(self, version: int) -> str:
        return f"{self.path}/{version:020d}.json"

    def entries(self, after: int) -> list[dict]:
        """The commits after a version, in order."""
        out = []
        while self.files.exists(at := self._entry(after + len(out) + 1)):
            out.append(json.loads(self.files.read(at)))
        return out

    def _snapshot(self) -> State:
        mark = f"{self.path}/snapshots/last"
        if not self.files.exists(mark):
            return State()
        kept = json.loads(self.files.read(f"{self.path}/snapshots/{self.files.read(mark)}.json"))
        return State(kept["version"], {t: tuple(map(_run, rs)) for t, rs in kept["runs"].items()})

    def state(self, upto: int | None = None) -> State:
        """What is committed, up to a version since the last snapshot."""
        state = self._snapshot()
        for entry in self.entries(state.version):
            if upto is None or entry["version"] <= upto:
                state = state.then(entry)
        return state

    def append(self, version: int, batch_id: str | None, runs: Sequence[Run] = (), merged: Sequence[str] = (), **more: object) -> bool:
        """Commits an entry as ``version``; False if that version is taken."""
        entry = {"version": version, "batch_id": batch_id, "runs": [asdict(r) for r in runs], "merged": list(merged)} | more
        if not self.files.put(self._entry(version), json.dumps(entry)):
            return False
        if version % EVERY == 0:
            self._keep(version)
        return True

    def _keep(self, version: int) -> None:
        """A snapshot as of a version. Should it be missed, readers start from the one before."""
        state = self.state(version)
        if state.version == version:
            text = json.dumps({"version": version, "runs": {t: [asdict(r) for r in rs] for t, rs in state.runs.items()}})
            self.files.put(f"{self.path}/snapshots/{version:020d}.json", text)
            self.files.put(f"{self.path}/snapshots/last", f"{version:020d}", replace=True)


def key_hash(key: Sequence[str]) -> Column:
    """Equal for equal keys, nulls included; different keys may share it."""
    return F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in key])


def bucket(hash_: Column) -> Column:
    return F.pmod(hash_, F.lit(BUCKETS)).cast("int")


#: A load's rows are dealt out by this many parts of each bucket.
PARTS = 4


def part(key: Sequence[str]) -> Column:
    """Of a bucket, by the key: rows that are dealt out by parts lie together by bucket, so that a run of them is written where they stand."""
    return F.pmod(key_hash(key), F.lit(BUCKETS * PARTS)).cast("int")


class LiveIndex:
    """The live rows of a store's tables, by key, as a tree of runs."""

    def __init__(self, spark: SparkSession, log: CommitLog, path: str):
        self.spark, self.log, self.path = spark, log, path

    def write(self, table: str, rows: DataFrame, level: int = 0, dealt: bool = False) -> Run | None:
        """A run of (key_hash, id, removed, and what a reader needs of live rows); nobody reads it before a commit names it. dealt: the rows lie by ``part``."""
        place = f"{self.path}/{table}/{uuid.uuid4().hex}"
        # a rebalance lets adaptive execution merge small buckets and split large ones
        held = rows.withColumn("bucket", bucket(F.col("key_hash")))
        held = (held if dealt else held.hint("rebalance", "bucket")).sortWithinPartitions("bucket", "key_hash")
        held.write.partitionBy("bucket").parquet(place, compression=CODEC)
        found = [int(n.partition("=")[2]) for n in self.log.files.names(place) if n.startswith("bucket=")]
        return Run(table, place, level, tuple(found), rows.schema.json()) if found else None

    def read(self, runs: Sequence[Run], buckets: set[int] | None = None) -> DataFrame | None:
        """The rows of runs, in some buckets or all; null without any."""
        paths = [f"{r.path}/bucket={b}" for r in runs for b in r.buckets if buckets is None or b in buckets]
        if not paths:
            return None
        return self.spark.read.schema(T.StructType.fromJson(json.loads(runs[-1].schema))).parquet(*paths)

    def live(self, state: State, table: str, incoming: DataFrame, key: Sequence[str]) -> DataFrame | None:
        """The live rows whose keys may come in: those in the incoming keys' buckets; null if the table has no run."""
        runs = state.runs.get(table, ())
        if not runs:
            return None
        asked = {r[0] for r in incoming.select(bucket(key_hash(key))).distinct().collect()}  # BUCKETS at most
        rows = self.read(runs, asked)
        if rows is None:
            return self.spark.createDataFrame([], T.StructType.fromJson(json.loads(runs[-1].schema))).drop("key_hash", "removed")
        return self.current(rows).drop("key_hash", "removed")

    @staticmethod
    def current(rows: DataFrame) -> DataFrame:
        """Added rows that nothing removes; ids are versions', so each is added and removed once."""
        if rows.where("removed").isEmpty():  # as footers tell; a join would move all rows
            return rows.where("not removed")
        return rows.where("not removed").join(rows.where("removed").select("id"), "id", "left_anti")

    def clash(self, own: Sequence[Run], others: Sequence[Run]) -> bool:
        """Whether two commits touch a key: buckets first, then the hashes that both have."""
        for a in own:
            for b in others:
                both = set(a.buckets) & set(b.buckets)
                if a.table == b.table and both:
                    mine, theirs = (self.read([r], both).select("key_hash") for r in (a, b))
                    if not mine.join(theirs, "key_hash", "left_semi").isEmpty():
                        return True
        return False

    def compact(self, table: str) -> bool:
        """Merges a full level and those below into the next; False if there is nothing to do or another writer was first."""
        state = self.log.state()
        runs = state.runs.get(table, ())
        full = [n for n in range(1 + max((r.level for r in runs), default=-1)) if sum(r.level == n for r in runs) >= FANOUT]
        if not full:
            return False
        old = [r for r in runs if r.level <= full[0]]
        rows = self.read(old)
        kept = self.current(rows).select(*rows.columns)
        if len(old) < len(runs):  # a removal whose row isn't here has it further down
            own = rows.where("not removed").select("id")
            kept = kept.unionByName(rows.where("removed").join(own, "id", "left_anti").select(*rows.columns))
        made = self.write(table, kept, full[0] + 1)
        gone, seen = {r.path for r in old}, state.version
        while True:
            for entry in self.log.entries(seen):
                if gone & set(entry["merged"]):
                    return False
                seen = entry["version"]
            if self.log.append(seen + 1, None, [made] if made else [], sorted(gone)):
                return True

    def vacuum(self, table: str) -> int:
        """Deletes runs that the latest state doesn't name; to be called while no load is under way. Returns how many."""
        named = {r.path for r in self.log.state().runs.get(table, ())}
        old = [f"{self.path}/{table}/{n}" for n in self.log.files.names(f"{self.path}/{table}")]
        for place in old:
            if place not in named:
                self.log.files.delete(place)
        return sum(p not in named for p in old)
