"""The intake gate, content dedup and format of uploaded files (S-09, S-11 to S-17)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_BYTES = 200 * 1024 * 1024
EXTENSIONS = ("csv", "json", "ndjson", "pdf")


def files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """S-16: path, name, length, content. Spark's reader skips files without bytes; the gate refuses them by their length."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    return reader.load(path).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "content")


def extension(name: Column) -> Column:
    return F.lower(F.when(F.contains(name, F.lit(".")), F.element_at(F.split(name, r"\."), -1)))


def refusal(name: Column, length: Column) -> Column:
    """S-12: the first gate that refuses, cheapest first; null when accepted."""
    return (
        F.when(F.coalesce(length, F.lit(0)) == 0, "EMPTY_FILE")
        .when(length > MAX_BYTES, "FILE_TOO_LARGE")
        .when(~F.coalesce(extension(name).isin(*EXTENSIONS), F.lit(False)), "UNSUPPORTED_EXTENSION")
    )


def content_format(name: Column) -> Column:
    """S-17: .json is read as NDJSON."""
    ext = extension(name)
    return F.when(ext == "csv", "CSV").when(ext.isin("json", "ndjson"), "NDJSON").when(ext == "pdf", "PDF")


def type_gate(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """S-13: adds ``type_refusal``: UNKNOWN_TYPE or OUT_OF_SCOPE. registry: doc_type_code, in_scope."""
    known = registry.select("doc_type_code", F.col("in_scope").alias("_scope"))
    out = rows.join(known, "doc_type_code", "left")
    return out.withColumn("type_refusal", F.when(F.col("_scope").isNull(), "UNKNOWN_TYPE").when(~F.col("_scope"), "OUT_OF_SCOPE")).drop("_scope")


def with_source(rows: DataFrame, refs: DataFrame) -> DataFrame:
    """S-11, J-09: document type and source system of each reference."""
    return rows.join(refs.select("ref", "doc_type_code", "source_system"), "ref")


def first_copies(arrivals: DataFrame, ledger: DataFrame) -> DataFrame:
    """S-15: each arrival with the ingest id that holds its bytes: the ledger's, or that of the first arrival.

    arrivals: ingest_id, tenant, content_hash, received_at. ledger: the same columns.
    """
    both = ledger.select("ingest_id", "tenant", "content_hash", "received_at", F.lit(0).alias("new")).unionByName(arrivals.select("ingest_id", "tenant", "content_hash", "received_at", F.lit(1).alias("new")))
    held = both.groupBy("tenant", "content_hash").agg(F.min(F.struct("new", "received_at", "ingest_id")).alias("first"))
    out = arrivals.join(held, ["tenant", "content_hash"])
    return out.select("ingest_id", "tenant", "content_hash", F.col("first.ingest_id").alias("held_by"), (F.col("first.ingest_id") != F.col("ingest_id")).alias("duplicate"))


def preferred(listing: DataFrame, gstin: str, period: str) -> DataFrame:
    """S-09: of the files whose path names a GSTIN and period, one per reference: json, then csv, then pdf, then by name."""
    rank = F.array_position(F.array(*[F.lit(x) for x in ("json", "csv", "pdf")]), extension(F.col("name")))
    mine = listing.where(F.contains("path", F.lit(gstin)) & F.contains("path", F.lit(period)) & (rank > 0))
    w = Window.partitionBy("ref").orderBy(rank, "name")
    return mine.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


class NullScanner:
    """S-14: the virus-scan port's default: nothing is scanned, everything is clean."""

    def verdicts(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("scan", F.lit("CLEAN"))


class LiveConnector:
    """S-10: a portal connector; it refuses to fetch until it is configured."""

    def __init__(self, name: str, endpoint: str | None = None):
        self.name, self.endpoint = name, endpoint

    def fetch(self, spark: SparkSession, gstin: str, period: str) -> DataFrame:
        if not self.endpoint:
            raise RuntimeError(f"connector {self.name} has no endpoint configured")
        raise NotImplementedError(f"connector {self.name}: an HTTP client is out of scope; land files and use files()")


CONNECTORS = {n: LiveConnector(n) for n in ("GSTN", "ICEGATE", "DGFT", "IRP", "EWAY_BILL", "MCA", "RBI")}
