"""Silver stored in buckets by vehicle: reports per vehicle need no shuffle of the messages.

A bucketed run is a table of the catalog over a folder of its own.  The folder's
name tells the number of buckets, so another session can register it again
(``open_bucketed_silver``).  A bucket is read by one task; a run in which one
vehicle fills a bucket far beyond the others is therefore read as plain files,
whose reports aggregate in every task and shuffle one row per vehicle and task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.schemas import SILVER
from telemetry_lake.stamps import compact_stamp

BUCKET_KEY = "vin"
SKEW = 4.0  # a bucket this many times the mean is too large for one task ...
SMALL = 256 << 20  # ... if it also holds more bytes than this


def bucketed_run_path(root: str, processed_at: datetime | str, buckets: int) -> str:
    return f"{root.rstrip('/')}/by_vin_{compact_stamp(processed_at)}_{buckets}_buckets"


def write_bucketed_silver(silver: DataFrame, root: str, processed_at: datetime | str, table: str, buckets: int) -> str:
    """Store a silver run in ``buckets`` buckets by vehicle as the catalog table ``table``; returns its folder.

    Rows are rebalanced by vehicle before, so a bucket has few files, and
    adaptive execution writes a vehicle with a large share of the rows from
    several tasks.  An existing table or run is an error.
    """
    path = bucketed_run_path(root, processed_at, buckets)
    (
        silver.select(*SILVER.fieldNames())
        .hint("rebalance", buckets, BUCKET_KEY)
        .write.bucketBy(buckets, BUCKET_KEY)
        .option("path", path)
        .saveAsTable(table)
    )
    return path


def open_bucketed_silver(spark: SparkSession, path: str, table: str) -> None:
    """Register a bucketed run in the catalog of this session's application."""
    buckets = int(path.rstrip("/").rsplit("_", 2)[1])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SILVER.fields)
    location = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {table} ({fields}) USING parquet CLUSTERED BY ({BUCKET_KEY}) INTO {buckets} BUCKETS "
        f"LOCATION '{location}'"
    )


def bucket_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Bytes of each bucket's files: bucket, files, bytes (no file is opened)."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    )
    bucket = F.regexp_extract("path", r"_([0-9]+)\.c[0-9]+[^/]*$", 1).cast("int")
    return files.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )


def read_bucketed_silver(
    spark: SparkSession, path: str, table: str, skew: float = SKEW, small: int = SMALL
) -> DataFrame:
    """A bucketed run: as the bucketed table, or as plain files if a bucket is too large for one task.

    Too large is a bucket of more than ``small`` bytes and ``skew`` times the
    mean of all buckets.  Both readings give the same rows.
    """
    buckets = int(path.rstrip("/").rsplit("_", 2)[1])
    largest, total = bucket_sizes(spark, path).agg(F.max("bytes"), F.sum("bytes")).first()
    if largest is not None and largest > max(small, skew * total / buckets):
        return spark.read.schema(SILVER).parquet(path)
    return spark.table(table)
