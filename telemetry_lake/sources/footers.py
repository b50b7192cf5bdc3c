"""Row counts and time ranges of bronze from the Parquet footers alone.

Spark answers COUNT, MIN and MAX of whole files from their footers when the
DataSource V2 reader pushes the aggregate down; grouping by the partition keys
is pushed down too.  Only whole-number columns are asked for: footers hold no
usable limits of texts and timestamps, and those of doubles break on NaN.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.schemas import PARTITION_KEYS
from telemetry_lake.sources.bronze_store import read_bronze


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application that reads Parquet through the V2 reader
    with aggregates pushed down; the caller's settings stay as they are."""
    session = spark.newSession()
    v1 = session.conf.get("spark.sql.sources.useV1SourceList").split(",")
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in v1 if s.strip() != "parquet"))
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    return session


def footer_partitions(spark: SparkSession, path: str) -> DataFrame:
    """Per hour folder, without reading a row: the keys, message_count, first and last epoch milliseconds.

    A message without time lies in the folder without keys, whose footers have
    no limits: it is counted by a scan of its own and has NULL limits.
    """
    bronze = read_bronze(footer_session(spark), path)
    timed = bronze.where(F.col("partition_date").isNotNull()).groupBy(*PARTITION_KEYS).agg(
        F.count(F.lit(1)).alias("message_count"), F.min("timestamp").alias("first_ms"), F.max("timestamp").alias("last_ms")
    )
    timeless = bronze.where(F.col("partition_date").isNull()).groupBy(*PARTITION_KEYS).agg(
        F.count(F.lit(1)).alias("message_count")
    )
    none = F.lit(None).cast("bigint")
    return timed.unionByName(timeless.withColumns({"first_ms": none, "last_ms": none}))


def footer_stats(spark: SparkSession, path: str) -> DataFrame:
    """One row without reading a row of data: total_records, earliest_message, latest_message."""
    return footer_partitions(spark, path).agg(
        F.coalesce(F.sum("message_count"), F.lit(0)).alias("total_records"),
        F.timestamp_millis(F.min("first_ms")).alias("earliest_message"),
        F.timestamp_millis(F.max("last_ms")).alias("latest_message"),
    )
