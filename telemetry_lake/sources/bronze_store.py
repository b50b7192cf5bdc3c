"""Bronze dataset: Parquet partitioned by UTC date, then hour."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.schemas import BRONZE, BRONZE_DATA, PARTITION_KEYS
from telemetry_lake.sources.versions import current_path, hadoop, new_version, publish
from telemetry_lake.stamps import compact_stamp, utc_now

WRITE_MODES = ("replace", "overwrite", "append", "errorifexists", "ignore")


def write_bronze(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    max_records_per_file: int = 5_000_000,
    observation: Observation | None = None,
    file_prefix: str = "part",
) -> str:
    """Write bronze rows under ``path/partition_date=.../partition_hour=...``.

    ``replace`` replaces the whole dataset (the reference's behaviour) by a new
    version, switched to when all of it is written; ``overwrite`` does so in
    place, deleting first; ``append`` adds files (the older behaviour) to the
    version that counts.  Rows are rebalanced on the
    keys first: each hour goes to few tasks (few files per directory), and
    AQE splits an hour that holds a large share of the rows instead of
    writing it from one task.  NULL keys land in
    ``__HIVE_DEFAULT_PARTITION__`` and read back as NULL.
    Never overwrite a path the same plan reads from.  Data files are named
    ``<file_prefix>-...``.

    ``observation`` receives ``records`` = rows written.  It is attached after
    the rebalance, i.e. in the write (result) stage, where Spark applies each
    partition's metric once even when tasks or lost map outputs are re-run.
    """
    if mode not in WRITE_MODES:
        raise ValueError(f"mode must be one of {WRITE_MODES}")
    spark, version = df.sparkSession, None
    if mode == "replace":
        version = new_version(compact_stamp(utc_now()))
        target, mode = f"{path.rstrip('/')}/{version}", "errorifexists"
    else:
        target = current_path(spark, path)
    out = df.select(*BRONZE.fieldNames()).hint("rebalance", *PARTITION_KEYS)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("records"))
    (
        out.write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("mapreduce.output.basename", file_prefix)
        .partitionBy(*PARTITION_KEYS)
        .parquet(target)
    )
    if version:
        publish(spark, path, version)
    return path


def remove_files(spark: SparkSession, path: str, file_prefix: str) -> int:
    """Delete the bronze files named ``<file_prefix>-...``; returns their number."""
    _, fs, root = hadoop(spark, current_path(spark, path))
    folders = "/".join(f"{key}=*" for key in PARTITION_KEYS)
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"{folders}/{file_prefix}-*"))
    for status in found or []:
        fs.delete(status.getPath(), False)
    return len(found or [])


def read_bronze(
    spark: SparkSession,
    path: str,
    with_keys: bool = True,
    date_from: date | str | None = None,
    date_to: date | str | None = None,
    with_file_name: bool = False,
) -> DataFrame:
    """Read the bronze dataset (the version that counts) with the declared schema.

    The declared schema keeps ``partition_hour`` a two-digit string and
    ``partition_date`` a DATE.  ``date_from`` / ``date_to`` (inclusive) prune
    directories.  ``with_keys=False`` drops the key columns (the row-count
    scan of the reference).  ``with_file_name=True`` adds ``filename``, the
    data file of each row (from the ``_metadata`` column).
    """
    df = spark.read.schema(BRONZE).parquet(current_path(spark, path))
    if with_file_name:
        df = df.withColumn("filename", F.col("_metadata.file_path"))
    if date_from is not None:
        df = df.where(F.col("partition_date") >= F.lit(str(date_from)).cast("date"))
    if date_to is not None:
        df = df.where(F.col("partition_date") <= F.lit(str(date_to)).cast("date"))
    if not with_keys:
        df = df.select(*BRONZE_DATA.fieldNames(), *(["filename"] if with_file_name else []))
    return df


def bronze_files(bronze: DataFrame) -> DataFrame:
    """One row per data file of a bronze read: file_path, row_count (sorted)."""
    return (
        bronze.select(F.col("_metadata.file_path").alias("file_path"))
        .groupBy("file_path")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy("file_path")
    )


def partition_counts(bronze: DataFrame) -> DataFrame:
    """Rows per (partition_date, partition_hour) directory."""
    return bronze.groupBy(*PARTITION_KEYS).agg(F.count(F.lit(1)).alias("message_count"))
