"""Silver and gold outputs: run folders, latest run, report listing."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from telemetry_lake.schemas import GOLD_REPORTS, SILVER, SILVER_RUN_PREFIX
from telemetry_lake.sources.versions import current_path, hadoop
from telemetry_lake.stamps import compact_stamp


def silver_run_path(silver_root: str, processed_at: datetime | str) -> str:
    return f"{silver_root.rstrip('/')}/{SILVER_RUN_PREFIX}{compact_stamp(processed_at)}"


def write_silver(df: DataFrame, silver_root: str, processed_at: datetime | str) -> str:
    """New folder per run; older runs are kept; an existing run is an error."""
    path = silver_run_path(silver_root, processed_at)
    df.write.mode("errorifexists").parquet(path)
    return path


def _child_dirs(spark: SparkSession, root: str) -> list[str]:
    """Names of the folders directly below ``root`` (Hadoop FS, any scheme)."""
    _, fs, p = hadoop(spark, root)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()]


def latest_silver_path(spark: SparkSession, silver_root: str) -> str | None:
    """Latest finished silver run by the stamp in its name (stable on object
    stores, unlike modification times); None when there is none.  A run that
    has no success marker is unfinished or failed and is passed over."""
    runs = sorted((n for n in _child_dirs(spark, silver_root) if n.startswith(SILVER_RUN_PREFIX)), reverse=True)
    for run in runs:
        path = f"{silver_root.rstrip('/')}/{run}"
        _, fs, marker = hadoop(spark, f"{path}/_SUCCESS")
        if fs.exists(marker):
            return path
    return None


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """One silver run with the declared schema (no footer is read for it)."""
    return spark.read.schema(SILVER).parquet(path)


def gold_path(gold_root: str, report: str) -> str:
    return f"{gold_root.rstrip('/')}/{report}"


def write_gold(df: DataFrame, gold_root: str, report: str) -> str:
    """One fixed folder per report below a version of gold (see ``sources.versions``)."""
    path = gold_path(gold_root, report)
    df.write.mode("overwrite").parquet(path)
    return path


def read_gold(spark: SparkSession, gold_root: str, report: str) -> DataFrame:
    """A report of the gold version that counts."""
    return spark.read.parquet(gold_path(current_path(spark, gold_root), report))


def list_reports(spark: SparkSession, gold_root: str) -> DataFrame:
    """Parquet files of the gold version that counts: path, report, modified (sorted by path)."""
    gold_root = current_path(spark, gold_root)
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(gold_root)
            .select("path", F.col("modificationTime").alias("modified"))
        )
    except AnalysisException:
        return spark.createDataFrame([], "path string, report string, modified timestamp")
    report = F.regexp_extract("path", "/(" + "|".join(GOLD_REPORTS) + ")/", 1)
    return files.select("path", F.nullif(report, F.lit("")).alias("report"), "modified").orderBy("path")


def gold_stats(reports: DataFrame) -> DataFrame:
    """Per report type: reports (a report is one folder, whatever its number of
    part files), part files and latest file (from ``list_reports``)."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    return reports.groupBy("report").agg(
        F.count_distinct(folder).alias("reports"),
        F.count(F.lit(1)).alias("files"),
        F.max("path").alias("latest_file"),
    ).orderBy("report")


def register_views(spark: SparkSession, bronze_path: str, silver_root: str | None = None,
                   gold_root: str | None = None) -> list[str]:
    """Temp views for SQL users: ``bronze``, ``silver`` (latest run) and one
    per existing gold report.  Returns the registered names."""
    from telemetry_lake.sources.bronze_store import read_bronze

    names = []
    read_bronze(spark, bronze_path).createOrReplaceTempView("bronze")
    names.append("bronze")
    if silver_root:
        latest = latest_silver_path(spark, silver_root)
        if latest:
            read_silver(spark, latest).createOrReplaceTempView("silver")
            names.append("silver")
    if gold_root:
        gold_root = current_path(spark, gold_root)
        present = set(_child_dirs(spark, gold_root))
        for report in GOLD_REPORTS:
            if report in present:
                spark.read.parquet(gold_path(gold_root, report)).createOrReplaceTempView(report)
                names.append(report)
    return names
