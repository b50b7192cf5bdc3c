"""

Every query reads the driver's ``events`` table and derives vehicle messages
from it (``telemetry_lake.sources.fixtures``); the oracle repeats the same
derivation in DuckDB SQL (``MESSAGES_SQL``) and then computes each result
independently.  Run stamps are fixed literals on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake import operators as op
from telemetry_lake.operators import stats
from telemetry_lake.operators.run_stats import STANDARD_ERROR, append_stats, merged_stats
from telemetry_lake.operators.vehicle_state import read_state, state_report, update_state
from telemetry_lake.plans.jobs import LakeConfig, run_all, run_bronze, run_gold, run_silver
from telemetry_lake.schemas import DEFAULT_PATTERNS, GOLD_REPORTS, RAW, STRICT_PATTERNS
from telemetry_lake.session import pin_utc, scratch_path
from telemetry_lake.sources.bronze_store import bronze_files, partition_counts, read_bronze, write_bronze
from telemetry_lake.sources.buckets import read_bucketed_silver, write_bucketed_silver
from telemetry_lake.sources.fixtures import read_messages
from telemetry_lake.sources.footers import footer_partitions, footer_stats
from telemetry_lake.sources.landing import read_landing, write_landing
from telemetry_lake.sources.layers import (
    gold_stats,
    latest_silver_path,
    list_reports,
    read_gold,
    read_silver,
    register_views,
    write_silver,
)
from telemetry_lake.sources.paged import fetch_pages, read_pages
from telemetry_lake.streaming.incremental import run_stream_to_bronze
from telemetry_lake.streaming.pages import stream_pages_to_bronze

# Fixed run stamps shared by queries and oracle.
FETCHED_AT = "2024-02-01T00:00:00"
INGESTED_AT = "2024-02-01T00:00:01"
BATCH_ID = "bronze_20240201_000001"
SILVER_AT = "20240201_000002"
GOLD_AT = "20240201_000003"
REPORT_TZ = "Asia/Jerusalem"
PAGE_SIZE = 1000  # messages per API response in the landing zone


# --- Spark side -----------------------------------------------------------------


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return op.to_bronze(
        read_messages(spark, sf_dir), batch_id=BATCH_ID, fetched_at=FETCHED_AT, ingested_at=INGESTED_AT
    )


def _silver(spark: SparkSession, sf_dir: str, sort: bool = True) -> DataFrame:
    return op.to_silver(_bronze(spark, sf_dir), SILVER_AT, sort=sort)


def _round_trip_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = write_bronze(_bronze(spark, sf_dir), scratch_path(spark, "bronze"))
    return read_bronze(spark, path)


def q_bronze_standardize(spark, sf_dir):
    return _bronze(spark, sf_dir)


def q_bronze_partition_counts(spark, sf_dir):
    return partition_counts(_round_trip_bronze(spark, sf_dir))


def q_bronze_round_trip(spark, sf_dir):
    return _round_trip_bronze(spark, sf_dir)


def q_row_count(spark, sf_dir):
    bronze = read_bronze(spark, write_bronze(_bronze(spark, sf_dir), scratch_path(spark, "bronze")),
                         with_keys=False)
    return bronze.agg(F.count(F.lit(1)).alias("row_count"))


def _landing(spark: SparkSession, sf_dir: str) -> str:
    """The events' messages stored once as API responses (one line each)."""
    pin_utc(spark)
    return write_landing(read_messages(spark, sf_dir, PAGE_SIZE), scratch_path(spark, "landing"), "page",
                         file_per_page=False)


def q_landing_bronze(spark, sf_dir):
    raw = read_landing(spark, _landing(spark, sf_dir), multi_line=False, fetched_at=FETCHED_AT)
    return op.to_bronze(raw, batch_id=BATCH_ID, ingested_at=INGESTED_AT)


def _api(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """(url of a page, wanted amount): the events' messages as stored responses of a paged API."""
    pin_utc(spark)
    messages = read_messages(spark, sf_dir, PAGE_SIZE)
    root = write_landing(messages, scratch_path(spark, "api"), "page", file_per_page=True)
    return root + "/page={page}", messages.count()


def q_paged_bronze(spark, sf_dir):
    """Pages fetched by the data source on the executors, stored once, then read."""
    url, total = _api(spark, sf_dir)
    pages = fetch_pages(spark, url, total, PAGE_SIZE, scratch_path(spark, "pages"))
    return op.to_bronze(read_pages(spark, pages), batch_id=BATCH_ID,
                        fetched_at=FETCHED_AT, ingested_at=INGESTED_AT)


def q_paged_stream_bronze(spark, sf_dir):
    """The same pages as a stream with page numbers as offsets."""
    url, total = _api(spark, sf_dir)
    out = scratch_path(spark, "paged_stream_bronze")
    stream_pages_to_bronze(spark, url, total, PAGE_SIZE, scratch_path(spark, "pages"), out, scratch_path(spark, "pages_ckpt"),
                           pages_per_batch=64, batch_id=BATCH_ID, fetched_at=FETCHED_AT, ingested_at=INGESTED_AT)
    return read_bronze(spark, out)


def q_stream_bronze(spark, sf_dir):
    landing = _landing(spark, sf_dir)
    out = scratch_path(spark, "stream_bronze")
    run_stream_to_bronze(spark, landing, out, scratch_path(spark, "stream_ckpt"),
                         max_files_per_trigger=32, multi_line=False, batch_id=BATCH_ID, fetched_at=FETCHED_AT,
                         ingested_at=INGESTED_AT)
    return read_bronze(spark, out)


PIPELINE_AT = datetime(2024, 2, 1, 0, 0, 3)  # stamps GOLD_AT on the reports


def _pipeline(spark: SparkSession, sf_dir: str) -> dict:
    """Full run on a scratch lake: landing -> bronze -> silver -> gold."""
    root = scratch_path(spark, "lake")
    cfg = LakeConfig(landing_path=_landing(spark, sf_dir), bronze_path=f"{root}/bronze",
                     silver_path=f"{root}/silver", gold_path=f"{root}/gold", multi_line=False)
    return run_all(spark, cfg, now=PIPELINE_AT)


def q_pipeline_last_state(spark, sf_dir):
    reports = _pipeline(spark, sf_dir)["stages"]["gold"]["reports_generated"]
    return spark.read.parquet(reports["vin_last_state"])


def q_pipeline_report_counts(spark, sf_dir):
    """Rows per gold report of a full run, for the reports the listing finds."""
    gold = _pipeline(spark, sf_dir)["stages"]["gold"]["reports_generated"]["vin_last_state"]
    gold_root = gold.rsplit("/", 1)[0]
    counts = None
    for report in GOLD_REPORTS:  # one small aggregate per report folder
        one = spark.read.parquet(f"{gold_root}/{report}").agg(F.count(F.lit(1)).alias("row_count"))
        one = one.select(F.lit(report).alias("report"), "row_count")
        counts = one if counts is None else counts.unionByName(one)
    listed = gold_stats(list_reports(spark, gold_root)).select("report")
    return counts.join(listed, "report", "inner")


def q_silver_clean(spark, sf_dir):
    return _silver(spark, sf_dir)


def q_silver_gear_counts(spark, sf_dir):
    return stats.gear_counts(_silver(spark, sf_dir, sort=False))


def q_vin_last_state(spark, sf_dir):
    return op.vin_last_state(_silver(spark, sf_dir, sort=False), GOLD_AT)


def q_vin_last_state_stored(spark, sf_dir):
    """The report over a stored silver run, read back with the declared schema."""
    path = write_silver(_silver(spark, sf_dir, sort=False), scratch_path(spark, "silver"), SILVER_AT)
    return op.vin_last_state(read_silver(spark, path), GOLD_AT)


def q_vin_last_state_windows(spark, sf_dir):
    """The report put together from its single parts (J1, J2)."""
    silver = _silver(spark, sf_dir, sort=False)
    report = op.latest_message_per_vin(silver)
    for column in ("front_left_door_state", "wipers_state"):
        report = report.join(op.last_component_state(silver, column, f"last_{column}"), "vin", "left")
    return report.withColumn("report_generated_timestamp", F.lit(GOLD_AT))


def q_latest_message_per_vin(spark, sf_dir):
    return op.latest_message_per_vin(_silver(spark, sf_dir, sort=False))


def q_last_door_state(spark, sf_dir):
    return op.last_component_state(
        _silver(spark, sf_dir, sort=False), "front_left_door_state", "last_front_left_door_state"
    )


def q_last_wipers_state(spark, sf_dir):
    return op.last_component_state(_silver(spark, sf_dir, sort=False), "wipers_state", "last_wipers_state")


def q_fastest_per_hour(spark, sf_dir):
    return op.fastest_per_hour(_silver(spark, sf_dir, sort=False), GOLD_AT)


def q_fastest_per_hour_local(spark, sf_dir):
    return op.fastest_per_hour(_silver(spark, sf_dir, sort=False), GOLD_AT, report_tz=REPORT_TZ)


def q_pattern_violations(spark, sf_dir):
    return op.pattern_violations(_bronze(spark, sf_dir))


def q_pattern_violations_strict(spark, sf_dir):
    return op.pattern_violations(_bronze(spark, sf_dir), patterns=STRICT_PATTERNS)


def q_bronze_stats(spark, sf_dir):
    return stats.bronze_stats(_bronze(spark, sf_dir))


def q_silver_stats(spark, sf_dir):
    return stats.silver_stats(_silver(spark, sf_dir, sort=False))


def q_last_state_stats(spark, sf_dir):
    return stats.last_state_stats(op.vin_last_state(_silver(spark, sf_dir, sort=False), GOLD_AT))


def q_manufacturer_summary(spark, sf_dir):
    return stats.manufacturer_summary(_silver(spark, sf_dir, sort=False))


def q_quality_flags(spark, sf_dir):
    return stats.with_quality_flags(_silver(spark, sf_dir, sort=False))


def q_gold_stats(spark, sf_dir):
    """Reports per type that the listing of a full run's gold folder finds."""
    last = _pipeline(spark, sf_dir)["stages"]["gold"]["reports_generated"]["vin_last_state"]
    return gold_stats(list_reports(spark, last.rsplit("/", 1)[0])).select("report", "reports")


def q_latest_silver(spark, sf_dir):
    """The latest of two finished silver runs; the newer one leaves its sort out."""
    root = scratch_path(spark, "silver")
    bronze = _bronze(spark, sf_dir)
    write_silver(op.to_silver(bronze.limit(0), "20240101_000000", sort=False), root, "20240101_000000")
    write_silver(op.to_silver(bronze, SILVER_AT, sort=False), root, SILVER_AT)
    return read_silver(spark, latest_silver_path(spark, root))


def q_bronze_file_stats(spark, sf_dir):
    """Figures of the bronze files: rows, hour folders and whether each has a file."""
    stored = _round_trip_bronze(spark, sf_dir)
    files = bronze_files(stored).agg(
        F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("total_records")
    )
    folders = partition_counts(stored).agg(F.count(F.lit(1)).alias("hour_folders"))
    return files.join(folders, F.lit(True)).select(
        "total_records", "hour_folders", (F.col("files") >= F.col("hour_folders")).alias("files_in_all_folders")
    )


def q_bronze_overwrite(spark, sf_dir):
    """Bronze written twice to one path with overwrite: the second write stays."""
    path = scratch_path(spark, "bronze")
    write_bronze(_bronze(spark, sf_dir), path)
    return read_bronze(spark, write_bronze(_bronze(spark, sf_dir), path, mode="overwrite"))


def q_bronze_append(spark, sf_dir):
    """Rows per hour after a write and an append of the same messages."""
    path = scratch_path(spark, "bronze")
    write_bronze(_bronze(spark, sf_dir), path)
    return partition_counts(read_bronze(spark, write_bronze(_bronze(spark, sf_dir), path, mode="append")))


def q_bronze_after_failed_replace(spark, sf_dir):
    """Bronze replaced by a run that fails while it writes: the rows of the run before."""
    path = scratch_path(spark, "bronze")
    write_bronze(_bronze(spark, sf_dir), path, mode="replace")
    late = F.when(F.col("vin").isNull(), F.raise_error(F.lit("no vin"))).otherwise(F.col("vin"))
    try:
        write_bronze(_bronze(spark, sf_dir).withColumn("vin", late), path, mode="replace")
    except Exception:  # noqa: BLE001 - the failure is what is asked for
        return read_bronze(spark, path)
    raise RuntimeError("the second write was to fail")


def q_gold_after_failed_run(spark, sf_dir):
    """Last states of gold after a full run and one that fails at its second report."""
    root = scratch_path(spark, "lake")
    cfg = LakeConfig(landing_path=_landing(spark, sf_dir), bronze_path=f"{root}/bronze",
                     silver_path=f"{root}/silver", gold_path=f"{root}/gold", multi_line=False)
    run_all(spark, cfg, now=PIPELINE_AT)
    cfg.report_tz = "No/Such_Zone"
    if run_gold(spark, cfg, now=datetime(2024, 2, 2))["status"] != "failed":
        raise RuntimeError("the second run was to fail")
    return read_gold(spark, cfg.gold_path, "vin_last_state")


def q_gold_of_a_run(spark, sf_dir):
    """Rows per report that the listing finds after a second run without a pattern report (K5)."""
    root = scratch_path(spark, "lake")
    cfg = LakeConfig(landing_path=_landing(spark, sf_dir), bronze_path=f"{root}/bronze",
                     silver_path=f"{root}/silver", gold_path=f"{root}/gold", multi_line=False)
    run_all(spark, cfg, now=PIPELINE_AT)
    cfg.patterns = []
    run_gold(spark, cfg, now=PIPELINE_AT)
    return gold_stats(list_reports(spark, cfg.gold_path)).select("report", "reports")


def q_views_vehicle_messages(spark, sf_dir):
    """SQL over the registered relations (S5): messages per vehicle in bronze and in the latest silver run."""
    root = scratch_path(spark, "views")
    bronze = write_bronze(_bronze(spark, sf_dir), f"{root}/bronze")
    write_silver(_silver(spark, sf_dir, sort=False), f"{root}/silver", SILVER_AT)
    register_views(spark, bronze, f"{root}/silver")
    return spark.sql("""
        SELECT b.vin, b.bronze_messages, coalesce(s.silver_messages, 0) AS silver_messages
        FROM (SELECT vin, count(*) AS bronze_messages FROM bronze WHERE vin IS NOT NULL GROUP BY vin) b
        LEFT JOIN (SELECT vin, count(*) AS silver_messages FROM silver GROUP BY vin) s ON s.vin = b.vin""")


def q_empty_stage_status(spark, sf_dir):
    """Status of the bronze and silver stages over the messages of no vehicle and over all."""
    rows = []
    for name, messages in (("none", read_messages(spark, sf_dir, PAGE_SIZE).where("vin = 'no such vehicle'")),
                           ("all", read_messages(spark, sf_dir, PAGE_SIZE))):
        pin_utc(spark)
        root = scratch_path(spark, "status")
        landing = write_landing(messages, f"{root}/landing", "page", file_per_page=False)
        cfg = LakeConfig(landing_path=landing, bronze_path=f"{root}/bronze", silver_path=f"{root}/silver",
                         gold_path=f"{root}/gold", multi_line=False)
        bronze = run_bronze(spark, cfg, now=PIPELINE_AT)
        if name == "none":  # an empty bronze for the silver stage
            write_bronze(_bronze(spark, sf_dir).where("vin = 'no such vehicle'"), cfg.bronze_path)
        silver = run_silver(spark, cfg, now=PIPELINE_AT)
        rows.append((name, bronze["status"], silver["status"], bronze.get("records_fetched", 0)))
    return spark.createDataFrame(rows, "messages string, bronze string, silver string, records bigint")


BUCKETS = 16  # of the bucketed silver; on a cluster so many that a bucket fits a task


def _bucketed_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = f"silver_by_vin_{uuid.uuid4().hex}"
    path = write_bucketed_silver(_silver(spark, sf_dir, sort=False), scratch_path(spark, "by_vin"), SILVER_AT,
                                 table, BUCKETS)
    return read_bucketed_silver(spark, path, table)


def q_vin_last_state_bucketed(spark, sf_dir):
    """The report over silver in buckets by vehicle: no shuffle of the messages."""
    return op.vin_last_state(_bucketed_silver(spark, sf_dir), GOLD_AT)


def q_vin_last_state_bucketed_joins(spark, sf_dir):
    """The report's parts joined over silver in buckets (J1, J2): neither aggregates nor joins shuffle."""
    silver = _bucketed_silver(spark, sf_dir)
    report = op.latest_message_per_vin(silver)
    for column in ("front_left_door_state", "wipers_state"):
        report = report.join(op.last_component_state(silver, column, f"last_{column}"), "vin", "left")
    return report.withColumn("report_generated_timestamp", F.lit(GOLD_AT))


def q_bronze_footer_stats(spark, sf_dir):
    """Records and time range of stored bronze from the files' footers."""
    return footer_stats(spark, write_bronze(_bronze(spark, sf_dir), scratch_path(spark, "bronze")))


def q_bronze_footer_partitions(spark, sf_dir):
    """Rows, first and last time of every hour folder from the files' footers."""
    return footer_partitions(spark, write_bronze(_bronze(spark, sf_dir), scratch_path(spark, "bronze")))


def _thirds(df: DataFrame) -> list[DataFrame]:
    """All rows in three parts by vehicle and time, for increments; late and tied rows fall in all of them."""
    part = F.pmod(F.xxhash64("vin", "timestamp", "wipers_state"), F.lit(3))
    return [df.where(part == k) for k in range(3)]


def q_bronze_stats_merged(spark, sf_dir):
    """Figures of bronze appended in three batches, from one row kept per batch."""
    bronze, kept = scratch_path(spark, "bronze"), scratch_path(spark, "bronze_stats")
    for number, batch in enumerate(_thirds(_bronze(spark, sf_dir))):
        write_bronze(batch, bronze, mode="append")
        append_stats(batch, kept, f"b{number}")
    merged = merged_stats(spark.read.parquet(kept))
    exact = read_bronze(spark, bronze).agg(F.count_distinct("vin").alias("vins"),
                                           F.count_distinct("manufacturer").alias("makers")).first()
    near = [F.abs(F.col(c) - n) <= 4 * STANDARD_ERROR * n for c, n in
            (("unique_vehicles", exact.vins), ("unique_manufacturers", exact.makers))]
    return merged.select("total_records", "avg_velocity", "earliest_message", "latest_message",
                         "records_with_valid_coords", "records_with_valid_velocity",
                         near[0].alias("vehicles_within_error"), near[1].alias("manufacturers_within_error"))


def q_vin_last_state_incremental(spark, sf_dir):
    """The report from a state that three increments, one of them merged twice, brought up to date."""
    root = scratch_path(spark, "state")
    parts = _thirds(_silver(spark, sf_dir, sort=False))
    for increment in [*parts, parts[0]]:
        update_state(spark, root, increment, GOLD_AT)
    return state_report(read_state(spark, root), GOLD_AT)


def q_fastest_per_hour_many(spark, sf_dir):
    """The 2,000 highest speeds of every hour."""
    return op.fastest_per_hour(_silver(spark, sf_dir, sort=False), GOLD_AT, k=2000)


RE2_PATTERNS = [r"\bDROP\b", r"[[:digit:]]{3}7$", r"(?i)select\s.", r"A/[^]x]", r"{", r"(?P<m>M)[&&8]\z"]


def q_pattern_violations_re2(spark, sf_dir):
    """Patterns as RE2 reads them, translated for Spark."""
    return op.pattern_violations(_bronze(spark, sf_dir), patterns=RE2_PATTERNS, dialect="re2")


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_standardize": q_bronze_standardize,
    "bronze_round_trip": q_bronze_round_trip,
    "bronze_partition_counts": q_bronze_partition_counts,
    "row_count": q_row_count,
    "landing_bronze": q_landing_bronze,
    "paged_bronze": q_paged_bronze,
    "paged_stream_bronze": q_paged_stream_bronze,
    "stream_bronze": q_stream_bronze,
    "pipeline_last_state": q_pipeline_last_state,
    "pipeline_report_counts": q_pipeline_report_counts,
    "silver_clean": q_silver_clean,
    "silver_gear_counts": q_silver_gear_counts,
    "vin_last_state": q_vin_last_state,
    "vin_last_state_stored": q_vin_last_state_stored,
    "vin_last_state_windows": q_vin_last_state_windows,
    "latest_message_per_vin": q_latest_message_per_vin,
    "last_door_state": q_last_door_state,
    "last_wipers_state": q_last_wipers_state,
    "fastest_per_hour": q_fastest_per_hour,
    "fastest_per_hour_local": q_fastest_per_hour_local,
    "pattern_violations": q_pattern_violations,
    "pattern_violations_strict": q_pattern_violations_strict,
    "bronze_stats": q_bronze_stats,
    "silver_stats": q_silver_stats,
    "last_state_stats": q_last_state_stats,
    "manufacturer_summary": q_manufacturer_summary,
    "quality_flags": q_quality_flags,
    "gold_stats": q_gold_stats,
    "latest_silver": q_latest_silver,
    "bronze_file_stats": q_bronze_file_stats,
    "bronze_overwrite": q_bronze_overwrite,
    "bronze_append": q_bronze_append,
    "bronze_after_failed_replace": q_bronze_after_failed_replace,
    "gold_after_failed_run": q_gold_after_failed_run,
    "gold_of_a_run": q_gold_of_a_run,
    "views_vehicle_messages": q_views_vehicle_messages,
    "empty_stage_status": q_empty_stage_status,
    "vin_last_state_bucketed": q_vin_last_state_bucketed,
    "vin_last_state_bucketed_joins": q_vin_last_state_bucketed_joins,
    "bronze_footer_stats": q_bronze_footer_stats,
    "bronze_footer_partitions": q_bronze_footer_partitions,
    "bronze_stats_merged": q_bronze_stats_merged,
    "vin_last_state_incremental": q_vin_last_state_incremental,
    "fastest_per_hour_many": q_fastest_per_hour_many,
    "pattern_violations_re2": q_pattern_violations_re2,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: last state per vehicle on sf0.001."""
    return q_vin_last_state(spark, "/root/testdata/sf0.001")


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators, if that subpackage is there."""
    try:
        import corpus_pipeline
        from telemetry_lake.llm.queries import ORACLE, QUERIES
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "telemetry_lake.llm", "telemetry_lake.llm.queries"):
            raise
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**QUERIES, "pipeline": corpus_pipeline.run}, {**ORACLE, **sql}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_training_data()[0]}


# --- DuckDB oracle --------------------------------------------------------------

MESSAGES_SQL = """
ev AS (
  SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events
),
messages AS (
  SELECT
    CASE WHEN event_id % 23 = 0 THEN NULL
         WHEN event_id % 29 = 0 THEN '  '
         ELSE 'VIN' || lpad(CAST(user_id AS VARCHAR), 5, '0') END AS vin,
    CASE WHEN event_id % 101 = 0 THEN ' SELECT Motors '
         WHEN event_id % 103 = 0 THEN 'A/B Cars'
         ELSE ' Maker' || CAST(user_id % 17 AS VARCHAR) || ' ' END AS manufacturer,
    2005 + user_id % 20 AS year,
    CASE WHEN event_id % 107 = 0 THEN 'x; DROP' ELSE 'M' || CAST(k % 9 AS VARCHAR) END AS model,
    CASE WHEN event_id % 97 = 0 THEN CAST(123 AS DOUBLE)
         ELSE CAST(2900 + user_id % 300 AS DOUBLE) / 100 END AS latitude,
    CAST(3400 + k % 100 AS DOUBLE) / 100 AS longitude,
    CASE WHEN event_id % 211 = 0 THEN NULL ELSE epoch_us(ts) // 1000 END AS timestamp,
    CASE WHEN event_id % 19 = 0 THEN NULL ELSE value END AS velocity,
    CASE k % 3 WHEN 1 THEN 'LOCKED' WHEN 2 THEN 'UNLOCKED' END AS frontLeftDoorState,
    CASE WHEN k % 5 = 0 THEN NULL WHEN k % 2 = 0 THEN 'ON' ELSE 'OFF' END AS wipersState,
    CASE event_type WHEN 'click' THEN 'NEUTRAL' WHEN 'error' THEN 'REVERSE'
                    WHEN 'view' THEN '3' WHEN 'signup' THEN 'neutral' END AS gearPosition,
    CASE WHEN k % 2 = 0 THEN 'FASTENED' ELSE 'UNFASTENED' END AS driverSeatbeltState
  FROM ev
)"""

BRONZE_SQL = f"""
bronze AS (
  SELECT vin, manufacturer, year, model, latitude, longitude, timestamp,
         epoch_ms(timestamp) AS message_datetime, velocity,
         frontLeftDoorState AS front_left_door_state, wipersState AS wipers_state,
         gearPosition AS gear_position, driverSeatbeltState AS driver_seatbelt_state,
         '{FETCHED_AT}' AS fetch_timestamp, '{INGESTED_AT}' AS ingestion_timestamp,
         '{BATCH_ID}' AS batch_id,
         CAST(epoch_ms(timestamp) AS DATE) AS partition_date,
         strftime(epoch_ms(timestamp), '%H') AS partition_hour
  FROM messages
)"""

# Silver starts from the bronze row: text numbers and trimmed names replace columns of it.
SILVER_SQL = f"""
silver AS (
  SELECT * EXCLUDE (gear_position) REPLACE (trim(manufacturer) AS manufacturer),
         map {{'NEUTRAL': 0, 'REVERSE': -1}}[gear_position] AS gear_position_numeric,
         gear_position AS gear_position_original,
         '{SILVER_AT}' AS silver_processing_timestamp
  FROM bronze
  WHERE length(trim(coalesce(vin, ''))) > 0
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


_B = _with(MESSAGES_SQL, BRONZE_SQL)
_S = _with(MESSAGES_SQL, BRONZE_SQL, SILVER_SQL)

# One row per vehicle: the state beside the greatest time among the rows that
# have one (times before all others stand in for missing ones).
LAST_STATE_SQL = f"""
timed AS (
  SELECT *, coalesce(timestamp, -9223372036854775807) AS moment FROM silver
),
last_state AS (
  SELECT vin,
         max(timestamp) AS last_reported_timestamp,
         max(message_datetime) AS last_message_datetime,
         struct_extract(max(struct_pack(moment := moment, state := front_left_door_state))
                        FILTER (WHERE front_left_door_state IS NOT NULL), 'state') AS last_front_left_door_state,
         struct_extract(max(struct_pack(moment := moment, state := wipers_state))
                        FILTER (WHERE wipers_state IS NOT NULL), 'state') AS last_wipers_state,
         '{GOLD_AT}' AS report_generated_timestamp
  FROM timed GROUP BY vin
)"""


def _fastest_cte(local_ts: str, k: int = 10) -> str:
    """Per hour, the list of its speeds in falling order, cut to the first ``k`` and spread again."""
    return f"""
hours AS (
  SELECT CAST(date_trunc('day', {local_ts}) AS DATE) AS date_part, hour({local_ts}) AS hour_part,
         list(velocity ORDER BY velocity DESC) AS speeds
  FROM silver WHERE velocity IS NOT NULL GROUP BY ALL
),
fastest AS (
  SELECT date_part, hour_part, unnest(speeds[1:{k}]) AS velocity, '{GOLD_AT}' AS report_generated_timestamp
  FROM hours
)"""


def _fastest_sql(local_ts: str) -> str:
    return _S + "," + _fastest_cte(local_ts) + """
SELECT * FROM fastest ORDER BY date_part, hour_part, velocity DESC
"""


def _violations_cte(patterns: list[str]) -> str:
    """The first column, by position in a list, in whose text some listed pattern is found."""
    listed = ", ".join("'" + p.replace("'", "''") + "'" for p in patterns)
    return f"""
found AS (
  SELECT *, list_position(
    [len([p FOR p IN [{listed}] IF coalesce(regexp_matches(t, p), FALSE)]) > 0 FOR t IN [vin, manufacturer, model]],
    TRUE) AS place
  FROM bronze
),
violations AS (
  SELECT * EXCLUDE (place), ['vin', 'manufacturer', 'model'][place] AS violating_column
  FROM found WHERE place > 0
)"""


def _violations_sql(patterns: list[str]) -> str:
    return _B + "," + _violations_cte(patterns) + "\nSELECT * FROM violations"


_ORACLE: dict[str, str] = {
    "bronze_standardize": _B + "\nSELECT * FROM bronze",
    "bronze_round_trip": _B + "\nSELECT * FROM bronze",
    "bronze_partition_counts": _B + """
SELECT partition_date, partition_hour, COUNT(*) AS message_count
FROM bronze GROUP BY partition_date, partition_hour""",
    "row_count": _B + "\nSELECT COUNT(*) AS row_count FROM bronze",
    "landing_bronze": _B + "\nSELECT * FROM bronze",
    "paged_bronze": _B + "\nSELECT * FROM bronze",
    "paged_stream_bronze": _B + "\nSELECT * FROM bronze",
    "stream_bronze": _B + "\nSELECT * FROM bronze",
    "silver_clean": _S + "\nSELECT * FROM silver ORDER BY message_datetime DESC NULLS LAST",
    "silver_gear_counts": _S + """
SELECT gear_position_numeric, COUNT(*) AS message_count FROM silver GROUP BY gear_position_numeric""",
    "vin_last_state": _S + "," + LAST_STATE_SQL + """
SELECT * FROM last_state ORDER BY last_message_datetime DESC NULLS LAST, vin""",
    "vin_last_state_stored": _S + "," + LAST_STATE_SQL + """
SELECT * FROM last_state ORDER BY last_message_datetime DESC NULLS LAST, vin""",
    "vin_last_state_windows": _S + "," + LAST_STATE_SQL + "\nSELECT * FROM last_state",
    "latest_message_per_vin": _S + "," + LAST_STATE_SQL + """
SELECT vin, last_reported_timestamp, last_message_datetime FROM last_state""",
    "last_door_state": _S + "," + LAST_STATE_SQL + """
SELECT vin, last_front_left_door_state FROM last_state WHERE last_front_left_door_state IS NOT NULL""",
    "last_wipers_state": _S + "," + LAST_STATE_SQL + """
SELECT vin, last_wipers_state FROM last_state WHERE last_wipers_state IS NOT NULL""",
    "fastest_per_hour": _fastest_sql("message_datetime"),
    "fastest_per_hour_local": _fastest_sql(
        f"timezone('{REPORT_TZ}', timezone('UTC', message_datetime))"
    ),
    "pattern_violations": _violations_sql(DEFAULT_PATTERNS),
    "pattern_violations_strict": _violations_sql(STRICT_PATTERNS),
    "pipeline_last_state": _S + "," + LAST_STATE_SQL + "\nSELECT * FROM last_state",
    "pipeline_report_counts": _S + "," + LAST_STATE_SQL + "," + _fastest_cte("message_datetime")
    + "," + _violations_cte(DEFAULT_PATTERNS) + """
SELECT 'sql_violating_messages_report' AS report, COUNT(*) AS row_count FROM violations
UNION ALL SELECT 'velocity_analysis', COUNT(*) FROM fastest
UNION ALL SELECT 'vin_last_state', COUNT(*) FROM last_state""",
    "bronze_stats": _B + """
SELECT COUNT(*) AS total_records, COUNT(DISTINCT vin) AS unique_vehicles,
       MIN(message_datetime) AS earliest_message, MAX(message_datetime) AS latest_message
FROM bronze""",
    "silver_stats": _S + """
, flagged AS (
  SELECT *,
    COALESCE(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, FALSE) AS vc,
    COALESCE(velocity >= 0, FALSE) AS vv
  FROM silver
)
SELECT COUNT(*) AS total_records, COUNT(DISTINCT vin) AS unique_vehicles,
       COUNT(DISTINCT manufacturer) AS unique_manufacturers,
       ROUND(AVG(velocity), 2) AS avg_velocity,
       MIN(message_datetime) AS earliest_message, MAX(message_datetime) AS latest_message,
       COUNT(*) FILTER (WHERE vc) AS records_with_valid_coords,
       COUNT(*) FILTER (WHERE vv) AS records_with_valid_velocity,
       ROUND(100.0 * COUNT(*) FILTER (WHERE vc) / COUNT(*), 2) AS valid_coords_percentage
FROM flagged""",
    "last_state_stats": _S + "," + LAST_STATE_SQL + """
SELECT COUNT(*) AS total_vehicles,
       COUNT(last_front_left_door_state) AS vehicles_with_door_state,
       COUNT(last_wipers_state) AS vehicles_with_wipers_state
FROM last_state""",
    "manufacturer_summary": _S + """
SELECT manufacturer, COUNT(*) AS message_count, COUNT(DISTINCT vin) AS vehicle_count,
       ROUND(AVG(velocity), 2) AS avg_velocity, MAX(velocity) AS max_velocity
FROM silver GROUP BY manufacturer ORDER BY manufacturer""",
    "quality_flags": _S + """
SELECT *,
  COALESCE(latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180, FALSE) AS has_valid_coordinates,
  COALESCE(velocity >= 0, FALSE) AS has_valid_velocity
FROM silver""",
    "gold_stats": _S + "," + LAST_STATE_SQL + "," + _fastest_cte("message_datetime")
    + "," + _violations_cte(DEFAULT_PATTERNS) + """
SELECT 'sql_violating_messages_report' AS report, CAST(count(*) > 0 AS BIGINT) AS reports FROM violations
UNION ALL SELECT 'velocity_analysis', CAST(count(*) > 0 AS BIGINT) FROM fastest
UNION ALL SELECT 'vin_last_state', CAST(count(*) > 0 AS BIGINT) FROM last_state""",
    "latest_silver": _S + "\nSELECT * FROM silver",
    "bronze_file_stats": _B + """
SELECT COUNT(*) AS total_records, COUNT(DISTINCT (partition_date, partition_hour)) AS hour_folders,
       TRUE AS files_in_all_folders
FROM bronze""",
    "bronze_overwrite": _B + "\nSELECT * FROM bronze",
    "bronze_append": _B + """
SELECT partition_date, partition_hour, 2 * COUNT(*) AS message_count FROM bronze GROUP BY ALL""",
    "bronze_after_failed_replace": _B + "\nSELECT * FROM bronze",
    "gold_after_failed_run": _S + "," + LAST_STATE_SQL + "\nSELECT * FROM last_state",
    "gold_of_a_run": _S + "," + LAST_STATE_SQL + "," + _fastest_cte("message_datetime") + """
SELECT 'velocity_analysis' AS report, CAST(count(*) > 0 AS BIGINT) AS reports FROM fastest
UNION ALL SELECT 'vin_last_state', CAST(count(*) > 0 AS BIGINT) FROM last_state""",
    "views_vehicle_messages": _S + """
SELECT b.vin, count(*) AS bronze_messages,
       CAST(any_value((SELECT count(*) FROM silver s WHERE s.vin = b.vin)) AS BIGINT) AS silver_messages
FROM bronze b WHERE b.vin IS NOT NULL GROUP BY b.vin""",
    "empty_stage_status": _B + """
SELECT 'none' AS messages, 'failed' AS bronze, 'failed' AS silver, CAST(0 AS BIGINT) AS records
UNION ALL SELECT 'all', 'success', 'success', COUNT(*) FROM bronze""",
    "vin_last_state_bucketed": _S + "," + LAST_STATE_SQL + "\nSELECT * FROM last_state",
    "vin_last_state_bucketed_joins": _S + "," + LAST_STATE_SQL + "\nSELECT * FROM last_state",
    "bronze_footer_stats": _B + """
SELECT COUNT(*) AS total_records, MIN(message_datetime) AS earliest_message, MAX(message_datetime) AS latest_message
FROM bronze""",
    "bronze_footer_partitions": _B + """
SELECT partition_date, partition_hour, COUNT(*) AS message_count, MIN(timestamp) AS first_ms, MAX(timestamp) AS last_ms
FROM bronze GROUP BY ALL""",
    "bronze_stats_merged": _B + """
SELECT COUNT(*) AS total_records, ROUND(AVG(velocity), 2) AS avg_velocity,
       MIN(message_datetime) AS earliest_message, MAX(message_datetime) AS latest_message,
       COUNT(*) FILTER (WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180) AS records_with_valid_coords,
       COUNT(*) FILTER (WHERE velocity >= 0) AS records_with_valid_velocity,
       TRUE AS vehicles_within_error, TRUE AS manufacturers_within_error
FROM bronze""",
    "vin_last_state_incremental": _S + "," + LAST_STATE_SQL + "\nSELECT * FROM last_state",
    "fastest_per_hour_many": _S + "," + _fastest_cte("message_datetime", 2000) + "\nSELECT * FROM fastest",
    "pattern_violations_re2": _violations_sql(RE2_PATTERNS),
}


def oracle_sql() -> dict[str, str]:
    return {**{k: v for k, v in _ORACLE.items() if k in _QUERIES}, **_training_data()[1]}
