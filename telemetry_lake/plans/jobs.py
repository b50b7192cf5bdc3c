"""Stage jobs: landing -> bronze -> silver -> gold.

Error contract (as the reference): a single stage returns
``{"status": "failed", "error": ...}`` instead of raising; the full run raises;
a failing pattern report only logs a warning and leaves its entry None.
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.operators.bronze import to_bronze
from telemetry_lake.operators.fastest import fastest_per_hour
from telemetry_lake.operators.last_state import vin_last_state
from telemetry_lake.operators.silver import to_silver
from telemetry_lake.operators.violations import pattern_violations
from telemetry_lake.schemas import DEFAULT_PATTERN_COLUMNS, DEFAULT_PATTERNS
from telemetry_lake.sources.bronze_store import read_bronze, write_bronze
from telemetry_lake.sources.landing import read_landing
from telemetry_lake.sources.paged import fetch_pages, read_pages
from telemetry_lake.sources.layers import latest_silver_path, read_silver, write_gold, write_silver
from telemetry_lake.sources.versions import new_version, publish
from telemetry_lake.stamps import compact_stamp, default_batch_id, iso_stamp, utc_now

log = logging.getLogger("telemetry_lake")


def has_rows(df) -> bool:
    """At least one row?  ``limit(1)`` scans partitions incrementally and stops
    at the first row (``DataFrame.isEmpty`` was measured to evaluate every
    input partition of the landing read)."""
    return len(df.limit(1).collect()) > 0


@dataclass
class LakeConfig:
    """Paths and options of one lake (any Hadoop-compatible URI)."""

    landing_path: str
    bronze_path: str
    silver_path: str
    gold_path: str
    multi_line: bool = True
    bronze_mode: str = "replace"
    silver_sort: bool = True
    top_k: int = 10
    report_tz: str = "UTC"
    pattern_columns: list[str] = field(default_factory=lambda: list(DEFAULT_PATTERN_COLUMNS))
    patterns: list[str] = field(default_factory=lambda: list(DEFAULT_PATTERNS))
    # Fetch from the message API instead of reading landing files: pages are
    # requested in parallel, stored once under pages_path, then read.
    api_url_template: str | None = None  # "{page}" and "{amount}" are filled in
    fetch_amount: int = 10000
    page_size: int = 1000
    pages_per_task: int = 0  # 0: left to the source
    pages_path: str | None = None  # default: landing_path + "_pages", apart from the landing text


def bronze_stage(spark: SparkSession, cfg: LakeConfig, batch_id: str | None = None,
                 fetched_at: datetime | None = None, now: datetime | None = None) -> dict:
    """Landing -> bronze.  Raises on failure."""
    now = now or utc_now()
    batch_id = batch_id or default_batch_id(now, "bronze")
    if cfg.api_url_template:
        pages_root = (cfg.pages_path or cfg.landing_path.rstrip("/") + "_pages").rstrip("/")
        pages = fetch_pages(spark, cfg.api_url_template, cfg.fetch_amount, cfg.page_size,
                            f"{pages_root}/pages_{compact_stamp(now)}",
                            pages_per_partition=cfg.pages_per_task)
        raw = read_pages(spark, pages).withColumn("fetch_timestamp",
                                                  F.lit(iso_stamp(fetched_at or now)))
    elif cfg.bronze_mode == "append":
        raise ValueError("append would store the landing zone again; use the checkpointed landing stream")
    else:
        raw = read_landing(spark, cfg.landing_path, cfg.multi_line, fetched_at or now)
    if not has_rows(raw):
        raise ValueError("the batch holds no message; bronze is left as it was")
    obs = Observation("bronze")
    bronze = to_bronze(raw, batch_id=batch_id, ingested_at=now)
    path = write_bronze(bronze, cfg.bronze_path, mode=cfg.bronze_mode, observation=obs)
    return {"status": "success", "batch_id": batch_id,
            "records_fetched": obs.get["records"], "file_path": path}


def silver_stage(spark: SparkSession, cfg: LakeConfig, now: datetime | None = None) -> dict:
    """Bronze -> new silver run folder.  Raises on failure."""
    now = now or utc_now()
    bronze = read_bronze(spark, cfg.bronze_path)
    if not has_rows(bronze):
        raise ValueError("bronze holds no message")
    silver = to_silver(bronze, now, sort=cfg.silver_sort)
    return {"status": "success", "file_path": write_silver(silver, cfg.silver_path, now)}


def gold_stage(spark: SparkSession, cfg: LakeConfig, silver_path: str | None = None,
               now: datetime | None = None) -> dict:
    """Silver (given or latest) -> the three reports, as a new gold version.

    Raises on failure, except for the pattern report, whose failure is logged;
    the new version counts once its reports are written, so a failed run
    leaves the previous one as it was.

    Each report is its own job over its own column-pruned scan: at scale two
    narrow scans beat caching the whole silver table.
    """
    now = now or utc_now()
    if not silver_path:
        silver_path = latest_silver_path(spark, cfg.silver_path)
        if not silver_path:
            raise FileNotFoundError("no finished silver run")
    silver = read_silver(spark, silver_path)
    version = new_version(compact_stamp(now))
    gold = f"{cfg.gold_path.rstrip('/')}/{version}"
    reports = {
        "vin_last_state": write_gold(vin_last_state(silver, now), gold, "vin_last_state"),
        "velocity_analysis": write_gold(
            fastest_per_hour(silver, now, k=cfg.top_k, report_tz=cfg.report_tz),
            gold, "velocity_analysis"),
    }
    try:
        # Scans bronze, so rows that silver drops are checked too.
        flagged = pattern_violations(read_bronze(spark, cfg.bronze_path),
                                     cfg.pattern_columns, cfg.patterns)
        # The filter keeps a sliver of every bronze split; rebalancing the
        # matches lets AQE pack them into few files instead of one tiny file
        # per input task (the two sorted reports are already range-packed).
        reports["sql_injection_report"] = write_gold(flagged.hint("rebalance"), gold,
                                                     "sql_violating_messages_report")
    except Exception as exc:  # noqa: BLE001 - the report is optional by contract
        log.warning("pattern report left out: %s", exc)
        reports["sql_injection_report"] = None
    publish(spark, cfg.gold_path, version)
    return {"status": "success", "silver_path": silver_path, "reports_generated": reports}


def _guarded(stage, *args, **kwargs) -> dict:
    try:
        return stage(*args, **kwargs)
    except Exception as exc:  # noqa: BLE001 - stage contract: report, do not raise
        log.error("%s failed: %s", stage.__name__, exc)
        return {"status": "failed", "error": str(exc)}


def run_bronze(spark: SparkSession, cfg: LakeConfig, batch_id: str | None = None, **kw) -> dict:
    return _guarded(bronze_stage, spark, cfg, batch_id, **kw)


def run_silver(spark: SparkSession, cfg: LakeConfig, **kw) -> dict:
    return _guarded(silver_stage, spark, cfg, **kw)


def run_gold(spark: SparkSession, cfg: LakeConfig, silver_path: str | None = None, **kw) -> dict:
    return _guarded(gold_stage, spark, cfg, silver_path, **kw)


def run_all(spark: SparkSession, cfg: LakeConfig, batch_id: str | None = None,
            now: datetime | None = None) -> dict:
    """Bronze, silver, gold in order; raises ``RuntimeError`` on any failure."""
    start = time.time()
    now = now or utc_now()
    batch_id = batch_id or default_batch_id(now, "pipeline")
    results: dict = {"batch_id": batch_id, "start_time": now.isoformat(), "stages": {}}
    try:
        for name, stage, kwargs in (
            ("bronze", bronze_stage, {"batch_id": batch_id, "now": now}),
            ("silver", silver_stage, {"now": now}),
            ("gold", gold_stage, {"now": now}),
        ):
            t0 = time.time()
            if name == "gold":
                kwargs["silver_path"] = results["stages"]["silver"]["file_path"]
            out = stage(spark, cfg, **kwargs)
            out["duration_seconds"] = round(time.time() - t0, 2)
            results["stages"][name] = out
    except Exception as exc:
        raise RuntimeError(f"full run stopped: {exc}") from exc
    results["status"] = "success"
    results["end_time"] = utc_now().isoformat()
    results["total_duration_seconds"] = round(time.time() - start, 2)
    return results
