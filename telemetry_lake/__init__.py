"""telemetry_lake: a Spark-native bronze / silver / gold lake for vehicle messages."""

from telemetry_lake.operators import (
    fastest_per_hour,
    last_non_null,
    latest_row,
    latest_state,
    pattern_violations,
    to_bronze,
    to_silver,
    vin_last_state,
)
from telemetry_lake.plans.jobs import LakeConfig, run_all, run_bronze, run_gold, run_silver
from telemetry_lake.session import checkpoint_root, lake_session

__all__ = [
    "LakeConfig",
    "checkpoint_root",
    "fastest_per_hour",
    "lake_session",
    "last_non_null",
    "latest_row",
    "latest_state",
    "pattern_violations",
    "run_all",
    "run_bronze",
    "run_gold",
    "run_silver",
    "to_bronze",
    "to_silver",
    "vin_last_state",
]
