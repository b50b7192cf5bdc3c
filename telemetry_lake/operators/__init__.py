"""DataFrame -> DataFrame operators of the lake."""

from telemetry_lake.operators.bronze import to_bronze
from telemetry_lake.operators.fastest import fastest_per_hour
from telemetry_lake.operators.last_state import (
    last_component_state,
    last_non_null,
    latest_message_per_vin,
    latest_row,
    latest_state,
    vin_last_state,
)
from telemetry_lake.operators.silver import to_silver
from telemetry_lake.operators.violations import pattern_violations

__all__ = [
    "fastest_per_hour",
    "last_component_state",
    "last_non_null",
    "latest_message_per_vin",
    "latest_row",
    "latest_state",
    "pattern_violations",
    "to_bronze",
    "to_silver",
    "vin_last_state",
]
