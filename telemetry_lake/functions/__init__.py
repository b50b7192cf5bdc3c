"""Column expressions (all Spark built-ins, no UDF)."""

from telemetry_lake.functions.text import gear_number, is_blank, zs_trim
from telemetry_lake.functions.time import (
    local_wall_clock,
    partition_date,
    partition_hour,
    utc_wall_clock,
)
from telemetry_lake.functions.patterns import first_matching_column, matches_any

__all__ = [
    "first_matching_column",
    "gear_number",
    "is_blank",
    "local_wall_clock",
    "matches_any",
    "partition_date",
    "partition_hour",
    "utc_wall_clock",
    "zs_trim",
]
