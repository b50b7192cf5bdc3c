"""Declared schemas, column lists and fixed values of the lake.

The reference infers types per batch; the lake declares them once, so a field
missing from a batch is NULL and integers stay integers.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- raw message, as the vehicle API delivers it (one JSON object each) ------
RAW = T.StructType(
    [
        T.StructField("vin", T.StringType()),
        T.StructField("manufacturer", T.StringType()),
        T.StructField("year", T.LongType()),
        T.StructField("model", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),  # epoch milliseconds
        T.StructField("velocity", T.DoubleType()),
        T.StructField("frontLeftDoorState", T.StringType()),
        T.StructField("wipersState", T.StringType()),
        T.StructField("gearPosition", T.StringType()),
        T.StructField("driverSeatbeltState", T.StringType()),
    ]
)
RAW_COLUMNS = [f.name for f in RAW.fields]

# API field -> bronze column
RENAMES = {
    "frontLeftDoorState": "front_left_door_state",
    "wipersState": "wipers_state",
    "gearPosition": "gear_position",
    "driverSeatbeltState": "driver_seatbelt_state",
}

# --- bronze: the data columns stored in the files ----------------------------
BRONZE_DATA = T.StructType(
    [
        T.StructField("vin", T.StringType()),
        T.StructField("manufacturer", T.StringType()),
        T.StructField("year", T.LongType()),
        T.StructField("model", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("message_datetime", T.TimestampType()),
        T.StructField("velocity", T.DoubleType()),
        T.StructField("front_left_door_state", T.StringType()),
        T.StructField("wipers_state", T.StringType()),
        T.StructField("gear_position", T.StringType()),
        T.StructField("driver_seatbelt_state", T.StringType()),
        T.StructField("fetch_timestamp", T.StringType()),
        T.StructField("ingestion_timestamp", T.StringType()),
        T.StructField("batch_id", T.StringType()),
    ]
)
PARTITION_KEYS = ["partition_date", "partition_hour"]
# The keys live only in the directory names; declaring them keeps '09' a
# two-digit string and the date a DATE on read.
BRONZE = T.StructType(
    BRONZE_DATA.fields
    + [
        T.StructField("partition_date", T.DateType()),
        T.StructField("partition_hour", T.StringType()),
    ]
)
BRONZE_COLUMNS = [f.name for f in BRONZE.fields]

# --- silver --------------------------------------------------------------------
SILVER_COLUMNS = [
    "vin",
    "manufacturer",
    "year",
    "model",
    "latitude",
    "longitude",
    "timestamp",
    "message_datetime",
    "velocity",
    "front_left_door_state",
    "wipers_state",
    "gear_position_numeric",
    "gear_position_original",
    "driver_seatbelt_state",
    "fetch_timestamp",
    "ingestion_timestamp",
    "batch_id",
    "partition_date",
    "partition_hour",
    "silver_processing_timestamp",
]
_SILVER_OWN = {
    "gear_position_numeric": T.IntegerType(),
    "gear_position_original": T.StringType(),
    "silver_processing_timestamp": T.StringType(),
}
SILVER = T.StructType(
    [T.StructField(c, _SILVER_OWN[c] if c in _SILVER_OWN else BRONZE[c].dataType) for c in SILVER_COLUMNS]
)

# --- gold ----------------------------------------------------------------------
LAST_STATE_COLUMNS = [
    "vin",
    "last_reported_timestamp",
    "last_message_datetime",
    "last_front_left_door_state",
    "last_wipers_state",
    "report_generated_timestamp",
]
FASTEST_COLUMNS = ["date_part", "hour_part", "velocity", "report_generated_timestamp"]

# --- fixed values: must equal the reference's for identical results -----------
# Unicode space separators (category Zs) removed by the SQL TRIM the reference
# uses; tabs and line breaks are not among them.
ZS_CHARS = (
    "\u0020\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
)
# Gear text -> number; any other text (other case, spaces, digits) is NULL.
GEAR_CODES = {"NEUTRAL": 0, "REVERSE": -1}
# Default text check: columns, then patterns, in the reference's order.  The
# two comment patterns carry two backslashes, so as regular expressions they
# mean "slash next to any number of backslashes" and flag every '/'.
DEFAULT_PATTERN_COLUMNS = ["vin", "manufacturer", "model"]
DEFAULT_PATTERNS = [r";", r"--", r"/\\*", r"\\*/", r"DROP", r"SELECT", r"INSERT", r"UPDATE", r"DELETE"]
# The same list with the comment markers meant literally: '/*' and '*/'.
STRICT_PATTERNS = [r";", r"--", r"/\*", r"\*/", r"DROP", r"SELECT", r"INSERT", r"UPDATE", r"DELETE"]
# Output names: file stem per gold report, silver run prefix.
SILVER_RUN_PREFIX = "vehicle_messages_cleaned_"
GOLD_REPORTS = ["vin_last_state", "velocity_analysis", "sql_violating_messages_report"]
