"""Time expressions that give the same result under every session time zone.

Messages carry epoch milliseconds; ``message_datetime`` is the instant.  Date
and hour keys are read off a TIMESTAMP_NTZ wall clock built from the instant's
microseconds, so neither the bronze keys (UTC) nor the report keys (any zone)
depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch_ntz() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant_from_millis(c: str | Column) -> Column:
    """Epoch milliseconds -> TIMESTAMP (an instant)."""
    return F.timestamp_millis(_col(c))


def utc_wall_clock(instant: str | Column) -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ holding its UTC wall clock."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(instant)), _epoch_ntz())


def local_wall_clock(instant: str | Column, tz: str = "UTC") -> Column:
    """TIMESTAMP instant -> TIMESTAMP_NTZ wall clock in zone ``tz``."""
    wall = utc_wall_clock(instant)
    if tz.upper() in ("UTC", "Z", "ETC/UTC", "GMT"):
        return wall
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), wall)


def _ntz_since_epoch(c: str | Column, per_second: int) -> Column:
    # Built from the wall-clock fields: date, hour, minute, second with
    # fraction.  (timestampdiff would cast to a zoned TIMESTAMP first and be
    # off by the zone's DST shift.)
    ts = _col(c)
    day = F.unix_date(F.to_date(ts)).cast("long") * F.lit(86400 * per_second)
    hms = (F.hour(ts).cast("long") * F.lit(3600 * per_second)
           + F.minute(ts).cast("long") * F.lit(60 * per_second))
    sec = F.floor(F.extract(F.lit("SECOND"), ts) * F.lit(per_second)).cast("long")
    return day + hms + sec


def ntz_micros(c: str | Column) -> Column:
    """TIMESTAMP_NTZ -> microseconds since 1970-01-01 00:00 of that wall clock."""
    return _ntz_since_epoch(c, 1_000_000)


def ntz_millis(c: str | Column) -> Column:
    """TIMESTAMP_NTZ -> whole milliseconds since 1970-01-01 00:00 (floor of micros / 1000)."""
    return _ntz_since_epoch(c, 1_000)


def partition_date(instant: str | Column) -> Column:
    """UTC calendar date of the instant (bronze key, DATE)."""
    return F.to_date(utc_wall_clock(instant))


def partition_hour(instant: str | Column) -> Column:
    """UTC hour of the instant as a two-digit string (bronze key)."""
    return F.lpad(F.hour(utc_wall_clock(instant)).cast("string"), 2, "0")


def report_date(instant: str | Column, tz: str = "UTC") -> Column:
    """``CAST(ts AS DATE)`` in zone ``tz``."""
    return F.to_date(local_wall_clock(instant, tz))


def report_hour(instant: str | Column, tz: str = "UTC") -> Column:
    """``EXTRACT('hour' FROM ts)`` in zone ``tz``, as BIGINT."""
    return F.hour(local_wall_clock(instant, tz)).cast("bigint")
