"""Vehicle messages derived from the driver's ``events`` table.

The reference reads messages from an HTTP API that is not part of it; tests
and driver queries derive the same 12 API fields from ``events`` so every
query grows with the tables.  The rules are fixed and mirrored, expression by
expression, in the DuckDB oracle (``__spark_entry__.MESSAGES_SQL``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.functions.time import ntz_millis
from telemetry_lake.schemas import RAW


def read_table(spark: SparkSession, sf_dir: str, name: str, spread_key: str | None = None,
               partitions: int | None = None) -> DataFrame:
    """Scan one test table.

    The test tables are single files with one row group, i.e. one scan task.
    ``spread_key`` with ``partitions`` hash-spreads the scan over that many
    tasks; it is a full shuffle, so only a caller who knows the input to be
    small and unsplit should ask for it.
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.repartition(partitions, spread_key) if spread_key and partitions else df


def messages_from_events(events: DataFrame, page_size: int | None = None) -> DataFrame:
    """``events`` -> raw API messages (schema ``RAW``), one per event.

    Fixed rules (event_id ``e``, user_id ``u``, ``k`` = the integer in props):
    vin NULL if e%23=0, two spaces if e%29=0, else 'VIN'+u padded to 5;
    manufacturer ' SELECT Motors ' if e%101=0, 'A/B Cars' if e%103=0, else
    ' Maker<u%17> '; year 2005+u%20; model 'x; DROP' if e%107=0 else 'M<k%9>';
    latitude 123 if e%97=0 else (2900+u%300)/100; longitude (3400+k%100)/100;
    timestamp NULL if e%211=0 else epoch micros div 1000; velocity NULL if
    e%19=0 else value; door by k%3 (NULL, LOCKED, UNLOCKED); wipers NULL if
    k%5=0, ON if k even, else OFF; gear by event type (click NEUTRAL, error
    REVERSE, view '3', signup 'neutral', purchase NULL); seatbelt FASTENED if
    k even, else UNFASTENED.
    """
    e = F.col("event_id")
    u = F.col("user_id")
    # The integer in props ('{"k": 69}'): the first run of digits, the same
    # expression as the oracle (and ~3x cheaper than a JSON parse per row).
    k = F.regexp_extract("props", "[0-9]+", 0).try_cast("int")
    millis = ntz_millis("ts")
    cols = {
        "vin": F.when(e % 23 == 0, F.lit(None))
        .when(e % 29 == 0, F.lit("  "))
        .otherwise(F.concat(F.lit("VIN"), F.lpad(u.cast("string"), 5, "0"))),
        "manufacturer": F.when(e % 101 == 0, F.lit(" SELECT Motors "))
        .when(e % 103 == 0, F.lit("A/B Cars"))
        .otherwise(F.concat(F.lit(" Maker"), (u % 17).cast("string"), F.lit(" "))),
        "year": F.lit(2005) + u % 20,
        "model": F.when(e % 107 == 0, F.lit("x; DROP")).otherwise(
            F.concat(F.lit("M"), (k % 9).cast("string"))
        ),
        "latitude": F.when(e % 97 == 0, F.lit(123.0)).otherwise(
            (F.lit(2900) + u % 300).cast("double") / F.lit(100)
        ),
        "longitude": (F.lit(3400) + k % 100).cast("double") / F.lit(100),
        "timestamp": F.when(e % 211 == 0, F.lit(None)).otherwise(millis),
        "velocity": F.when(e % 19 == 0, F.lit(None)).otherwise(F.col("value")),
        "frontLeftDoorState": F.when(k % 3 == 1, F.lit("LOCKED")).when(k % 3 == 2, F.lit("UNLOCKED")),
        "wipersState": F.when(k % 5 == 0, F.lit(None))
        .when(k % 2 == 0, F.lit("ON"))
        .otherwise(F.lit("OFF")),
        "gearPosition": F.when(F.col("event_type") == "click", F.lit("NEUTRAL"))
        .when(F.col("event_type") == "error", F.lit("REVERSE"))
        .when(F.col("event_type") == "view", F.lit("3"))
        .when(F.col("event_type") == "signup", F.lit("neutral")),
        "driverSeatbeltState": F.when(k % 2 == 0, F.lit("FASTENED")).otherwise(F.lit("UNFASTENED")),
    }
    out = [cols[f.name].cast(f.dataType).alias(f.name) for f in RAW.fields]
    if page_size:
        # API response number: consecutive events, ``page_size`` per response.
        out.append(F.floor(e / F.lit(page_size)).cast("long").alias("page"))
    return events.select(*out)


def read_messages(spark: SparkSession, sf_dir: str, page_size: int | None = None,
                  partitions: int | None = None) -> DataFrame:
    """Messages of one test scale (column-pruned scan of ``events``); with
    ``page_size`` also the ``page`` (API response) each message belongs to.
    ``partitions`` spreads the scan (see ``read_table``)."""
    return messages_from_events(read_table(spark, sf_dir, "events", "event_id", partitions), page_size)


def replicate_events(events: DataFrame, copies: int) -> DataFrame:
    """``events`` grown ``copies`` times for scaling runs: copy ``r`` gets
    event ids shifted by ``r * (max(event_id) + 1)``, so dense ids stay dense
    (API pages stay numbered 0..n-1); users and times are kept, so every
    vehicle and every hour holds ``copies`` times the messages (per-key volume
    grows with the data).  Rows come from ``explode``, not a join."""
    if copies <= 1:
        return events
    span = (events.agg(F.max("event_id")).first()[0] or 0) + 1  # one number to the driver
    r = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy")
    grown = events.select("*", r)
    return grown.select(
        (F.col("event_id") + F.col("_copy").cast("long") * F.lit(span)).alias("event_id"),
        "ts",
        "user_id",
        "event_type", "value", "props",
    )
