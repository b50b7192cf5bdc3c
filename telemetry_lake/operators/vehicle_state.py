"""The last-state report kept up to date from increments.

A state holds per vehicle the latest message and the latest known state of each
component, every one with its time.  States merge by the larger time (ties by
the larger value), in any order and any number of times, so late rows, tied rows
and an increment that is merged again give the report over all messages.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.sources.versions import current_path, current_version, new_version, publish
from telemetry_lake.stamps import compact_stamp

COMPONENTS = ("front_left_door_state", "wipers_state")
STATE_SCHEMA = (
    "vin string, last struct<message_datetime: timestamp, timestamp: bigint>, "
    + ", ".join(f"{c} struct<message_datetime: timestamp, {c}: string>" for c in COMPONENTS)
)


def _merged(rows: DataFrame) -> DataFrame:
    return rows.groupBy("vin").agg(*[F.max(c).alias(c) for c in ("last", *COMPONENTS)])


def vehicle_state(silver: DataFrame) -> DataFrame:
    """State of the messages in ``silver``; rows without a vehicle number are left out.

    A hash aggregate first leaves one row per vehicle and pair of component
    states, so a vehicle with a third of all messages sends few rows.
    """
    times = (
        silver.where(F.col("vin").isNotNull())
        .groupBy("vin", *COMPONENTS)
        .agg(F.max("message_datetime").alias("message_datetime"), F.max("timestamp").alias("timestamp"))
    )
    return _merged(
        times.select(
            "vin",
            F.struct("message_datetime", "timestamp").alias("last"),
            *[F.when(F.col(c).isNotNull(), F.struct("message_datetime", c)).alias(c) for c in COMPONENTS],
        )
    )


def merge_states(*states: DataFrame) -> DataFrame:
    """One state of several: their union, aggregated once."""
    union = states[0]
    for state in states[1:]:
        union = union.unionByName(state)
    return _merged(union)


def state_report(state: DataFrame, generated_at: datetime | str) -> DataFrame:
    """The last-state report (columns and order of ``vin_last_state``) from a state."""
    return state.select(
        "vin",
        F.col("last.timestamp").alias("last_reported_timestamp"),
        F.col("last.message_datetime").alias("last_message_datetime"),
        *[F.col(f"{c}.{c}").alias(f"last_{c}") for c in COMPONENTS],
        F.lit(compact_stamp(generated_at)).alias("report_generated_timestamp"),
    ).orderBy(F.desc_nulls_last("last_message_datetime"), F.asc("vin"))


def read_state(spark: SparkSession, root: str) -> DataFrame:
    """The stored state that counts; an empty one before the first increment."""
    if current_version(spark, root) is None:
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).parquet(current_path(spark, root))


def update_state(spark: SparkSession, root: str, increment: DataFrame, updated_at: datetime | str) -> str:
    """Merge new silver rows into the state stored below ``root``; returns the new version's folder.

    The new state is a version of its own that counts once it is written, so a
    failed update leaves the state as it was and can be run again.
    """
    version = new_version(compact_stamp(updated_at))
    merge_states(read_state(spark, root), vehicle_state(increment)).write.parquet(f"{root.rstrip('/')}/{version}")
    return publish(spark, root, version)
