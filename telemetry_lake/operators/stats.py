"""Layer statistics and quality flags.

The reference's log prints these figures, but the code that made them is gone;
the definitions here are the lake's own.  Distinct counts run on rows that a
hash aggregate has reduced to one per counted value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid_coordinates(lat: str = "latitude", lon: str = "longitude") -> Column:
    """Latitude in [-90, 90] and longitude in [-180, 180]; NULL counts as invalid."""
    return F.coalesce(
        F.col(lat).between(-90.0, 90.0) & F.col(lon).between(-180.0, 180.0), F.lit(False)
    )


def valid_velocity(v: str = "velocity") -> Column:
    """Velocity present and not negative."""
    return F.coalesce(F.col(v) >= F.lit(0.0), F.lit(False))


def with_quality_flags(silver: DataFrame) -> DataFrame:
    """Silver rows plus ``has_valid_coordinates`` and ``has_valid_velocity``."""
    return silver.withColumns(
        {"has_valid_coordinates": valid_coordinates(), "has_valid_velocity": valid_velocity()}
    )


def bronze_stats(bronze: DataFrame) -> DataFrame:
    """One row: total_records, unique_vehicles, earliest_message, latest_message."""
    return bronze.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("vin").alias("unique_vehicles"),
        F.min("message_datetime").alias("earliest_message"),
        F.max("message_datetime").alias("latest_message"),
    )


def bronze_file_stats(bronze_read: DataFrame) -> DataFrame:
    """One row for a bronze dataset read from files: total_files, total_records."""
    return bronze_read.agg(
        F.count_distinct(F.col("_metadata.file_path")).alias("total_files"),
        F.count(F.lit(1)).alias("total_records"),
    )


def silver_stats(silver: DataFrame) -> DataFrame:
    """One row of silver figures; averages and percentages rounded to 2 places."""
    # Two distinct counts in one aggregate copy their input per count, so they
    # run on one row per vehicle and manufacturer, not on the messages.
    pairs = silver.groupBy("vin", "manufacturer").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("velocity").alias("velocity_sum"),
        F.count("velocity").alias("velocity_n"),
        F.min("message_datetime").alias("earliest"),
        F.max("message_datetime").alias("latest"),
        F.count_if(valid_coordinates()).alias("coords"),
        F.count_if(valid_velocity()).alias("speeds"),
    )

    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0))

    average = F.sum("velocity_sum") / F.nullif(F.sum("velocity_n"), F.lit(0))
    return pairs.agg(
        total("n").alias("total_records"),
        F.count_distinct("vin").alias("unique_vehicles"),
        F.count_distinct("manufacturer").alias("unique_manufacturers"),
        F.round(average, 2).alias("avg_velocity"),
        F.min("earliest").alias("earliest_message"),
        F.max("latest").alias("latest_message"),
        total("coords").alias("records_with_valid_coords"),
        total("speeds").alias("records_with_valid_velocity"),
        F.round(F.lit(100.0) * F.sum("coords") / F.sum("n"), 2).alias("valid_coords_percentage"),
    )


def last_state_stats(last_state: DataFrame) -> DataFrame:
    """One row: total_vehicles, vehicles_with_door_state, vehicles_with_wipers_state."""
    return last_state.agg(
        F.count(F.lit(1)).alias("total_vehicles"),
        F.count("last_front_left_door_state").alias("vehicles_with_door_state"),
        F.count("last_wipers_state").alias("vehicles_with_wipers_state"),
    )


def manufacturer_summary(silver: DataFrame) -> DataFrame:
    """Per manufacturer: message_count, vehicle_count, avg_velocity (2 places), max_velocity."""
    return (
        silver.groupBy("manufacturer")
        .agg(
            F.count(F.lit(1)).alias("message_count"),
            F.count_distinct("vin").alias("vehicle_count"),
            F.round(F.avg("velocity"), 2).alias("avg_velocity"),
            F.max("velocity").alias("max_velocity"),
        )
        .orderBy(F.asc_nulls_last("manufacturer"))
    )


def gear_counts(silver: DataFrame) -> DataFrame:
    """Rows per numeric gear (NULL included)."""
    return silver.groupBy("gear_position_numeric").agg(F.count(F.lit(1)).alias("message_count"))
