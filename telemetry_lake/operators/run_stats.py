"""Statistics kept per bronze batch and merged on read.

A batch leaves one row of mergeable partial figures, so the figures of the
whole dataset come from as many rows as there were batches.  Counts, limits and
sums are exact.  Distinct vehicles and manufacturers are HyperLogLog sketches:
with ``2**LG_K`` registers the estimate's standard error is about
``1.04 / sqrt(2**LG_K)`` (0.8 % at 14), and small counts are nearly exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.operators.stats import valid_coordinates, valid_velocity

LG_K = 14
STANDARD_ERROR = 1.04 / 2 ** (LG_K / 2)


def partial_stats(bronze: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """One row of mergeable figures of the messages, in one pass without a shuffle of them."""
    return bronze.agg(
        F.count(F.lit(1)).alias("records"),
        F.min("message_datetime").alias("earliest"),
        F.max("message_datetime").alias("latest"),
        F.coalesce(F.sum("velocity"), F.lit(0.0)).alias("velocity_sum"),
        F.count("velocity").alias("velocity_n"),
        F.count_if(valid_coordinates()).alias("coords"),
        F.count_if(valid_velocity()).alias("speeds"),
        F.hll_sketch_agg("vin", lg_k).alias("vin_sketch"),
        F.hll_sketch_agg("manufacturer", lg_k).alias("manufacturer_sketch"),
    )


def append_stats(bronze: DataFrame, path: str, batch_id: str) -> str:
    """Store the partial figures of one batch in a folder of its own: a batch written again replaces its figures."""
    partial_stats(bronze).coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")
    return path


def merged_stats(partials: DataFrame) -> DataFrame:
    """One row of figures over all stored batches; no batch at all gives zeros and NULLs.

    unique_vehicles and unique_manufacturers are estimates (see above).
    """
    merged = partials.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("records", "velocity_n", "coords", "speeds")],
        F.sum("velocity_sum").alias("velocity_sum"),
        F.min("earliest").alias("earliest"),
        F.max("latest").alias("latest"),
        *[F.hll_union_agg(c).alias(c) for c in ("vin_sketch", "manufacturer_sketch")],
    )
    return merged.select(
        F.col("records").alias("total_records"),
        F.coalesce(F.hll_sketch_estimate("vin_sketch"), F.lit(0)).alias("unique_vehicles"),
        F.coalesce(F.hll_sketch_estimate("manufacturer_sketch"), F.lit(0)).alias("unique_manufacturers"),
        F.round(F.col("velocity_sum") / F.nullif("velocity_n", F.lit(0)), 2).alias("avg_velocity"),
        F.col("earliest").alias("earliest_message"),
        F.col("latest").alias("latest_message"),
        F.col("coords").alias("records_with_valid_coords"),
        F.col("speeds").alias("records_with_valid_velocity"),
    )
