"""Silver: trim names, number gears, drop rows without a vehicle, sort."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.text import gear_number, is_blank, zs_trim
from telemetry_lake.schemas import SILVER_COLUMNS
from telemetry_lake.stamps import compact_stamp


def to_silver(
    bronze: DataFrame,
    processed_at: datetime | str,
    sort: bool = True,
) -> DataFrame:
    """Bronze (with key columns) -> the 20 silver columns.

    Keeps rows whose ``vin`` is not NULL and not only space separators; the
    output ``vin`` itself is untrimmed.  ``manufacturer`` is trimmed,
    ``gear_position`` becomes ``gear_position_numeric`` (NEUTRAL 0, REVERSE
    -1, else NULL) plus ``gear_position_original``.

    ``sort=True`` orders by ``message_datetime`` descending, NULLs last, as the
    reference's output file is.  That is one range shuffle.  Ties are broken
    by a hash of the whole row, then by row position, so that a single instant
    (or a block of copied messages) holding a large share of the rows still
    spreads over many range partitions instead of landing in one task.  The
    hash places distinct rows by content alone; the position only orders exact
    copies, so a re-run map task (whose rows may arrive in another order)
    sends the same multiset of rows to every range partition.
    """
    out = bronze.where(~is_blank("vin")).select(
        "vin",
        zs_trim("manufacturer").alias("manufacturer"),
        "year",
        "model",
        "latitude",
        "longitude",
        "timestamp",
        "message_datetime",
        "velocity",
        "front_left_door_state",
        "wipers_state",
        gear_number("gear_position").alias("gear_position_numeric"),
        F.col("gear_position").alias("gear_position_original"),
        "driver_seatbelt_state",
        "fetch_timestamp",
        "ingestion_timestamp",
        "batch_id",
        "partition_date",
        "partition_hour",
        F.lit(compact_stamp(processed_at)).alias("silver_processing_timestamp"),
    )
    if sort:
        out = (
            out.withColumns({"_h": F.xxhash64(*SILVER_COLUMNS),
                             "_pos": F.monotonically_increasing_id()})
            .orderBy(F.desc_nulls_last("message_datetime"), F.asc("_h"), F.asc("_pos"))
            .drop("_h", "_pos")
        )
    return out.select(*SILVER_COLUMNS)
