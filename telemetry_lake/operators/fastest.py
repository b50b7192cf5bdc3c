"""Ten highest speeds per (date, hour) of the message time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetry_lake.functions.time import report_date, report_hour
from telemetry_lake.stamps import compact_stamp

GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def fastest_per_hour(
    silver: DataFrame,
    generated_at: datetime | str,
    k: int = 10,
    report_tz: str = "UTC",
) -> DataFrame:
    """Gold report: the ``k`` highest non-null velocities of every hour.

    Date and hour are taken in ``report_tz`` (the reference used its session
    zone; here it is explicit).  Rows with a NULL time form one (NULL, NULL)
    hour.  Only velocities are emitted, so ties at rank ``k`` do not change the
    output.  ``row_number <= k`` becomes a WindowGroupLimit on both sides of
    the exchange: a busy hour sends at most ``k`` rows per map task.  The
    optimizer keeps these limits up to a threshold, which is raised in the
    session for a larger ``k``; a limit streams over sorted rows, so its memory
    doesn't grow with ``k``.
    Columns: date_part DATE, hour_part BIGINT, velocity, report_generated_timestamp.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    ranked = silver.where(F.col("velocity").isNotNull()).select(
        report_date("message_datetime", report_tz).alias("date_part"),
        report_hour("message_datetime", report_tz).alias("hour_part"),
        "velocity",
    )
    conf = silver.sparkSession.conf
    if k > int(conf.get(GROUP_LIMIT, "1000")):
        conf.set(GROUP_LIMIT, str(k))
    w = Window.partitionBy("date_part", "hour_part").orderBy(F.desc_nulls_last("velocity"))
    return (
        ranked.withColumn("rn", F.row_number().over(w))
        .where(F.col("rn") <= k)
        .select(
            "date_part",
            "hour_part",
            "velocity",
            F.lit(compact_stamp(generated_at)).alias("report_generated_timestamp"),
        )
        .orderBy(
            F.asc_nulls_last("date_part"),
            F.asc_nulls_last("hour_part"),
            F.desc_nulls_last("velocity"),
        )
    )
