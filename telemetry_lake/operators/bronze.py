"""Bronze: stamp, rename and key raw messages (one projection, no shuffle)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.functions.time import instant_from_millis, partition_date, partition_hour
from telemetry_lake.schemas import BRONZE, RAW, RENAMES
from telemetry_lake.stamps import default_batch_id, iso_stamp, utc_now


def to_bronze(
    raw: DataFrame,
    batch_id: str | Column | None = None,
    fetched_at: datetime | str | None = None,
    ingested_at: datetime | str | Column | None = None,
) -> DataFrame:
    """Raw API messages -> the 18 bronze columns (16 data + 2 keys).

    * ``fetch_timestamp``: kept from ``raw`` when present and ``fetched_at`` is
      None, else the literal ``fetched_at`` (one value per batch).
    * ``ingestion_timestamp``: literal ISO stamp of this write.
    * ``batch_id``: given, else ``batch_<yyyyMMdd_HHmmss>`` of the ingest time
      (an empty string also takes the default).
    * ``batch_id`` and ``ingested_at`` may be columns of ``raw``, for rows of several writes.
    * ``message_datetime``: the epoch-millisecond ``timestamp`` as an instant.
    * ``partition_date`` / ``partition_hour``: its UTC date and two-digit hour,
      NULL for a NULL timestamp.
    Fields other than the 12 API fields are dropped; missing ones are NULL,
    and a NaN in a DOUBLE field (JSON ``NaN``) is stored as NULL, as the
    reference's frame-to-table path does.
    """
    ingested = ingested_at if ingested_at is not None else utc_now()
    if not isinstance(batch_id, Column) and not batch_id:
        if isinstance(ingested, str | Column):
            raise ValueError("batch_id is required when ingested_at is a string")
        batch_id = default_batch_id(ingested)
    stamp = ingested if isinstance(ingested, Column) else F.lit(iso_stamp(ingested))
    if fetched_at is not None:
        fetch_col = F.lit(iso_stamp(fetched_at))
    elif "fetch_timestamp" in raw.columns:
        fetch_col = F.col("fetch_timestamp").cast("string")
    else:
        fetch_col = stamp

    present = set(raw.columns)
    fields = {}
    for f in RAW.fields:
        src = (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType)
        if isinstance(f.dataType, T.DoubleType):
            src = F.nanvl(src, F.lit(None).cast("double"))
        fields[RENAMES.get(f.name, f.name)] = src
    instant = instant_from_millis(fields["timestamp"])
    fields["message_datetime"] = instant
    fields["fetch_timestamp"] = fetch_col
    fields["ingestion_timestamp"] = stamp
    fields["batch_id"] = F.lit(batch_id)
    fields["partition_date"] = partition_date(instant)
    fields["partition_hour"] = partition_hour(instant)
    return raw.select(*[fields[name].alias(name) for name in BRONZE.fieldNames()])
