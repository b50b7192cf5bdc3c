"""Incremental ingestion: landing files -> bronze with Structured Streaming.

The reference's batch generator (pages yielded one by one) becomes a file
stream over the landing zone: ``maxFilesPerTrigger`` responses per
micro-batch, ``availableNow`` to drain what has landed and stop.  Every
micro-batch goes through the batch writer (``write_bronze``, append), so stream
and batch runs share one dataset without a metadata log, and a busy hour is
split by the rebalance.  A restarted query resumes from the checkpoint; the
files of a micro-batch carry a hash of the checkpoint path and the batch's number, and the
first batch of a run removes what an unfinished run of it left.
"""

from __future__ import annotations

import hashlib
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telemetry_lake.functions.time import utc_wall_clock
from telemetry_lake.operators.bronze import to_bronze
from telemetry_lake.sources.bronze_store import remove_files, write_bronze
from telemetry_lake.sources.landing import parse_landing
from telemetry_lake.stamps import iso_stamp


def landing_stream(
    spark: SparkSession,
    landing_path: str,
    max_files_per_trigger: int = 100,
    multi_line: bool = True,
) -> DataFrame:
    """Streaming DataFrame of landing records (column ``value``)."""
    return (
        spark.readStream.format("text")
        .option("wholetext", str(multi_line).lower())
        .option("maxFilesPerTrigger", str(max_files_per_trigger))
        .option("recursiveFileLookup", "true")
        .load(landing_path)
    )


def _batch_stamp(fmt: str):
    # current_timestamp() is fixed per micro-batch in a streaming query.
    return F.date_format(utc_wall_clock(F.current_timestamp()), fmt)


def write_micro_batch(batch: DataFrame, bronze_path: str, checkpoint_path: str, number: int,
                      replay: bool = True) -> None:
    """Append micro-batch ``number`` of the stream with this checkpoint.

    ``replay``: the batch may have been written before; its files are removed
    first, so writing it again adds nothing.
    """
    stream = hashlib.sha256(checkpoint_path.rstrip("/").encode()).hexdigest()[:12]
    prefix = f"stream{stream}b{number}"
    if replay:
        remove_files(batch.sparkSession, bronze_path, prefix)
    write_bronze(batch, bronze_path, mode="append", file_prefix=prefix)


def stream_to_bronze(
    spark: SparkSession,
    landing_path: str,
    bronze_path: str,
    checkpoint_path: str,
    max_files_per_trigger: int = 100,
    multi_line: bool = True,
    batch_id: str | None = None,
    fetched_at: datetime | str | None = None,
    ingested_at: datetime | str | None = None,
    trigger_interval: str | None = None,
) -> StreamingQuery:
    """Start the landing -> bronze stream; returns the query.

    Default trigger ``availableNow``: drain what has landed, then stop (a
    scheduled job).  ``trigger_interval`` (e.g. ``"1 minute"``) keeps the
    query running with a processing-time trigger instead.

    Without ``fetched_at`` / ``ingested_at`` / ``batch_id`` every micro-batch
    is stamped with its own trigger time (batch id ``stream_<yyyyMMdd_HHmmss>``);
    with them, the given literals are used (tests).
    """
    raw = parse_landing(
        landing_stream(spark, landing_path, max_files_per_trigger, multi_line),
        fetched_at,
        skip_blank=not multi_line,
    )
    fixed_ingest = ingested_at if ingested_at is not None else "1970-01-01T00:00:00"
    bronze = to_bronze(raw, batch_id=batch_id or "stream", ingested_at=fixed_ingest,
                       fetched_at=fetched_at)
    if ingested_at is None:
        bronze = bronze.withColumn(
            "ingestion_timestamp", _batch_stamp("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        )
    else:
        bronze = bronze.withColumn("ingestion_timestamp", F.lit(iso_stamp(ingested_at)))
    if fetched_at is None:
        bronze = bronze.withColumn(
            "fetch_timestamp", _batch_stamp("yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        )
    if batch_id is None:
        bronze = bronze.withColumn(
            "batch_id", F.concat(F.lit("stream_"), _batch_stamp("yyyyMMdd_HHmmss"))
        )
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(bronze_path)
    log = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, "_spark_metadata")
    if root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(log):
        raise ValueError(f"{bronze_path} was written by a file sink, whose log hides other files")
    first = True

    def append(batch: DataFrame, number: int) -> None:
        nonlocal first
        write_micro_batch(batch, bronze_path, checkpoint_path, number, replay=first)
        first = False

    writer = (
        bronze.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint_path)
        .outputMode("append")
    )
    if trigger_interval:
        writer = writer.trigger(processingTime=trigger_interval)
    else:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_stream_to_bronze(spark: SparkSession, *args, timeout_s: float | None = None, **kwargs) -> str:
    """Run ``stream_to_bronze`` until everything landed so far is in bronze."""
    query = stream_to_bronze(spark, *args, **kwargs)
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError("landing stream did not finish in time")
    if query.exception() is not None:
        raise query.exception()
    return args[1] if len(args) > 1 else kwargs["bronze_path"]
