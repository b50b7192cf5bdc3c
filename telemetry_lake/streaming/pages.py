"""Incremental ingestion of a paged API: pages -> bronze as a stream.

The reference's batch generator yields page after page and ends with an empty
or short one, or when the wanted amount is reached.  Here the paged source is a
stream whose offsets are page numbers.  A micro-batch's pages are fetched on
the executors and stored once, before anything reads them: a re-run request
would return other messages.  The stopping rule is applied to the stored
counts; pages up to the last one go through the batch writer.  That writes a
file or more for each hour however few the messages, so it takes the stored
micro-batches of some time together, and the files of bronze grow with the
time and the messages, not with the number of micro-batches.  A query that is
started again goes on after the pages that are stored.
"""

from __future__ import annotations

import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.operators.bronze import to_bronze
from telemetry_lake.sources.paged import STORED_SCHEMA, _page_rows, last_page, page_messages, register
from telemetry_lake.sources.versions import hadoop
from telemetry_lake.stamps import default_batch_id, iso_stamp, utc_now
from telemetry_lake.streaming.incremental import write_micro_batch

_STORED = STORED_SCHEMA + ", micro_batch BIGINT"
_STAMPS = ["fetch_timestamp", "ingestion_timestamp", "batch_id"]  # of a micro-batch, stored with its pages
_STAMPED = STORED_SCHEMA + "".join(f", {name} STRING" for name in _STAMPS)
WRITE_S = 60.0  # seconds after which stored micro-batches are written to bronze, at the next one


def _stamped_bronze(pages: DataFrame) -> DataFrame:
    return to_bronze(page_messages(pages, *_STAMPS), batch_id=F.col("batch_id"), ingested_at=F.col("ingestion_timestamp"))


def _stop(sizes: DataFrame, already: int) -> int | None:
    """The page that ends the read; no page is placed if all are full and together don't bring the total."""
    full = F.coalesce(F.col("page_rows") >= F.col("batch_size"), F.lit(False))
    all_full, n, total = sizes.agg(F.bool_and(full), F.sum("page_rows"), F.max("total_amount")).first()
    return None if all_full and already + n < total else last_page(sizes, already).first()["stop"]


class _Progress:
    """What the stored micro-batches say: pages, messages and whether the read has ended."""

    def __init__(self, spark: SparkSession, pages_path: str, total_amount: int):
        self.spark, self.path, self.total = spark, pages_path.rstrip("/"), total_amount

    def done(self, number: int) -> None:
        """Mark a micro-batch whose messages, like those of all before it, are in bronze."""
        _, fs, marker = hadoop(self.spark, f"{self.path}/_done/{number}")
        fs.create(marker, True).close()

    def last_done(self) -> int:
        _, fs, folder = hadoop(self.spark, f"{self.path}/_done")
        return max((int(s.getPath().getName()) for s in fs.listStatus(folder)), default=-1) if fs.exists(folder) else -1

    def before(self, number: int | None = None) -> tuple[int, int, bool]:
        """(next page, messages up to the end, ended) of the micro-batches before ``number``, or of all that are done.

        The next page counts all stored ones: an unfinished micro-batch is
        planned already and will be taken again, or is only not yet in bronze.
        """
        _, fs, path = hadoop(self.spark, self.path)
        if not fs.exists(path):
            return 0, 0, self.total <= 0
        rows = self.spark.read.schema(_STORED).parquet(self.path)
        at = rows.agg(F.max("page")).first()[0]
        rows = rows.where(F.col("micro_batch") < (self.last_done() + 1 if number is None else number))
        stop = last_page(rows.select("page", "page_rows", "batch_size", "total_amount")).first()["stop"]
        n = (rows if stop is None else rows.where(F.col("page") <= stop)).agg(F.sum("page_rows")).first()[0]
        return (0 if at is None else at + 1), n or 0, stop is not None or self.total <= 0


def stream_pages_to_bronze(
    spark: SparkSession,
    url_template: str,
    total_amount: int,
    batch_size: int,
    pages_path: str,
    bronze_path: str,
    checkpoint_path: str,
    pages_per_batch: int = 100,
    pages_per_partition: int = 1,
    batch_id: str | None = None,
    fetched_at: datetime | str | None = None,
    ingested_at: datetime | str | None = None,
    poll_s: float = 0.2,
    write_s: float = WRITE_S,
) -> dict:
    """Stream pages into bronze until the read ends; returns {"pages", "messages", "ended"}.

    The read ends with the first page that is short or empty or brings the
    total to ``total_amount``; later pages, also those of the same micro-batch,
    are stored but not read.  A micro-batch without messages writes nothing.
    A page longer than asked is kept whole.  Stopped or failed runs go on where
    they were with the same paths; a run after the end does nothing.  Without
    stamps, every micro-batch has its own.

    Every micro-batch is stored and parsed, and refused, by itself; those
    stored are written to bronze together, by the first one that ends
    ``write_s`` seconds after the last such write, and when the read ends or
    fails (0: each at once).  What a killed run had stored and not written,
    the next one writes.
    """
    register(spark)
    progress = _Progress(spark, pages_path, total_amount)
    start, messages, ended = progress.before()
    if ended:
        return {"pages": start, "messages": messages, "ended": True}
    path = pages_path.rstrip("/")
    # micro-batches from ``first`` to ``last`` are stored, with ``waiting`` messages, but not in bronze
    state = {"known": None, "ended": False, "first": progress.last_done() + 1, "last": None, "waiting": 0,
             "replay": True, "written": time.monotonic()}

    def write(stop: int | None = None) -> None:
        first, last, waiting = state["first"], state["last"], state["waiting"]
        if last is None:
            return
        state.update(first=last + 1, last=None, waiting=0)  # a write that fails is left to the next run
        if waiting:
            folders = [f"{path}/micro_batch={k}" for k in range(first, last + 1)]
            pages = spark.read.schema(_STAMPED).parquet(*folders)
            kept = pages if stop is None else pages.where(F.col("page") <= stop)
            write_micro_batch(_stamped_bronze(kept), bronze_path, checkpoint_path, first, replay=state["replay"])
            state["replay"] = False
        progress.done(last)
        state["written"] = time.monotonic()

    def take(batch: DataFrame, number: int) -> None:
        if state["ended"] or number < state["first"]:  # the latter: in bronze, only Spark's own mark is missing
            return
        now = utc_now()
        stamps = [iso_stamp(fetched_at or now), iso_stamp(ingested_at or now), batch_id or default_batch_id(now, "stream")]
        stored = batch.withColumn("page_rows", _page_rows()).withColumns(dict(zip(_STAMPS, map(F.lit, stamps), strict=True)))
        folder = f"{path}/micro_batch={number}"
        stored.write.mode("overwrite").parquet(folder)
        pages = spark.read.schema(_STAMPED).parquet(folder)
        if state["known"] is None:
            state["known"] = progress.before(number)[1]
            state["waiting"] = state["known"] - messages  # of an earlier run
        stop = _stop(pages.select("page", "page_rows", "batch_size", "total_amount"), state["known"])
        kept = pages if stop is None else pages.where(F.col("page") <= stop)
        bronze = _stamped_bronze(kept)  # every value is made here once, so a page that is refused fails its own micro-batch
        n = bronze.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*bronze.columns))).first()["n"]
        state.update(known=state["known"] + n, waiting=state["waiting"] + n, last=number)
        if stop is not None or time.monotonic() - state["written"] >= write_s:
            write(stop)
        state["ended"] = stop is not None

    source = (
        spark.readStream.format("vehicle_messages")
        .option("url_template", url_template)
        .option("total_amount", str(total_amount))
        .option("batch_size", str(batch_size))
        .option("pages_per_partition", str(pages_per_partition))
        .option("pages_per_batch", str(pages_per_batch))
        .option("start_page", str(start))
        .load()
    )
    query = source.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_path).trigger(
        processingTime="0 seconds"
    ).start()
    try:  # the last page that is asked for brings the total or is short, so the end is always found
        while not state["ended"] and not query.awaitTermination(poll_s):
            pass
    finally:
        query.stop()
        write()
    at, messages, ended = progress.before()
    return {"pages": at, "messages": messages, "ended": ended}
