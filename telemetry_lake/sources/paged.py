"""Paged API source: a Python Data Source that stores one row per response.

Requests carry only an amount, so pages are independent draws; all pages are
requested at once by parallel tasks and stored as they came, one row per page,
the empty ones too.  The stopping rule is applied when the stored pages are
read: the read ends with the first page that brings the running total to the
wanted amount or holds fewer messages than were still to be asked for.  A page
longer than asked is kept whole.  Because Spark may re-run a task, and a re-run
request to a live API returns other messages, pages are written to a table once
(``fetch_pages``) and every later step reads that table.
"""

from __future__ import annotations

import sys
import urllib.request
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from telemetry_lake.schemas import RAW
from telemetry_lake.sources.landing import checked_messages

PAGE_SCHEMA = "page BIGINT, requested INT, batch_size INT, total_amount BIGINT, body STRING"
STORED_SCHEMA = PAGE_SCHEMA + ", page_rows BIGINT"  # and the number of messages, counted once
MAX_TASKS = 4096  # fetch tasks when pages_per_partition is left to the source
RUN = 4096  # pages whose running totals one window group holds


def plan_pages(total_amount: int, batch_size: int) -> list[int]:
    """Requested amount of each page, in order, when every page is full."""
    if total_amount <= 0:
        return []
    size = max(1, batch_size)
    return [min(size, total_amount - start) for start in range(0, total_amount, size)]


def _fetch(url: str, timeout: float) -> str:
    """Body of a response: over HTTP, or a stored one from any file system that pyarrow knows (file, hdfs, s3, gs, ...).

    A folder must hold exactly one file that isn't hidden.
    """
    if urlparse(url).scheme in ("http", "https"):
        with urllib.request.urlopen(url, timeout=timeout) as resp:  # noqa: S310 (http only)
            return resp.read().decode("utf-8")
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(url.replace("file:/", "file:///", 1) if urlparse(url)[:2] == ("file", "") else url)
    if system.get_file_info(path).type == fs.FileType.Directory:
        found = [f.path for f in system.get_file_info(fs.FileSelector(path)) if not f.base_name.startswith((".", "_"))]
        if len(found) != 1:
            raise ValueError(f"page folder {url} must hold exactly one file")
        path = found[0]
    with system.open_input_stream(path) as stream:
        return stream.read().decode("utf-8")


def _page_amount(page: int, total_amount: int, size: int) -> int:
    """Requested amount of page ``page`` (same numbers as ``plan_pages``)."""
    return min(size, total_amount - page * size)


class _Pages:
    """Options of a read and the fetch of its pages."""

    # Only scalars travel with each task; a page's amount is computed on the
    # executor, so a million pages do not ship a million-entry list per task.
    def __init__(self, options: dict[str, str]):
        self.template = options["url_template"]
        self.total = max(0, int(options.get("total_amount", "0")))
        self.size = max(1, int(options.get("batch_size", "1000")))
        self.pages = -(-self.total // self.size)  # ceil
        per_task = int(options.get("pages_per_partition", "0"))
        self.per_task = per_task if per_task > 0 else max(1, -(-self.pages // MAX_TASKS))
        self.timeout = float(options.get("timeout", "30"))
        self.options = options

    def parts(self, first: int, end: int) -> list[InputPartition]:
        return [InputPartition((at, min(at + self.per_task, end))) for at in range(first, end, self.per_task)]

    def rows(self, partition: InputPartition):
        for page in range(*partition.value):
            amount = _page_amount(page, self.total, self.size)
            body = _fetch(self.template.format(page=page, amount=amount), self.timeout)
            if not body.lstrip().startswith("["):
                raise ValueError(f"response of page {page} is not a JSON list")
            yield (page, amount, self.size, self.total, body)


class _PageReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.of = _Pages(options)

    def partitions(self):
        return self.of.parts(0, self.of.pages)

    def read(self, partition):
        return self.of.rows(partition)


class _PageStreamReader(DataSourceStreamReader):
    """Offsets are page numbers; a micro-batch has ``pages_per_batch`` pages at most.

    The reader offers the pages after those it has planned or was told are
    stored (``start_page``, for a query that goes on from a checkpoint).
    """

    def __init__(self, options: dict[str, str]):
        self.of = _Pages(options)
        self.per_batch = max(1, int(options.get("pages_per_batch", "100")))
        self.planned = int(options.get("start_page", "0"))

    def initialOffset(self) -> dict:
        return {"page": 0}

    def latestOffset(self) -> dict:
        return {"page": max(self.planned, min(self.of.pages, self.planned + self.per_batch))}

    def partitions(self, start: dict, end: dict):
        self.planned = max(self.planned, end["page"])
        return self.of.parts(start["page"], end["page"])

    def read(self, partition):
        return self.of.rows(partition)


class VehicleMessagesSource(DataSource):
    """``spark.read.format("vehicle_messages")`` with options ``url_template``
    (``{page}`` and ``{amount}`` are filled in), ``total_amount``,
    ``batch_size`` (<= 0 means 1), ``pages_per_partition`` (consecutive pages
    fetched by one task; by default one page, and more only so that there are
    at most ``MAX_TASKS`` tasks) and ``timeout`` seconds.
    One row per page: page, requested, batch_size, total_amount, body (the
    response text).  As a stream, also ``pages_per_batch`` and ``start_page``.
    """

    @classmethod
    def name(cls) -> str:
        return "vehicle_messages"

    def schema(self) -> str:
        return PAGE_SCHEMA

    def reader(self, schema):
        return _PageReader(self.options)

    def streamReader(self, schema):
        return _PageStreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Register the source; its code travels with the plan (pickled by value),
    so Python workers need not have this package installed."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(VehicleMessagesSource)


def fetch_pages(
    spark: SparkSession,
    url_template: str,
    total_amount: int,
    batch_size: int,
    pages_path: str,
    pages_per_partition: int = 0,
) -> str:
    """Fetch every page in parallel and store the raw pages once (Parquet)."""
    register(spark)
    (
        spark.read.format("vehicle_messages")
        .option("url_template", url_template)
        .option("total_amount", str(total_amount))
        .option("batch_size", str(batch_size))
        .option("pages_per_partition", str(pages_per_partition))
        .load()
        .withColumn("page_rows", _page_rows())
        .write.mode("errorifexists")
        .parquet(pages_path)
    )
    return pages_path


def _page_rows() -> Column:
    """Number of messages of a stored body, without reading them; NULL if it can't be told (then parsing refuses it)."""
    return F.json_array_length("body").cast("long")


def write_pages(responses: DataFrame, pages_path: str, total_amount: int, batch_size: int) -> str:
    """Store responses that are already there (page, body) as ``fetch_pages`` would."""
    total, size = F.lit(total_amount).cast("long"), F.lit(max(1, batch_size))
    responses.select(
        F.col("page").cast("long").alias("page"),
        F.least(size.cast("long"), total - F.col("page") * size).cast("int").alias("requested"),
        size.cast("int").alias("batch_size"),
        total.alias("total_amount"),
        "body",
        _page_rows().alias("page_rows"),
    ).write.mode("errorifexists").parquet(pages_path)
    return pages_path


def last_page(sizes: DataFrame, already: int = 0) -> DataFrame:
    """(stop): the page that ends the read; NULL when the stored pages run out first.

    ``sizes``: (page, page_rows, batch_size, total_amount); ``already``: messages
    of the pages before these.  The messages before a page are summed in two
    steps, within runs of ``RUN`` pages and over the totals of the runs, so no
    task orders all pages.
    """
    runs = sizes.withColumn("run", F.floor(F.col("page") / RUN))
    over_runs = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    earlier = runs.groupBy("run").agg(F.sum("page_rows").alias("n")).select(
        "run", (F.coalesce(F.sum("n").over(over_runs), F.lit(0)) + F.lit(already)).alias("earlier")
    )
    in_run = Window.partitionBy("run").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("earlier") + F.coalesce(F.sum("page_rows").over(in_run), F.lit(0))
    placed = runs.join(earlier, "run").withColumn("before", before)
    wanted = F.least(F.col("batch_size").cast("long"), F.col("total_amount") - F.col("before"))
    ends = (F.col("page_rows") < wanted) | (F.col("before") + F.col("page_rows") >= F.col("total_amount"))
    return placed.where(ends).agg(F.min("page").alias("stop"))


def page_messages(pages: DataFrame, *keep: str) -> DataFrame:
    """Stored pages -> messages (``RAW`` columns); a body is refused for what a landing record is refused for.

    ``keep``: columns of the page that its messages get too.
    """
    name = F.concat(F.lit("page "), F.col("page").cast("string"))
    return pages.select(*keep, F.inline(checked_messages(F.col("body"), name)))


def read_pages(spark: SparkSession, pages_path: str) -> DataFrame:
    """Stored pages -> messages (``RAW`` columns) up to the page that ends the read.

    Pages beyond it aren't parsed.  An empty page counts as short; no pages, no
    rows.  The counts are read from their own column, the bodies once.
    """
    pages = spark.read.schema(STORED_SCHEMA).parquet(pages_path)
    stop = last_page(pages.select("page", "page_rows", "batch_size", "total_amount")).scalar()
    return page_messages(pages.where(stop.isNull() | (F.col("page") <= stop)))
