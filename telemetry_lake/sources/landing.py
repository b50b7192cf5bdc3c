"""Landing zone: API responses (JSON arrays of messages) stored as files.

The reference fetches one JSON array per request and refuses anything that is
not a list.  Here each response is a landing file (or a line of one), read in
parallel with one pass: text -> checked ``from_json`` (declared schema,
FAILFAST) -> inline.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_lake.schemas import RAW
from telemetry_lake.stamps import iso_stamp, utc_now

JSON_WHITESPACE = " \t\r\n"
_END = "__end_of_landing_record__"
_WRAPPED = T.StructType([T.StructField("messages", T.ArrayType(RAW)), T.StructField(_END, T.BooleanType())])


def checked_messages(text: Column, where: Column) -> Column:
    """JSON text -> array of ``RAW`` structs; anything but one list of objects fails the job.

    ``from_json`` stops at the end of the first value, so the text is parsed as
    a member of an object whose last member must be reached: text after the
    list is malformed or hides that member.  The first character is checked
    apart, as a lone object would be read as a list of one.
    """
    wrapped = F.concat(F.lit('{"messages":'), text, F.lit(f',"{_END}":true}}'))
    record = F.from_json(wrapped, _WRAPPED, {"mode": "FAILFAST"})
    lead = F.ltrim(text, F.lit(JSON_WHITESPACE))
    whole = lead.startswith("[") & F.coalesce(record[_END], F.lit(False)) & record["messages"].isNotNull()
    objects = ~F.exists(record["messages"], lambda m: m.isNull())
    return F.when(F.coalesce(whole & objects, F.lit(False)), record["messages"]).otherwise(
        F.raise_error(F.concat(F.lit("not one JSON list of messages: "), where))
    )


def parse_landing(
    text_df: DataFrame,
    fetched_at: datetime | str | None = None,
    source: Column | None = None,
    skip_blank: bool = True,
) -> DataFrame:
    """Rows of JSON-array text (column ``value``) -> one row per message.

    Columns: the 12 API fields (schema ``RAW``) + ``fetch_timestamp``.  A
    record that is not one list of objects, text after the list, broken JSON or
    a value of the wrong type fails the job; a missing field is NULL, an
    unknown field is dropped, a number in a text field becomes text.  Blank
    records are skipped, or fail with ``skip_blank=False``.
    """
    stamp = iso_stamp(fetched_at if fetched_at is not None else utc_now())
    src = source if source is not None else F.lit("?")
    records = text_df.select("value", src.alias("_src"))
    if skip_blank:
        records = records.where(F.ltrim(F.col("value"), F.lit(JSON_WHITESPACE)) != "")
    parsed = records.select(checked_messages(F.col("value"), F.col("_src")).alias("_msgs"))
    # ``inline`` turns the array of structs straight into rows and columns.
    messages = parsed.select(F.inline("_msgs"))
    return messages.select(*[F.col(f.name) for f in RAW.fields],
                           F.lit(stamp).alias("fetch_timestamp"))


def _refuse_empty_files(spark: SparkSession, path: str) -> None:
    """Spark's readers pass over files of no bytes; as responses they are faults.

    Spark's own listing knows the empty files, its scans leave them out: the
    two numbers differ if there is one.  Names are looked at only then.
    """
    files = spark.read.option("recursiveFileLookup", "true").format("binaryFile").load(path).select("path", "length")
    listed = files._jdf.inputFiles()
    if len(listed) == files.count():
        return
    read = {row.path for row in files.select("path").toLocalIterator()}
    for name in listed:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(name))
        if p.toString() not in read:
            raise ValueError(f"empty landing response: {p.toString()}")


def read_landing(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    fetched_at: datetime | str | None = None,
) -> DataFrame:
    """Read landing files below ``path``.

    ``multi_line=True``: each file is one API response (may be pretty
    printed; a file is one task), and a blank or empty one fails.
    ``multi_line=False``: each line is one response (files split across
    tasks), blank lines are skipped.
    """
    if multi_line:
        _refuse_empty_files(spark, path)
    reader = spark.read.option("recursiveFileLookup", "true")
    text = reader.text(path, wholetext=multi_line)
    return parse_landing(text, fetched_at, F.col("_metadata.file_path"), skip_blank=not multi_line)


def write_landing(raw: DataFrame, path: str, page_column: str, file_per_page: bool = True) -> str:
    """Store raw messages as JSON-array responses, one array per ``page_column`` value.

    ``file_per_page=True`` writes ``path/page=<n>/`` with one single-line file
    each (readable with ``multi_line=True``); else pages are lines of
    shared files (``multi_line=False``).  Pages are bounded groups (one API
    response), so collecting one into an array is safe.
    """
    cols = [c for c in raw.columns if c != page_column]
    pages = raw.groupBy(F.col(page_column).alias("page")).agg(
        F.to_json(F.collect_list(F.struct(*cols))).alias("value")
    )
    if file_per_page:
        pages.repartition("page").write.mode("errorifexists").partitionBy("page").text(path)
    else:
        pages.select("value").write.mode("errorifexists").text(path)
    return path
