"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every result as Parquet and reads it back as the next stage's documents.  All
stages but the last return the columns of their input.

NULL texts count as empty.  Decisions of the classifier, of exact dedup and of
decontamination are taken and applied row by row, so different texts that share
a doc_id, and rows without one, stand for themselves.  For near duplicates
the texts of one doc_id are one document, which stays or goes whole; rows
without doc_id stay there.  Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm import decontamination, exact_dedup, near_dedup, packing, quality
from telemetry_lake.llm.frames import saved, table

NEAR_PERCENT = 80  # similarity of near duplicates, on five-word shingles


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    return docs.join(ids.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_anti").select(
        *[docs[c] for c in docs.columns]
    )


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id; of rows repeated with that id one.

    What goes is named by doc_id and text, so a text stays if only its id is shared.
    """
    judged = saved(exact_dedup.exact_dedup(*exact_dedup.split_batches(docs)), "judged")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))  # both NULL: a text without any id
    named = [F.col("doc_id").alias("of_id"), F.col("text_sha256").alias("of_text")]
    lost = saved(judged.where(~stays).select(*named).distinct(), "lost")
    again = judged.where(stays).groupBy(*named).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = saved(again, "again")
    with_text = docs.withColumn("own_text", exact_dedup.text_sha256())
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("own_text") == F.col("of_text"))
    kept = with_text.join(lost, same, "left_anti")
    if again.limit(1).count():
        once = kept.join(again, same, "left_semi").dropDuplicates(["own_text"])
        kept = kept.join(again, same, "left_anti").unionByName(once)
    return kept.select(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id."""
    groups = near_dedup.near_dedup(docs, percent=NEAR_PERCENT)
    return _without(docs, groups.where("not kept"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no near copy of a benchmark item; a row is known by a hash of its id and text."""
    key = F.xxhash64("doc_id", "text")
    leaks = decontamination.matches(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    leaks = saved(leaks.select(F.col("doc_id").alias("leak")).distinct(), "leaks")
    return docs.join(leaks, key == F.col("leak"), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 ids."""
    return packing.pack(docs)


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", distinct_texts),
    ("near_dedup", one_of_near_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]

#: No SQL can express the classifier or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs
