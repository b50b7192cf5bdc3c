"""DataFrame helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm_{name}")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b: long) as rows (id, component).

    Alternating large-star and small-star rounds (Kiveris et al. 2014): every
    round is two grouped minima and two joins on the edges, which stay linear
    in number; rounds grow with the logarithm of the component size.  Ends when
    the edges stay the same.
    """
    edges = saved(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    before = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        edges = saved(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("connected components did not settle")
    return edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "id").unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )
