"""URL rules by a sort-merge range join, in DataFrame operations only.

A rule (host, path) covers its host and all subdomains where the path starts
with the rule's.  With hosts written label by label from the right
(``com.example.www``), a separator and the path, a rule is a key prefix, so the
keys it covers on one host form an interval.  A URL probes with one key per
host suffix (as many as it has labels).  Rules and probes are range-partitioned
and sorted together; the sweep carries the stack of nested rules that the last
rule opened, and a probe takes the deepest entry of the stack that is a prefix
of its own key.  Partitions start with the last stack of those before them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemetry_lake.llm.frames import saved, table

#: The contract's rules: fixed values.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEP = "\u0001"  # between host and path: sorts before every host character
_URL = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


def host_of(url):
    """From the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url):
    """After the host up to ``? #`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _reversed(host):
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def rule_keys(rules: DataFrame) -> DataFrame:
    """Rules (verdict, host, path) -> (key, rule, verdict, stack).

    ``stack``: the rules whose keys are prefixes of this key, this one included,
    outermost first, as structs (key, rule, verdict).  Enclosing rules are found
    by an equi-join on the key's prefixes, so the work grows with the rules'
    lengths, not with pairs of rules.  Of rules with the same host and path,
    ``block`` stands.
    """
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    path = F.coalesce("path", F.lit(""))
    keyed = (
        rules.select(
            F.concat(_reversed(host), F.lit(_SEP), path).alias("key"),
            F.concat(host, path).alias("rule"),
            "verdict",
        )
        .groupBy("key", "rule")
        .agg(F.max("verdict").alias("verdict"))
    )
    host_length = F.instr("key", _SEP)
    prefixes = keyed.select(
        "key",
        F.explode(F.sequence(host_length, F.length("key"))).alias("_n"),
    ).select("key", F.expr("substr(key, 1, _n)").alias("outer"))
    outer = keyed.select(
        F.col("key").alias("outer"), F.struct("key", "rule", "verdict").alias("entry")
    )
    stacks = prefixes.join(outer, "outer").groupBy("key").agg(F.sort_array(F.collect_list("entry")).alias("stack"))
    return keyed.join(stacks, "key")


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", default: str = "allow") -> DataFrame:
    """Judge every url: (id, host, path, rule, verdict).

    The longest fitting rule (host and path together; of equal lengths the
    longer host) gives the verdict; without one ``rule`` is NULL and the verdict
    ``default``.  A NULL url or one without ``://`` has an empty host and path,
    which only a rule with empty host and path would cover.  Rows repeated with
    the same id and url are each judged; empty tables give no rows; other
    columns of ``pages`` are ignored.
    """
    urls = pages.select(F.col(id_col).alias("id"), host_of("url").alias("host"), path_of("url").alias("path"))
    parts = F.split("host", r"\.", -1)
    labels = F.size(parts)
    probes = urls.select("host", "path").distinct().select(
        "host", "path", F.explode(F.sequence(F.lit(1), labels)).alias("_k"), parts.alias("_l")
    ).select(
        F.concat(
            F.array_join(F.reverse(F.slice("_l", -F.col("_k"), F.col("_k"))), "."), F.lit(_SEP), F.col("path")
        ).alias("key"),
        F.lit(1).alias("kind"),
        "host",
        "path",
    )
    keys = rule_keys(rules)
    stack_type = keys.schema["stack"].dataType
    events = keys.select(
        "key", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("host"),
        F.lit(None).cast("string").alias("path"), "stack",
    ).unionByName(probes.withColumn("stack", F.lit(None).cast(stack_type)))
    # One range exchange for rules and probes; written once, so the sweep and
    # the carried stacks see the same partitions.
    ranged = saved(
        events.repartitionByRange("key", "kind", "host", "path").withColumn("part", F.spark_partition_id()),
        "url_events",
    )
    carried = (
        ranged.where("kind = 0").groupBy("part").agg(F.max_by("stack", "key").alias("carry"))
    )
    # one row per partition: the last stack opened before it
    starts = (
        ranged.select("part").distinct().join(carried, "part", "left")
        .select("part", F.last("carry", True).over(
            Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)).alias("carry"))
    )
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = (
        ranged.withColumn("open", F.last("stack", True).over(sweep))
        .where("kind = 1")
        .join(starts, "part")
        .select("host", "path", "key", F.coalesce("open", "carry").alias("open"))
    )
    fit = F.try_element_at(F.filter("open", lambda e: F.col("key").startswith(e["key"])), F.lit(-1))
    best = (
        swept.select("host", "path", fit.alias("fit"))
        .where("fit is not null")
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    F.length("fit.rule").alias("size"), F.instr("fit.key", _SEP).alias("host_size"),
                    F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("verdict"),
                )
            ).alias("best")
        )
    )
    return urls.join(best, ["host", "path"], "left").select(
        F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )


def rules_frame(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def op7_url_filter(spark, sf_dir):
    """Every page under the contract's rules."""
    return url_filter(table(spark, sf_dir, "pages"), rules_frame(spark))


def _fits(host: str, path: str) -> str:
    return f"((host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}'))"


OP7_SQL = (
    r"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE """
    + " ".join(
        f"WHEN {_fits(h, p)} THEN '{h}{p}'" for _, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    )
    + """ END AS rule FROM u)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ("""
    + ", ".join(f"'{h}{p}'" for v, h, p in RULES if v == "block")
    + """) THEN 'block' ELSE 'allow' END AS verdict
FROM r"""
)
