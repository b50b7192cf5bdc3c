import pytest

from conftest import bronze_rows
from telemetry_lake.operators import pattern_violations
from telemetry_lake.schemas import STRICT_PATTERNS


def _viol(spark, rows, **kw):
    return {r.vin: r.violating_column for r in pattern_violations(bronze_rows(spark, rows), **kw).collect()}


def test_first_column_wins(spark):
    assert _viol(spark, [{"vin": "a;b", "model": "DROP"}]) == {"a;b": "vin"}


def test_case_sensitive(spark):
    assert _viol(spark, [{"vin": "A", "model": "drop"}]) == {}


def test_slash_default_vs_strict(spark):
    rows = [{"vin": "A", "model": "A/B"}, {"vin": "B", "model": "x /* y"}]
    assert _viol(spark, rows) == {"A": "model", "B": "model"}
    assert _viol(spark, rows, patterns=STRICT_PATTERNS) == {"B": "model"}


def test_all_columns_kept(spark):
    out = pattern_violations(bronze_rows(spark, [{"vin": "SELECT", "manufacturer": "m"}]))
    assert out.columns[-1] == "violating_column" and "partition_hour" in out.columns


def test_empty_lists_raise(spark):
    df = bronze_rows(spark, [{"vin": "A"}])
    with pytest.raises(ValueError):
        pattern_violations(df, columns=[])
    with pytest.raises(ValueError):
        pattern_violations(df, patterns=[])


def test_null_text_not_flagged(spark):
    assert _viol(spark, [{"vin": "A", "model": None, "manufacturer": None}]) == {}


def test_combined_pattern_equals_separate_patterns(spark):
    import random

    from pyspark.sql import functions as F

    from telemetry_lake.functions.patterns import combined_pattern, matches_any
    from telemetry_lake.schemas import DEFAULT_PATTERNS

    pats = DEFAULT_PATTERNS + [r"(?i)drop", r"a|b", r"^x"]
    rnd = random.Random(3)
    alphabet = ["a", "b", "x", ";", "-", "/", "*", "\\", "DROP", "drop", "SEL", "ECT", " "]
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(6))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    separate = F.lit(False)
    for p in pats:
        separate = separate | F.col("t").rlike(p)
    rows = df.select(matches_any("t", pats).alias("a"), separate.alias("b")).collect()
    assert all(r.a == r.b for r in rows)
    assert combined_pattern([r"(a)\1"]) is None  # back-reference: kept separate
    one = df.select(matches_any("t", [r"(a)\1", r"x"]).alias("m")).collect()
    assert [r.m for r in one] == [("aa" in t) or ("x" in t) for t in texts]


@pytest.mark.parametrize("patterns", [
    [r"(?<x>DROP)", r"(?<x>;)"], [r"\Qa+b", "DROP"], ["(?x) DROP # words", ";"], [r"(a)\1", "(D)ROP"],
])
def test_patterns_that_clash_when_joined(spark, patterns):
    from pyspark.sql import functions as F

    from telemetry_lake.functions.patterns import matches_any

    df = spark.createDataFrame([("a;b",), ("DROP",), ("a+b",), ("aa",), ("z",), (None,)], "t string")
    got = [r.t for r in df.where(matches_any("t", patterns)).collect()]
    want = set()
    for p in patterns:
        want |= {r.t for r in df.where(F.col("t").rlike(p)).collect()}
    assert set(got) == want and want
