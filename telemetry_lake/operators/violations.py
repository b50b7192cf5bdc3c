"""Messages whose text matches suspicious patterns (no shuffle)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.functions.dialect import portable
from telemetry_lake.functions.patterns import first_matching_column
from telemetry_lake.schemas import DEFAULT_PATTERN_COLUMNS, DEFAULT_PATTERNS


def pattern_violations(
    df: DataFrame,
    columns: Sequence[str] = DEFAULT_PATTERN_COLUMNS,
    patterns: Sequence[str] = DEFAULT_PATTERNS,
    dialect: str = "java",
) -> DataFrame:
    """All columns of ``df`` plus ``violating_column`` = first listed column in
    which any pattern is found; rows without a hit are dropped.

    Patterns are Java regular expressions, found anywhere, case sensitive;
    they are passed as data, never pasted into SQL text.  Empty ``columns`` or
    ``patterns`` raise ValueError.  With ``dialect="re2"`` they are read as RE2
    reads them; one that Java can't follow raises ``DialectError``.
    """
    if dialect not in ("java", "re2"):
        raise ValueError("dialect must be java or re2")
    if dialect == "re2":
        patterns = [portable(p) for p in patterns]
    flagged = df.withColumn("violating_column", first_matching_column(list(columns), list(patterns)))
    return flagged.where(F.col("violating_column").isNotNull())
