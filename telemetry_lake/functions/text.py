"""Text expressions: the SQL TRIM of the reference and the gear map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetry_lake.schemas import GEAR_CODES, ZS_CHARS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zs_trim(c: str | Column) -> Column:
    """Strip the Unicode space separators from both ends.

    Spark's ``trim`` removes only U+0020; ``btrim`` with the Zs set also
    removes U+00A0, U+3000 and the others, and leaves tabs alone.
    """
    return F.btrim(_col(c), F.lit(ZS_CHARS))


def is_blank(c: str | Column) -> Column:
    """NULL or only space separators (the silver drop rule for ``vin``)."""
    col = _col(c)
    return col.isNull() | (zs_trim(col) == F.lit(""))


def gear_number(c: str | Column) -> Column:
    """Exact, case-sensitive gear text -> INT; anything else is NULL.

    Matched as text, never cast, so dirty values cannot fail under ANSI mode.
    """
    col = _col(c)
    expr = None
    for text, code in GEAR_CODES.items():
        expr = (F.when(col == F.lit(text), F.lit(code)) if expr is None
                else expr.when(col == F.lit(text), F.lit(code)))
    return expr.cast("int")
