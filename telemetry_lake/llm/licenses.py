"""Licence scan: one automaton finds tags and notices, a shunting-yard parser reads expressions.

The normalised words of a text (A-Z lower-cased, single spaces) are walked once
by an Aho-Corasick automaton of notice phrases and of the identifier tag.
Where the tag stands, the expression after it is parsed in the raw text and
evaluated: ``or`` leaves the choice of the freer side, ``and`` binds to the
stricter one, ``with`` joins an exception to its licence.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from telemetry_lake.llm.frames import table
from telemetry_lake.llm.text import NOT_ALNUM, per_batch

#: The contract's phrases and labels: fixed values.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Further notices of the method.
NOTICE_PHRASES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "boost software license": "bsl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "bsd license": "bsd",
    "isc license": "isc",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
#: How strict a licence family is, 0 (free to use) to 1.
STRICTNESS = {
    "mit": 0.1, "isc": 0.1, "bsd": 0.1, "bsl": 0.1, "apache": 0.2, "cc-by": 0.3, "mpl": 0.5, "epl": 0.5,
    "lgpl": 0.6, "gpl": 0.8, "agpl": 0.9, "proprietary": 1.0,
}
UNKNOWN = 0.7  # strictness of an identifier of no known family
EXCEPTION = 0.75  # an exception leaves this part of its licence's strictness

_TABLE = bytes(32 if NOT_ALNUM[i] else (i + 32 if 65 <= i <= 90 else i) for i in range(256))
_TAG = re.compile(r"SPDX-License-Identifier[ \t]*:?[ \t]*([A-Za-z0-9.+() \t:-]+)", re.I | re.A)
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+:-]+", re.A)
_FAMILY = [("lgpl", "lgpl"), ("agpl", "agpl"), ("gpl", "gpl"), ("apache", "apache"), ("mit", "mit"), ("bsd", "bsd"),
           ("0bsd", "bsd"), ("mpl", "mpl"), ("epl", "epl"), ("cc-by", "cc-by"), ("bsl", "bsl"), ("isc", "isc")]
_RANK = {"or": 1, "and": 2, "with": 3}


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for phrase in [*BASE_PHRASES, *NOTICE_PHRASES, TAG]:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def family(identifier: str) -> str | None:
    low = identifier.lower()
    return next((name for start, name in _FAMILY if low.startswith(start)), None)


def to_postfix(tokens: list[str]) -> list[str]:
    """Shunting-yard: operators by rank (with, and, or), left to right; stops at what can't go on.

    Returns the longest well-formed head of the expression in postfix order, so
    prose after an identifier isn't taken for a licence.
    """
    out: list[str] = []
    ops: list[str] = []
    depth, want_id = 0, True
    for token in tokens:
        low = token.lower()
        if want_id:
            if token == "(":
                ops.append(token)
                depth += 1
            elif token == ")" or low in _RANK:
                break
            else:
                out.append(token)
                want_id = False
        elif low in _RANK:
            while ops and ops[-1] != "(" and _RANK[ops[-1]] >= _RANK[low]:
                out.append(ops.pop())
            ops.append(low)
            want_id = True
        elif token == ")" and depth:
            while (o := ops.pop()) != "(":
                out.append(o)
            depth -= 1
        else:
            break
    if want_id:  # what waits for a licence, an operator and open brackets, is taken back
        while ops and ops[-1] == "(":
            ops.pop()
        if ops and out:
            ops.pop()
    return out + [o for o in reversed(ops) if o != "("] if out else []


def evaluate(postfix: list[str]) -> tuple[float, set[str]]:
    """Strictness and licence families of a postfix expression."""
    stack: list[tuple[float, set[str]]] = []
    for token in postfix:
        if token in _RANK and len(stack) >= 2:
            right, left = stack.pop(), stack.pop()
            if token in ("or", "and"):
                more, less = sorted((left[1], right[1]), key=len, reverse=True)
                more |= less  # the smaller set goes into the larger one
                stack.append(((min if token == "or" else max)(left[0], right[0]), more))
            else:  # the right side is an exception, not a licence
                stack.append((left[0] * EXCEPTION, left[1]))
        else:
            name = family(token)
            stack.append((STRICTNESS.get(name, UNKNOWN), {name or token.lower()}))
    return stack[-1] if stack else (0.0, set())


def scan(text: str | None) -> dict:
    """The licence marks of one whole text; NULL is empty."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()
    line = " " + b" ".join(words).decode("latin-1") + " "
    n_base, first, last, base, labels, score, tagged = 0, None, None, set(), set(), 0.0, False
    at = word = 0  # words counted so far, and up to where: hits come in order of their ends
    for end, phrase in _automaton().iter(line):
        if phrase == TAG:
            tagged = True
        elif label := BASE_PHRASES.get(phrase):
            n_base += 1
            start = end - len(phrase) - 1
            word += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
            at = start
            first = word if first is None else min(first, word)
            last = word if last is None else max(last, word)
            base.add(label)
        else:
            labels.add(NOTICE_PHRASES[phrase])
    labels |= base
    if labels:
        score = max(STRICTNESS[x] for x in labels)
    if tagged:
        for m in _TAG.finditer(text):
            strict, names = evaluate(to_postfix(_TOKEN.findall(m[1])))
            labels |= names
            score = max(score, strict)
    return {
        "n_words": len(words), "n_base": n_base, "first_word": first, "last_word": last,
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": score,
    }


_SCHEMA = pa.schema(
    [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
     ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
)


def license_marks(docs: DataFrame) -> DataFrame:
    """One row per document: word count, base phrases and places, labels, strictness.

    ``score`` is 0 without any licence mark and else the strictness that binds
    the user of the text.  NULL and empty texts have no words and no labels;
    each text is read whole; a repeated row is answered each time; other
    columns are ignored; an empty table gives no rows.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = pa.Table.from_pylist([scan(t) for t in batch.column(1).to_pylist()], schema=_SCHEMA)
        columns = [c.combine_chunks() for c in rows.columns]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *_SCHEMA.names])

    return docs.select("doc_id", "text").mapInArrow(
        per_batch(run),
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
        "base_labels string, labels string, score double",
    )


def op2_licenses(spark, sf_dir):
    """Every whole text of ``documents``."""
    return license_marks(table(spark, sf_dir, "documents"))
