"""Secret scan: Aho-Corasick keywords, anchored patterns near the hits, checksums last.

One automaton walks each whole text for every keyword (in any ASCII case where
the pattern allows it).  A regular expression runs only at a hit, anchored
there.  Token formats that embed a checksum count only if it holds.  Runs of
hexadecimal digits have no keyword; one pattern finds them directly.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import itertools
import json
import re
import string
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from telemetry_lake.llm.frames import table
from telemetry_lake.llm.text import per_batch

KINDS = ["assign", "access", "hex", "github", "npm", "jwt"]  # order of spans that start together
BASE_KINDS = ("assign", "access", "hex")
ASSIGN_WORDS = ["password", "passwd", "secret", "token", "api_key", "apikey"]
#: Prefixes of tokens whose last six characters are the base-62 CRC-32 of what stands between.
CRC_PREFIXES = {"ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github", "npm_": "npm"}

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CRC_BODY = re.compile(r"[A-Za-z0-9]{36}(?![A-Za-z0-9])")
#: A JWT is a header (a run of base64url characters from "eyJ" on), a payload and a signature.
_URL_RUN = re.compile(r"[A-Za-z0-9_-]+")
_JWT_REST = re.compile(r"\.(eyJ[A-Za-z0-9_-]+)\.([A-Za-z0-9_-]{16,})")
_STRUCTURE = re.compile(rb'\\*["{}]')
_BASE62 = string.digits + string.ascii_uppercase + string.ascii_lowercase


def _cases(word: str):
    return map("".join, itertools.product(*({c, c.upper()} for c in word)))


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for word in ASSIGN_WORDS:
        for form in _cases(word):
            found.add_word(form, ("assign", len(word)))
    found.add_word("AKIA", ("access", 4))
    for prefix in CRC_PREFIXES:
        found.add_word(prefix, (prefix, 4))
    found.add_word("eyJ", ("jwt", 3))
    found.make_automaton()
    return found


def crc62(body: str) -> str:
    """CRC-32 as six base-62 digits, the checksum at the end of such tokens."""
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, rest = divmod(value, 62)
        digits = _BASE62[rest] + digits
    return digits.rjust(6, "0")


def _base64url(part: str) -> bytes:
    return base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))


def _json_object(part: str) -> dict | None:
    """A JSON object in base64url, or None."""
    try:
        value = json.loads(_base64url(part))
    except (ValueError, binascii.Error, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _last_object(line: bytes) -> int:
    """Where a JSON object that ends with ``line`` must begin, or -1; one pass over quotes and braces from the end.

    Outside of strings at the end, quotes pair off backwards, so only one
    brace can match the last one.
    """
    if not line.rstrip(b" \t\n\r").endswith(b"}"):
        return -1
    depth, quoted = 0, False
    for m in reversed(list(_STRUCTURE.finditer(line))):
        sign, escaped = line[m.end() - 1], (m.end() - m.start()) % 2 == 0
        if sign == 0x22:
            quoted ^= not escaped
        elif not quoted:
            depth += 1 if sign == 0x7D else -1
            if not depth:
                return m.end() - 1
    return -1


class _Headers:
    """Possible JWT headers in a text, each run of base64url characters decoded once.

    Headers that begin in one run end where it ends, so what follows is looked
    at once for all of them; and a header four characters later decodes to
    three bytes less, so all of them are read from four decoded texts.
    """

    def __init__(self, text: str):
        self.text, self.end, self.rest = text, -1, None
        self.begins: dict[int, int] = {}  # by length modulo 4: where a header must begin

    def jwt_end(self, at: int) -> int | None:
        """End of the JWT that begins at ``at``, or None."""
        if at >= self.end:  # a new run
            self.end, self.begins = _URL_RUN.match(self.text, at).end(), {}
            self.rest = _JWT_REST.match(self.text, self.end)
            if self.rest and _json_object(self.rest[1]) is None:
                self.rest = None
        if self.rest is None or self.end - at < 4:
            return None
        turn = (self.end - at) % 4
        if turn not in self.begins:
            try:
                object_at = _last_object(_base64url(self.text[at : self.end]))
            except (ValueError, binascii.Error):
                object_at = -1
            self.begins[turn] = at + object_at // 3 * 4 if object_at >= 0 and object_at % 3 == 0 else -1
        if self.begins[turn] != at:
            return None
        return self.rest.end() if "alg" in (_json_object(self.text[at : self.end]) or ()) else None


def scan(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, by start, then kind as listed; NULL is empty."""
    if not text:
        return []
    spans, reach, headers = [], dict.fromkeys(KINDS, 0), _Headers(text)
    hits = sorted((end + 1 - size, kind) for end, (kind, size) in _automaton().iter(text))
    for at, kind in hits:
        if kind == "assign":
            # a failing match takes its characters too: leftmost, not overlapping
            if at >= reach["assign"] and (m := _ASSIGN.match(text, at)):
                reach["assign"] = m.end()
                if m.end() - m.start(2) >= 6:
                    spans.append((at, m.end(), "assign"))
        elif kind == "access":
            if at >= reach["access"] and (m := _ACCESS.match(text, at)):
                reach["access"] = m.end()
                if m.end() - at >= 20:
                    spans.append((at, m.end(), "access"))
        elif kind == "jwt":
            if at >= reach["jwt"] and (end := headers.jwt_end(at)):
                reach["jwt"] = end
                spans.append((at, end, "jwt"))
        else:
            name, m = CRC_PREFIXES[kind], _CRC_BODY.match(text, at + len(kind))
            if m and at >= reach[name] and crc62(m[0][:30]) == m[0][30:]:
                reach[name] = m.end()
                spans.append((at, m.end(), name))
    spans += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return spans


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and the array ``spans`` of (kind, start, end).

    Positions are code points, ends exclusive.  NULL and empty texts have no
    spans; each text is scanned whole; a repeated row is answered each time;
    other columns are ignored; an empty table gives no rows.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [
            [{"kind": kind, "start": start, "end": end} for start, end, kind in scan(t)]
            for t in batch.column(1).to_pylist()
        ]
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, kind)], names=["doc_id", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        per_batch(run), "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>"
    )


def digest_columns(spans: DataFrame) -> DataFrame:
    """Counts per base kind, the base spans' digest and all spans as text."""
    from pyspark.sql import functions as F

    def joined(column):
        return F.array_join(
            F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE_KINDS]
    return spans.select(
        "doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


def op1_secrets(spark, sf_dir):
    """Every whole text of ``documents``."""
    return digest_columns(secret_spans(table(spark, sf_dir, "documents")))


def base_digest(spans: list[tuple[int, int, str]]) -> str:
    """The digest of a list of base spans, for tests."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()
