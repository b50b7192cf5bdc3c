"""Arrow and numpy helpers shared by the operators of this package.

Texts stay in Arrow's flat UTF-8 buffers: words are found with byte masks and
hashed with one prefix sum, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # text bytes worked on at a time (at least one document); a worker holds some 100 bytes for each

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Separators of the contract's words: space and 0x09-0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: Separators of alphanumeric words: every ASCII byte but 0-9, A-Z, a-z.
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[:128] = True
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    NOT_ALNUM[_a:_b] = False

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_BYTE_KEYS = np.random.default_rng(20240611).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i < n (grown on demand)."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES)
        tables = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(size, base & _MASK, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[:] = tables
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and int64 row offsets of a string column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[
        column.offset : column.offset + len(column) + 1
    ].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple]:
    """(first row, end row, bytes, offsets) of pieces of at most ``limit`` bytes or one row."""
    data, off = flat(batch.column(batch.schema.get_field_index(column)))
    row, rows = 0, batch.num_rows
    while row < rows:
        end = max(row + 1, int(np.searchsorted(off, off[row] + limit, "right")) - 1)
        end = min(end, rows)
        yield row, end, data[off[row] : off[end]], off[row : end + 1] - off[row]
        row = end


def word_spans(data: np.ndarray, off: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts and ends of all words, and the number of words before each row (rows + 1 values)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = ~separator[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    cuts = off[:-1][off[:-1] < n]
    opens[cuts] = inside[cuts]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    last = off[1:][off[1:] > 0] - 1
    closes[last] = inside[last]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, off)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans; equal bytes give equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_KEYS[data] * power[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, off: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased) and the number of words before each row."""
    data = LOWER[data]
    starts, ends, rows = word_spans(data, off, separator)
    return span_hashes(data, starts, ends), rows


def ascii_lower(text: str) -> str:
    """Lower-case A-Z only; positions stay."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def per_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """Lift a function on one batch to what ``mapInArrow`` takes; empty batches are skipped."""

    def run(batches):
        for batch in batches:
            if batch.num_rows and (out := fn(batch)) is not None:
                yield out

    return run


def crc_remainder(doc_ids: list, modulus: int) -> np.ndarray:
    """crc32 of each id's decimal text modulo ``modulus``; -1 for a NULL id."""
    import zlib

    return np.array([-1 if d is None else zlib.crc32(str(d).encode()) % modulus for d in doc_ids], dtype=np.int64)
