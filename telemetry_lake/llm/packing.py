"""Sequence packing: non-negative least squares over shallow length combinations.

Documents become ids (byte-level BPE, then id 0) and are cut into pieces of at
most ``window`` ids.  The plan is made on the histogram of piece lengths, which
has ``window`` bins however large the corpus is: combinations of one to three
lengths that fill the window exactly are the columns of a non-negative least
squares problem, its solution is rounded down to repeat counts, and what is
left of the histogram is packed greedily, longest first.  Pieces then find
their sequence by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetry_lake.llm.frames import saved, table
from telemetry_lake.llm.text import chunks, flat, span_hashes

WINDOW = 1024
END_ID = 0
PATTERN_CACHE = 600_000  # pieces of text remembered per Python worker


# --- tokens -----------------------------------------------------------------------

#: Bytes that may belong to white space: ASCII white space and control separators.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
#: First bytes of the characters that other white space is encoded with, and its last byte but one.
_LEAD = np.zeros(256, dtype=bool)
_LEAD[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_INNER = np.zeros(256, dtype=bool)
_INNER[[0xC2, 0x80, 0x81, 0x9A]] = True

_OPEN = frozenset(np.flatnonzero(_BLANK | _LEAD).tolist())
_SHUT = frozenset(np.flatnonzero(_BLANK).tolist())
_WITHIN = frozenset(np.flatnonzero(_INNER).tolist())
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, dtype=bool)
for _from, _to in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _MARK[_from:_to] = True


def safe_cuts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Starts of pieces that can be encoded alone.

    These are places where the vocabulary's splitting pattern always starts a
    new word: each row, a space or line end between two other characters, and
    an ASCII mark after an ASCII letter.  Where a neighbour may be part of
    non-ASCII white space there is no cut.
    """
    n = len(data)
    cut = np.zeros(n, dtype=bool)
    if n > 2:
        before, after = data[:-2], data[2:]
        here = data[1:-1]
        ok = ((here == 32) | (here == 10)) & ~_BLANK[before] & ~_BLANK[after] & ~_LEAD[after]
        earlier = np.concatenate([np.zeros(1, np.uint8), data[:-3]])
        cut[1:-1] = ok & ~((before >= 128) & _INNER[earlier]) | (_MARK[here] & _LETTER[before])
        rows = off[off < n]
        # a space at the end of a row or right after its start has no neighbour there
        for shift in (0, -1):
            at = rows + shift
            cut[at[(at >= 0)]] = False
    cut[off[:-1][off[:-1] < off[1:]]] = True
    return np.flatnonzero(cut)


class Encoder:
    """Ids of texts under a byte-level BPE, equal to encoding each text alone.

    Texts are cut at safe places and every distinct piece (by its 64-bit hash)
    is encoded once per worker; ids are then gathered by position.
    """

    def __init__(self, path: str):
        import tokenizers

        self.bpe = tokenizers.Tokenizer.from_file(path)
        self.bpe.encode_special_tokens = True
        size = max(self.bpe.get_vocab(with_added_tokens=True).values()) + 1
        # a byte-level token is written with one character per byte
        self.widths = np.array([len(self.bpe.id_to_token(i) or "") for i in range(size)], dtype=np.int64)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.flat = np.zeros(1 << 20, dtype=np.uint32)
        self.bounds = np.zeros(1 << 16, dtype=np.int64)

    def _add(self, keys: list[int], ids: np.ndarray, ends: np.ndarray) -> None:
        at = len(self.known)
        start = self.bounds[at]
        while at + len(keys) + 1 > len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        while start + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[start : start + len(ids)] = ids
        self.bounds[at + 1 : at + 1 + len(keys)] = start + ends
        self.known.update(zip(keys, range(at, at + len(keys)), strict=True))

    def _learn(self, keys: list[int], pieces: list[bytes]) -> None:
        """Encode new pieces: together where the joints are safe cuts, else one by one."""
        joint = [p[0] in b" \n" and len(p) > 1 and p[1] not in _OPEN and p[-1] not in _SHUT
                 and not (p[-1] > 127 and p[-2] in _WITHIN) for p in pieces]
        alone = [i for i, j in enumerate(joint) if not j]
        for i, got in zip(alone, self.bpe.encode_batch_fast(
                [pieces[i].decode("utf-8") for i in alone], add_special_tokens=False), strict=True):
            ids = np.array(got.ids, dtype=np.uint32)
            self._add([keys[i]], ids, np.array([len(ids)]))
        together = [i for i, j in enumerate(joint) if j]
        for first in range(0, len(together), 4096):
            part = together[first : first + 4096]
            text = b"".join(pieces[i] for i in part).decode("utf-8")
            ids = np.array(self.bpe.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.uint32)
            want, have = np.cumsum([len(pieces[i]) for i in part]), np.cumsum(self.widths[ids])
            ends = np.searchsorted(have, want) + 1
            if not np.array_equal(have[ends - 1], want):
                raise RuntimeError("ids don't end where the pieces do")
            self._add([keys[i] for i in part], ids, ends)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows one after the other, and the number of ids before each row (rows + 1 values)."""
        starts = safe_cuts(data, off)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(off), np.int64)
        if len(self.known) > PATTERN_CACHE:
            self._forget()
        ends = np.append(starts[1:], len(data))
        keys, first, at = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        keys = keys.tolist()
        new = [i for i, k in enumerate(keys) if k not in self.known]
        self._learn([keys[i] for i in new], [data[starts[first[i]] : ends[first[i]]].tobytes() for i in new])
        place = np.fromiter(map(self.known.__getitem__, keys), dtype=np.int64, count=len(keys))[at]
        begins, sizes = self.bounds[place], self.bounds[place + 1] - self.bounds[place]
        total = np.cumsum(sizes)
        ids = self.flat[np.arange(int(total[-1])) + np.repeat(begins - (total - sizes), sizes)]
        return ids, np.append(0, total)[np.searchsorted(starts, off)]

    def encode_texts(self, texts: list[str]) -> list[list[int]]:
        data, off = flat(pa.array(texts, pa.string()))
        ids, rows = self.encode(data, off)
        return [ids[a:b].tolist() for a, b in zip(rows[:-1], rows[1:], strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


_PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, task int, nth bigint"


def pieces(docs: DataFrame, window: int, tokenizer: str) -> DataFrame:
    """Tokenize and cut: full windows, then the rest of each document.

    ``task`` and ``nth`` number the pieces of each length within a task; with
    the counts per task they give every piece a rank of its own.
    """

    def run(batches):
        from pyspark import TaskContext

        task, counts = TaskContext.get().partitionId(), np.zeros(window + 1, dtype=np.int64)
        for batch in batches:
            doc_ids = batch.column(0).to_numpy(zero_copy_only=False)
            for row, end, data, off in chunks(batch):
                ids, rows = encoder(tokenizer).encode(data, off)
                # the end id closes every document
                ids = np.insert(ids, rows[1:], END_ID).astype("<u4")
                rows = rows + np.arange(len(rows))
                size = np.diff(rows)
                cuts = -(-size // window)
                doc = np.repeat(np.arange(end - row), cuts)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * window
                length = np.minimum(window, size[doc] - start)
                at = rows[doc] + start
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(at.tolist(), (at + length).tolist(), strict=True)]
                order = np.argsort(length, kind="stable")
                same = length[order]
                nth = np.empty(len(same), dtype=np.int64)
                nth[order] = counts[same] + np.arange(len(same)) - np.searchsorted(same, same)
                counts += np.bincount(length, minlength=window + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids[row:end][doc], pa.int64(), from_pandas=True), pa.array(start), pa.array(length),
                        pa.array(crc, pa.int64()), pa.array(size[doc]),
                        pa.array(np.full(len(doc), task), pa.int32()), pa.array(nth),
                    ],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, _PIECE)


# --- plan on the histogram ----------------------------------------------------------


def combinations(window: int, present: np.ndarray, depth: int = 3) -> np.ndarray:
    """All non-increasing combinations of up to ``depth`` (1-3) present lengths with sum ``window``.

    Rows of three lengths, 0 where a combination is shorter.
    """
    has = np.zeros(window + 1, dtype=bool)
    has[present] = True
    rows = []
    if has[window]:
        rows.append([[window, 0, 0]])
    if depth >= 2:
        a = np.arange((window + 1) // 2, window)
        pair = a[has[a] & has[window - a]]
        rows.append(np.stack([pair, window - pair, np.zeros_like(pair)], axis=1))
    if depth >= 3:
        a, b = np.meshgrid(np.arange(1, window - 1), np.arange(1, window - 1), indexing="ij")
        a, b = a.ravel(), b.ravel()
        c = window - a - b
        ok = (a >= b) & (b >= c) & (c >= 1)
        a, b, c = a[ok], b[ok], c[ok]
        ok = has[a] & has[b] & has[c]
        rows.append(np.stack([a[ok], b[ok], c[ok]], axis=1))
    return np.concatenate([np.asarray(r, dtype=np.int64).reshape(-1, 3) for r in rows] or [np.zeros((0, 3), np.int64)])


def nnls(combos: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that bring ``A x`` near the histogram (least squares).

    ``A[l, s]`` is how often combination s holds length l.  Accelerated
    projected gradient; A is applied by gathers and a weighted bincount, it is
    never stored.  Short lengths weigh less: they are easy to place later.
    """
    n = len(histogram)
    if not len(combos):
        return np.zeros(0)
    weight = np.sqrt(np.arange(n) / n)
    weight[0] = 0.0
    target = histogram * weight

    def apply(x):
        return sum(np.bincount(combos[:, k], weights=x, minlength=n) for k in range(3)) * weight

    def back(r):
        r = r * weight
        return sum(r[combos[:, k]] for k in range(3))

    # largest eigenvalue of A'A by power iteration
    v = np.ones(len(combos))
    for _ in range(12):
        v = back(apply(v))
        size = np.linalg.norm(v)
        v /= size or 1.0
    step = 1.0 / max(size * 1.05, 1e-12)
    x = y = np.zeros(len(combos))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - step * back(apply(y) - target))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(histogram: np.ndarray, window: int) -> list[tuple[list[int], int]]:
    """[(lengths of a sequence, repeats)] that use every piece of the histogram exactly once."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    out: list[tuple[list[int], int]] = []

    def use(lengths: list[int], repeats: int) -> None:
        if repeats > 0:
            out.append((lengths, int(repeats)))
            for length in lengths:
                left[length] -= repeats

    use([window], left[window])
    combos = combinations(window, np.flatnonzero(left))
    x = nnls(combos, left.astype(float))
    for s in np.argsort(-x):
        if x[s] < 0.5:
            break
        lengths = [int(v) for v in combos[s] if v]
        most = min(left[v] // lengths.count(v) for v in lengths)
        use(lengths, min(int(round(x[s])), most))
    # the rest greedily: the longest piece, then always the longest that still fits;
    # a pattern repeats while its lengths last, so the loop ends after few patterns
    while left.any():
        lengths, room, stock = [], window, left.copy()
        while True:
            fits = np.flatnonzero(stock[: room + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            times = int(min(stock[length], room // length))
            lengths += [length] * times
            stock[length] -= times
            room -= length * times
        use(lengths, min(left[v] // lengths.count(v) for v in set(lengths)))
    return out


def padding(lengths: list[int], window: int) -> int:
    """Padding of a sequence: up to the window, none at a power of two."""
    used = sum(lengths)
    return 0 if used & (used - 1) == 0 else window - used


def runs(patterns: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, offset): where the pieces of each length go.

    At most a few thousand rows: the number of patterns is bounded by the
    window, not by the corpus.
    """
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, repeats in patterns:
        offset = 0
        for length in lengths:
            first = taken.get(length, 0)
            rows.append((length, first, first + repeats, sequence, offset))
            taken[length] = first + repeats
            offset += length
        sequence += repeats
    return rows


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None) -> DataFrame:
    """Pack all documents (doc_id, text) into sequences of at most ``window`` ids.

    One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.  A NULL or empty text is the end id alone; NULL ids and
    repeated rows are packed like any other row; an empty table gives no rows;
    other columns are ignored.
    """
    cut = saved(pieces(docs, window, tokenizer or default_tokenizer()), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = per_task.select(
        "length", "task",
        (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")).alias("earlier"),
    )
    histogram = np.zeros(window + 1, dtype=np.int64)
    for length, n in per_task.groupBy("length").agg(F.sum("n")).collect():  # at most ``window`` rows
        histogram[length] = n
    by_length: dict[int, list] = {}
    for length, *rest in runs(plan(histogram, window)):
        by_length.setdefault(length, []).append(rest)
    tables = {k: np.array(sorted(v), dtype=np.int64).reshape(-1, 4) for k, v in by_length.items()}

    def place(batches):
        for batch in batches:
            t = pa.Table.from_batches([batch])
            length, rank = t.column("length").to_numpy(), t.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for value in np.unique(length):
                rows, to = np.flatnonzero(length == value), tables[int(value)]
                at = np.searchsorted(to[:, 0], rank[rows], "right") - 1
                sequence[rows] = to[at, 2] + rank[rows] - to[at, 0]
                offset[rows] = to[at, 3]
            out = t.drop_columns(["rank"]).append_column("sequence_id", pa.array(sequence))
            yield from out.append_column("offset", pa.array(offset)).to_batches()

    ranked = cut.join(before, ["length", "task"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("earlier") + F.col("nth")).alias("rank")
    )
    return ranked.mapInArrow(
        place,
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint",
    )


def op3_packing(spark, sf_dir):
    """Every whole text of ``documents``, in sequences of 1024 ids."""
    return pack(table(spark, sf_dir, "documents"))
