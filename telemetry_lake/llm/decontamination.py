"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit check.

A benchmark item and every window of a text that could hold it are sequences of
words.  The CGK random walk (Chakraborty, Goldenberg, Koucky 2016) reads a
sequence and writes symbols; at each step a shared random bit, chosen by step
and symbol, says whether to move on or to write the symbol again.  Sequences a
few edits apart mostly write the same symbols at the same steps, so edit
distance becomes Hamming distance, and sampling a few steps is a locality-
sensitive hash for it.  ``WALKS`` independent walks with ``SAMPLES`` sampled
steps each reach the target recall; the edit distance of every candidate is
then computed exactly.

Windows start at every word.  A walk from a start serves items of all lengths
of a class (its steps don't depend on where the window ends), and it is
followed lazily: a start is dropped as soon as a sampled step shows a symbol
that no item's signature continues with, which is the same as looking the whole
signature up.  Before walking, a count filter drops starts that cannot match:
a window within k word edits of an item of n words holds at least n - 1 - 2k of
the benchmark's word pairs (the q-gram lemma), so nothing is lost.

Walks drift apart as edits add up, so long items are cut into blocks of
``BLOCK`` words or somewhat more, and the blocks are searched like short items.
Of the blocks of a near copy at least one has no larger share of edits than the
whole (their edits sum up to it); around each block that is found the whole item
is then aligned exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.frames import table
from telemetry_lake.llm.text import NOT_ALNUM, chunks, flat, mix, word_hashes

SIMILARITY = 0.8  # 1 - word edits / words of the item
WALKS = 24
SAMPLES = 3
SHORTEST = 5  # items with fewer words are matched exactly only
BLOCK = 30  # words; items of twice as many or more are cut into blocks of at least this size
ITEM_GROUP_BYTES = 8 << 20  # benchmark text that one pass over the documents compares with


def edits_allowed(words: np.ndarray | int) -> np.ndarray | int:
    """Word edits within which a window of an item's size is a near copy."""
    return ((1 - SIMILARITY) * words + 1e-9).astype(np.int64) if isinstance(words, np.ndarray) else int((1 - SIMILARITY) * words + 1e-9)


def word_symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased alphanumeric words of each row, and words before each row."""
    data, off = flat(pc.utf8_lower(column))
    return word_hashes(data, off, NOT_ALNUM)


@dataclass
class Benchmark:
    """Items as symbol sequences, with their walks' signatures by length class."""

    item_ids: list
    items: list[np.ndarray]  # symbols 1 .. of each item
    blocks: list[tuple[int, int, np.ndarray]]  # item index, first word in it, symbols
    vocabulary: np.ndarray  # sorted word hashes; symbol = index + 1, 0 is any other word
    pairs: np.ndarray  # sorted codes of adjacent symbols
    classes: list[dict]


def _bits(walk: int, step: int, symbols: np.ndarray) -> np.ndarray:
    """The shared random bit of each symbol at a step of a walk."""
    key = np.uint64((walk * 1_000_003 + step) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    return (mix(symbols.astype(np.uint64) + key) >> np.uint64(17)) & np.uint64(1)


def embed(sequence: np.ndarray, walk: int, steps: int) -> np.ndarray:
    """CGK embedding of one sequence, ``steps`` symbols long; past its end it writes 0."""
    out, at = np.zeros(steps, dtype=np.int64), 0
    for step in range(steps):
        if at >= len(sequence):
            break
        out[step] = sequence[at]
        at += int(_bits(walk, step, sequence[at : at + 1])[0])
    return out


def sampled_steps(walk: int, length: int) -> np.ndarray:
    """The steps that a walk samples for windows of at least ``length`` words: all lie within such a window."""
    rng = np.random.default_rng([walk, length])
    return np.sort(rng.choice(length, size=min(SAMPLES, length), replace=False))


def prepare(item_ids: list, texts: list[str]) -> Benchmark:
    """Signatures of all items' blocks; items without words are left out."""
    hashes, first = word_symbols(pa.array(texts, pa.string()))
    vocabulary = np.unique(hashes)
    symbols = np.searchsorted(vocabulary, hashes) + 1
    kept = [i for i in range(len(texts)) if first[i + 1] > first[i]]
    items = [symbols[first[i] : first[i + 1]] for i in kept]
    size = len(vocabulary) + 1
    pairs = np.unique(np.concatenate([x[:-1] * size + x[1:] for x in items] or [np.zeros(0, np.int64)]))
    blocks = [
        (i, int(a), x[a:b])
        for i, x in enumerate(items)
        for cuts in [np.linspace(0, len(x), max(1, len(x) // BLOCK) + 1).astype(int)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True)
    ]
    classes = []
    lengths = np.array([len(x) for _, _, x in blocks])
    low = 1
    while len(lengths) and low <= lengths.max():
        own = np.flatnonzero((lengths >= low) & (lengths < max(low + 1, low * 3 // 2)))
        if len(own):
            shortest = int(lengths[own].min())
            k = lengths[own].astype(float)
            least = int((k - 1 - 2 * edits_allowed(lengths[own])).min())
            walks = []
            for walk in range(WALKS if shortest >= SHORTEST else 1):
                steps = sampled_steps(walk, shortest) if shortest >= SHORTEST else np.arange(shortest)
                table_: dict[tuple, list[int]] = {}
                for i in own:
                    table_.setdefault(tuple(embed(blocks[i][2], walk, int(steps[-1]) + 1)[steps].tolist()), []).append(int(i))
                walks.append((walk, steps, table_))
            classes.append({
                "shortest": shortest, "longest": int(lengths[own].max()), "least": max(0, least), "walks": walks,
            })
        low = max(low + 1, low * 3 // 2)
    return Benchmark([item_ids[i] for i in kept], items, blocks, vocabulary, pairs, classes)


def edit_distances(item: np.ndarray, windows: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least word edits from the item to a prefix of each window, and that prefix's length.

    ``windows`` has one row per window, ``sizes`` their lengths; the dynamic
    programme runs over all windows at once.
    """
    count, width = windows.shape
    steps = np.arange(width + 1)
    row = np.tile(steps, (count, 1))
    for i, symbol in enumerate(item):
        below = np.empty_like(row)
        below[:, 0] = i + 1
        np.minimum(row[:, :-1] + (windows != symbol), row[:, 1:] + 1, out=below[:, 1:])
        row = np.minimum.accumulate(below - steps, axis=1) + steps  # insertions along the row
    row[steps > sizes[:, None]] = 1 << 40
    end = np.argmin(row, axis=1)
    return row[np.arange(count), end], end


def verified(item: np.ndarray, starts: np.ndarray, symbols: np.ndarray, ends: np.ndarray, vocabulary: int):
    """(start, length, edits) of the candidate windows within the edits that the item allows.

    Windows that hold too few of the item's words are dropped first.
    """
    most, out = edits_allowed(len(item)), []
    width = len(item) + most
    own = np.zeros(vocabulary + 1, dtype=bool)
    own[item] = True
    for k in range(0, len(starts), 4096):
        part = starts[k : k + 4096]
        sizes = np.minimum(width, ends[part] - part)
        at = np.minimum(part[:, None] + np.arange(width), len(symbols) - 1)
        windows = np.where(np.arange(width) < sizes[:, None], symbols[at], 0)
        enough = own[windows].sum(axis=1) >= len(item) - most
        if enough.any():
            part, windows, sizes = part[enough], windows[enough], sizes[enough]
            edits, length = edit_distances(item, windows, sizes)
            good = edits <= most
            out += zip(part[good].tolist(), length[good].tolist(), edits[good].tolist(), strict=True)
    return out


def aligned(item: np.ndarray, text: np.ndarray, vocabulary: int) -> tuple[int, int, int] | None:
    """(edits, start, length) of the part of a text with the least word edits from the item, the first of equal ones.

    None if it has more edits than the item allows.  One row of the dynamic
    programme holds edits and start together, so the least of both is carried.
    """
    most = edits_allowed(len(item))
    own = np.zeros(vocabulary + 1, dtype=bool)
    own[item] = True
    held = np.append(0, np.cumsum(own[text]))
    at = np.arange(len(held))
    if (held - held[np.maximum(at - len(item) - most, 0)]).max() < len(item) - most:
        return None
    unit = len(text) + 1
    steps = at * unit
    row = at.copy()  # nothing of the item yet: a part may start anywhere
    for i, symbol in enumerate(item):
        below = np.empty_like(row)
        below[0] = (i + 1) * unit
        np.minimum(row[:-1] + unit * (text != symbol), row[1:] + unit, out=below[1:])
        row = np.minimum.accumulate(below - steps) + steps  # insertions along the row
    end = int(np.argmin(row))
    edits, start = divmod(int(row[end]), unit)
    return (edits, start, end - start) if edits <= most else None


def candidate_starts(symbols: np.ndarray, ends: np.ndarray, pair_hits: np.ndarray, group: dict) -> np.ndarray:
    """Starts whose windows hold enough benchmark word pairs for some item of the class."""
    starts = np.flatnonzero(symbols > 0)
    if group["least"] <= 0:
        return starts
    reach = group["longest"] + edits_allowed(group["longest"])
    stop = np.minimum(starts + reach - 1, ends[starts] - 1)
    held = pair_hits[np.maximum(stop, starts)] - pair_hits[starts]
    return starts[held >= group["least"]]


def search(hashes: np.ndarray, first: np.ndarray, bench: Benchmark) -> list[tuple[int, int, int, int, int]]:
    """(row, item index, first word, end word, edits): the best window of each item in each row."""
    if not len(hashes) or not bench.items:
        return []
    at = np.searchsorted(bench.vocabulary, hashes)
    at[at == len(bench.vocabulary)] = 0
    symbols = np.where(bench.vocabulary[at] == hashes, at + 1, 0)
    row_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    ends = first[1:][row_of]
    size = len(bench.vocabulary) + 1
    codes = symbols[:-1] * size + symbols[1:]
    known = np.zeros(len(symbols), dtype=np.int64)
    maybe = np.flatnonzero((symbols[:-1] > 0) & (symbols[1:] > 0) & (row_of[:-1] == row_of[1:]))
    if len(maybe) and len(bench.pairs):
        found = np.searchsorted(bench.pairs, codes[maybe])
        found[found == len(bench.pairs)] = 0
        known[maybe[bench.pairs[found] == codes[maybe]]] = 1
    pair_hits = np.concatenate([[0], np.cumsum(known)])  # known pairs that start before a word
    found: dict[int, list[np.ndarray]] = {}
    for group in bench.classes:
        starts = candidate_starts(symbols, ends, pair_hits, group)
        if not len(starts):
            continue
        for walk, steps, signatures in group["walks"]:
            _walk(symbols, ends, starts, walk, steps, signatures, found)
    best: dict[tuple[int, int], tuple] = {}

    def offer(row: int, item: int, value: tuple[int, int, int]) -> None:
        if (row, item) not in best or value < best[row, item]:
            best[row, item] = value

    regions: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for block, parts in found.items():
        starts = np.unique(np.concatenate(parts))
        item, offset, own = bench.blocks[block]
        n = len(bench.items[item])
        slack = edits_allowed(n) + edits_allowed(len(own))
        for start, length, edits in verified(own, starts, symbols, ends, len(bench.vocabulary)):
            row = int(row_of[start])
            if len(own) == n:
                offer(row, item, (edits, start - int(first[row]), length))
            else:
                low, high = start - offset - slack, start - offset + n + slack
                regions.setdefault((row, item), []).append((max(low, int(first[row])), min(high, int(first[row + 1]))))
    for (row, item), spans in regions.items():
        for low, high in _merged(spans):
            value = aligned(bench.items[item], symbols[low:high], len(bench.vocabulary))
            if value:
                offer(row, item, (value[0], value[1] + low - int(first[row]), value[2]))
    return sorted((row, item, start, start + length, edits) for (row, item), (edits, start, length) in best.items())


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans that overlap as one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _walk(symbols, ends, starts, walk, steps, signatures, found) -> None:
    """Follow one walk from all starts, dropping those that no signature continues."""
    alive, at = starts, starts.copy()
    codes = np.zeros(len(starts), dtype=np.int64)  # index of the signature's beginning among those of all items
    step = 0
    keys = sorted(signatures)
    for depth, sampled in enumerate(steps):
        while step < sampled:
            inside = at < ends[alive]
            move = np.zeros(len(at), dtype=np.int64)
            move[inside] = _bits(walk, step, symbols[at[inside]]).astype(np.int64)
            at = at + move
            step += 1
        shown = np.where(at < ends[alive], symbols[np.minimum(at, len(symbols) - 1)], 0)
        # beginnings of signatures known so far -> (code, symbol) pairs that go on
        heads = sorted({k[: depth + 1] for k in keys})
        before = {h: i for i, h in enumerate(sorted({k[:depth] for k in keys}))}
        top = int(max((h[-1] for h in heads), default=0)) + 1
        allowed = np.array([before[h[:-1]] * top + h[-1] for h in heads], dtype=np.int64)
        order = np.argsort(allowed)
        value = np.where(shown < top, codes * top + shown, -1)
        spot = np.searchsorted(allowed[order], value)
        spot[spot == len(allowed)] = 0
        ok = allowed[order][spot] == value
        alive, at, codes = alive[ok], at[ok], order[spot[ok]]
        if not len(alive):
            return
    for code in np.unique(codes):
        for item in signatures[heads[code]]:
            found.setdefault(item, []).append(alive[codes == code])


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Near copies of benchmark items in texts: (doc_id, item_id, start_word, end_word, edits).

    One row per document and item, for the window with the fewest word edits (at
    most a fifth of the item's words; the first of equal ones).  Words are
    alphanumeric runs, lower-cased.  NULL and empty texts hold nothing; items
    without words match nothing and shorter ones than five words only exactly;
    items with the same text are reported each; repeated rows give repeated
    results; empty tables give no rows; other columns are ignored.

    The benchmark is read in groups of ``ITEM_GROUP_BYTES``, each with its own
    pass over the documents, so what a task holds of it is bounded.
    """
    sized = benchmark.select("item_id", "text").where("text is not null")
    total = sized.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-int(total) // ITEM_GROUP_BYTES))
    found = None
    for group in range(groups):
        rows = sized.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)) == group).collect()
        rows.sort(key=lambda r: (str(r["item_id"]), r["text"]))
        bench = prepare([r["item_id"] for r in rows], [r["text"] for r in rows])
        part = _matches(docs, bench)
        found = part if found is None else found.unionByName(part)
    return found


def _matches(docs: DataFrame, bench: Benchmark) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(bench)

    def run(batches):
        for batch in batches:
            for row, end, _, _ in chunks(batch):
                hashes, first = word_symbols(batch.column(1).slice(row, end - row))
                hits = search(hashes, first, shared.value)
                if hits:
                    ids = batch.column(0).slice(row, end - row)
                    rows, items, start, stop, edits = map(list, zip(*hits, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(rows)), pa.array([shared.value.item_ids[i] for i in items], pa.int64()),
                         pa.array(start, pa.int64()), pa.array(stop, pa.int64()), pa.array(edits, pa.int64())],
                        names=["doc_id", "item_id", "start_word", "end_word", "edits"],
                    )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id bigint, item_id bigint, start_word bigint, end_word bigint, edits bigint"
    )


def op8_decontamination(spark, sf_dir):
    """Every document against every benchmark item."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
