"""Near duplicates by 64-bit fingerprints, joined through keys of the Golay code.

A fingerprint has a bit for every position that is set in over half the hashes
of a text's shingles.  Fingerprints that differ in at most ``NEAR`` = 4 bits
are linked.  To find them without comparing all pairs, a fingerprint is cut
into three segments of 22, 21 and 21 bits, each padded to a word of the perfect
binary [23, 12, 7] code.  Every 23-bit word decodes to one codeword; a
segment's *keys* are the 12-bit indices of the codewords that the word itself
and the words one bit away decode to: one index for 277 of the 2,048 cosets,
six for the others.  Two segments that differ in at most two bits share a key,
because the word half-way between them is one bit from either.

Four differing bits fall on three segments in one of two ways:

* no segment has more than two: all three segments share a key, and the
  fingerprints meet in a 36-bit key of three indices;
* one segment has three or four: the other two have one at most between them,
  so one is equal and the other shares a key (33 or 34 bits).

That gives 184 keys for a fingerprint on average, 252 at most, and a key holds
few unrelated ones: with 10**10 different fingerprints about 22.  Rows that
meet in a key are verified on the whole fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.frames import components, saved, table
from telemetry_lake.llm.text import flat

SHINGLE = 4
SEED = 42
NEAR = 4
SLAB = 1 << 16  # shingles whose bits are counted at a time
FEW = 8  # members of a key that are compared pair by pair; more give a spanning forest
HELD = 1 << 14  # members of a key that one task holds; more are dealt in pairs of blocks

_N, _K, _LEAST = 23, 12, 11
#: Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
_GENERATOR = 0b101011100011


# --- fingerprints -------------------------------------------------------------------


def fingerprint(text: bytes, size: int = SHINGLE) -> bytes:
    """Eight bytes (highest bit first) of a text in UTF-8; zero for a text without words."""
    words = text.lower().split()  # bytes: A-Z only, and 0x20, 0x09-0x0D
    if not words:
        return bytes(8)
    width = min(size, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1]
    ends = ends[width - 1 :]
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_digest
    for a in range(0, len(starts), SLAB):
        spans = zip(starts[a : a + SLAB].tolist(), ends[a : a + SLAB].tolist(), strict=True)
        hashes = b"".join([digest(joined[s:e], SEED) for s, e in spans])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * counts > len(starts)).tobytes()


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed long."""

    def run(batches):
        for batch in batches:
            data, off = flat(batch.column(1))
            raw = b"".join(
                fingerprint(data[a:b].tobytes(), size) for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)
            )
            fp = np.frombuffer(raw, ">u8").astype(np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fp bigint")


# --- keys of the Golay code ---------------------------------------------------------


def _remainder(word: int) -> int:
    """``word`` modulo the generator: its syndrome."""
    for bit in range(_N - 1, _LEAST - 1, -1):
        if word >> bit & 1:
            word ^= _GENERATOR << (bit - _LEAST)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(remainder of the upper 12 bits, what leads from a word to its nearby codewords, which of these count).

    The difference between a word and a codeword near it depends on the word's
    syndrome alone; rows of the second table hold up to six such differences.
    """
    upper = np.array([_remainder(m << _LEAST) for m in range(1 << _K)], dtype=np.int64)
    bits = [1 << k for k in range(_N)]
    error = np.zeros(1 << _LEAST, dtype=np.int64)  # the one pattern of at most three bits with this syndrome
    patterns = [0, *bits]
    patterns += [a | b for i, a in enumerate(bits) for b in bits[:i]]
    patterns += [a | b | c for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]]
    for p in patterns:
        error[_remainder(p)] = p
    near = np.zeros((1 << _LEAST, 6), dtype=np.int64)
    count = np.zeros((1 << _LEAST, 6), dtype=bool)
    syndromes = [_remainder(b) for b in bits]
    for s in range(1 << _LEAST):
        found = dict.fromkeys([int(error[s]), *(b ^ int(error[s ^ t]) for b, t in zip(bits, syndromes, strict=True))])
        near[s, : len(found)] = list(found)
        count[s, : len(found)] = True
    return upper, near, count


_UPPER, _NEAR, _COUNT = _tables()


def segment_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices (rows x 6) near each 23-bit word, and which of the six count."""
    syndrome = _UPPER[words >> _LEAST] ^ (words & ((1 << _LEAST) - 1))
    return (words[:, None] ^ _NEAR[syndrome]) >> _LEAST, _COUNT[syndrome]


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row of ``fps``) of all keys of unsigned 64-bit fingerprints."""
    low = np.uint64((1 << 21) - 1)
    parts = [fps >> np.uint64(42), (fps >> np.uint64(21)) & low, fps & low]
    parts = [p.astype(np.int64) for p in parts]
    index, count = zip(*(segment_keys(p) for p in parts), strict=True)
    three = (index[0][:, :, None, None] << 24) | (index[1][:, None, :, None] << 12) | index[2][:, None, None, :]
    row, *rest = np.nonzero(count[0][:, :, None, None] & count[1][:, None, :, None] & count[2][:, None, None, :])
    found, rows = [three[(row, *rest)]], [row]
    for kind, (equal, other) in enumerate(((0, 1), (1, 0), (0, 2), (2, 0), (1, 2), (2, 1)), 1):
        row, k = np.nonzero(count[other])
        found.append((kind << 40) | (parts[equal][row] << 12) | index[other][row, k])
        rows.append(row)
    return np.concatenate(found), np.concatenate(rows)


def keyed(fps: DataFrame) -> DataFrame:
    """(key, fp) for every key of the distinct fingerprints (fp)."""

    def run(batches):
        for batch in batches:
            all_fps = batch.column(0).to_numpy()
            for a in range(0, len(all_fps), 2048):
                fp = all_fps[a : a + 2048]
                key, row = keys(fp.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], names=["key", "fp"])

    return fps.select("fp").mapInArrow(run, "key bigint, fp bigint")


# --- verification -------------------------------------------------------------------


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of differing bits."""
    return np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64))


def spanning(fps: np.ndarray, near: int = NEAR) -> list[np.ndarray]:
    """Links (a, b) that connect what is connected among distinct ``fps``; in all fewer links than fps.

    A row leaves when it is reached, so a dense cluster costs little more than
    a pass for each of its first members.
    """
    left, links = fps, [np.zeros((0, 2), np.int64)]
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            hit = apart(left, np.array([at])) <= near
            if hit.any():
                reached, left = left[hit], left[~hit]
                links.append(np.stack([np.full(len(reached), at), reached], axis=1))
                front += reached.tolist()
    return links


def _run_links(key: np.ndarray, fp: np.ndarray, near: int) -> np.ndarray:
    """Links within the runs of equal keys of sorted rows."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[starts, len(key)])
    links = [np.zeros((0, 2), np.int64)]
    few = np.repeat(sizes <= FEW, sizes)
    k, f = key[few], fp[few]
    for lag in range(1, min(FEW, len(k))):
        at = np.flatnonzero(k[lag:] == k[:-lag])
        at = at[apart(f[at + lag], f[at]) <= near]
        links.append(np.stack([f[at], f[at + lag]], axis=1))
    for i in np.flatnonzero(sizes > FEW):
        links += spanning(fp[starts[i] : starts[i] + sizes[i]], near)
    return np.unique(np.sort(np.concatenate(links), axis=1), axis=0)


def meet(rows: DataFrame, held: int = HELD, near: int = NEAR) -> DataFrame:
    """(a, b, key) for rows (key, fp): links found within keys, and (NULL, NULL, key) of keys with over ``held`` rows."""

    def links_of(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
        found = _run_links(key, fp, near)
        none = pa.nulls(len(found), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1]), none], names=["a", "b", "key"])

    def run(batches: Iterator[pa.RecordBatch]):
        key, fp, over = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.concatenate([key, batch.column(0).to_numpy()])
            fp = np.concatenate([fp, batch.column(1).to_numpy()])
            if over is not None:  # the rest of a key that is too large is passed over
                rest = np.searchsorted(key, over, "right")
                key, fp = key[rest:], fp[rest:]
                if not len(key):
                    continue
                over = None
            last = np.searchsorted(key, key[-1])
            if last:
                yield links_of(key[:last], fp[:last])
                key, fp = key[last:], fp[last:]
            if len(key) > held:
                over = key[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([over], pa.int64())],
                    names=["a", "b", "key"],
                )
                key, fp = key[:0], fp[:0]
        if len(key):
            yield links_of(key, fp)

    ordered = rows.repartition("key").sortWithinPartitions("key", "fp")
    return ordered.mapInArrow(run, "a bigint, b bigint, key bigint")


def block_links(rows: DataFrame, block: int, near: int = NEAR) -> DataFrame:
    """Links (a, b) within large keys: rows (key, fp, n) are dealt to blocks and any two blocks meet in one group."""
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp", "key"), blocks).cast("int")
    dealt = rows.select("key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))

    def both(t: pa.Table) -> pa.Table:
        found = np.concatenate(spanning(np.unique(t.column("fp").to_numpy()), near))
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return dealt.select(
        "key", "fp", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    ).groupBy("key", "low", "high").applyInArrow(both, "a bigint, b bigint")


def links(fps: DataFrame, held: int = HELD, near: int = NEAR) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (fp) at most ``near`` = 4 or fewer bits apart."""
    if not 0 <= near <= NEAR:
        raise ValueError(f"the keys find up to {NEAR} differing bits")
    found = saved(meet(keyed(fps), held, near).distinct(), "meetings")
    out = found.where("key is null").select("a", "b")
    large = found.where("key is not null").select("key")
    if large.limit(1).count():
        rows = keyed(fps).join(large, "key")
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(block_links(rows.join(sizes, "key"), held, near))
    return out.distinct()


def simhash_groups(docs: DataFrame, size: int = SHINGLE, near: int = NEAR) -> DataFrame:
    """Connected components of documents by fingerprints at most ``near`` bits apart.

    Returns one row per row of ``docs`` (doc_id, text): doc_id, fingerprint (16
    lowercase hex digits), component_id (the smallest doc_id reachable, itself
    included).

    NULL, empty and blank texts have fingerprint zero and are linked like any
    other.  Every row is judged by its own text: repeated rows give repeated
    results, rows of different texts that share a doc_id are not linked by it.
    A row without doc_id links others and belongs to a component; one of such
    rows alone has component_id NULL.  Other columns are ignored; an empty
    table gives no rows.
    """
    marked = saved(fingerprints(docs, size), "fingerprints")
    classes = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    groups = components(links(classes, near=near)).withColumnRenamed("id", "fp")
    of_class = saved(classes.join(groups, "fp", "left").withColumn("component", F.coalesce("component", "fp")), "of_class")
    least = of_class.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of_class.join(least, "component").select("fp", "component_id")
    return marked.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_simhash(spark, sf_dir):
    """Every document: four-word shingles, fingerprints at most four bits apart."""
    return simhash_groups(table(spark, sf_dir, "documents"))
