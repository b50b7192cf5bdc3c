"""Near duplicates by a chosen-path set-similarity join over minwise tokens.

Each text becomes its set of distinct word shingles; equal sets are one class.
A class has ``TOKENS`` minwise tokens.  In each of ``TREES`` independent trees
a node chooses a few token positions (by a hash of its own path) and its
classes branch by their token there.  Two sets of high similarity agree on most
tokens, so they stay together along many paths; unrelated ones part at once.

Every node of the first level and every large one below it, whatever its size,
is compared with one random member, its pivot: a group of near copies is linked
by as many pairs as it has members.  Nodes whose members the links connect are
done.  Of the others, those
of at most ``SMALL`` classes are compared exhaustively on their tokens, larger
ones branch again, down to ``DEPTH`` levels.  What is large and apart even
there is compared in blocks: on tokens first, then the classes that have a
likely partner on their full sets.  All links are confirmed on the full sets.

Recall: a pair of similarity 0.85 stays together in one level of a tree with
probability 1 - 0.15**2, so all three trees lose it in nodes that are small at
level 1 with about 1e-5, in nodes that stay large and unconnected down to level
3 with about 3e-4; the token estimate drops a linked pair with at most 1e-6.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.frames import components, saved, table
from telemetry_lake.llm.text import chunks, mix, word_hashes

SHINGLE = 5
TOKENS = 64
TREES = 3
BRANCHES = 2
DEPTH = 3
SMALL = 32
COLUMNS = 4096  # shingles that a block comparison multiplies at a time
BLOCK = 1024
FEW_IDS = 1 << 18  # ids (8 bytes each) that are broadcast at most
MISSED = 1e-6  # chance that the token estimate drops a pair that should be linked

_STEPS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                                 0xA0761D6478BD642F)]
_rng = np.random.default_rng(97)
_SEEDS = _rng.integers(1, 1 << 63, TOKENS, dtype=np.uint64) | np.uint64(1)


# --- sets and tokens ----------------------------------------------------------------


def _fingerprint(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set; zero for the empty one."""
    a = int(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
    b = int(mix(shingles * np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64))
    return a, b


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row; a row with fewer words is one shingle of them all."""
    hashes, first = word_hashes(data, off)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        words = hashes[a:b]
        n = len(words)
        if not n:
            out.append(words)
            continue
        width = min(size, n)
        total = np.full(n - width + 1, width, dtype=np.uint64)
        for k in range(width):
            total = (total ^ words[k : n - width + 1 + k]) * _STEPS[k % len(_STEPS)]
            total ^= total >> np.uint64(29)
        out.append(np.unique(mix(total)))
    return out


def minwise(shingles: np.ndarray) -> np.ndarray:
    """``TOKENS`` minwise tokens of a set (uint32), each under its own multiply-and-mix hash."""
    out = np.empty(TOKENS, dtype=np.uint64)
    for k, seed in enumerate(_SEEDS):
        h = shingles * seed
        h ^= h >> np.uint64(32)
        out[k] = (h * np.uint64(0xD6E8FEB86659FD93)).min()
    return (mix(out) & np.uint64(0xFFFFFFFF)).astype("<u4")


_SKETCH = "doc_id bigint, n_shingles bigint, fp1 bigint, fp2 bigint, tokens binary"


def sketches(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, fp1, fp2, tokens): set size, 128-bit fingerprint of the set, minwise tokens."""

    def run(batches):
        for batch in batches:
            for row, end, data, off in chunks(batch):
                n, fp, tokens = [], [], []
                for shingles in shingle_sets(data, off, size):
                    n.append(len(shingles))
                    fp.append(_fingerprint(shingles))
                    tokens.append(minwise(shingles).tobytes() if len(shingles) else b"")
                pair = np.array(fp, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(n, pa.int64()), pa.array(pair[:, 0]),
                     pa.array(pair[:, 1]), pa.array(tokens, pa.binary())],
                    names=["doc_id", "n_shingles", "fp1", "fp2", "tokens"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, _SKETCH)


# --- chosen paths -------------------------------------------------------------------


@lru_cache
def estimate_least(percent: int) -> int:
    """Equal tokens that a pair of this similarity reaches with probability of at least 1 - MISSED."""
    p, below = min(percent, 100) / 100, 0.0
    for k in range(TOKENS + 1):
        below += comb(TOKENS, k) * p**k * (1 - p) ** (TOKENS - k)
        if below > MISSED:
            return k
    return TOKENS


def _token_rows(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<u4").reshape(-1, TOKENS)


def _children(node: np.ndarray, tokens: np.ndarray) -> list[np.ndarray]:
    """Child nodes of each (node, tokens) row: the node's hash picks the positions, the tokens the branch."""
    out = []
    for k in range(BRANCHES):
        at = mix(node + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(TOKENS)
        value = tokens[np.arange(len(tokens)), at.astype(np.int64)].astype(np.uint64)
        out.append(mix(mix(node ^ (at + np.uint64(k) * np.uint64(TOKENS))) ^ (value * _STEPS[0])))
    return out


def branch(members: DataFrame) -> DataFrame:
    """(node, id, tokens) -> (node, id) one level down."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                node = batch.column(0).to_numpy().view(np.uint64)
                below = _children(node, _token_rows(batch.column(2)))
                ids = batch.column(1).to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(below).view(np.int64)), pa.array(np.tile(ids, BRANCHES))],
                    names=["node", "id"],
                )

    return members.select("node", "id", "tokens").mapInArrow(run, "node bigint, id bigint").distinct()


def small_pairs(members: DataFrame, least: int) -> DataFrame:
    """Pairs (a, b) of different components within small nodes whose tokens agree enough.

    ``members``: (node, id, component, tokens) of nodes of at most ``SMALL``
    documents.  Sorted by node, a document is compared with the ``SMALL`` rows
    before it, so memory is bounded by a batch.
    """

    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            fresh = (*(batch.column(k).to_numpy() for k in range(3)), _token_rows(batch.column(3)))
            before = 0 if held is None else len(held[0])
            rows = fresh if held is None else tuple(np.concatenate(x) for x in zip(held, fresh, strict=True))
            node, ids, component, tokens = rows
            pairs = [np.zeros((0, 2), np.int64)]
            for lag in range(1, min(SMALL, len(node))):
                at = np.flatnonzero((node[lag:] == node[:-lag]) & (component[lag:] != component[:-lag])) + lag
                at = at[at >= before]
                at = at[(tokens[at] == tokens[at - lag]).sum(axis=1) >= least]
                pairs.append(np.stack([ids[at], ids[at - lag]], axis=1))
            held = tuple(x[-SMALL:] for x in rows)
            found = np.sort(np.concatenate(pairs), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

    ordered = members.select("node", "id", "component", "tokens").repartition("node").sortWithinPartitions("node", "id")
    return _ordered(ordered.mapInArrow(run, "a bigint, b bigint")).distinct()


def agreeing(pairs: DataFrame, least: int) -> DataFrame:
    """Pairs (a, ta, b, tb) with tokens -> (a, b) with enough equal tokens."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                equal = (_token_rows(batch.column(1)) == _token_rows(batch.column(3))).sum(axis=1)
                keep = pa.array(equal >= least)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=["a", "b"]).filter(keep)

    return pairs.select("a", "ta", "b", "tb").mapInArrow(run, "a bigint, b bigint")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _sized(members: DataFrame) -> DataFrame:
    """Members of nodes with at least two classes, with the node's size and pivot.

    The pivot is the first by one of two hashes, so the nodes that a group of
    near copies shares have few different pivots.
    """
    nodes = members.groupBy("node").agg(
        F.count(F.lit(1)).alias("size"), F.min_by("id", F.xxhash64("id", F.col("node") % 2)).alias("pivot")
    )
    return members.join(nodes.where("size > 1"), "node")


def roots(reps: DataFrame) -> DataFrame:
    """(node, id) of the first level of all trees for reps (id, tokens)."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                tokens, ids = _token_rows(batch.column(1)), batch.column(0).to_numpy()
                nodes = [x for t in range(TREES)
                         for x in _children(np.full(len(ids), mix(np.array([t + 1], np.uint64))[0]), tokens)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(nodes).view(np.int64)), pa.array(np.tile(ids, len(nodes)))],
                    names=["node", "id"],
                )

    return reps.select("id", "tokens").mapInArrow(run, "node bigint, id bigint").distinct()


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs of sets, by matrix products over the shingles that occur twice."""
    sets = [*left, *right]
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    values, place, often = np.unique(flat, return_inverse=True, return_counts=True)
    shared = np.cumsum(often > 1) - 1
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    keep = often[place] > 1
    owner, column = owner[keep], shared[place[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.float32)
    total = int(column[-1]) + 1 if len(column) else 0
    for first in range(0, total, COLUMNS):
        at = slice(*np.searchsorted(column, (first, first + COLUMNS)))
        block = np.zeros((len(sets), min(COLUMNS, total - first)), dtype=np.float32)
        block[owner[at], column[at] - first] = 1
        out += block[: len(left)] @ block[len(left) :].T
    return out


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """(first, member) for every member of each connected group of a symmetric boolean matrix."""
    seen, out = np.zeros(len(linked), dtype=bool), []
    for first in range(len(linked)):
        if seen[first]:
            continue
        seen[first], front = True, np.array([first])
        while len(front):
            front = np.flatnonzero(linked[front].any(axis=0) & ~seen)
            seen[front] = True
            out += [(first, int(x)) for x in front]
    return out


def _dealt(members: DataFrame) -> DataFrame:
    """(node, id, own, low, high): a node's members in blocks of about ``BLOCK``, any two of which meet in one group."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("id", "node"), blocks).cast("int")
    dealt = members.select("node", "id", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    return dealt.select("node", "id", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))


def likely(members: DataFrame, tokens: DataFrame, least: int) -> DataFrame:
    """Members (node, id, size, component) that agree on ``least`` tokens with one of another component in their node."""

    def meet(t: pa.Table) -> pa.Table:
        ids, part = t.column("id").to_numpy(), t.column("component").to_numpy()
        rows = _token_rows(t.column("tokens"))
        hit = np.zeros(len(ids), dtype=bool)
        for i in range(len(ids) - 1):
            near = ((rows[i + 1 :] == rows[i]).sum(axis=1) >= least) & (part[i + 1 :] != part[i])
            hit[i] |= near.any()
            hit[i + 1 :] |= near
        return pa.table({"node": t.column("node").filter(pa.array(hit)), "id": t.column("id").filter(pa.array(hit))})

    rows = _dealt(members).join(members.select("node", "id", "component"), ["node", "id"]).join(tokens, "id")
    found = rows.groupBy("node", "low", "high").applyInArrow(meet, "node bigint, id bigint").distinct()
    sizes = found.groupBy("node").agg(F.count(F.lit(1)).alias("size"))
    return found.join(sizes, "node")


def block_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Connected pairs (a, b) within nodes (node, id, size), by exact comparison of the full sets."""
    dealt = _dealt(members)

    def meet(t: pa.Table) -> pa.Table:
        ids, own = t.column("id").to_numpy(), t.column("own").to_numpy()
        full = [np.frombuffer(x.as_buffer(), "<u8") for x in t.column("shingles")]
        low, high = t.column("low")[0].as_py(), t.column("high")[0].as_py()
        left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
        both = overlaps([full[i] for i in left], [full[i] for i in right])
        sizes = np.array([len(x) for x in full], dtype=np.float64)
        union = sizes[left][:, None] + sizes[right][None, :] - both
        near = 100.0 * both >= percent * union
        rows = left if low == high else np.concatenate([left, right])
        square = near if low == high else np.block(
            [[np.zeros((len(left), len(left)), bool), near], [near.T, np.zeros((len(right), len(right)), bool)]]
        )
        pairs = np.array(spanning(square), dtype=np.int64).reshape(-1, 2)
        return pa.table({"a": ids[rows[pairs[:, 0]]], "b": ids[rows[pairs[:, 1]]]})

    return _ordered(
        dealt.join(sets, "id").groupBy("node", "low", "high").applyInArrow(meet, "a bigint, b bigint")
    ).distinct()


class Links:
    """The confirmed links so far, and a label for each class that has one.

    Classes of one label are connected, so pairs of them need no comparison;
    connected classes may still have different labels: a label is the least
    class within two links, the same for all that a pivot has linked.
    ``components`` settles the rest at the end.
    """

    def __init__(self, tokens: DataFrame, sets: DataFrame, percent: int):
        self.tokens, self.sets, self.percent = tokens, sets, percent
        self.links = tokens.select(F.col("id").alias("a"), F.col("id").alias("b")).where("false")
        self.linked = tokens.select("id", F.col("id").alias("component")).where("false")

    def components_of(self, rows: DataFrame, name: str, to: str) -> DataFrame:
        """Add the component of column ``name`` as column ``to``."""
        side = self.linked.select(F.col("id").alias(name), F.col("component").alias(to))
        return rows.join(side, name, "left").withColumn(to, F.coalesce(to, name))

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Pairs of different components."""
        both = self.components_of(self.components_of(pairs, "a", "ca"), "b", "cb")
        return both.where("ca <> cb").select("a", "b")

    def with_components(self, level: DataFrame) -> DataFrame:
        """Members (node, id, size) with their component."""
        return self.components_of(level.select("node", "id", "size"), "id", "component")

    def mixed(self, level: DataFrame) -> DataFrame:
        """``with_components`` of the nodes that hold more than one component."""
        parts = self.with_components(level)
        nodes = parts.groupBy("node").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        return saved(parts.join(nodes.where("lo <> hi").select("node"), "node"), "mixed")

    def with_tokens(self, pairs: DataFrame) -> DataFrame:
        left = self.tokens.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
        right = self.tokens.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
        return pairs.join(left, "a").join(right, "b")

    def add(self, links: DataFrame) -> None:
        """Take in confirmed links and label their classes."""
        new = saved(links, "links")
        if new.limit(1).count():
            self.links = self.links.unionByName(new)
            both = self.links.unionByName(self.links.select(F.col("b").alias("a"), F.col("a").alias("b")))
            first = saved(both.groupBy(F.col("a").alias("id")).agg(F.least("a", F.min("b")).alias("least")), "least")
            second = both.join(first.select(F.col("id").alias("b"), "least"), "b").groupBy(F.col("a").alias("id"))
            self.linked = saved(second.agg(F.min("least").alias("component")), "linked")

    def confirm(self, pairs: DataFrame) -> DataFrame:
        return confirmed(pairs, self.sets, self.percent)


def join_sets(reps: DataFrame, level: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect the classes of each component, of those that have one.

    ``reps``: (id, tokens); ``level``: the members of the first nodes; ``sets``:
    (id, shingles) of these members.
    """
    least = estimate_least(percent)
    tokens = saved(reps.join(level.select("id").distinct(), "id"), "tokens")
    found = Links(tokens, sets, percent)
    for depth in range(1, DEPTH + 1):
        pivots = level if depth == 1 else level.where(F.col("size") > SMALL)  # below, small ones are compared anyway
        stars = _ordered(pivots.select(F.col("pivot").alias("a"), F.col("id").alias("b"))).distinct()
        stars = agreeing(found.with_tokens(found.apart(stars)), least)
        if depth == 1:  # most groups of copies are linked here; what they need no more is left out below
            found.add(found.confirm(stars))
            stars = stars.where("false")
            level = found.mixed(level)
        else:
            level = found.with_components(level)
        small = level.where(F.col("size") <= SMALL).join(tokens, "id")
        found.add(found.confirm(small_pairs(small, least).unionByName(stars).distinct()))
        large = found.mixed(level.where(F.col("size") > SMALL))
        if not large.limit(1).count():
            break
        if depth < DEPTH:
            level = saved(_sized(branch(large.join(tokens, "id"))), f"level{depth + 1}")
        else:
            found.add(block_links(saved(likely(large, tokens, least), "likely"), sets, percent))
    return found.links


# --- confirmation on full sets -----------------------------------------------------


def set_rows(docs: DataFrame, size: int) -> DataFrame:
    """(fp1, fp2, shingles): fingerprint and sorted distinct shingle hashes (as bytes) of each text."""

    def run(batches):
        for batch in batches:
            for _, _, data, off in chunks(batch):
                sets = shingle_sets(data, off, size)
                pair = np.array([_fingerprint(s) for s in sets], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[:, 0]), pa.array(pair[:, 1]),
                     pa.array([s.astype("<u8").tobytes() for s in sets], pa.binary())],
                    names=["fp1", "fp2", "shingles"],
                )

    return docs.select("text").mapInArrow(run, "fp1 bigint, fp2 bigint, shingles binary")


def _few(ids: DataFrame) -> DataFrame:
    """``ids`` (one long), to be broadcast if there are at most ``FEW_IDS``; the join shuffles beyond that."""
    return F.broadcast(ids) if ids.count() <= FEW_IDS else ids


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets satisfy 100 * |A n B| >= percent * |A u B|."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(1), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                if percent * max(len(x), len(y)) > 100 * min(len(x), len(y)):
                    keep.append(False)
                    continue
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            if keep:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2)], names=["a", "b"]).filter(
                    pa.array(keep, pa.bool_())
                )

    # only the sets that are compared are shuffled: they are picked first, by a broadcast of bounded size
    pairs = saved(pairs.select("a", "b"), "pairs")
    ids = saved(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "ids")
    sets = sets.join(_few(ids), "id", "left_semi")
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(right, "b").join(left, "a").select("a", "sa", "b", "sb")
    return both.mapInArrow(run, "a bigint, b bigint")


def near_dedup(docs: DataFrame, percent: int = 85, size: int = SHINGLE) -> DataFrame:
    """Connected components of near-duplicate documents.

    Returns one row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id (the smallest doc_id reachable over links, itself included),
    kept (doc_id = component_id).

    NULL, empty and blank texts have no shingles and are linked with nothing;
    rows that share a doc_id are one document: the links of all its texts add
    up, and its texts are linked with each other; a row
    without doc_id has component_id NULL and kept false and links nothing;
    other columns are ignored; an empty table gives no rows.
    """
    sketch = saved(sketches(docs, size), "sketch")
    some = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = some.groupBy("fp1", "fp2").agg(F.min("doc_id").alias("least"))
    classes = saved(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    reps = some.select("fp1", "fp2", F.col("doc_id").alias("least"), "tokens").join(classes, ["fp1", "fp2", "least"])
    reps = saved(reps.dropDuplicates(["id"]).select("id", "tokens"), "reps")
    level = saved(_sized(roots(reps)), "level1")
    together = saved(classes.join(level.select("id").distinct(), "id"), "together")
    wanted = docs.join(_few(together.select(F.col("least").alias("doc_id")).distinct()), "doc_id", "left_semi")
    sets = saved(
        set_rows(wanted, size).join(together, ["fp1", "fp2"]).dropDuplicates(["fp1", "fp2"]).select("id", "shingles"), "sets"
    )
    links = join_sets(reps, level, sets, percent)
    repeated = some.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    shared = some.join(repeated, "doc_id").select("doc_id", "fp1", "fp2").join(classes, ["fp1", "fp2"])
    shared = saved(shared.select("doc_id", "id").distinct(), "shared")
    if shared.limit(1).count():  # texts that share a doc_id are one document
        first = shared.groupBy("doc_id").agg(F.min("id").alias("a"))
        links = links.unionByName(shared.join(first, "doc_id").select("a", F.col("id").alias("b")).where("a <> b"))
    linked = components(links)
    of_class = classes.join(linked, "id", "left").withColumn("component", F.coalesce("component", "id"))
    of_class = saved(of_class.select("fp1", "fp2", "least", "component"), "of_class")
    least = of_class.groupBy("component").agg(F.min("least").alias("component_id"))
    named = of_class.join(least, "component").select("fp1", "fp2", "component_id")
    out = sketch.select("doc_id", "n_shingles", "fp1", "fp2").join(named, ["fp1", "fp2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select("doc_id", "n_shingles", component.alias("component_id")).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def op9_near_dedup(spark, sf_dir):
    """Every document: five-word shingles, similarity of 0.85 or more."""
    return near_dedup(table(spark, sf_dir, "documents"))
