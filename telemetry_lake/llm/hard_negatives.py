"""Hard negatives by exact inner-product search with coordinate pruning.

Every row of ``embeddings`` is held as integers.  The distinct rows are dealt
by a hash to blocks of about ``BLOCK`` rows; every anchor visits every block of
its dimension.  Within a block, rows lie in *length buckets*: sorted by
falling length, a new bucket begins after ``BUCKET`` rows or where the length
falls below ``SHRINK`` of the bucket's longest.  A bucket keeps a sorted list
of values for each coordinate of its normalised rows.

An anchor q that looks for scores of at least t visits buckets in order.  No
row of a bucket of greatest length l reaches t if ``t > |q| * l``: then that
bucket and all later ones are left out.  Otherwise a row p with
``cos(q, p) >= c``, c = t / (|q| l), has in every coordinate f a value in

    q_f c  -  sqrt((1 - c*c) (1 - q_f*q_f))  ..  q_f c  +  sqrt(...)

(q, p normalised, c > 0; no upper end where q_f >= c, no lower one where
q_f <= -c).  For the ``FOCUS`` coordinates where the anchor is
largest, these ranges are looked up in the sorted lists; rows that lie in all
of them are candidates, whose exact integer scores are then taken.  t rises as
results are found.  Where the ranges hold most of a bucket, as for short
random vectors, the whole bucket is verified.  Nothing is lost either way.

Two searches follow each other: an anchor's positives among the rows of its
own label, then the negatives in the score window of each of its positives.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetry_lake.llm.frames import saved, table

BLOCK = 1 << 14
BUCKET = 2048
SHRINK = 0.9
FOCUS = 4
WORTH = 0.25  # largest share of a bucket that is looked up by ranges
ANCHORS = 256  # anchors worked on at a time
LONGEST = 1 << 31  # rows of this length or more could have scores that no long holds
POSITIVES = 5
NEGATIVES = 3
SCALE = 256
_NONE = -(1 << 62)
#: The scores n with 50 p <= 100 n <= 95 p: from p / 2 rounded up to 19 p / 20 rounded down; none without a p.
_LOWS = "transform(scores, p -> coalesce((p + pmod(p, 2)) div 2, 1L))"
_HIGHS = "transform(scores, p -> coalesce(p - (p + pmod(-p, 20)) div 20, 0L))"


# --- rows ---------------------------------------------------------------------------


def quantised(rows: DataFrame, shift: int = 7, count: int = 10) -> DataFrame:
    """(vec_id, label, vec: binary of int64, copies) of the distinct rows that take part.

    Where vec_id is divisible by ``shift``, the label moves on by one of ``count`` labels.
    """

    def run(batches):
        for batch in batches:
            ids, labels, lists = (batch.column(k) for k in range(3))
            missing = ids.is_null().to_numpy(False) | labels.is_null().to_numpy(False) | lists.is_null().to_numpy(False)
            values, offsets = lists.values.to_numpy(False), lists.offsets.to_numpy()  # a NULL component is not a number
            at, vectors = [], []
            for i in np.flatnonzero(~missing).tolist():
                with np.errstate(over="ignore", invalid="ignore"):
                    scaled = np.floor(SCALE * values[offsets[i] : offsets[i + 1]])
                    if scaled @ scaled < float(LONGEST) ** 2:  # false for infinite ones and those that are not a number
                        at.append(i)
                        vectors.append(scaled.astype("<i8").tobytes())
            ids, labels = ids.to_numpy(False)[at].astype(np.int64), labels.to_numpy(False)[at].astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(np.where(ids % shift == 0, (labels + 1) % count, labels)), pa.array(vectors, pa.binary())],
                names=["vec_id", "label", "vec"],
            )

    named = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>"))
    each = named.mapInArrow(run, "vec_id bigint, label bigint, vec binary")
    return each.groupBy("vec_id", "label", "vec").agg(F.count(F.lit(1)).alias("copies"))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i8").reshape(len(column), -1)


# --- buckets ------------------------------------------------------------------------


class Bucket:
    """Rows of similar length with a sorted list of values for each coordinate."""

    def __init__(self, vectors: np.ndarray, lengths: np.ndarray, ids: np.ndarray, labels: np.ndarray, copies: np.ndarray):
        self.vectors, self.ids, self.labels, self.copies = vectors, ids, labels, copies
        self.longest = float(lengths.max())
        self.exact = vectors.astype(np.float64).T.copy()
        unit = vectors / np.maximum(lengths, 1.0)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(unit, self.order.T, axis=0).T.copy()

    def scores(self, anchors: np.ndarray, longest: float) -> np.ndarray:
        """Exact inner products of anchors (rows x coordinates) with all rows of the bucket.

        Partial sums are bounded by the product of the lengths, so they are
        exact in doubles below 2**53.
        """
        if longest * self.longest < 2.0**53:
            return (anchors.astype(np.float64) @ self.exact).astype(np.int64)
        return anchors @ self.vectors.T

    def candidates(self, unit: np.ndarray, cosine: float) -> np.ndarray | None:
        """Rows whose focus coordinates lie in the feasible ranges; None where these hold most of the bucket."""
        if cosine <= 0:
            return None
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        middle = unit[focus] * cosine
        width = np.sqrt(max(0.0, 1 - cosine * cosine) * np.maximum(0.0, 1 - unit[focus] ** 2)) + 1e-9
        lows = np.where(unit[focus] <= -cosine, -2.0, middle - width)
        highs = np.where(unit[focus] >= cosine, 2.0, middle + width)
        ranges = []
        for f, low, high in zip(focus, lows, highs, strict=True):
            a, b = np.searchsorted(self.values[f], low, "left"), np.searchsorted(self.values[f], high, "right")
            ranges.append((b - a, f, a, b))
        ranges.sort()
        if ranges[0][0] > WORTH * len(self.ids):
            return None
        seen = np.zeros(len(self.ids), dtype=np.int64)
        for _, f, a, b in ranges:
            seen[self.order[f, a:b]] += 1
        return np.flatnonzero(seen == len(ranges))


def buckets(vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, copies: np.ndarray) -> list[Bucket]:
    """Length buckets of a block, longest first."""
    lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
    order = np.lexsort((ids, -lengths))
    out, first = [], 0
    while first < len(order):
        end = min(first + BUCKET, len(order))
        short = np.searchsorted(-lengths[order[first:end]], -SHRINK * lengths[order[first]], "right")
        end = first + max(1, int(short))
        at = order[first:end]
        out.append(Bucket(vectors[at], lengths[at], ids[at], labels[at], copies[at]))
        first = end
    return out


def _hits(bucket: Bucket, rows: np.ndarray, at: np.ndarray, score: np.ndarray, ids: np.ndarray, labels: np.ndarray,
          least: np.ndarray, high: np.ndarray, k: int, same: bool) -> list[tuple]:
    """(anchor, window, score, id, copies) that may be among the first ``k``; ``score``: anchors ``rows`` x places ``at``."""
    fits = bucket.labels[at][None, :] == labels[rows][:, None]
    fits = fits & (bucket.ids[at][None, :] != ids[rows][:, None]) if same else ~fits
    out = []
    for w in range(high.shape[1]):
        good = fits & (score >= least[rows, w][:, None]) & (score <= high[rows, w][:, None])
        if good.shape[1] > k:  # nothing below the k-th best of this bucket is needed
            best = np.partition(np.where(good, score, _NONE), good.shape[1] - k, axis=1)[:, -k]
            good &= score >= best[:, None]
        r, c = np.nonzero(good)
        out.append((rows[r], np.full(len(r), w), score[r, c], bucket.ids[at[c]], bucket.copies[at[c]]))
    return out


def search(block: list[Bucket], anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray, low: np.ndarray,
           high: np.ndarray, k: int, same: bool) -> list[np.ndarray]:
    """Best rows of a block for each anchor and each of its windows.

    ``low``, ``high`` (anchors x windows): scores looked for, ends included.
    ``same``: rows of the anchor's label with another id, else rows of other
    labels.  Returns arrays (anchor, window, score, id) of the first ``k`` rows,
    a row with copies as often as it has them.
    """
    lengths = np.sqrt((anchors.astype(np.float64) ** 2).sum(axis=1))
    unit = anchors / np.maximum(lengths, 1.0)[:, None]
    longest = float(lengths.max(initial=0.0))
    least = low.copy()  # rises to the k-th best score so far
    open_ = low <= high
    kept = [np.zeros(0, np.int64)] * 4
    for bucket in block:
        floor = np.where(open_, least, 1 << 62).min(axis=1)
        reach = lengths * bucket.longest * (1 + 1e-9) + 1
        live = np.flatnonzero(open_.any(axis=1) & (floor <= reach))
        if not len(live):
            break
        whole, parts = [], []
        for i in live:
            cosine = (float(floor[i]) - 1) / max(1e-9, lengths[i] * bucket.longest * (1 + 1e-9))
            chosen = bucket.candidates(unit[i], min(cosine, 1.0)) if floor[i] > 0 else None
            if chosen is None:
                whole.append(i)
            elif len(chosen):
                parts.append((i, chosen))
        found = []
        want = (ids, labels, least, high, k, same)
        if whole:
            rows = np.array(whole)
            found += _hits(bucket, rows, np.arange(len(bucket.ids)), bucket.scores(anchors[rows], longest), *want)
        for i, chosen in parts:
            score = (bucket.vectors[chosen] @ anchors[i])[None, :]
            found += _hits(bucket, np.array([i]), chosen, score, *want)
        if not found:
            continue
        anchor, window, score, place, copies = (np.concatenate(x) for x in zip(*found, strict=True))
        often = np.minimum(copies, k)
        fresh = [np.repeat(x, often) for x in (anchor, window, score, place)]
        kept = _first([np.concatenate(x) for x in zip(kept, fresh, strict=True)], k)
        full = np.flatnonzero(kept[4] == k - 1)
        least[kept[0][full], kept[1][full]] = np.maximum(least[kept[0][full], kept[1][full]], kept[2][full])
        kept = kept[:4]
    return kept


def _first(rows: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The first ``k`` of each (anchor, window) by falling score and rising id, with their places from 0."""
    order = np.lexsort((rows[3], -rows[2], rows[1], rows[0]))
    rows = [x[order] for x in rows]
    n = len(order)
    if not n:
        return [*rows, np.zeros(0, np.int64)]
    new = np.r_[True, (rows[0][1:] != rows[0][:-1]) | (rows[1][1:] != rows[1][:-1])]
    starts = np.flatnonzero(new)
    place = np.arange(n) - np.repeat(starts, np.diff(np.r_[starts, n]))
    keep = place < k
    return [*(x[keep] for x in rows), place[keep]]


# --- searches over all blocks --------------------------------------------------------


def _visits(rows: DataFrame, anchors: DataFrame, k: int, same: bool) -> DataFrame:
    """(anchor, window, score, vec_id): the first ``k`` of each block for each anchor and window.

    ``rows``: (vec_id, label, vec, copies, dim, block); ``anchors``: (anchor, vec_id,
    label, vec, dim, lows, highs, blocks).  A task gets a block's rows first, builds its
    buckets and then reads the anchors, ``ANCHORS`` at a time.
    """
    none = F.lit(None).cast("array<bigint>")
    here = rows.select("dim", "block", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("anchor"), "vec_id",
                       "label", "vec", "copies", none.alias("lows"), none.alias("highs"))
    there = anchors.select("dim", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("kind"),
                           "anchor", "vec_id", "label", "vec", F.lit(1).cast("bigint").alias("copies"), "lows", "highs")

    def run(batches):
        at, held, block = None, [], []

        def visit(part: pa.RecordBatch):
            lows = np.array(part.column(8).to_pylist(), dtype=np.int64).reshape(part.num_rows, -1)
            highs = np.array(part.column(9).to_pylist(), dtype=np.int64).reshape(part.num_rows, -1)
            ids, labels = (part.column(x).to_numpy() for x in (4, 5))
            who, window, score, found = search(block, _matrix(part.column(6)), ids, labels, lows, highs, k, same)
            return pa.RecordBatch.from_arrays(
                [pa.array(part.column(3).to_numpy()[who]), pa.array(window, pa.int32()), pa.array(score), pa.array(found)],
                names=["anchor", "window", "score", "vec_id"],
            )

        for batch in batches:
            where = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1).astype(np.int64)
            cuts = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
            edges = np.r_[0, cuts, len(where)] if len(where) else []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                part, key = batch.slice(a, b - a), (int(where[a, 0]), int(where[a, 1]))
                if key != at:
                    at, held, block = key, [], []
                if where[a, 2] == 0:
                    held.append(part)
                    continue
                if held:
                    t = pa.Table.from_batches(held)
                    block, held = buckets(_matrix(t.column("vec")), *(t.column(x).to_numpy() for x in ("vec_id", "label", "copies"))), []
                for first in range(0, part.num_rows, ANCHORS):
                    yield visit(part.slice(first, ANCHORS))

    both = here.unionByName(there).repartition("dim", "block").sortWithinPartitions("dim", "block", "kind")
    return both.mapInArrow(run, "anchor bigint, window int, score bigint, vec_id bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of each (anchor, window), with rank from 1."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(rows: DataFrame, every: int = 50, shift: int = 7, block: int = BLOCK) -> DataFrame:
    """For each anchor and each of its positives, the best rows of other labels within the score window.

    ``rows``: (vec_id, embedding, label).  Anchors are rows whose vec_id is
    divisible by ``every``; where vec_id is divisible by ``shift``, the label is
    moved by one first.  Returns anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    Rows with a NULL vec_id, label or vector or a NULL or non-finite component
    take no part, nor do rows of length 2**31 or more after scaling, whose
    scores no long may hold.  Vectors are compared with those of their own
    dimension; empty vectors have score 0 with each other.  Repeated rows count
    as often as they stand, but as one anchor; rows of the anchor's own vec_id
    are never its positives.  Ties go to the smaller vec_id.  Other columns are
    ignored; an empty table gives no rows.
    """
    taken = saved(quantised(rows, shift), "quantised").withColumn("dim", F.length("vec"))
    sizes = taken.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("blocks"))
    placed = saved(taken.join(sizes, "dim"), "placed")  # one row of sizes for each dimension
    dealt = placed.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "vec"), "blocks"))
    anchors = placed.where(F.col("vec_id") % every == 0).drop("copies")
    anchors = saved(anchors.withColumn("anchor", F.monotonically_increasing_id()), "anchors")
    any_score = anchors.withColumns({"lows": F.array(F.lit(_NONE)), "highs": F.array(F.lit(-_NONE))})
    positives = _ranked(_visits(dealt, any_score, POSITIVES, same=True), POSITIVES)
    positives = saved(positives.select("anchor", "rank", "score", "vec_id"), "positives")
    scores = [F.max(F.when(F.col("rank") == k, F.col("score"))) for k in range(1, POSITIVES + 1)]
    windows = positives.groupBy("anchor").agg(F.array(*scores).alias("scores")).select(
        "anchor", F.expr(_LOWS).alias("lows"), F.expr(_HIGHS).alias("highs")
    )
    found = _ranked(_visits(dealt, anchors.join(windows, "anchor"), NEGATIVES, same=False), NEGATIVES)
    chosen = positives.select("anchor", (F.col("rank") - 1).alias("window"), F.col("vec_id").alias("positive_id"),
                              F.col("score").alias("positive_score"))
    named = found.withColumnRenamed("score", "negative_score").withColumnRenamed("vec_id", "negative_id")
    return named.join(chosen, ["anchor", "window"]).join(
        anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor"
    ).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark, sf_dir):
    """Every anchor against all embeddings."""
    return hard_negatives(table(spark, sf_dir, "embeddings"))


#: The same by comparing every anchor with every row.
OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank,
       s.other_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3"""
