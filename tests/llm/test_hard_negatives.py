"""Hard negatives against brute force, with pruning on and off."""

import math
from collections import defaultdict

import numpy as np
import pytest

from telemetry_lake.llm import hard_negatives as hn

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, block int, dim int, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, x, label, 0.5, 3, 1, 9) for i, x, label in rows], SCHEMA)


def brute(rows, every=50):
    """All scores of every anchor, as lists; repeated rows count, rows of the anchor's id are no positives."""
    kept = []
    for i, x, label in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        q = [math.floor(256 * float(np.float32(v))) for v in x]
        kept.append((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(q)))
    out = []
    for i, label, q in dict.fromkeys(r for r in kept if r[0] % every == 0):
        scored = sorted((-sum(a * b for a, b in zip(q, p, strict=True)), j, m) for j, m, p in kept if len(p) == len(q))
        for s, j, _ in [x for x in scored if x[2] == label and x[1] != i][:5]:
            fits = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s][:3]
            out += [(i, j, r, n, -s, -t) for r, (t, n, _) in enumerate(fits, 1)]
    return sorted(out)


def got(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture(scope="module")
def mixed():
    """Clusters of different lengths and labels, with copies, ties and rows that take no part."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(900):
        centre = np.zeros(12)
        centre[i % 5] = 3.0
        x = (centre + rng.normal(0, 0.25, 12)) * rng.choice([0.2, 1.0, 4.0])
        rows.append((i, [float(v) for v in np.float32(x)], int(rng.integers(0, 3))))
    hot = rows[100][1]
    rows += [(2000 + i, hot, i % 2) for i in range(300)]
    rows += [rows[7], rows[7], rows[50], rows[50]]  # repeated rows, an anchor among them
    rows += [(150, hot, 2), (None, hot, 1), (3000, None, 1), (3001, hot, None), (3050, [1.0, None], 1),
             (3100, [float("nan")] * 12, 1), (3150, [float("inf")] + [0.0] * 11, 0), (3200, [1.0, 2.0], 1), (3201, [1.0, 1.5], 1),
             (3202, [1.0, 0.5], 0), (3250, [], 1), (3251, [], 1), (3252, [], 0), (3300, [0.0] * 12, 0), (3350, [1e30] * 12, 0)]
    return rows


@pytest.mark.parametrize("block", [64, hn.BLOCK])
def test_brute_force(spark, mixed, block):
    kept = [r for r in mixed if r[0] != 3350]  # too long for a long: takes no part
    assert got(hn.hard_negatives(frame(spark, mixed).repartition(3), block=block)) == brute(kept)


def test_empty(spark, mixed):
    assert not hn.hard_negatives(frame(spark, mixed).where("false")).count()
    assert not hn.hard_negatives(frame(spark, [(1, [1.0], 1), (2, [2.0], 1)])).count()  # no anchor


def test_ranges_leave_rows_out_and_lose_none():
    """Near a few directions most rows are not looked at; what is left out can't reach the score."""
    rng = np.random.default_rng(2)
    vectors = np.floor(256 * (np.eye(16)[rng.integers(0, 16, 2000)] + rng.normal(0, 0.05, (2000, 16)))).astype(np.int64)
    ids = np.arange(2000)
    (bucket, *_), total = hn.buckets(vectors, ids, ids % 2, np.ones(2000, np.int64)), 0
    lengths = np.sqrt((vectors**2).sum(axis=1))
    place = {int(v): k for k, v in enumerate(bucket.ids)}
    for a in range(0, 2000, 100):
        scores = vectors @ vectors[a]
        floor = 0.8 * lengths[a] * bucket.longest
        found = bucket.candidates(vectors[a] / lengths[a], 0.8)
        assert found is not None
        assert {place[int(v)] for v in np.flatnonzero(scores >= floor) if int(v) in place} <= set(found.tolist())
        total += len(found)
    assert total < 20 * 0.2 * len(bucket.ids)


def test_long_rows_have_exact_scores(spark):
    big = 3.0e5  # 256 * 3e5 has products above 2**53
    rows = [(50 * i, [big + i, 1.0, big - i], i % 2) for i in range(8)] + [(7 * i + 1, [big, float(i), big], i % 3) for i in range(30)]
    assert got(hn.hard_negatives(frame(spark, rows))) == brute(rows)


def test_negative_scores(spark):
    rows = [(50, [1.0, 0.0], 1), (51, [-1.0, 0.0], 1), (52, [-0.7, 0.0], 2), (53, [0.0, 1.0], 1), (54, [0.0, -1.0], 2)]
    want = brute(rows)
    assert got(hn.hard_negatives(frame(spark, rows))) == want
    by = defaultdict(list)
    for row in want:
        by[row[0], row[1]].append(row[3])
    assert (50, 53) in by and (50, 51) not in by  # no window below zero
