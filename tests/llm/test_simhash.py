"""Fingerprints and their Golay-code join against brute force."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from telemetry_lake.llm import simhash as sh

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").translate(LOW)) if w]
    n = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + n]).encode(), 42) for k in range(len(words) - n + 1)] if n else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(ids, fps):
    """Smallest id reachable over fingerprints at most four bits apart, by looking at all pairs."""
    f = np.array(fps, dtype=np.uint64)
    out, seen = {}, np.zeros(len(f), bool)
    for i in range(len(f)):
        if seen[i]:
            continue
        seen[i], front, group = True, [i], []
        while front:
            at = front.pop()
            group.append(at)
            new = np.flatnonzero((np.bitwise_count(f ^ f[at]) <= 4) & ~seen)
            seen[new] = True
            front += new.tolist()
        known = [ids[k] for k in group if ids[k] is not None]
        out |= dict.fromkeys(group, min(known) if known else None)
    return [out[i] for i in range(len(f))]


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in sh.op11_simhash(spark, sf_dir).collect()}
    fps = [brute_fingerprint(r["text"]) for r in docs]
    ids = [r["doc_id"] for r in docs]
    assert [got[i]["fingerprint"] for i in ids] == [f"{f:016x}" for f in fps]
    assert [got[i]["component_id"] for i in ids] == brute_groups(ids, fps)


def test_edge_rows(spark):
    long = " ".join(f"word{i % 97}x{i}" for i in range(90000))
    rows = [(1, None), (2, ""), (3, " \n\t\x0b "), (4, "A b C d E f"), (5, "a\nB  c D e F "), (6, long), (7, long + " end"),
            (7, "other text of the same id"), (7, "other text of the same id"), (None, "a b c d e f"), (None, "nobody else has this"),
            (8, "É ñ ß word"), (9, "é ñ ß word"), (10, "x")]
    frame = spark.createDataFrame([(i, t, 0.5, "c", 1) for i, t in rows],
                                  "doc_id bigint, text string, fp double, component string, key int")
    got = sorted(sh.simhash_groups(frame).collect(), key=str)
    fps = [brute_fingerprint(t) for _, t in rows]
    want = zip([i for i, _ in rows], [f"{f:016x}" for f in fps], brute_groups([i for i, _ in rows], fps), strict=True)
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert got[0].__fields__ == ["doc_id", "fingerprint", "component_id"]
    assert not sh.simhash_groups(frame.where("false")).count()


def test_every_near_pair_shares_a_key():
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 64, 600, dtype=np.uint64)
    for d in range(5):
        for low, high in ((0, 64), (0, 21), (21, 42), (42, 64)):
            near = fps.copy()
            for i in range(len(near)):
                for bit in rng.choice(np.arange(low, high), d, replace=False):
                    near[i] ^= np.uint64(1 << int(bit))
            key, row = sh.keys(fps)
            other, place = sh.keys(near)
            both = set(zip(key.tolist(), row.tolist(), strict=True)) & set(zip(other.tolist(), place.tolist(), strict=True))
            assert {r for _, r in both} == set(range(len(fps)))
    assert np.bincount(row).max() == 252


@pytest.mark.parametrize("held", [4, 64, sh.HELD])
def test_dense_clusters_and_large_keys(spark, held):
    """Fingerprints around a few centres; keys over ``held`` members go by pairs of blocks."""
    rng = np.random.default_rng(9)
    fps = set()
    for centre in rng.integers(0, 1 << 64, 3, dtype=np.uint64):
        for _ in range(150):
            bits = rng.choice(64, rng.integers(0, 6), replace=False)
            fps.add(int(centre) ^ sum(1 << int(b) for b in bits))
    fps = sorted(fps)
    signed = np.array(fps, dtype=np.uint64).view(np.int64).tolist()
    frame = spark.createDataFrame([(x,) for x in signed], "fp bigint").repartition(4)
    found = [(r["a"], r["b"]) for r in sh.links(frame, held=held).collect()]
    at = {x: i for i, x in enumerate(signed)}
    group = list(range(len(fps)))
    for a, b in found:
        assert (fps[at[a]] ^ fps[at[b]]).bit_count() <= 4
        old, new = group[at[b]], group[at[a]]
        group = [new if g == old else g for g in group]
    want = brute_groups(list(range(len(fps))), fps)
    assert len(set(zip(group, want, strict=True))) == len(set(want)) == len(set(group))


def test_links_grow_with_the_cluster(spark):
    """A dense cluster gives links in proportion to its size, not to its pairs."""
    rng = np.random.default_rng(5)
    made = []
    for n in (500, 2000):
        fps = {sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in range(n)}
        signed = np.array(sorted(fps), dtype=np.uint64).view(np.int64).tolist()
        frame = spark.createDataFrame([(x,) for x in signed], "fp bigint")
        made.append(sh.meet(sh.keyed(frame)).where(F.col("key").isNull()).count() / len(signed))
    assert made[1] < 3 * made[0]
