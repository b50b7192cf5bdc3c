"""Exact duplicates through minimal perfect hash functions over historical digests.

A *history* is a table of distinct SHA-256 digests with the winning document of
each.  It is cut into shards by digest prefix; each shard stores a minimal
perfect hash (levels of bit arrays, as in Limasset et al. 2017) and, slot by
slot, the full digest and the winner's locator.  Arriving digests are looked up
shard by shard: the hash gives one slot, the slot's 32 bytes are compared, and
only equal bytes count as a repeat.  Digests outside the history group among
themselves.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.frames import saved, table
from telemetry_lake.llm.text import mix

SHARD_DIGESTS = 1 << 18  # digests of a shard on average: 12 MB of slots
NO_ID = -(1 << 63)  # stands in a slot for the winner of a group without any id
GAMMA = 2.0  # bits of a level per key that reaches it


# --- minimal perfect hash of one shard -------------------------------------------


def _level_bits(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    return mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)


def build_mph(digests: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """(levels, slot of each digest) for distinct digests given as an (n, 32) byte array.

    A level keeps the keys that are alone on their bit; the others go to the
    next one.  Keys are 16 bytes of the digest folded to 64 bits; should two
    digests share them, the last level lists them one by one, so any distinct
    digests get distinct slots 0 .. n-1.
    """
    keys = _keys(digests)
    slots = np.full(len(keys), -1, dtype=np.int64)
    left, levels, used = np.arange(len(keys)), [], 0
    while len(left) and len(levels) < 40:
        size = max(64, int(GAMMA * len(left)))
        at = _level_bits(keys[left], len(levels), size).astype(np.int64)
        count = np.bincount(at, minlength=size)
        alone = count == 1
        rank = np.cumsum(alone) - 1
        done = alone[at]
        slots[left[done]] = used + rank[at[done]]
        used += int(alone.sum())
        levels.append(alone)
        left = left[~done]
    slots[left] = used + np.arange(len(left))
    return levels, slots


def look_up(levels: list[np.ndarray], slot_digests: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Slot of each wanted digest, or -1; every hit is confirmed on its 32 bytes."""
    keys, found = _keys(wanted), np.full(len(wanted), -1, dtype=np.int64)
    left, used = np.arange(len(wanted)), 0
    for depth, alone in enumerate(levels):
        at = _level_bits(keys[left], depth, len(alone)).astype(np.int64)
        rank, hit = np.cumsum(alone) - 1, alone[at]
        found[left[hit]] = used + rank[at[hit]]
        used += int(alone.sum())
        left = left[~hit]
    if len(left) and used < len(slot_digests):  # keys that never stood alone
        tail = {bytes(d): used + i for i, d in enumerate(slot_digests[used:])}
        found[left] = [tail.get(bytes(d), -1) for d in wanted[left]]
    seen = found >= 0
    same = np.zeros(len(wanted), dtype=bool)
    same[seen] = (slot_digests[found[seen]] == wanted[seen]).all(axis=1)
    return np.where(same, found, -1)


def _keys(digests: np.ndarray) -> np.ndarray:
    words = np.ascontiguousarray(digests[:, 8:24]).view("<u8")
    return words[:, 0] ^ mix(words[:, 1])


def _digest_rows(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, 32)


# --- Spark side -------------------------------------------------------------------


def text_sha256() -> Column:
    """SHA-256 (hex) of column text with A-Z lower-cased; NULL counts as empty."""
    low = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.sha2(low, 256)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest): the bytes of ``text_sha256``."""
    return docs.select("doc_id", F.unhex(text_sha256()).alias("digest"))


def winners(rows: DataFrame) -> DataFrame:
    """One row per digest: the largest doc_id and the number of rows (combined before the shuffle)."""
    return rows.groupBy("digest").agg(F.max("doc_id").alias("winner"), F.count(F.lit(1)).alias("n"))


def _shard(shards: int):
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """History (digest, winner, n) -> one index row per shard.

    Columns: shard, levels (bit arrays, packed), sizes (bits of each level),
    slots (digests in slot order), winners and counts (little-endian int64).
    """

    def build(t: pa.Table) -> pa.Table:
        rows = _digest_rows(t.column("digest"))
        levels, slot = build_mph(rows)
        order = np.argsort(slot)
        take = lambda name: t.column(name).to_numpy()[order].astype("<i8").tobytes()
        return pa.table(
            {
                "shard": pa.array([t.column("shard")[0].as_py()], pa.int32()),
                "levels": pa.array([[np.packbits(x).tobytes() for x in levels]], pa.list_(pa.binary())),
                "sizes": pa.array([[len(x) for x in levels]], pa.list_(pa.int64())),
                "slots": pa.array([rows[order].tobytes()], pa.binary()),
                "winners": pa.array([take("winner")], pa.binary()),
                "counts": pa.array([take("n")], pa.binary()),
            }
        )

    return (
        history.withColumn("winner", F.coalesce("winner", F.lit(NO_ID)))
        .withColumn("shard", _shard(shards))
        .groupBy("shard")
        .applyInArrow(
            build,
            "shard int, levels array<binary>, sizes array<bigint>, slots binary, winners binary, counts binary",
        )
    )


def probe(arrivals: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Look distinct arriving digests (digest, winner, n) up in the index.

    Adds old_winner and old_n, NULL for a digest outside the history.
    """

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        wanted = left.select(["digest", "winner", "n"])
        old, old_n = np.zeros(left.num_rows, np.int64), np.zeros(left.num_rows, np.int64)
        miss = np.ones(left.num_rows, bool)
        if left.num_rows and right.num_rows:
            row = right.slice(0, 1).to_pylist()[0]
            levels = [
                np.unpackbits(np.frombuffer(b, np.uint8), count=size).astype(bool)
                for b, size in zip(row["levels"], row["sizes"], strict=True)
            ]
            slots = np.frombuffer(row["slots"], np.uint8).reshape(-1, 32)
            at = look_up(levels, slots, _digest_rows(left.column("digest")))
            miss = at < 0
            old = np.where(miss, 0, np.frombuffer(row["winners"], "<i8")[at])
            old_n = np.where(miss, 0, np.frombuffer(row["counts"], "<i8")[at])
        return wanted.append_column("old_winner", pa.array(old, pa.int64(), mask=miss | (old == NO_ID))).append_column(
            "old_n", pa.array(old_n, pa.int64(), mask=miss)
        )

    return (
        arrivals.withColumn("shard", _shard(shards))
        .groupBy("shard")
        .cogroup(index.groupBy("shard"))
        .applyInArrow(match, "digest binary, winner bigint, n bigint, old_winner bigint, old_n bigint")
    )


def exact_dedup(history: DataFrame, arrivals: DataFrame, shard_digests: int = SHARD_DIGESTS) -> DataFrame:
    """Group the rows of two tables (doc_id, text) by text, ignoring the case of A-Z.

    Returns one row per input row of either table: doc_id, keep_id (the largest
    doc_id of the equal texts), group_size, kept, text_sha256.

    NULL and empty texts are one group.  A row without doc_id never wins over
    one with an id; if a group has no id at all, keep_id is NULL and kept false.
    Rows repeated with the same doc_id count one by one and are all kept or all
    dropped.  Empty tables give no rows; other columns are ignored.
    """
    rows = saved(
        digests(history).withColumn("old", F.lit(True)).unionByName(digests(arrivals).withColumn("old", F.lit(False))),
        "digests",
    )
    past = saved(winners(rows.where("old")), "history")
    new = saved(winners(rows.where("not old")), "arrivals")
    shards = max(1, -(-max(past.count(), new.count()) // shard_digests))  # neither side outgrows a shard
    hits = saved(probe(new, build_index(past, shards), shards), "hits")
    # a repeat joins its historical group; the larger id wins
    groups = hits.select(
        "digest",
        F.greatest("winner", "old_winner").alias("keep_id"),
        (F.col("n") + F.coalesce("old_n", F.lit(0))).alias("group_size"),
    ).unionByName(
        past.select("digest", F.col("winner").alias("keep_id"), F.col("n").alias("group_size")).join(
            hits.select("digest"), "digest", "left_anti"
        )
    )
    return rows.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("bigint").alias("group_size"),
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.lit(False)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def split_batches(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The older half of the rows by id as history, the rest (and rows without id) as arrivals.

    The middle is an approximate median, which ids far off don't move.
    """
    middle = docs.agg(F.percentile_approx("doc_id", 0.5)).first()[0]
    old = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(False))
    return docs.where(old), docs.where(~old)


def op6_exact_dedup(spark, sf_dir):
    """Every document; ids up to the middle are the history, the others arrive."""
    return exact_dedup(*split_batches(table(spark, sf_dir, "documents")))


OP6_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM t"""
