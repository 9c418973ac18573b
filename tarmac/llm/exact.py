"""Exact deduplication against an index of historical digests.

The distinct digests of the history are dealt to shards by their hash. Each shard
gets a minimal perfect hash, a cascade of collision-free bitmaps: a key falls to the
next level when it shares its bit with another, and the rank of its bit is its slot.
A slot holds the full digest, the history's winner and its number of copies. Digests
of a delivery, one row each, are looked up in their shard; a hit counts only when all
bytes of the digest agree. Digests that are not members form groups of their own.

Hot groups: copies are counted in each task before the shuffle, the index and the lookup see
a digest once, and the join that gives the rows their group is one that Spark can split.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import shards, ship_package, stored, text_or_empty
from tarmac.llm.hashing import mix64

DIGESTS_PER_SHARD = 100_000
BITS_PER_KEY = 2
MAX_LEVELS = 48

INDEX_SCHEMA = (
    "shard int, level_bits array<int>, bitmaps binary, digests binary, winners binary, copies binary"
)
FOUND_SCHEMA = "digest binary, member boolean, winner bigint, copies bigint"


def text_digest(column: str) -> Column:
    """SHA-256 of the unchanged text in UTF-8, as lowercase hex; null counts as empty."""
    return F.sha2(text_or_empty(column).cast("binary"), 256)


# --- the minimal perfect hash ---------------------------------------------------


def _spots(first: np.ndarray, second: np.ndarray, level: int, bits: int) -> np.ndarray:
    step = np.uint64((level + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (mix64(first ^ mix64(second + step)) % np.uint64(bits)).astype(np.int64)


def _halves(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = digests.view("<u8").reshape(len(digests), 4)
    return words[:, 0] ^ words[:, 2], words[:, 1] ^ words[:, 3]


def build_hash(digests: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, concatenated bitmaps and the slot of each of the distinct digests.

    ``digests`` has a row of 32 bytes per digest. Digests that no level could part, if
    any, take the last slots in the given order.
    """
    first, second = _halves(digests)
    slots = np.full(len(digests), -1, dtype=np.int64)
    left, sizes, bitmaps, used = np.arange(len(digests)), [], [], 0
    while len(left) and len(sizes) < MAX_LEVELS:
        bits = max(64, BITS_PER_KEY * len(left))
        spot = _spots(first[left], second[left], len(sizes), bits)
        bitmap = np.bincount(spot, minlength=bits) == 1
        alone = bitmap[spot]
        slots[left[alone]] = used + (np.cumsum(bitmap) - 1)[spot[alone]]
        used += int(alone.sum())
        sizes.append(bits)
        bitmaps.append(bitmap)
        left = left[~alone]
    slots[left] = np.arange(used, used + len(left))
    return sizes, np.concatenate(bitmaps) if bitmaps else np.empty(0, dtype=bool), slots


def find_slots(sizes: list[int], bitmaps: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The one slot where each digest can be, or -1. Members are certain of theirs."""
    first, second = _halves(digests)
    slots = np.full(len(digests), -1, dtype=np.int64)
    left, offset, used = np.arange(len(digests)), 0, 0
    for level, bits in enumerate(sizes):
        bitmap = bitmaps[offset : offset + bits]
        spot = _spots(first[left], second[left], level, bits)
        there = bitmap[spot]
        slots[left[there]] = used + (np.cumsum(bitmap) - 1)[spot[there]]
        used += int(bitmap.sum())
        offset += bits
        left = left[~there]
    return slots


def _rows(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, 32)


def _build_shard(table: pa.Table) -> pa.Table:
    digests = _rows(table["digest"])
    sizes, bitmaps, slots = build_hash(digests)
    order = np.argsort(slots)
    row = {
        "shard": [table["shard"][0].as_py()],
        "level_bits": [sizes],
        "bitmaps": [np.packbits(bitmaps).tobytes()],
        "digests": [digests[order].tobytes()],
        "winners": [table["winner"].to_numpy()[order].astype("<i8").tobytes()],
        "copies": [table["copies"].to_numpy()[order].astype("<i8").tobytes()],
    }
    kinds = [pa.int32(), pa.list_(pa.int32()), *[pa.binary()] * 4]
    return pa.table({k: pa.array(v, t) for (k, v), t in zip(row.items(), kinds, strict=True)})


def _look_up_shard(asked: pa.Table, index: pa.Table) -> pa.Table:
    count = asked.num_rows
    member = np.zeros(count, dtype=bool)
    winner, copies = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
    if count and index.num_rows:
        entry = index.to_pylist()[0]
        digests = _rows(asked["digest"])
        held = np.frombuffer(entry["digests"], dtype=np.uint8).reshape(-1, 32)
        bitmaps = np.unpackbits(
            np.frombuffer(entry["bitmaps"], dtype=np.uint8), count=sum(entry["level_bits"])
        ).astype(bool)
        slots = find_slots(entry["level_bits"], bitmaps, digests)
        unparted = {held[i].tobytes(): i for i in range(int(bitmaps.sum()), len(held))}
        if unparted:
            for i, digest in enumerate(digests):
                slots[i] = unparted.get(digest.tobytes(), slots[i])
        hit = np.flatnonzero(slots >= 0)
        hit = hit[(held[slots[hit]] == digests[hit]).all(axis=1)]
        member[hit] = True
        winner[hit] = np.frombuffer(entry["winners"], dtype="<i8")[slots[hit]]
        copies[hit] = np.frombuffer(entry["copies"], dtype="<i8")[slots[hit]]
    return pa.table(
        {
            "digest": pa.array(asked["digest"].to_pylist(), pa.binary()),
            "member": pa.array(member),
            "winner": pa.array(winner, mask=~member),
            "copies": pa.array(copies),
        }
    )


# --- the operator -----------------------------------------------------------------


def _grouped(rows: DataFrame) -> DataFrame:
    """One row per digest: the largest id (null where no copy has one) and the copies."""
    return rows.groupBy("digest").agg(F.max("id").alias("winner"), F.count("*").alias("copies"))


def build_index(groups: DataFrame, shard_count: int) -> DataFrame:
    """One row per shard from (digest, winner, copies): the stored form of the history."""
    sharded = groups.withColumn("shard", _shard(shard_count))
    return sharded.groupBy("shard").applyInArrow(_build_shard, INDEX_SCHEMA)


def look_up(groups: DataFrame, index: DataFrame, shard_count: int) -> DataFrame:
    """For each distinct digest: whether the index holds it, with winner and copies there."""
    asked = groups.select("digest", _shard(shard_count).alias("shard")).groupBy("shard")
    return asked.cogroup(index.groupBy("shard")).applyInArrow(_look_up_shard, FOUND_SCHEMA)


def _shard(count: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(count)).cast("int")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    history_up_to: int | None = None,
    digests_per_shard: int = DIGESTS_PER_SHARD,
) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256, in_history.

    Rows with an id up to ``history_up_to`` are the history, the others a delivery; by
    default the middle of the id range parts them. Of equal texts the row with the largest
    id stays, wherever its copies are. ``in_history`` tells whether the history has the text.

    Null text counts as empty, and empty texts are equal. A row without an id belongs to the
    delivery and stays only if no copy has an id. Rows that repeat an id and its text are one document:
    each is returned, counted and marked alike. Other columns are ignored; an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    rows = stored(
        docs.select(
            F.col(id_col).cast("bigint").alias("id"), F.unhex(text_digest(text_col)).alias("digest")
        ),
        "exact-digests",
    )
    if history_up_to is None:
        low, high = rows.agg(F.min("id"), F.max("id")).first()
        history_up_to = -1 if low is None else (low + high) // 2
    old = F.coalesce(F.col("id") <= history_up_to, F.lit(False))
    history = stored(_grouped(rows.filter(old)), "exact-history")
    delivery = stored(_grouped(rows.filter(~old)), "exact-delivery")
    shard_count = shards(max(history.count(), delivery.count()), digests_per_shard)

    index = stored(build_index(history, shard_count), "exact-index")
    found = look_up(delivery, index, shard_count).withColumnsRenamed(
        {"digest": "found_digest", "winner": "old_winner", "copies": "old_copies"}
    )
    # Hits and misses of the delivery, then the history with what the delivery added to it.
    seen = stored(
        delivery.join(found, F.col("digest") == F.col("found_digest")).select(
            "digest",
            "member",
            F.greatest("winner", "old_winner").alias("winner"),
            (F.col("copies") + F.col("old_copies")).alias("copies"),
        ),
        "exact-found",
    )
    untouched = history.join(seen.filter("member"), "digest", "left_anti")
    groups = seen.unionByName(untouched.withColumn("member", F.lit(True))).select(
        F.col("digest").alias("group_digest"), "member", "winner", "copies"
    )
    keep = F.col("winner")
    return rows.join(groups, F.col("digest") == F.col("group_digest"), "left").select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.col("copies").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        F.col("member").alias("in_history"),
    )
