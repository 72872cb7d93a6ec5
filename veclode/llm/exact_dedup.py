"""Exact deduplication against history by a minimal perfect hash.

The distinct digests of earlier documents are dealt into segments by their own bits, and in
each segment a task finds a minimal perfect hash: digests fall into small buckets, and every
bucket gets the least seed that sends its digests to free slots (a bucket of one names its
slot outright). The hash of n digests has exactly n slots; a slot holds a full digest and the
locator of that group's winner. Any digest leads to one slot in its segment, so a lookup
compares one digest: equal bytes mean a repeat, anything else a text that history has not
seen. Those form groups of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veclode.llm.common import column, stored

# Digests in a segment and in a bucket, on average.
SEGMENT = 4096
BUCKET = 3
# Seeds tried at once for a bucket.
TRIED = 128
WHITE_SPACE = " \t\n\x0b\x0c\r"


def text_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text without white space, in UTF-8; null counts as empty."""
    bare = F.translate(F.coalesce(text.cast("string"), F.lit("")), WHITE_SPACE, "")
    return F.unhex(F.sha2(bare.cast("binary"), 256))


def _words(digests: np.ndarray) -> np.ndarray:
    """n x 4 whole numbers of n digests (n x 32 bytes)."""
    return np.ascontiguousarray(digests).view("<u8")


def _slots(words: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    """Slots of digests under seeds (shapes broadcast): a mixed hash modulo n."""
    h = words[..., 1] ^ (seeds.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) + words[..., 2]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(32))) % np.uint64(n)).astype(np.int64)


def _buckets(words: np.ndarray, seeds: int) -> np.ndarray:
    return (words[..., 3] % np.uint64(seeds)).astype(np.int64)


def perfect_hash(digests: np.ndarray) -> np.ndarray:
    """Seeds of the buckets for n distinct digests (n x 32 bytes).

    A bucket of one digest holds ``-1 - slot``. Large buckets choose first, while most slots
    are free.
    """
    n, words = len(digests), _words(digests)
    seeds = np.zeros(max(1, -(-n // BUCKET)), np.int32)
    bucket = _buckets(words, len(seeds))
    order = np.argsort(bucket, kind="stable")
    sizes = np.bincount(bucket, minlength=len(seeds))
    ends = np.cumsum(sizes)
    free = np.ones(n, bool)
    by_size = np.argsort(-sizes, kind="stable")
    for b in by_size[sizes[by_size] > 1].tolist():
        own = words[order[ends[b] - sizes[b] : ends[b]]]
        first = 0
        while True:
            tried = np.arange(first, first + TRIED)
            slots = _slots(own[None, :, :], tried[:, None], n)
            apart = np.sort(slots, axis=1)
            good = free[slots].all(axis=1) & (apart[:, 1:] != apart[:, :-1]).all(axis=1)
            if good.any():
                break
            first += TRIED
            if first > 1 << 30:
                raise ValueError("digests are not distinct")
        won = int(good.argmax())
        seeds[b] = first + won
        free[slots[won]] = False
    singles = by_size[sizes[by_size] == 1]
    seeds[singles] = -1 - np.flatnonzero(free)[: len(singles)]
    return seeds


def slot_of(digests: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    """The one slot where a digest can be, of n."""
    words = _words(digests)
    seed = seeds[_buckets(words, len(seeds))].astype(np.int64)
    return np.where(seed < 0, -1 - seed, _slots(words, np.maximum(seed, 0), n))


def _digest_rows(values: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(values.to_pylist()), np.uint8).reshape(-1, 32)


def _grouped(rows: DataFrame) -> DataFrame:
    """``digest, member``: a group's winner and how many rows the group has.

    The longest original text wins, then the least key (null first), then the row read first.
    Counted and compared in the tasks before anything is shuffled.
    """
    best = F.min(F.struct((-F.col("length")).alias("minus"), "key", "row"))
    groups = rows.groupBy("digest").agg(best.alias("best"), F.count(F.lit(1)).alias("copies"))
    return groups.select("digest", F.struct("best.*", "copies").alias("member"))


def _number(digest: Column) -> Column:
    """The first six bytes of a digest; the hash inside a segment does not use them."""
    return F.conv(F.hex(F.substring(digest, 1, 6)), 16, 10).cast("bigint")


def _numbers(digests: np.ndarray) -> np.ndarray:
    parts = digests[:, :6].astype(np.int64)
    return parts @ (1 << np.arange(40, -1, -8, dtype=np.int64))


def build_index(history: DataFrame, segment: int = SEGMENT) -> tuple[DataFrame, int]:
    """Index of ``digest, member`` rows with distinct digests, and its number of segments.

    One row for each segment: ``segment, seeds, digests, members``; place i of ``digests``
    (32 bytes each) and ``members`` is slot i. A segment is one task's work at a time, about
    ``segment`` digests whatever the texts are.
    """
    segments = max(1, -(-history.count() // segment))
    schema = T.StructType(
        [
            T.StructField("segment", T.LongType()),
            T.StructField("seeds", T.ArrayType(T.IntegerType())),
            T.StructField("digests", T.BinaryType()),
            T.StructField("members", T.ArrayType(history.schema["member"].dataType)),
        ]
    )

    def build(rows: pa.Table) -> pa.Table:
        digests = _digest_rows(rows["digest"])
        seeds = perfect_hash(digests)
        place = np.argsort(slot_of(digests, seeds, len(digests)))
        members = rows["member"].combine_chunks().take(pa.array(place))
        return pa.Table.from_arrays(
            [
                rows["segment"].slice(0, 1),
                pa.array([seeds.tolist()], pa.list_(pa.int32())),
                pa.array([digests[place].tobytes()], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(place)], pa.int32()), members),
            ],
            names=schema.names,
        )

    own = F.pmod(_number(F.col("digest")), F.lit(segments)).alias("segment")
    dealt = history.select(own, "digest", "member")
    return stored(dealt.groupBy("segment").applyInArrow(build, schema)), segments


def look_up(
    index: DataFrame, segments: int, groups: DataFrame, segment: int = SEGMENT
) -> DataFrame:
    """Every group of the index and of ``groups`` (distinct ``digest, member``), merged.

    ``digest, known, member``: ``known`` is the slot's member, ``member`` the new one; a
    repeat has both, the rest one of them. Where many more digests are looked up than are
    indexed, segments are looked up in several cells of bounded size, each with its own copy.
    """
    copies = max(1, -(-groups.count() // (2 * segment * segments)))
    cells = segments * copies
    kind = groups.schema["member"].dataType
    schema = T.StructType(
        [
            T.StructField("digest", T.BinaryType()),
            T.StructField("known", kind),
            T.StructField("member", kind),
        ]
    )

    def match(rows: pa.Table, slots: pa.Table) -> pa.Table:
        digests = _digest_rows(rows["digest"])
        members = rows["member"].combine_chunks()
        slot = np.full(len(digests), -1)
        held, known, own = np.zeros((0, 32), np.uint8), members.slice(0, 0), np.zeros(0, np.int64)
        if slots.num_rows:
            held = np.frombuffer(slots["digests"][0].as_py(), np.uint8).reshape(-1, 32)
            known = slots["members"].combine_chunks().flatten()
            seeds = slots["seeds"].combine_chunks().flatten().to_numpy()
            # a slot is given out by the cell its digest belongs to
            own = np.flatnonzero(_numbers(held) % cells == slots["cell"][0].as_py())
            at = slot_of(digests, seeds, len(held))
            slot = np.where((held[at] == digests).all(axis=1), at, -1)
        met = np.full(len(held), -1)
        met[slot[slot >= 0]] = np.flatnonzero(slot >= 0)
        new = np.flatnonzero(slot < 0)
        theirs = np.concatenate([own, np.full(len(new), -1)])
        mine = np.concatenate([met[own], new])
        both = np.concatenate([held[own], digests[new]])
        found = [pa.array([d.tobytes() for d in both], pa.binary())]
        for values, at in ((known, theirs), (members, mine)):
            found.append(values.take(pa.array(at, mask=at < 0)))
        return pa.Table.from_arrays(found, names=schema.names)

    cell = F.pmod(_number(F.col("digest")), F.lit(cells)).alias("cell")
    rows = groups.select(cell, "digest", "member")
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    slots = index.select("*", copy).withColumn("cell", F.col("segment") + F.col("copy") * segments)
    slots = slots.select(F.col("cell"), "seeds", "digests", "members")
    return rows.groupBy("cell").cogroup(slots.groupBy("cell")).applyInArrow(match, schema)


def exact_duplicates(
    docs: DataFrame,
    historical: Column,
    key: str = "doc_id",
    text: str = "text",
    segment: int = SEGMENT,
) -> DataFrame:
    """One row for every row of ``docs``: ``key, keep_id, group_size, kept, digest``.

    Texts are equal when they are without white space; a null text is empty. Rows where
    ``historical`` holds came earlier: their distinct digests are indexed, the others are
    looked up. In each group the row with the most code points stays, then the one with the
    least key (null first), then the one read first. Columns besides key and text take no part. An empty table gives an empty table.

    The two group tables, one row a distinct text, are made with partial aggregation, so a
    text that fills a third of all rows is met in many tasks; giving rows their group's winner
    is a join by digest that adaptive execution splits where it is skewed.
    """
    whole = F.coalesce(column(docs, text).cast("string"), F.lit(""))
    rows = stored(
        docs.select(
            column(docs, key).alias("key"),
            F.length(whole).cast("bigint").alias("length"),
            text_digest(whole).alias("digest"),
            F.coalesce(historical, F.lit(False)).alias("historical"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    index, segments = build_index(stored(_grouped(rows.where("historical"))), segment)
    looked_up = stored(_grouped(rows.where("NOT historical")))
    groups = look_up(index, segments, looked_up, segment)
    known, mine = F.col("known"), F.col("member")
    order = lambda m: F.struct(m["minus"], m["key"], m["row"])
    newer = known.isNull() | (mine.isNotNull() & (order(mine) < order(known)))
    winner = F.when(newer, mine).otherwise(known)
    size = F.coalesce(known["copies"], F.lit(0)) + F.coalesce(mine["copies"], F.lit(0))
    winners = groups.select(
        F.col("digest").alias("group"),
        winner["key"].alias("keep_id"),
        winner["row"].alias("keep_row"),
        size.cast("bigint").alias("group_size"),
    )
    return rows.join(winners, F.col("digest") == F.col("group")).select(
        F.col("key").alias(key),
        "keep_id",
        "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        "digest",
    )
