"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veclode.session import cut_lineage

# Text handled at once inside a task; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20


def stored(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, as a Parquet table in the shared checkpoint folder."""
    return cut_lineage(df)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def column(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots included."""
    return df["`" + name.replace("`", "``") + "`"]


def raw_bytes(values: pa.Array) -> list[bytes | None]:
    """Strings as UTF-8 bytes, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()
    return values.cast(kind).to_pylist()


def blocks(texts: list, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges holding about ``limit`` bytes (or characters) of text, one row at least."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def row_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenation of ``arange(start, start + length)`` for every pair."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


def held_out(key: Column) -> Column:
    """Whether a row is set aside for testing: crc32 of the key as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(key.cast("string")) % 4 == 2, F.lit(False))


def with_rank(df: DataFrame, group: str, unique: str, rank: str, rows_per_task: int = 20_000):
    """Number the rows of every group from 0, however large a group is.

    ``df`` must be stored and ``unique`` differ in every row. Where the largest group has more
    than ``rows_per_task`` rows, groups are cut by the hash of ``unique`` into cells of about
    that size; a row's number is the count of the group's earlier cells plus its number in its
    own cell. Only counts are ordered by group.
    """
    cell, group_, cell_, before_ = (fresh_name(df, f"rank_{n}") for n in "abcd")
    largest = df.groupBy(group).count().agg(F.max("count")).head()[0] or 0
    cells = max(1, -(-largest // rows_per_task))
    if cells == 1:
        alone = F.row_number().over(Window.partitionBy(group).orderBy(unique)) - 1
        return df.withColumn(rank, alone.cast("bigint"))
    celled = df.withColumn(cell, F.pmod(F.xxhash64(unique), F.lit(cells)))
    counts = celled.groupBy(group, cell).agg(F.count(F.lit(1)).alias(before_))
    earlier = Window.partitionBy(group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(group).alias(group_),
        F.col(cell).alias(cell_),
        F.coalesce(F.sum(before_).over(earlier), F.lit(0)).alias(before_),
    )
    own = F.row_number().over(Window.partitionBy(group, cell).orderBy(unique)) - 1
    return (
        celled.withColumn(rank, own)
        .join(offsets, (F.col(group) == F.col(group_)) & (F.col(cell) == F.col(cell_)))
        .withColumn(rank, (F.col(rank) + F.col(before_)).cast("bigint"))
        .drop(cell, group_, cell_, before_)
    )
