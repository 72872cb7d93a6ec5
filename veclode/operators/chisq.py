"""Chi-squared test of every feature against the label, and selection by it."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .lookup import lookup_join
from .ranking import TAKE_ORDERED_ROWS, top_rows
from .tfidf import keep_terms

# Executors get these functions with the job; they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Indices whose cells meet in one task at a time.
RANGE = 4096
# Cells added to a task's table before it is packed, and packed cells it keeps (64 MB).
LOOSE_CELLS = 1 << 20
SPILLED_CELLS = 1 << 21
# Different labels that every task is told.
SHIPPED_LABELS = 100_000


def _packed(
    idx: np.ndarray, value: np.ndarray, label: np.ndarray, n: np.ndarray
) -> tuple[np.ndarray, ...]:
    """Cells in order of index, value and label, equal ones added up."""
    order = np.lexsort((label, value, idx))
    idx, value, label, n = idx[order], value[order], label[order], n[order]
    new = np.ones(len(idx), bool)
    new[1:] = (idx[1:] != idx[:-1]) | (value[1:] != value[:-1]) | (label[1:] != label[:-1])
    first = np.flatnonzero(new)
    return idx[first], value[first], label[first], np.add.reduceat(n, first) if len(first) else n


class Cells:
    """A sparse table of counts by index, value and label code, packed when it has grown."""

    def __init__(self):
        self.packed = _packed(*(np.zeros(0, k) for k in (np.int64, float, np.int64, np.int64)))
        self.loose: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, *cells: np.ndarray) -> None:
        self.loose.append(cells)
        self.size += len(cells[0])
        if self.size > max(LOOSE_CELLS, len(self.packed[0])):
            self.pack()

    def pack(self) -> int:
        parts = zip(self.packed, *self.loose)
        self.packed = _packed(*(np.concatenate(p) for p in parts))
        self.loose, self.size = [], 0
        return len(self.packed[0])

    def taken(self) -> tuple[np.ndarray, ...]:
        self.pack()
        out, self.packed = self.packed, tuple(c[:0] for c in self.packed)
        return out


def _by_range(cells: tuple[np.ndarray, ...], names: list[str]) -> Iterator[pa.RecordBatch]:
    """A row for each range of indices, its cells as arrays."""
    idx = cells[0]
    if not len(idx):
        return
    ranges = idx // RANGE
    first = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1]))
    offsets = pa.array(np.append(first, len(idx)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(c)) for c in cells]
    yield pa.RecordBatch.from_arrays([pa.array(ranges[first]), *lists], names=names)


CELLS = "range bigint, idx array<bigint>, value array<double>, label array<bigint>, n array<bigint>"
CELL_NAMES = ["range", "idx", "value", "label", "n"]


def _statistic(
    cells: tuple[np.ndarray, ...], totals: np.ndarray, n: float
) -> tuple[np.ndarray, np.ndarray]:
    """Indices and their chi2, from packed cells of non-zero values."""
    idx, value, label, o = cells
    c = totals[label].astype(float)
    o = o.astype(float)
    new_value = np.append(True, (idx[1:] != idx[:-1]) | (value[1:] != value[:-1]))
    rows = np.flatnonzero(new_value)
    part = np.add.reduceat(o * o / c, rows) / np.add.reduceat(o, rows)
    first = np.flatnonzero(np.append(True, idx[1:] != idx[:-1]))
    share = np.add.reduceat(part, np.searchsorted(rows, first))
    # rows whose value is not zero, by index and label
    place = np.cumsum(np.append(False, idx[1:] != idx[:-1]))
    by_label = np.lexsort((label, place))
    p, l, m = place[by_label], label[by_label], o[by_label]
    pair = np.flatnonzero(np.append(True, (p[1:] != p[:-1]) | (l[1:] != l[:-1])))
    filled = np.add.reduceat(m, pair)
    at = np.flatnonzero(np.append(True, p[pair][1:] != p[pair][:-1]))
    nz = np.add.reduceat(filled, at)
    squares = np.add.reduceat(filled * filled / totals[l[pair]], at)
    zero_rows = n - nz
    zero = np.where(zero_rows > 0, (n - 2 * nz + squares) / np.maximum(zero_rows, 1), 0.0)
    return idx[first], n * (share + zero - 1)


def _packed_chi_square(df: DataFrame, features: str, label: str, labels: list, totals: list[int]) -> DataFrame:
    """``idx, chi2`` of the indices that occur. ``labels`` in order, ``totals`` their rows.

    A task keeps one table of cells and gives it out, cut by ranges of indices, when it has
    ``SPILLED_CELLS`` of them and at its end; so what is shuffled are packed tables, not
    entries. A range's tables meet in one task, one after the other.
    """
    known, counts, n = np.array(labels, float), np.array(totals, np.int64), float(sum(totals))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = Cells()
        for batch in batches:
            lengths = batch.column(1).value_lengths().fill_null(0).to_numpy().astype(np.int64)
            own = batch.column(0).to_numpy(zero_copy_only=False)
            code = np.where(np.isnan(own), len(known) - 1, np.searchsorted(known, own))
            idx = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            value = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            stored = value != 0
            code = np.repeat(code, lengths)[stored]
            cells.add(idx[stored], value[stored], code, np.ones(len(code), np.int64))
            if len(cells.packed[0]) > SPILLED_CELLS:
                yield from _by_range(cells.taken(), CELL_NAMES)
        yield from _by_range(cells.taken(), CELL_NAMES)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tables():
            for batch in batches:
                for i, r in enumerate(batch.column(0).to_pylist()):
                    yield r, tuple(batch.column(j)[i].values.to_numpy() for j in range(1, 5))

        for _, parts in groupby(tables(), key=lambda t: t[0]):
            cells = Cells()
            for _, part in parts:
                cells.add(*part)
            idx, chi2 = _statistic(cells.taken(), counts, n)
            columns = [pa.array(idx.astype(np.int32)), pa.array(chi2)]
            yield pa.RecordBatch.from_arrays(columns, names=["idx", "chi2"])

    vector = F.col(features)
    rows = df.filter(F.col(label).isNotNull() & vector["indices"].isNotNull()).select(
        F.col(label).cast("double").alias("label"),
        vector["indices"].alias("indices"),
        vector["values"].alias("values"),
    )
    tables = rows.mapInArrow(count, CELLS).repartition("range").sortWithinPartitions("range")
    return tables.mapInArrow(merge, "idx int, chi2 double")


def _joined_chi_square(df: DataFrame, features: str, label: str) -> DataFrame:
    """The same for any number of labels, which are joined with the cells."""
    spark = df.sparkSession
    # index -1 stands in every row: its cells are the label totals, its value the width
    vector = F.col(features)
    indices = F.concat(F.array(F.lit(-1)), vector["indices"])
    values = F.concat(F.array(vector["size"].cast("double")), vector["values"])
    cells = cut_lineage(
        df.filter(F.col(label).isNotNull())
        .select(F.col(label).cast("double"), F.inline(F.arrays_zip(indices, values)))
        .toDF("label", "idx", "value")
        .filter("value != 0")
        .groupBy("idx", "value", "label")
        .agg(F.count(F.lit(1)).alias("o"))
    )
    totals = (
        cells.filter("idx = -1")
        .groupBy("label")
        .agg(F.sum("o").alias("c"), F.max("value").cast("int").alias("size"))
    )
    n, last = totals.agg(F.sum("c").cast("double"), F.max("size")).head()
    n, last = n or 0.0, last or 0
    cells = lookup_join(cells.filter("idx >= 0"), totals.select("label", "c"), "label", "idx")
    by_value = cells.groupBy("idx", "value").agg(
        (F.sum(F.col("o") * F.col("o") / F.col("c")) / F.sum("o")).alias("part")
    )
    by_label = cells.groupBy("idx", "label", "c").agg(F.sum("o").alias("nz"))
    # one row per index: the non-zero values' share, non-zero rows, sum of nz^2/C over labels
    sq = F.col("nz") * F.col("nz") / F.col("c")
    sums = (
        by_value.select("idx", "part", F.lit(0).alias("nz"), F.lit(0.0).alias("sq"))
        .unionByName(by_label.select("idx", F.lit(0.0).alias("part"), "nz", sq.alias("sq")))
        .groupBy("idx")
        .agg(F.sum("part").alias("part"), F.sum("nz").alias("nz"), F.sum("sq").alias("sq"))
    )
    zero_rows = n - F.col("nz")
    zero_part = F.when(zero_rows > 0, (n - 2 * F.col("nz") + F.col("sq")) / zero_rows).otherwise(0.0)
    chi2 = n * (F.col("part") + zero_part - 1)
    all_indices = spark.range(last).select(F.col("id").cast("int").alias("idx"))
    return all_indices.join(sums, "idx", "left").select(
        "idx", F.coalesce(chi2, F.lit(0.0)).alias("chi2")
    )


def chi_square(
    df: DataFrame,
    features: str = "features",
    label: str = "label",
    shipped_labels: int = SHIPPED_LABELS,
) -> DataFrame:
    """``idx, chi2`` for every index of the vectors; values and labels count as categories.

    Only non-zero cells are counted; the row of zeros follows from the label totals. With n
    rows in all, O the count of a cell, R and C the totals of its value and label,
    chi2 = n (sum O^2/(R C) - 1). Rows without a label or vector take no part. Up to
    ``shipped_labels`` different labels are known to every task; beyond that, as for labels
    that are measurements, cells are counted by grouping and labels' totals joined.
    """
    vector = F.col(features)
    labelled = df.filter(F.col(label).isNotNull() & vector["indices"].isNotNull())
    by_label = cut_lineage(
        labelled.groupBy(F.col(label).cast("double").alias("label")).agg(
            F.count(F.lit(1)).alias("c"), F.max(vector["size"]).alias("size")
        )
    )
    if by_label.count() > shipped_labels:
        return _joined_chi_square(labelled, features, label)
    totals = sorted(by_label.collect(), key=lambda r: (math.isnan(r["label"]), r["label"]))
    width = max((r["size"] for r in totals), default=0)
    stats = _packed_chi_square(
        df, features, label, [r["label"] for r in totals], [r["c"] for r in totals]
    )
    all_indices = df.sparkSession.range(width).select(F.col("id").cast("int").alias("idx"))
    return all_indices.join(stats, "idx", "left").select(
        "idx", F.coalesce("chi2", F.lit(0.0)).alias("chi2")
    )


def chi_square_select(
    df: DataFrame,
    n: int,
    features: str = "features",
    label: str = "label",
    take_rows: int = TAKE_ORDERED_ROWS,
) -> DataFrame:
    """Keep the n indices of greatest statistic, renumbered in their original order.

    Ties go to the lower index (statistics are compared to nine decimals). Rows whose
    vector ends up empty stay, as empty vectors.
    """
    stats = cut_lineage(chi_square(df, features, label)).withColumn("chi2", F.round("chi2", 9))
    chosen = top_rows(stats, [("chi2", "desc"), ("idx", "asc")], n, take_rows)
    return keep_terms(df, chosen, features, remap=True, drop_empty=False)
