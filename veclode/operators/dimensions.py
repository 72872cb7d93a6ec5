"""Per-dimension statistics and selection of the dimensions that vary most."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import keep_dims

# Executors get these functions with the job; they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Coordinates taken together inside a task.
BLOCK = 1 << 21
# Partial moments are merged in this many tasks at most before they meet in one.
MERGERS = 32
MOMENTS = "n array<bigint>, base array<double>, rest array<double>, m2 array<double>"


class Moments:
    """Count, mean and sum of squared deviations of every dimension.

    Two sets of values are merged by their means' difference (Chan, Golub and LeVeque). A
    mean is kept as a first estimate and what has to be added to it, so nothing is lost
    where it is large beside the spread.
    """

    def __init__(self):
        self.n = np.zeros(0, np.int64)
        self.base, self.rest, self.m2 = np.zeros(0), np.zeros(0), np.zeros(0)

    @property
    def mean(self) -> np.ndarray:
        return self.base + self.rest

    def merge(self, n: np.ndarray, base: np.ndarray, rest: np.ndarray, m2: np.ndarray) -> None:
        width = max(len(n), len(self.n))
        pad = lambda x: np.pad(x, (0, width - len(x)))
        n, base, rest, m2 = map(pad, (n, base, rest, m2))
        n0, base0, rest0, m20 = map(pad, (self.n, self.base, self.rest, self.m2))
        self.n = n0 + n
        share = n / np.maximum(self.n, 1)
        apart = (base - base0) + (rest - rest0)
        first, both = n0 == 0, (n0 > 0) & (n > 0)
        self.base = np.where(first, base, base0)
        self.rest = np.where(first, rest, np.where(both, rest0 + apart * share, rest0))
        self.m2 = m20 + m2 + np.where(both, apart * apart * n0 * share, 0.0)

    def add(self, values: np.ndarray, known: np.ndarray) -> None:
        """Rows x dimensions; what is not known is left out."""
        n = known.sum(axis=0)
        base = np.where(known, values, 0.0).sum(axis=0) / np.maximum(n, 1)
        deviation = np.where(known, values - base, 0.0)
        rest = deviation.sum(axis=0) / np.maximum(n, 1)
        self.merge(n, base, rest, ((deviation - rest * known) ** 2).sum(axis=0))

    def batch(self) -> pa.RecordBatch:
        fields = {"n": self.n, "base": self.base, "rest": self.rest, "m2": self.m2}
        lists = [pa.array([x], pa.list_(pa.from_numpy_dtype(x.dtype))) for x in fields.values()]
        return pa.RecordBatch.from_arrays(lists, names=list(fields))


def _padded(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of rows x dimensions, and which values are there; shorter rows lack the rest."""
    lengths = vectors.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    flat = vectors.flatten()
    known = flat.is_valid().to_numpy(zero_copy_only=False)
    values = flat.to_numpy(zero_copy_only=False).astype(float)
    ends = np.cumsum(lengths)
    width = int(lengths.max(initial=0))
    if not width:
        return
    step = max(1, BLOCK // width)
    for start in range(0, len(lengths), step):
        own = lengths[start : start + step]
        first = ends[start] - lengths[start]
        part = slice(first, first + int(own.sum()))
        if (own == width).all():
            yield values[part].reshape(-1, width), known[part].reshape(-1, width)
            continue
        there = np.arange(width) < own[:, None]
        block, filled = np.zeros(there.shape), np.zeros(there.shape, bool)
        block[there], filled[there] = values[part], known[part]
        yield block, filled


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    moments = Moments()
    with np.errstate(invalid="ignore", over="ignore"):
        for batch in batches:
            for values, known in _padded(batch.column(0)):
                moments.add(values, known)
    yield moments.batch()


def _merged(batches: Iterator[pa.RecordBatch]) -> Moments:
    moments = Moments()
    with np.errstate(invalid="ignore", over="ignore"):
        for batch in batches:
            for parts in zip(*(c.to_pylist() for c in batch.columns)):
                moments.merge(*(np.array(p, k) for p, k in zip(parts, (np.int64, float, float, float))))
    return moments


def dim_stats(df: DataFrame, features: str = "features") -> DataFrame:
    """``dim, mean, var`` (population variance) of a dense vector column.

    Every task adds its rows up to one row of moments, so no coordinate becomes a row of its
    own and nothing but a row for each task is shuffled. Null vectors and values take no part;
    a vector that is shorter than others has no say in the dimensions it lacks. A dimension
    without values has neither mean nor variance.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _merged(batches).batch()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _merged(batches)
        none = m.n == 0
        columns = [
            pa.array(np.arange(len(m.n), dtype=np.int32)),
            pa.array(m.mean, mask=none),
            pa.array(m.m2 / np.maximum(m.n, 1), mask=none),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["dim", "mean", "var"])

    parts = df.select(F.col(features).cast("array<double>")).mapInArrow(_moments, MOMENTS)
    # few and small parts come together in one task; adaptive execution sees to that
    group = F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("group")
    fewer = parts.select("*", group).repartition("group").drop("group").mapInArrow(merge, MOMENTS)
    return fewer.repartition(1).mapInArrow(finish, "dim int, mean double, var double")


def top_variance_dims(stats: DataFrame, k: int) -> DataFrame:
    """The k dimensions of greatest variance; ties go to the lower dimension."""
    return stats.orderBy(F.desc("var"), "dim").limit(k)


@dataclass(frozen=True)
class TopVarianceModel:
    dims: list[int]
    features: str

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.features, keep_dims(F.col(self.features), self.dims))


@dataclass(frozen=True)
class TopVarianceSelector:
    """Choose the k dimensions on one set, keep them on any."""

    k: int
    features: str = "features"

    def fit(self, df: DataFrame) -> TopVarianceModel:
        chosen = top_variance_dims(dim_stats(df, self.features), self.k).select("dim").collect()
        return TopVarianceModel(sorted(r["dim"] for r in chosen), self.features)
