"""Locality-sensitive hashing by random projections.

A family offers ``family_size`` projections. Each of ``tables`` hash tables chains
``chain`` of them, drawn with replacement. A vector's bucket in a table comes from its
dot products with the chained projections:

* ``angle``: one sign bit per projection, the first one highest;
* ``pstable``: ``floor((dot + b) / w)`` per projection.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from ..functions import vectors as V
from ..functions.batches import row_pieces
from ..session import cut_lineage
from .lookup import lookup_join

# Executors get these functions with the job; they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Up to this many coefficients (128 MB) the projections are shipped to every executor.
SHIPPED_COEFFICIENTS = 1 << 24
# Entries multiplied at once inside a task.
BLOCK = 1 << 21
# Odd multiplier that folds a chain's numbers to 64 bits.
FOLD = 6364136223846793005

Bucketing = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


Draw = Callable[[np.random.Generator, int, int], tuple[np.ndarray, np.ndarray]]


@dataclass(frozen=True)
class Family:
    """A hash family of one's own, to be given wherever a family's name may stand.

    ``draw`` takes a generator, the family's size and the dimension, and gives the
    members (size x dim) and their offsets. ``bucketing`` takes dot products (rows x
    tables x chain), ``b`` and ``w`` (tables x chain) and gives rows x tables whole
    numbers. ``offsets``: lines of a hash-function file hold ``vector;b;w``.
    """

    name: str
    draw: Draw
    bucketing: Bucketing
    offsets: bool = False


@dataclass(frozen=True)
class LshParams:
    """``members``: projections x dim; ``drawn``, ``b``, ``w``: tables x chain.

    ``drawn`` tells which member stands at each place of a chain, so one drawn several
    times is kept and multiplied once. Without it ``members`` is tables x chain x dim.
    """

    family: str | Family
    members: np.ndarray
    b: np.ndarray
    w: np.ndarray
    drawn: np.ndarray | None = None

    def __post_init__(self):
        if self.drawn is None:
            tables, chain, dim = self.members.shape
            places = np.arange(tables * chain).reshape(tables, chain)
            object.__setattr__(self, "members", self.members.reshape(-1, dim))
            object.__setattr__(self, "drawn", places)

    @property
    def a(self) -> np.ndarray:
        """Tables x chain x dim coefficients."""
        return self.members[self.drawn]

    @property
    def tables(self) -> int:
        return self.drawn.shape[0]

    @property
    def chain(self) -> int:
        return self.drawn.shape[1]

    @property
    def dim(self) -> int:
        return self.members.shape[1]

    def used(self, chain: int) -> LshParams:
        """The first ``chain`` places of every table, with the members that stand there."""
        kept, drawn = np.unique(self.drawn[:, :chain], return_inverse=True)
        return LshParams(
            self.family,
            self.members[kept],
            self.b[:, :chain],
            self.w[:, :chain],
            drawn.reshape(self.tables, chain),
        )


def lsh_params(
    family: str | Family,
    dim: int,
    family_size: int,
    tables: int,
    chain: int,
    seed: int,
    w: int = 1,
    mu: float = 0.0,
    sigma: float = 1.0,
    dist: str = "gaussian",
) -> LshParams:
    """Draw a family and chain its members into tables.

    Angle projections have length 1; ``dist="uniform_sign"`` draws each coordinate
    uniformly with a random sign instead of from a normal distribution. P-stable
    offsets are whole numbers in ``[0, w)``. A :class:`Family` draws its own members.
    """
    rng = np.random.default_rng(seed)
    if isinstance(family, Family):
        members, offsets = family.draw(rng, family_size, dim)
        if np.shape(members) != (family_size, dim) or np.shape(offsets) != (family_size,):
            raise ValueError("draw must give size x dim members and an offset for each")
    elif family == "angle":
        _check_angle_chain(chain)
        if dist == "gaussian":
            members = rng.standard_normal((family_size, dim))
        elif dist == "uniform_sign":
            members = rng.random((family_size, dim)) * rng.choice((-1.0, 1.0), (family_size, dim))
        else:
            raise ValueError(f"unknown dist {dist!r}")
        members /= np.linalg.norm(members, axis=1, keepdims=True)
        offsets = np.zeros(family_size)
    elif family == "pstable":
        members = rng.normal(mu, sigma, (family_size, dim))
        offsets = rng.integers(0, w, family_size).astype(float)
    else:
        raise ValueError(f"unknown family {family!r}")
    drawn = rng.integers(0, family_size, (tables, chain))
    return LshParams(family, members, offsets[drawn], np.full((tables, chain), float(w)), drawn)


GOLDEN = 0x9E3779B97F4A7C15
MIXERS = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit number's hash (the finalizer of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIXERS[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIXERS[1])
    return x ^ (x >> np.uint64(31))


@dataclass(frozen=True)
class GeneratedParams:
    """A family whose coefficients are computed where they are needed.

    The coefficient of a member at an index is drawn by a hash of (seed, member, index), so
    vectors may be as wide as they like: nothing is stored, shipped or joined. ``drawn``,
    ``b``, ``w`` (tables x chain) are those of :class:`LshParams`.
    """

    family: str
    dim: int
    seed: int
    drawn: np.ndarray
    b: np.ndarray
    w: np.ndarray
    mu: float = 0.0
    sigma: float = 1.0
    dist: str = "gaussian"

    @property
    def tables(self) -> int:
        return self.drawn.shape[0]

    @property
    def chain(self) -> int:
        return self.drawn.shape[1]

    @property
    def used_members(self) -> np.ndarray:
        return np.unique(self.drawn)

    def used(self, chain: int) -> GeneratedParams:
        """The first ``chain`` places of every table."""
        first = slice(None), slice(chain)
        return replace(self, drawn=self.drawn[first], b=self.b[first], w=self.w[first])

    def coefficients(self, indices: np.ndarray) -> np.ndarray:
        """Indices x used members."""
        with np.errstate(over="ignore"):
            keys = _mixed(np.uint64(self.seed) + (self.used_members.astype(np.uint64) + np.uint64(1)) * np.uint64(GOLDEN))
            bits = _mixed(keys[None, :] + (indices.astype(np.uint64)[:, None] + np.uint64(1)) * np.uint64(GOLDEN))
        # two uniform numbers strictly between 0 and 1
        first = ((bits >> np.uint64(32)).astype(float) + 0.5) / 2**32
        second = ((bits & np.uint64(0xFFFFFFFF)).astype(float) + 0.5) / 2**32
        if self.dist == "uniform_sign":
            return np.where(second < 0.5, -first, first)
        return self.mu + self.sigma * np.sqrt(-2 * np.log(first)) * np.cos(2 * np.pi * second)


def generated_params(
    family: str,
    dim: int,
    family_size: int,
    tables: int,
    chain: int,
    seed: int,
    w: int = 1,
    mu: float = 0.0,
    sigma: float = 1.0,
    dist: str = "gaussian",
) -> GeneratedParams:
    """:func:`lsh_params` for vectors of any width: only the chains and offsets are drawn here.

    Angle projections are not scaled to length 1, which changes no sign.
    """
    if family not in ("angle", "pstable"):
        raise ValueError(f"unknown family {family!r}")
    if dist not in ("gaussian", "uniform_sign"):
        raise ValueError(f"unknown dist {dist!r}")
    if family == "angle":
        _check_angle_chain(chain)
    rng = np.random.default_rng(seed)
    offsets = rng.integers(0, w, family_size).astype(float) if family == "pstable" else np.zeros(family_size)
    drawn = rng.integers(0, family_size, (tables, chain))
    return GeneratedParams(
        family, dim, seed, drawn, offsets[drawn], np.full((tables, chain), float(w)), mu, sigma, dist
    )


def _check_angle_chain(chain: int) -> None:
    if chain > 63:
        raise ValueError("an angle bucket holds at most 63 bits")


def _angle(dots: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Rows x tables: the sign bits of a chain as one number. A dot product of 0 gives 0."""
    chain = dots.shape[2]
    weights = np.left_shift(np.int64(1), np.arange(chain - 1, -1, -1, dtype=np.int64))
    return (~(dots <= 0)).astype(np.int64) @ weights


def _floor(dots: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.floor((dots + b) / w).astype(np.int64)


def _truncate(dots: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.trunc((dots + b) / w).astype(np.int64)


def _folded(numbers: Bucketing) -> Bucketing:
    """A chain's numbers as one: ``h * FOLD + number`` from 0, wrapping at 64 bits."""

    def fold(dots: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
        folded = np.zeros(dots.shape[:2], dtype=np.int64)
        for place in np.moveaxis(numbers(dots, b, w), 2, 0):
            folded = folded * np.int64(FOLD) + place
        return folded

    return fold


def _dense_dots(flat: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    return flat.reshape(-1, matrix.shape[0]) @ matrix


def _sparse_dots(
    indices: np.ndarray,
    values: np.ndarray,
    lengths: np.ndarray,
    coefficients: Callable[[np.ndarray], np.ndarray],
    members: int,
) -> np.ndarray:
    """Row-wise sums of the indices' coefficients (indices x members), a block at a time."""
    dots = np.zeros((len(lengths), members))
    ends = np.cumsum(lengths)
    row, step = 0, max(1, BLOCK // members)
    while row < len(lengths):
        start = ends[row] - lengths[row]
        stop_row = max(row + 1, int(np.searchsorted(ends, start + step, side="right")))
        stop = ends[stop_row - 1]
        filled = np.flatnonzero(lengths[row:stop_row])
        if len(filled):
            products = coefficients(indices[start:stop]) * values[start:stop, None]
            starts = ends[row:stop_row][filled] - lengths[row:stop_row][filled] - start
            dots[row + filled] = np.add.reduceat(products, starts, axis=0)
        row = stop_row
    return dots


def _list_array(values: pa.Array, width: int, rows: int) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), values)


def _distinct_first(coefficients: Callable[[np.ndarray], np.ndarray]):
    """Compute the coefficients of an index once for all its places in a block."""

    def found(indices: np.ndarray) -> np.ndarray:
        distinct, place = np.unique(indices, return_inverse=True)
        return coefficients(distinct)[place]

    return found


def _bucket_column(
    params: LshParams | GeneratedParams, vector: Column, dense: bool, bucketing: Bucketing, depth: int
):
    """Arrow function: vector -> buckets. ``depth`` 1 gives one per table, 2 one per projection.

    Marked nondeterministic so the optimizer neither copies it into filters nor runs it twice.
    """
    tables, chain, dim = params.tables, params.chain, params.dim
    b, w, drawn = params.b, params.w, params.drawn
    if isinstance(params, GeneratedParams):
        # members stand by their place among those used
        members, matrix = len(params.used_members), None
        drawn = np.searchsorted(params.used_members, drawn)
        coefficients = _distinct_first(params.coefficients)
    else:
        members, matrix = len(params.members), np.ascontiguousarray(params.members.T)
        coefficients = lambda indices: matrix[indices]

    kind = ArrayType(LongType()) if depth == 1 else ArrayType(ArrayType(LongType()))

    def from_dots(dots: np.ndarray) -> pa.Array:
        rows = len(dots)
        buckets = bucketing(dots[:, drawn], b, w)
        flat = pa.array(np.ascontiguousarray(buckets, dtype=np.int64).ravel())
        if depth == 1:
            return _list_array(flat, tables, rows)
        return _list_array(_list_array(flat, chain, rows * tables), tables, rows)

    if dense:

        @F.arrow_udf(kind)
        def hash_dense(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for batch in batches:
                flat = batch.flatten().to_numpy(zero_copy_only=False)
                if len(flat) != len(batch) * dim:
                    raise ValueError(f"every vector must have {dim} dimensions")
                if matrix is not None:
                    yield from_dots(_dense_dots(flat, matrix))
                    continue
                indices, lengths = np.tile(np.arange(dim), len(batch)), np.full(len(batch), dim)
                yield from_dots(_sparse_dots(indices, flat, lengths, coefficients, members))

        filled = F.coalesce(vector, F.array_repeat(F.lit(0.0), dim))
        return F.when(vector.isNotNull(), hash_dense.asNondeterministic()(filled))

    @F.arrow_udf(kind)
    def hash_sparse(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            for rows in row_pieces(batch[1].value_lengths()):
                sizes, indices, values = (column[rows] for column in batch)
                if set(sizes.unique().to_pylist()) - {dim, None}:
                    raise ValueError(f"every vector must have {dim} dimensions")
                lengths = indices.value_lengths().fill_null(0).to_numpy().astype(np.int64)
                dots = _sparse_dots(
                    indices.flatten().to_numpy(zero_copy_only=False),
                    values.flatten().to_numpy(zero_copy_only=False),
                    lengths,
                    coefficients,
                    members,
                )
                yield from_dots(dots)

    buckets = hash_sparse.asNondeterministic()(vector["size"], vector["indices"], vector["values"])
    return F.when(vector.isNotNull(), buckets)


def _joined_dots(df: DataFrame, params: LshParams, features: str, dense: bool) -> DataFrame:
    """Dot products when the projections are too many to ship: join entries with coefficients."""
    spark = df.sparkSession
    vector = F.col(features)
    size = F.size(vector) if dense else vector["size"]
    message = F.lit(f"every vector must have {params.dim} dimensions")
    fits = F.when(vector.isNull() | (size == params.dim), vector).otherwise(F.raise_error(message))
    # rows are told apart by a number of their own, fixed by a written table
    df = cut_lineage(
        df.withColumn(features, fits).withColumn("_row", F.monotonically_increasing_id())
    )
    inlined = F.posexplode(vector) if dense else V.inline_entries(vector)
    flat = params.members.T
    coefficients = spark.createDataFrame(
        pa.table({"idx": np.arange(params.dim, dtype=np.int32), "a": list(flat)})
    )
    entries = df.select("_row", inlined).toDF("_row", "idx", "value")
    products = lookup_join(entries, coefficients, "idx", "_row", broadcast_bytes=0)
    sums = [F.sum(F.col("value") * F.col("a")[f]).alias(f"d{f}") for f in range(flat.shape[1])]
    dots = products.groupBy("_row").agg(F.array(*sums).alias("_dots"))
    zero = F.array_repeat(F.lit(0.0), flat.shape[1])
    found = F.when(vector.isNotNull(), F.coalesce("_dots", zero))
    return df.join(dots, "_row", "left").withColumn("_dots", found).drop("_row")


def lsh_index(
    df: DataFrame,
    params: LshParams | GeneratedParams,
    features: str = "features",
    rounding: str = "floor",
    chain: str = "all",
    bucketing: Bucketing | None = None,
    out: str = "buckets",
    shipped: int = SHIPPED_COEFFICIENTS,
) -> DataFrame:
    """Add ``buckets``: the vector's bucket in every table, in table order.

    ``features`` is dense (``array<double>``) or sparse. Angle buckets are bigints. A
    p-stable bucket joins the whole chain's numbers by ``:``; with ``chain="first"`` it
    is the first projection's number alone, with ``chain="folded"`` the whole chain's
    numbers folded to 64 bits, both bigints. ``rounding`` is ``floor`` or
    ``trunc`` (toward zero). ``bucketing`` replaces the family's own rule: from dot
    products (rows x tables x chain), ``b`` and ``w`` to rows x tables numbers. A null
    vector has null buckets; a vector of another size ends the job. With
    :class:`GeneratedParams` coefficients are computed in the tasks; nothing is shuffled.
    """
    if rounding not in ("floor", "trunc") or chain not in ("all", "first", "folded"):
        raise ValueError("rounding is floor or trunc, chain is all, first or folded")
    dense = isinstance(df.schema[features].dataType, ArrayType)
    whole_chain = False
    if bucketing is None and isinstance(params.family, Family):
        bucketing = params.family.bucketing
    if bucketing is None:
        if params.family == "angle":
            _check_angle_chain(params.chain)
            bucketing = _angle
        else:
            bucketing = _floor if rounding == "floor" else _truncate
            whole_chain = chain == "all"
            if chain == "folded":
                bucketing = _folded(bucketing)
            if chain == "first":
                params = params.used(1)
                each = bucketing

                def bucketing(dots, b, w):
                    return each(dots, b, w)[:, :, 0]

    depth = 2 if whole_chain else 1
    if isinstance(params, GeneratedParams) or params.members.size <= shipped:
        hashed = df.withColumn(
            out, _bucket_column(params, F.col(features), dense, bucketing, depth)
        )
    else:
        identity = LshParams(
            params.family, np.eye(len(params.members)), params.b, params.w, params.drawn
        )
        hashed = _joined_dots(df, params, features, dense)
        hashed = hashed.withColumn(
            out, _bucket_column(identity, F.col("_dots"), True, bucketing, depth)
        ).drop("_dots")
    if not whole_chain:
        return hashed
    joined = F.transform(out, lambda t: F.array_join(t.cast("array<string>"), ":"))
    return hashed.withColumn(out, joined)


def lsh_rows(df: DataFrame, key: str = "id", buckets: str = "buckets") -> DataFrame:
    """One row ``key, table_id, bucket`` per vector and table."""
    return df.select(key, F.posexplode_outer(buckets).alias("table_id", "bucket"))


def lsh_histogram(df: DataFrame, buckets: str = "buckets") -> DataFrame:
    """``table_id, bucket, n`` for the non-empty buckets.

    Counts are combined before the shuffle, so a crowded bucket costs one row per task.
    """
    return (
        df.select(F.posexplode_outer(buckets).alias("table_id", "bucket"))
        .groupBy("table_id", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )
