"""Centroid clustering with an incremental distance matrix.

Squared distance to a centroid is |x|^2 - 2 x.c + |c|^2. The products x.c of every vector with
every centroid are stored beside the vector as exact integers. When centroids move, a product
changes by x.(c' - c), so each task goes over the components in which a centroid really
changed and adds their part; products with a centroid that stayed cost nothing. The nearest
centroid is then read off the products. Between rounds only one row of sums for each cluster
and task leaves the tasks, and what the driver holds is the centroids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veclode.llm.common import column, fresh_name, stored
from veclode.session import release

# Vectors whose products are updated at once inside a task.
ROWS = 4096
# Components this large keep every distance and product of up to 64 components below 2^63.
LARGEST = 1 << 27


def whole_components(vector: Column, dim: int, scale: float) -> Column:
    """``floor(scale * x)`` of every component; null unless there are ``dim`` finite ones."""
    sound = (F.size(vector) == dim) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    scaled = F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("bigint"))
    return F.when(sound, scaled)


def first_centroids(vectors: DataFrame, k: int, seed: int, key: str, x: str) -> np.ndarray:
    """The ``k`` vectors of least ``sha256("seed:key")``, in that order; k x dim.

    A null key counts as empty text; vectors of equal keys go by their components.
    """
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(column(vectors, key).cast("string"), F.lit("")))
    digest = F.sha2(named.cast("binary"), 256)
    least = vectors.select(digest.alias("digest"), F.col(x).alias("x")).orderBy("digest", "x").limit(k)
    return np.array([r["x"] for r in least.collect()], np.int64)


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Equally long lists as a width x rows matrix, one run of memory for each component."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(-1, width).T)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    width, rows = matrix.shape
    return pa.ListArray.from_arrays(
        pa.array(np.arange(rows + 1, dtype=np.int32) * width), pa.array(matrix.T.ravel())
    )


def updated(products: np.ndarray, x: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Products (k x rows) after centroids changed by ``change`` (k x dim); x is dim x rows."""
    for centroid, moved in enumerate(change):
        components = np.flatnonzero(moved)
        if len(components):
            products[centroid] += moved[components] @ x[components]
    return products


def nearest(products: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (the smaller at ties) and |c|^2 - 2 x.c there."""
    parts = (centroids * centroids).sum(axis=1)[:, None] - 2 * products
    cluster = parts.argmin(axis=0)
    return cluster, parts[cluster, np.arange(parts.shape[1])]


def _round(table: DataFrame, x: str, state: str, change: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """The table with its products brought up to ``centroids``, and the clusters that follow."""
    k, dim = centroids.shape
    names = table.columns
    at, state_at = names.index(x), names.index(state)

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS):
                batch = whole.slice(start, ROWS)
                vectors = _matrix(batch.column(at), dim)
                before = batch.column(state_at)
                products = _matrix(before.field("products"), k) if before.null_count == 0 else None
                if products is None:
                    if vectors.max() >= LARGEST or vectors.min() <= -LARGEST:
                        raise ValueError(f"components must be below {LARGEST} in size")
                    products = np.zeros((k, batch.num_rows), np.int64)
                products = updated(products, vectors, change)
                cluster, part = nearest(products, centroids)
                now = pa.StructArray.from_arrays(
                    [
                        _lists(products),
                        pa.array(cluster.astype(np.int32)),
                        pa.array((vectors * vectors).sum(axis=0) + part),
                    ],
                    names=["products", "cluster", "distance"],
                )
                columns = [now if i == state_at else c for i, c in enumerate(batch.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return table.mapInArrow(update, table.schema)


def _sums(table: DataFrame, x: str, state: str, k: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of vectors and sum of components of every cluster, added up in the tasks first."""
    slim = table.select(F.col(state)["cluster"].alias("cluster"), F.col(x).alias("x"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            cluster = batch.column(0).to_numpy(zero_copy_only=False)
            vectors = _matrix(batch.column(1), dim)
            for c in np.unique(cluster):
                sums[c] += vectors[:, cluster == c].sum(axis=1)
            counts += np.bincount(cluster, minlength=k)
        own = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(own), pa.array(counts[own]), _lists(np.ascontiguousarray(sums[own].T))],
            names=["cluster", "n", "x"],
        )

    parts = slim.mapInArrow(add, "cluster bigint, n bigint, x array<bigint>")
    totals = parts.groupBy("cluster").agg(
        F.sum("n").alias("n"), *(F.sum(F.col("x")[i]).alias(f"x{i}") for i in range(dim))
    )
    counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
    for row in totals.collect():  # k rows
        counts[row["cluster"]], sums[row["cluster"]] = row["n"], row[2:]
    return counts, sums


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster_vectors(
    df: DataFrame,
    k: int = 40,
    rounds: int = 5,
    dim: int = 64,
    scale: float = 256.0,
    seed: int = 2,
    key: str = "vec_id",
    vector: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """Every kept vector's ``key, cluster, distance``, and the final centroids (k x dim).

    Components become ``floor(scale * x)``, and all that follows is exact whole-number
    arithmetic. Vectors that are null, of another length, or hold a null or non-finite
    component are left out. A row is a vector: repeated rows and keys count one by one, and a
    null key is kept. With fewer than ``k`` vectors there are as many centroids; of two
    equal ones the later keeps an empty cluster, where it stays. An empty table gives an
    empty table. Components of 2^27 or more in size end the job, for their distances need not
    fit a 64-bit number.

    Each round reads the table of vectors and products, writes the next and removes the one
    before, so a lost executor repeats one round's tasks and two tables exist at most.
    """
    x, state = "x", "state"
    whole = whole_components(column(df, vector), dim, scale)
    kept = df.select(column(df, key).alias("key"), whole.alias(x)).where(f"{x} IS NOT NULL")
    centroids = first_centroids(kept, k, seed, "key", x).reshape(-1, dim)
    kind = T.StructType(
        [
            T.StructField("products", T.ArrayType(T.LongType())),
            T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType()),
        ]
    )
    table = kept.withColumn(state, F.lit(None).cast(kind))
    if not len(centroids):
        found = table.select(F.col("key").alias(key), f"{state}.cluster", f"{state}.distance")
        return found, centroids
    change = centroids
    for step in range(rounds + 1):
        before, table = table, stored(_round(table, x, state, change, centroids))
        if step:
            release(before)
        if step < rounds:
            counts, sums = _sums(table, x, state, len(centroids), dim)
            means = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], centroids)
            change, centroids = means - centroids, means
    return table.select(F.col("key").alias(key), f"{state}.cluster", f"{state}.distance"), centroids


def with_inertia(clustered: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` to the clusters' rows."""
    own = clustered.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    sums = {r["cluster"]: r["cluster_inertia"] for r in own.collect()}  # k rows
    total = sum(sums.values())
    rows = [(c, s, total, centroid_digest(centroids[c])) for c, s in sums.items()]
    place = fresh_name(clustered, "cluster_")
    table = clustered.sparkSession.createDataFrame(
        rows, f"{place} int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    )
    joined = clustered.join(F.broadcast(table), F.col("cluster") == F.col(place))
    return joined.drop(place)
