import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from veclode.functions.vectors import dense_to_sparse
from veclode.operators.lsh import LshParams, lsh_histogram, lsh_index, lsh_params, lsh_rows
from veclode.sources.lsh_files import read_lsh_params


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((120, 6)) * (rng.random((120, 6)) < 0.5)
    x[0] = 0.0
    x[1] = x[2]
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id bigint, features array<double>")
    return df.repartition(3).cache(), x


def buckets(df):
    return [r["buckets"] for r in df.orderBy("id").collect()]


def sparse(df):
    return df.withColumn("features", dense_to_sparse(F.col("features")))


def test_angle_buckets(points):
    df, x = points
    params = lsh_params("angle", 6, family_size=10, tables=3, chain=5, seed=1)
    assert np.allclose(np.linalg.norm(params.a, axis=2), 1)
    bits = np.einsum("nd,tcd->ntc", x, params.a) > 0
    expected = [[int("".join("01"[int(b)] for b in table), 2) for table in row] for row in bits]
    assert expected[0] == [0, 0, 0]
    assert buckets(lsh_index(df, params)) == expected
    assert buckets(lsh_index(sparse(df), params)) == expected
    assert buckets(lsh_index(sparse(df), params, shipped=0)) == expected
    assert expected[1] == expected[2]


def test_pstable_buckets(points):
    df, x = points
    params = lsh_params("pstable", 6, family_size=8, tables=2, chain=3, seed=2, w=2)
    assert set(params.b.ravel()) <= {0.0, 1.0}
    raw = (np.einsum("nd,tcd->ntc", x, params.a) + params.b) / params.w
    whole = [[":".join(str(math.floor(v)) for v in table) for table in row] for row in raw]
    for frame in (df, sparse(df)):
        assert buckets(lsh_index(frame, params)) == whole
        assert buckets(lsh_index(frame, params, rounding="trunc", chain="first")) == [
            [int(table[0]) for table in row] for row in raw
        ]
    assert buckets(lsh_index(sparse(df), params, shipped=0)) == whole
    assert buckets(lsh_index(df, params, chain="first")) == [
        [math.floor(table[0]) for table in row] for row in raw
    ]


def test_own_bucketing(points):
    df, x = points
    params = lsh_params("angle", 6, family_size=4, tables=2, chain=2, seed=1)
    got = lsh_index(df, params, bucketing=lambda dots, b, w: (dots > 0).sum(axis=2))
    expected = (np.einsum("nd,tcd->ntc", x, params.a) > 0).sum(axis=2)
    assert buckets(got) == expected.tolist()


def test_seed_fixes_the_family():
    def draw(seed, **more):
        return lsh_params("angle", 9, family_size=20, tables=4, chain=6, seed=seed, **more).a

    assert np.array_equal(draw(1), draw(1)) and not np.array_equal(draw(1), draw(2))
    assert draw(1, dist="uniform_sign").shape == (4, 6, 9)


def test_histogram_counts_every_vector_once_per_table(points):
    df, x = points
    indexed = lsh_index(df, lsh_params("angle", 6, 10, tables=3, chain=2, seed=1))
    rows = lsh_histogram(indexed).collect()
    for t in range(3):
        assert sum(r["n"] for r in rows if r["table_id"] == t) == len(x)
    assert lsh_rows(indexed).count() == 3 * len(x)


@pytest.mark.parametrize("partitions", ["1", "4", "64"])
def test_histogram_does_not_depend_on_partitions(spark, points, partitions):
    df, _ = points
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        params = lsh_params("pstable", 6, 10, tables=2, chain=2, seed=1)
        rows = lsh_histogram(lsh_index(df.repartition(int(partitions)), params)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    reference = lsh_histogram(lsh_index(df, params)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, reference))


def test_refusals(points):
    df, _ = points
    params = lsh_params("pstable", 6, 4, tables=1, chain=1, seed=1)
    with pytest.raises(ValueError, match="unknown family"):
        lsh_params("cosine", 6, 4, tables=1, chain=1, seed=1)
    with pytest.raises(ValueError, match="63 bits"):
        lsh_params("angle", 6, 4, tables=1, chain=64, seed=1)
    with pytest.raises(ValueError, match="rounding"):
        lsh_index(df, params, rounding="up")
    with pytest.raises(Exception, match="dimensions"):
        lsh_index(df.select("id", F.array(F.lit(1.0)).alias("features")), params).collect()


def test_params_from_file(spark, write):
    text = "(0,3,[0,1,2],[0.1,-1.2,0.7]);2;4\n(1,3,[2],[1.0]);0;4\n(2,3,[],[]);1;4\n(3,3,[0,2],[1.0,2.0]);3;4\n"
    params = read_lsh_params(spark, write("pstable", text), "pstable", chain=2)
    assert params.a.tolist() == [[[0.1, -1.2, 0.7], [0, 0, 1.0]], [[0, 0, 0], [1.0, 0, 2.0]]]
    assert params.b.tolist() == [[2, 0], [1, 3]] and params.w.tolist() == [[4, 4], [4, 4]]
    angle = read_lsh_params(spark, write("angle", "(0,3,[0,1,2],[0.6,0.0,0.8])\n"), "angle", chain=1)
    assert isinstance(angle, LshParams) and angle.a.tolist() == [[[0.6, 0.0, 0.8]]]


@pytest.mark.parametrize(
    "family, chain, text",
    [
        ("pstable", 2, "(0,2,[0],[1.0]);1;1\n"),
        ("pstable", 1, "(0,2,[0],[1.0])\n"),
        ("angle", 1, "nonsense\n"),
        ("angle", 1, "(0,2,[0],[1.0])\n(1,3,[0],[1.0])\n"),
        ("angle", 1, ""),
        ("cosine", 1, "(0,2,[0],[1.0])\n"),
    ],
)
def test_bad_params_file(spark, write, family, chain, text):
    with pytest.raises(ValueError):
        read_lsh_params(spark, write("params", text), family, chain)
