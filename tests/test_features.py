import random
import statistics
from itertools import product
from math import prod

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from veclode.functions import labels as L
from veclode.functions.vectors import dense_to_sparse, sparse_to_dense
from veclode.operators.chisq import chi_square, chi_square_select
from veclode.operators.dimensions import TopVarianceSelector, dim_stats, top_variance_dims
from veclode.operators.polynomial import expanded_size, polynomial


def test_labels(spark):
    df = spark.createDataFrame([(2007.0, "TRUE", "?"), (2008.0, "false", "0.5")], "y double, t string, v string")
    rows = df.select(
        L.binarize(F.col("y"), 2007, above=0).alias("old"),
        L.binarize(F.col("y"), 2007).alias("new"),
        L.positive_or_zero(F.col("y") - 2007.5).alias("pos"),
        L.is_token(F.col("t")).alias("truth"),
        L.number_or(F.col("v")).alias("number"),
    ).collect()
    assert [tuple(r) for r in rows] == [(1, 0, 0.0, 1.0, 0.0), (0, 1, 0.5, 0.0, 0.5)]


def test_dimension_statistics_and_ties(spark):
    rows = [[1.0, 5.0, 0.0, 2.0], [3.0, 5.0, 0.0, 4.0], [5.0, 8.0, 0.0, 6.0]]
    df = spark.createDataFrame([(r,) for r in rows], "features array<double>")
    stats = {r["dim"]: r for r in dim_stats(df).collect()}
    for d, column in enumerate(zip(*rows)):
        assert stats[d]["mean"] == pytest.approx(statistics.fmean(column))
        assert stats[d]["var"] == pytest.approx(statistics.pvariance(column))
    assert [r["dim"] for r in top_variance_dims(dim_stats(df), 3).collect()] == [0, 3, 1]
    model = TopVarianceSelector(2).fit(df)
    assert model.dims == [0, 3]
    other = spark.createDataFrame([([9.0, 8.0, 7.0, 6.0],)], "features array<double>")
    assert model.transform(other).head()["features"] == [9.0, 6.0]


def monomials(x, degree):
    """Values in the order where the last variable's power varies slowest."""
    powers = [p[::-1] for p in product(range(degree + 1), repeat=len(x)) if 0 < sum(p) <= degree]
    return [prod(v**e for v, e in zip(x, p)) for p in powers]


@pytest.mark.parametrize("x, degree", [([2.0, 3.0], 3), ([2.0, 0.0, 5.0], 3), ([1.0, -1.0, 0.5, 2.0], 2)])
def test_polynomial_order(spark, x, degree):
    df = spark.createDataFrame([(1.0, x)], "label double, features array<double>")
    df = df.withColumn("features", dense_to_sparse(F.col("features")))
    got = polynomial(df, degree).select("label", sparse_to_dense(F.col("features")).alias("x")).head()
    assert got["label"] == 1.0
    assert got["x"] == pytest.approx(monomials(x, degree))
    assert len(got["x"]) == expanded_size(len(x), degree)


def test_expanded_size():
    assert expanded_size(11, 3) == 363


@pytest.fixture(scope="module")
def categories(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        label = float(rng.choice([-1, -1, -1, 1, 2]))
        rows.append(
            (i, label, [float(rng.randrange(3)), float(label > 0), 0.0, 4.0, label * rng.randrange(2), rng.random() // 0.3])
        )
    df = spark.createDataFrame(rows, "id bigint, label double, dense array<double>")
    return df.withColumn("features", dense_to_sparse(F.col("dense"))).repartition(3).cache()


def test_chi_square_against_the_ml_test(categories):
    ml = ChiSquareTest.test(
        categories.select("label", array_to_vector("dense").alias("v")), "v", "label", flatten=True
    )
    expected = {r["featureIndex"]: r["statistic"] for r in ml.collect()}
    got = {r["idx"]: r["chi2"] for r in chi_square(categories).collect()}
    assert got == pytest.approx(expected, abs=1e-9)


@pytest.mark.parametrize("n, chosen", [(1, [1]), (2, [1, 4]), (5, [0, 1, 2, 4, 5]), (6, [0, 1, 2, 3, 4, 5])])
def test_chi_square_select(categories, n, chosen):
    got = chi_square_select(categories, n)
    for r in got.select("dense", "label", sparse_to_dense(F.col("features")).alias("x")).collect():
        assert r["x"] == [r["dense"][d] for d in chosen]
