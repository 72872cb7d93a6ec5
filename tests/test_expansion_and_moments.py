import random
from fractions import Fraction
from math import comb

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml.feature import PolynomialExpansion
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from veclode.functions.vectors import dense_to_sparse
from veclode.operators import dimensions, polynomial


def sparse_frame(spark, rows):
    df = spark.createDataFrame(list(enumerate(rows)), "id int, features array<double>")
    return df.withColumn("features", dense_to_sparse(F.col("features")))


@pytest.mark.parametrize("degree", [1, 2, 3, 5])
def test_polynomial_equals_the_ml_library(spark, degree, monkeypatch):
    rng = random.Random(degree)
    rows = [[rng.choice([0.0, 1.5, -2.0, 0.25, 3.0]) for _ in range(6)] for _ in range(40)] + [[0.0] * 6]
    own = polynomial.polynomial(sparse_frame(spark, rows), degree).orderBy("id").collect()
    df = spark.createDataFrame([(i, Vectors.dense(r)) for i, r in enumerate(rows)], ["id", "x"])
    ml = PolynomialExpansion(degree=degree, inputCol="x", outputCol="y").transform(df).orderBy("id")
    for mine, theirs in zip(own, ml.collect(), strict=True):
        v = mine["features"]
        dense = np.zeros(v["size"])
        dense[v["indices"]] = v["values"]
        assert v["indices"] == sorted(v["indices"]) and v["size"] == comb(6 + degree, degree) - 1
        assert np.allclose(dense, theirs["y"].toArray(), rtol=1e-12)


def test_wide_and_odd_vectors(spark):
    schema = "features struct<size:int,indices:array<int>,values:array<double>>"
    rows = [((1000, [7, 999], [2.0, 3.0]),), (None,), ((1000, [], []),), ((1000, [5, 8], [0.0, 4.0]),)]
    df = spark.createDataFrame(rows, schema).coalesce(1)
    found = [r["features"] for r in polynomial.polynomial(df, 2).collect()]
    assert found[1] is None and found[2]["indices"] == [] and found[3]["values"] == [4.0, 16.0]
    number = lambda *v: sum(comb(x + 2 - j, 2 - j) for j, x in enumerate(v)) - 1
    assert dict(zip(found[0]["indices"], found[0]["values"])) == {
        number(7): 2.0, number(7, 7): 4.0, number(999): 3.0, number(999, 7): 6.0, number(999, 999): 9.0
    }
    assert found[0]["size"] == comb(1002, 2) - 1 and max(found[0]["indices"]) == found[0]["size"] - 1
    huge = spark.createDataFrame([((1 << 20, [1], [1.0]),)], schema)
    with pytest.raises(PySparkException, match="too many"):
        polynomial.polynomial(huge, 3).collect()


def test_parts_of_a_batch(spark):
    df = sparse_frame(spark, [[1.0, 2.0, 0.0, 3.0]] * 300 + [[0.0, 2.0, 0.0, 0.0]] * 5)
    whole = polynomial.polynomial(df, 3).orderBy("id").collect()
    batch = df.coalesce(1).orderBy("id").select("features").toArrow().column(0).combine_chunks()
    fields = [batch.field(name) for name in ("size", "indices", "values")]
    old, polynomial.TERMS = polynomial.TERMS, 50
    try:
        parts = list(polynomial._expand_batch(*fields, 3))
    finally:
        polynomial.TERMS = old
    assert len(parts) > 50
    assert [x for p in parts for x in p.to_pylist()] == [r["features"].asDict() for r in whole]


def stats(spark, rows, partitions=3):
    df = spark.createDataFrame([(r,) for r in rows], "features array<double>").repartition(partitions)
    return {r["dim"]: (r["mean"], r["var"]) for r in dimensions.dim_stats(df).collect()}


def test_moments_far_from_zero(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (400, 3)) * [1e-3, 1, 50] + [1e9, -1e9, 0]
    found = stats(spark, x.tolist())
    for d in range(3):
        values = [Fraction(v) for v in x[:, d].tolist()]
        mean = sum(values) / len(values)
        exact = float(sum((v - mean) ** 2 for v in values) / len(values))
        assert found[d][0] == pytest.approx(float(mean), rel=1e-14)
        # a mean of 1e9 is known to 1e-7, which a spread of 1e-3 just notices
        assert found[d][1] == pytest.approx(exact, rel=1e-5 if d == 0 else 1e-12)


def test_moments_of_odd_rows(spark):
    found = stats(spark, [[1.0, None, 3.0], None, [2.0], [], [3.0, 5.0], [None, None, None, None]])
    assert found == {0: (2.0, pytest.approx(2 / 3)), 1: (5.0, 0.0), 2: (3.0, 0.0), 3: (None, None)}
    nan = stats(spark, [[float("nan"), 1.0], [2.0, 1.0]])
    assert np.isnan(nan[0][0]) and np.isnan(nan[0][1]) and nan[1] == (1.0, 0.0)
    assert stats(spark, []) == {} and stats(spark, [None]) == {}


def test_no_coordinate_becomes_a_row(spark):
    df = spark.range(10).select(F.array(F.rand(), F.rand()).alias("features"))
    plan = dimensions.dim_stats(df)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan
