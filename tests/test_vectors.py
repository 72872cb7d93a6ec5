import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from veclode.functions import vectors as V



def frame(spark, *rows):
    schema = "v struct<size:int,indices:array<int>,values:array<double>>"
    return spark.createDataFrame([(r,) for r in rows], schema)


def evaluate(spark, column, schema, *values):
    return spark.createDataFrame([values], schema).select(column.alias("r")).head()["r"]


def test_dense_to_sparse_and_back(spark):
    dense = [0.0, 1.5, 0.0, -2.0, 0.0]
    got = evaluate(spark, V.dense_to_sparse(F.col("x")), "x array<double>", dense)
    assert (got["size"], got["indices"], got["values"]) == (5, [1, 3], [1.5, -2.0])
    back = V.sparse_to_dense(V.dense_to_sparse(F.col("x")))
    for x in (dense, [0.0, 0.0], [1.0], [], [1.0, 2.0, 3.0]):
        assert evaluate(spark, back, "x array<double>", x) == x


def test_dense_to_sparse_keeps_nan(spark):
    got = evaluate(spark, V.dense_to_sparse(F.col("x")), "x array<double>", [0.0, math.nan])
    assert got["indices"] == [1] and math.isnan(got["values"][0])


PAIRS = "p array<struct<idx:int,value:double>>"


def test_pairs_are_sorted(spark):
    column = V.sparse_from_pairs(F.lit(9), F.col("p"))
    got = evaluate(spark, column, PAIRS, [(7, 1.0), (2, 3.0)])
    assert (got["size"], got["indices"], got["values"]) == (9, [2, 7], [3.0, 1.0])
    assert evaluate(spark, column, PAIRS, [])["indices"] == []


@pytest.mark.parametrize("pairs", [[(1, 1.0), (1, 2.0)], [(9, 1.0)], [(-1, 1.0)]])
def test_bad_pairs_raise(spark, pairs):
    with pytest.raises(PySparkException, match="repeated or out-of-range"):
        evaluate(spark, V.sparse_from_pairs(F.lit(9), F.col("p")), PAIRS, pairs)


@pytest.mark.parametrize(
    "line, key, vector",
    [
        ("(10,[1,4],[0.6,0.8])", None, (10, [1, 4], [0.6, 0.8])),
        ("(7,10,[1,4],[0.6,0.8])", 7, (10, [1, 4], [0.6, 0.8])),
        ("((10,[1,4],[0.6,1.0E-5]),7)", 7, (10, [1, 4], [0.6, 1e-5])),
        ("(10,[],[])", None, (10, [], [])),
    ],
)
def test_parse_each_form(spark, line, key, vector):
    got = evaluate(spark, V.parse_sparse(F.col("t")), "t string", line)
    assert got["key"] == key
    assert tuple(got["vector"]) == vector


@pytest.mark.parametrize(
    "line", ["", "x", "(10,[1,4])", "(10,[1],[0.6,0.8])", "(a,[1],[0.5])", "(10,[1],[z])", "(10,[1],[1.0],[2.0])"]
)
def test_malformed_text_is_null(spark, line):
    assert evaluate(spark, V.parse_sparse(F.col("t")), "t string", line) is None


@pytest.mark.parametrize(
    "line, label, vector",
    [
        ("(1.0,(10,[1,4],[0.6,0.8]))", 1.0, (10, [1, 4], [0.6, 0.8])),
        ("(-1.0,[0.0,2.5])", -1.0, (2, [1], [2.5])),
        ("0.0,1.5 0.0 2.0", 0.0, (3, [0, 2], [1.5, 2.0])),
    ],
)
def test_parse_labeled(spark, line, label, vector):
    got = evaluate(spark, V.parse_labeled(F.col("t")), "t string", line)
    assert got["label"] == label and tuple(got["features"]) == vector
    assert evaluate(spark, V.parse_labeled(F.col("t")), "t string", "(1.0,(x,[1],[2]))") is None


def test_text_forms(spark):
    df = frame(spark, (4, [0, 3], [1.0, 0.5]))
    v = F.col("v")
    row = df.select(
        V.format_sparse(v).alias("a"),
        V.format_sparse(v, F.lit(7)).alias("b"),
        V.format_sparse(v, F.lit(7), key_last=True).alias("c"),
        V.format_labeled(F.lit(1), v).alias("d"),
        V.format_dense(v["values"]).alias("e"),
        V.zeros(2).alias("z"),
    ).head()
    assert row["a"] == "(4,[0,3],[1.0,0.5])"
    assert row["b"] == "(7,4,[0,3],[1.0,0.5])"
    assert row["c"] == "((4,[0,3],[1.0,0.5]),7)"
    assert row["d"] == "(1.0,(4,[0,3],[1.0,0.5]))"
    assert row["e"] == "[1.0,0.5]"
    assert row["z"] == [0.0, 0.0]


vectors = st.dictionaries(
    st.integers(0, 19), st.floats(-1e6, 1e6, allow_nan=False).filter(bool), max_size=8
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pairs=st.lists(st.tuples(vectors, vectors), min_size=1, max_size=20))
def test_dot_equality_and_round_trip_against_python(spark, pairs):
    def stored(d):
        return (20, sorted(d), [d[i] for i in sorted(d)])

    schema = "n int, a struct<size:int,indices:array<int>,values:array<double>>, b struct<size:int,indices:array<int>,values:array<double>>"
    df = spark.createDataFrame([(n, stored(a), stored(b)) for n, (a, b) in enumerate(pairs)], schema)
    a, b = F.col("a"), F.col("b")
    rows = df.select(
        "n",
        "a",
        V.sparse_dot(a, b).alias("dot"),
        V.dense_dot(V.sparse_to_dense(a), V.sparse_to_dense(b)).alias("dense"),
        V.vectors_equal(a, b).alias("eq"),
        V.parse_sparse(V.format_sparse(a, F.col("n"))).alias("back"),
        V.from_ml_vector(V.to_ml_vector(a)).alias("ml"),
    ).collect()
    for r in rows:
        x, y = pairs[r["n"]]
        expected = sum(x[i] * y[i] for i in x if i in y)
        assert r["dot"] == pytest.approx(expected, rel=1e-9, abs=1e-3)
        assert r["dense"] == pytest.approx(expected, rel=1e-9, abs=1e-3)
        assert r["eq"] == (x == y)
        assert r["back"]["key"] == r["n"] and r["back"]["vector"] == r["a"] == r["ml"]


def test_stored_zeros_do_not_break_equality(spark):
    df = frame(spark, (3, [0, 1], [1.0, 0.0]), (3, [0], [1.0]))
    hashes = {r["h"] for r in df.select(V.vector_hash(F.col("v")).alias("h")).collect()}
    assert len(hashes) == 1


def test_dot_of_different_sizes_raises(spark):
    df = frame(spark, (3, [0], [1.0])).select("v", V.dense_to_sparse(V.zeros(4)).alias("w"))
    with pytest.raises(PySparkException, match="differ in size"):
        df.select(V.sparse_dot(F.col("v"), F.col("w"))).collect()
