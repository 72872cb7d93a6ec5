import hashlib
import random

import pytest
from pyspark.sql import functions as F

from veclode.operators.lookup import lookup_join
from veclode.operators.ranking import kth_row, top_rows, with_row_index
from veclode.operators.split import exact_split

ORDER = [("n", "desc"), ("word", "asc")]


@pytest.fixture(scope="module")
def counts(spark):
    rng = random.Random(1)
    rows = [(f"w{i:04d}", rng.choice([1, 1, 1, 1, 2, 3, 50])) for i in range(700)]
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows, "word string, n bigint").repartition(7).cache(), expected


@pytest.mark.parametrize("take_rows", [0, 1000])
@pytest.mark.parametrize("k", [1, 37, 650, 700])
def test_top_rows_is_exact_either_way(counts, k, take_rows):
    df, expected = counts
    assert tuple(kth_row(df, ORDER, k, take_rows))[::-1] == expected[k - 1]
    got = top_rows(df, ORDER, k, take_rows).collect()
    assert sorted(map(tuple, got)) == sorted(expected[:k])


@pytest.mark.parametrize("take_rows", [0, 1000])
def test_asking_for_more_than_there_is(counts, take_rows):
    df, expected = counts
    assert kth_row(df, ORDER, 701, take_rows) is None
    assert top_rows(df, ORDER, 701, take_rows).count() == 700
    assert top_rows(df, ORDER, 0, take_rows).count() == 0


def test_row_index_is_dense_and_ordered(counts):
    df, expected = counts
    rows = with_row_index(df, ORDER).orderBy("row_index").collect()
    assert [r["row_index"] for r in rows] == list(range(700))
    assert [(r["word"], r["n"]) for r in rows] == expected


def test_row_index_of_nothing(spark):
    assert with_row_index(spark.range(0), [("id", "asc")]).collect() == []


@pytest.mark.parametrize("take_rows", [0, 1000])
@pytest.mark.parametrize("size", [50, 51, 200, 3000])
def test_exact_split(spark, size, take_rows):
    df = spark.range(size).repartition(5)
    rows = exact_split(df, 50, seed=3, take_rows=take_rows).collect()
    test = {r["id"] for r in rows if r["split"] == "test"}
    assert len(test) == 50 and len(rows) == size
    draws = sorted(range(size), key=lambda i: hashlib.md5(f"3:{i}".encode()).hexdigest())
    assert test == set(draws[:50])


def test_exact_split_is_reproducible(spark):
    df = spark.range(200).repartition(5)
    test = {r["id"] for r in exact_split(df, 50, seed=3).filter("split = 'test'").collect()}
    again = exact_split(df.repartition(2), 50, seed=3).filter("split = 'test'").collect()
    assert {r["id"] for r in again} == test
    other = exact_split(df, 50, seed=4).filter("split = 'test'").collect()
    assert {r["id"] for r in other} != test


def test_exact_split_refuses_what_it_cannot_do(spark):
    with pytest.raises(ValueError, match="fewer than"):
        exact_split(spark.range(49), 50, seed=0)
    with pytest.raises(ValueError, match="not unique"):
        exact_split(spark.range(10).select(F.lit(1).alias("id")), 3, seed=0)
    assert len({r["split"] for r in exact_split(spark.range(50), 50, seed=0).collect()}) == 1
    assert exact_split(spark.range(3), 0, seed=0).filter("split = 'test'").count() == 0


def test_lookup_join_spreads_a_hot_key(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    table = spark.range(0, 3000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("x"))
    small = lookup_join(rows, table, "k", "id")
    large = lookup_join(rows, table, "k", "id", broadcast_bytes=0)
    plan = large._jdf.queryExecution().toString()
    assert "_salt" in plan and "SortMergeJoin" in plan
    assert "BroadcastHashJoin" in small._jdf.queryExecution().toString()
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
