"""What the physical plans must and must not contain."""

import os

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not here")


def plan(spark, name):
    return entry.own_queries()[name](spark, SF_DIR)._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(entry.own_queries()))
def test_no_cross_joins_and_no_row_wise_python(spark, name):
    text = plan(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "MapInPandas"):
        assert operator not in text
    by_the_batch = name.startswith("lsh_") or name in ("hashing_tf", "title_points", "poly3")
    assert ("ArrowEvalPython" in text) == by_the_batch


def test_scans_read_only_the_columns_they_need(spark):
    assert "ReadSchema: struct<text:string>" in plan(spark, "word_count")
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan(
        spark, "label_threshold"
    )


def test_words_are_computed_once_per_row(spark):
    physical = plan(spark, "vocab_filter").split("== Physical Plan ==")[1]
    assert physical.count("split(") == 2  # into lines, into words
    assert physical.count("INSET") + physical.count(" IN (") == 1
    assert "hashpartitioning" not in physical
