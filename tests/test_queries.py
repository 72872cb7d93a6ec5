"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([r[i] + 0.0 if isinstance(r[i], float) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(entry.own_oracle_sql()))
def test_query(spark, duck, name):
    df = entry.own_queries()[name](spark, SF_DIR)
    expected = duck.sql(entry.own_oracle_sql()[name])
    assert sorted(df.columns) == sorted(expected.columns)
    got = canonical(df.columns, df.collect())
    assert got and got == canonical(expected.columns, expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "idx", "weight"]
