import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from veclode import sinks
from veclode.functions.vectors import dense_to_sparse
from veclode.session import cut_lineage, ensure_checkpoint_dir, sql_strings, table_bytes
from veclode.sources.bibliography import read_articles
from veclode.sources.documents import read_documents
from veclode.sources.points import read_labeled_points, read_libsvm, read_sparse_vectors
from veclode.sources.tables import read_keyed_values, read_labeled_csv


def lines(path):
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    return [line for p in parts for line in open(os.path.join(path, p)).read().splitlines()]


def test_documents_from_a_tree(spark, write):
    write("mail/a/1.", "Message-ID: <1>\nSubject: hi\nTomorrow we go\nhello world\nx")
    write("mail/a/b/2.", "From: me\r\n\r\nfirst line\r\nsecond line\r\n")
    write("mail/.DS_Store", "junk that must not be read")
    root = os.path.dirname(write("mail/empty", ""))
    rows = {os.path.basename(r["doc_id"]): r["content"] for r in read_documents(spark, root).collect()}
    rows.pop("empty", None)
    assert rows == {"1.": "hello world ", "2.": "first line second line "}


def test_sparse_vectors_fail_fast_or_keep_the_bad_line(spark, write):
    path = write("v", "(10,[1,4],[0.6,0.8])\nbroken\n(7,10,[2],[1.0])\n")
    with pytest.raises(PySparkException, match="cannot parse broken"):
        read_sparse_vectors(spark, path).collect()
    rows = read_sparse_vectors(spark, path, mode="PERMISSIVE").collect()
    assert [r["_corrupt"] for r in rows] == [None, "broken", None]
    assert [r["key"] for r in rows] == [None, None, 7]
    with pytest.raises(ValueError):
        read_sparse_vectors(spark, path, mode="SOMETIMES")


def test_libsvm(spark, write):
    path = write("points.svm", "-1 1:1 3:2\n1 2:0.5\n")
    rows = read_libsvm(spark, path, 5).collect()
    assert [(r["label"], *r["features"]) for r in rows] == [
        (-1.0, 5, [0, 2], [1.0, 2.0]),
        (1.0, 5, [1], [0.5]),
    ]
    assert {r["features"]["size"] for r in read_libsvm(spark, path).collect()} == {3}


def test_labeled_csv(spark, write):
    first = read_labeled_csv(spark, write("a", "1.0,0.5,0.0,-2.5\n0,1e3,0,1\n"))
    assert [tuple(r) for r in first.collect()] == [(1.0, [0.5, 0.0, -2.5]), (0.0, [1000.0, 0.0, 1.0])]
    path = write("b", "1,?,0.8,TRUE\n?,2,3,FALSE\n")
    last = read_labeled_csv(spark, path, label="last", missing="?", truth="TRUE")
    assert [tuple(r) for r in last.collect()] == [(1.0, [1.0, 0.0, 0.8]), (0.0, [0.0, 2.0, 3.0])]
    with pytest.raises(PySparkException):
        read_labeled_csv(spark, path, label="last", truth="TRUE").collect()


def test_keyed_values(spark, write):
    rows = read_keyed_values(spark, write("k", "12 0.0 0.25 0.0 \n13 1.0 0.0 2.0\n")).collect()
    assert [tuple(r) for r in rows] == [(12, [0.0, 0.25, 0.0]), (13, [1.0, 0.0, 2.0])]
    rows = read_keyed_values(spark, write("p", "1|2.0|3.0\n"), sep="|").collect()
    assert [tuple(r) for r in rows] == [(1, [2.0, 3.0])]


XML = """<?xml version="1.0"?>
<bib>
<inproceedings key="c"><title>Not me.</title><year>1999</year></inproceedings>
<article key="a" mdate="2010-01-01">
<author>J&uuml;rgen</author>
<title>On <i>Foo</i> B&auml;r.</title>
<year>2008</year>
</article>
<article key="b"><author>X</author><year>2001</year></article>
<article key="c"><title>No year</title></article>
<book><title>Book</title><year>1990</year></book>
<article key="d"><title>Last One</title><year>2007</year></article>
</bib>
"""


def test_articles(spark, write):
    rows = read_articles(spark, write("b.xml", XML)).collect()
    assert sorted(map(tuple, rows)) == [("Last One", 2007), ("On <i>Foo</i> B&auml;r.", 2008)]


@pytest.fixture
def points(spark):
    rows = [(1.0, [0.5, 0.0, 2.0]), (0.0, [0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "label double, features array<double>")
    return df.withColumn("features", dense_to_sparse(F.col("features")))


@pytest.mark.parametrize("fmt", ["parquet", "text", "libsvm"])
def test_labeled_points_come_back(spark, points, tmp_path, fmt):
    path = str(tmp_path / fmt)
    assert sinks.write_labeled_points(points, path, fmt, partitions=2) == 2
    if fmt == "parquet":
        back = spark.read.parquet(path)
    elif fmt == "text":
        assert sorted(lines(path)) == ["(0.0,(3,[],[]))", "(1.0,(3,[0,2],[0.5,2.0]))"]
        back = read_labeled_points(spark, path)
    else:
        back = read_libsvm(spark, path, 3)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, points.collect()))
    with pytest.raises(ValueError):
        sinks.write_labeled_points(points, path, "csv")


def test_indexed_vectors(spark, points, tmp_path):
    path = str(tmp_path / "v")
    sinks.write_indexed_vectors(points, path, [("label", "asc")], "text")
    assert sorted(lines(path)) == ["((3,[0,2],[0.5,2.0]),1)", "((3,[],[]),0)"]
    assert read_sparse_vectors(spark, path).filter("key = 1").head()["vector"]["indices"] == [0, 2]


def test_split_folders(points, tmp_path):
    df = points.withColumn("key", F.col("label").cast("int")).withColumn(
        "split", F.when(F.col("label") > 0, "test").otherwise("training")
    )
    sinks.write_split(df, str(tmp_path / "s"), "text")
    assert lines(tmp_path / "s_test") == ["(1,3,[0,2],[0.5,2.0])"]
    assert lines(tmp_path / "s_training") == ["(0,3,[],[])"]
    sinks.write_split(df, str(tmp_path / "p"))
    assert {"split=test", "split=training"} <= set(os.listdir(tmp_path / "p"))


def test_session_helpers(spark):
    assert spark.conf.get("spark.checkpoint.dir") in ensure_checkpoint_dir(spark)
    df = spark.createDataFrame([("ab", 1), ("é", 2)], "word string, n bigint")
    assert table_bytes(df) == (16 + 2 + 8) + (16 + 2 + 8)
    assert sorted(cut_lineage(df).collect()) == sorted(df.collect())
    odd = ["it's", "back\\", "a\nb", "%_", ""]
    words = spark.createDataFrame([(w,) for w in [*odd, "other"]], "w string")
    assert {r["w"] for r in words.filter(f"w IN ({sql_strings(odd)})").collect()} == set(odd)
