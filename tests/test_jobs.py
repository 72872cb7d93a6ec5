import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_sources_and_sinks import XML, lines
from tests.test_text import jvm_hash
from veclode.functions.vectors import sparse_to_dense
from veclode.operators.lsh import LshParams
from veclode.plans import jobs


def test_mail_vectors_feed_the_hash_job(spark, write, tmp_path):
    rng = random.Random(1)
    for i in range(30):
        body = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", f"rare{i}"]) for _ in range(20))
        root = write(f"mail/{i % 3}/{i}.", f"Subject: s\n\n{body}\n")
    out = str(tmp_path / "vectors")
    vectors = jobs.mail_vectors(spark, str(tmp_path / "mail"), out, fraction=0.2, fmt="text")
    assert vectors.count() == 30
    for r in vectors.collect():
        norm = math.sqrt(sum(x * x for x in r["features"]["values"]))
        assert norm == pytest.approx(1) or norm == 0
    written = lines(out)
    assert len(written) == 30 and sorted(int(w.rsplit(",", 1)[1][:-1]) for w in written) == list(range(30))

    width = vectors.head()["features"]["size"]
    rng = np.random.default_rng(1)
    params = LshParams("angle", rng.standard_normal((2, 3, width)), np.zeros((2, 3)), np.ones((2, 3)))
    indexed = jobs.hash_vectors(spark, out, str(tmp_path / "lsh"), params, fmt="text", partitions=3)
    assert indexed.count() == 30
    assert len(lines(tmp_path / "lsh")) == 30
    histogram = [line.split("\t") for line in lines(tmp_path / "lsh_histogram")]
    assert histogram == sorted(histogram, key=lambda r: (int(r[0]), int(r[1])))
    for table in "01":
        assert sum(int(n) for t, _, n in histogram if t == table) == 30


def test_vectors_without_keys_get_distinct_ones(spark, write, tmp_path):
    path = write("v", "(2,[0],[1.0])\n" * 5)
    params = LshParams("pstable", np.ones((1, 1, 2)), np.zeros((1, 1)), np.ones((1, 1)))
    rows = jobs.hash_vectors(spark, path, str(tmp_path / "o"), params, chain="first").collect()
    assert len({r["id"] for r in rows}) == 5 and {tuple(r["buckets"]) for r in rows} == {(1,)}
    back = spark.read.parquet(str(tmp_path / "o_histogram")).collect()
    assert [tuple(r) for r in back] == [(0, 1, 5)]


def test_bibliography_points(spark, write, tmp_path):
    out = str(tmp_path / "o")
    rows = jobs.bibliography_points(spark, write("b.xml", XML), out, 50, fmt="text").collect()
    assert len(lines(out)) == 2
    by_label = {r["label"]: r["features"] for r in rows}
    assert set(by_label) == {0.0, 1.0}  # 2008 and 2007
    assert by_label[1.0]["indices"] == sorted({jvm_hash(w) % 50 for w in ("last", "one")})


def test_libsvm_points(spark, write, tmp_path):
    path = write("p.svm", "-1 1:1 3:2\n1 2:1 3:2\n-1 1:1\n1 2:1\n")
    assert jobs.libsvm_points(spark, path, str(tmp_path / "all"), num_features=4, fmt="text") == 4
    assert sorted(lines(tmp_path / "all"))[0] == "(0.0,(4,[0,2],[1.0,2.0]))"
    assert jobs.libsvm_points(spark, path, str(tmp_path / "best"), select=2, fmt="text") == 4
    assert sorted(lines(tmp_path / "best")) == ["(0.0,(2,[0],[1.0]))"] * 2 + ["(1.0,(2,[1],[1.0]))"] * 2


def test_csv_points(spark, write, tmp_path):
    jobs.csv_points(spark, write("h.csv", "1.0,0.5,0.0,-2.5\n"), str(tmp_path / "o"), fmt="text")
    assert lines(tmp_path / "o") == ["(1.0,(3,[0,2],[0.5,-2.5]))"]


def test_linkage_points_and_expanding_saved_ones(spark, write, tmp_path):
    path = write("l.csv", "2,?,3,TRUE\n0,1,0,FALSE\n")
    jobs.linkage_points(spark, path, str(tmp_path / "cubic"), fmt="text")
    jobs.linkage_points(spark, path, str(tmp_path / "plain"), degree=1, fmt="text")
    jobs.expand_points(spark, str(tmp_path / "plain"), str(tmp_path / "again"), fmt="text")
    assert sorted(lines(tmp_path / "again")) == sorted(lines(tmp_path / "cubic"))
    assert "(0.0,(19,[3,6,8],[1.0,1.0,1.0]))" in lines(tmp_path / "cubic")


def test_variance_vectors(spark, write, tmp_path):
    train = write("train.csv", "5,1,0,10\n3,1,7,20\n4,1,9,40\n")
    test = write("test.csv", "1,50,60,0\n")
    rows = jobs.variance_vectors(spark, train, test, str(tmp_path / "o"), k=2, fmt="text")
    dense = rows.select("key", "split", sparse_to_dense(F.col("features")).alias("x")).collect()
    assert sorted(r["key"] for r in dense) == [0, 1, 2, 3]
    assert [(r["key"], r["x"]) for r in dense if r["split"] == "test"] == [(3, [60.0, 0.0])]
    assert sorted(r["x"] for r in dense if r["split"] == "training") == [[0, 10], [7, 20], [9, 40]]
    assert lines(tmp_path / "o_test") == ["(3,2,[0],[60.0])"]


def test_split_vectors(spark, write, tmp_path):
    path = write("k", "".join(f"{i} {i}.0 0.0\n" for i in range(80)))
    jobs.split_vectors(spark, path, str(tmp_path / "o"), n=50, seed=1, fmt="text")
    test, training = lines(tmp_path / "o_test"), lines(tmp_path / "o_training")
    assert len(test) == 50 and len(training) == 30 and not set(test) & set(training)


def test_expanded_points_compressed(spark, write, tmp_path):
    lines = "".join(f"{i},2,0.{i % 9}1,?,1,?,1,{i % 5},1,1,0,{'TRUE' if i % 3 else 'FALSE'}\n" for i in range(500))
    path, found, sizes = write("links.csv", lines), [], []
    for codec in ("none", "gzip"):
        once, saved, then = (str(tmp_path / f"{name}_{codec}") for name in ("once", "saved", "then"))
        jobs.linkage_points(spark, path, once, fmt="text", compression=codec)
        jobs.linkage_points(spark, path, saved, degree=1, fmt="text", compression=codec)
        jobs.expand_points(spark, saved, then, fmt="text", compression=codec)
        found += [sorted(r["value"] for r in spark.read.text(folder).collect()) for folder in (once, then)]
        sizes.append(sum(f.stat().st_size for folder in (once, then) for f in tmp_path.glob(f"{os.path.basename(folder)}/part-*")))
    assert len(found[0]) == 500 and found[0] == found[2] and found[1] == found[3]
    assert sizes[1] < sizes[0] / 3
