"""Nulls, repeats, malformed vectors and every size of lookup give one answer."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from veclode.functions import vectors as V
from veclode.functions.text import last_record
from veclode.operators.chisq import chi_square, chi_square_select
from veclode.operators.lsh import FOLD, Family, lsh_index, lsh_params
from veclode.operators.polynomial import polynomial
from veclode.operators.tfidf import apply_idf, fit_idf, hashing_tf
from veclode.operators.vocabulary import Vocabulary, keep_vocab
from veclode.plans import jobs
from veclode.session import cut_lineage, ensure_checkpoint_dir, scratch_tables
from veclode.sources import bibliography
from veclode.sources.bibliography import read_articles
from veclode.sources.documents import read_documents
from veclode.sources.lsh_files import read_lsh_params

ROWS = [(1, ["a", "x"]), (1, ["b", "y", None]), (None, ["a"]), (4, None), (5, [])]


def words(spark):
    return spark.createDataFrame(ROWS, "doc_id int, words array<string>")


def result(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("tier", [{}, {"inline_words": 0}, {"inline_words": 0, "shipped_bytes": 0}])
def test_vocabulary_tiers(spark, tier):
    table = spark.createDataFrame([("a", 2), ("b", 1)], "word string, n bigint")
    kept = keep_vocab(words(spark), Vocabulary(table, 2), **tier)
    assert result(kept.select("doc_id", "words")) == result(
        spark.createDataFrame([(1, ["a"]), (1, ["b"]), (None, ["a"])], "doc_id int, words array<string>")
    )


@pytest.mark.parametrize("tier", [{"inline_values": 0}, {"shipped_bytes": 0}])
def test_idf_tiers(spark, tier):
    tf = hashing_tf(words(spark), 16)
    idf = fit_idf(tf, 16)
    same = [apply_idf(tf, idf, **t).select("doc_id", "features") for t in ({}, tier)]
    got = [r["features"] for r in same[1].collect()]
    assert result(same[0]) == result(same[1]) and got.count(None) == 1


def test_null_words(spark):
    counted = {tuple(r["words"] or [r["doc_id"]]): r["features"] for r in hashing_tf(words(spark), 8).select("doc_id", "words", "features").collect()}
    assert counted[(4,)] is None and list(counted[(5,)]["indices"]) == []
    assert sum(counted[("b", "y", None)]["values"]) == 2


@pytest.mark.parametrize("dense", [True, False])
def test_lsh_tiers(spark, dense):
    rows = [(1, [0.5, -1.0, 2.0]), (1, [3.0, 1.0, -2.0]), (None, [0.0, 0.0, 1.0]), (2, None)]
    df = spark.createDataFrame(rows, "id int, features array<double>")
    if not dense:
        df = df.withColumn("features", F.when(F.col("features").isNotNull(), V.dense_to_sparse(F.col("features"))))
    params = lsh_params("angle", 3, family_size=6, tables=2, chain=3, seed=1)
    shipped, joined = (lsh_index(df, params, **t).select("id", "buckets") for t in ({}, {"shipped": 0}))
    assert result(shipped) == result(joined)
    assert [r["buckets"] for r in joined.where("id = 2").collect()] == [None]
    wide = lsh_params("angle", 4, family_size=6, tables=2, chain=3, seed=1)
    for tier in ({}, {"shipped": 0}):
        with pytest.raises(Exception, match="must have 4 dimensions"):
            lsh_index(df, wide, **tier).collect()


def test_chi_square_labels(spark):
    rng = np.random.default_rng(0)
    rows = [(float(i % 3), [0], [float(rng.integers(1, 3))]) for i in range(60)]
    make = lambda rs: spark.createDataFrame(rs, "label double, i array<int>, v array<double>").select(
        "label", V.sparse(F.lit(2), F.col("i"), F.col("v")).alias("features")
    )
    plain, nulls = make(rows), make(rows + [(None, [0], [9.0])] * 3)
    assert result(chi_square(plain)) == result(chi_square(nulls))
    many = make([(float(i), [0], [1.0]) for i in range(10_001)])
    assert chi_square(many).count() == 2
    assert chi_square_select(nulls, 1).count() == 63


def test_malformed_vectors(spark):
    texts = ["(4,[3,1],[1.0,2.0])", "(4,[1,9],[1.0,2.0])", "(4,[1,1],[3.0,2.0])", "(4,[-1],[1.0])", "(4,[],[])"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(V.parse_sparse(F.col("t"))["vector"]).collect()]
    assert (list(got[0]["indices"]), list(got[0]["values"])) == ([1, 3], [2.0, 1.0])
    assert got[1:4] == [None] * 3 and got[4]["size"] == 4
    labeled = df.select(V.parse_labeled(F.concat(F.lit("(1.0,"), "t", F.lit(")"))))
    assert [r[0] is None for r in labeled.collect()] == [False, True, True, True, False]


def test_equality_without_order(spark):
    df = spark.sql("SELECT named_struct('size', 4, 'indices', array(3, 1), 'values', array(1D, 2D)) AS a,"
                   " named_struct('size', 4, 'indices', array(0, 1, 3), 'values', array(0D, 2D, 1D)) AS b")  # fmt: skip
    a, b = F.col("a"), F.col("b")
    row = df.select(V.vectors_equal(a, b).alias("same"), (V.vector_hash(a) == V.vector_hash(b)).alias("alike")).head()
    assert row["same"] and row["alike"]


def test_long_text_without_a_record(spark):
    text = "<www key='x'>" + "y " * 5_000_000
    start = time.time()
    df = spark.range(1).select(F.repeat(F.lit("<www> y "), 1_000_000).alias("t"))
    assert df.select(last_record(F.col("t"), "article").alias("r")).head()["r"] is None
    assert time.time() - start < 5 and len(text)


def test_hidden_mail_folders(spark, write, tmp_path):
    for name in ("in/1.", "_sent_mail/2.", "_sent_mail/.old/3.", ".DS_Store/4.", "in/.DS_Store"):
        write(f"mail/{name}", "text of " + name)
    docs = read_documents(spark, str(tmp_path / "mail"), lambda line: F.lit(True))
    names = sorted(r["doc_id"].rsplit("/", 1)[1] for r in docs.collect())
    assert names == ["1.", "2.", "3."]
    write("mail/in/_x", "hidden")
    docs = read_documents(spark, str(tmp_path / "mail"), lambda line: F.lit(True))
    found = {r["doc_id"].rsplit("/", 1)[1]: r["content"] for r in docs.collect()}
    assert set(found) == {"1.", "2.", "3.", "_x"} and found["_x"] == "hidden "
    plain = read_documents(spark, str(tmp_path / "mail"), hidden=False)
    assert [r["doc_id"].rsplit("/", 1)[1] for r in plain.collect()] == ["1."]


def test_own_family_folded_chain_and_repeated_members(spark, write):
    rows = [(i, [float(i), 1.0 - i, 2.0]) for i in range(4)]
    df = spark.createDataFrame(rows, "id int, features array<double>")
    sign = Family(
        "count_positive",
        lambda rng, size, dim: (rng.standard_normal((size, dim)), np.zeros(size)),
        lambda dots, b, w: (dots > b).sum(axis=2),
        offsets=True,
    )
    params = lsh_params(sign, 3, family_size=4, tables=2, chain=5, seed=1)
    assert params.members.shape == (4, 3) and params.a.shape == (2, 5, 3)
    expected = {i: [int((params.a[t] @ x > 0).sum()) for t in range(2)] for i, x in rows}
    for tier in ({}, {"shipped": 0}):
        got = {r["id"]: r["buckets"] for r in lsh_index(df, params, **tier).collect()}
        assert got == expected

    text = "(3,[0],[1.0]);-1;1\n(3,[1],[1.0]);0;1\n"
    own = read_lsh_params(spark, write("own", text), sign, chain=2)
    assert [r["buckets"] for r in lsh_index(df, own).orderBy("id").collect()] == [[2], [1], [1], [1]]
    with pytest.raises(ValueError):
        read_lsh_params(spark, write("bare", "(3,[0],[1.0])\n"), sign, chain=1)

    stable = lsh_params("pstable", 3, family_size=3, tables=2, chain=4, seed=2, w=2)
    whole = {r["id"]: r["buckets"] for r in lsh_index(df, stable).collect()}
    folded = {r["id"]: r["buckets"] for r in lsh_index(df, stable, chain="folded").collect()}
    for i, buckets in whole.items():
        for text, got in zip(buckets, folded[i]):
            h = 0
            for n in text.split(":"):
                h = (h * FOLD + int(n)) % 2**64
            assert got == (h - 2**64 if h >= 2**63 else h)


def test_polynomial_of_odd_vectors(spark):
    rows = [(1, [2.0, 0.0, 3.0]), (2, [0.0, 0.0, 0.0]), (3, None)]
    df = spark.createDataFrame(rows, "id int, x array<double>")
    df = df.withColumn("features", F.when(F.col("x").isNotNull(), V.dense_to_sparse(F.col("x"))))
    got = {r["id"]: r["features"] for r in polynomial(df, 2).collect()}
    assert got[3] is None and got[2]["values"] == [] and got[2]["size"] == 9
    assert sorted(got[1]["values"]) == [2.0, 3.0, 4.0, 6.0, 9.0]


def test_jobs_leave_no_tables_behind(spark, write, tmp_path):
    for i in range(4):
        write(f"mail/{i}", f"alpha beta gamma{i}\n")
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    with scratch_tables(spark) as tables:
        jobs.mail_vectors(spark, str(tmp_path / "mail"), str(tmp_path / "v"), 0.9)
        jobs.libsvm_points(
            spark, write("p.svm", "1 1:1 3:2\n-1 2:1\n"), str(tmp_path / "best"), 1, 4
        )
    assert tables and not set(os.listdir(folder)) - before
    assert spark.read.parquet(str(tmp_path / "v")).count() == 4


def test_articles_do_not_depend_on_splits(spark, write):
    def article(i):
        return f"<article key='{i}'>\n<author>A</author>\n<title>Title {i}</title>\n<year>{1900 + i}</year>\n</article>"

    other = "<www><title>Home</title><year>1</year></www>\n"
    text = "<bib>\n" + other * 40 + article(0) + "\n" + other * 3 + article(1) + article(2) + "\n"
    text += "<article key='open'>\n<title>Never closed</title><year>1</year>\n" + other + article(3) + "\n"
    text += "".join(article(i) + "\n" for i in range(4, 12)) + other * 20
    text += "<article key='end'><title>Cut off</title><year>2</year>\n"
    path = write("splits/b.xml", text)
    write("splits/c.xml", article(50) + "\n" + "</article>\n" + article(51) + "\n")
    write("splits/empty.xml", "")
    folder = os.path.dirname(path)
    expected = sorted((f"Title {i}", 1900 + i) for i in [*range(12), 50, 51])
    bytes_key, cost_key = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    saved = {k: spark.conf.get(k) for k in (bytes_key, cost_key)}
    try:
        for size in (150, 700, 1 << 27):
            spark.conf.set(bytes_key, size)
            spark.conf.set(cost_key, 1)
            assert sorted(map(tuple, read_articles(spark, folder).collect())) == expected, size
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_small_splits_of_a_bibliography_do_not_cost_a_task_each(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "bibliography")
    record = F.concat(F.lit("<article key='"), F.col("id"), F.lit("'><title>T</title><year>1999</year></article>"))
    spark.range(2000).coalesce(1).select(record.alias("value")).write.text(folder)
    written = []
    monkeypatch.setattr(bibliography, "cut_lineage", lambda df: written.append(df.rdd.getNumPartitions()) or cut_lineage(df))
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "1000")
    try:
        assert spark.read.text(folder).rdd.getNumPartitions() > 100
        assert read_articles(spark, folder).count() == 2000
    finally:
        spark.conf.set(size, before)
    assert written and max(written) <= 2 * spark.sparkContext.defaultParallelism
