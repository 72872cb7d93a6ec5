import math
import random
from collections import Counter

import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import functions as F

from tests.test_text import jvm_hash
from veclode.functions.vectors import from_ml_vector
from veclode.operators import tfidf as T
from veclode.operators.vocabulary import keep_vocab, top_fraction_vocab, word_count
from veclode.plans.jobs import text_tfidf


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    words = ["hot"] * 60 + [f"w{i}" for i in range(80)] + ["it's", "back\\slash", "", "naïve"]
    docs = [(d, [rng.choice(words) for _ in range(rng.randrange(0, 40))]) for d in range(60)]
    docs.append((60, ["only-here"]))
    df = spark.createDataFrame(docs, "doc_id bigint, words array<string>").cache()
    return df, dict(docs)


def ranked(docs):
    counts = Counter(w for ws in docs.values() for w in ws)
    return counts, sorted(counts, key=lambda w: (-counts[w], w.encode()))


def test_word_count(corpus):
    df, docs = corpus
    assert {r["word"]: r["n"] for r in word_count(df).collect()} == ranked(docs)[0]


@pytest.mark.parametrize("take_rows", [0, 1000])
def test_top_fraction(corpus, take_rows):
    df, docs = corpus
    counts, order = ranked(docs)
    vocab = top_fraction_vocab(word_count(df), 0.3, take_rows)
    assert vocab.size == int(len(order) * 0.3)
    assert {r["word"] for r in vocab.table.collect()} == set(order[: vocab.size])


@pytest.mark.parametrize("limits", [{}, {"inline_words": 0}, {"inline_words": 0, "shipped_bytes": 0}])
def test_keep_vocab_keeps_order_and_repeats(corpus, limits):
    df, docs = corpus
    vocab = top_fraction_vocab(word_count(df), 0.9)
    kept = {r["word"] for r in vocab.table.collect()}
    assert {"it's", "back\\slash", ""} <= kept
    expected = {d: [w for w in ws if w in kept] for d, ws in docs.items()}
    expected = {d: ws for d, ws in expected.items() if ws}
    got = keep_vocab(df.withColumn("lang", F.lit("en")), vocab, **limits)
    assert {r["doc_id"]: r["words"] for r in got.collect()} == expected
    assert {r["lang"] for r in got.collect()} == {"en"}


def test_vocab_of_nothing(corpus):
    df, _ = corpus
    vocab = top_fraction_vocab(word_count(df), 0.0)
    assert vocab.size == 0 and keep_vocab(df, vocab).count() == 0


def python_tf(docs, n):
    return {d: Counter(jvm_hash(w) % n for w in ws) for d, ws in docs.items()}


def as_dicts(df):
    return {r["doc_id"]: dict(zip(r["features"]["indices"], r["features"]["values"])) for r in df.collect()}


def test_hashing_tf(corpus):
    df, docs = corpus
    tf = T.hashing_tf(df, 17)
    assert as_dicts(tf) == python_tf(docs, 17)
    for r in tf.collect():
        assert r["features"]["size"] == 17
        assert r["features"]["indices"] == sorted(r["features"]["indices"])


def test_murmur3_is_the_ml_hashing(corpus):
    df, _ = corpus
    ml = HashingTF(numFeatures=33, inputCol="words", outputCol="v").transform(df)
    expected = as_dicts(ml.select("doc_id", from_ml_vector(F.col("v")).alias("features")))
    assert as_dicts(T.hashing_tf(df, 33, hash="murmur3")) == expected
    with pytest.raises(ValueError, match="unknown hash"):
        T.hashing_tf(df, 33, hash="sha")


TIERS = [{}, {"inline_values": 0}, {"shipped_bytes": 0}]


@pytest.mark.parametrize("limits", TIERS)
def test_tfidf_weights(corpus, limits):
    df, docs = corpus
    n = 23
    tf = python_tf(docs, n)
    seen = Counter(i for c in tf.values() for i in c)
    m = len(docs)
    expected = {}
    for d, c in tf.items():
        w = {i: x * math.log((m + 1) / (seen[i] + 1)) for i, x in c.items()}
        norm = math.sqrt(sum(x * x for x in w.values()))
        expected[d] = {i: x / norm if norm else 0.0 for i, x in w.items()}
    vectors = T.hashing_tf(df, n)
    idf = T.fit_idf(vectors, n)
    assert idf.documents == m
    got = as_dicts(T.l2_normalize(T.apply_idf(vectors, idf, **limits)))
    assert got.keys() == expected.keys()
    for d in expected:
        assert got[d] == pytest.approx(expected[d])


@pytest.mark.parametrize("limits", TIERS)
def test_idf_of_an_index_not_seen_when_fitting(spark, limits):
    schema = "doc_id bigint, features struct<size:int,indices:array<int>,values:array<double>>"
    fitted = spark.createDataFrame([(1, (4, [0], [1.0])), (2, (4, [0, 1], [1.0, 1.0]))], schema)
    other = spark.createDataFrame([(3, (4, [0, 3], [2.0, 1.0])), (4, (4, [], []))], schema)
    got = as_dicts(T.apply_idf(other, T.fit_idf(fitted, 4), **limits))
    assert got == {3: {0: 0.0, 3: pytest.approx(math.log(3))}, 4: {}}


def test_zero_vector_stays_zero(spark):
    df = spark.createDataFrame([(1, ["a", "a"]), (2, ["a"])], "doc_id bigint, words array<string>")
    got = as_dicts(T.tfidf_l2(df, 8))
    assert all(set(v.values()) == {0.0} for v in got.values())


def test_important_terms(spark):
    schema = "doc_id bigint, features struct<size:int,indices:array<int>,values:array<double>>"
    rows = [
        (1, (9, [0, 2, 5], [0.1, 0.9, 0.3])),
        (2, (9, [0, 5], [0.2, 0.3])),
        (3, (9, [7], [0.9])),
        (4, (9, [0], [0.1])),
    ]
    df = spark.createDataFrame(rows, schema)
    terms = T.important_terms(df, 0.5)
    assert {(r["idx"], r["max_weight"]) for r in terms.collect()} == {(2, 0.9), (7, 0.9)}
    for limits in TIERS:
        kept = T.keep_terms(df, terms, **limits)
        assert as_dicts(kept) == {1: {2: 0.9}, 3: {7: 0.9}}
        assert {r["features"]["size"] for r in kept.collect()} == {9}
        packed = T.keep_terms(df, terms, remap=True, drop_empty=False, **limits)
        assert as_dicts(packed) == {1: {0: 0.9}, 2: {}, 3: {1: 0.9}, 4: {}}
        assert {r["features"]["size"] for r in packed.collect()} == {2}


@pytest.mark.parametrize("partitions", ["1", "64"])
def test_weights_do_not_depend_on_partitions(spark, corpus, partitions):
    df, docs = corpus
    content = df.select("doc_id", F.array_join("words", " ").alias("content"))
    expected = as_dicts(text_tfidf(content, 0.3))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = as_dicts(text_tfidf(content.repartition(int(partitions)), 0.3))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got.keys() == expected.keys()
    for d in expected:
        assert got[d] == pytest.approx(expected[d])


def test_nothing_is_left_when_the_vocabulary_is_empty(spark):
    docs = spark.createDataFrame([(1, "a b c "), (2, "")], "doc_id bigint, content string")
    assert text_tfidf(docs, 0.005).collect() == []
