"""Functions over batches hold a bounded number of array elements, however many rows a batch has."""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from veclode.functions.batches import ELEMENTS, list_pieces
from veclode.operators import lsh, shipped, terms
from veclode.operators.tfidf import apply_idf, fit_idf, hashing_tf, keep_terms

ROWS, WORDS = 40, 10_000
LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def long_rows(spark):
    """One batch of 400,000 different words."""
    words = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda j: F.concat_ws("_", "id", j))
    return spark.range(ROWS).coalesce(1).withColumn("words", F.when(F.col("id") != 7, words))


def bounded(function, elements):
    """``function``, failing where it is given more elements than a piece has."""

    def checked(first, *others):
        if elements(first) > 1 << 17:
            raise ValueError("more than a piece")
        return function(first, *others)

    return checked


def test_pieces_hold_all_rows_in_order():
    rows = [[1] * 5, None, [], [2] * 9, [3], [4] * 2, [5] * 3, None]
    batch = pa.array(rows, pa.list_(pa.int32()))
    found = list(list_pieces(iter([batch, batch[:0], batch[2:]]), 6))
    assert [r for p in found for r in p.to_pylist()] == rows + rows[2:]
    assert max(len(p.flatten()) for p in found if len(p) > 1) <= 6


def test_terms_are_counted_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(terms, "string_hashes", bounded(terms.string_hashes, len))
    rows = {r["id"]: r["features"] for r in hashing_tf(long_rows(spark), 1000).collect()}
    assert len(rows) == ROWS and rows[7] is None and ROWS * WORDS > ELEMENTS
    for i in (0, 6, 8, 39):
        hashes = terms.string_hashes(pa.array([f"{i}_{j}" for j in range(WORDS)]))
        assert dict(zip(rows[i]["indices"], rows[i]["values"])) == Counter((hashes % 1000).tolist())


def test_elements_are_looked_up_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(shipped, "_offsets", bounded(shipped._offsets, lambda b: len(b.flatten())))
    places = F.transform("words", lambda w: F.substring_index(w, "_", -1).cast("int"))
    table = np.arange(WORDS) * 0.5
    members = pa.array(["0_1", "8_3", "39_9999"])
    found = long_rows(spark).select(
        "id", shipped.values_at(table, places, 10).alias("v"), shipped.keep_members(F.col("words"), members).alias("k")
    )
    rows = {r["id"]: r for r in found.collect()}
    assert all(rows[i]["v"] == table.tolist() for i in range(ROWS) if i != 7)
    assert rows[7]["v"] is None and rows[7]["k"] is None
    assert {i: r["k"] for i, r in rows.items() if r["k"]} == {0: ["0_1"], 8: ["8_3"], 39: ["39_9999"]}


def test_idf_and_kept_terms_work_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(terms, "string_hashes", bounded(terms.string_hashes, len))
    monkeypatch.setattr(shipped, "_offsets", bounded(shipped._offsets, lambda b: len(b.flatten())))
    width = 30_000  # sent to the tasks, not a constant
    tf = hashing_tf(long_rows(spark), width).drop("words").localCheckpoint()
    sets = [set(r["features"]["indices"]) for r in tf.collect() if r["features"]]
    seen = Counter(i for s in sets for i in s)
    idf = fit_idf(tf, width)
    assert idf.documents == len(sets) and {r["idx"]: r["df"] for r in idf.table.collect()} == seen
    wanted = sorted(seen)[::3]
    listed = spark.createDataFrame([(i,) for i in wanted], "idx int")
    weighted = apply_idf(tf, idf)
    place = {i: k for k, i in enumerate(wanted)}
    for remap in (False, True):
        kept = keep_terms(weighted, listed, remap=remap).select("features.indices").collect()
        expected = Counter(place[i] if remap else i for s in sets for i in s if i in place)
        assert Counter(i for r in kept for i in r["indices"]) == expected


def test_wide_vectors_are_hashed_in_pieces(spark, monkeypatch):
    params = lsh.generated_params("angle", 1 << 20, family_size=4, tables=2, chain=3, seed=5)
    vectors = hashing_tf(long_rows(spark), 1 << 20).drop("words")
    expected = lsh.lsh_index(vectors.repartition(20), params).select("id", "buckets").orderBy("id").collect()
    monkeypatch.setattr(lsh, "_sparse_dots", bounded(lsh._sparse_dots, len))
    assert lsh.lsh_index(vectors, params).select("id", "buckets").orderBy("id").collect() == expected


def test_batches_are_bounded_in_bytes(spark, monkeypatch):
    def checked(batches, *limit):
        def small():
            for batch in batches:
                if batch.nbytes > 6 << 20:
                    raise ValueError(f"a batch of {batch.nbytes} bytes")
                yield batch

        return list_pieces(small(), *limit)

    monkeypatch.setattr(terms, "list_pieces", checked)
    monkeypatch.setattr(shipped, "list_pieces", checked)
    spark.conf.unset(LIMIT)
    five = F.explode(F.sequence(F.lit(1), F.lit(5))).alias("copy")  # some 20 MB
    tf = hashing_tf(long_rows(spark).select("*", five), 30_000).drop("words").localCheckpoint()
    vectors = [r["features"] for r in tf.collect() if r["features"]]
    assert [sum(v["values"]) for v in vectors] == [WORDS] * 5 * (ROWS - 1)
    kept = keep_terms(tf, spark.range(30_000).selectExpr("cast(id AS int) idx"))
    assert Counter(len(r["features"]["indices"]) for r in kept.collect()) == Counter(
        len(v["indices"]) for v in vectors
    )


def test_a_limit_of_the_session_stays(spark):
    spark.conf.set(LIMIT, "8m")
    try:
        hashing_tf(long_rows(spark), 100)
        assert spark.conf.get(LIMIT) == "8m"
    finally:
        spark.conf.unset(LIMIT)
