"""Repeated keys, clashing columns, small and empty tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from veclode.llm import language_id, quality, substring_dedup, toxicity
from veclode.llm.common import stored, with_rank
from veclode.llm.url_filter import filter_urls


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(3, 9))) for _ in range(n))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_ambiguous_keys_and_clashing_columns_lose_no_text(spark):
    rng = random.Random(1)
    shared = prose(rng, 60)
    rows = [(i, f"{prose(rng, 30)} {shared} {prose(rng, 30)}") for i in range(6)]
    rows += [(3, prose(rng, 90)), (None, prose(rng, 40)), rows[5]]
    docs = frame(spark, rows).withColumns({c: F.lit(c) for c in ("key_", "spans_", "span_", "texts_")})
    passages = substring_dedup.repeated_passages(docs.select("doc_id", "text"))
    left = substring_dedup.drop_passages(docs, passages)
    assert left.columns == docs.columns
    found = sorted((r["doc_id"] or -1, r["text"]) for r in left.collect())
    whole = sorted((k or -1, t) for k, t in rows)
    assert len(found) == len(whole)
    for (key, text), (_, before) in zip(found, whole):
        if key in (-1, 0, 3):  # the first holder keeps it; key 3 has two texts
            assert text == before or key == 0
        else:
            assert len(text) < len(before) - 80
    assert {r["key_"] for r in left.collect()} == {"key_"}


def test_empty_tables(spark):
    none = frame(spark, [])
    assert substring_dedup.repeated_passages(none).collect() == []
    assert substring_dedup.drop_passages(none, substring_dedup.repeated_passages(none)).collect() == []
    assert quality.judge(none, [])[0].collect() == []
    model = language_id.fit_prototypes(none.withColumn("lang", F.lit("en")))
    assert none.select(language_id.predict_language(F.col("text"), model)).collect() == []
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert quality.fit_rules(none, labels) == []
    net = toxicity.fit_network(none.withColumn("lang", F.lit("en")), labels)
    assert none.select(toxicity.toxicity_score(F.col("text"), net)).collect() == []


def test_a_key_with_many_documents_counts_once(spark, monkeypatch):
    rng = random.Random(2)
    good = [(i, ". ".join(prose(rng, 12) for _ in range(10))) for i in range(40)]
    bad = [(100 + i, " ".join("# $ %" for _ in range(80))) for i in range(40)]
    docs = frame(spark, good + bad + [bad[0]] * 500)
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad], "doc_id bigint, quality int")
    seen = []
    learn = quality.learn_rules
    monkeypatch.setattr(quality, "learn_rules", lambda values, bad, **o: seen.append(len(bad)) or learn(values, bad, **o))
    quality.fit_rules(docs, labels)
    assert seen == [80]


@pytest.mark.parametrize("rows_per_task", [7, 1000])
def test_ranks(spark, rows_per_task):
    rng = random.Random(3)
    rows = [(rng.choice("aaab") if i else None, i) for i in range(200)]
    df = stored(spark.createDataFrame(rows, "g string, u bigint").where("g IS NOT NULL"))
    ranked = with_rank(df, "g", "u", "r", rows_per_task).collect()
    for g in "ab":
        own = sorted(r["r"] for r in ranked if r["g"] == g)
        assert own == list(range(sum(x == g for x, _ in rows)))


def test_pages_blocked_by_their_canonical_url_alone(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.net/x?q=1"), (2, "https://www.a.net/x/"), (3, "http://a.net/y"), (4, None), (5, "http://m.a.net/x#t")],
        "page_id int, url string",
    )
    rules = spark.createDataFrame([("net", "/y", "allow")], "host string, path string, verdict string")
    judged = filter_urls(pages, rules, pages.where("page_id = 1").select("url")).collect()
    assert {r["page_id"]: r["verdict"] for r in judged} == {1: "block", 2: "block", 3: "allow", 4: "allow", 5: "block"}


def test_near_duplicates_with_clashing_columns(spark):
    rng = random.Random(4)
    text = prose(rng, 80)
    rows = [(1, text), (2, text + " end"), (2, text + " end"), (None, prose(rng, 50)), (4, None), (5, "")]
    docs = frame(spark, rows).withColumns({c: F.lit(c) for c in ("key_", "many_", "kept_", "digest_")})
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "5", "None"]
    assert {r["kept_"] for r in kept.collect()} == {"kept_"}
    assert corpus_pipeline.near_duplicates(spark, docs.limit(0), "").collect() == []
