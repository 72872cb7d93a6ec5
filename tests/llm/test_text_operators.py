"""Operators that judge documents one by one, against plain restatements."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from veclode.llm import decontamination, language_id, quality, secret_scan, toxicity, url_filter

DOCS = "doc_id bigint, text string, lang string, TEXT_ string"
ODD = [None, "", " \n\t ", "é", "one", "a b c d", "İstanbul ſ K", "x" * 5000]


def frame(spark, texts, first=0):
    rows = [(first + i, t, "en", "clash") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- decontamination ------------------------------------------------------------------


def plain_words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def plain_hits(text, items, length=13):
    words, hit, named = plain_words(text), set(), set()
    for item, t in items:
        w = plain_words(t)
        for i in range(max(1, len(w) - length + 1) if w else 0):
            win = w[i : i + length]
            for p in range(len(words) - len(win) + 1):
                if words[p : p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    named.add(str(item))
    return len(words), len(hit), sorted(named)


def benchmark_case(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "And", "ét", "x1", "run-on", "Zed"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 13, 15, 30]))) for i in range(12)] + [(3, text(20)), (99, None)]
    texts = ODD + [text(rng.randrange(60)) for _ in range(30)]
    texts += [f"{text(5)}, {t}! {text(4)}" for _, t in items if t]
    return items, texts + texts[-2:]


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_decontamination(spark, block_bytes):
    items, texts = benchmark_case(1)
    docs = frame(spark, texts)
    table = spark.createDataFrame(items, "item_id bigint, text string")
    got = by_id(decontamination.decontaminate(docs, table, block_bytes=block_bytes))
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        row = got[i]
        assert (row["n_words"], row["n_hit"], row["items"]) == plain_hits(text, items), text
        assert sum(s["stop"] - s["start"] for s in row["spans"]) >= row["n_hit"]


def test_decontamination_of_empty_tables(spark):
    docs = frame(spark, ["a b", None])
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert {r["n_hit"] for r in decontamination.decontaminate(docs, none).collect()} == {0}
    items = spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert decontamination.decontaminate(docs.limit(0), items).collect() == []


def test_no_window_begins_before_the_segment(spark):
    items = [(1, "no no thanks"), (2, "all of it")]
    texts = ["no thanks", "x no no thanks y", "all of it"]
    docs = frame(spark, texts).coalesce(1)  # one segment
    got = by_id(decontamination.decontaminate(docs, spark.createDataFrame(items, "item_id bigint, text string")))
    for i, text in enumerate(texts):
        assert (got[i]["n_words"], got[i]["n_hit"], got[i]["items"]) == plain_hits(text, items), text


def test_segments_split_long_lists(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "TRIED", 3)
    segment = decontamination._Segment(
        np.array([0, 1]), np.array([4, 2]), np.array([0, 2, 4, 6, 1, 5]), 2
    )
    found = segment.starts(np.array([[1, 0]] * 5), np.array([[1, 0]] * 5), np.array([2] * 5))
    pairs = {(int(w), int(s)) for ws, ss in found for w, s in zip(ws, ss)}
    assert pairs == {(w, s) for w in range(5) for s in (0, 4)}


def test_proximity(spark):
    docs = frame(spark, ["red x x blue", "red x x x blue", "blue red", None, "red"])
    found = decontamination.find_near(docs, [["Red", "blue"], []], 3)
    assert sorted(r["doc_id"] for r in found.collect()) == [0, 2]


# --- secrets --------------------------------------------------------------------------


def plain_secrets(text):
    assign = r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    found = []
    for kind, pattern, ok in (
        ("assign", assign, lambda m: len(m[1]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ):
        found += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text or "") if ok(m)]
    return sorted(found, key=lambda s: (s[1], secret_scan.KINDS.index(s[0])))


def secret_texts():
    rng = random.Random(2)
    parts = ["password", "PassWD=", "toKen", "api_key", "APIKEY : ", "secret", "=", '"', "' ", ": ", "AKIA",
             "ABCD1234EFGH5678", "deadbeef" * 3, "abc", "İ", "ſecret=", "K", "é", "\n", "abcdef", "=="]
    return ODD + ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(400)]


def test_secrets_match_plain_patterns(spark):
    texts = secret_texts()
    spans = secret_scan.secret_spans(F.col("text"))
    got = by_id(frame(spark, texts).select("doc_id", spans.alias("s")))
    for i, text in enumerate(texts):
        base = [tuple(s) for s in got[i]["s"] if s["kind"] in secret_scan.BASE_KINDS]
        assert base == plain_secrets(text), text


def test_embedded_checksums():
    body = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    good = f"x ghp_{body}{secret_scan.base62_checksum(body)} y"
    assert ("github", 2, 42) in secret_scan.find_secrets(good)
    assert secret_scan.find_secrets(f"x ghp_{body}000000 y") == []
    assert [s[0] for s in secret_scan.find_secrets(f"npm_{body}{secret_scan.base62_checksum(body)}")] == ["npm"]


def test_masking(spark):
    docs = frame(spark, ["é token=abcdefgh, ok", "clean", None, "password=" + "a" * 24 + " end"])
    got = by_id(docs.withColumn("text", secret_scan.mask_secrets(F.col("text"))))
    assert [got[i]["text"] for i in range(4)] == ["é [SECRET], ok", "clean", None, "[SECRET] end"]


# --- quality --------------------------------------------------------------------------


def plain_stats(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            inside.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


def test_stats(spark):
    rng = random.Random(3)
    parts = ["a", "b ", "é ", "\n", "# ", "x y z ", "|", "\x1c", "\u2003", "\x85", "the cat sat\n"]
    texts = ODD + ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(200)]
    got = by_id(frame(spark, texts).select("doc_id", quality.quality_stats(F.col("text")).alias("s")))
    for i, text in enumerate(texts):
        assert tuple(got[i]["s"][n] for n in quality.STATS[:5]) == plain_stats(text), text


def test_rules_find_thresholds():
    rng = np.random.default_rng(0)
    table = {n: rng.random(3000) for n in quality.FEATURES}
    bad = (table["symbols"] > 0.8) | ((table["upper"] > 0.7) & (table["digits"] < 0.3))
    rules = quality.learn_rules(table, bad)
    covered = np.any([r.covers(table) for r in rules], axis=0)
    assert bad[covered].mean() > 0.97 and covered[bad].mean() > 0.85
    assert quality.learn_rules(table, np.zeros(3000, bool)) == []


def quality_tables(spark):
    rng = random.Random(4)
    good = lambda: " ".join(f"w{rng.randrange(500)}" for _ in range(80))
    texts = [good() if i % 4 else " ".join(x + "***" for x in good().split()) for i in range(400)]
    labels = [(i, int(i % 4 > 0)) for i in range(300)] + [(None, 0), (5, None), (7, 1)]
    return frame(spark, texts), spark.createDataFrame(labels, "doc_id bigint, quality int")


def test_fitted_rules_judge_new_rows(spark):
    docs, labels = quality_tables(spark)
    rules = quality.fit_rules(docs, labels)
    assert rules and all(rules[0].conditions)
    kept = {r["doc_id"] for r in quality.keep_good(docs, rules).collect()}
    assert kept == {i for i in range(400) if i % 4}
    assert quality.keep_good(docs, rules).columns == docs.columns
    judged, name = quality.judge(frame(spark, ODD), rules)
    assert not any(r[name]["kept"] for r in judged.collect())
    assert quality.fit_rules(docs, labels.where("quality = 1")) == []


# --- language -------------------------------------------------------------------------


def test_languages(spark):
    rng = random.Random(5)
    words = {"aa": ["der", "und", "schön", "nicht"], "bb": ["que", "año", "por", "mucho"]}
    rows = [(i, " ".join(rng.choices(words[x], k=30)), x) for i, x in enumerate(["aa", "bb"] * 40)]
    rows += [(900, "der", None), (901, None, "aa"), (902, "", "bb")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit_prototypes(docs.where("doc_id < 20 OR doc_id >= 900"))
    found = language_id.predict_language(F.col("text"), model).alias("p")
    got = {r["doc_id"]: r for r in docs.select("doc_id", "lang", found).collect()}
    assert all(r["p"]["lang_pred"] == r["lang"] for i, r in got.items() if i < 900)
    assert all(0 <= r["p"]["score"] <= 1 for r in got.values())
    odd = frame(spark, [None, "", "12 34!", "數"])
    marks = [r["p"]["lang_pred"] for r in odd.orderBy("doc_id").select(found).collect()]
    assert marks[:3] == ["und"] * 3 and marks[3] in ("aa", "bb")
    empty = language_id.fit_prototypes(docs.limit(0))
    assert {r["p"]["lang_pred"] for r in docs.select(language_id.predict_language(F.col("text"), empty).alias("p")).collect()} == {"und"}


def test_scores_are_cosines_of_bundled_vectors():
    texts = ["Der Hund schläft.", "perro y gato", "", None, "ab"]
    vectors = np.random.default_rng(0).normal(size=(2, language_id.DIM))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    got, has = language_id.cosines(texts, vectors)
    assert has.tolist() == [True, True, False, False, True]
    for text, row in zip(texts, got):
        letters = re.sub(r"[^a-zäñ]+", " ", f" {text} ".lower()) if text else " "
        total = np.zeros(language_id.DIM)
        counts = Counter(letters[i : i + 3] for i in range(len(letters) - 2))
        for gram, n in counts.items():
            a, b, c = (language_id.letter_vector(ord(x)) for x in gram)
            total += n * (np.roll(a, 2) * np.roll(b, 1) * c)
        norm = np.linalg.norm(total) or 1
        assert np.allclose(row, vectors @ total / norm, atol=1e-3)


# --- toxicity -------------------------------------------------------------------------


def toxic_tables(spark):
    rng = random.Random(6)
    clean = [f"word{i}" for i in range(200)]
    texts, labels = [], []
    for i in range(800):
        words = rng.choices(clean, k=30)
        if bad := i % 5 == 0:
            words[rng.randrange(30)] = f"vile{rng.randrange(30)}"
        texts.append(" ".join(words))
        labels.append((i, int(bad)))
    return frame(spark, texts), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_a_long_text_does_not_end_the_sample(spark):
    texts = ["word " * 100 if i % 20 == 0 else f"word w{i}" for i in range(100)]
    docs = frame(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id bigint, toxic int")
    short = {i for i in range(100) if i % 20 and zlib.crc32(str(i).encode()) % 4 != 2}
    names = ("doc_id", "text", "lang", "toxic")
    assert {r[0] for r in toxicity.sample(docs, labels, *names, 1000, 99)} <= short
    texts[::20] = ["word " * 1000] * 5
    rows = toxicity.sample(frame(spark, texts), labels, *names, 1000, 999)
    assert {r[0] for r in rows} == short
    few = [toxicity.sample(d, labels, *names, 10, 10_000) for d in (docs, docs.repartition(7, "text"))]
    assert len(few[0]) == 10 and [r[0] for r in few[0]] == [r[0] for r in few[1]]


def test_toxicity_on_rows_held_out(spark):
    docs, labels = toxic_tables(spark)
    net = toxicity.fit_network(docs, labels)
    score = toxicity.toxicity_score(F.col("text"), net).alias("score")
    rows = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h"), score).collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    right = [(r["score"] >= 0.3) == (r["doc_id"] % 5 == 0) for r in rows if r["h"]]
    assert len(right) > 100 and np.mean(right) > 0.95
    assert all(r["score"] < 0.3 for r in frame(spark, [None, "", "word1"]).select(score).collect())
    assert toxicity.fit_network(docs, labels.where("toxic = 0")) is None
    assert {r[0] for r in docs.select(toxicity.toxicity_score(F.col("text"), None)).collect()} == {0.0}


def test_toxicity_learns_from_all_labelled_rows(spark):
    docs, labels = toxic_tables(spark)
    net = toxicity.fit_network(docs, labels, max_rows=100)
    again = toxicity.fit_network(docs.repartition(7, "text"), labels, max_rows=100)
    assert np.array_equal(net.embed, again.embed) and net.shift == again.shift
    score = toxicity.toxicity_score(F.col("text"), net).alias("score")
    rows = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("h"), score).collect()
    right = [(r["score"] >= 0.3) == (r["doc_id"] % 5 == 0) for r in rows if r["h"]]
    assert len(right) > 100 and np.mean(right) > 0.95
    # 100 rows hold at most 20 of the 30 toxic words
    known, every = toxicity._Buckets(), toxicity.fit_network(docs, labels, max_rows=100, min_texts=1)
    assert sum(every.embed[known[b"vile%d" % i] >> toxicity.SHIFT].any() for i in range(30)) > 24
    assert toxicity.fit_network(docs, labels.where("toxic = 0"), max_rows=100) is None


def test_tables_equal_convolutions():
    rng = np.random.default_rng(1)
    rows = [rng.integers(0, 1 << 30, n).astype(np.int32) for n in (0, 1, 2, 3, 9)]
    net = toxicity.train(rows, np.array([0, 1, 0, 1, 0]), epochs=2, min_texts=1)
    got = toxicity.Scorer(net).logits_of(rows)
    for row, logit in zip(rows, got):
        total = net.intercept
        for k, w in enumerate(toxicity.WIDTHS):
            x = np.concatenate([row, np.full(max(0, w - len(row)), toxicity.PADDING)]).astype(int)
            e = net.embed[x >> toxicity.SHIFT] + net.embed[x & toxicity.MASK]
            conv = sum(e[j : len(e) - w + 1 + j] @ net.filters[k][j] for j in range(w)) + net.bias[k]
            each = len(net.bias[k])
            total += np.maximum(conv.max(axis=0), 0) @ net.weights[k * each : (k + 1) * each]
        assert abs(total - logit) < 1e-3


# --- URLs -----------------------------------------------------------------------------


def test_urls(spark):
    urls = [
        "http://Sub.Example.ORG/es/x?y", "https://example.org/en/123", "http://example.org/en/2",
        "http://a.com/fr/1#z", "http://a.com/de/", "http://b.net/p/", "https://www.b.net/p?q=1",
        "http://b.net/q", None, "nothing", "http://", "x://h?://other/", "http://notexample.org/es/",
    ]
    expected = ["block", "block", "allow", "allow", "block", "block", "block", "allow", "allow",
                "allow", "allow", "allow", "allow"]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id int, url string, HOST string")
    rules = spark.createDataFrame(
        [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")], "host string, path string, verdict string")
    listed = spark.createDataFrame([("https://m.b.net/p/",), (None,)], "url string")
    got = {r["page_id"]: r for r in url_filter.filter_urls(pages, rules, listed).collect()}
    assert [got[i]["verdict"] for i in range(len(urls))] == expected
    assert (got[0]["host_"], got[0]["path"], got[0]["rule"]) == ("sub.example.org", "/es/x", "example.org/es/")
    assert (got[11]["host_"], got[11]["path"]) == ("h", "") and got[11]["rule"] is None
    bare = url_filter.filter_urls(pages, rules.limit(0)).collect()
    assert {r["verdict"] for r in bare} == {"allow"} and len(bare) == len(urls)
    assert url_filter.filter_urls(pages.limit(0), rules, listed).collect() == []


def test_bloom_has_no_false_negatives(spark):
    keys = spark.range(500).selectExpr("concat('k', id) AS key")
    asked = spark.range(5000).selectExpr("concat('k', id) AS key")
    passed = {r["key"] for r in url_filter.possible(asked, keys, 24).collect()}
    assert {f"k{i}" for i in range(500)} <= passed and len(passed) < 800


def test_digest_of_nothing():
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
