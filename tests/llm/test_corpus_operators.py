"""Operators over the whole corpus, against brute force."""

import multiprocessing.pool
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from veclode.llm import jaccard_join, packing, queries, sharding, substring_dedup
from veclode.llm.components import components

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


# --- packing --------------------------------------------------------------------------


def odd_texts(n=400):
    rng = random.Random(1)
    parts = list(" \t\n\x0b\x1c\x1d\x85\xa0aAbZé'ſß!|1٣İ𝒳×÷") + ["<|endoftext|>", "'re", "e\u0301", "Word, "]
    return [None, ""] + ["".join(rng.choices(parts, k=rng.randrange(30))) for _ in range(n)]


def test_tokenizer_equals_the_library():
    texts = [t or "" for t in odd_texts(3000)]
    plain = tokenizers.Tokenizer.from_file(PATH)
    got = packing.WordTokenizer(PATH)([t.encode() for t in texts])
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text


def test_words_are_cut_as_the_pattern_cuts_them():
    rng = random.Random(7)
    alphabet = ["'", "s", "t", "re", "ll", "ve", "m", "d", "a", " ", "1", "22", "!", "\n", "é", "--", "'s", "'re"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(12))).encode() for _ in range(4000)]
    words, begins = packing._cut(texts)
    words = words.to_pylist()
    for i, text in enumerate(texts):
        assert words[begins[i] : begins[i + 1]] == packing._UNIT.findall(text), text


def test_tokenizer_forgets(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    texts = [b"one two three", b"four five, six", b"one seven"]
    whole = packing.WordTokenizer(PATH)
    plain = tokenizers.Tokenizer.from_file(PATH)
    for t in texts * 2:
        assert np.frombuffer(whole([t])[0], "<u4").tolist() == plain.encode(t.decode(), add_special_tokens=False).ids


def test_pack(spark):
    rng = random.Random(2)
    texts = odd_texts(60) + ["word " * rng.randrange(200) for _ in range(60)] + ["same"] * 40
    rows = packing.pack(frame(spark, texts), PATH, size=128, unit=4).collect()
    plain = tokenizers.Tokenizer.from_file(PATH)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(range(len(texts)))
    for i, text in enumerate(texts):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            part = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert zlib.crc32(part) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    for group in sequences.values():
        at = 0
        for r in sorted(group, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 128
    least = sum(r["length"] for r in rows) / 128
    assert len(sequences) <= 1.1 * least + 2
    assert packing.pack(frame(spark, []), PATH).collect() == []


def test_patterns_hold_every_piece_once():
    rng = random.Random(3)
    for _ in range(20):
        histogram = {s: rng.randrange(1, 80) for s in rng.sample(range(1, 65), rng.randrange(1, 30))}
        patterns = packing.whole_patterns(histogram, 64)
        held = Counter()
        for pattern, times in patterns.items():
            assert sum(pattern) <= 64
            for s in pattern:
                held[s] += times
        assert held == Counter(histogram)
        sizes = np.array(sorted(histogram))
        wanted = np.array([histogram[s] for s in sizes.tolist()], float)
        shapes, used = packing.fractional_patterns(sizes, wanted, 64)
        assert np.allclose(used @ shapes, wanted) and (shapes @ sizes <= 64).all()
        plain = packing.best_fit([s for s, n in histogram.items() for _ in range(n)], 64)
        assert used.sum() <= len(plain) * 1.001
        assert sum(patterns.values()) <= used.sum() + len(sizes)


def test_many_lengths_end_in_a_process_that_runs_spark(spark):
    """Over 200 steps, so that the basis is inverted anew; a blocked solver would not return."""
    rng = random.Random(5)
    histogram = {s: rng.randrange(1, 60) for s in range(2, 252)}
    spark.range(1000).selectExpr("sum(id)").collect()
    with multiprocessing.pool.ThreadPool(1) as pool:
        patterns = pool.apply_async(packing.whole_patterns, (histogram, 256)).get(timeout=120)
    held = Counter()
    for pattern, times in patterns.items():
        assert sum(pattern) <= 256
        for size in pattern:
            held[size] += times
    assert held == Counter(histogram)
    assert sum(patterns.values()) <= 1.03 * sum(s * n for s, n in histogram.items()) / 256 + 1


def test_inverse_by_row_operations():
    rng = np.random.default_rng(6)
    matrix = rng.integers(-3, 4, (40, 40)).astype(float)
    assert np.allclose(packing._inverted(matrix) @ matrix, np.eye(40), atol=1e-6)


def test_knapsack_is_best():
    rng = random.Random(4)
    for _ in range(50):
        sizes = np.array(sorted(rng.sample(range(1, 12), 4)))
        prices = np.array([rng.random() for _ in sizes])
        worth, pattern = packing.best_pattern(sizes, prices, 17)
        best = [0.0] * 18
        for u in range(1, 18):
            best[u] = max([best[u - 1]] + [best[u - s] + p for s, p in zip(sizes, prices) if s <= u])
        assert abs(worth - best[17]) < 1e-9 and abs(pattern @ prices - worth) < 1e-9 and pattern @ sizes <= 17


# --- sharding -------------------------------------------------------------------------


def test_shards(spark):
    texts = [None, "", "é"] + [f"t{i % 50}" for i in range(1200)]
    rows = [(i % 1000, t) for i, t in enumerate(texts)] + [(None, "n")] * 300
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sharding.shard(docs, shards=7).collect()
    assert len(got) == len(rows)
    counts = Counter(r["shard"] for r in got)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(counts[s]))
    expected = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == expected
    assert sharding.shard(docs.limit(0)).collect() == []


def test_overflow_goes_clockwise():
    counts = {c: 1 + c % 5 for c in range(0, 1000, 3)}
    runs = sharding.walk(counts, 6, 4, 1000)
    around = sharding.ring(6, 4, 1000)
    used = Counter()
    bounds = sharding.bounds(sum(counts.values()), 6)
    for cell, first, last, shard, slot in runs:
        assert slot == used[shard]
        ahead = [s for c, s in around if c >= cell] + [s for c, s in around if c < cell]
        passed = ahead[: ahead.index(shard)]
        assert all(used[s] == bounds[s] for s in passed)  # only full shards are passed by
        used[shard] += last - first + 1
    assert [used[s] for s in range(6)] == bounds


def test_a_new_shard_moves_few():
    counts = {c: 10 for c in range(0, sharding.CELLS, 16)}
    place = lambda n: {(c, i): s for c, a, b, s, _ in sharding.walk(counts, n, 64) for i in range(a, b + 1)}
    before, after = place(24), place(25)
    assert sum(before[k] != after[k] for k in before) < 0.1 * len(before)


# --- Jaccard --------------------------------------------------------------------------


def plain_components(rows):
    def shingles(text):
        w = [x.decode() for x in jaccard_join.split_words((text or "").encode())]
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            c = len(a & sets[j])
            if c and 100 * c >= 75 * (len(a) + len(sets[j]) - c):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        least[find(i)].append(key)
    return Counter((key, len(s), min(least[find(i)])) for i, ((key, _), s) in enumerate(zip(rows, sets)))


def near_copies(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["The", "of"]
    rows = [None, "", " \n", "one", "ONE", "a b c d", "a b c d e", "A B C D E"]
    for _ in range(12):
        base = rng.choices(words, k=rng.randrange(6, 70))
        for _ in range(rng.choice([1, 2, 6, 15])):
            base = list(base)
            for _ in range(rng.randrange(3)):
                base[rng.randrange(len(base))] = rng.choice(words)
            rows.append(" ".join(base))
            rows.append(" ".join(base[: len(base) - rng.randrange(4)]))
    rng.shuffle(rows)
    return list(enumerate(rows)) + [(2, rows[2]), (2, rows[5])]


@pytest.mark.parametrize("seed, block", [(1, 1000), (2, 5), (3, 2)])
def test_jaccard(spark, monkeypatch, seed, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
    rows = near_copies(seed)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, CLS string")
    got = jaccard_join.jaccard_components(docs.repartition(5)).collect()
    assert Counter(map(tuple, got)) == plain_components(rows)


def test_jaccard_of_nothing(spark):
    assert jaccard_join.jaccard_components(frame(spark, [])).collect() == []
    got = jaccard_join.jaccard_components(frame(spark, [None, ""])).collect()
    assert sorted(map(tuple, got)) == [(0, 0, 0), (1, 0, 1)]


def test_derived_answers_equal_counted_ones():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 60, 100).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(100) < 0.9], rng.integers(0, 1 << 60, 5).astype(np.uint64)])) for _ in range(60)]
    got = jaccard_join.link_sets(sets, np.ones(60, bool), np.arange(60))
    for i in range(60):
        for j in range(i):
            c = len(np.intersect1d(sets[i], sets[j]))
            if 7 * c >= 3 * (len(sets[i]) + len(sets[j])):
                assert got[i] == got[j]


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(50, 40), (40, 45), (60, 60), (50, 40), (99, 5)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a int, b int")).collect()))
    assert got == {**{i: 0 for i in range(31)}, 99: 0, 40: 40, 45: 40, 50: 40, 60: 60}


# --- substring dedup ------------------------------------------------------------------


def prose(rng, n):
    return " ".join("".join(rng.choices("abcdefghé", k=rng.randrange(2, 9))) for _ in range(n))


def test_chunks_cover_texts_and_resist_shifts():
    rng = random.Random(6)
    texts = [prose(rng, 200).encode(), b"", ("x" * 5000).encode(), "é".encode() * 3000, b"a"]
    doc, first, at, starts, joined, _, inside = substring_dedup.chunk_block(texts)
    for d, text in enumerate(texts):
        own = [(a, b) for x, a, b in zip(doc, first, at) if x == d]
        assert b"".join(joined[a:b] for a, b in own) == text
        assert not any(inside[a] for a, _ in own)
    cut = lambda t: [j[a:b] for _, f, e, _, j, _, _ in [substring_dedup.chunk_block([t])] for a, b in zip(f, e)]
    old, new = Counter(cut(texts[0])), Counter(cut(b"inserted " + texts[0]))
    assert sum((old - new).values()) <= 3


def test_repeated_passages(spark):
    rng = random.Random(7)
    shared = prose(rng, 60)
    texts = [f"{prose(rng, 40)} {shared} {prose(rng, 30)}" for _ in range(25)]
    clean = [prose(rng, 100) for _ in range(25)] + [None, "", "\n".join([prose(rng, 30)] * 3)]
    docs = frame(spark, texts + clean)
    found = substring_dedup.repeated_passages(docs).collect()
    assert {r["doc_id"] for r in found} == set(range(25))
    for r in found:
        place = texts[r["doc_id"]].index(shared)
        assert place - 1 <= r["start"] and r["stop"] <= place + len(shared) + 1
    kept = {r["doc_id"] for r in found if r["kept"]}
    assert 0 in kept and len(kept) < 5  # others may keep a chunk at the passage's edge
    assert {r["doc_id"] for r in found if not r["kept"]} == set(range(1, 25))
    shorter = {r["doc_id"]: r["text"] for r in substring_dedup.drop_passages(docs, substring_dedup.repeated_passages(docs)).collect()}
    assert shorter[0] == texts[0] and all(shorter[25 + i] == t for i, t in enumerate(clean))
    assert all(len(shorter[i]) < len(texts[i]) - 80 for i in range(1, 25))


def test_first_holder_with_many_lesser_ids(spark):
    rng = random.Random(17)
    shared = prose(rng, 60)
    _, first, at, _, joined, _, _ = substring_dedup.chunk_block([shared.encode()])
    parts = [joined[a:b].decode() for a, b in zip(first, at)]
    # lesser documents hold one chunk each, with the bytes before it that make its start
    small = [i for i in range(1, len(parts) - 1) if len(parts[i].split()) < 8][::2]
    texts = [f"{prose(rng, 9)} {''.join(parts[:i])[-16:]}{parts[i]}{prose(rng, 9)}" for i in small]
    holder = len(texts)
    texts += [f"{prose(rng, 20)} {shared} {prose(rng, 20)}" for _ in range(3)]
    docs = frame(spark, texts)
    passages = substring_dedup.repeated_passages(docs)
    found = passages.collect()
    assert sorted(r["doc_id"] for r in found) == [holder, holder + 1, holder + 2]
    inner = "".join(parts[2:-1])  # a chunk or so at either end may take in what surrounds it
    for r in found:
        text = texts[r["doc_id"]]
        place = text.index(inner)
        assert r["start"] <= place and r["stop"] >= place + len(inner)  # the passage is not broken up
        assert r["kept"] == (r["doc_id"] == holder) == (not r["dropped"])
        assert r["first_key"] == holder  # not a document that holds one chunk of it
    left = {r["doc_id"]: r["text"] for r in substring_dedup.drop_passages(docs, passages).collect()}
    assert [left[i] for i in range(holder + 1)] == texts[: holder + 1]
    assert all(inner not in left[i] and len(left[i]) <= len(texts[i]) - len(inner) for i in (holder + 1, holder + 2))


def test_periodic_passages(spark):
    rng = random.Random(18)
    parts = ["word", "é", "no and", "hello there"] + [prose(rng, 1) for _ in range(12)]
    shared = [" ".join([part] * (60 // len(part.split()))) for part in parts]
    texts = [f"{prose(rng, 20 + 7 * i)} {run} {prose(rng, 20)}" for i in range(2) for run in shared]
    found = {r["doc_id"]: r for r in substring_dedup.repeated_passages(frame(spark, texts)).collect()}
    for i, text in enumerate(texts):
        run = shared[i % len(shared)]
        if len(run) >= 300:
            assert i in found, run
            assert text.index(run) - 1 <= found[i]["start"] and found[i]["stop"] <= text.index(run) + len(run) + 1


# --- pipeline -------------------------------------------------------------------------


def test_pipeline(spark, tmp_path):
    rng = random.Random(8)
    item = " ".join(f"item{i}" for i in range(30))
    good = lambda: " ".join(rng.choice(["the", "of"]) + f" w{rng.randrange(3000)}" for _ in range(60))
    copied = good()
    texts = [good() for _ in range(30)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    rows += [(100 + i, copied + f" end{i}", "en", "s", 1) for i in range(4)]  # one stays
    rows += [(200, f"{good()} {item}", "en", "s", 1), (201, "short", "en", "s", 1), (202, None, None, None, None)]
    rows += [(203, good() + " password=abcdefgh1", "en", "s", 1), (203, rows[0][1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    labels = [(i, 1, 0) for i in range(30)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = docs
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, got, str(tmp_path))
        assert got.columns == docs.columns
        kept.append(sorted(r["doc_id"] for r in got.collect()))
    start = [*range(30), *range(100, 104), 200, 203, 203]
    assert kept[0] == sorted(start)
    assert kept[1] == sorted([*range(30), 100, 200, 203])
    assert kept[2] == kept[3] == sorted([*range(30), 100, 203])
    masked = [r for r in got.collect() if r["doc_id"] == 203][0]
    assert masked["text"].endswith(" [SECRET]") and masked["n_chars"] == len(masked["text"])
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == set(kept[3])


def test_queries_keep_every_row(spark):
    folder = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{folder}/documents.parquet").count()
    for name in ("op3_secret_scan", "op5_quality_rules", "op7_toxicity", "op8_language_id", "op10_sharding"):
        df = queries.queries()[name](spark, folder)
        assert df.count() == n == df.select("doc_id").distinct().count()
    assert queries.op4_substring_dedup(spark, folder).where(F.col("stop") <= F.col("start")).isEmpty()
