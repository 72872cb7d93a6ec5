"""Which sets the Jaccard join takes for candidates."""

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from veclode.llm import jaccard_join


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_large_sets_that_share_one_shingle_are_no_candidates(spark):
    words = [[f"w{i}x{k}" for k in range(200)] for i in range(12)]
    others = [w[::-1] for w in words] + [w[::2] + w[1::2] for w in words]  # no word is as rare as the next
    for i, own in enumerate(words):  # a chain: five words of each stand in the next
        own[10:15] = [f"s{i}x{k}" for k in range(5)]
        own[50:55] = [f"s{i - 1}x{k}" for k in range(5)]
    copy = words[3][:-4] + ["other"] * 4
    docs = frame(spark, [" ".join(w) for w in [*words, copy, *others]])
    ranks = jaccard_join.word_ranks(docs, "text")
    edges = {frozenset(map(bytes, r)) for r in jaccard_join._candidates(docs, "text", ranks).collect()}
    names = [jaccard_join.word_class([x.encode() for x in w]) for w in (words[3], copy)]
    assert edges == {frozenset(names)}
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs).collect()}
    assert found == {i: 3 if i == 12 else i for i in range(37)}


def batches(rows, step):
    kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
    for i in range(0, len(rows), step):
        columns = [pa.array(c, k) for c, k in zip(zip(*rows[i : i + step]), kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["token", "n", "late", "cls"])


class Lists:
    """Stands for the lists and keeps the function that makes edges of them."""

    def repartition(self, *names):
        return self

    sortWithinPartitions = repartition

    def mapInArrow(self, function, schema):
        raise LookupError(function)


@pytest.mark.parametrize("seed", range(4))
def test_sets_that_share_lists_enough_are_connected(monkeypatch, seed):
    rng = random.Random(seed)
    monkeypatch.setattr(jaccard_join, "_texts", lambda *a: Lists())
    with pytest.raises(LookupError) as caught:
        jaccard_join._candidates(None, "text", np.zeros(4, np.uint8))
    edges = caught.value.args[0]
    for _ in range(100):
        monkeypatch.setattr(jaccard_join, "WINDOW", rng.choice([1, 2, 8]))
        monkeypatch.setattr(jaccard_join, "LONG_LIST", rng.choice([5, 20, 20_000]))
        sizes = [rng.choice([3, 10, 40, 50, 70, 100, 130]) for _ in range(rng.randrange(2, 30))]
        rows = []
        for token in range(-3, rng.randrange(1, 9)):
            held = rng.choice([0.2, 0.9])
            for i, n in enumerate(sizes):
                copies = rng.choice([1, 2]) * (rng.random() < held)
                rows += [(token, n, rng.random() < 0.3, b"%03d" % i)] * copies
        rows.sort()
        expected, shared, needed = Counter(), Counter(), {}
        for _, own in itertools.groupby(rows, key=lambda r: r[0]):
            for x, y in itertools.combinations(dict.fromkeys(own), 2):
                if not x[2] and 4 * x[1] >= 3 * y[1]:
                    expected[x[3], y[3]] += 1
        for batch in edges(batches(rows, rng.choice([1, 7, 50, 10_000]))):
            for r in batch.to_pylist():
                pair = r["a"], r["b"]
                shared[pair] += r["shared"]
                needed[pair] = min(r["need"], needed.get(pair, jaccard_join.SHARED))
        root = {b"%03d" % i: b"%03d" % i for i in range(len(sizes))}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in (p for p in shared if shared[p] >= needed[p]):
            root[find(a)] = find(b)
        for (a, b), n in expected.items():
            if n >= jaccard_join.least_shared(sizes[int(a)]):
                assert find(a) == find(b)
        if jaccard_join.WINDOW == 8 and jaccard_join.LONG_LIST == 20_000 and len(sizes) <= 8:
            assert all(shared[p] == n for p, n in expected.items())  # copies are counted once
