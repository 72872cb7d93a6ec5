"""What a task of the training-data operators holds."""

import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark import cloudpickle
from pyspark.sql import functions as F

from veclode.llm import jaccard_join, packing
from veclode.llm.quality import judge

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
TEXTS = [f"w{i} w{i % 7} w{i * 3} common Common" for i in range(500)] + [None, "", " "]


def counting(monkeypatch):
    """The function that counts words in a task."""

    def texts(docs, text, function, schema):
        raise LookupError(function)

    monkeypatch.setattr(jaccard_join, "_texts", texts)
    with pytest.raises(LookupError) as caught:
        jaccard_join.word_ranks(None, "text")
    return caught.value.args[0]


@pytest.mark.parametrize("limit", [None, 16])
def test_words_are_counted_in_little_memory(monkeypatch, limit):
    if limit:
        monkeypatch.setattr(jaccard_join, "COUNTED", limit)
    count = counting(monkeypatch)
    batches = [pa.record_batch([pa.array(TEXTS[a : a + 90])], ["text"]) for a in range(0, 503, 90)]
    tracemalloc.start()
    try:
        found = list(count(iter(batches)))
        assert tracemalloc.get_traced_memory()[1] < 16 << 20
    finally:
        tracemalloc.stop()
    sums = Counter()
    for batch in found:
        for bucket, n in zip(*(c.to_pylist() for c in batch.columns)):
            sums[bucket] += n
    expected = Counter()
    for text in TEXTS:
        words = {w.encode() for w in (text or "").lower().split()}
        expected.update({xxhash.xxh3_64_intdigest(w) % jaccard_join.WORD_BUCKETS for w in words})
    assert sums == expected
    assert list(count(iter([]))) == []


def test_operators_bound_their_batches_in_bytes(spark):
    docs = spark.range(3, numPartitions=1).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    for run in (lambda: judge(docs, []), lambda: jaccard_join.jaccard_components(docs)):
        spark.conf.unset(LIMIT)
        run()
        assert int(spark.conf.get(LIMIT).rstrip("b")) <= 8 << 20


def task_function(monkeypatch, build):
    """The function over texts that ``build`` gives to Spark."""

    def texts(docs, text, function, schema):
        raise LookupError(function)

    monkeypatch.setattr(jaccard_join, "_texts", texts)
    with pytest.raises(LookupError) as caught:
        build()
    return caught.value.args[0]


def test_tasks_get_word_ranks_in_little_memory(monkeypatch):
    ranks = np.zeros(jaccard_join.WORD_BUCKETS, np.uint8)
    words = sorted({w for t in TEXTS for w in (t or "").lower().encode().split()})
    hashes = jaccard_join.word_hashes(words, jaccard_join._Hashes())
    ranks[hashes & np.uint64(len(ranks) - 1)] = np.arange(len(words)) % 250 + 1
    post = task_function(monkeypatch, lambda: jaccard_join._candidates(None, "text", ranks))
    assert len(cloudpickle.dumps(post)) < 1 << 20
    (found,) = post(iter([pa.record_batch([pa.array(TEXTS)], ["text"])]))
    expected = []
    for text in TEXTS[:500]:
        own = jaccard_join.split_words(text.encode())
        listed, _ = jaccard_join.prefix(own, jaccard_join.word_hashes(own, jaccard_join._Hashes()), ranks)
        expected += listed.view(np.int64).tolist()
    assert found["token"].to_pylist() == expected


class Rows:
    """Stands for a DataFrame and keeps the function that it is given."""

    def __init__(self, docs):
        self.schema, self.function = docs.schema, None

    def __getitem__(self, name):
        return name

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):
        self.function = function
        return self


class Task:
    @staticmethod
    def get():
        return Task()

    def partitionId(self):
        return 0


def test_texts_are_cut_into_words_in_little_memory(spark, monkeypatch):
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    monkeypatch.setattr(packing, "TaskContext", Task)
    cut = packing.token_pieces(Rows(docs), path, 4096, 2, "doc_id", "text", False).function
    texts = ["a few common words, and it's these again " * 100] * 1500  # 6 MB
    batch = pa.record_batch([pa.array(range(1500)), pa.array(texts)], ["doc_id", "text"])
    packing._tokenizer(path)
    tracemalloc.start()
    try:
        before = tracemalloc.get_traced_memory()[0]
        rows = sum(b.num_rows for b in cut(iter([batch])))
        assert tracemalloc.get_traced_memory()[1] - before < 40 << 20
    finally:
        tracemalloc.stop()
    assert rows == 1500


def test_the_library_encodes_few_texts_at_once(monkeypatch):
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    monkeypatch.setattr(packing, "ENCODED", 2)
    few = packing.WordTokenizer(path)
    texts = [f"word{i} Wörd {i} it's \u4e2d\u6587{i} <|endoftext|>"[: 12 + i] for i in range(300)]
    expected = few.tokenizer.encode_batch(texts, add_special_tokens=False)
    found = few([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [e.ids for e in expected]
