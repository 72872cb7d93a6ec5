"""Exact n-gram Jaccard join by prefix lists and set relations.

A document's set holds its distinct shingles, in an order that puts those with rare words
first. Documents with the same words are one class, and classes are joined:

1. The first quarter of every set, and up to three shingles more, goes into index lists by
   shingle: two sets that are similar enough share one of these, large sets up to four. A list,
   sorted by set size, is read once. A set is paired with the last few of compatible size before
   it, and such pairs have the lists they share counted; where more are compatible, the run they
   form gives a star of candidate edges. Components of the stars and of the pairs that share
   lists enough hold every pair that can link.
2. The sets of a component are brought together in blocks of bounded size. In a block, one
   set's overlaps with all others are counted over full index lists; the next set's overlaps
   are derived from them by the shingles in which the two differ, if these are few.
3. A component of several blocks is joined in two rounds: every block with itself and with
   the first, then only sets outside the component's largest class so far against the rest.

The result does not depend on the order of shingles. Word frequencies are counted over all
documents into a table of fixed size; words that share a bucket share a rank.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veclode.llm.common import blocks, column, raw_bytes, row_ranges, stored
from veclode.llm.components import components
from veclode.session import bounded_batches

N = 5  # words in a shingle
WORD_BUCKETS = 1 << 24
BLOCK_SETS = 1000  # sets in a block, about
BLOCK_SHINGLES = 1_000_000  # shingles in a block, about
COUNTED = 1 << 20  # word buckets counted in a task before they are given out, about
SHARED = 4  # first shingles that large sets must share, at most
WINDOW = 8  # index sets that a set is paired with one by one in a list
LONG_LIST = 20_000  # postings of a list that a task holds, about

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_MIX = np.random.default_rng(9).integers(1 << 62, 1 << 63, N, dtype=np.uint64) * 2 + 1


class _Hashes(dict):
    """64-bit hashes of words, remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 100_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def split_words(text: bytes | None) -> list[bytes]:
    return text.translate(_LOWER).split() if text else []


def word_hashes(words: list[bytes], known: _Hashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """A hash for every run of ``N`` words; one for all of them if there are fewer."""
    if len(words) < N:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), len(words))] * bool(words), np.uint64)
    last = len(words) - N + 1
    h = hashes[:last] * _MIX[0]
    for k in range(1, N):
        h += hashes[k : last + k] * _MIX[k]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def word_class(words: list[bytes]) -> bytes | None:
    """Names the documents with exactly these words; none for no words."""
    return xxhash.xxh3_128_digest(b" ".join(words)) if words else None


def _texts(docs: DataFrame, text: str, function, schema: str) -> DataFrame:
    return docs.select(column(docs, text)).mapInArrow(function, schema)


def classes_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    """One row per document: ``key``, ``cls`` (null without words) and ``n_shingles``."""
    kind = docs.schema[key].dataType
    fields = T._parse_datatype_string("cls binary, n_shingles bigint").fields
    schema = T.StructType([T.StructField("key", kind), *fields])

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            names, sizes = [], []
            for text in raw_bytes(batch.column(1)):
                words = split_words(text)
                names.append(word_class(words))
                sizes.append(len(np.unique(shingle_hashes(words, word_hashes(words, known)))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.binary()), pa.array(sizes, pa.int64())],
                names=schema.names,
            )

    return docs.select(column(docs, key), column(docs, text)).mapInArrow(classify, schema)


def word_ranks(docs: DataFrame, text: str) -> np.ndarray:
    """For every word bucket the logarithm of its document frequency, in one byte."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mask = _Hashes(), np.uint64(WORD_BUCKETS - 1)
        buckets, counts, fresh = np.zeros(0, np.int32), np.zeros(0, np.int64), []

        def merge() -> None:
            nonlocal buckets, counts
            some, n = np.unique(np.concatenate([buckets[:0], *fresh]), return_counts=True)
            buckets, at = np.unique(np.concatenate([buckets, some]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(buckets)).astype(np.int64)
            fresh.clear()

        def give() -> Iterator[pa.RecordBatch]:
            for a in range(0, len(buckets), 100_000):
                part = slice(a, a + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets[part]), pa.array(counts[part].astype(np.int32))],
                    names=["bucket", "n"],
                )

        waiting = 0
        for batch in batches:
            for text in raw_bytes(batch.column(0)):
                hashes = word_hashes(split_words(text), known)
                fresh.append(np.unique((hashes & mask).astype(np.int32)))
                waiting += len(fresh[-1])
                if waiting > max(COUNTED // 4, len(buckets)):
                    merge()
                    waiting = 0
                    if len(buckets) > COUNTED:
                        yield from give()
                        buckets, counts = buckets[:0], counts[:0]
        merge()
        yield from give()

    counts = _texts(docs, text, count, "bucket int, n int").groupBy("bucket")
    rank = F.least(F.lit(255), F.round(8 * F.log2(F.sum("n"))) + 1).cast("short")
    found = counts.agg(rank.alias("rank")).toArrow()  # no more rows than buckets
    ranks = np.zeros(WORD_BUCKETS, np.uint8)
    ranks[found["bucket"].to_numpy()] = found["rank"].to_numpy()
    return ranks


def least_shared(n):
    """How many first shingles a set of ``n`` must share with a set of its own size or larger."""
    return np.clip(n // 32, 1, SHARED)


def prefix(words: list[bytes], hashes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, int]:
    """The shingles of a set that go into the lists, in order, and the size of the set.

    A partner with three quarters of the union in common shares at least three quarters of
    this set, hence k shingles among the first size - ceil(3/4 size) + k in any fixed order;
    here by the frequency of the rarest word, then by hash.
    """
    h = shingle_hashes(words, hashes)
    rank = np.zeros(len(h), np.uint8)
    if len(words) >= N:
        own = ranks[hashes & np.uint64(len(ranks) - 1)]
        rank = own[: len(h)]
        for k in range(1, N):
            rank = np.minimum(rank, own[k : len(h) + k])
    h, at = np.unique(h, return_index=True)
    n = len(h)
    return h[np.lexsort((h, rank[at]))[: n + least_shared(n) - -(-3 * n // 4)]], n


def index_length(n):
    """How many first shingles of a set of ``n`` can be the first few it shares with a set of its
    own size or larger: such a pair has at least 6/7 of the smaller set in common."""
    return n + least_shared(n) - -(-6 * n // 7)


def _edges(a: np.ndarray, b: np.ndarray, n: np.ndarray, shared: np.ndarray, names) -> list[pa.RecordBatch]:
    """Edges between rows with these names: a's set must share ``need`` lists with b's."""
    edges = pa.table(
        {
            "a": names.take(pa.array(a)),
            "b": names.take(pa.array(b)),
            "need": pa.array(least_shared(n[a]).astype(np.int32)),
            "shared": pa.array(shared.astype(np.int32)),
        }
    )
    counted = edges.group_by(["a", "b", "need"]).aggregate([("shared", "sum")])
    return counted.rename_columns(["a", "b", "need", "shared"]).to_batches()


def list_edges(lists: pa.RecordBatch) -> list[pa.RecordBatch]:
    """Edges of whole lists: token, n, late, cls, in this order.

    A set can link with the smaller ones in a list, if they hold the shingle among their index
    shingles and are not too small. ``WINDOW`` of these, the last before it, are paired with the
    set. If there are more, all from there to the set are joined to one star, whose edges need
    no counting.
    """
    if not lists.num_rows:
        return []
    token, codes = lists.column(0).to_numpy(), lists.column(3).dictionary_encode().indices.to_numpy()
    again = (token[1:] == token[:-1]) & (codes[1:] == codes[:-1])  # a copy from another task
    kept = np.flatnonzero(np.append(True, ~again))
    same = token[kept[1:]] == token[kept[:-1]]
    kept = kept[np.append(same, False) | np.append(False, same)]
    if not len(kept):
        return []
    token, names = token[kept], lists.column(3).take(pa.array(kept))
    n = lists.column(1).to_numpy()[kept].astype(np.int64)
    early = ~lists.column(2).to_numpy(zero_copy_only=False)[kept]
    rows, index = np.arange(len(token)), np.flatnonzero(early)
    before = np.cumsum(early) - early  # index sets before each row

    def nearby(k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k-th index set before each row, and whether the row can link with it."""
        at = index[np.maximum(before - k, 0)] if len(index) else rows
        return at, (before >= k) & (token[at] == token) & (4 * n[at] >= 3 * n)

    full = nearby(WINDOW + 1)[1]
    # whether an index set is in one star with the one before
    bounds = np.zeros(len(index) + 1, np.int64)
    np.add.at(bounds, before[full] - WINDOW, 1)
    np.add.at(bounds, (before + early)[full], -1)
    joined = np.cumsum(bounds[:-1]) > 0
    star = np.maximum.accumulate(np.where(joined, 0, np.arange(len(index))))
    # the star of each row; late rows are ends of one if they are full
    own = np.full(len(rows), -1)
    own[index] = star
    ends = full & ~early
    own[ends] = star[before[ends] - 1]
    starred = np.append(index[joined], rows[ends])
    a, b, shared = [index[own[starred]]], [starred], [np.full(len(starred), SHARED)]
    for k in range(1, WINDOW + 1):
        at, near = nearby(k)
        near &= own[at] != own
        a.append(at[near])
        b.append(rows[near])
        shared.append(np.ones(near.sum(), np.int64))
    return _edges(*map(np.concatenate, (a, b)), n, np.concatenate(shared), names)


def star_edges(part: pa.RecordBatch, last: tuple | None) -> tuple[list[pa.RecordBatch], tuple | None]:
    """Edges of a part of one list that is too long to be held: a star for every run of sets
    whose sizes are compatible from each to the next. ``last``: the last index set's size and
    the first set of its run, at the end of the part before; given for this part too."""
    n, early = part.column(1).to_numpy().astype(np.int64), ~part.column(2).to_numpy(zero_copy_only=False)
    names = part.column(3)
    if last is not None:  # it stands before the part
        n, early = np.append(last[0], n), np.append(True, early)
        names = pa.concat_arrays([last[1], names])
    place = np.arange(len(n))
    before = np.maximum.accumulate(np.where(early, place, -1))
    before = np.append(-1, before[:-1])
    near = (before >= 0) & (4 * n[before] >= 3 * n)
    first = np.maximum.accumulate(np.where(early & ~near, place, 0))
    rows = np.flatnonzero(near)
    found = _edges(first[before[rows]], rows, n, np.full(len(rows), SHARED), names)
    if early.any():
        end = int(np.flatnonzero(early)[-1])
        last = int(n[end]), names.slice(int(first[end]), 1)
    return found, last


def _candidates(docs: DataFrame, text: str, ranks: np.ndarray) -> DataFrame:
    """Candidate edges (a, b) whose components hold every pair that can link.

    Every pair that can link shares as many lists as its smaller set needs, or is in one star
    (see :func:`list_edges`). Chance pairs of large sets share one list, seldom two: without the
    count they would join most large sets of a large table to one component.
    """

    # few buckets have a rank: a worker process would hold the plain table several times over
    packed = zstandard.compress(ranks, 1)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = _Hashes(), set()
        ranks = np.frombuffer(zstandard.decompress(packed), np.uint8)
        for batch in batches:
            texts = raw_bytes(batch.column(0))
            for a, b in blocks(texts):
                lists, sizes, late, names = [], [], [], []
                for text in texts[a:b]:
                    words = split_words(text)
                    name = word_class(words)
                    if name is None or name in seen:
                        continue
                    seen.add(name)
                    listed, n = prefix(words, word_hashes(words, known), ranks)
                    lists.append(listed.view(np.int64))
                    late.append(np.arange(len(listed)) >= index_length(n))
                    sizes.append(n)
                    names.append(name)
                if lists:
                    each = [len(x) for x in lists]
                    owner = pa.array(np.repeat(np.arange(len(each)), each))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(lists)),
                            pa.array(np.repeat(np.array(sizes, np.int32), each)),
                            pa.array(np.concatenate(late)),
                            pa.array(names, pa.binary()).take(owner),
                        ],
                        names=["token", "n", "late", "cls"],
                    )

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, long, last = None, None, None  # the last list; one too long, and its last index set
        for rows in batches:
            if not rows.num_rows:
                continue
            if long is not None:
                on = int(np.searchsorted(rows.column(0).to_numpy(), long, "right"))
                if on:
                    found, last = star_edges(rows.slice(0, on), last)
                    yield from found
                rows = rows.slice(on)
                if not rows.num_rows:
                    continue
                long, last = None, None
            rows = pa.concat_batches([held, rows]) if held else rows
            token = rows.column(0).to_numpy()
            begin = int(np.searchsorted(token, token[-1]))
            yield from list_edges(rows.slice(0, begin))
            held = rows.slice(begin)
            if held.num_rows > LONG_LIST:
                long = token[-1]
                found, last = star_edges(held, None)
                yield from found
                held = None
        if held:
            yield from list_edges(held)

    lists = _texts(docs, text, post, "token bigint, n int, late boolean, cls binary")
    dealt = lists.repartition("token").sortWithinPartitions("token", "n", "late", "cls")
    found = dealt.mapInArrow(edges, "a binary, b binary, need int, shared bigint").where("a <> b")
    counted = found.groupBy("a", "b").agg(F.min("need").alias("need"), F.sum("shared").alias("shared"))
    return counted.where("shared >= need").select("a", "b")


# A class passes the filter if the bit that its first three bytes name is set.
_FILTER_BYTES = 3


def _named_bit(cls) -> F.Column:
    return F.conv(F.hex(F.substring(cls, 1, _FILTER_BYTES)), 16, 10).cast("int")


def _member_texts(docs: DataFrame, text: str, members: DataFrame) -> DataFrame:
    """``members`` with the ``words`` of their class, compressed: these are a quarter of the
    size of its shingles. A filter of fixed size keeps most other texts from being shuffled.
    A class may come once from every task."""
    bits = members.select(_named_bit(F.col("node")).alias("bit")).distinct().toArrow()
    wanted = np.zeros(1 << 8 * _FILTER_BYTES, bool)
    wanted[bits["bit"].to_numpy()] = True
    packed = np.packbits(wanted).tobytes()

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def asked(name: bytes) -> int:
            bit = int.from_bytes(name[:_FILTER_BYTES])
            return packed[bit >> 3] & 128 >> (bit & 7)

        seen = set()
        compress = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            texts = raw_bytes(batch.column(0))
            for a, b in blocks(texts):
                names, found = [], []
                for text in texts[a:b]:
                    words = split_words(text)
                    name = word_class(words)
                    if name is None or name in seen or not asked(name):
                        continue
                    seen.add(name)
                    names.append(name)
                    found.append(compress(b" ".join(words)))
                if names:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(names, pa.binary()), pa.array(found, pa.binary())],
                        names=["cls", "words"],
                    )

    texts = _texts(docs, text, fetch, "cls binary, words binary")
    return members.join(texts, F.col("node") == F.col("cls"))


def link_sets(sets: list[np.ndarray], probes: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Labels of the sets after joining all linked ones; only ``probes`` are compared, each
    with every set of another label. Sets with the same label are known to be connected."""
    sizes = np.array([len(s) for s in sets])
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    length = np.bincount(token)
    shared = length[token] > 1
    token, owner = token[shared], owner[shared]
    stop = np.cumsum(np.bincount(owner, minlength=len(sets)))
    own = [token[a:b] for a, b in zip(np.append(0, stop[:-1]), stop)]
    order = np.argsort(token, kind="stable")
    lists = owner[order]
    n = np.bincount(token, minlength=len(length))
    first = np.cumsum(n) - n

    def counted(tokens: np.ndarray) -> np.ndarray:
        return np.bincount(lists[row_ranges(first[tokens], n[tokens])], minlength=len(sets))

    before, answers = None, None
    labels, marked = labels.copy(), np.zeros(len(length), bool)
    for x in np.flatnonzero(probes)[np.argsort(sizes[probes], kind="stable")]:
        mine = own[x]
        fresh = True
        if before is not None:
            marked[before] = True
            added = mine[~marked[mine]]
            if 2 * len(added) + len(before) - len(mine) < len(mine):
                marked[mine] = False
                gone = before[marked[before]]
                answers = answers + counted(added) - counted(gone)
                fresh = False
            marked[before] = False
            marked[mine] = False
        if fresh:
            answers = counted(mine)
        before = mine
        linked = (7 * answers >= 3 * (sizes + sizes[x])) & (labels != labels[x])
        if linked.any():
            joined = np.append(np.unique(labels[linked]), labels[x])
            labels[np.isin(labels, joined)] = joined.min()
    return labels


def _linked(rows: DataFrame) -> DataFrame:
    """Edges (a, b) that connect the linked sets of every block pair.

    ``rows``: root, i, j (the block pair), cls, label, probe, words.
    """

    def links(group: list[tuple], known: _Hashes) -> list[tuple[bytes, bytes]]:
        decompress = zstandard.ZstdDecompressor().decompress
        names = [r[0] for r in group]
        numbers: dict[bytes, int] = {}
        labels = np.array([numbers.setdefault(r[1], len(numbers)) for r in group])
        probes = np.array([r[2] for r in group])
        if len(numbers) < 2 or not probes.any():
            return []
        sets = []
        for row in group:
            words = decompress(row[3]).split()
            sets.append(np.unique(shingle_hashes(words, word_hashes(words, known))))
        after = link_sets(sets, probes, labels)
        heads: dict[int, bytes] = {}
        edges = [(heads.setdefault(k, name), name) for k, name in zip(after.tolist(), names)]
        return [(a, b) for a, b in edges if a != b]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place, group, found = _Hashes(), None, [], []

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array([e[k] for e in found], pa.binary()) for k in (0, 1)], names=["a", "b"]
            )
            found.clear()
            return batch

        for batch in batches:
            for root, i, j, name, label, probe, words in zip(*(c.to_pylist() for c in batch.columns)):
                if (root, i, j) != place:
                    found += links(group, known) if len(group) > 1 else []
                    place, group = (root, i, j), []
                if not group or group[-1][0] != name:  # sorted: the same class again is a copy
                    group.append((name, label, probe, words))
            if len(found) > 10_000:
                yield flush()
        found += links(group, known) if len(group) > 1 else []
        yield flush()

    columns = ["root", "i", "j", "cls", "label", "probe", "words"]
    dealt = rows.select(*columns).repartition("root", "i", "j").sortWithinPartitions(*columns[:4])
    return dealt.mapInArrow(join, "a binary, b binary")


def _pairs(members: DataFrame) -> DataFrame:
    """Every block pair (i <= j) that a member's block is part of."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return members.select("*", other).select(
        "*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")
    )


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_shingles`` and ``component_id``.

    Words are what lies between ASCII white space, A-Z folded; a set holds the distinct runs
    of five words, or the whole text if it has fewer. Two documents link if their sets have
    at least three quarters of their union in common; ``component_id`` is the least key that
    links lead to, the own one included. A null, empty or blank text has no shingles and no
    links: its component is its own key. Null keys are not component ids unless a component
    has no other. Repeated rows come back repeatedly. Other columns are not read.
    """
    bounded_batches(docs.sparkSession)
    rows = stored(classes_of(docs, key, text))
    classes = rows.where("cls IS NOT NULL").groupBy("cls").agg(
        F.min("key").alias("key"), F.first("n_shingles").alias("n")
    )
    candidates = stored(components(_candidates(docs, text, word_ranks(docs, text))))
    sized = candidates.join(classes.select(F.col("cls").alias("node"), "n"), "node")
    share = F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("n") / BLOCK_SHINGLES)
    counts = sized.groupBy("root").agg(F.ceil(share).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    members = stored(sized.join(counts, "root").select("root", "node", "blocks", block))
    first = members.withColumns({"label": F.col("node"), "probe": F.lit(True)})
    pairs = _pairs(_member_texts(docs, text, first)).where("i = j OR i = 0")
    edges = stored(_linked(pairs))
    large = members.where("blocks > 2")
    if not large.isEmpty():
        edges = edges.unionByName(stored(_linked(_second(docs, text, large, edges))))
    linked = components(edges)

    named = classes.join(linked, F.col("cls") == F.col("node"))
    least = named.groupBy("root").agg(F.min("key").alias("component_id"))
    of = named.join(least, "root").select("cls", "component_id")
    alone = F.when(F.col("n_shingles") > 0, F.col("least_key")).otherwise(F.col("key"))
    # a table of its own, so that the rows of a class with very many copies can be split
    own = stored(classes.select("cls", F.col("key").alias("least_key")).join(of, "cls", "left"))
    return rows.join(own, "cls", "left").select(
        F.col("key").alias(key), "n_shingles", F.coalesce("component_id", alone).alias("component_id")
    )


def _second(docs: DataFrame, text: str, members: DataFrame, edges: DataFrame) -> DataFrame:
    """The block pairs that the first round left out, their sets labelled by its components.

    Sets of a component's most frequent label need no comparison among themselves: they are
    no probes, and go only to pairs whose other block has a probe.
    """
    labels = components(edges).withColumnRenamed("root", "label")
    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = stored(labelled)
    often = labelled.groupBy("root", "label").count().groupBy("root")
    main = often.agg(F.max(F.struct("count", "label")).alias("m")).select("root", F.col("m.label").alias("main"))
    told = labelled.join(main, "root").withColumn("probe", F.col("label") != F.col("main"))
    told = stored(told)
    with_probe = told.where("probe").select(
        F.col("root").alias("root_"), F.col("block").alias("block_")
    ).distinct()
    theirs = (F.col("root") == F.col("root_")) & (F.col("other") == F.col("block_"))
    pairs = _pairs(told).where("i <> j AND i <> 0")
    asked = pairs.where("probe").unionByName(pairs.where("NOT probe").join(with_probe, theirs, "left_semi"))
    texts = _member_texts(docs, text, asked.select("node").distinct())
    return asked.join(texts.drop("node"), F.col("node") == F.col("cls"))
