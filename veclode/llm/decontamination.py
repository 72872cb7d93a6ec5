"""Benchmark decontamination over a positional inverted index.

The corpus is cut into segments of about a megabyte of text. A segment holds, for every
term of the test set that occurs in it, the sorted list of its positions, and is stored as
one row. Test windows are then looked up in each segment: the list of the window's rarest
term (by its count in the whole corpus) is shifted by the term's place in the window and
intersected with the lists of the other terms, from rare to common, until no start is left
or every term agrees. Segments are independent, so nothing is shuffled and no key can be hot.

Terms that the test set does not hold cannot be part of a match; their postings are left
out. A test set larger than ``BLOCK`` bytes is matched in blocks, each with its own index.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veclode.llm.common import blocks, column, fresh_name, raw_bytes, row_ranges, stored
from veclode.session import bounded_batches

# Bytes of test text in one block of the test set: bounds what is sent to the tasks.
BLOCK = 2 << 20
# Start positions tried at once inside a task.
TRIED = 1 << 20

_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b in _KEEP else 0x20 for b in range(256)
)  # A-Z to a-z, every separator to a blank

_SEGMENT = (
    "block string, starts array<int>, words array<int>, terms array<int>, counts array<int>,"
    " positions array<int>"
)


def split_words(text: bytes | None) -> list[bytes]:
    """Words of ASCII letters (folded to lower case), ASCII digits and any non-ASCII bytes."""
    return text.translate(_TABLE).split() if text else []


@dataclass(frozen=True)
class Phrases:
    """The windows of one block of the test set, as term ids, with the items they occur in."""

    vocabulary: dict[bytes, int]
    windows: list[tuple[int, ...]]
    items: list[tuple[str, ...]]
    length: int

    @classmethod
    def of(cls, rows: Iterable[tuple], length: int) -> Phrases:
        vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in rows:
            ids = [vocabulary.setdefault(w, len(vocabulary)) for w in split_words(text)]
            for i in range(max(1, len(ids) - length + 1) if ids else 0):
                found.setdefault(tuple(ids[i : i + length]), set()).add(item)
        return cls(vocabulary, list(found), [tuple(sorted(x)) for x in found.values()], length)


def build_index(docs: DataFrame, vocabulary: dict[bytes, int], gap: int, key: str, text: str):
    """Segments of the positional index of ``docs``, one row each.

    ``keys``, ``starts`` and ``words`` list the documents of a segment, the place of their
    first word and their number of words; ``terms``, ``counts`` and ``positions`` hold the
    postings, by term and then by position. ``gap`` unused places follow each document.
    """
    kind = docs.schema[key].dataType
    schema = T.StructType([T.StructField("keys", T.ArrayType(kind))])
    schema = T.StructType(schema.fields + T._parse_datatype_string(_SEGMENT).fields)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, n = vocabulary.get, 0
        where = TaskContext.get().partitionId()
        for batch in batches:
            texts, keys = raw_bytes(batch.column(1)), batch.column(0)
            for a, b in blocks(texts):
                at, starts, lengths, ids, places = 0, [], [], [], []
                for words in map(split_words, texts[a:b]):
                    starts.append(at)
                    lengths.append(len(words))
                    found = np.fromiter(map(lookup, words, repeat(-1)), np.int32, len(words))
                    known = np.flatnonzero(found >= 0)
                    ids.append(found[known])
                    places.append(known + at)
                    at += len(words) + gap
                term, place = np.concatenate(ids), np.concatenate(places)
                order = np.argsort(term, kind="stable")
                terms, counts = np.unique(term, return_counts=True)
                row = {
                    "keys": pa.ListArray.from_arrays([0, b - a], keys.slice(a, b - a)),
                    "block": pa.array([f"{where}-{n}"]),
                }
                for name, values in (
                    ("starts", starts),
                    ("words", lengths),
                    ("terms", terms),
                    ("counts", counts),
                    ("positions", place[order]),
                ):
                    row[name] = pa.array([np.asarray(values, np.int32)], pa.list_(pa.int32()))
                n += 1
                yield pa.RecordBatch.from_pydict(row)

    return docs.select(column(docs, key), column(docs, text)).mapInArrow(segments, schema)


def term_counts(index: DataFrame) -> dict[int, int]:
    """How often each term occurs in the whole corpus; no more rows than the test vocabulary."""
    zipped = F.explode(F.arrays_zip("terms", "counts")).alias("x")
    counts = index.select(zipped).groupBy("x.terms").agg(F.sum("x.counts").alias("n"))
    return {r["terms"]: r["n"] for r in counts.toLocalIterator()}


class _Segment:
    """The postings of one segment: sorted position lists by term."""

    def __init__(self, terms, counts, positions, n_terms):
        self.counts, self.positions = counts.astype(np.int64), positions.astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        self.place = np.full(n_terms + 1, -1, np.int64)  # the last entry: padding
        self.place[terms] = np.arange(len(terms))
        self.keys = (np.repeat(np.arange(len(terms)), self.counts) << 32) | self.positions

    def listed(self, place: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Whether the list at ``place`` holds ``position``."""
        wanted = (place << 32) | position
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return self.keys[at] == wanted

    def starts(self, terms, offsets, lengths) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, start) of every occurrence; terms and offsets go from rare to common."""
        if not len(self.keys):
            return
        alive = np.flatnonzero(self.place[terms[:, 0]] >= 0)
        for r in range(1, terms.shape[1]):
            alive = alive[(self.place[terms[alive, r]] >= 0) | (lengths[alive] <= r)]
        many = np.cumsum(self.counts[self.place[terms[alive, 0]]])
        for part in np.split(alive, np.searchsorted(many, np.arange(TRIED, many[-1], TRIED)) if len(many) else []):
            place = self.place[terms[part, 0]]
            n = self.counts[place]
            window = np.repeat(part, n)
            start = self.positions[row_ranges(self.first[place], n)] - offsets[window, 0]
            window, start = window[start >= 0], start[start >= 0]  # none begins before the segment
            for r in range(1, terms.shape[1]):
                if not len(window):
                    break
                ok = (lengths[window] <= r) | self.listed(
                    self.place[terms[window, r]], start + offsets[window, r]
                )
                window, start = window[ok], start[ok]
            if len(window):
                yield window, start


def _rare_first(phrases: Phrases, counts: dict[int, int]):
    """Windows that can occur, as arrays of term ids and offsets from rare to common."""
    can = [i for i, w in enumerate(phrases.windows) if all(t in counts for t in w)]
    width, pad = phrases.length, len(phrases.vocabulary)
    terms = np.full((len(can), width), pad, np.int64)
    offsets = np.zeros((len(can), width), np.int64)
    for row, i in enumerate(can):
        by_count = sorted((counts[t], o, t) for o, t in enumerate(phrases.windows[i]))
        terms[row, : len(by_count)] = [t for _, _, t in by_count]
        offsets[row, : len(by_count)] = [o for _, o, _ in by_count]
    lengths = np.array([len(phrases.windows[i]) for i in can], np.int64)
    return terms, offsets, lengths, [phrases.items[i] for i in can]


def _search(index: DataFrame, phrases: Phrases) -> DataFrame:
    """One row for every document of the index: its words, hit spans and items."""
    kind = index.schema["keys"].dataType.elementType
    schema = T.StructType(
        [T.StructField("key", kind)]
        + T._parse_datatype_string(
            "row string, n_words bigint, spans array<struct<start:bigint,stop:bigint>>,"
            " items array<string>"
        ).fields
    )
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    terms, offsets, lengths, items = _rare_first(phrases, term_counts(index))
    n_terms = len(phrases.vocabulary)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda name: batch.column(name)[i].values.to_numpy(zero_copy_only=False)
                docs, words = get("starts").astype(np.int64), get("words").astype(np.int64)
                spans: list[list[dict]] = [[] for _ in docs]
                named: list[set[str]] = [set() for _ in docs]
                segment = _Segment(get("terms"), get("counts"), get("positions"), n_terms)
                covered = np.zeros(int(docs[-1] + words[-1]) + phrases.length + 1, np.int32)
                hit = False
                for window, start in segment.starts(terms, offsets, lengths):
                    hit = True
                    np.add.at(covered, start, 1)
                    np.add.at(covered, start + lengths[window], -1)
                    doc = np.searchsorted(docs + words, start, side="right")
                    for pair in np.unique(doc * len(items) + window).tolist():
                        named[pair // len(items)].update(items[pair % len(items)])
                if hit:
                    on = np.diff((np.cumsum(covered) > 0).astype(np.int8), prepend=0, append=0)
                    for s, e in zip(np.flatnonzero(on > 0).tolist(), np.flatnonzero(on < 0).tolist()):
                        d = int(np.searchsorted(docs + words, s, side="right"))
                        spans[d].append({"start": s - int(docs[d]), "stop": e - int(docs[d])})
                block = batch.column("block")[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("keys")[i].values,
                        pa.array([f"{block}-{k}" for k in range(len(docs))]),
                        pa.array(words),
                        pa.array(spans, spans_type),
                        pa.array([sorted(x) for x in named], pa.list_(pa.string())),
                    ],
                    names=["key", "row", "n_words", "spans", "items"],
                )

    return index.mapInArrow(search, schema)


def _covered(spans) -> F.Column:
    """Words inside any of the sorted spans."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("upto"))
    return F.aggregate(
        spans,
        zero,
        lambda acc, x: F.struct(
            (acc.n + F.greatest(F.lit(0), x["stop"] - F.greatest(acc.upto, x["start"]))).alias("n"),
            F.greatest(acc.upto, x["stop"]).alias("upto"),
        ),
        lambda acc: acc.n,
    )


def _test_blocks(items: DataFrame, key: str, text: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The test set in blocks of about ``block_bytes``, one block in the driver at a time."""
    rows = items.select(
        F.coalesce(column(items, key).cast("string"), F.lit("")).alias("item"),
        column(items, text).cast("string").cast("binary").alias("text"),
    ).where("text IS NOT NULL")
    size = rows.agg(F.sum(F.octet_length("text") + 64).alias("n")).head()["n"] or 0
    n = -(-size // block_bytes)
    for i in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        yield [(r["item"], bytes(r["text"])) for r in part.toLocalIterator()]


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    length: int = 13,
    block_bytes: int = BLOCK,
) -> DataFrame:
    """How much of each document lies inside passages of the test set.

    A window is ``length`` consecutive words of an item; an item with fewer words, but not
    none, is one window. One row comes back for every row of ``docs``: ``key`` (under its own
    name), ``n_words``, ``spans`` (the hit words as sorted, disjoint ranges of word numbers),
    ``n_hit`` (words in them) and ``items`` (ids, as sorted strings, of items with a window in
    the document). Null and empty texts have no words and no hits; an empty test set gives no
    hits; an item without an id has the id "". Repeated rows and keys are judged row by row.
    Other columns of either table are not read.
    """
    bounded_batches(docs.sparkSession)
    parts = []
    for rows in _test_blocks(items, item_key, item_text, block_bytes):
        phrases = Phrases.of(rows, length)
        if phrases.windows:
            index = stored(build_index(docs, phrases.vocabulary, length, key, text))
            parts.append(_search(index, phrases))
    if not parts:
        nothing = Phrases({}, [], [], length)
        parts.append(_search(build_index(docs, {}, length, key, text), nothing))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    if len(parts) > 1:
        found = found.groupBy("row").agg(
            F.first("key").alias("key"),
            F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
    return found.select(
        F.col("key").alias(key),
        "n_words",
        "spans",
        _covered(F.col("spans")).alias("n_hit"),
        "items",
    )


def is_contaminated(n_hit="n_hit", n_words="n_words", parts: int = 20) -> F.Column:
    """Whether hit words are at least one part in ``parts`` of a document's words."""
    return (F.col(n_hit) > 0) & (parts * F.col(n_hit) >= F.col(n_words))


def find_near(
    docs: DataFrame, queries: list[list[str]], distance: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Proximity matches: (key, query number, word number of the rarest term) wherever every
    term of a query lies within ``distance`` words of an occurrence of its rarest term.

    Queries are folded and cut into words like documents; one without words matches nothing.
    """
    vocabulary: dict[bytes, int] = {}
    asked = []
    for i, words in enumerate(queries):
        own = dict.fromkeys(w for x in words for w in split_words(x.encode()))
        asked.append((i, [vocabulary.setdefault(w, len(vocabulary)) for w in own]))
    index = stored(build_index(docs, vocabulary, distance + 1, key, text))
    counts = term_counts(index)
    plan = [
        (i, sorted(ids, key=lambda t: (counts[t], t)))
        for i, ids in asked
        if ids and all(t in counts for t in ids)
    ]
    kind = index.schema["keys"].dataType.elementType
    schema = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField(fresh_name(index, "query"), T.IntegerType()),
            T.StructField("word", T.LongType()),
        ]
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda name: batch.column(name)[r].values.to_numpy(zero_copy_only=False)
                bounds = np.cumsum(get("counts"))[:-1]
                lists = dict(zip(get("terms").tolist(), np.split(get("positions"), bounds)))
                docs, words = get("starts").astype(np.int64), get("words")
                for i, ids in plan:
                    at = lists.get(ids[0], np.zeros(0, np.int32)).astype(np.int64)
                    for other in ids[1:]:
                        near = lists.get(other, np.zeros(0, np.int32)).astype(np.int64)
                        low = np.searchsorted(near, at - distance)
                        at = at[np.searchsorted(near, at + distance, side="right") > low]
                    if len(at):
                        doc = np.searchsorted(docs + words, at, side="right")
                        keys = batch.column("keys")[r].values.take(pa.array(doc))
                        yield pa.RecordBatch.from_arrays(
                            [keys, pa.array(np.full(len(at), i, np.int32)), pa.array(at - docs[doc])],
                            names=schema.names,
                        )

    return index.mapInArrow(search, schema)
