"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of every text; a chunk ends wherever the hash of the last
sixteen bytes falls under a fixed bound, so an insertion moves only the chunk ends near it.
Where no hash does for long, as in periodic text, it ends at the least hash of a short stretch.
Chunks are compared by digest. One that occurs in several documents is repeated; repeated
chunks that follow each other in a text form a run, and runs of enough words are reported,
whichever documents keep their chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veclode.llm.common import blocks, column, fresh_name, raw_bytes, stored

ROLLED = 16  # bytes the rolling hash looks back on
MEAN = 24  # bytes between chunk ends, on average
LONGEST = 5  # times the mean; a longer chunk is cut again
NEAREST, FARTHEST = 1, 3  # times the mean from its start: where the least hash is looked for


def gear_table(seed: int = 5) -> np.ndarray:
    """A random number for every byte; zero, which separates texts, has none."""
    table = np.random.default_rng(seed).integers(0, 1 << 32, 256, dtype=np.uint32)
    table[0] = 0
    return table


_GEAR = gear_table()
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0]] = True


def gear_hash(data: np.ndarray) -> np.ndarray:
    """At every byte, the sum of the gear numbers of the last ``ROLLED`` bytes, each shifted
    left once for every byte after it. Doubling the window takes four steps."""
    h, width = _GEAR[data], 1
    while width < ROLLED:
        older = np.zeros_like(h)
        older[width:] = h[:-width]
        h = h + (older << np.uint32(width))
        width *= 2
    return h


def chunk_block(texts: list[bytes], mean: int = MEAN):
    """Chunks of some texts: (text number, first byte in the block, end, joined bytes)."""
    gap = bytes(ROLLED)
    joined = gap + gap.join(texts) + gap
    data = np.frombuffer(joined, np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = ROLLED + np.cumsum(lengths + ROLLED) - lengths - ROLLED
    ends = starts + lengths
    inside = (data & 0xC0) == 0x80  # not the first byte of a code point
    rolled = gear_hash(data)
    cut = ((rolled >> np.uint32(16)) < 65536 // mean)[:-1] & ~inside[1:]
    at = np.flatnonzero(cut) + 1
    doc = np.searchsorted(ends, at, side="left")
    ok = (doc < len(texts)) & (at > starts[np.minimum(doc, len(texts) - 1)])
    full = np.flatnonzero(lengths)
    at = np.unique(np.concatenate([at[ok], ends[full]]))
    doc = np.searchsorted(ends, at, side="left")
    first = np.concatenate([[0], at[:-1]])
    new = np.concatenate([[True], doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, bool)
    first[new] = starts[doc[new]]
    long = np.flatnonzero(at - first > LONGEST * mean)
    if len(long):
        more_doc, more_first, more_at = [], [], []
        for i in long.tolist():
            a, stop, d = int(first[i]), int(at[i]), int(doc[i])
            while stop - a > FARTHEST * mean:
                near = np.arange(a + NEAREST * mean, a + FARTHEST * mean)
                near = near[~inside[near]]
                if not len(near):  # no text: bytes without a first one of a code point
                    break
                b = int(near[rolled[near - 1].argmin()])  # the first of equal ones
                more_doc.append(d)
                more_first.append(a)
                more_at.append(b)
                a = b
            first[i] = a
        doc = np.concatenate([doc, more_doc]).astype(np.int64)
        first = np.concatenate([first, more_first]).astype(np.int64)
        at = np.concatenate([at, more_at]).astype(np.int64)
        order = np.argsort(first)
        doc, first, at = doc[order], first[order], at[order]
    return doc, first, at, starts, joined, data, inside


def chunks(docs: DataFrame, key: str, text: str, mean: int = MEAN) -> DataFrame:
    """Every chunk: ``row`` (a number of the document's row), ``key``, ``digest``, ``start``
    and ``stop`` (code points) and ``n_words`` (words that begin in it)."""
    kind = docs.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("key", kind),
            *T._parse_datatype_string(
                "row bigint, digest bigint, start int, stop int, n_words int"
            ).fields,
        ]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = [t or b"" for t in raw_bytes(batch.column(1))]
            for a, b in blocks(texts):
                doc, first, at, starts, joined, data, inside = chunk_block(texts[a:b], mean)
                points = np.concatenate([[0], np.cumsum(~inside)])
                begins = np.concatenate([[0], np.cumsum(~_BLANK[data[1:]] & _BLANK[data[:-1]]), [0]])
                # a word that begins at byte p counts at p; begins[p] counts those up to p
                words = begins[at - 1] - begins[np.maximum(first - 1, 0)]
                base = points[starts[doc]]
                digest = xxhash.xxh3_64_intdigest
                ids = np.fromiter(
                    (digest(joined[s:e]) for s, e in zip(first.tolist(), at.tolist())),
                    np.uint64,
                    len(first),
                ).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(pa.array(doc)),
                        pa.array(row + doc),
                        pa.array(ids),
                        pa.array((points[first] - base).astype(np.int32)),
                        pa.array((points[at] - base).astype(np.int32)),
                        pa.array(words.astype(np.int32)),
                    ],
                    names=schema.names,
                )
                row += b - a

    return docs.select(column(docs, key), column(docs, text)).mapInArrow(cut, schema)


def repeated_passages(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_words: int = 16,
    mean: int = MEAN,
) -> DataFrame:
    """Passages that several documents share, one row for every document and passage.

    ``start`` and ``stop`` are places in code points. Of every chunk the document with the
    least key keeps its copies; ``first_key`` is the document that keeps most of the passage's
    words (then most of its text, then the least). ``dropped`` lists the stretches of the passage, of ``min_words`` words or more, whose
    chunks are all kept by others; shorter ones, such as a word that some lesser document happens
    to hold, stay in the text. ``kept`` passages have no such stretch. Passages under
    ``min_words`` words are not reported; a shared passage loses up
    to a chunk at either end, so ``min_words`` should be well below the length looked for.
    Null and empty texts have no chunks. Rows with equal keys are the same document, and a
    passage repeated only inside one document is not reported; rows without a key cannot be
    named and are left out. Other columns are not read.
    """
    docs = docs.where(column(docs, key).isNotNull())
    parts = chunks(docs, key, text, mean)
    shared = stored(  # a table of its own, so that a very frequent chunk's rows can be split
        parts.groupBy("digest")
        .agg(F.min("key").alias("first_key"), F.max("key").alias("last_key"))
        .where("first_key < last_key")
        .select(F.col("digest").alias("digest_"), "first_key")
    )
    repeated = parts.join(shared, F.col("digest") == F.col("digest_"))
    repeated = repeated.withColumn("kept", F.col("first_key") == F.col("key"))
    in_row = Window.partitionBy("row").orderBy("start")
    goes_on = F.coalesce(F.lag("stop").over(in_row) == F.col("start"), F.lit(False))
    alike = goes_on & (F.lag("kept").over(in_row) == F.col("kept"))
    runs = (
        repeated.withColumn("new_run", (~goes_on).cast("int"))
        .withColumn("new_piece", (~alike).cast("int"))
        .withColumn("run", F.sum("new_run").over(in_row))
        .withColumn("piece", F.sum("new_piece").over(in_row))
    )
    in_run = Window.partitionBy("row", "run")
    runs = runs.withColumn("run_words", F.sum("n_words").over(in_run)).where(F.col("run_words") >= min_words)
    agreed = Window.partitionBy("row", "run", "first_key")
    vote = F.struct(
        (-F.sum("n_words").over(agreed)).alias("words"),
        (-F.sum(F.col("stop") - F.col("start")).over(agreed)).alias("points"),
        F.col("first_key"),
    )
    pieces = runs.withColumn("vote", vote).groupBy("row", "run", "piece").agg(
        F.first("key").alias("key"),
        F.min("start").cast("bigint").alias("start"),
        F.max("stop").cast("bigint").alias("stop"),
        F.sum("n_words").alias("n_words"),
        F.count(F.lit(1)).alias("n_chunks"),
        F.min("vote").alias("vote"),
        F.first("kept").alias("kept"),
    )
    drop = ~F.col("kept") & (F.col("n_words") >= min_words)
    return (
        pieces.groupBy("row", "run")
        .agg(
            F.first("key").alias("key"),
            F.min("start").alias("start"),
            F.max("stop").alias("stop"),
            F.sum("n_words").alias("n_words"),
            F.sum("n_chunks").alias("n_chunks"),
            F.min("vote")["first_key"].alias("first_key"),
            F.array_sort(F.collect_list(F.when(drop, F.struct("start", "stop")))).alias("dropped"),
        )
        .select(
            F.col("key").alias(key),
            "start",
            "stop",
            "n_words",
            "n_chunks",
            "first_key",
            (F.size("dropped") == 0).alias("kept"),
            "dropped",
        )
    )


def drop_passages(docs: DataFrame, passages: DataFrame, key: str = "doc_id", text: str = "text"):
    """``docs`` without the stretches in ``dropped``; all other rows as they are.

    Rows of one key must have one text: stretches are told by the key, so where a key has
    several texts its rows stay whole.
    """
    key_, span_, spans_, texts_ = (fresh_name(docs, n) for n in ("key_", "span_", "spans_", "texts_"))
    spans = (
        passages.where("NOT kept")
        .select(column(passages, key).alias(key_), F.explode("dropped").alias(span_))
        .groupBy(key_)
        .agg(F.array_sort(F.collect_set(span_)).alias(spans_))
    )
    whole = column(docs, text)
    # keys with one text; a text's digest is enough to tell
    digest = F.md5(F.coalesce(whole.cast("string"), F.lit("")))
    named = docs.select(column(docs, key).alias(key_), digest.alias(texts_))
    single = named.groupBy(key_).agg(F.min(texts_).alias("a"), F.max(texts_).alias("b")).where("a = b")
    spans = spans.join(single.select(key_), key_, "left_semi")
    joined = docs.join(spans, column(docs, key) == F.col(key_), "left")
    # every piece between two removed passages, then the end
    start = F.struct(F.lit("").alias("kept"), F.lit(0).cast("bigint").alias("upto"))
    shorter = F.aggregate(
        spans_,
        start,
        lambda acc, x: F.struct(
            F.concat(
                acc.kept,
                F.substring(whole, (acc.upto + 1).cast("int"), F.greatest(x.start - acc.upto, F.lit(0)).cast("int")),
            ).alias("kept"),
            F.greatest(acc.upto, x.stop).alias("upto"),
        ),
        lambda acc: F.concat(acc.kept, F.substring(whole, (acc.upto + 1).cast("int"), F.length(whole))),
    )
    short = F.when(F.col(spans_).isNull(), whole).otherwise(shorter)
    return joined.withColumn(text, short).drop(key_, spans_)
