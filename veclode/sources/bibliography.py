"""Bibliography XML."""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import between_tags, last_record
from ..session import cut_lineage, few_tasks

# Executors get these functions with the job; they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The kinds of record a bibliography file holds.
RECORDS = (
    "article",
    "inproceedings",
    "proceedings",
    "book",
    "incollection",
    "phdthesis",
    "mastersthesis",
    "www",
)
TAG = re.compile(r"<(/?)(" + "|".join(RECORDS) + r")(?=[\s>])")

# What a row of pieces is: a whole article; or, of one split, the text before its first tag
# when that closes an article (HEAD), all of it when it has no tag (MIDDLE), a mark that its
# first tag is another (BREAK), and the article still open at its end (TAIL).
WHOLE, HEAD, MIDDLE, BREAK, TAIL = range(5)
PIECES = "file string, start bigint, kind int, text string"


def article_fields(record: Column) -> Column:
    """Text up to a closing ``</article>`` -> ``struct<title string, year int>``.

    Whatever stands before the article opens, other kinds of record included, is left
    out. Entities and inner markup stay as they are.
    """
    article = last_record(record, "article")
    return F.struct(
        between_tags(article, "title").alias("title"),
        between_tags(article, "year").try_cast("int").alias("year"),
    )


def _split_pieces(chunks: Iterator[str]) -> Iterator[tuple[int, str | None]]:
    """The pieces of one split's text. Only an open article's text is carried along."""
    before: list[str] | None = []  # the text before the first tag, until there is one
    article: list[str] | None = None  # the text of the open article
    for chunk in chunks:
        at = 0
        for tag in TAG.finditer(chunk):
            closes = tag.group() == "</article"
            if before is not None:
                head = "".join(before) + chunk[: tag.start()]
                yield (HEAD, head) if closes else (BREAK, None)
                before = None
            elif article is not None and closes:
                yield WHOLE, "".join(article) + chunk[at : tag.start()]
            article, at = ([], tag.start()) if tag.group() == "<article" else (None, at)
        if before is not None:
            before.append(chunk)
        elif article is not None:
            article.append(chunk[at:])
    if before is not None:
        yield MIDDLE, "".join(before)
    elif article is not None:
        yield TAIL, "".join(article)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``file, start, value`` of lines, split after split -> pieces."""

    def chunks():
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(3)))
            for split, lines in groupby(rows, key=lambda r: r[:2]):
                yield split, "".join(f"{line[2]}\n" for line in lines)

    def batch_of(rows: list) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays(columns, ["file", "start", "kind", "text"])

    ready: list = []
    for split, parts in groupby(chunks(), key=lambda c: c[0]):
        for piece in _split_pieces(text for _, text in parts):
            ready.append((*split, *piece))
            if len(ready) == 1000:
                yield batch_of(ready)
                ready = []
    if ready:
        yield batch_of(ready)


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """``title, year`` of every article that has both.

    The XML reader would reject the entities the format declares, so lines are read, in as
    many splits as the file has. An article lasts from its opening tag to its closing one;
    one that is followed by another record's tag, or by the end of the file, before it
    closes is left out. Articles cut by the end of a split are put together from a small
    row or two per split, so the result does not depend on the splits, and a run of other
    records is never held. A task takes several splits where they are small. The lines are read once, into a table of titles and years.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )
    fields = F.when(F.col("kind") == WHOLE, article_fields(F.col("text"))).alias("r")
    cut = F.when(F.col("kind") != WHOLE, F.col("text")).alias("text")
    pieces = cut_lineage(
        few_tasks(lines).mapInArrow(_pieces, PIECES).select("file", "start", "kind", fields, cut)
    )
    pieces = few_tasks(pieces)

    # pieces from one tail up to the next tail or break; of them, those up to the first head
    upto = Window.partitionBy("file").orderBy("start", "kind")
    begins = F.col("kind").isin(BREAK, TAIL).cast("int")
    runs = pieces.filter(F.col("kind") != WHOLE).withColumn("run", F.sum(begins).over(upto))
    earlier = Window.partitionBy("file", "run").orderBy("start", "kind")
    heads = F.sum((F.col("kind") == HEAD).cast("int")).over(earlier)
    needed = runs.withColumn("heads", heads).filter(
        (F.col("heads") == 0) | ((F.col("heads") == 1) & (F.col("kind") == HEAD))
    )
    parts = F.array_sort(F.collect_list(F.struct("start", "kind", "text")))
    joined = (
        needed.groupBy("file", "run")
        .agg(
            F.max((F.col("kind") == TAIL).cast("int")).alias("opens"),
            F.max("heads").alias("closes"),
            parts.alias("parts"),
        )
        .filter("opens = 1 AND closes = 1")
        .select(article_fields(F.array_join(F.col("parts.text"), "")).alias("r"))
    )
    return (
        pieces.filter(F.col("kind") == WHOLE)
        .select("r")
        .unionByName(joined)
        .select("r.*")
        .filter("title IS NOT NULL AND title != '' AND year IS NOT NULL")
    )
