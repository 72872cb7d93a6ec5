"""Word counts and pruning documents to the most frequent words."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import bounded_batches, cut_lineage, sql_strings, table_bytes
from .columns import explode_elements, with_bound_column
from .lookup import match_elements
from .ranking import TAKE_ORDERED_ROWS, top_rows
from .shipped import SHIPPED_BYTES, keep_members

# Up to this many words and bytes the vocabulary becomes a constant hash set in the plan.
INLINE_WORDS = 10_000
INLINE_BYTES = 1 << 20


@dataclass(frozen=True)
class Vocabulary:
    """The kept words (``word, n``) and how many they are."""

    table: DataFrame
    size: int


def word_count(df: DataFrame, words: str = "words") -> DataFrame:
    """``word, n`` over all documents; counts are combined before the shuffle."""
    rows = explode_elements(df, [], words, "word")
    return rows.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def top_fraction_vocab(
    counts: DataFrame, fraction: float = 0.005, take_rows: int = TAKE_ORDERED_ROWS
) -> Vocabulary:
    """The ``int(distinct words * fraction)`` most frequent words; ties go by the word."""
    counts = cut_lineage(counts)
    size = int(counts.count() * fraction)
    kept = top_rows(counts, [("n", "desc"), ("word", "asc")], size, take_rows)
    return Vocabulary(kept, size)


def keep_vocab(
    df: DataFrame,
    vocab: Vocabulary,
    words: str = "words",
    inline_words: int = INLINE_WORDS,
    shipped_bytes: int = SHIPPED_BYTES,
) -> DataFrame:
    """Drop words outside the vocabulary (order and repeats stay), then empty documents.

    A vocabulary of bounded size is tested inside the row and nothing is shuffled: as a
    constant, or sent to the tasks. A larger one is joined.
    """
    if vocab.size == 0:
        return df.limit(0)
    table = vocab.table.select("word")
    size = table_bytes(table)
    if vocab.size <= inline_words and size <= INLINE_BYTES:
        kept = [r["word"] for r in table.collect()]
        pruned = F.expr(f"filter(`{words}`, w -> w IN ({sql_strings(kept)}))")
    elif size <= shipped_bytes:
        members = table.toArrow().column("word").combine_chunks()
        bounded_batches(df.sparkSession)
        pruned = keep_members(F.col(words), members)
    else:
        matched = match_elements(df, F.col(words), table, "word", "_kept")
        return matched.withColumn(words, F.col("_kept")["word"]).drop("_kept")
    return with_bound_column(df, words, pruned).filter(F.size(words) >= 1)
