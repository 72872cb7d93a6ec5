"""The batch jobs end to end.

Unless said otherwise a job returns the DataFrame it wrote. ``fmt`` is ``parquet`` or ``text``.
``compression`` is for text, where expanded points take many times the room of the lines read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sinks
from ..functions.labels import binarize, positive_or_zero
from ..functions.text import clean_title, tokens
from ..functions.vectors import dense_to_sparse
from ..operators.chisq import chi_square_select
from ..operators.dimensions import TopVarianceSelector
from ..operators.lsh import LshParams, lsh_histogram, lsh_index
from ..operators.polynomial import polynomial
from ..operators.split import exact_split
from ..operators.tfidf import hashing_tf, tfidf_l2
from ..operators.vocabulary import keep_vocab, top_fraction_vocab, word_count
from ..session import cut_lineage
from ..sources.bibliography import read_articles
from ..sources.documents import read_documents
from ..sources.points import read_labeled_points, read_libsvm, read_sparse_vectors
from ..sources.tables import read_keyed_values, read_labeled_csv


def text_tfidf(docs: DataFrame, fraction: float = 0.005, key: str = "doc_id") -> DataFrame:
    """``content`` -> pruned to frequent words -> L2-normalized TF-IDF ``features``.

    The width of the vectors is the size of the vocabulary.
    """
    worded = docs.select(key, tokens(F.col("content")).alias("words"))
    vocab = top_fraction_vocab(word_count(worded), fraction)
    return tfidf_l2(keep_vocab(worded, vocab), max(vocab.size, 1))


def mail_vectors(
    spark: SparkSession, root: str, out: str, fraction: float = 0.005, fmt: str = "parquet"
) -> DataFrame:
    """A tree of mail files -> numbered TF-IDF vectors."""
    vectors = text_tfidf(read_documents(spark, root), fraction)
    sinks.write_indexed_vectors(vectors, out, [("doc_id", "asc")], fmt)
    return vectors


def hash_vectors(
    spark: SparkSession,
    path: str,
    out: str,
    params: LshParams,
    fmt: str = "parquet",
    partitions: int | None = None,
    **options,
) -> DataFrame:
    """Sparse vectors -> buckets in every table (``out``) and bucket sizes (``out_histogram``).

    Vectors without a key of their own get the negative of their line's number, from -1; it is
    the same on every run. Keys count from 0.
    """
    vectors = read_sparse_vectors(spark, path, numbered=True).select(
        F.coalesce("key", -1 - F.col("line_key")).alias("id"),
        F.col("vector").alias("features"),
    )
    indexed = lsh_index(vectors, params, **options)
    if fmt == "text":
        indexed = cut_lineage(indexed)
    sinks.write_lsh(indexed, out, fmt, partitions)
    if fmt != "text":  # the table just written serves for the histogram
        indexed = spark.read.schema(indexed.schema).parquet(out)
    sinks.write_histogram(lsh_histogram(indexed), f"{out}_histogram", fmt)
    return indexed


def title_points(articles: DataFrame, num_features: int, last_old_year: int = 2007) -> DataFrame:
    """``title, year`` -> label 1 up to ``last_old_year``, 0 after it, and hashed title words."""
    worded = articles.withColumn("words", tokens(clean_title(F.col("title"))))
    labeled = worded.withColumn(
        "label", binarize(F.col("year"), last_old_year, above=0).cast("double")
    )
    return hashing_tf(labeled, num_features).drop("words")


def bibliography_points(
    spark: SparkSession,
    path: str,
    out: str,
    num_features: int,
    fmt: str = "parquet",
    partitions: int | None = None,
) -> DataFrame:
    """Bibliography XML -> labelled title words."""
    points = title_points(read_articles(spark, path), num_features).select("label", "features")
    sinks.write_labeled_points(points, out, fmt, partitions)
    return points


def libsvm_points(
    spark: SparkSession,
    path: str,
    out: str,
    select: int | None = None,
    num_features: int | None = None,
    fmt: str = "parquet",
    partitions: int | None = None,
) -> int:
    """LibSVM -> labels not above 0 become 0; optionally only the ``select`` best features.

    Returns the number of rows written.
    """
    points = read_libsvm(spark, path, num_features)
    if select is not None:
        points = chi_square_select(points, select)
    points = points.withColumn("label", positive_or_zero(F.col("label")))
    return sinks.write_labeled_points(points, out, fmt, partitions)


def csv_points(
    spark: SparkSession, path: str, out: str, fmt: str = "parquet", partitions: int | None = None
) -> DataFrame:
    """Label-first CSV -> sparse labelled points."""
    rows = read_labeled_csv(spark, path)
    points = rows.withColumn("features", dense_to_sparse(F.col("features")))
    sinks.write_labeled_points(points, out, fmt, partitions)
    return points


def linkage_points(
    spark: SparkSession,
    path: str,
    out: str,
    degree: int = 3,
    fmt: str = "parquet",
    partitions: int | None = None,
    compression: str = "none",
) -> DataFrame:
    """Label-last CSV with ``?`` gaps -> polynomially expanded labelled points."""
    rows = read_labeled_csv(spark, path, label="last", missing="?", truth="TRUE")
    points = polynomial(rows.withColumn("features", dense_to_sparse(F.col("features"))), degree)
    sinks.write_labeled_points(points, out, fmt, partitions, compression=compression)
    return points


def expand_points(
    spark: SparkSession,
    path: str,
    out: str,
    degree: int = 3,
    fmt: str = "parquet",
    partitions: int | None = None,
    compression: str = "none",
) -> DataFrame:
    """Saved labelled points -> polynomially expanded labelled points."""
    points = polynomial(read_labeled_points(spark, path), degree)
    sinks.write_labeled_points(points, out, fmt, partitions, compression=compression)
    return points


def variance_vectors(
    spark: SparkSession, training: str, test: str, out: str, k: int = 50, fmt: str = "parquet"
) -> DataFrame:
    """Two label-first CSVs -> sparse vectors of the k dimensions that vary most in training.

    Keys count on through the lines of the training files, then of the test files, in order of
    the files' names; they are the same on every run.
    """
    train = read_labeled_csv(spark, training, numbered=True).withColumn("split", F.lit("training"))
    rest = read_labeled_csv(spark, test, numbered=True).withColumn("split", F.lit("test"))
    after = train.count()
    rest = rest.withColumn("key", F.col("key") + after)
    both = TopVarianceSelector(k).fit(train).transform(train.unionByName(rest))
    keyed = both.withColumn("features", dense_to_sparse(F.col("features")))
    sinks.write_split(keyed, out, fmt)
    return keyed


def split_vectors(
    spark: SparkSession, path: str, out: str, n: int = 50, seed: int = 0, fmt: str = "parquet"
) -> DataFrame:
    """Key-first rows -> sparse vectors, n of them for testing."""
    rows = read_keyed_values(spark, path)
    sparse = rows.withColumn("features", dense_to_sparse(F.col("features")))
    split = exact_split(sparse, n, seed, key="key")
    sinks.write_split(split, out, fmt)
    return split
