
from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from veclode import sinks  # noqa: E402
from veclode.functions import vectors as V  # noqa: E402
from veclode.functions.labels import binarize, positive_or_zero  # noqa: E402
from veclode.functions.text import (  # noqa: E402
    MAIL_HEADERS,
    between_tags,
    clean_title,
    keep_lines,
    tokens,
)
from veclode.operators.chisq import chi_square, chi_square_select  # noqa: E402
from veclode.operators.dimensions import (  # noqa: E402
    TopVarianceSelector,
    dim_stats,
    top_variance_dims,
)
from veclode.operators.lsh import (  # noqa: E402
    FOLD,
    GOLDEN,
    MIXERS,
    Family,
    LshParams,
    generated_params,
    lsh_histogram,
    lsh_index,
    lsh_params,
    lsh_rows,
)
from veclode.operators.polynomial import polynomial  # noqa: E402
from veclode.operators.ranking import with_row_index  # noqa: E402
from veclode.operators.split import exact_split  # noqa: E402
from veclode.operators.tfidf import (  # noqa: E402
    fit_idf,
    hashing_tf,
    important_terms,
    keep_terms,
    tfidf_l2,
    to_long,
)
from veclode.operators.vocabulary import keep_vocab, top_fraction_vocab, word_count  # noqa: E402
from veclode.plans import jobs  # noqa: E402
from veclode.plans.jobs import text_tfidf, title_points  # noqa: E402
from veclode.session import cut_lineage, ensure_checkpoint_dir, spread_small  # noqa: E402
from veclode.sources.bibliography import article_fields, read_articles  # noqa: E402
from veclode.sources.documents import read_documents  # noqa: E402
from veclode.sources.file_tree import write_files  # noqa: E402
from veclode.sources.lines import numbered_lines  # noqa: E402
from veclode.sources.lsh_files import hash_function_fields, read_lsh_params  # noqa: E402
from veclode.sources.points import read_labeled_points, read_libsvm, read_sparse_vectors  # noqa: E402
from veclode.sources.tables import keyed_fields, labeled_fields  # noqa: E402

try:
    import corpus_pipeline
    from veclode.llm import queries as llm
except ModuleNotFoundError as missing:  # the subpackage is optional, what it needs is not
    if missing.name not in ("corpus_pipeline", "veclode.llm"):
        raise
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"

ANGLE = lsh_params("angle", 64, family_size=24, tables=4, chain=8, seed=11)
ANGLE_SIGNED = lsh_params(
    "angle", 64, family_size=12, tables=3, chain=5, seed=12, dist="uniform_sign"
)
PSTABLE = lsh_params("pstable", 64, family_size=12, tables=3, chain=4, seed=13, w=1)
ANGLE_TEXT = lsh_params("angle", 256, family_size=8, tables=2, chain=4, seed=14)
ANGLE_ITEM = lsh_params("angle", 3, family_size=8, tables=2, chain=4, seed=15)


def _signed_max() -> Family:
    """Bucket: the chained projection of greatest magnitude and its sign, as one number."""

    def draw(rng, size, dim):
        return rng.standard_normal((size, dim)), np.zeros(size)

    def bucketing(dots, b, w):
        place = np.abs(dots).argmax(axis=2)
        greatest = np.take_along_axis(dots, place[:, :, None], axis=2)[:, :, 0]
        return 2 * place + (greatest < 0)

    return Family("signed_max", draw, bucketing)


SIGNED_MAX = lsh_params(_signed_max(), 64, family_size=16, tables=3, chain=6, seed=16)
# Three million dimensions: coefficients are computed, not stored
WIDE = generated_params("angle", 3_000_000, family_size=6, tables=2, chain=4, seed=17)
FILE_CHAIN, FILE_TABLES = 4, 3
SPLIT_SEED = 7
# Bytes of a file split in the queries that read files in several ways.
SPLIT_SIZES = (1 << 16, 1 << 18, 1 << 27)
TERM_FRACTION = 0.05


# Tables with costly work per row.
HEAVY = ("documents", "embeddings", "lineitem", "pages")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread_small(table) if name in HEAVY else table


# --- text -------------------------------------------------------------------------


def _content(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return documents.select("doc_id", keep_lines(F.col("text")).alias("content"))


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _content(spark, sf_dir).select("doc_id", tokens(F.col("content")).alias("words"))


def _vocab(spark: SparkSession, sf_dir: str):
    return top_fraction_vocab(word_count(_words(spark, sf_dir)))


def _pruned(spark: SparkSession, sf_dir: str):
    vocab = _vocab(spark, sf_dir)
    return keep_vocab(_words(spark, sf_dir), vocab), vocab.size


def _tf(spark: SparkSession, sf_dir: str):
    pruned, width = _pruned(spark, sf_dir)
    return hashing_tf(pruned, width), width


def line_filter(spark, sf_dir):
    return _content(spark, sf_dir)


def words_counted(spark, sf_dir):
    return word_count(_words(spark, sf_dir))


def vocab_table(spark, sf_dir):
    return _vocab(spark, sf_dir).table


def vocab_filter(spark, sf_dir):
    pruned, _ = _pruned(spark, sf_dir)
    return pruned.select(
        "doc_id", F.size("words").alias("n_kept"), F.array_join("words", " ").alias("kept")
    )


def term_frequencies(spark, sf_dir):
    return to_long(_tf(spark, sf_dir)[0], "doc_id", value="tf")


def idf_table(spark, sf_dir):
    tf, width = _tf(spark, sf_dir)
    return fit_idf(tf, width).table.select("idx", "df", F.round("idf", 6).alias("idf"))


def _weights(df: DataFrame) -> DataFrame:
    return to_long(df, "doc_id", value="weight").withColumn("weight", F.round("weight", 6))


def tfidf_weights(spark, sf_dir):
    return _weights(text_tfidf(_content(spark, sf_dir)))


def _rounded_terms(spark, sf_dir):
    """TF-IDF vectors and their top terms, ranked on weights rounded as in the SQL."""
    vectors = text_tfidf(_content(spark, sf_dir))
    rounded = V.sparse(
        F.col("features")["size"],
        F.col("features")["indices"],
        F.transform(F.col("features")["values"], lambda x: F.round(x, 6)),
    )
    vectors = vectors.withColumn("features", rounded)
    return vectors, important_terms(vectors, TERM_FRACTION)


def terms_ranked(spark, sf_dir):
    return _rounded_terms(spark, sf_dir)[1]


def terms_kept(spark, sf_dir):
    return _weights(keep_terms(*_rounded_terms(spark, sf_dir)))


def terms_renumbered(spark, sf_dir):
    return _weights(keep_terms(*_rounded_terms(spark, sf_dir), remap=True))


def lsh_text(spark, sf_dir):
    vectors = tfidf_l2(_words(spark, sf_dir), 256)
    return lsh_rows(lsh_index(vectors, ANGLE_TEXT), "doc_id")


def title_words(spark, sf_dir):
    title = clean_title(between_tags(F.col("html"), "title"))
    return _table(spark, sf_dir, "pages").select(
        "page_id", F.array_join(tokens(title), "|").alias("words")
    )


def bibliography_titles(spark, sf_dir):
    """Orders written as bibliography records, then read by the record parser."""
    title = F.concat_ws(" ", "o_orderpriority", F.lit("Order"), "o_orderstatus", "o_custkey")
    year = F.year("o_orderdate").cast("string")
    record = F.concat(
        F.lit("<book><title>Other</title><year>1</year></book>\n<article key='"),
        F.col("o_orderkey").cast("string"),
        F.lit("'>\n<title>"),
        title,
        F.lit(".</title>\n<year>"),
        year,
        F.lit("</year>\n"),
    )
    articles = (
        _table(spark, sf_dir, "orders")
        .select("o_orderkey", article_fields(record).alias("r"))
        .select("o_orderkey", "r.*")
    )
    points = title_points(articles, 1000, last_old_year=1997)
    return _entries(points, "o_orderkey", "label", value="tf")


# --- vectors ----------------------------------------------------------------------


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("features")
    )


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        "l_linestatus",
        F.array("l_quantity", "l_discount", "l_tax").alias("features"),
    )


def _entries(df: DataFrame, *keys: str, value: str = "value") -> DataFrame:
    return df.select(*keys, V.inline_entries(F.col("features"))).toDF(*keys, "idx", value)


def dimension_variance(spark, sf_dir):
    top = top_variance_dims(dim_stats(_embeddings(spark, sf_dir)), 10)
    return top.select("dim", F.round("mean", 6).alias("mean"), F.round("var", 6).alias("var"))


def dimension_select(spark, sf_dir):
    vectors = _embeddings(spark, sf_dir)
    chosen = TopVarianceSelector(10).fit(vectors).transform(vectors)
    return chosen.select("vec_id", F.posexplode_outer("features").alias("pos", "value"))


def variance_split(spark, sf_dir):
    """Split, choose dimensions on the training part, keep them in both as sparse vectors."""
    split = exact_split(_embeddings(spark, sf_dir), 50, SPLIT_SEED, key="vec_id")
    chosen = TopVarianceSelector(10).fit(split.filter("split = 'training'")).transform(split)
    sparse = chosen.withColumn("features", V.dense_to_sparse(F.col("features")))
    return _entries(sparse, "vec_id", "split")


def split_rows(spark, sf_dir):
    return exact_split(_embeddings(spark, sf_dir), 50, SPLIT_SEED, key="vec_id").select(
        "vec_id", "split"
    )


def row_index(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders").select("o_totalprice", "o_orderkey")
    return with_row_index(orders, [("o_totalprice", "desc"), ("o_orderkey", "asc")])


def sparse_entries(spark, sf_dir):
    items = _items(spark, sf_dir).withColumn("features", V.dense_to_sparse(F.col("features")))
    return _entries(items, "l_orderkey", "l_linenumber")


def sparse_roundtrip(spark, sf_dir):
    """Pairs in descending order -> vector -> each text form -> vector."""
    pairs = F.reverse(V.entries(V.dense_to_sparse(F.col("features"))))
    vectors = _embeddings(spark, sf_dir).withColumn(
        "features", V.sparse_from_pairs(F.size("features"), pairs)
    )
    vector, key = F.col("features"), F.col("vec_id")
    forms = F.array(
        V.format_sparse(vector), V.format_sparse(vector, key), V.format_sparse(vector, key, True)
    )
    lines = vectors.select("vec_id", F.posexplode(forms).alias("form", "line"))
    read = lines.select("vec_id", "form", V.parse_sparse(F.col("line")).alias("r"))
    total = F.aggregate(F.col("r.vector.values"), F.lit(0.0), lambda a, x: a + x)
    return read.select(
        "vec_id",
        "form",
        F.col("r.key").alias("key"),
        F.size("r.vector.indices").alias("n"),
        F.round(total, 6).alias("total"),
    )


def neighbour_dots(spark, sf_dir):
    """Dot product of each vector with the next."""
    vectors = _embeddings(spark, sf_dir).select(
        "vec_id", V.dense_to_sparse(F.col("features")).alias("features")
    )
    first = vectors.select(F.col("vec_id").alias("a"), F.col("features").alias("va"))
    second = vectors.select(F.col("vec_id").alias("b"), F.col("features").alias("vb"))
    pairs = first.join(second, F.col("b") == F.col("a") + 1)
    return pairs.select("a", "b", F.round(V.sparse_dot(F.col("va"), F.col("vb")), 6).alias("dot"))


def equal_vectors(spark, sf_dir):
    """Rows per distinct vector, given back as dense coordinates."""
    items = _items(spark, sf_dir).withColumn("features", V.dense_to_sparse(F.col("features")))
    groups = items.groupBy("features").agg(F.count(F.lit(1)).alias("n"))
    dense = groups.select("n", V.sparse_to_dense(F.col("features")).alias("x"))
    return dense.select(
        *(F.get("x", F.lit(i)).alias(name) for i, name in enumerate(("quantity", "discount", "tax"))),
        "n",
    )


def vector_equality(spark, sf_dir):
    """Each line item's vector against that of the next line of its order, stored backwards."""
    items = _items(spark, sf_dir).withColumn("features", V.dense_to_sparse(F.col("features")))
    backwards = V.sparse(
        F.col("features")["size"],
        F.reverse(F.col("features")["indices"]),
        F.reverse(F.col("features")["values"]),
    )
    following = items.select(
        "l_orderkey", (F.col("l_linenumber") - 1).alias("l_linenumber"), backwards.alias("other")
    )
    pairs = items.join(following, ["l_orderkey", "l_linenumber"])
    here, there = F.col("features"), F.col("other")
    return pairs.select(
        "l_orderkey",
        "l_linenumber",
        V.vectors_equal(here, there).alias("equal"),
        (V.vector_hash(here) == V.vector_hash(there)).alias("same_hash"),
    )


def _lsh(params: LshParams, **options) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark, sf_dir):
        return lsh_rows(
            lsh_index(_embeddings(spark, sf_dir), params, **options), "vec_id"
        )

    return run


def hash_function_lines(spark, sf_dir):
    """Vectors written as lines of a hash-function file and read back."""
    lines = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(
        "vec_id",
        F.concat_ws(
            ";",
            V.format_sparse(V.dense_to_sparse(F.col("embedding"))),
            F.col("label").cast("string"),
            (F.col("label") + 1).cast("string"),
        ).alias("line"),
    )
    read = lines.select("vec_id", hash_function_fields(F.col("line")).alias("f"))
    return read.select(
        "vec_id",
        F.posexplode("f.a").alias("pos", "coefficient"),
        F.col("f.b").alias("b"),
        F.col("f.w").alias("w"),
    )


def bucket_histogram(spark, sf_dir):
    return lsh_histogram(lsh_index(_embeddings(spark, sf_dir), ANGLE))


def bucket_lines(spark, sf_dir):
    items = _items(spark, sf_dir).withColumn("features", V.dense_to_sparse(F.col("features")))
    indexed = lsh_index(items, ANGLE_ITEM)
    line = sinks.lsh_line(F.col("features"), F.col("l_orderkey"), F.col("buckets"))
    return indexed.select(line.alias("line"))


# --- labelled points ----------------------------------------------------------------


def csv_points(spark, sf_dir):
    items = _table(spark, sf_dir, "lineitem")
    line = F.concat_ws(",", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    points = items.select("l_orderkey", labeled_fields(line).alias("r")).select(
        "l_orderkey", "r.label", V.dense_to_sparse(F.col("r.features")).alias("features")
    )
    return _entries(points, "l_orderkey", "label")


def _gappy_line() -> Column:
    """Label last; a discount of 0.05 counts as not known."""
    known = F.col("l_discount").cast("string")
    discount = F.when(F.col("l_discount") == 0.05, F.lit("?")).otherwise(known)
    truth = F.when(F.col("l_returnflag") == "R", "TRUE").otherwise("FALSE")
    return F.concat_ws(",", "l_quantity", discount, "l_tax", truth)


def _gappy_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = labeled_fields(_gappy_line(), label="last", missing="?", truth="TRUE")
    return (
        _table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", fields.alias("r"))
        .select("l_orderkey", "l_linenumber", "r.*")
    )


def missing_to_zero(spark, sf_dir):
    points = _gappy_points(spark, sf_dir)
    return points.select("l_orderkey", "l_linenumber", "label", F.posexplode_outer("features")).toDF(
        "l_orderkey", "l_linenumber", "label", "idx", "value"
    )


def cubic_terms(spark, sf_dir):
    points = _gappy_points(spark, sf_dir)
    sparse = points.withColumn("features", V.dense_to_sparse(F.col("features")))
    terms = _entries(polynomial(sparse, 3), "l_orderkey", "l_linenumber", "label", value="term")
    return terms.withColumn("term", F.round("term", 6))


def keyed_values(spark, sf_dir):
    line = F.concat_ws(" ", "p_partkey", F.col("p_size").cast("double"), "p_retailprice")
    rows = _table(spark, sf_dir, "part").select(keyed_fields(line).alias("r")).select("r.*")
    return _entries(
        rows.withColumn("features", V.dense_to_sparse(F.col("features"))), "key"
    )


def point_lines(spark, sf_dir):
    items = _items(spark, sf_dir)
    vector = V.dense_to_sparse(F.col("features"))
    return items.select(V.format_labeled(F.col("l_linenumber"), vector).alias("line"))


def point_roundtrip(spark, sf_dir):
    points = point_lines(spark, sf_dir).select(V.parse_labeled(F.col("line")).alias("r"))
    return _entries(points.select("r.*"), "label")


def libsvm_roundtrip(spark, sf_dir):
    """Line items written as LibSVM lines and read back."""
    items = _items(spark, sf_dir).withColumnRenamed("l_linenumber", "label")
    points = items.select("label", V.dense_to_sparse(F.col("features")).alias("features"))
    path = f"{ensure_checkpoint_dir(spark)}/libsvm-{uuid.uuid4()}"
    sinks.write_labeled_points(points, path, "libsvm")
    return _entries(read_libsvm(spark, path, 3), "label")


def label_year(spark, sf_dir):
    year = F.year("o_orderdate")
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey", binarize(year, 1997, above=0).alias("label")
    )


def label_positive(spark, sf_dir):
    return _table(spark, sf_dir, "customer").select(
        "c_custkey", positive_or_zero(F.col("c_acctbal")).alias("label")
    )


def _categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five categorical features of a line item against its return flag."""
    return _table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        (F.ascii("l_returnflag") - 65).cast("double").alias("label"),
        V.dense_to_sparse(
            F.array(
                F.col("l_linenumber").cast("double") - 1,
                "l_quantity",
                "l_discount",
                "l_tax",
                (F.col("l_linestatus") == "F").cast("double"),
            )
        ).alias("features"),
    )


def chisq_test(spark, sf_dir):
    return chi_square(_categories(spark, sf_dir)).withColumn("chi2", F.round("chi2", 6))


def chisq_select(spark, sf_dir):
    return _entries(chi_square_select(_categories(spark, sf_dir), 2), "l_orderkey", "label")


# --- files, written first and read back ------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4()}"


@contextmanager
def _split_bytes(spark: SparkSession, size: int) -> Iterator[None]:
    """Files are read in splits of ``size`` bytes inside the block."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names}
    for name in names:
        spark.conf.set(name, str(size))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def documents_from_files(spark, sf_dir):
    """Every document as a file, names that start with ``_`` and ``.`` among them, read back."""
    name = F.concat(
        F.col("lang"),
        F.element_at(F.array(*map(F.lit, ("/", "/_", "/.", "/_old/", "/.x/_"))), F.col("doc_id").cast("int") % 5 + 1),
        F.col("doc_id").cast("string"),
    )
    documents = _table(spark, sf_dir, "documents").select(name.alias("name"), "text")
    folder = _folder(spark, "documents")
    write_files(documents, folder, "name", "text")
    doc_id = F.regexp_extract("doc_id", r"(\d+)$", 1).cast("bigint").alias("doc_id")
    return read_documents(spark, folder).select(doc_id, "content")


def _bibliography(record_year: Column) -> Column:
    """An order as a record that several lines hold; every seventh is not an article."""
    kind = F.when(F.col("o_orderkey") % 7 == 0, "book").otherwise("article")
    title = F.concat_ws(" ", "o_orderpriority", F.lit("Order"), "o_orderstatus", "o_custkey")
    year = F.when(F.col("o_orderkey") % 11 == 0, "").otherwise(
        F.concat(F.lit("<year>"), record_year.cast("string"), F.lit("</year>\n"))
    )
    parts = ["<", kind, " key='", F.col("o_orderkey").cast("string"), "'>\n<title>", title, ".</title>\n", year]
    return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in [*parts, "</", kind, ">"]))


def articles_from_files(spark, sf_dir):
    """Bibliography files read in many small splits, in larger ones and whole."""
    orders = _table(spark, sf_dir, "orders")
    folder = _folder(spark, "bibliography")
    records = orders.select(_bibliography(F.year("o_orderdate")).alias("value"))
    sinks.write_lines(records, F.col("value"), folder, 3)
    found = []
    for size in SPLIT_SIZES:
        with _split_bytes(spark, size):  # articles are kept as a table while it lasts
            found.append(cut_lineage(read_articles(spark, folder)).withColumn("split_bytes", F.lit(size)))
    return reduce(DataFrame.unionByName, found)


def stable_keys(spark, sf_dir):
    """Lines of a file keyed in splits of two sizes, with the text that lies there."""
    folder = _folder(spark, "lines")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    line = F.concat_ws("|", "o_orderkey", "o_orderpriority")
    sinks.write_lines(orders.orderBy("o_orderkey"), line, folder)
    found = []
    for size in SPLIT_SIZES[:2]:
        with _split_bytes(spark, size):
            keyed = numbered_lines(spark, folder).select("key", "value")
            found.append(cut_lineage(keyed).withColumn("split_bytes", F.lit(size)))
    return reduce(DataFrame.unionByName, found)


def split_folders(spark, sf_dir):
    """Training and test vectors in text folders of their own, checked and read back."""
    split = exact_split(_embeddings(spark, sf_dir), 50, SPLIT_SEED, key="vec_id")
    sparse = split.withColumn("features", V.dense_to_sparse(F.col("features")))
    folder = _folder(spark, "split")
    found = []
    for name, written in sinks.write_split(sparse, folder, "text", key="vec_id").items():
        sinks.check_written(spark, f"{folder}_{name}", written)
        read = read_sparse_vectors(spark, f"{folder}_{name}").withColumn("split", F.lit(name))
        found.append(read.withColumn("rows", F.lit(written.rows)))
    both = reduce(DataFrame.unionByName, found)
    return both.select("split", "rows", "key", V.inline_entries(F.col("vector"))).toDF(
        "split", "rows", "key", "idx", "value"
    )


def indexed_vectors(spark, sf_dir):
    """Vectors numbered by their length and id as text, checked and read back."""
    vectors = _embeddings(spark, sf_dir).select(
        "vec_id", V.dense_to_sparse(F.slice("features", 1, F.col("vec_id").cast("int") % 8 + 1)).alias("features")
    )
    vectors = vectors.withColumn("width", F.col("features")["size"])
    folder = _folder(spark, "vectors")
    order = [("width", "desc"), ("vec_id", "asc")]
    written = sinks.write_indexed_vectors(vectors, folder, order, "text")
    sinks.check_written(spark, folder, written)
    read = read_sparse_vectors(spark, folder).withColumn("rows", F.lit(written.rows))
    return read.select("rows", "key", V.inline_entries(F.col("vector"))).toDF("rows", "key", "idx", "value")


def histogram_lines(spark, sf_dir):
    """A histogram as text; its lines are told by their place, which is that of the buckets."""
    folder = _folder(spark, "histogram")
    written = sinks.write_histogram(bucket_histogram(spark, sf_dir), folder, "text")
    sinks.check_written(spark, folder, written)
    return numbered_lines(spark, folder).select("key", F.col("value").alias("line"))


def written_rows(spark, sf_dir):
    """Rows that writing labelled points reports, in every format, and those found there."""
    items = _items(spark, sf_dir).withColumnRenamed("l_linenumber", "label")
    points = items.select("label", V.dense_to_sparse(F.col("features")).alias("features"))
    points = points.withColumn("label", F.col("label").cast("double"))
    found = []
    for fmt in ("parquet", "text", "libsvm"):
        folder = _folder(spark, fmt)
        rows = sinks.write_labeled_points(points, folder, fmt)
        if fmt == "parquet":
            back = spark.read.parquet(folder)
        else:
            back = read_labeled_points(spark, folder) if fmt == "text" else read_libsvm(spark, folder, 3)
        total = F.round(F.sum(F.aggregate(F.col("features")["values"], F.lit(0.0), lambda a, x: a + x)), 2)
        found.append(
            back.agg(F.count(F.lit(1)).alias("n"), total.alias("total"))
            .withColumn("format", F.lit(fmt))
            .withColumn("rows", F.lit(rows))
        )
    return reduce(DataFrame.unionByName, found)


def lsh_from_file(spark, sf_dir):
    """The first vectors as hash functions in two files, a chain across both, then used."""
    functions = _embeddings(spark, sf_dir).filter(F.col("vec_id") < FILE_CHAIN * FILE_TABLES)
    line = V.format_sparse(V.dense_to_sparse(F.col("features")))
    folder = _folder(spark, "functions")
    edge = FILE_CHAIN + 2
    for part, rows in (("a", F.col("vec_id") < edge), ("b", F.col("vec_id") >= edge)):
        one = functions.filter(rows).orderBy("vec_id").coalesce(1)
        sinks.write_lines(one, line, f"{folder}/{part}")
    params = read_lsh_params(spark, f"{folder}/*", "angle", FILE_CHAIN)
    return lsh_rows(lsh_index(_embeddings(spark, sf_dir), params), "vec_id")


def lsh_wide(spark, sf_dir):
    """Buckets of documents' hashed words among three million dimensions."""
    counted = hashing_tf(_words(spark, sf_dir), WIDE.dim)
    return lsh_rows(lsh_index(counted, WIDE), "doc_id")


# --- whole jobs, from files to files ------------------------------------------------


def _text_file(rows: DataFrame, line: Column, name: str, *order: str) -> str:
    """Lines written to a folder of their own, in the order given, as one file if there is one."""
    folder = _folder(rows.sparkSession, name)
    sinks.write_lines(rows.orderBy(*order).coalesce(1) if order else rows, line, folder)
    return folder


def job_mail_vectors(spark, sf_dir):
    """Documents as mail files; numbered TF-IDF vectors in the order of the files' names.

    A folder holds the names that begin alike, so none is listed that grows with the table.
    """
    digits = F.lpad(F.col("doc_id").cast("string"), 12, "0")
    name = F.concat(F.substring(digits, 1, 8), F.lit("/"), digits)
    folder, out = _folder(spark, "mail"), _folder(spark, "mail_vectors")
    write_files(_table(spark, sf_dir, "documents").select(name.alias("name"), "text"), folder, "name", "text")
    jobs.mail_vectors(spark, folder, out, fmt="text")
    rows = read_sparse_vectors(spark, out).withColumnRenamed("vector", "features")
    return _entries(rows, "key", value="weight").withColumn("weight", F.round("weight", 6))


def job_hash_vectors(spark, sf_dir):
    """Keyed vectors as text; their buckets and the histogram, both as lines."""
    vector = V.format_sparse(V.dense_to_sparse(F.col("features")), F.col("vec_id"))
    folder, out = _text_file(_embeddings(spark, sf_dir), vector, "keyed"), _folder(spark, "hashed")
    jobs.hash_vectors(spark, folder, out, ANGLE, fmt="text")
    hashed = spark.read.text(out).select(
        F.lit("vector").alias("kind"),
        F.regexp_extract("value", r"^\(\((\d+),", 1).alias("name"),
        F.regexp_extract("value", r"\),([-\d,]+)\)$", 1).alias("found"),
    )
    counted = spark.read.text(f"{out}_histogram").select(
        F.lit("histogram").alias("kind"),
        F.substring_index("value", "\t", 2).alias("name"),
        F.substring_index("value", "\t", -1).alias("found"),
    )
    return hashed.unionByName(counted)


def _points_of(spark: SparkSession, folder: str, value: str) -> DataFrame:
    return _entries(read_labeled_points(spark, folder), "label", value=value).withColumn(
        value, F.round(value, 6)
    )


def job_bibliography_points(spark, sf_dir):
    """Bibliography files; labelled title words."""
    orders = _table(spark, sf_dir, "orders")
    folder, out = _text_file(orders, _bibliography(F.year("o_orderdate")), "records"), _folder(spark, "titles")
    jobs.bibliography_points(spark, folder, out, 1000, fmt="text")
    return _points_of(spark, out, "tf")


def job_libsvm_points(spark, sf_dir):
    """LibSVM lines; the two best features by chi-square."""
    folder, out = _folder(spark, "categories"), _folder(spark, "selected")
    sinks.write_labeled_points(_categories(spark, sf_dir).select("label", "features"), folder, "libsvm")
    jobs.libsvm_points(spark, folder, out, select=2, num_features=5, fmt="text")
    return _points_of(spark, out, "value")


def job_csv_points(spark, sf_dir):
    """Label-first lines; labelled points."""
    line = F.concat_ws(",", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    folder, out = _text_file(_table(spark, sf_dir, "lineitem"), line, "csv"), _folder(spark, "points")
    jobs.csv_points(spark, folder, out, fmt="text")
    return _points_of(spark, out, "value")


def job_linkage_points(spark, sf_dir):
    """Label-last lines with gaps; points expanded at once, and saved first and expanded then."""
    folder = _text_file(_table(spark, sf_dir, "lineitem"), _gappy_line(), "linkage")
    once, saved, then = (_folder(spark, name) for name in ("cubic", "plain", "cubic_later"))
    text = {"fmt": "text", "compression": "gzip"}
    jobs.linkage_points(spark, folder, once, **text)
    jobs.linkage_points(spark, folder, saved, degree=1, **text)
    jobs.expand_points(spark, saved, then, **text)
    both = [(once, "at once"), (then, "later")]
    return reduce(
        DataFrame.unionByName,
        [_points_of(spark, f, "term").withColumn("expanded", F.lit(name)) for f, name in both],
    )


def _split_rows(spark: SparkSession, out: str) -> DataFrame:
    found = [
        read_sparse_vectors(spark, f"{out}_{split}").withColumn("split", F.lit(split))
        for split in ("training", "test")
    ]
    both = reduce(DataFrame.unionByName, found).withColumnRenamed("vector", "features")
    return _entries(both, "split", "key")


def job_variance_vectors(spark, sf_dir):
    """Label-first lines of two sets; the dimensions that vary most in the first, of both."""
    vectors, out = _embeddings(spark, sf_dir), _folder(spark, "variance")
    line = F.concat_ws(",", F.lit("0"), F.array_join(F.col("features").cast("array<string>"), ","))
    test = F.col("vec_id") % 10 == 0
    folders = [_text_file(vectors.filter(rows), line, "dense", "vec_id") for rows in (~test, test)]
    jobs.variance_vectors(spark, *folders, out, k=10, fmt="text")
    return _split_rows(spark, out)


def job_split_vectors(spark, sf_dir):
    """Key-first lines; an exact split into training and test vectors."""
    line = F.concat_ws(" ", "vec_id", F.array_join(F.col("features").cast("array<string>"), " "))
    folder, out = _text_file(_embeddings(spark, sf_dir), line, "keyed_lines"), _folder(spark, "split_job")
    jobs.split_vectors(spark, folder, out, 50, SPLIT_SEED, fmt="text")
    return _split_rows(spark, out)


# --- contract -----------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """L2-normalized TF-IDF weights of the documents."""
    return tfidf_weights(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = {**llm.queries(), "pipeline": corpus_pipeline.run} if llm else {}
    return own_queries() | more


def oracle_sql() -> dict[str, str]:
    return own_oracle_sql() | (llm.oracle_sql() if llm else {})


def own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "line_filter": line_filter,
        "word_count": words_counted,
        "top_fraction_vocab": vocab_table,
        "vocab_filter": vocab_filter,
        "hashing_tf": term_frequencies,
        "idf": idf_table,
        "tfidf_l2": tfidf_weights,
        "important_terms": terms_ranked,
        "important_terms_kept": terms_kept,
        "important_terms_renumbered": terms_renumbered,
        "dim_variance": dimension_variance,
        "dim_select": dimension_select,
        "variance_split": variance_split,
        "dense_to_sparse": sparse_entries,
        "sparse_roundtrip": sparse_roundtrip,
        "sparse_dot": neighbour_dots,
        "equal_vectors": equal_vectors,
        "vector_equality": vector_equality,
        "hash_function_lines": hash_function_lines,
        "libsvm_roundtrip": libsvm_roundtrip,
        "lsh_angle": _lsh(ANGLE),
        "lsh_angle_uniform_sign": _lsh(ANGLE_SIGNED),
        "lsh_pstable": _lsh(PSTABLE),
        "lsh_pstable_folded": _lsh(PSTABLE, chain="folded"),
        "lsh_own_family": _lsh(SIGNED_MAX),
        "lsh_pstable_first": _lsh(PSTABLE, chain="first", rounding="trunc"),
        "lsh_text": lsh_text,
        "lsh_histogram": bucket_histogram,
        "lsh_lines": bucket_lines,
        "csv_to_labeled": csv_points,
        "missing_to_zero": missing_to_zero,
        "keyed_values": keyed_values,
        "point_lines": point_lines,
        "point_roundtrip": point_roundtrip,
        "label_threshold": label_year,
        "label_positive": label_positive,
        "poly3": cubic_terms,
        "chisq_test": chisq_test,
        "chisq_select": chisq_select,
        "exact_split": split_rows,
        "row_index": row_index,
        "extract_title_year": title_words,
        "title_points": bibliography_titles,
        "documents_from_files": documents_from_files,
        "articles_from_files": articles_from_files,
        "stable_keys": stable_keys,
        "split_folders": split_folders,
        "indexed_vectors": indexed_vectors,
        "histogram_lines": histogram_lines,
        "written_rows": written_rows,
        "lsh_from_file": lsh_from_file,
        "lsh_wide": lsh_wide,
        "job_mail_vectors": job_mail_vectors,
        "job_hash_vectors": job_hash_vectors,
        "job_bibliography_points": job_bibliography_points,
        "job_libsvm_points": job_libsvm_points,
        "job_csv_points": job_csv_points,
        "job_linkage_points": job_linkage_points,
        "job_variance_vectors": job_variance_vectors,
        "job_split_vectors": job_split_vectors,
    }


# --- SQL ----------------------------------------------------------------------------

_HEADERS = "|".join(MAIL_HEADERS)

_TEXT = rf"""
WITH body AS (
  SELECT doc_id, list_filter(string_split_regex(text, '\r\n|\n|\r'),
    lambda x: (length(x) >= 2 OR strlen(x) = 4) AND NOT regexp_matches(x, '^({_HEADERS})')) AS kept
  FROM documents),
content AS (
  SELECT doc_id, coalesce(array_to_string(list_transform(kept, lambda x: x || ' '), ''), '') AS content
  FROM body),
words AS (
  SELECT doc_id, CASE WHEN rtrim(content, ' ') = '' AND content <> '' THEN []
                      ELSE string_split(rtrim(content, ' '), ' ') END AS words
  FROM content),
counts AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(words) AS word FROM words) GROUP BY word),
vocab AS (
  SELECT word, n FROM (
    SELECT *, row_number() OVER (ORDER BY n DESC, word) AS r, count(*) OVER () AS total FROM counts)
  WHERE r <= floor(total * 0.005::DOUBLE))"""


def _hash_sql(word: str) -> str:
    """The 32-bit string hash over UTF-16 units, signed."""
    units = (
        f"flatten(list_transform(string_split({word}, ''), lambda c: CASE WHEN unicode(c) < 65536"
        " THEN [unicode(c)] ELSE [55296 + ((unicode(c) - 65536) >> 10),"
        " 56320 + ((unicode(c) - 65536) & 1023)] END))"
    )
    unsigned = (
        f"list_reduce(list_prepend(0::BIGINT, {units}::BIGINT[]),"
        " lambda h, u: (h * 31 + u) % 4294967296)"
    )
    return (
        f"CASE WHEN {word} = '' THEN 0 WHEN {unsigned} >= 2147483648"
        f" THEN {unsigned} - 4294967296 ELSE {unsigned} END"
    )


def _tf_sql(source: str, width: str) -> str:
    """Hashed term frequencies ``tf(doc_id, idx, tf)`` of ``source(doc_id, word)``."""
    return f""",
indexed AS (
  SELECT word, ((h % width + width) % width)::INTEGER AS idx
  FROM (SELECT word, {_hash_sql("word")} AS h, {width} AS width
        FROM (SELECT DISTINCT word FROM {source}))),
tf AS (
  SELECT doc_id, idx, count(*)::DOUBLE AS tf
  FROM {source} JOIN indexed USING (word) GROUP BY doc_id, idx)"""


_WEIGHTS = """,
idf AS (
  SELECT idx, count(*) AS df, ln((m + 1.0) / (count(*) + 1)) AS idf
  FROM tf, (SELECT count(DISTINCT doc_id) AS m FROM tf) GROUP BY idx, m),
raw AS (SELECT doc_id, idx, tf * idf AS w FROM tf JOIN idf USING (idx)),
weights AS (
  SELECT doc_id, idx, round(CASE WHEN norm > 0 THEN w / norm ELSE 0 END, 6) AS weight, w, norm
  FROM raw JOIN (SELECT doc_id, sqrt(sum(w * w)) AS norm FROM raw GROUP BY doc_id) USING (doc_id))"""

_PRUNED = (
    _TEXT
    + """,
kept AS (SELECT doc_id, word FROM (SELECT doc_id, unnest(words) AS word FROM words)
         SEMI JOIN vocab USING (word))"""
    + _tf_sql("kept", "(SELECT count(*) FROM vocab)")
)

_TERMS = (
    _PRUNED
    + _WEIGHTS
    + f""",
best AS (SELECT idx, max(weight) AS max_weight FROM weights GROUP BY idx),
terms AS (
  SELECT idx, max_weight, (row_number() OVER (ORDER BY idx) - 1)::INTEGER AS place FROM (
    SELECT *, row_number() OVER (ORDER BY max_weight DESC, idx) AS r, count(*) OVER () AS total
    FROM best)
  WHERE r <= floor(total * {TERM_FRACTION}::DOUBLE))"""
)


def _params_sql(params: LshParams) -> str:
    rows = [
        f"({t}, {p}, {[float(x) for x in params.a[t, p]]}::DOUBLE[],"
        f" {float(params.b[t, p])}::DOUBLE, {float(params.w[t, p])}::DOUBLE)"
        for t in range(params.tables)
        for p in range(params.chain)
    ]
    return "params(table_id, pos, a, b, w) AS (VALUES " + ", ".join(rows) + ")"


def _bits_sql(params: LshParams) -> str:
    return f"sum(CASE WHEN dot > 0 THEN 1::BIGINT << ({params.chain} - 1 - pos) ELSE 0 END)::BIGINT"


_DOTS = """,
dots AS (SELECT vec_id, table_id, pos, b, w,
                list_inner_product(embedding::DOUBLE[], a) AS dot FROM embeddings, params)"""

_ITEMS = """items AS (
  SELECT *, [l_quantity, l_discount, l_tax]::DOUBLE[] AS x FROM lineitem),
entries AS (
  SELECT *, unnest(x) AS value, (unnest(range(3)))::INTEGER AS idx FROM items)"""

_ITEM_TEXT = """
'3,[' || array_to_string(list_filter([0, 1, 2], lambda i: x[i + 1] <> 0), ',') || '],['
      || array_to_string(list_transform(list_filter(x, lambda v: v <> 0), lambda v: v::VARCHAR), ',')
      || ']'"""

_SPLIT = f"""split AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY md5('{SPLIT_SEED}:' || vec_id), vec_id) <= 50
                 THEN 'test' ELSE 'training' END AS split
  FROM embeddings)"""


def _variance_sql(source: str) -> str:
    return f"""stats AS (
  SELECT dim, avg(v) AS mean, var_pop(v) AS var
  FROM (SELECT unnest(embedding)::DOUBLE AS v, unnest(range(64))::INTEGER AS dim FROM {source})
  GROUP BY dim),
top AS (SELECT * FROM stats ORDER BY var DESC, dim LIMIT 10),
placed AS (SELECT dim, (row_number() OVER (ORDER BY dim) - 1)::INTEGER AS pos FROM top)"""


_TITLE = r"regexp_extract(html, '(?s)<title(?:\s[^>]*)?>(.*?)</title>', 1)"
_CLEAN = rf"rtrim(lower(regexp_replace({_TITLE}, '\.$', '')), ' ')"

_FEATURES = [
    "l_linenumber - 1",
    "l_quantity",
    "l_discount",
    "l_tax",
    "CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END",
]
_CHISQ = (
    "WITH long AS (SELECT l_orderkey, (ascii(l_returnflag) - 65)::DOUBLE AS label,"
    " unnest([" + ", ".join(f"({f})::DOUBLE" for f in _FEATURES) + "]) AS value,"
    " (unnest(range(5)))::INTEGER AS idx FROM lineitem),"
    """
rows_ AS (SELECT idx, value, count(*) AS r FROM long GROUP BY idx, value),
cols_ AS (SELECT idx, label, count(*) AS c FROM long GROUP BY idx, label),
total AS (SELECT count(*)::DOUBLE AS n FROM lineitem),
cells AS (SELECT idx, value, label, count(*) AS o FROM long GROUP BY idx, value, label),
test AS (
  SELECT idx, sum(pow(coalesce(o, 0) - r * c / n, 2) / (r * c / n)) AS chi2
  FROM rows_ JOIN cols_ USING (idx) LEFT JOIN cells USING (idx, value, label), total
  GROUP BY idx)"""
)


def _wide_sql() -> str:
    """The coefficients of :data:`WIDE` for the indices that occur, by the same hash."""
    modulus = f"{2**64}::UHUGEINT"

    def times(x: str, factor: int) -> str:
        return f"(({x})::UHUGEINT * {factor}::UHUGEINT % {modulus})::UBIGINT"

    def plus(x: str, y: str) -> str:
        return f"((({x})::UHUGEINT + ({y})::UHUGEINT) % {modulus})::UBIGINT"

    def mixed(x: str) -> str:
        steps = ((30, MIXERS[0]), (27, MIXERS[1]))
        for shift, factor in steps:
            x = f"list_transform([{x}], lambda v: {times(f'xor(v, v >> {shift})', factor)})[1]"
        return f"list_transform([{x}], lambda v: xor(v, v >> 31))[1]"

    keyed = mixed(plus(f"{WIDE.seed}::UBIGINT", times("(member + 1)::UBIGINT", GOLDEN)))
    drawn = mixed(plus("k", times("(idx + 1)::UBIGINT", GOLDEN)))
    places = ", ".join(
        f"({t}, {p}, {WIDE.drawn[t, p]})" for t in range(WIDE.tables) for p in range(WIDE.chain)
    )
    return f""",
places(table_id, pos, member) AS (VALUES {places}),
members AS (SELECT member, {keyed} AS k FROM (SELECT DISTINCT member FROM places)),
bits AS (SELECT member, idx, {drawn} AS z FROM members, (SELECT DISTINCT idx FROM tf)),
coefficients AS (
  SELECT member, idx, sqrt(-2 * ln(((z >> 32)::DOUBLE + 0.5) / 4294967296))
         * cos(2 * pi() * ((z & 4294967295)::DOUBLE + 0.5) / 4294967296) AS a FROM bits),
member_dots AS (
  SELECT doc_id, member, sum(tf * a) AS dot FROM tf JOIN coefficients USING (idx) GROUP BY doc_id, member),
dots AS (SELECT doc_id, table_id, pos, dot FROM member_dots JOIN places USING (member))
SELECT d.doc_id, p.table_id::INTEGER AS table_id,
       sum(CASE WHEN dot > 0 THEN 1::BIGINT << ({WIDE.chain} - 1 - pos) ELSE 0 END)::BIGINT AS bucket
FROM words d CROSS JOIN (SELECT DISTINCT table_id FROM places) p
LEFT JOIN dots USING (doc_id, table_id) GROUP BY d.doc_id, p.table_id"""


# expansion order of three variables: the power of the last one varies slowest
_CUBIC = [
    (i, j, k) for k in range(4) for j in range(4 - k) for i in range(4 - k - j) if i + j + k > 0
]


def own_oracle_sql() -> dict[str, str]:
    cubic = ", ".join(f"pow(q, {i}) * pow(d, {j}) * pow(t, {k})" for i, j, k in _CUBIC)
    gappy = (
        "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1.0 ELSE 0.0 END::DOUBLE"
        " AS label, l_quantity AS q, CASE WHEN l_discount = 0.05 THEN 0.0 ELSE l_discount END AS d,"
        " l_tax AS t FROM lineitem"
    )
    return {
        "line_filter": _TEXT + " SELECT doc_id, content FROM content",
        "word_count": _TEXT + " SELECT word, n FROM counts",
        "top_fraction_vocab": _TEXT + " SELECT word, n FROM vocab",
        "vocab_filter": _TEXT
        + """,
kept AS (SELECT doc_id, word, place FROM (
           SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM words)
         SEMI JOIN vocab USING (word))
SELECT doc_id, count(*)::INTEGER AS n_kept, string_agg(word, ' ' ORDER BY place) AS kept
FROM kept GROUP BY doc_id""",
        "hashing_tf": _PRUNED + " SELECT doc_id, idx, tf FROM tf",
        "idf": _PRUNED + _WEIGHTS + " SELECT idx, df, round(idf, 6) AS idf FROM idf",
        "tfidf_l2": _PRUNED + _WEIGHTS + " SELECT doc_id, idx, weight FROM weights",
        "important_terms": _TERMS + " SELECT idx, max_weight FROM terms",
        "important_terms_kept": _TERMS
        + " SELECT doc_id, idx, weight FROM weights SEMI JOIN terms USING (idx)",
        "important_terms_renumbered": _TERMS
        + " SELECT doc_id, place AS idx, weight FROM weights JOIN terms USING (idx)",
        "dim_variance": f"WITH {_variance_sql('embeddings')}"
        " SELECT dim, round(mean, 6) AS mean, round(var, 6) AS var FROM top",
        "dim_select": f"WITH {_variance_sql('embeddings')}"
        " SELECT vec_id, pos, embedding[dim + 1]::DOUBLE AS value FROM embeddings, placed",
        "variance_split": f"""WITH {_SPLIT},
training AS (SELECT * FROM split WHERE split = 'training'), {_variance_sql('training')}
SELECT vec_id, split, pos AS idx, embedding[dim + 1]::DOUBLE AS value FROM split, placed
WHERE embedding[dim + 1] <> 0""",
        "dense_to_sparse": f"WITH {_ITEMS}"
        " SELECT l_orderkey, l_linenumber, idx, value FROM entries WHERE value <> 0",
        "sparse_roundtrip": """
SELECT vec_id, form::INTEGER AS form, CASE WHEN form > 0 THEN vec_id END AS key,
       len(list_filter(embedding, lambda x: x <> 0))::INTEGER AS n,
       round(list_sum(embedding::DOUBLE[]), 6) AS total
FROM embeddings, range(3) AS forms(form)""",
        "sparse_dot": """
SELECT a.vec_id AS a, b.vec_id AS b,
       round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS dot
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
        "vector_equality": f"""
WITH {_ITEMS}, next_ AS (SELECT l_orderkey, l_linenumber - 1 AS l_linenumber, x FROM items)
SELECT l_orderkey, l_linenumber, a.x = b.x AS equal, a.x = b.x AS same_hash
FROM items a JOIN next_ b USING (l_orderkey, l_linenumber)""",
        "hash_function_lines": """
SELECT vec_id, unnest(range(len(embedding)))::INTEGER AS pos,
       unnest(embedding)::DOUBLE AS coefficient, label::DOUBLE AS b, (label + 1)::DOUBLE AS w
FROM embeddings""",
        "libsvm_roundtrip": f"WITH {_ITEMS} SELECT l_linenumber::DOUBLE AS label, idx, value"
        " FROM entries WHERE value <> 0",
        "equal_vectors": """
SELECT l_quantity AS quantity, l_discount AS discount, l_tax AS tax, count(*) AS n
FROM lineitem GROUP BY ALL""",
        "lsh_angle": f"WITH {_params_sql(ANGLE)}{_DOTS} SELECT vec_id, table_id::INTEGER AS table_id,"
        f" {_bits_sql(ANGLE)} AS bucket FROM dots GROUP BY vec_id, table_id",
        "lsh_angle_uniform_sign": f"WITH {_params_sql(ANGLE_SIGNED)}{_DOTS} SELECT vec_id,"
        f" table_id::INTEGER AS table_id, {_bits_sql(ANGLE_SIGNED)} AS bucket"
        " FROM dots GROUP BY vec_id, table_id",
        "lsh_pstable": f"WITH {_params_sql(PSTABLE)}{_DOTS} SELECT vec_id, table_id::INTEGER AS table_id,"
        " string_agg(floor((dot + b) / w)::BIGINT::VARCHAR, ':' ORDER BY pos) AS bucket"
        " FROM dots GROUP BY vec_id, table_id",
        "lsh_pstable_folded": f"WITH {_params_sql(PSTABLE)}{_DOTS}, chains AS ("
        "SELECT vec_id, table_id, list(floor((dot + b) / w)::HUGEINT ORDER BY pos) AS numbers"
        " FROM dots GROUP BY vec_id, table_id), folded AS (SELECT vec_id, table_id, list_reduce("
        f"list_prepend(0::HUGEINT, numbers), lambda h, x: ((h * {FOLD} + x) % {2**64} + {2**64})"
        f" % {2**64}) AS h FROM chains) SELECT vec_id, table_id::INTEGER AS table_id,"
        f" (CASE WHEN h >= {2**63} THEN h - {2**64} ELSE h END)::BIGINT AS bucket FROM folded",
        "lsh_own_family": f"WITH {_params_sql(SIGNED_MAX)}{_DOTS} SELECT vec_id,"
        " table_id::INTEGER AS table_id, arg_max(2 * pos + CASE WHEN dot < 0 THEN 1 ELSE 0 END,"
        " abs(dot))::BIGINT AS bucket FROM dots GROUP BY vec_id, table_id",
        "lsh_pstable_first": f"WITH {_params_sql(PSTABLE)}{_DOTS} SELECT vec_id,"
        " table_id::INTEGER AS table_id, trunc((dot + b) / w)::BIGINT AS bucket"
        " FROM dots WHERE pos = 0",
        "lsh_text": _TEXT
        + ", tokens_ AS (SELECT doc_id, unnest(words) AS word FROM words)"
        + _tf_sql("tokens_", "256")
        + _WEIGHTS
        + f", {_params_sql(ANGLE_TEXT)}"
        + """,
dots AS (SELECT doc_id, table_id, pos,
                sum(CASE WHEN norm > 0 THEN w / norm ELSE 0 END * a[idx + 1]) AS dot
         FROM (SELECT doc_id, idx, weights.w AS w, norm FROM weights),
              (SELECT table_id, pos, a FROM params) GROUP BY doc_id, table_id, pos)
SELECT doc_id, table_id::INTEGER AS table_id, """
        + f"{_bits_sql(ANGLE_TEXT)} AS bucket FROM dots GROUP BY doc_id, table_id",
        "lsh_histogram": f"WITH {_params_sql(ANGLE)}{_DOTS},"
        f" buckets AS (SELECT vec_id, table_id, {_bits_sql(ANGLE)} AS bucket"
        " FROM dots GROUP BY vec_id, table_id)"
        " SELECT table_id::INTEGER AS table_id, bucket, count(*) AS n"
        " FROM buckets GROUP BY table_id, bucket",
        "lsh_lines": f"WITH {_ITEMS}, {_params_sql(ANGLE_ITEM)},"
        f"""
vectors AS (SELECT DISTINCT x FROM items),
dots AS (SELECT x, table_id, pos, list_inner_product(x, a) AS dot FROM vectors, params),
buckets AS (SELECT x, table_id, {_bits_sql(ANGLE_ITEM)} AS bucket FROM dots GROUP BY x, table_id),
listed AS (SELECT x, string_agg(bucket::VARCHAR, ',' ORDER BY table_id) AS b FROM buckets GROUP BY x)
SELECT '((' || l_orderkey || ',' || {_ITEM_TEXT} || '),' || b || ')' AS line
FROM items JOIN listed USING (x)""",
        "csv_to_labeled": f"WITH {_ITEMS} SELECT l_orderkey, l_linenumber::DOUBLE AS label, idx, value"
        " FROM entries WHERE value <> 0",
        "missing_to_zero": f"WITH points AS ({gappy}) SELECT l_orderkey, l_linenumber, label,"
        " unnest(range(3))::INTEGER AS idx, unnest([q, d, t]) AS value FROM points",
        "keyed_values": """
SELECT * FROM (SELECT p_partkey AS key, unnest(range(2))::INTEGER AS idx,
                      unnest([p_size::DOUBLE, p_retailprice]) AS value FROM part)
WHERE value <> 0""",
        "point_lines": f"WITH {_ITEMS} SELECT '(' || l_linenumber::DOUBLE || ',(' || {_ITEM_TEXT}"
        " || '))' AS line FROM items",
        "point_roundtrip": f"WITH {_ITEMS} SELECT l_linenumber::DOUBLE AS label, idx, value"
        " FROM entries WHERE value <> 0",
        "label_threshold": "SELECT o_orderkey, CASE WHEN year(o_orderdate) > 1997 THEN 0 ELSE 1 END"
        " AS label FROM orders",
        "label_positive": "SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END::DOUBLE"
        " AS label FROM customer",
        "poly3": f"""WITH points AS ({gappy}),
terms AS (SELECT l_orderkey, l_linenumber, label, unnest(range({len(_CUBIC)}))::INTEGER AS idx,
                 unnest([{cubic}]) AS term FROM points)
SELECT l_orderkey, l_linenumber, label, idx, round(term, 6) AS term FROM terms WHERE term <> 0""",
        "chisq_test": _CHISQ + " SELECT idx, round(chi2, 6) AS chi2 FROM test",
        "chisq_select": _CHISQ
        + """,
chosen AS (SELECT idx, (row_number() OVER (ORDER BY idx) - 1)::INTEGER AS place
           FROM (SELECT idx FROM test ORDER BY round(chi2, 9) DESC, idx LIMIT 2))
SELECT l_orderkey, label, place AS idx, value FROM long JOIN chosen USING (idx) WHERE value <> 0""",
        "exact_split": f"WITH {_SPLIT} SELECT vec_id, split FROM split",
        "row_index": "SELECT o_totalprice, o_orderkey,"
        " row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS row_index FROM orders",
        "extract_title_year": f"SELECT page_id, array_to_string(string_split({_CLEAN}, ' '), '|')"
        " AS words FROM pages",
        "title_points": f"""
WITH titles AS (SELECT o_orderkey AS doc_id, year(o_orderdate) AS year,
  lower(concat_ws(' ', o_orderpriority, 'Order', o_orderstatus, o_custkey)) AS title FROM orders),
title_words AS (SELECT doc_id, unnest(string_split(title, ' ')) AS word FROM titles)"""
        + _tf_sql("title_words", "1000")
        + " SELECT doc_id AS o_orderkey, CASE WHEN year > 1997 THEN 0.0 ELSE 1.0 END::DOUBLE AS label,"
        " idx, tf FROM tf JOIN titles USING (doc_id)",
        "documents_from_files": _TEXT + " SELECT doc_id, content FROM content",
        "articles_from_files": f"""
SELECT concat_ws(' ', o_orderpriority, 'Order', o_orderstatus, o_custkey) || '.' AS title,
       year(o_orderdate)::INTEGER AS year, unnest([{", ".join(map(str, SPLIT_SIZES))}]) AS split_bytes
FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0""",
        "stable_keys": f"""
SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS key, o_orderkey || '|' || o_orderpriority AS value,
       unnest([{", ".join(map(str, SPLIT_SIZES[:2]))}]) AS split_bytes FROM orders""",
        "split_folders": f"""WITH {_SPLIT}
SELECT split, (count(*) OVER (PARTITION BY split, idx)) AS rows, vec_id AS key, idx::INTEGER AS idx, value
FROM (SELECT split, vec_id, unnest(range(64)) AS idx, unnest(embedding)::DOUBLE AS value FROM split)
QUALIFY value <> 0""",
        "indexed_vectors": """
SELECT * FROM (
  SELECT (SELECT count(*) FROM embeddings) AS rows, key, (unnest(range(width)))::INTEGER AS idx,
         unnest(embedding[:width])::DOUBLE AS value
  FROM (SELECT *, row_number() OVER (ORDER BY vec_id % 8 DESC, vec_id) - 1 AS key, vec_id % 8 + 1 AS width
        FROM embeddings))
WHERE value <> 0""",
        "histogram_lines": f"WITH {_params_sql(ANGLE)}{_DOTS},"
        f" buckets AS (SELECT vec_id, table_id, {_bits_sql(ANGLE)} AS bucket"
        " FROM dots GROUP BY vec_id, table_id),"
        " counted AS (SELECT table_id, bucket, count(*) AS n FROM buckets GROUP BY ALL)"
        " SELECT row_number() OVER (ORDER BY table_id, bucket) - 1 AS key,"
        " concat_ws(chr(9), table_id, bucket, n) AS line FROM counted",
        "written_rows": """
SELECT unnest(['parquet', 'text', 'libsvm']) AS format, count(*) AS rows, count(*) AS n,
       round(sum(l_quantity + l_discount + l_tax), 2) AS total FROM lineitem""",
        "lsh_from_file": f"""
WITH params AS (
  SELECT vec_id // {FILE_CHAIN} AS table_id, vec_id % {FILE_CHAIN} AS pos, embedding::DOUBLE[] AS a
  FROM embeddings WHERE vec_id < {FILE_CHAIN * FILE_TABLES}),
dots AS (SELECT vec_id, table_id, pos, list_inner_product(embedding::DOUBLE[], a) AS dot
         FROM (SELECT vec_id, embedding FROM embeddings), params)
SELECT vec_id, table_id::INTEGER AS table_id,
       sum(CASE WHEN dot > 0 THEN 1::BIGINT << ({FILE_CHAIN} - 1 - pos::INTEGER) ELSE 0 END)::BIGINT AS bucket
FROM dots GROUP BY vec_id, table_id""",
        "lsh_wide": _TEXT
        + ", tokens_ AS (SELECT doc_id, unnest(words) AS word FROM words)"
        + _tf_sql("tokens_", str(WIDE.dim))
        + _wide_sql(),
        "job_mail_vectors": _PRUNED
        + _WEIGHTS
        + " SELECT key, idx, weight FROM weights JOIN"
        " (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS key"
        "  FROM (SELECT DISTINCT doc_id FROM tf)) USING (doc_id)",
        "job_hash_vectors": f"WITH {_params_sql(ANGLE)}{_DOTS},"
        f" buckets AS (SELECT vec_id, table_id, {_bits_sql(ANGLE)} AS bucket"
        " FROM dots GROUP BY vec_id, table_id)"
        " SELECT 'vector' AS kind, vec_id::VARCHAR AS name,"
        " string_agg(bucket::VARCHAR, ',' ORDER BY table_id) AS found FROM buckets GROUP BY vec_id"
        " UNION ALL SELECT 'histogram', concat_ws(chr(9), table_id, bucket), count(*)::VARCHAR"
        " FROM buckets GROUP BY table_id, bucket",
        "job_bibliography_points": """
WITH titles AS (SELECT o_orderkey AS doc_id, year(o_orderdate) AS year,
  lower(concat_ws(' ', o_orderpriority, 'Order', o_orderstatus, o_custkey)) AS title FROM orders
  WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0),
title_words AS (SELECT doc_id, unnest(string_split(title, ' ')) AS word FROM titles)"""
        + _tf_sql("title_words", "1000")
        + " SELECT CASE WHEN year > 2007 THEN 0.0 ELSE 1.0 END::DOUBLE AS label,"
        " idx, tf FROM tf JOIN titles USING (doc_id)",
        "job_libsvm_points": _CHISQ
        + """,
chosen AS (SELECT idx, (row_number() OVER (ORDER BY idx) - 1)::INTEGER AS place
           FROM (SELECT idx FROM test ORDER BY round(chi2, 9) DESC, idx LIMIT 2))
SELECT label, place AS idx, value FROM long JOIN chosen USING (idx) WHERE value <> 0""",
        "job_csv_points": f"WITH {_ITEMS} SELECT l_linenumber::DOUBLE AS label, idx, value"
        " FROM entries WHERE value <> 0",
        "job_linkage_points": f"""WITH points AS ({gappy}),
terms AS (SELECT label, unnest(range({len(_CUBIC)}))::INTEGER AS idx, unnest([{cubic}]) AS term FROM points)
SELECT label, idx, round(term, 6) AS term, unnest(['at once', 'later']) AS expanded
FROM terms WHERE term <> 0""",
        "job_variance_vectors": f"""
WITH training AS (SELECT * FROM embeddings WHERE vec_id % 10 <> 0), {_variance_sql('training')},
keyed AS (SELECT *, CASE WHEN vec_id % 10 = 0 THEN 'test' ELSE 'training' END AS split,
                 row_number() OVER (ORDER BY vec_id % 10 = 0, vec_id) - 1 AS key FROM embeddings)
SELECT split, key, pos AS idx, embedding[dim + 1]::DOUBLE AS value FROM keyed, placed
WHERE embedding[dim + 1] <> 0""",
        "job_split_vectors": f"""WITH {_SPLIT}
SELECT split, vec_id AS key, idx, value FROM (
  SELECT split, vec_id, unnest(range(64))::INTEGER AS idx, unnest(embedding)::DOUBLE AS value FROM split)
WHERE value <> 0""",
    }
