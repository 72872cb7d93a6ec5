"""A training-corpus pipeline: every stage takes and returns documents, the last packs them.

Decisions on a text are joined back by a digest of the text, so that rows without an id and
rows with equal ids are judged like all others. Every stage but the last keeps the columns of
``documents``, whatever else is among them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veclode.llm import quality, secret_scan
from veclode.llm.common import fresh_name
from veclode.llm.decontamination import decontaminate, is_contaminated
from veclode.llm.jaccard_join import jaccard_components
from veclode.llm.packing import pack
from veclode.llm.queries import tokenizer_path
from veclode.session import bounded_batches, cut_lineage, release


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned ones. Null and empty texts go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, quality.fit_rules(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: that with the least id, then text digest.

    Rows with the same id and text are one document. A text without words, null or not, is
    similar to no other; a missing id counts as the least.
    """
    key, many, own = (fresh_name(docs, n) for n in ("key_", "many_", "kept_"))
    named = docs.withColumn(key, F.struct("doc_id", F.md5("text").alias("digest")))
    found = jaccard_components(named, key=key)
    kept = found.where(F.col(key).eqNullSafe(F.col("component_id")))
    kept = kept.groupBy(F.col(key).alias(own)).agg(F.count(F.lit(1)).alias(many))
    same = F.col(f"{key}.doc_id").eqNullSafe(F.col(f"{own}.doc_id"))
    same &= F.col(f"{key}.digest").eqNullSafe(F.col(f"{own}.digest"))
    # every row has its copies counted; the few with copies are thinned out
    joined = named.join(kept, same).drop(own)
    once = joined.where(F.col(many) == 1).select(docs.columns)
    if kept.where(F.col(many) > 1).isEmpty():
        return once
    return once.unionByName(joined.where(F.col(many) > 1).dropDuplicates([key]).select(docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not contaminated by passages of the benchmark. A null or empty text is not
    contaminated and stays; rows of equal texts go or stay together; an empty table, or an
    empty benchmark, changes nothing."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    key = fresh_name(docs, "digest_")
    named = docs.withColumn(key, F.md5("text"))
    found = decontaminate(named, items, key=key)
    bad = found.where(is_contaminated()).select(key).distinct()
    return named.join(bad, key, "left_anti").select(docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; ``n_chars`` follows a text that changed."""
    bounded_batches(spark)
    clean = fresh_name(docs, "clean_")
    masked = docs.withColumn(clean, secret_scan.mask_secrets(F.col("text")))
    changed = F.col(clean) != F.col("text")
    count = F.when(changed, F.length(clean)).otherwise(F.col("n_chars")).alias("n_chars")
    columns = {"text": F.col(clean).alias("text"), "n_chars": count}
    return masked.select([columns.get(c, F.col(f"`{c}`")) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 4096 tokens. A null or empty text is one
    piece of one token; repeated rows are packed one by one; no documents give no pieces."""
    return pack(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scans),
    ("packing", packing),
]

# The learned rules have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``, each written as Parquet and read again.

    A stage's table is removed when the next one is written; the last one's lives as long as
    the result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        before, docs = docs, cut_lineage(stage(spark, docs, sf_dir))
        release(before)
    return docs
