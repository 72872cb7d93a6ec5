"""Hashed term frequencies, inverse document frequency, L2 weights and term pruning."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..functions.arrays import let
from ..session import bounded_batches, cut_lineage
from .columns import with_bound_column
from .lookup import match_elements
from .ranking import TAKE_ORDERED_ROWS, top_rows, with_row_index
from .shipped import INLINE_VALUES, SHIPPED_BYTES, values_at
from .terms import count_terms


def hashing_tf(
    df: DataFrame,
    num_features: int,
    words: str = "words",
    out: str = "features",
    hash: str = "string",
) -> DataFrame:
    """Term frequencies by feature index, as a sparse vector next to the row's other columns.

    ``hash``: ``string`` for the JVM string hash, ``murmur3`` for the ML library's
    ``HashingTF``. Either way each document is counted inside its own row.
    """
    if hash == "murmur3":
        stage = HashingTF(numFeatures=num_features, inputCol=words, outputCol=out)
        return stage.transform(df).withColumn(out, V.from_ml_vector(F.col(out)))
    if hash != "string":
        raise ValueError(f"unknown hash {hash!r}")
    bounded_batches(df.sparkSession)
    return df.withColumn(out, count_terms(F.col(words), num_features))


@dataclass(frozen=True)
class Idf:
    """``table`` (idx, df, idf) of the indices seen, and the number of documents."""

    table: DataFrame
    documents: int
    num_features: int


def fit_idf(df: DataFrame, num_features: int, features: str = "features") -> Idf:
    """Document frequencies and ``ln((m + 1) / (df + 1))``.

    Index -1 stands in every document, so one pass gives m as well.
    """
    seen = F.explode(F.concat(F.array(F.lit(-1)), F.col(features)["indices"]))
    counts = cut_lineage(
        df.select(seen.alias("idx")).groupBy("idx").agg(F.count(F.lit(1)).alias("df"))
    )
    row = counts.filter("idx = -1").head()
    documents = row["df"] if row else 0
    table = counts.filter("idx >= 0").withColumn(
        "idf", F.log(F.lit(float(documents + 1)) / (F.col("df") + 1))
    )
    return Idf(table, documents, num_features)


def _dense(table: DataFrame, column: str, width: int, default: float | int) -> np.ndarray:
    """The ``idx, column`` rows of a table as an array of the given width."""
    rows = table.select("idx", column).toArrow()
    dense = np.full(width, default)
    dense[rows.column("idx").to_numpy()] = rows.column(column).to_numpy()
    return dense


def apply_idf(
    df: DataFrame,
    idf: Idf,
    features: str = "features",
    inline_values: int = INLINE_VALUES,
    shipped_bytes: int = SHIPPED_BYTES,
) -> DataFrame:
    """Multiply term frequencies by their IDF; a weight of 0 stays stored.

    IDF values of bounded size are looked up inside the row. Wider ones are joined.
    """
    vector = F.col(features)
    unseen = math.log(idf.documents + 1)
    if idf.num_features * 8 <= shipped_bytes:
        dense = _dense(idf.table, "idf", idf.num_features, unseen)
        bounded_batches(df.sparkSession)
        df = df.withColumn("_idf", values_at(dense, vector["indices"], inline_values))
    else:
        table = idf.table.select("idx", "idf")
        df = match_elements(df, vector["indices"], table, "idx", "_found", how="left")
        found = F.transform("_found", lambda f: F.coalesce(f["idf"], F.lit(unseen)))
        df = df.withColumn("_idf", F.coalesce(found, F.array().cast("array<double>")))
    weights = F.zip_with(F.col("_idf"), vector["values"], lambda f, tf: tf * f)
    weighted = V.sparse(vector["size"], vector["indices"], weights)
    weighted = F.when(vector.isNotNull(), weighted)
    return df.withColumn(features, weighted).drop("_idf", "_found")


def l2_normalize(df: DataFrame, features: str = "features") -> DataFrame:
    """Scale every vector to length 1; the zero vector stays zero."""

    def scale(v):
        return let(
            V.l2_norm(v["values"]),
            lambda norm: V.sparse(
                v["size"],
                v["indices"],
                F.transform(
                    v["values"], lambda x: F.when(norm > 0, x / norm).otherwise(F.lit(0.0))
                ),
            ),
        )

    vector = F.col(features)
    return df.withColumn(features, F.when(vector.isNotNull(), let(vector, scale)))


def tfidf_l2(
    df: DataFrame,
    num_features: int,
    words: str = "words",
    features: str = "features",
    hash: str = "string",
) -> DataFrame:
    """Words -> L2-normalized TF-IDF vectors. The TF vectors are computed once and kept."""
    tf = cut_lineage(hashing_tf(df, num_features, words, features, hash).drop(words))
    return l2_normalize(apply_idf(tf, fit_idf(tf, num_features, features), features), features)


def to_long(df: DataFrame, key: str, features: str = "features", value: str = "value") -> DataFrame:
    """One row ``key, idx, value`` per stored entry."""
    return df.select(key, V.inline_entries(F.col(features))).toDF(key, "idx", value)


def important_terms(
    df: DataFrame,
    fraction: float = 0.005,
    features: str = "features",
    take_rows: int = TAKE_ORDERED_ROWS,
) -> DataFrame:
    """``idx, max_weight`` of the top fraction of indices by their greatest weight."""
    best = cut_lineage(
        df.select(V.inline_entries(F.col(features)))
        .toDF("idx", "value")
        .groupBy("idx")
        .agg(F.max("value").alias("max_weight"))
    )
    k = int(best.count() * fraction)
    return top_rows(best, [("max_weight", "desc"), ("idx", "asc")], k, take_rows)


def keep_terms(
    df: DataFrame,
    terms: DataFrame,
    features: str = "features",
    remap: bool = False,
    drop_empty: bool = True,
    inline_values: int = INLINE_VALUES,
    shipped_bytes: int = SHIPPED_BYTES,
) -> DataFrame:
    """Keep only the listed indices, then (``drop_empty``) drop vectors left empty.

    The width stays as it was; ``remap`` renumbers the kept indices 0..k-1 and
    shrinks the width to k. A long list is joined.
    """
    terms = cut_lineage(terms.select("idx"))
    size, last = terms.agg(F.count("idx"), F.max("idx")).head()
    vector = F.col(features)
    if (last or 0) * 4 < shipped_bytes:
        places = np.full((last or 0) + 1, -1, dtype=np.int32)
        chosen = np.sort(terms.toArrow().column("idx").to_numpy())
        places[chosen] = np.arange(size) if remap else chosen
        # an index past the table's end is not among the terms
        known = F.transform(vector["indices"], lambda i: F.least(i, F.lit(len(places))))
        bounded_batches(df.sparkSession)
        df = df.withColumn("_place", values_at(np.append(places, -1), known, inline_values))
    else:
        if remap:
            table = with_row_index(terms, [("idx", "asc")], "place")
        else:
            table = terms.withColumn("place", F.col("idx"))
        df = match_elements(df, vector["indices"], table, "idx", "_found", how="left")
        found = F.transform("_found", lambda f: F.coalesce(f["place"], F.lit(-1)).cast("int"))
        df = df.withColumn("_place", F.coalesce(found, F.array().cast("array<int>")))
    placed = F.zip_with(
        F.col("_place"),
        vector["values"],
        lambda place, x: F.struct(place.alias("idx"), x.alias("value")),
    )
    width = F.lit(size) if remap else vector["size"]
    pruned = let(
        F.filter(placed, lambda e: e["idx"] >= 0), lambda e: V.sparse(width, e["idx"], e["value"])
    )
    helpers = ("_place", "_found")
    if not drop_empty:
        return df.withColumn(features, pruned).drop(*helpers)
    bound = with_bound_column(df, features, pruned).drop(*helpers)
    return bound.filter(F.size(vector["indices"]) >= 1)
