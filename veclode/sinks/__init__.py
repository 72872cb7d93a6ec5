"""Writers. Parquet is the default; the text forms are there to be read elsewhere.

Nothing is overwritten: a path that exists already is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import format_labeled, format_sparse, to_ml_vector
from ..operators.ranking import Order, with_row_index


@dataclass(frozen=True)
class Written:
    """What a writer has put into a folder: rows, and the sum of the lines' 64-bit hashes."""

    rows: int
    checksum: int


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    return df if partitions is None else df.repartition(partitions)


def _measures(line: Column) -> list[Column]:
    total = F.coalesce(F.sum(F.xxhash64(line).cast("decimal(38,0)")), F.lit(0))
    return [F.count(F.lit(1)).alias("rows"), total.alias("checksum")]


def write_lines(
    df: DataFrame, line: Column, path: str, partitions: int | None = None, compression: str = "none"
) -> Written:
    """Lines as text; they are counted and summed up while they are written.

    ``compression`` is a codec of Spark's text writer; the readers know it by the files' names. A
    file of ``gzip`` is read by one task, as it was written by one.
    """
    written = Observation()
    lines = _spread(df.select(line.alias("value")), partitions)
    lines.observe(written, *_measures(F.col("value"))).write.text(path, compression=compression)
    return Written(written.get["rows"], int(written.get["checksum"]))


def read_back(spark: SparkSession, path: str) -> Written:
    """Count and checksum of the lines that lie in a folder."""
    found = spark.read.text(path).agg(*_measures(F.col("value"))).head()
    return Written(found["rows"], int(found["checksum"]))


def check_written(spark: SparkSession, path: str, written: Written) -> None:
    """Raise ``ValueError`` unless the folder holds just the lines that were written."""
    found = read_back(spark, path)
    if found != written:
        raise ValueError(f"{path} holds {found}, not {written}")


def write_labeled_points(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partitions: int | None = None,
    label: str = "label",
    features: str = "features",
    compression: str = "none",
) -> int:
    """``fmt``: ``parquet``, ``text`` (labelled-point lines) or ``libsvm``.

    ``compression`` is for ``text``. Returns the number of rows, counted while they are written.
    """
    if fmt == "text":
        line = format_labeled(F.col(label), F.col(features))
        return write_lines(df, line, path, partitions, compression).rows
    written = Observation()
    df = df.observe(written, F.count(F.lit(1)).alias("rows"))
    if fmt == "libsvm":
        points = df.select(
            F.col(label).cast("double").alias("label"),
            to_ml_vector(F.col(features)).alias("features"),
        )
        _spread(points, partitions).write.format("libsvm").save(path)
    elif fmt == "parquet":
        _spread(df, partitions).write.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return written.get["rows"]


def write_indexed_vectors(
    df: DataFrame, path: str, order: Order, fmt: str = "parquet", features: str = "features"
) -> Written | None:
    """Vectors with a dense row number in the given order: ``((size,[i],[v]),number)`` as text.

    Text writers say what they wrote (see :func:`check_written`)."""
    numbered = with_row_index(df, order)
    if fmt == "text":
        line = format_sparse(F.col(features), F.col("row_index"), key_last=True)
        return write_lines(numbered, line, path)
    numbered.write.parquet(path)
    return None


def write_split(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    key: str = "key",
    features: str = "features",
) -> dict[str, Written]:
    """Training and test rows apart.

    Parquet: one table partitioned by ``split``. Text: the folders ``path_training`` and
    ``path_test`` with lines ``(key,size,[i],[v])``; what each of the two got is returned.
    """
    if fmt == "parquet":
        df.write.partitionBy("split").parquet(path)
        return {}
    line = format_sparse(F.col(features), F.col(key))
    return {
        split: write_lines(df.filter(F.col("split") == split), line, f"{path}_{split}")
        for split in ("training", "test")
    }


def write_lsh(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partitions: int | None = None,
    key: str = "id",
    features: str = "features",
    buckets: str = "buckets",
) -> Written | None:
    """Vectors with their buckets; as text ``((key,size,[i],[v]),b0,b1,...)``."""
    if fmt == "parquet":
        _spread(df, partitions).write.parquet(path)
        return None
    return write_lines(df, lsh_line(F.col(features), F.col(key), F.col(buckets)), path, partitions)


def lsh_line(vector: Column, key: Column, buckets: Column) -> Column:
    """``((key,size,[i],[v]),b0,b1,...)``"""
    listed = F.array_join(buckets.cast("array<string>"), ",")
    return F.concat(F.lit("("), format_sparse(vector, key), F.lit(","), listed, F.lit(")"))


def write_histogram(df: DataFrame, path: str, fmt: str = "parquet") -> Written | None:
    """Bucket counts sorted by table and bucket; as text ``table<TAB>bucket<TAB>n``."""
    ordered = df.orderBy("table_id", "bucket")
    if fmt == "text":
        return write_lines(ordered, F.concat_ws("\t", "table_id", "bucket", "n"), path)
    ordered.write.parquet(path)
    return None
