"""Folders of documents, one file each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import keep_lines, mail_body
from .file_tree import read_files


def read_documents(
    spark: SparkSession,
    path: str,
    predicate: Callable[[Column], Column] = mail_body,
    hidden: bool = True,
) -> DataFrame:
    """``doc_id`` (the file's path) and ``content`` of every file below ``path``.

    ``predicate`` picks the lines to keep. Paths that hold ``.DS_Store`` are left out.
    Folders are listed and files read in tasks, whatever their names (see
    :mod:`.file_tree`). ``hidden=False`` reads with Spark's own text reader instead, for file
    systems only the JVM knows; it passes over names that start with ``.`` or ``_``.
    """
    if hidden:
        files = read_files(spark, path).select("path", F.col("value").cast("string").alias("value"))
    else:
        found = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
        files = found.select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select(
        F.col("path").alias("doc_id"), keep_lines(F.col("value"), predicate).alias("content")
    )
