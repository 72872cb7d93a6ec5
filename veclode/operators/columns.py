"""Columns that are costly to compute."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_bound_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``withColumn`` for a costly value that a later filter looks at.

    The optimizer moves a filter below an ordinary projection by repeating the
    projection's expression in it. It cannot move one below a generator, so the value
    is computed once per row.
    """
    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))


def explode_elements(df: DataFrame, keep: list[str], array: str, name: str) -> DataFrame:
    """``keep`` columns and one row per array element.

    A plain explode of a computed column makes the optimizer add a filter on its size,
    which computes the array a second time; the outer form does not.
    """
    rows = df.select(*keep, F.explode_outer(array).alias(name))
    return rows.filter(F.col(name).isNotNull())
