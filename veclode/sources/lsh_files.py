"""Hash functions kept in a file."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..functions.text import lines
from ..functions.vectors import parse_sparse, sparse_to_dense
from ..operators.lsh import Family, LshParams


def hash_function_fields(line: Column) -> Column:
    """``vector`` or ``vector;b;w`` -> ``struct<a array<double>, b double, w double>``.

    A malformed vector has a null ``a``, an offset or width that is missing or malformed
    is null.
    """
    return let(
        F.split(line, ";"),
        lambda p: F.struct(
            sparse_to_dense(parse_sparse(F.get(p, F.lit(0)))["vector"]).alias("a"),
            F.get(p, F.lit(1)).try_cast("double").alias("b"),
            F.get(p, F.lit(2)).try_cast("double").alias("w"),
        ),
    )


def read_lsh_params(
    spark: SparkSession, path: str, family: str | Family, chain: int
) -> LshParams:
    """One function per line, ``chain`` consecutive lines per table.

    Angle lines hold a vector; p-stable lines hold ``vector;b;w``; a family of one's own
    says which. Several files are read in order of their names. The files are the
    parameter set itself, no larger than what every executor is sent.
    """
    if not isinstance(family, Family) and family not in ("angle", "pstable"):
        raise ValueError(f"unknown family {family!r}")
    offsets = family.offsets if isinstance(family, Family) else family == "pstable"
    parsed = (
        spark.read.text(path, wholetext=True)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.posexplode(lines(F.col("value"))).alias("pos", "line"),
        )
        .filter("trim(line) != ''")
        .select("file", "pos", hash_function_fields(F.col("line")).alias("f"))
        .select("file", "pos", "f.*")
    )
    rows = parsed.orderBy("file", "pos").collect()
    if not rows or len(rows) % chain:
        raise ValueError(f"{len(rows)} functions do not make up tables of {chain}")
    if any(r["a"] is None or len(r["a"]) != len(rows[0]["a"] or ()) for r in rows):
        raise ValueError("malformed function, or functions of different sizes")
    if offsets and any(r["b"] is None or r["w"] is None for r in rows):
        raise ValueError("a function of this family needs vector;b;w")
    shape = (len(rows) // chain, chain)
    return LshParams(
        family,
        np.array([r["a"] for r in rows]).reshape(*shape, -1),
        np.array([r["b"] or 0.0 for r in rows]).reshape(shape),
        np.array([r["w"] or 1.0 for r in rows]).reshape(shape),
    )
