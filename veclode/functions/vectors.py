"""Dense and sparse vectors as ordinary columns.

Dense: ``array<double>``. Sparse: ``struct<size int, indices array<int>, values
array<double>>`` with strictly increasing indices. The row's key and label stay in
their own columns next to it.
"""

from __future__ import annotations

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .arrays import let

_NO_INDICES = "array<int>"
_NO_VALUES = "array<double>"


def sparse(size: Column, indices: Column, values: Column) -> Column:
    return F.struct(
        size.cast("int").alias("size"),
        indices.cast("array<int>").alias("indices"),
        values.cast("array<double>").alias("values"),
    )


def sparse_from_pairs(size: Column, pairs: Column) -> Column:
    """From ``array<struct<idx, value>>`` in any order.

    Raises on a repeated index or one outside ``0..size-1``.
    """

    def build(p: Column) -> Column:
        indices = F.transform(p, lambda e: e["idx"])
        ok = (
            (F.size(F.array_distinct(indices)) == F.size(indices))
            & (F.coalesce(F.array_max(indices), F.lit(-1)) < size)
            & (F.coalesce(F.array_min(indices), F.lit(0)) >= 0)
        )
        return F.when(ok, sparse(size, indices, F.transform(p, lambda e: e["value"]))).otherwise(
            F.raise_error(
                F.concat(F.lit("repeated or out-of-range index: "), indices.cast("string"))
            )
        )

    return let(F.sort_array(pairs), build)


def zeros(size: int) -> Column:
    """The dense zero vector."""
    return F.array_repeat(F.lit(0.0), size)


def dense_to_sparse(dense: Column) -> Column:
    """Leave out exact zeros; NaN stays."""

    def build(x: Column) -> Column:
        entries = F.filter(
            F.transform(x, lambda v, i: F.struct(i.alias("idx"), v.alias("value"))),
            lambda e: e["value"] != 0,
        )
        return let(entries, lambda e: sparse(F.size(x), e["idx"], e["value"]))

    return let(dense.cast("array<double>"), build)


def sparse_to_dense(vector: Column) -> Column:
    """The full ``array<double>``. Linear: gaps between neighbouring indices become runs of 0."""

    def build(v: Column) -> Column:
        def gap(i: Column) -> Column:
            before = F.coalesce(F.get(v["indices"], i - 1), F.lit(-1))
            here = F.coalesce(F.get(v["indices"], i), v["size"])
            return F.concat(
                F.array_repeat(F.lit(0.0), here - before - 1),
                F.when(i < F.size(v["indices"]), F.array(F.get(v["values"], i))).otherwise(
                    F.array().cast(_NO_VALUES)
                ),
            )

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(v["indices"])), gap))

    return let(vector, build)


def entries(vector: Column) -> Column:
    """``array<struct<idx int, value double>>`` of a sparse vector."""
    return F.transform(
        F.arrays_zip(vector["indices"], vector["values"]),
        lambda e: F.struct(e["indices"].alias("idx"), e["values"].alias("value")),
    )


def inline_entries(vector: Column) -> Column:
    """One row per stored entry: its index, then its value."""
    return F.inline(F.arrays_zip(vector["indices"], vector["values"]))


def sparse_dot(a: Column, b: Column) -> Column:
    """Dot product of two sparse vectors; raises when their sizes differ.

    Both entry lists are merged by index, so an index held by both stands next to
    itself: n log n in the non-zeros, whatever the width.
    """

    def add_matches(m: Column) -> Column:
        steps = F.when(F.size(m) > 1, F.sequence(F.lit(1), F.size(m) - 1)).otherwise(
            F.array().cast(_NO_INDICES)
        )
        return F.aggregate(
            steps,
            F.lit(0.0),
            lambda total, i: total
            + F.when(
                F.get(m, i)["idx"] == F.get(m, i - 1)["idx"],
                F.get(m, i)["value"] * F.get(m, i - 1)["value"],
            ).otherwise(F.lit(0.0)),
        )

    merged = F.sort_array(F.concat(entries(a), entries(b)))
    return F.when(a["size"] == b["size"], let(merged, add_matches)).otherwise(
        F.raise_error(F.lit("vectors differ in size")).cast("double")
    )


def dense_dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, p: total + p
    )


def vectors_equal(a: Column, b: Column) -> Column:
    """Equality by dense content: stored zeros and order do not matter, keys take no part."""

    def stored(v: Column) -> Column:
        return F.sort_array(F.filter(entries(v), lambda e: e["value"] != 0))

    return (a["size"] == b["size"]) & (stored(a) == stored(b))


def vector_hash(vector: Column) -> Column:
    """Equal vectors (see :func:`vectors_equal`) hash alike."""
    stored = F.sort_array(F.filter(entries(vector), lambda e: e["value"] != 0))
    return F.xxhash64(vector["size"], stored)


def l2_norm(values: Column) -> Column:
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda total, x: total + x * x))


def keep_dims(dense: Column, dims: list[int]) -> Column:
    """The chosen dimensions in their original order, packed to 0..k-1."""
    return F.array(*[F.get(dense, F.lit(d)) for d in sorted(set(dims))])


# --- the ML library's vector type -------------------------------------------------


def to_ml_vector(vector: Column) -> Column:
    """Sparse struct -> ML vector. No built-in does this; the JSON reader builds the type."""
    fields = F.struct(
        F.lit(0).cast("byte").alias("type"), vector["size"], vector["indices"], vector["values"]
    )
    schema = StructType([StructField("v", VectorUDT())])
    return F.from_json(F.to_json(F.struct(fields.alias("v"))), schema)["v"]


def from_ml_vector(vector: Column) -> Column:
    """ML vector (dense or sparse) -> sparse struct."""
    return let(
        F.unwrap_udt(vector),
        lambda v: F.when(
            v["type"] == 0,
            F.struct(
                v["size"].alias("size"), v["indices"].alias("indices"), v["values"].alias("values")
            ),
        ).otherwise(dense_to_sparse(v["values"])),
    )


# --- text forms -------------------------------------------------------------------


def bracketed(numbers: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(numbers.cast("array<string>"), ","), F.lit("]"))


def format_dense(dense: Column) -> Column:
    """``[v,...]``"""
    return bracketed(dense)


def format_sparse(vector: Column, key: Column | None = None, key_last: bool = False) -> Column:
    """``(size,[i],[v])``, ``(key,size,[i],[v])`` or ``((size,[i],[v]),key)``."""
    body = F.concat_ws(
        ",", vector["size"].cast("string"), bracketed(vector["indices"]), bracketed(vector["values"])
    )
    if key is None:
        return F.concat(F.lit("("), body, F.lit(")"))
    key = key.cast("string")
    if key_last:
        return F.concat(F.lit("(("), body, F.lit("),"), key, F.lit(")"))
    return F.concat(F.lit("("), key, F.lit(","), body, F.lit(")"))


def format_labeled(label: Column, vector: Column) -> Column:
    """``(label,(size,[i],[v]))``"""
    return F.concat(
        F.lit("("), label.cast("double").cast("string"), F.lit(","), format_sparse(vector), F.lit(")")
    )


def _numbers(text: Column, kind: str) -> Column:
    """Comma-separated numbers; null as a whole if any of them is malformed."""
    parsed = F.when(F.trim(text) == "", F.array().cast(f"array<{kind}>")).otherwise(
        F.split(text, ",").try_cast(f"array<{kind}>")
    )
    return let(parsed, lambda p: F.when(~F.exists(p, lambda x: x.isNull()), p))


def _sound(v: Column) -> Column:
    """As many indices as values, none twice, all inside the size."""
    n = F.size(v["indices"])
    inside = (F.array_min(v["indices"]) >= 0) & (F.array_max(v["indices"]) < v["size"])
    return (
        v["size"].isNotNull()
        & (n == F.size(v["values"]))
        & ((n == 0) | (inside & (F.size(F.array_distinct(v["indices"])) == n)))
    )


def _ordered(v: Column) -> Column:
    """The same vector with its entries in order of their indices; most lines have them so."""
    ordered = let(F.sort_array(entries(v)), lambda e: sparse(v["size"], e["idx"], e["value"]))
    return F.when(v["indices"] == F.sort_array(v["indices"]), v).otherwise(ordered)


def parse_sparse(text: Column) -> Column:
    """Any of the three sparse forms -> ``struct<key bigint, vector>``; null if malformed.

    The brackets cut a line into head, indices, comma, values, tail. The key is the
    first of two numbers in the head or the number in the tail.
    """

    def build(p: Column) -> Column:
        head = F.split(F.regexp_replace(F.get(p, F.lit(0)), "[(]|,$", ""), ",").try_cast(
            "array<bigint>"
        )
        tail = F.regexp_extract(F.get(p, F.lit(4)), r"^\),(-?\d+)\)$", 1).try_cast("bigint")
        whole = (F.size(p) == 5) & (F.get(p, F.lit(2)) == ",")

        def check(r: Column) -> Column:
            v = r["vector"]
            ok = _sound(v) & (F.size(r["head"]) <= 2)
            return F.when(ok, F.struct(r["key"].alias("key"), _ordered(v).alias("vector")))

        parts = let(
            head,
            lambda h: F.struct(
                h.alias("head"),
                F.when(F.size(h) == 2, F.get(h, F.lit(0))).otherwise(tail).alias("key"),
                sparse(
                    F.get(h, F.size(h) - 1),
                    _numbers(F.get(p, F.lit(1)), "int"),
                    _numbers(F.get(p, F.lit(3)), "double"),
                ).alias("vector"),
            ),
        )
        return F.when(whole, let(parts, check))

    return let(F.split(text, r"[\[\]]"), build)


def parse_labeled(text: Column) -> Column:
    """Labelled-point text -> ``struct<label double, features>``; null if malformed.

    Reads ``(label,(size,[i],[v]))``, the dense ``(label,[v])`` and ``label,v v v``.
    """

    def build(p: Column) -> Column:
        head = F.split(F.regexp_replace(F.get(p, F.lit(0)), "[(]|,$", ""), ",")
        stored = sparse(
            F.get(head, F.lit(1)).try_cast("int"),
            _numbers(F.get(p, F.lit(1)), "int"),
            _numbers(F.get(p, F.lit(3)), "double"),
        )
        bare = F.split(text, ",")
        features = (
            F.when(F.size(p) == 5, stored)
            .when(F.size(p) == 3, dense_to_sparse(_numbers(F.get(p, F.lit(1)), "double")))
            .when(
                F.size(p) == 1,
                dense_to_sparse(_numbers(F.translate(F.get(bare, F.lit(1)), " ", ","), "double")),
            )
        )
        return F.struct(
            F.get(head, F.lit(0)).try_cast("double").alias("label"), features.alias("features")
        )

    def check(r: Column) -> Column:
        f = r["features"]
        ok = r["label"].isNotNull() & _sound(f)
        return F.when(ok, F.struct(r["label"].alias("label"), _ordered(f).alias("features")))

    return let(let(F.split(text, r"[\[\]]"), build), check)
