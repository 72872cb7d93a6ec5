"""Joining rows, or elements of array columns, with a table of unknown size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import let
from ..session import cut_lineage, table_bytes

# A table measured at up to this many bytes is broadcast.
BROADCAST_BYTES = 64 << 20
# Beyond that each key is spread over this many shuffle partitions.
SALTS = 32


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: str,
    spread_by: str,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join with a lookup table holding one row per ``on`` value.

    A small table is broadcast. A larger one is copied once per salt, and each row picks
    its salt from ``spread_by``: a value held by a third of all rows then meets its match
    in many tasks instead of one.
    """
    if broadcast_bytes and table_bytes(table) <= broadcast_bytes:
        return rows.join(F.broadcast(table), on, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies.hint("merge"), [on, "_salt"], how).drop("_salt")


def match_elements(
    df: DataFrame,
    elements: Column,
    table: DataFrame,
    on: str,
    out: str,
    how: str = "inner",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Look every array element up in ``table`` and put the finds back into the row.

    Adds ``out``: ``array<struct<pos, on, other table columns>>`` in element order. With
    an inner join, elements without a match are left out, and so are rows without any.
    Rows are told apart by a number of their own, fixed by a written table; columns of
    ``df`` may hold nulls and repeats.

    Equal elements of a row are folded into one, with their positions, before anything is
    shuffled. What is regrouped is one row's own array, never more.
    """
    df = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    exploded = df.select("_row", F.inline(_positions(elements))).toDF("_row", on, "_pos")
    found = lookup_join(exploded, table, on, "_row", how, broadcast_bytes)
    others = [c for c in table.columns if c != on]
    folded = F.collect_list(F.struct(on, "_pos", *others))
    unfolded = F.transform(
        folded,
        lambda e: F.transform(
            e["_pos"], lambda p: F.struct(p.alias("pos"), *(e[c].alias(c) for c in (on, *others)))
        ),
    )
    regrouped = found.groupBy("_row").agg(F.sort_array(F.flatten(unfolded)).alias(out))
    return df.join(regrouped, "_row", "inner" if how == "inner" else "left").drop("_row")


def _positions(elements: Column) -> Column:
    """``array<struct<element, array of its positions>>``; null elements are left out."""
    numbered = F.transform(elements, lambda e, i: F.struct(e.alias("e"), i.alias("pos")))
    placed = F.sort_array(F.filter(numbered, lambda s: s["e"].isNotNull()))

    def fold(s: Column) -> Column:
        starts = F.filter(
            F.transform(s, lambda _, i: i),
            lambda i: (i == 0) | (F.get(s, i)["e"] != F.get(s, i - 1)["e"]),
        )
        return let(
            starts,
            lambda st: F.transform(
                st,
                lambda i, j: F.struct(
                    F.get(s, i)["e"],
                    F.slice(s, i + 1, F.coalesce(F.get(st, j + 1), F.size(s)) - i)["pos"],
                ),
            ),
        )

    return let(placed, fold)
