"""Exact top-k and row numbering that do not funnel the rows through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..session import cut_lineage, literal_array

# Up to this k every task puts forward its k best rows; beyond it the rows are ranked in place.
TAKE_ORDERED_ROWS = 5000

# (column name, "asc" | "desc") pairs; together they must order the rows totally.
Order = list[tuple[str, str]]


def sort_columns(order: Order) -> list[Column]:
    return [F.col(c).desc() if way == "desc" else F.col(c).asc() for c, way in order]


def at_or_before(order: Order, row: Row) -> Column:
    """True for rows that do not come after ``row`` in the order."""
    condition = F.lit(True)
    for name, way in reversed(order):
        here, edge = F.col(name), F.lit(row[name])
        ahead = here > edge if way == "desc" else here < edge
        condition = ahead | ((here == edge) & condition)
    return condition


def with_row_index(df: DataFrame, order: Order, name: str = "row_index") -> DataFrame:
    """Add a dense 0-based row number in the given order.

    Range partitions are sorted side by side and written to the checkpoint folder, so
    the positions inside them are fixed; only one count per partition reaches the driver.
    """
    placed = cut_lineage(
        df.repartitionByRange(*sort_columns(order))
        .sortWithinPartitions(*sort_columns(order))
        .withColumn("_place", F.monotonically_increasing_id())
    )
    # the upper bits of the generated id are the partition, the lower 33 the place inside it
    part = F.shiftright("_place", 33)
    sizes = {
        r["part"]: r["n"]
        for r in placed.groupBy(part.cast("int").alias("part"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    starts, total = [], 0
    for p in range(max(sizes, default=-1) + 1):
        starts.append(total)
        total += sizes.get(p, 0)
    start = F.get(literal_array(starts, "bigint"), part.cast("int"))
    inside = F.col("_place").bitwiseAND((1 << 33) - 1)
    return placed.withColumn(name, start + inside).drop("_place")


def rows_at(
    df: DataFrame, order: Order, k: int, n: int = 1, take_rows: int = TAKE_ORDERED_ROWS
) -> list[Row]:
    """The order's columns of the k-th row (1-based) and those after it, n in all.

    They come back unordered, and fewer where the rows run out.
    """
    names = [name for name, _ in order]
    keys = df.select(*names)
    if k <= take_rows:
        found = keys.orderBy(*sort_columns(order)).offset(k - 1).limit(n)
    else:
        ranked = with_row_index(keys, order, "_rank")
        found = ranked.filter(F.col("_rank").between(k - 1, k + n - 2))
    # aggregated so that each task's candidates meet in a task, not on the driver
    return found.agg(F.collect_list(F.struct(*names)).alias("rows")).head()["rows"]


def kth_row(df: DataFrame, order: Order, k: int, take_rows: int = TAKE_ORDERED_ROWS) -> Row | None:
    """The k-th row (1-based) in the order; None when there are fewer."""
    return next(iter(rows_at(df, order, k, 1, take_rows)), None)


def top_rows(df: DataFrame, order: Order, k: int, take_rows: int = TAKE_ORDERED_ROWS) -> DataFrame:
    """The first k rows in the order, found by comparing each row with the k-th."""
    if k <= 0:
        return df.limit(0)
    edge = kth_row(df, order, k, take_rows)
    return df if edge is None else df.filter(at_or_before(order, edge))
