"""Reproducible splits of exact size."""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranking import TAKE_ORDERED_ROWS, at_or_before, rows_at


def exact_split(
    df: DataFrame, n: int, seed: int, key: str = "id", take_rows: int = TAKE_ORDERED_ROWS
) -> DataFrame:
    """Add ``split``: ``test`` for exactly n rows in seeded random order, else ``training``.

    The n-th smallest hash of the key is found first; comparing with it then splits the
    rows where they lie, without a join. ``key`` must be unique.
    """
    if n <= 0:
        return df.withColumn("split", F.lit("training"))
    drawn = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    order = [("_draw", "asc"), (key, "asc")]
    hashed = df.withColumn("_draw", drawn)
    total = hashed.count()
    if total < n:
        raise ValueError(f"fewer than {n} rows to draw from")
    # hashes are uniform, so a little more than n/total of them hold the n smallest
    share = (n + 10 * sqrt(n) + 100) / total
    low = hashed.filter(F.col("_draw") < f"{int(share * 16**12):012x}") if share < 1 else hashed
    edges = rows_at(low, order, n, 2, take_rows) or rows_at(hashed, order, n, 2, take_rows)
    if len(edges) == 2 and edges[0] == edges[1]:
        raise ValueError(f"{key} is not unique")
    is_test = at_or_before(order, min(edges))
    return hashed.withColumn("split", F.when(is_test, "test").otherwise("training")).drop("_draw")
