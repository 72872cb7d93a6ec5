import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from veclode.functions.vectors import dense_to_sparse
from veclode.operators import chisq


def expected(rows):
    """Pearson's statistic of every feature, from its whole contingency table."""
    rows = [(y, x) for y, x in rows if y is not None and x is not None]
    n, out = len(rows), {}
    for d in range(max((len(x) for _, x in rows), default=0)):
        cells = Counter((x[d], str(y)) for y, x in rows)
        by_value = Counter(x[d] for _, x in rows)
        by_label = Counter(str(y) for y, _ in rows)
        out[d] = sum(
            (cells[v, y] - r * c / n) ** 2 / (r * c / n)
            for v, r in by_value.items()
            for y, c in by_label.items()
        )
    return out


def odd_rows(n=400):
    rng = random.Random(2)
    rows = [(rng.choice([0.0, 1.0, 2.5, None, math.nan]), [rng.choice([0.0, 1.0, -2.0, 0.5]) for _ in range(6)]) for _ in range(n)]
    rows = [(y, [y if y in (0.0, 1.0) else 3.0, *x, 0.0, 1.0]) for y, x in rows]
    return rows + [(1.0, None)]


@pytest.mark.parametrize("shipped", [100, 1])
@pytest.mark.parametrize("spilled", [1 << 21, 3])
def test_chi_square(spark, monkeypatch, shipped, spilled):
    for name, value in (("RANGE", 4), ("SPILLED_CELLS", spilled), ("LOOSE_CELLS", spilled)):
        monkeypatch.setattr(chisq, name, value)
    rows = odd_rows()
    df = spark.createDataFrame(rows, "label double, features array<double>").repartition(5)
    df = df.withColumn("features", dense_to_sparse(F.col("features")))
    found = {r["idx"]: r["chi2"] for r in chisq.chi_square(df, shipped_labels=shipped).collect()}
    assert found == pytest.approx(expected(rows), abs=1e-8)


def test_no_rows(spark):
    df = spark.createDataFrame([], "label double, features struct<size:int,indices:array<int>,values:array<double>>")
    assert chisq.chi_square(df).collect() == []


def test_no_entry_is_shuffled(spark):
    """Half a million entries leave their tasks as a few packed tables."""
    df = spark.range(50_000, numPartitions=4).select(
        (F.col("id") % 2).cast("double").alias("label"),
        F.struct(
            F.lit(3_000_000).alias("size"),
            F.transform(F.sequence(F.lit(0), F.lit(9)), lambda i: (i * 300_000 + F.col("id") % 2).cast("int")).alias("indices"),
            F.array_repeat(F.lit(1.0), 10).alias("values"),
        ).alias("features"),
    )
    tables = chisq._packed_chi_square(df, "features", "label", [0.0, 1.0], [25_000, 25_000])
    plan = tables._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange") == 1
    found = {r["idx"]: r["chi2"] for r in tables.collect()}
    assert len(found) == 20 and all(x == pytest.approx(50_000) for x in found.values())


def test_cells_are_packed():
    rng = np.random.default_rng(3)
    cells, kept = chisq.Cells(), Counter()
    for _ in range(20):
        part = rng.integers(0, 4, (3, 50))
        cells.add(part[0], part[1].astype(float), part[2], np.ones(50, np.int64))
        kept.update(zip(*part.tolist()))
    packed = list(zip(*(c.tolist() for c in cells.taken())))
    assert packed == [(*k, n) for k, n in sorted(kept.items())] and cells.pack() == 0
