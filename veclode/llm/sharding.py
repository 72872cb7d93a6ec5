"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into cells. A row's cell comes from the hash of its key and text; a shard
owns the cells up to each of its virtual nodes. Shards take rows up to their bound, and rows
that find a shard full go on clockwise to the next one. Rows of a cell have the same way
round the ring, so the walk needs only the number of rows in each cell, of which there is a
fixed number; it yields runs of rows (cell, first, last, shard, first slot), and every row
finds its run by its number in its cell.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veclode.llm.common import column, stored, with_rank

CELLS = 1 << 16


def _place(name: str, cells: int) -> int:
    return int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest()) % cells


def ring(shards: int, nodes: int, cells: int = CELLS) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node, clockwise. More shards only add nodes."""
    return sorted((_place(f"{s}/{v}", cells), s) for s in range(shards) for v in range(nodes))


def bounds(total: int, shards: int) -> list[int]:
    """The rows each shard may take: as even as whole numbers can be."""
    return [total // shards + (s < total % shards) for s in range(shards)]


def walk(counts: dict[int, int], shards: int, nodes: int, cells: int = CELLS):
    """Runs (cell, first, last, shard, slot) that place every row within the bounds.

    Cells are served in hashed order, so that no part of the ring is always last.
    """
    around = ring(shards, nodes, cells)
    at = [c for c, _ in around]
    free, used = bounds(sum(counts.values()), shards), [0] * shards
    runs = []
    for cell in sorted(counts, key=lambda c: (_place(f"turn {c}", 1 << 63), c)):
        first, left = 0, counts[cell]
        start = bisect.bisect_left(at, cell)
        for step in range(len(around)):
            if not left:
                break
            shard = around[(start + step) % len(around)][1]
            take = min(left, free[shard] - used[shard])
            if take:
                runs.append((cell, first, first + take - 1, shard, used[shard]))
                used[shard] += take
                first += take
                left -= take
    return runs


def shard(
    docs: DataFrame,
    shards: int = 24,
    nodes: int = 64,
    key: str = "doc_id",
    text: str = "text",
    cells: int = CELLS,
) -> DataFrame:
    """Every row with ``size``, ``text_crc32``, ``cell``, ``shard`` and ``slot``.

    Numbers of rows differ by one at most between shards; ``slot`` counts from 0 without
    gaps. A null text is an empty one; a null key is a key of its own; repeated rows are
    placed one by one. An empty table gives an empty table. Equal texts may lie in different
    shards: with counts at most one apart, a text that fills more than a shard's share cannot
    lie in one.
    """
    text_ = F.coalesce(column(docs, text).cast("string"), F.lit(""))
    own = docs.select(
        column(docs, key).alias(key),
        (F.octet_length(text_).cast("bigint") + 8).alias("size"),
        F.crc32(text_).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row_"),
    )
    placed = stored(
        own.withColumn(
            "cell", F.pmod(F.xxhash64(F.col(f"`{key}`"), "text_crc32"), F.lit(cells)).cast("int")
        )
    )
    counts = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().toLocalIterator()}
    runs = placed.sparkSession.createDataFrame(
        walk(counts, shards, nodes, cells),
        "run_cell int, first bigint, last bigint, shard int, slot bigint",
    )
    ranked = with_rank(placed, "cell", "row_", "rank_")
    # no more runs than cells and nodes together
    return ranked.join(
        F.broadcast(runs),
        (F.col("cell") == F.col("run_cell")) & F.col("rank_").between(F.col("first"), F.col("last")),
    ).select(
        F.col(f"`{key}`"),
        "size",
        "text_crc32",
        "cell",
        "shard",
        (F.col("slot") + F.col("rank_") - F.col("first")).alias("slot"),
    )
