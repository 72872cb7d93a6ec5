"""Looking array elements up in a table small enough to be sent to every task.

Beyond a few thousand entries a table is too long for a constant in the plan, yet joining
it would shuffle every element. These Arrow functions look whole batches of elements up
in place instead. They are marked nondeterministic so the optimizer neither copies them
into filters nor runs them twice.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.batches import ELEMENTS, list_pieces
from ..session import literal_array

# Executors get these functions with the job; they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Up to this many numbers a table becomes a constant in the plan.
INLINE_VALUES = 20_000
# Up to this many bytes a table is sent to every task; beyond it has to be joined.
SHIPPED_BYTES = 64 << 20


def _lists(batch: pa.ListArray, offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    """New lists for a batch; its nulls stay null."""
    mask = batch.is_null() if batch.null_count else None
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values, mask=mask)


def _offsets(batch: pa.ListArray) -> np.ndarray:
    lengths = batch.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    return np.concatenate([[0], np.cumsum(lengths)])


def keep_members(words: Column, members: pa.Array) -> Column:
    """The elements of a string array that are members; order and repeats stay.

    Null elements are no members; a null array stays null.
    """

    @F.arrow_udf("array<string>")
    def keep(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        # members are hashed anew for every piece
        for batch in list_pieces(batches, max(ELEMENTS, 2 * len(members))):
            flat = batch.flatten()
            known = pc.is_in(flat, value_set=members.cast(flat.type))
            kept_before = np.concatenate([[0], np.cumsum(known.to_numpy(zero_copy_only=False))])
            yield _lists(batch, kept_before[_offsets(batch)], flat.filter(known))

    return keep.asNondeterministic()(words)


def values_at(table: np.ndarray, indices: Column, inline_values: int = INLINE_VALUES) -> Column:
    """``table[i]`` for every index, as an array column."""
    kind = "int" if np.issubdtype(table.dtype, np.integer) else "double"
    if len(table) <= inline_values:
        constant = literal_array(table.tolist(), kind)
        return F.transform(indices, lambda i: F.get(constant, i))

    @F.arrow_udf(f"array<{kind}>")
    def gather(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in list_pieces(batches):
            found = table[batch.flatten().to_numpy(zero_copy_only=False)]
            yield _lists(batch, _offsets(batch), pa.array(found))

    return gather.asNondeterministic()(indices)
