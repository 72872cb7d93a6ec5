"""Arrow batches cut into pieces of bounded size.

A batch holds up to 10,000 rows, however long their arrays are. Functions that work on its
elements take it piece by piece and give each piece's rows out before they take the next, so
what they hold besides the batch does not grow with its rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Executors get these functions with the job; they need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Array elements handled at once inside a task; a row with more is a piece of its own.
ELEMENTS = 1 << 17


def row_pieces(lengths: pa.Array, limit: int = ELEMENTS) -> Iterator[slice]:
    """Row ranges of about ``limit`` elements, one row at least, for rows of these lengths."""
    ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = before = 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield slice(start, stop)
        start, before = stop, ends[stop - 1]


def list_pieces(batches: Iterator[pa.ListArray], limit: int = ELEMENTS) -> Iterator[pa.ListArray]:
    """The rows of batches of lists, in pieces; an empty batch gives none."""
    for batch in batches:
        for rows in row_pieces(batch.value_lengths(), limit):
            yield batch[rows]
