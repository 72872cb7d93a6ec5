"""Small building blocks over array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body``.

    Naming an expression in Python only repeats it in the plan. Inside a lambda that
    repetition runs once per element, so anything used there is bound first.
    """
    return F.transform(F.array(value), body)[0]
