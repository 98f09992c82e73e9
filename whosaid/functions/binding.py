"""Compute a column expression once and use its value many times."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` computed once per row.

    Stacked selects do not give that: Catalyst merges them and copies the inner
    expression to each place that uses it, also into lambdas, where it would run
    once per array element. A lambda variable is never inlined.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
