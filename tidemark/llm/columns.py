"""Column helpers of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated a single time, however often it is used."""
    return F.transform(F.array(value), body)[0]
