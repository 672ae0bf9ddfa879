"""What may be broadcast, and how large an input is before it is run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_DIMENSION_ROWS = 10_000
SMALL_INPUT_BYTES = 16 * 1024 * 1024
_MULTIPLYING = ("Generate ", "Expand ", "InPandas", "InArrow")


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate, without running a job; None if it is no upper bound.

    Scans are estimated from their files and joins from the product of both sides.
    A plan that multiplies rows on its own has no usable estimate: write it first.
    """
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
    except AttributeError:  # a remote session does not expose plan statistics
        return None
    text = plan.toString()
    if any(node in text for node in _MULTIPLYING):
        return None
    return int(str(plan.stats().sizeInBytes()))


def is_small(df: DataFrame, limit: int = SMALL_INPUT_BYTES) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit


def fits(df: DataFrame, limit: int) -> bool:
    """Whether all values of ``df`` together take at most ``limit`` bytes.

    A scan is estimated by its compressed files, so what passes the estimate is measured,
    in one pass over an input whose files are small.
    """
    if not df.columns or not is_small(df, limit):
        return False
    size = F.sum(F.octet_length(F.to_json(F.struct(*df.columns))).cast("long"))
    return (df.agg(size).first()[0] or 0) <= limit


def dimension(spark: SparkSession, columns: Mapping[str, Sequence]) -> DataFrame:
    """A driver-supplied lookup table, with a broadcast hint up to ``MAX_DIMENSION_ROWS``.

    A larger one gets no hint: its size is known to the optimizer, which decides.
    """
    table = pa.table({name: list(values) for name, values in columns.items()})
    lookup = spark.createDataFrame(table)
    return F.broadcast(lookup) if table.num_rows <= MAX_DIMENSION_ROWS else lookup
