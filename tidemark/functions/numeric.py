"""Numeric expressions with results that do not depend on task order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, NumericType

# Sums of measured seconds run over decimals: decimal addition is associative,
# so a retried task or another partitioning cannot change the last digit.  What a
# decimal cannot hold (beyond its range, or below its last place) is summed apart.
EXACT = DecimalType(28, 9)
EXACT_RANGE = 1e18
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def measure(col: Column | str) -> Column:
    """A measured value as double; unparsable text and NaN become null.

    Text has to be a decimal number or an infinity: type suffixes and hexadecimal
    floats, which the cast would take, are no numbers.  (The type test is folded away.)
    """
    column = as_column(col)
    value = column.try_cast("double")
    number = (F.typeof(column) != "string") | column.cast("string").rlike(NUMBER)
    return F.when(number & ~F.isnan(value), value)


def exceeds(df: DataFrame, name: str, limit: float) -> Column:
    """Whether a measured column is above ``limit``; null, NaN and text that is no number are not.

    A numeric column is compared as it is, so that the comparison reaches the scan.
    """
    dtype = df.schema[name].dataType
    if isinstance(dtype, (DoubleType, FloatType)):
        return (F.col(name) > limit) & ~F.isnan(name)
    if isinstance(dtype, NumericType):
        return F.col(name) > limit
    return measure(name) > limit


def round_even(col: Column, digits: int) -> Column:
    """Half-even rounding on ``x * 10^digits`` (Spark's own ``round`` is half-up)."""
    scale = float(10**digits)
    return F.rint(col * F.lit(scale)) / F.lit(scale)


def exact_sum(col: Column | str) -> Column:
    """Order-independent sum, returned as double; infinite, huge and tiny values count too."""
    value = as_column(col).cast("double")
    held = F.when(F.abs(value) < EXACT_RANGE, value.cast(EXACT))
    rest = value - F.coalesce(held.cast("double"), F.lit(0.0))
    whole = F.coalesce(F.sum(held).cast("double"), F.lit(0.0))
    return F.when(F.count(value) > 0, whole + F.sum(rest))


def exact_avg(col: Column | str) -> Column:
    """Order-independent mean over non-null values; null when there are none."""
    value = as_column(col)
    return F.try_divide(exact_sum(value), F.count(value))


def percentage(part: Column, whole: Column, when_empty: float = 0.0) -> Column:
    """``part / whole`` as a percentage with two decimals; ``when_empty`` for no rows."""
    rate = F.rint(F.try_divide(part * F.lit(10000.0), whole)) / F.lit(100.0)
    return F.when(whole > 0, rate).otherwise(F.lit(when_empty))
