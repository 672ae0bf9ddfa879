"""Text and timestamp expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numeric import as_column


def compact_timestamp(ts: Column | str) -> Column:
    """Timestamp as an id such as ``20260812_093000_000123``."""
    return F.date_format(as_column(ts), "yyyyMMdd_HHmmss_SSSSSS")


def iso_timestamp(ts: Column | str) -> Column:
    """ISO-8601 text with microseconds, without an offset."""
    return F.date_format(as_column(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def parse_timestamp(col: Column | str) -> Column:
    """Timestamp from text or timestamp; anything unparsable becomes null."""
    return as_column(col).try_cast("timestamp")


def lines(*parts: Column) -> Column:
    """Join parts with newlines; a part that is null is left out."""
    return F.concat_ws("\n", *parts)


def labelled(label: str, value: Column) -> Column:
    """``label: value``, or null when the value is null or empty text."""
    text = F.nullif(value.cast("string"), F.lit(""))
    return F.concat(F.lit(f"{label}: "), text)


def utc_instant(ts: Column | str) -> Column:
    """Zone-less timestamp read as UTC, whatever the session time zone is."""
    ts = as_column(ts)
    micros = (
        F.unix_date(F.to_date(ts)).cast("long") * 86_400_000_000
        + F.hour(ts).cast("long") * 3_600_000_000
        + F.minute(ts).cast("long") * 60_000_000
        + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")
    )
    return F.timestamp_micros(micros)


def utc_wall_clock(ts: Column | str) -> Column:
    """The inverse of :func:`utc_instant`."""
    seconds = (F.unix_micros(as_column(ts)).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds)
