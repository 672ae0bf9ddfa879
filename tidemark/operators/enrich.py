"""Renames, derived columns, lineage and canonical column sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, MapType, StructType, TimestampType

from tidemark import schemas
from tidemark.functions.numeric import measure
from tidemark.functions.text import parse_timestamp

# Landing field names and the names used afterwards.
POST_NAMES = {"userId": "user_id", "id": "post_id"}
USER_NAMES = {"id": "user_id"}


def with_text_lengths(df: DataFrame, columns: Sequence[str] = ("title", "body")) -> DataFrame:
    """Add ``<column>_length``: Unicode code points, null for null text."""
    return df.withColumns({f"{name}_length": F.length(name) for name in columns})


def with_lineage(
    df: DataFrame, source_file: Column | str, source_system: str = schemas.SOURCE_SYSTEM
) -> DataFrame:
    if isinstance(source_file, str):
        source_file = F.lit(source_file)
    return df.withColumns(
        {"source_system": F.lit(source_system), "source_file": source_file}
    )


def with_batch_time(df: DataFrame, batch_time: Column) -> DataFrame:
    """One processing timestamp for the whole batch."""
    return df.withColumn("processed_at", batch_time)


def enrich_posts(raw: DataFrame, source_file: Column | str, batch_time: Column) -> DataFrame:
    """Landed posts to staged posts; fields this job does not know survive."""
    renamed = raw.withColumnsRenamed(POST_NAMES)
    return with_batch_time(
        with_lineage(with_text_lengths(renamed), source_file), batch_time
    )


def prune_users(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(USER_NAMES).select(*schemas.USERS.names)


def backfill_lineage(
    df: DataFrame,
    source_system: str = schemas.SOURCE_SYSTEM,
    source_file: str = schemas.LEGACY_SOURCE_FILE,
) -> DataFrame:
    """Add the lineage columns where absent and fill their nulls."""
    filled = {}
    for name, default in (("source_system", source_system), ("source_file", source_file)):
        filled[name] = (
            F.coalesce(F.col(name), F.lit(default)) if name in df.columns else F.lit(default)
        )
    return df.withColumns(filled)


def length_category(df: DataFrame, length: str = "body_length") -> DataFrame:
    """Add ``body_category``: Long above 200, Medium from 150, else Short (also for null)."""
    value = F.col(length)
    return df.withColumn(
        "body_category",
        F.when(value > 200, "Long").when(value >= 150, "Medium").otherwise("Short"),
    )


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns of ``schema``: absent ones null, values coerced or null."""
    columns = []
    for field in schema.fields:
        if field.name not in df.columns:
            value = F.lit(None).cast(field.dataType)
        elif isinstance(field.dataType, TimestampType):
            value = parse_timestamp(field.name)
        elif isinstance(field.dataType, LongType):
            # Text such as "3.0" is a number too, so whole numbers go through double
            # unless they already are integers (a double would lose digits).
            value = F.col(field.name)
            if df.schema[field.name].dataType.typeName() in ("string", "double", "float"):
                value = F.coalesce(value.try_cast("long"), measure(value).try_cast("long"))
            else:
                value = value.try_cast("long")
        elif isinstance(field.dataType, DoubleType):
            value = measure(field.name)
        elif isinstance(field.dataType, MapType):
            # Older layouts hold the map as JSON text; what does not parse is null.
            value = F.col(field.name)
            if df.schema[field.name].dataType.typeName() == "string":
                value = F.from_json(value, field.dataType)
        else:
            value = F.col(field.name).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)
