"""JSON landing zone: timestamp-named snapshots, the latest one, sanity checks.

A snapshot is named ``<entity>_<yyyymmdd_hhmmss>.json``.  It is either one file
holding a JSON array, or a folder of JSON lines as Spark writes it.  Either is read by
many tasks; an array is shuffled once for it (:mod:`tidemark.sources.json_array`).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.sources.json_array import array_records
from tidemark.sources.paths import children, delete, exists, is_folder, rename_file

CORRUPT = "_corrupt_record"


def snapshot_name(entity: str, at: datetime) -> str:
    return f"{entity}_{at:%Y%m%d_%H%M%S}.json"


def land(records: DataFrame, root: str, entity: str, at: datetime) -> str:
    """Write records as a new snapshot of JSON lines; an existing one is an error."""
    path = f"{root}/{snapshot_name(entity, at)}"
    records.write.mode("errorifexists").json(path)
    return path


def land_array(records: DataFrame, root: str, entity: str, at: datetime) -> str:
    """Write records as a new snapshot of one JSON array; an existing one is an error.

    One file has one writer, so this suits small batches; :func:`land` any.
    """
    texts = records.select(F.to_json(F.struct(*records.columns)).alias("value"))
    return write_array(texts, f"{root}/{snapshot_name(entity, at)}")


def write_array(texts: DataFrame, path: str) -> str:
    """Write the JSON texts in ``value`` as the elements of one array file."""
    spark, folder = texts.sparkSession, f"{path}.writing"
    if exists(spark, path):
        raise FileExistsError(path)
    rows = texts.coalesce(1).withColumn("place", F.monotonically_increasing_id())
    mark = F.when(F.col("place") == 0, F.lit(" ")).otherwise(F.lit(","))
    body = rows.select("place", F.concat(mark, "value").alias("value"))
    brackets = spark.createDataFrame([(-1, "["), (2**62, "]")], "place long, value string")
    whole = body.unionByName(brackets).coalesce(1).sortWithinPartitions("place")
    whole.select("value").write.text(folder)
    part = next(name for name in children(spark, folder) if name.startswith("part-"))
    rename_file(spark, f"{folder}/{part}", path)
    delete(spark, folder)
    return path


def snapshots(spark: SparkSession, root: str, entity: str) -> list[str]:
    """Complete snapshots, oldest first: a folder counts once its writer has finished."""
    names = children(spark, root)
    paths = [f"{root}/{n}" for n in names if n.startswith(f"{entity}_") and n.endswith(".json")]
    return [p for p in paths if not is_folder(spark, p) or exists(spark, f"{p}/_SUCCESS")]


def latest_snapshot(spark: SparkSession, root: str, entity: str) -> str:
    """The complete snapshot with the greatest name.  Contents are not read."""
    found = snapshots(spark, root, entity)
    if not found:
        raise FileNotFoundError(f"no {entity} snapshot in {root}")
    return found[-1]


def _texts(spark: SparkSession, path: str, layout: str) -> tuple[DataFrame, bool]:
    """The records of a snapshot as text, and whether it has the shape it should have."""
    if layout not in ("array", "lines"):
        raise ValueError(f"unknown landing layout {layout!r}")
    return array_records(spark, path) if layout == "array" else (spark.read.text(path), True)


def _parsed(texts: DataFrame, schema: StructType) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return texts.select(F.from_json("value", schema, options).alias("r")).select("r.*")


def read_landed(
    spark: SparkSession, path: str, schema: StructType, layout: str = "lines"
) -> DataFrame:
    """Landed records with exactly the columns of ``schema``."""
    if layout == "lines":
        return spark.read.schema(schema).json(path)
    return _parsed(_texts(spark, path, layout)[0], schema)


def landed_fields(spark: SparkSession, path: str, layout: str = "lines") -> list[str]:
    """Field names that occur in a snapshot; costs a pass over it.

    A reader schema drops other fields silently, so a job that must notice them
    asks here first.
    """
    if layout == "lines":
        return spark.read.json(path).columns
    keys = F.map_keys(F.from_json("value", "map<string,string>"))
    names = _texts(spark, path, layout)[0].select(F.explode(keys).alias("name")).distinct()
    return sorted(r.name for r in names.collect())


def read_all_fields(
    spark: SparkSession, path: str, schema: StructType, layout: str = "lines"
) -> DataFrame:
    """Landed records with typed known fields first and unknown ones kept as text."""
    known = set(schema.names)
    extra = [n for n in landed_fields(spark, path, layout) if n not in known and n != CORRUPT]
    wide = StructType(schema.fields + [StructField(n, StringType(), True) for n in extra])
    return read_landed(spark, path, wide, layout)


def landing_sanity(
    spark: SparkSession, path: str, schema: StructType, layout: str = "lines"
) -> DataFrame:
    """Check rows for a snapshot: parsable, an array where one is due, not empty.

    A record is parsable if it fits the schema and has at least one of its fields;
    all fields are looked at, since the parser skips what is not asked for.
    """
    wide = StructType(schema.fields + [StructField(CORRUPT, StringType(), True)])
    texts, shaped = _texts(spark, path, layout)
    parsed = _parsed(texts, wide)
    blank = F.coalesce(*[F.col(name).cast("string") for name in schema.names]).isNull()
    totals = parsed.agg(
        F.count("*").alias("records"),
        F.count_if(F.col(CORRUPT).isNotNull() | blank).alias("corrupt"),
    )
    checks = [
        (0, "parsable", F.col("corrupt"), "unparsable records"),
        (2, "not_empty", (F.col("records") == 0).cast("long"), "zero records landed"),
    ]
    if layout == "array":
        checks.append((1, "is_list", F.lit(int(not shaped)), "expected a list of records"))
    return totals.select(F.inline(F.array(*[_check(*c) for c in checks])))


def _check(position, name, violations, detail):
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(name).alias("check_name"),
        F.when(violations > 0, "FAILED").otherwise("PASSED").alias("status"),
        violations.cast("long").alias("violations"),
        F.when(violations > 0, detail).otherwise("").alias("detail"),
    )
