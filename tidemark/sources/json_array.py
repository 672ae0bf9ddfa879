"""One JSON array in one file, read by as many tasks as it has blocks.

The file is read as text that ends at closing braces, which Spark splits at any byte.
Whether a brace ends a record depends on what stands before it: inside a string it ends
nothing, inside a nested object it ends that.  For each piece the number of its quotes and
what it does to the depth are counted for both cases, outside and inside a string;
running sums give the same for every prefix of a block, and the blocks' totals - one row
for each - are composed in order.  Then every piece knows the state it begins in, and
pieces between two record ends are put together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CLOSE = "}"


@dataclass(frozen=True)
class _Start:
    """The state at the beginning of a block: in a string, depth, records ended before."""

    inside: int
    depth: int
    ended: int


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Text up to each closing brace, with its quotes and its depth change in both cases."""
    text = spark.read.option("lineSep", CLOSE).text(path).select(
        "value",
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        F.col("_metadata.file_size").alias("file_size"),
    )
    plain = F.regexp_replace("value", r"\\.", "")
    pieces = text.withColumn("plain", plain).withColumn("quotes", _count(F.col("plain"), '"'))
    begun = F.regexp_replace("plain", r'^[^"]*("|$)', "")
    for name, visible in (("out", F.col("plain")), ("in", begun)):
        visible = F.regexp_replace(visible, r'"[^"]*("|$)', "")
        opened = _count(visible, "{") + _count(visible, "[") - _count(visible, "]")
        pieces = pieces.withColumn(f"turn_{name}", opened)
    return pieces.drop("plain")


def _in_states(pieces: DataFrame) -> DataFrame:
    """For a block that begins outside (0) or inside (1) a string: each piece's end and depth."""
    here = Window.partitionBy("block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumn("upto", F.sum("quotes").over(here))
    before = F.col("upto") - F.col("quotes")
    for case in (0, 1):
        starts_inside = (before + case) % 2 == 1
        ends_inside = (F.col("upto") + case) % 2 == 1
        turn = F.when(starts_inside, F.col("turn_in")).otherwise(F.col("turn_out"))
        # The brace that ends the piece closes something only outside a string.
        pieces = pieces.withColumn(f"turn{case}", turn - F.when(ends_inside, 0).otherwise(1))
        pieces = pieces.withColumn(f"inside{case}", ends_inside)
    for case in (0, 1):
        pieces = pieces.withColumn(f"depth{case}", F.sum(f"turn{case}").over(here))
    return pieces.drop("turn_in", "turn_out", "upto", "turn0", "turn1", "quotes")


def array_records(spark: SparkSession, path: str) -> tuple[DataFrame, bool]:
    """``(value)`` of the records' texts, and whether the file begins like an array.

    A file with a single object instead has that as its record.  Text that is no object,
    or not closed, comes as it stands, so that parsing it fails.
    """
    states = _in_states(_pieces(spark, path))
    ends = {}
    for case in (0, 1):
        last = F.max_by(F.struct(f"inside{case}", f"depth{case}"), "place")
        ends[f"end{case}"] = last
    blocks = states.groupBy("block").agg(
        F.count("*").alias("n"),
        F.sum(F.octet_length("value")).alias("bytes"),
        F.max("file_size").alias("file_size"),
        F.min_by(F.left("value", F.lit(4096)), "place").alias("first"),
        *[value.alias(name) for name, value in ends.items()],
    )
    # One row for each block of the file.
    rows = blocks.orderBy("block").collect()
    if not rows:
        return spark.createDataFrame([], "value string"), False
    is_list = rows[0].first.lstrip("﻿ \t\r\n").startswith("[")
    base = 1 if is_list else 0
    inside, depth, starts = 0, 0, {}
    for r in rows:
        starts[r.block] = (inside, depth)
        end = r[f"end{inside}"]
        inside, depth = int(end[0]), depth + end[1]
    # Without a brace at its end the file has one byte less than its pieces and their braces.
    closed = sum(r.bytes + r.n for r in rows) == rows[0].file_size
    begun = spark.createDataFrame([(b, *s) for b, s in starts.items()], "block long, inside int, depth long")
    known = states.join(F.broadcast(begun), "block")
    outside = F.when(F.col("inside") == 0, ~F.col("inside0")).otherwise(~F.col("inside1"))
    level = F.col("depth") + F.when(F.col("inside") == 0, F.col("depth0")).otherwise(F.col("depth1"))
    last = (F.col("block") == rows[-1].block) & F.col("is_last")
    ordered = Window.partitionBy("block").orderBy("place")
    known = known.withColumn("is_last", F.lead("place").over(ordered).isNull())
    braced = F.lit(True) if closed else ~last
    known = known.withColumn("ends", outside & (level == base) & braced)
    running = ordered.rowsBetween(Window.unboundedPreceding, -1)
    known = known.withColumn("ended", F.coalesce(F.sum(F.col("ends").cast("long")).over(running), F.lit(0)))
    known = known.select(
        "block", "place", "ends", "ended",
        F.when(braced, F.concat("value", F.lit(CLOSE))).otherwise(F.col("value")).alias("value"),
    )
    # How many records end in the blocks before: a record that goes on keeps its number.
    counts = known.groupBy("block").agg(F.count_if("ends").alias("c")).orderBy("block").collect()
    offsets, total = [], 0
    for r in counts:
        offsets.append((r.block, total))
        total += r.c
    offset = F.broadcast(spark.createDataFrame(offsets, "block long, before long"))
    numbered = known.join(offset, "block").withColumn("record", F.col("before") + F.col("ended"))
    parts = F.array_sort(F.collect_list(F.struct("block", "place", "value")))
    joined = numbered.groupBy("record").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "").alias("value"))
    body = F.regexp_replace("value", r"^[\s﻿]*[\[,]?\s*", "")
    rest = F.regexp_like("value", F.lit(r"\A[\s﻿]*\[?\s*\]?\s*\z"))
    complete = F.col("record") < total
    # What follows the last record has to be the end of the array, or nothing.
    return joined.where(complete | ~rest).select(body.alias("value")), is_list
