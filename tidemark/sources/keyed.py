"""Keyed tables whose versions are lists of files with key ranges.

A version is a small table that names its files with their lowest and highest key; the
files stay where they are and are shared by versions.  A batch is merged into the files
whose ranges its keys fall into, and only these are written anew: the cost of a merge
follows what the batch touches, not the size of the table.

Ranges do not overlap: the first file takes every key below the second one's lowest, any
other file those from its lowest key to the next one's.  A file that has outgrown the
wanted size is split at the next merge that touches it.

Writers need no lock.  A version is prepared aside and takes its number by a rename that
fails if the number is taken (atomic on HDFS and local disks; a store without such a
rename takes one writer at a time).  Who loses takes the next number if none of the files
it replaced has been replaced since, and merges again otherwise.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, LongType, StringType, StructField, StructType

from tidemark.operators.enrich import backfill_lineage
from tidemark.operators.merge import CHANGE, upsert
from tidemark.sources.paths import delete, rename_to_new
from tidemark.sources.tables import KEYED, read_manifest, version_path, versions

ROWS_PER_FILE = 4_000_000
KINDS = ("INSERTED", "UPDATED", "UNCHANGED", "KEPT")


@dataclass(frozen=True)
class Part:
    """A file (below the table's root), its key range as values and as text, its rows."""

    file: str
    low: object
    low_text: str
    high: object
    rows: int


@dataclass
class Merged:
    """What a merge did: its version, the rows by change, files by what became of them."""

    version: int
    changes: dict[str, int]
    written: list[str] = field(default_factory=list)
    replaced: list[str] = field(default_factory=list)


def _place(key: Column, bounds: Sequence[str], kind: DataType) -> Column:
    """How many of the ascending bounds are at most the key: a binary search in the row."""
    if not bounds:
        return F.lit(0)
    lows = F.from_json(F.lit(json.dumps(list(bounds))), "array<string>").cast(f"array<{kind.simpleString()}>")
    span = F.struct(F.lit(0).alias("from"), F.lit(len(bounds)).alias("to"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.shiftright(s["from"] + s["to"], 1)
        right = F.coalesce(F.get(lows, middle) <= key, F.lit(False))
        return F.when(s["from"] >= s["to"], s).otherwise(
            F.struct(
                F.when(right, middle + 1).otherwise(s["from"]).alias("from"),
                F.when(right, s["to"]).otherwise(middle).alias("to"),
            )
        )

    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    return F.aggregate(steps, span, halve)["from"]


class KeyedTable:
    """A table at ``root`` with one row for each ``key``, merged file by file."""

    def __init__(self, spark: SparkSession, root: str, key: str, rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.root, self.key, self.rows_per_file = spark, root, key, rows_per_file
        # What has been read of versions, which never change.
        self._known: dict[int, _Version] = {}

    def newest(self) -> int:
        """The newest complete version, 0 if there is none."""
        return max(versions(self.spark, self.root), default=0)

    def parts(self, version: int) -> list[Part]:
        """The files of a version in key order."""
        return list(self._version(version).parts) if version else []

    def _version(self, version: int) -> _Version:
        if version not in self._known:
            rows = read_manifest(self.spark, self.root, version)
            if KEYED not in rows.columns:
                raise ValueError(f"version {version} of {self.root} is not a list of files")
            found = rows.withColumn("low_text", F.col("low").cast("string")).collect()
            parts = [Part(r.file, r.low, r.low_text, r.high, r.n) for r in found if r.file is not None]
            head = next(r for r in found if r.file is None)
            schema = StructType.fromJson(json.loads(head.columns))
            self._known[version] = _Version(schema, head.owner, sorted(parts, key=lambda p: p.low))
        return self._known[version]

    def read(self, version: int | None = None, parts: Sequence[Part] | None = None) -> DataFrame | None:
        """A version, the newest by default, or some of its files; None without a version."""
        version = self.newest() if version is None else version
        if not version:
            return None
        schema = self._schema(version)
        chosen = self.parts(version) if parts is None else parts
        if not chosen:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p.file}" for p in chosen])

    def owner(self, version: int) -> str | None:
        return self._version(version).owner

    def _schema(self, version: int) -> StructType:
        return self._version(version).schema

    # --- merging ------------------------------------------------------------------------

    def merge(
        self,
        incoming: DataFrame,
        compare: Sequence[str] | None = None,
        lineage: bool = True,
        owner: str | None = None,
    ) -> Merged:
        """Upsert ``incoming``, whose keys must be unique and not null, as a new version.

        ``incoming`` is read more than once, so it should be written or cheap.  Rows in
        files that are not touched are counted as kept.  ``owner`` is noted in the version.
        """
        while True:
            base = self.newest()
            done = self._write(base, incoming, compare, lineage)
            version = self._commit(base, done, owner)
            if version:
                done.result.version = version
                return done.result
            delete(self.spark, f"{self.root}/{done.folder}")

    def _commit(self, base: int, done: _Written, owner: str | None) -> int | None:
        """The number that the written files got; None if they must be merged again."""
        parts, newest = self.parts(base), base
        replaced = set(done.result.replaced)
        while True:
            kept = [p for p in parts if p.file not in replaced]
            staged = f"{self.root}/_staged-{uuid.uuid4().hex}"
            self._manifest([*kept, *done.parts], done.schema, owner).write.parquet(staged)
            if rename_to_new(self.spark, staged, version_path(self.root, newest + 1)):
                done.result.changes["kept"] += sum(p.rows for p in kept)
                listed = sorted([*kept, *done.parts], key=lambda p: p.low)
                self._known[newest + 1] = _Version(done.schema, owner, listed)
                return newest + 1
            delete(self.spark, staged)
            newest = self.newest()
            parts = self.parts(newest)
            same = replaced and replaced <= {p.file for p in parts}
            if not same or self._schema(newest) != done.schema:
                return None

    def _manifest(self, parts: Sequence[Part], schema: StructType, owner: str | None) -> DataFrame:
        kind = schema[self.key].dataType
        columns = StructType(
            [
                StructField("file", StringType()), StructField("low", kind), StructField("high", kind),
                StructField("n", LongType()), StructField("columns", StringType()),
                StructField("owner", StringType()), StructField(KEYED, StringType()),
            ]
        )
        rows = [(p.file, p.low, p.high, p.rows, None, None, None) for p in parts]
        rows.append((None, None, None, 0, schema.json(), owner, self.key))
        return self.spark.createDataFrame(rows, columns).coalesce(1)

    def _write(self, base: int, incoming: DataFrame, compare, lineage: bool) -> _Written:
        key, old = self.key, self.parts(base)
        empty = self.spark.createDataFrame([], self._schema(base) if base else incoming.schema)
        schema = upsert(empty, incoming, key, compare, lineage, "full_outer", "none").drop(CHANGE).schema
        schema = StructType([StructField(f.name, f.dataType) for f in schema])
        kind = schema[key].dataType
        found = self._touched(incoming, old, kind)
        # New columns have to be filled in everywhere.
        grown = base > 0 and schema != self._schema(base)
        touched = old if grown else [old[i] for i in sorted(found) if i < len(old)]
        bounds = {p.low_text: p.low for p in touched[1:]}
        bounds |= self._splits(incoming, touched, old, found, kind)
        texts = sorted(bounds, key=bounds.get)
        if touched:
            merged = upsert(self.read(base, touched), incoming, key, compare, lineage, validate="none")
        else:
            merged = incoming.withColumn(CHANGE, F.lit("INSERTED"))
            merged = backfill_lineage(merged) if lineage else merged
            merged = merged.select(*[F.col(f.name).cast(f.dataType) for f in schema], CHANGE)
        merged = merged.withColumn("piece", _place(F.col(key), texts, kind))
        merged = merged.repartition("piece").sortWithinPartitions("piece", key)
        seen = Observation()
        merged = merged.observe(seen, *[F.count_if(F.col(CHANGE) == k).alias(k.lower()) for k in KINDS])
        folder = f"data/{uuid.uuid4().hex}"
        merged.drop(CHANGE).write.partitionBy("piece").parquet(f"{self.root}/{folder}")
        changes = {k.lower(): seen.get[k.lower()] or 0 for k in KINDS}
        parts = self._written(folder) if sum(changes.values()) else []
        result = Merged(0, changes, [p.file for p in parts], [p.file for p in touched])
        return _Written(folder, parts, schema, result)

    def _touched(self, incoming: DataFrame, old: Sequence[Part], kind: DataType) -> dict[int, int]:
        """The batch's rows by the file they fall into; null and repeated keys are refused."""
        counts = incoming.groupBy(F.col(self.key).cast(kind).alias("k")).agg(F.count("*").alias("n"))
        place = _place(F.col("k"), [p.low_text for p in old[1:]], kind).alias("place")
        found = counts.groupBy(place).agg(
            F.sum("n").alias("n"),
            F.max("n").alias("most"),
            F.max_by(F.col("k").cast("string"), "n").alias("example"),
            F.max(F.col("k").isNull()).alias("nulls"),
        )
        rows = found.collect()
        for r in rows:
            if r.nulls:
                raise ValueError(f"null {self.key} on the incoming side")
            if r.most > 1:
                raise ValueError(f"repeated {self.key} on the incoming side: {r.example}")
        return {r.place: r.n for r in rows}

    def _splits(self, incoming: DataFrame, touched, old, found, kind: DataType) -> dict[str, object]:
        """Keys at which files that would be too large are cut, from all keys they would hold."""
        key, files = self.key, {p.file: p for p in touched}
        sizes = {i: (old[i].rows if i < len(old) and old[i].file in files else 0) + n for i, n in found.items()}
        large = {i: n for i, n in sizes.items() if n > 2 * self.rows_per_file}
        if not large:
            return {}
        place = _place(F.col(key).cast(kind), [p.low_text for p in old[1:]], kind)
        keys = incoming.where(place.isin(list(large))).select(F.col(key).cast(kind).alias("k"))
        held = [old[i] for i in large if i < len(old)]
        if held:
            keys = keys.unionAll(self.spark.read.parquet(*[f"{self.root}/{p.file}" for p in held]).select(F.col(key).cast(kind)))
        ranges = keys.repartitionByRange(-(-sum(large.values()) // self.rows_per_file), "k")
        lows = ranges.groupBy(F.spark_partition_id()).agg(F.min("k").alias("low"))
        cuts = {r.text: r.low for r in lows.select("low", F.col("low").cast("string").alias("text")).collect()}
        lowest = min(cuts.values())
        return {text: low for text, low in cuts.items() if low != lowest}

    def _written(self, folder: str) -> list[Part]:
        name, low = F.col("_metadata.file_name"), F.min(self.key)
        files = self.spark.read.parquet(f"{self.root}/{folder}").groupBy("piece", name.alias("name"))
        rows = files.agg(
            low.alias("low"), low.cast("string").alias("text"), F.max(self.key).alias("high"), F.count("*").alias("n")
        ).collect()
        return [Part(f"{folder}/piece={r.piece}/{r.name}", r.low, r.text, r.high, r.n) for r in rows]

    # --- old versions -------------------------------------------------------------------

    def drop_old_versions(self, keep: int) -> list[str]:
        """Delete all but the newest ``keep`` versions, and files that only they name.

        Files that no version names yet may belong to a merge under way and stay.
        """
        if keep < 2:
            raise ValueError("at least two versions are kept")
        known = versions(self.spark, self.root)
        needed = {p.file for v in known[-keep:] for p in self.parts(v)}
        old = {p.file for v in known[:-keep] for p in self.parts(v)} - needed
        for version in known[:-keep]:
            delete(self.spark, version_path(self.root, version))
        for file in sorted(old):
            delete(self.spark, f"{self.root}/{file}")
        return sorted(old)


@dataclass(frozen=True)
class _Version:
    schema: StructType
    owner: str | None
    parts: list[Part]


@dataclass
class _Written:
    folder: str
    parts: list[Part]
    schema: StructType
    result: Merged
