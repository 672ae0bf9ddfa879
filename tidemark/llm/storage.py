"""Written intermediates and keys shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.scratch import scratch_dir
from tidemark.sources.paths import delete


#: Has shuffle files deleted at the end of the query that made them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Written:
    """A DataFrame written once to the shared scratch folder and read back from there.

    What was shuffled for it is not read again and is deleted once it is written; otherwise
    those files would stay until the driver happens to collect its garbage.
    """

    def __init__(self, df: DataFrame, label: str) -> None:
        self.spark = df.sparkSession
        self.path = scratch_dir(self.spark, label)
        with _setting(self.spark, CLEANUP, "true"):
            df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)
        if _open:
            _open[-1].made.append(self)

    def drop(self) -> None:
        """Delete the files; nothing may read :attr:`df` afterwards."""
        delete(self.spark, self.path)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """The session has this setting inside the block, and the one it had before after it."""
    before = spark.conf.getAll.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


#: Blocks under way, the innermost last.
_open: list[Intermediates] = []


class Intermediates:
    """A block whose written frames are deleted at its end, but for the results.

    Use it as a context; :meth:`result` writes what is read after the block.
    """

    def __init__(self) -> None:
        self.made: list[Written] = []
        self.results: list[Written] = []

    def __enter__(self) -> Intermediates:
        _open.append(self)
        return self

    def result(self, df: DataFrame, label: str) -> DataFrame:
        self.results.append(Written(df, label))
        return self.results[-1].df

    def __exit__(self, *_: object) -> None:
        _open.remove(self)
        for written in self.made:
            if written not in self.results:
                written.drop()
        if _open:
            _open[-1].made.extend(self.results)


def content_keys(value: Column) -> list[Column]:
    """128 bits of hash, as two longs: rows with equal keys have equal content."""
    return [
        F.xxhash64(value).alias("k1"),
        F.xxhash64(F.lit("other half"), value).alias("k2"),
    ]
