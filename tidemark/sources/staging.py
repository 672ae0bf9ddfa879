"""Appends that are written once: aside first, into their table when they are approved."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F

from tidemark.sources.paths import delete, move_files


class Staged:
    """Rows written below ``path`` where its readers do not look, with what was seen of them.

    ``seen`` has their number as ``n`` and the given aggregates, observed while they were
    written.  :meth:`publish` moves the files into the table, :meth:`discard` deletes them.
    """

    def __init__(
        self,
        df: DataFrame,
        path: str,
        write: Callable[[DataFrameWriter, str], None],
        **also: Column,
    ) -> None:
        self.spark, self.target = df.sparkSession, path
        self.path = f"{path}/_staged-{uuid.uuid4().hex}"
        seen = Observation()
        counted = df.observe(
            seen, F.count(F.lit(1)).alias("n"), *[value.alias(name) for name, value in also.items()]
        )
        try:
            write(counted.write, self.path)
        except Exception:
            self.discard()
            raise
        self.seen = dict(seen.get)

    def publish(self) -> list[str]:
        moved = move_files(self.spark, self.path, self.target)
        delete(self.spark, self.path)
        return moved

    def discard(self) -> None:
        delete(self.spark, self.path)


def append_once(df: DataFrame, path: str, write: Callable[[DataFrameWriter, str], None]) -> int:
    """Append rows in one write; nothing is left behind for no rows.  Returns how many."""
    staged = Staged(df, path, write)
    if staged.seen["n"]:
        staged.publish()
    else:
        staged.discard()
    return staged.seen["n"]
