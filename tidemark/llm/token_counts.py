"""Token counts from an exact histogram of encoded document lengths.

Every whole text is encoded once and only its length is kept.  One row for each distinct
length with suffix sums then answers, for any context limit, how many documents and
tokens fit, how many are cut, and what remains after truncation; and quantiles.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import encoder

#: Lengths in one range of the suffix sums: no task ever sees more rows than this.
RANGE = 4096


def document_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``(doc_id, n_tokens)`` of every whole text; null and empty texts have 0."""

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = encoder(tokenizer)
        for batch in texts:
            yield pd.Series([bpe.count(t) for t in batch], dtype="int64")

    return docs.select("doc_id", count(F.col("text")).alias("n_tokens"))


def histogram(lengths: DataFrame) -> DataFrame:
    """``(n_tokens, docs)``: how many documents have each length; null lengths are left out."""
    known = lengths.where(F.col("n_tokens").isNotNull())
    return known.groupBy("n_tokens").agg(F.count("*").alias("docs"))


def length_table(counts: DataFrame) -> DataFrame:
    """The histogram with suffix sums; an empty one stays empty.

    For a context limit equal to ``n_tokens``: ``docs_at_least`` and ``tokens_at_least``
    are of the documents with that length or a longer one, ``truncated_total`` are the
    tokens left when every document is cut to the limit, ``cut_docs`` the documents
    that lose some, and ``share_at_most`` the share of documents not longer.

    Sums run inside ranges of lengths first and then over the ranges' totals, so one
    range of lengths is all that a task holds.
    """
    tokens = F.col("n_tokens") * F.col("docs")
    ranged = counts.select(
        "n_tokens", "docs", tokens.alias("tokens"), F.floor(F.col("n_tokens") / RANGE).alias("r")
    )
    totals = ranged.groupBy("r").agg(F.sum("docs").alias("d"), F.sum("tokens").alias("t"))
    later = Window.orderBy(F.col("r").desc()).rowsBetween(Window.unboundedPreceding, -1)
    first = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "r",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("tokens_after"),
        F.sum("d").over(first).alias("all_docs"),
        F.sum("t").over(first).alias("all_tokens"),
    )
    here = Window.partitionBy("r").orderBy(F.col("n_tokens").desc())
    here = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = ranged.select(
        "*", F.sum("docs").over(here).alias("d_here"), F.sum("tokens").over(here).alias("t_here")
    )
    docs_at_least = F.col("d_here") + F.col("docs_after")
    tokens_at_least = F.col("t_here") + F.col("tokens_after")
    longer = docs_at_least - F.col("docs")
    kept = F.col("all_tokens") - tokens_at_least + F.col("n_tokens") * docs_at_least
    return inside.join(offsets, "r").select(
        "n_tokens",
        "docs",
        docs_at_least.alias("docs_at_least"),
        tokens_at_least.alias("tokens_at_least"),
        longer.alias("cut_docs"),
        kept.alias("truncated_total"),
        ((F.col("all_docs") - longer) / F.col("all_docs")).alias("share_at_most"),
    )


def quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """``(share, n_tokens)``: the smallest length that at least that share does not exceed."""
    picked = [
        F.min(F.when(F.col("share_at_most") >= share - 1e-12, F.col("n_tokens"))).alias(f"q{i}")
        for i, share in enumerate(shares)
    ]
    pairs = [F.struct(F.lit(s).alias("share"), F.col(f"q{i}").alias("n_tokens")) for i, s in enumerate(shares)]
    return table.agg(*picked).select(F.inline(F.array(*pairs)))


def limits(table: DataFrame, contexts: list[int]) -> DataFrame:
    """``(context, docs_fitting, cut_docs, truncated_total)`` for any context limits.

    ``table`` is a length table; a limit between two lengths is answered exactly.
    """
    out = []
    for i, context in enumerate(contexts):
        over = F.col("n_tokens") > context
        out += [
            F.coalesce(F.sum(F.when(~over, F.col("docs"))), F.lit(0)).alias(f"f{i}"),
            F.coalesce(F.sum(F.when(over, F.col("docs"))), F.lit(0)).alias(f"c{i}"),
            F.coalesce(F.sum(F.least("n_tokens", F.lit(context)) * F.col("docs")), F.lit(0)).alias(f"t{i}"),
        ]
    rows = [
        F.struct(
            F.lit(c).alias("context"),
            F.col(f"f{i}").alias("docs_fitting"),
            F.col(f"c{i}").alias("cut_docs"),
            F.col(f"t{i}").alias("truncated_total"),
        )
        for i, c in enumerate(contexts)
    ]
    return table.agg(*out).select(F.inline(F.array(*rows)))
