"""Cleaning pipeline over ``documents``: each stage works on what the one before it kept.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the next stage's ``docs``.  All but the last keep the columns
of ``documents``; the last gives the digests of the encoded texts.

Null and empty texts pass every stage: they are not toxic, hold no line and no
benchmark item, and equal ones are copies of each other, of which one stays.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_dedup, order_minhash, pieces, toxicity
from tidemark.llm.storage import Written

#: The stages cannot be expressed in SQL; they are tested against brute-force versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not predict to be toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_documents(docs, toxicity.train(docs, labels))
    return scored.where("predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each without the lines that an earlier one holds."""
    clean = line_dedup.deduplicated(docs)
    if "n_chars" not in docs.columns:
        return clean
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    changed = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length)
    return clean.withColumn("n_chars", changed)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates; rows without an id stay."""
    classes = order_minhash.near_duplicate_classes(docs)
    dropped = classes.where("NOT kept").select(F.col("doc_id").alias("_dropped"))
    return docs.join(dropped, docs["doc_id"] == dropped["_dropped"], "left_anti")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean_documents(docs, items)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the decoded text of every document."""
    return pieces.encoded(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; all but the last are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = Written(stage(spark, docs, sf_dir), name).df
    return STAGES[-1][1](spark, docs, sf_dir)
