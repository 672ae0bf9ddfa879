"""The analytical questions asked of curated posts and users.

Sorts end in the post or user key: it makes ties definite and gives range
partitioning something to split a run of equal lengths on.  Nulls sort last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.enrich import length_category
from tidemark.plans.skew import keyed_join

_SIZES = ["post_id", "user_id", "title_length", "body_length"]


def _longest_first():
    return [F.col("body_length").desc_nulls_last(), F.col("post_id").asc_nulls_last()]


def first_posts(posts: DataFrame, rows: int = 10) -> DataFrame:
    return (
        posts.select("post_id", "user_id", "title", "title_length", "body_length")
        .orderBy(F.col("post_id").asc_nulls_last())
        .limit(rows)
    )


def total_posts(posts: DataFrame) -> DataFrame:
    return posts.agg(F.count("*").alias("total_posts"))


def posts_per_user(posts: DataFrame, more_than: int | None = None) -> DataFrame:
    """Post counts by user, largest first; ``more_than`` keeps only busier users."""
    counts = posts.groupBy("user_id").agg(F.count("*").alias("post_count"))
    if more_than is not None:
        counts = counts.filter(F.col("post_count") > more_than)
    return counts.orderBy(
        F.col("post_count").desc_nulls_last(), F.col("user_id").asc_nulls_last()
    )


def average_title_length(posts: DataFrame) -> DataFrame:
    # Lengths are integers: their sum is exact whatever the order of addition.
    return posts.agg(
        F.try_divide(F.sum("title_length").cast("double"), F.count("title_length")).alias(
            "average_title_length"
        )
    )


def longest_posts(posts: DataFrame, rows: int = 10) -> DataFrame:
    return posts.select(*_SIZES).orderBy(*_longest_first()).limit(rows)


def long_posts(
    posts: DataFrame, longer_than: int = 200, title_below: int | None = None
) -> DataFrame:
    wanted = F.col("body_length") > longer_than
    if title_below is not None:
        wanted = wanted & (F.col("title_length") < title_below)
    return posts.filter(wanted).select(*_SIZES).orderBy(*_longest_first())


def posts_by_length_category(posts: DataFrame) -> DataFrame:
    return (
        length_category(posts)
        .select("post_id", "user_id", "body_length", "body_category")
        .orderBy(*_longest_first())
    )


def posts_with_users(
    posts: DataFrame, users: DataFrame, rows: int | None = 20, strategy: str = "auto"
) -> DataFrame:
    joined = keyed_join(
        posts.select("post_id", "user_id", "title", "body_length"),
        users.select("user_id", "name", "username", "email"),
        "user_id",
        strategy=strategy,
        spread_by=["post_id"],
    ).select("post_id", "user_id", "name", "username", "email", "title", "body_length")
    joined = joined.orderBy(F.col("post_id").asc_nulls_last())
    return joined if rows is None else joined.limit(rows)


def post_user_mart(posts: DataFrame, users: DataFrame, strategy: str = "auto") -> DataFrame:
    """Every post that has a user, with the user's name and address."""
    facts = posts.select(
        "post_id", "user_id", "title", "body", "title_length", "body_length", "processed_at"
    )
    return keyed_join(
        facts,
        users.select("user_id", "name", "username", "email"),
        "user_id",
        strategy=strategy,
        spread_by=["post_id"],
    ).select(*schemas.MART_COLUMNS)
