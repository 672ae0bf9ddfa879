"""Upserts and insert-only loads: fixtures, invariants and both strategies."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.sources import tables

DAY = datetime(2026, 8, 12)
SCHEMA = ("user_id long, post_id long, title string, body string, title_length int,"
          " body_length int, processed_at timestamp")
STRATEGIES = pytest.mark.parametrize("strategy", ["full_outer", "lookup"])


def posts(spark, **titles):
    rows = []
    for n, (key, title) in enumerate(titles.items(), 1):
        body = f"Body for {title}"
        rows.append((n, int(key[1:]), title, body, len(title), len(body), DAY))
    return spark.createDataFrame(rows, SCHEMA)


def titles_and_changes(df):
    return sorted((r["post_id"], r["title"], r["change"]) for r in df.collect())


@STRATEGIES
def test_insert_update_mixed(spark, strategy):
    def run(existing, incoming):
        return titles_and_changes(merge.upsert(existing, incoming, "post_id", strategy=strategy))

    one = posts(spark, p1="Original post")
    assert run(one, posts(spark, p2="New post")) == [
        (1, "Original post", "KEPT"), (2, "New post", "INSERTED")]
    assert run(one, posts(spark, p1="Updated post")) == [(1, "Updated post", "UPDATED")]
    two = posts(spark, p1="Original 1", p2="Original 2")
    assert run(two, posts(spark, p2="Updated 2", p3="New 3")) == [
        (1, "Original 1", "KEPT"), (2, "Updated 2", "UPDATED"), (3, "New 3", "INSERTED")]
    nothing = two.limit(0)
    assert run(nothing, two) == [(1, "Original 1", "INSERTED"), (2, "Original 2", "INSERTED")]
    assert run(two, nothing) == [(1, "Original 1", "KEPT"), (2, "Original 2", "KEPT")]


@STRATEGIES
def test_counts(spark, strategy):
    existing = posts(spark, p1="Original 1", p2="Original 2")
    incoming = posts(spark, p1="Original 1", p2="Updated 2", p3="New 3")
    merged = merge.upsert(existing, incoming, "post_id", strategy=strategy)
    row = merge.change_counts(merged).first()
    assert (row["updated"], row["inserted"], row["unchanged"], row["kept"]) == (1, 1, 1, 0)


@STRATEGIES
def test_incoming_null_is_not_written(spark, strategy):
    existing = posts(spark, p1="Original 1")
    incoming = existing.withColumn("title", F.lit(None).cast("string"))
    merged = merge.upsert(existing, incoming, "post_id", strategy=strategy)
    assert titles_and_changes(merged) == [(1, "Original 1", "UPDATED")]


@STRATEGIES
def test_lineage(spark, strategy):
    existing = posts(spark, p1="Original 1", p2="Original 2")
    incoming = posts(spark, p2="Updated 2", p3="New 3").withColumns(
        {"source_system": F.lit("feed"), "source_file": F.lit("f3")})
    merged = merge.upsert(existing, incoming, "post_id", strategy=strategy)
    found = {r["post_id"]: (r["source_system"], r["source_file"], r["change"])
             for r in merged.collect()}
    legacy = ("jsonplaceholder_api", "legacy_incremental_load")
    # The target had no lineage: only inserted rows bring theirs.
    assert found == {1: (*legacy, "KEPT"), 2: (*legacy, "UPDATED"), 3: ("feed", "f3", "INSERTED")}


def test_compare_columns_exclude_lineage(spark):
    existing = posts(spark, p1="Same")
    incoming = existing.withColumn("processed_at", F.lit(datetime(2026, 8, 13)))
    merged = merge.upsert(existing, incoming, "post_id")
    assert titles_and_changes(merged) == [(1, "Same", "UPDATED")]
    merged = merge.upsert(existing, incoming, "post_id", compare=["title", "body"])
    assert titles_and_changes(merged) == [(1, "Same", "UNCHANGED")]


@pytest.mark.parametrize("side", ["existing", "incoming"])
def test_bad_keys_are_refused(spark, side):
    good = posts(spark, p1="A", p2="B")
    for bad in (good.withColumn("post_id", F.lit(1).cast("long")),
                good.withColumn("post_id", F.when(F.col("post_id") > 1, F.col("post_id")))):
        pair = (bad, good) if side == "existing" else (good, bad)
        with pytest.raises(ValueError, match="repeated|null"):
            merge.upsert(*pair, "post_id")


@STRATEGIES
def test_invariants(spark, strategy):
    rng = random.Random(3)
    value = ["a", "b", None]

    def table(keys):
        rows = [(k, rng.choice(value), rng.choice(value)) for k in keys]
        rng.shuffle(rows)
        return rows

    schema = "k long, x string, y string"
    left = table(rng.sample(range(60), 40))
    right = table(rng.sample(range(60), 40))
    existing = spark.createDataFrame(left, schema)
    incoming = spark.createDataFrame(right, schema)

    def run(e, i):
        return merge.upsert(e, i, "k", lineage=False, strategy=strategy)

    first = run(existing, incoming)
    expected = {}
    old, new = {r[0]: r for r in left}, {r[0]: r for r in right}
    for k in old.keys() | new.keys():
        if k not in new:
            expected[k] = (*old[k][1:], "KEPT")
        elif k not in old:
            expected[k] = (*new[k][1:], "INSERTED")
        else:
            merged = [n if n is not None else o for o, n in zip(old[k][1:], new[k][1:])]
            expected[k] = (*merged, "UNCHANGED" if old[k] == new[k] else "UPDATED")
    found = {r["k"]: (r["x"], r["y"], r["change"]) for r in first.collect()}
    assert found == expected
    counts = merge.change_counts(first).first()
    assert sum(counts) == len(expected)
    again = run(first.drop("change"), incoming)
    assert {r["k"]: (r["x"], r["y"]) for r in again.collect()} == {
        k: v[:2] for k, v in expected.items()}


def test_insert_only(spark, rows):
    existing = spark.createDataFrame([(1, "old", 0), (2, "old", 0), (2, "again", 1)],
                                     "k long, v string, o int")
    incoming = spark.createDataFrame(
        [(2, "new", 0), (3, "late", 5), (3, "first", 1)], "k long, v string, o int")
    assert rows(merge.new_rows(existing, incoming, "k", ["o"])) == [(3, "first", 1)]
    assert rows(merge.insert_only(existing, incoming, "k", ["o"], ["o"]), "k", "v") == [
        (1, "old"), (2, "old"), (3, "first")]
    assert merge.insert_only(existing, incoming, "k", ["o"]).count() == 4
    assert rows(merge.key_overlap(existing, incoming, "k")) == [
        (1, "EXISTING"), (2, "BOTH"), (3, "INCOMING")]


def test_append_new_rows(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "old", 0)], "k long, v string, o int").write.parquet(path)
    incoming = spark.createDataFrame([(1, "new", 0), (2, "b", 1), (2, "a", 0)],
                                     "k long, v string, o int")
    assert tables.append_new_rows(incoming, path, "k", ["o"]) == 1
    assert tables.append_new_rows(incoming, path, "k", ["o"]) == 0
    assert rows(tables.read_table(spark, path), "k", "v") == [(1, "old"), (2, "a")]


def test_keep_first_is_pruned_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id AS o")
    first = merge.keep_first(df, "k", ["o"])
    assert sorted(tuple(r) for r in first.collect()) == [(0, 0), (1, 1), (2, 2)]
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()


def test_versions(spark, rows, tmp_path):
    root = str(tmp_path / "posts")
    assert tables.read_current(spark, root) is None
    assert tables.publish_version(posts(spark, p1="One"), root) == 1
    current = tables.read_current(spark, root)
    merged = merge.upsert(current, posts(spark, p2="Two"), "post_id").drop("change")
    assert tables.publish_version(merge.sorted_by_key(merged, "post_id"), root) == 2
    assert rows(tables.read_current(spark, root), "post_id", "title") == [(1, "One"), (2, "Two")]
    assert tables.read_current(spark, root, before=2).count() == 1
    (tmp_path / "posts" / "version=0000000003").mkdir()
    assert tables.versions(spark, root) == [1, 2]
    with pytest.raises(ValueError, match="no rows"):
        tables.publish_version(merged.limit(0), root, allow_empty=False)
    assert tables.versions(spark, root) == [1, 2]
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, str(tmp_path / "absent"))
    tables.publish_version(posts(spark, p9="Nine"), root, version=4)
    assert tables.drop_old_versions(spark, root, keep=2) == [1]
    assert tables.versions(spark, root) == [2, 4]
    with pytest.raises(ValueError):
        tables.drop_old_versions(spark, root, keep=1)
