"""Keyed tables: pruned merges, splitting, concurrent writers, old versions."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.sources import keyed, tables
from tidemark.sources.keyed import KeyedTable

SCHEMA = "k long, v string"


def frame(spark, pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def content(df):
    return {r["k"]: r["v"] for r in df.collect()}


def checked(target, version=None):
    """The parts of a version, after a look at their ranges and counts."""
    parts = target.parts(version or target.newest())
    for one, following in zip(parts, parts[1:]):
        assert one.high < following.low
    for p in parts:
        seen = target.read(parts=[p]).agg(F.min("k"), F.max("k"), F.count("*")).first()
        assert tuple(seen) == (p.low, p.high, p.rows)
    return parts


def test_untouched_files_keep_their_names(spark, tmp_path):
    target = KeyedTable(spark, str(tmp_path / "t"), "k", rows_per_file=50)
    first = target.merge(frame(spark, [(k, "a") for k in range(0, 1000, 2)]), lineage=False)
    before = checked(target)
    assert first.changes == {"inserted": 500, "updated": 0, "unchanged": 0, "kept": 0}
    assert len(before) >= 5
    second = target.merge(frame(spark, [(2, "b"), (3, "c"), (998, "a")]), lineage=False)
    after = checked(target)
    assert second.changes == {"inserted": 1, "updated": 1, "unchanged": 1, "kept": 498}
    assert len(second.replaced) == 2
    assert {p.file for p in before} - {p.file for p in after} == set(second.replaced)
    expected = {k: "a" for k in range(0, 1000, 2)} | {2: "b", 3: "c"}
    assert content(target.read()) == content(tables.read_current(spark, target.root)) == expected
    assert content(target.read(1)) == {k: "a" for k in range(0, 1000, 2)}


def test_random_merges_equal_a_dictionary(spark, tmp_path):
    rng = random.Random(4)
    target = KeyedTable(spark, str(tmp_path / "t"), "k", rows_per_file=20)
    known = {}
    for step in range(5):
        low = rng.choice([-100, 0, 300])
        batch = {k: f"{step}" for k in rng.sample(range(low, low + 200), 60)}
        target.merge(frame(spark, batch.items()), lineage=False)
        known |= batch
        assert content(target.read()) == known
        assert max(p.rows for p in checked(target)) <= 3 * 20 + 60
    assert len(target.parts(target.newest())) > 4


def test_keys_of_other_types(spark, tmp_path):
    for name, kind in (("s", "string"), ("d", "date"), ("t", "timestamp"), ("n", "decimal(10,2)")):
        target = KeyedTable(spark, str(tmp_path / name), "k", rows_per_file=10)
        days = spark.range(60).select(F.date_add(F.lit("2026-01-01").cast("date"), F.col("id").cast("int")).alias("d"), "id")
        key = {"string": F.concat(F.lit("é'\""), F.col("id")), "decimal(10,2)": F.col("id") / 4}.get(kind, F.col("d"))
        rows = days.select(key.cast(kind).alias("k"), F.col("id").cast("string").alias("v"))
        target.merge(rows, lineage=False)
        assert target.merge(rows.where("v < '2'"), lineage=False).changes["inserted"] == 0
        parts = target.parts(2)
        assert len(parts) > 2 and all(a.high < b.low for a, b in zip(parts, parts[1:]))
        assert target.read().count() == 60


def test_new_columns_are_filled_in_everywhere(spark, tmp_path):
    target = KeyedTable(spark, str(tmp_path / "t"), "k", rows_per_file=10)
    target.merge(frame(spark, [(k, "a") for k in range(60)]), lineage=False)
    done = target.merge(frame(spark, [(1, "b")]))
    assert len(done.replaced) == len(target.parts(1)) > 1
    assert target.read().where("source_system = 'jsonplaceholder_api'").count() == 60
    assert len(target.merge(frame(spark, [(1, "c")])).replaced) == 1


def test_bad_keys_empty_batches_and_other_tables(spark, tmp_path):
    target = KeyedTable(spark, str(tmp_path / "t"), "k")
    assert target.read() is None
    assert target.merge(frame(spark, []), lineage=False).version == 1
    assert target.read().count() == 0 and target.read().columns == ["k", "v"]
    for bad, message in (([(1, "a"), (1, "b")], "repeated"), ([(None, "a")], "null")):
        with pytest.raises(ValueError, match=message):
            target.merge(frame(spark, bad), lineage=False)
    assert target.merge(frame(spark, [(1, "a")]), lineage=False).version == 2
    assert target.merge(frame(spark, []), lineage=False).changes["kept"] == 1
    tables.publish_version(frame(spark, [(1, "a")]), str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="not a list of files"):
        KeyedTable(spark, str(tmp_path / "plain"), "k").read()


def overtaken(monkeypatch, other):
    """Let ``other`` commit just before the first commit that follows."""
    commit = KeyedTable._commit

    def late(self, *args):
        monkeypatch.setattr(KeyedTable, "_commit", commit)
        other()
        return commit(self, *args)

    monkeypatch.setattr(KeyedTable, "_commit", late)


@pytest.mark.parametrize("theirs, again", [([(900, "x")], 0), ([(1, "x"), (5, "x")], 1)])
def test_a_writer_that_loses_goes_on_from_the_newer_version(spark, tmp_path, monkeypatch, theirs, again):
    root = str(tmp_path / "t")
    target = KeyedTable(spark, root, "k", rows_per_file=50)
    target.merge(frame(spark, [(k, "a") for k in range(0, 1000, 2)]), lineage=False)
    overtaken(monkeypatch, lambda: KeyedTable(spark, root, "k", 50).merge(frame(spark, theirs), lineage=False))
    writes, write = [], KeyedTable._write
    monkeypatch.setattr(KeyedTable, "_write", lambda self, *a: writes.append(1) or write(self, *a))
    done = target.merge(frame(spark, [(2, "b"), (5, "c")]), lineage=False)
    assert done.version == 3 and sum(done.changes.values()) == target.read().count()
    # One write of mine, one of the other's, and one more only if it took the same files.
    assert len(writes) == 2 + again
    expected = {k: "a" for k in range(0, 1000, 2)} | dict(theirs) | {2: "b", 5: "c"}
    assert content(target.read()) == expected
    checked(target)


def test_writers_at_the_same_time_lose_nothing(spark, tmp_path):
    root, failed = str(tmp_path / "t"), []

    def writer(first):
        try:
            for step in range(3):
                rows = frame(spark, [(first + 2 * (10 * step + i), f"{first}") for i in range(10)])
                KeyedTable(spark, root, "k", rows_per_file=8).merge(rows, lineage=False)
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=writer, args=(n,)) for n in (0, 1)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed
    assert content(tables.read_current(spark, root)) == {k: str(k % 2) for k in range(60)}
    assert tables.versions(spark, root) == [1, 2, 3, 4, 5, 6]


def test_old_versions_take_the_files_that_only_they_name(spark, tmp_path):
    target = KeyedTable(spark, str(tmp_path / "t"), "k", rows_per_file=20)
    target.merge(frame(spark, [(k, "a") for k in range(100)]), lineage=False)
    for step in range(3):
        target.merge(frame(spark, [(step, "b")]), lineage=False)
    gone = target.drop_old_versions(keep=2)
    assert tables.versions(spark, target.root) == [3, 4]
    assert gone and not any((tmp_path / "t" / file).exists() for file in gone)
    assert target.read(3).count() == target.read(4).count() == 100
    with pytest.raises(ValueError):
        target.drop_old_versions(keep=1)


def test_a_merge_scans_touched_files_only(spark, tmp_path, monkeypatch):
    target = KeyedTable(spark, str(tmp_path / "t"), "k", rows_per_file=20)
    target.merge(frame(spark, [(k, "a") for k in range(200)]), lineage=False)
    read = []
    original = keyed.upsert
    monkeypatch.setattr(keyed, "upsert", lambda e, *a, **b: read.append(len(e.inputFiles())) or original(e, *a, **b))
    target.merge(frame(spark, [(7, "b")]), lineage=False)
    assert read == [0, 1]
