"""Parallel reading of one JSON array against the json module."""

import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources import json_array, landing

AWKWARD = ["", "plain", "a } b", "[{", '"quoted"', "back\\slash", '\\"}', "tab\tnew\nline", "é日本😀", "{}", "],[", "\\"]


def nested(rng, depth=0):
    kind = rng.randrange(6 if depth < 3 else 4)
    if kind < 4:
        return [rng.choice(AWKWARD), rng.randrange(100), None, True][kind]
    if kind == 4:
        return [nested(rng, depth + 1) for _ in range(rng.randrange(3))]
    return {rng.choice(AWKWARD) + str(i): nested(rng, depth + 1) for i in range(rng.randrange(3))}


def records(seed, n):
    rng = random.Random(seed)
    return [{"id": i, "title": rng.choice(AWKWARD), "more": nested(rng)} for i in range(n)]


@pytest.fixture()
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "300")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("indent, ascii_only", [(None, True), (2, False), (None, False)])
def test_every_record_is_cut_where_it_ends(spark, tmp_path, small_blocks, indent, ascii_only):
    expected = records(indent or 0, 150)
    path = tmp_path / "a.json"
    path.write_text(json.dumps(expected, indent=indent, ensure_ascii=ascii_only) + "\n", encoding="utf-8")
    texts, is_list = json_array.array_records(spark, str(path))
    assert is_list
    found = sorted((json.loads(r.value) for r in texts.collect()), key=lambda r: r["id"])
    assert found == expected
    blocks = spark.read.option("lineSep", "}").text(str(path)).select("_metadata.file_block_start").distinct()
    assert blocks.count() > 10


def test_a_record_larger_than_many_blocks(spark, tmp_path, small_blocks):
    expected = [{"id": 0, "title": "x } " * 2000}, {"id": 1, "title": "\\\"" * 500}, {"id": 2, "title": "y"}]
    path = tmp_path / "a.json"
    path.write_text(json.dumps(expected))
    texts, _ = json_array.array_records(spark, str(path))
    assert sorted((json.loads(r.value) for r in texts.collect()), key=lambda r: r["id"]) == expected


@pytest.mark.parametrize(
    "content, is_list, texts",
    [
        ("[]", True, []), (" [ ] \n", True, []), ("", False, []), ('{"id": 1}', False, ['{"id": 1}']),
        ('[{"id": 1}', True, ['{"id": 1}']), ('[{"id": 1', True, ['{"id": 1']), ("[{]", True, ["{]"]),
        ('[1, {"id": 1}]', True, ['1, {"id": 1}']), ('[{"id": 1}, 7]', True, ['{"id": 1}', "7]"]),
        ('[{"a": {}}, {"a": {"b": {}}}]', True, ['{"a": {"b": {}}}', '{"a": {}}']),
    ],
)
def test_odd_files(spark, tmp_path, content, is_list, texts):
    path = tmp_path / "a.json"
    path.write_text(content)
    found, shape = json_array.array_records(spark, str(path))
    assert (sorted(r.value for r in found.collect()), shape) == (sorted(texts), is_list)


def test_landing_in_both_layouts_agrees(spark, tmp_path):
    rows = [{"userId": i % 3, "id": i, "title": AWKWARD[i % len(AWKWARD)], "body": "b", "extra": {"k": [i]}} for i in range(40)]
    # A nested unknown field is text; without spaces it is the same from either parser.
    texts = [json.dumps(r, separators=(",", ":")) for r in rows]
    (tmp_path / "array.json").write_text("[" + ", ".join(texts) + "]")
    (tmp_path / "lines.json").write_text("\n".join(texts))
    both = []
    for layout in ("array", "lines"):
        path = str(tmp_path / f"{layout}.json")
        assert landing.landed_fields(spark, path, layout) == ["body", "extra", "id", "title", "userId"]
        df = landing.read_all_fields(spark, path, schemas.RAW_POSTS, layout)
        both.append((df.columns, sorted(map(tuple, df.collect()), key=repr)))
    assert both[0] == both[1]


def test_no_task_reads_the_whole_file(spark, tmp_path, small_blocks):
    path = tmp_path / "a.json"
    path.write_text(json.dumps(records(1, 100)))
    texts, _ = json_array.array_records(spark, str(path))
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert "wholetext" not in plan.lower() and "Python" not in plan
    assert texts.where(F.col("value") == "").count() == 0


def test_landing_an_array(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(30)], "id long, name string").repartition(4)
    path = landing.land_array(rows, str(tmp_path), "users", datetime(2026, 8, 12))
    assert path.endswith("/users_20260812_000000.json")
    assert sorted(r["id"] for r in json.loads((tmp_path / "users_20260812_000000.json").read_text())) == list(range(30))
    assert landing.read_landed(spark, path, schemas.RAW_USERS, "array").count() == 30
    with pytest.raises(FileExistsError):
        landing.land_array(rows, str(tmp_path), "users", datetime(2026, 8, 12))
    empty = landing.land_array(rows.limit(0), str(tmp_path), "posts", datetime(2026, 8, 12))
    assert json.loads((tmp_path / empty.rsplit("/", 1)[1]).read_text()) == []
