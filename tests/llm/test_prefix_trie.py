import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import catalog, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, part string"


def content(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()[:32]


def brute_force(rows):
    """The definition itself: every node with its members, subtree by subtree."""
    own = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            own[conv_id].append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, content(t[1], t[2])))
        turns[:] = [t[1:] for t in turns]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c > 0 else -1)
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, found in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children.get(path)
            saved[path[:d]] += (len(found) - 1) * words
    return sorted(
        (
            min(found), len(path), min(members[path[:-1]]) if path else -1, len(found),
            children.get(path, 0), leaves[path], saved[path],
            hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
        )
        for path, found in members.items()
    )


def result(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.collect())


def compared(spark, rows):
    table = spark.createDataFrame([(*r, 7, "x") for r in rows], SCHEMA)
    assert result(prefix_trie.prefix_trie(table)) == brute_force(rows)


def conversations(seed, n=120, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-60, 400), n):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant", None]), rng.choice(["a b", "", None, "c\x0bd e f"])))
    rng.shuffle(rows)
    return rows


def test_query_equals_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()]
    out = catalog.QUERIES["op12_prefix_trie"](spark, sf_dir)
    assert {k for n, k in out.dtypes if n != "ends_sha256"} == {"bigint"}
    assert result(out) == brute_force(rows)


@pytest.mark.parametrize("seed", range(2))
def test_shared_prefixes_nulls_and_negative_ids(spark, seed):
    compared(spark, conversations(seed))


def test_ties_repeated_rows_and_null_turns(spark):
    rows = [(c, t, "user", x) for c in (20, 21, 22, 40) for t in (None, 1, 1) for x in ("x", "y", "y")]
    compared(spark, rows + [(None, 1, "user", "lost"), (41, None, None, None)])


def test_one_conversation_in_many_ranges(spark):
    """A conversation with most of the turns is hashed in parts; its copies are leaves too."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        long = [(60, t, "user", f"w{t % 7} x" * (t % 3)) for t in range(900)]
        copy = [(80, *r[1:]) for r in long]
        rows = conversations(5, 60) + long + copy + [(c, t, "user", "same") for c in range(500, 560) for t in (1, 2)]
        # 900 deep prefixes are too many for the brute force's quadratic sums; halve them.
        compared(spark, [r for r in rows if r[0] not in (60, 80) or r[1] < 300])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_long_end_lists_are_hashed_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    compared(spark, [(c, 0, "user", "same") for c in range(100, 140)])


def test_a_rebuilt_conversation_may_have_no_turn(spark):
    ids = [c for c in range(1, 200) if zlib.crc32(str(c).encode()) % 4 and c % 20][:3]
    compared(spark, [(c, 0, "user", "gone") for c in ids])


def test_very_long_texts(spark):
    compared(spark, [(20, 0, "user", "word " * 400_000), (20, 1, "user", "x" * 2_000_000), (40, 0, "user", "word " * 400_000)])


def test_empty_table(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
