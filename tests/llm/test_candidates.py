"""Pairs that a cut of the candidates would lose."""

import random
import string

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, graph, line_dedup, order_minhash

from test_documents import changed, frame, leaks_brute_force, line_sets, lines_brute_force, near_brute_force, prose


def kept_lines(spark, rows):
    return {(r.doc_id, r.line_no): r.kept for r in line_dedup.line_decisions(frame(spark, rows)).collect()}


def test_all_lines_of_one_bucket_meet(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "band_keys", lambda _: F.array(F.lit(1).cast("long")))
    rng = random.Random(5)
    texts = []
    for _ in range(20):
        line = " ".join(prose(rng, rng.randint(4, 12)))
        texts += [line, line + "s", line[3:]]
    rows = list(enumerate(texts))
    assert kept_lines(spark, rows) == lines_brute_force(rows)


def test_apart_pairs_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(graph, "CHUNK", 7)
    rng = random.Random(7)
    sets = {}
    for i in range(60):
        near = rng.choice(list(sets.values())) if i % 2 else set()
        keep = set(rng.sample(sorted(near), max(0, len(near) - rng.randint(0, 4))))
        sets[i] = keep | {rng.getrandbits(62) for _ in range(rng.randint(0, 5) if i % 2 else rng.randint(1, 90))} or {1}
    parts = [(i, i // 20) for i in range(40)]
    part = {i: c for i, c in parts}
    rows = []
    for i, found in sets.items():
        word = 0
        for h in found:
            word ^= 1 << (h & 63)
        rows.append((i, len(found), word - (1 << 64) if word >> 63 else word))
    placed = spark.createDataFrame([(i, b) for i in sets for b in (1, 2)], "id long, bucket long")
    sketches = spark.createDataFrame(rows, "id long, size long, x0 long")
    found = graph.apart_pairs(placed, sketches, spark.createDataFrame(parts, "id long, component long"), 1, 0.8)
    pairs = [tuple(r) for r in found.collect()]
    similar = {
        (a, b) for a in sets for b in sets
        if a < b and part.get(a, a) != part.get(b, b) and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8
    }
    assert similar and similar <= set(pairs)
    assert len(pairs) == len(set(pairs)) and all(a < b and part.get(a, a) != part.get(b, b) for a, b in pairs)


def test_short_lines_with_edits_at_an_end(spark):
    pairs = [("copyright 2020", "copyright 2021"), ("chapter 1", "chapter 12"), ("introduction", "introduction:"),
             ("advertisement", "advertisements"), ("read more below", "read more below!"), ("all rights reserved", "all rights reserved.")]
    rows = list(enumerate(line for pair in pairs for line in pair))
    expected = lines_brute_force(rows)
    assert sum(expected.values()) == len(pairs)
    assert kept_lines(spark, rows) == expected


def test_lines_without_spaces(spark):
    rng = random.Random(12)
    letters = string.ascii_lowercase + string.digits
    rows = []
    for alphabet, start in ((letters, ""), (letters, "https://www."), ("กขคงจฉชซฌญฎฏฐฑฒณดตถทธนบปผฝพฟภมยรลวศษสหฬอฮ", "")):
        for _ in range(8):
            line = start + "".join(rng.choices(alphabet, k=rng.randint(42, 90)))
            rows += [(len(rows), line), (len(rows) + 1, "#" + line[1:]), (len(rows) + 2, line[:30] + "#" + line[31:])]
    words = prose(rng, 14)
    blob = "".join(rng.choices(letters, k=400))
    rows += [(900, " ".join([*words, blob])), (901, " ".join([*words[:13], "other", blob[:-4]]))]
    assert kept_lines(spark, rows) == lines_brute_force(rows)


def test_all_documents_of_one_bucket_meet(spark, monkeypatch):
    def one_bucket(batches):
        for batch in whole(batches):
            yield batch.assign(sketches=[np.array([1])] * len(batch))

    whole = order_minhash._sketch_batches
    monkeypatch.setattr(order_minhash, "_sketch_batches", one_bucket)
    rng = random.Random(15)
    rows = []
    for _ in range(12):
        base = prose(rng, rng.randint(80, 160))
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(changed(rng, base, 1)))]
    assert len(set(near_brute_force(rows).values())) < len(rows)
    found = order_minhash.near_duplicate_classes(frame(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in found} == near_brute_force(rows)


def test_leaks_with_insertions_and_cut_ends(spark):
    rng = random.Random(16)
    items = [(i, " ".join(prose(rng, 104))) for i in range(6)]
    docs = []
    for item_id, text in items:
        words = text.split()
        cut, new = 2 + item_id % 2, 5 + item_id % 3
        words = words[cut:52] + prose(rng, new) + words[52:-cut]
        docs.append((len(docs), " ".join(prose(rng, 30) + words + prose(rng, 30))))
        docs.append((len(docs), " ".join(words)))
    expected = leaks_brute_force(docs, items)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(frame(spark, docs), benchmark).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in found}
    assert len(expected) >= len(items) and expected.keys() <= got.keys()
    assert all(got[k] >= expected[k] - 1e-9 for k in expected)


def test_bucket_sizes_are_counted_without_a_window(spark):
    rows = [(i, f"https://www.example.org/the/same/long/path/{i}") for i in range(5)]
    shared = line_dedup.shared_bands(line_dedup.document_lines(frame(spark, rows)))
    sizes = {r.bucket: r.n for r in shared.collect()}
    assert sizes and all(shared.where(F.col("bucket") == b).count() == n for b, n in list(sizes.items())[:2])
    with open(line_dedup.__file__) as file:
        assert "Window" not in file.read()


def test_lines_are_split_once(spark):
    """A filter on the size of an exploded array would make the array a second time."""
    docs = frame(spark, [(1, "one line of text\nanother line")])
    lines = line_dedup.document_lines(docs)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("lower(") == 1
    plan = line_dedup.bitmaps(lines.selectExpr("line_id AS id", "line"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("encode(") == 1


def test_bands_hold_the_smallest_hashes_of_each_class(spark):
    rng = random.Random(21)
    texts = [" ".join(prose(rng, rng.randint(1, 40))) for _ in range(30)] + ["ab", "x" * 90, "y " * 20]
    lines = line_dedup.document_lines(frame(spark, list(enumerate(texts))))
    words = F.split("line", " ")
    hashes = lines.select("line_id", line_dedup.word_runs(words).alias("h")).collect()
    close = lines.select("line_id", F.transform(line_dedup.shingles(F.col("line")), lambda s: F.xxhash64(s)).alias("h")).collect()
    hashes, close = ({r.line_id: sorted(r.h) for r in rows} for rows in (hashes, close))
    found = line_dedup.described(lines).select(
        "line_id", F.col("runs").isNotNull().alias("worded"), F.col("close").isNotNull().alias("few"),
        line_dedup.band_keys(F.struct("runs", "close")).alias("keys"),
    ).collect()
    keys = {}
    for r in found:
        expected = []
        for kind, (used, of) in enumerate(((r.worded, hashes), (r.few, close))):
            classes = [[h for h in of[r.line_id] if h % line_dedup.BANDS == b][: line_dedup.ROWS] for b in range(line_dedup.BANDS)]
            expected += [(kind, b, tuple(c)) for b, c in enumerate(classes) if c and used]
        got = [k for k in r["keys"] if k is not None]
        assert len(set(got)) == len(got) == len(expected) > 0
        order = [(k, (b + line_dedup.BANDS // 2) % line_dedup.BANDS, c) for k, b, c in expected]
        for key, band in zip(got, [x for _, x in sorted(zip(order, expected))]):
            assert keys.setdefault(key, band) == band
    assert len(set(keys.values())) == len(keys)


def test_the_bound_leaves_out_unlike_pairs_and_no_similar_one(spark):
    rng = random.Random(22)
    base = [" ".join(prose(rng, rng.randint(3, 60))) for _ in range(12)]
    texts = base + [t[: rng.randint(1, len(t))] for t in base] + [t + "s" for t in base] + ["abab" * 30, "abab" * 9]
    texts = spark.createDataFrame(list(enumerate(texts)), "id long, line string")
    ids = texts.select("id")
    pairs = ids.selectExpr("id AS a").crossJoin(ids.selectExpr("id AS b")).where("a < b")
    sketches = line_dedup.bitmaps(texts)
    near = {tuple(r) for r in graph.near_pairs(pairs, sketches, line_dedup.BITMAP, 0.8).collect()}
    similar = {tuple(r) for r in line_dedup.similar_pairs(texts, pairs).collect()}
    lines = {r.id: line_sets(r.line) for r in texts.collect()}
    assert similar == {
        (a, b) for a in lines for b in lines if a < b and len(lines[a] & lines[b]) / len(lines[a] | lines[b]) >= 0.8
    }
    assert similar and similar <= near and len(near) < 3 * len(similar)


def test_members_of_several_large_buckets_are_joined_once(spark, monkeypatch):
    monkeypatch.setattr(graph, "MANY", 3)
    placed = [(i, b) for i in range(6) for b in (1, 2, 3)] + [(i, 4) for i in (0, 1, 7, 8)] + [(7, 5), (8, 5), (0, 5)]
    placed = spark.createDataFrame(placed, "id long, bucket long")
    sketches = spark.createDataFrame([(i, 9, 0) for i in range(9)], "id long, size long, x0 long")
    parts = spark.createDataFrame([(0, 0), (2, 0)], "id long, component long")
    found = graph.apart_pairs(placed, sketches, parts, 1, 0.8)
    expected = {(a, b) for a in range(6) for b in range(a + 1, 6)} - {(0, 2)}
    expected |= {(0, 7), (0, 8), (1, 7), (1, 8), (7, 8)}
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    joined = found._jdf.queryExecution().logical().children().head()
    joined = spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, joined)
    assert joined.count() == len(expected) + 3  # 0, 7 and 8 meet in a small bucket, too
