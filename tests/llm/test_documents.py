import random
import time

import numpy as np
import pytest

from tidemark.llm import decontaminate, graph, licences, line_dedup, order_minhash, storage
from tidemark.sources.paths import exists

DOCS = "doc_id long, text string, hashes string, class_id int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in rows], DOCS)


def groups(links, ids):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def prose(rng, n):
    return [rng.choice("abcdefghij") + rng.choice("klmnop") * rng.randint(1, 9) + str(rng.randint(0, 60)) for _ in range(n)]


def changed(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        out[rng.randrange(len(out))] = "new" + str(rng.randint(0, 10**6))
    return out


# components


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 560)]
    some = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)]
    links = chain + star + some + [(7, 7), (None, 3)]
    found = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert dict(map(tuple, found)) == groups(real, {x for pair in real for x in pair})
    assert len(found) == len({r.id for r in found})
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# near duplicates


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@pytest.mark.parametrize("seed", range(40))
def test_banded_alignment_equals_full_alignment(seed):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 6, rng.integers(1, 30))
    b = a.copy()
    for _ in range(rng.integers(0, 8)):
        at = rng.integers(0, len(b) + 1)
        b = np.insert(b, at, rng.integers(0, 6)) if rng.random() < 0.5 else np.delete(b, min(at, len(b) - 1))
        if not len(b):
            b = np.array([1])
    best = lcs(a.tolist(), b.tolist())
    for needed in range(1, min(len(a), len(b)) + 2):
        assert order_minhash.matched_in_order(a, b, needed) == (best >= needed)
    same = order_minhash.similar(a.astype(np.uint64), b.astype(np.uint64))
    assert same == (best / (len(a) + len(b) - best) >= 0.8 - 1e-12)


def shingled(text):
    words = (text or "").lower().split()
    width = min(5, len(words))
    return [tuple(words[i : i + width]) for i in range(len(words) - width + 1)] if words else []


def near_brute_force(rows):
    by_id = {}
    links = []
    for i, (a, x) in enumerate(rows):
        by_id[a] = a
        for b, y in rows[i + 1 :]:
            p, q = shingled(x), shingled(y)
            best = lcs(p, q)
            if (x or "") == (y or "") or p and q and best / (len(p) + len(q) - best) >= 0.8:
                links.append((a, b))
    return groups(links, by_id)


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(14):
        base = prose(rng, rng.randint(1, 220))
        for _ in range(rng.randint(1, 4)):
            rows.append((len(rows), " ".join(changed(rng, base, rng.randint(0, max(1, len(base) // 60))))))
    rows += [(900, rows[0][1]), (901, rows[0][1].upper()), (902, None), (903, ""), (904, "  "), (905, "a"), (906, "a"), (907, "a a a a a a a a"), (908, "b c")]
    found = order_minhash.near_duplicate_classes(frame(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in found} == near_brute_force(rows)
    assert len(found) == len(rows) and all(r.kept == (r.doc_id == r.class_id) for r in found)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(1, "same text here"), (1, "same text here"), (None, "same text here"), (2, "same text here")]
    found = order_minhash.near_duplicate_classes(frame(spark, rows)).collect()
    assert sorted(map(tuple, found)) == [(1, 1, True), (2, 1, False)]
    assert order_minhash.near_duplicate_classes(frame(spark, [])).count() == 0


def test_order_matters(spark):
    rng = random.Random(8)
    words = prose(rng, 120)
    turned = words[60:] + words[:60]
    found = order_minhash.near_duplicate_classes(frame(spark, [(1, " ".join(words)), (2, " ".join(turned))]))
    assert {r.class_id for r in found.collect()} == {1, 2}


def test_very_long_texts(spark):
    rng = random.Random(9)
    words = prose(rng, 60_000)
    rows = [(1, " ".join(words)), (2, " ".join(changed(rng, words, 20))), (3, " ".join(prose(rng, 60_000)))]
    found = order_minhash.near_duplicate_classes(frame(spark, rows)).collect()
    assert {r.doc_id: r.class_id for r in found} == {1: 1, 2: 1, 3: 3}


# lines


def line_sets(line):
    return {line} if len(line) < 5 else {line[i : i + 5] for i in range(len(line) - 4)}


def lines_brute_force(rows):
    seen = []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        for no, raw in enumerate((text or "").split("\n")):
            line = raw.strip(" \t\r").lower()
            if line:
                seen.append(((doc_id, no), line))
    links = []
    for i, (a, x) in enumerate(seen):
        for b, y in seen[i + 1 :]:
            p, q = line_sets(x), line_sets(y)
            if len(p & q) / len(p | q) >= 0.8:
                links.append((a, b))
    first = groups(links, [place for place, _ in seen])
    return {place: first[place] == place for place, _ in seen}


def test_lines_equal_brute_force(spark):
    rng = random.Random(6)
    bases = [" ".join(prose(rng, rng.randint(4, 40))) for _ in range(12)]
    rows = []
    for doc_id in range(16):
        lines = []
        for _ in range(4):
            line = rng.choice(bases)
            if rng.random() < 0.4:
                at = rng.randrange(len(line))
                line = line[:at] + "#" + line[at + 1 :]
            lines.append(rng.choice(["", "  "]) + line)
        rows.append((doc_id, "\n".join(lines)))
    rows += [(50, None), (51, ""), (52, "\n \n"), (53, "ab\nAB \ncd"), (54, "日本語の長い文章です。\n日本語の長い文章です。")]
    found = line_dedup.line_decisions(frame(spark, rows)).collect()
    assert {(r.doc_id, r.line_no): r.kept for r in found} == lines_brute_force(rows)


def test_deduplicated_documents(spark):
    rows = [(2, "shared line of text\nonly here"), (1, "first\nshared line of text\n\nend"), (3, "shared line of text"), (4, None), (None, "first"), (5, "first\nshared line of text")]
    found = line_dedup.deduplicated(frame(spark, rows))
    assert found.columns == ["doc_id", "text", "hashes", "class_id"]
    assert {r.doc_id: r.text for r in found.collect()} == {
        1: "first\nshared line of text\n\nend",
        2: "only here",
        3: "",
        4: None,
        None: "first",
        5: "",
    }
    assert line_dedup.deduplicated(frame(spark, [])).count() == 0


# decontamination


def bag(words):
    out = {}
    for i in range(len(words) - 4):
        out[tuple(words[i : i + 5])] = out.get(tuple(words[i : i + 5]), 0) + 1
    return out


def leaks_brute_force(docs, items):
    out = {}
    for item_id, text in items:
        want = bag((text or "").lower().split())
        n = sum(want.values())
        for doc_id, body in docs:
            words = (body or "").lower().split()
            for start in range(max(1, len(words) - 4 - n + 1)):
                have = bag(words[start : start + n + 4])
                total = sum(want.values()) + sum(have.values())
                both = sum(min(c, have.get(s, 0)) for s, c in want.items())
                if want and have and both / (total - both) >= 0.8:
                    out[doc_id, item_id] = max(out.get((doc_id, item_id), 0), both / (total - both))
    return out


def test_leaks_equal_brute_force(spark):
    rng = random.Random(3)
    items = [(i, " ".join(prose(rng, rng.randint(12, 50)))) for i in range(12)]
    items += [(50, "la la la la la la la la la la"), (51, "too few words"), (52, None), (53, "")]
    docs = []
    for doc_id in range(40):
        words = prose(rng, rng.randint(0, 150))
        if doc_id % 2:
            item = rng.choice(items[:13])[1].split()
            item = changed(rng, item, rng.choice([0, 0, 1, 2]))
            at = rng.randint(0, len(words))
            words[at:at] = item
        docs.append((doc_id, " ".join(words)))
    docs += [(100, None), (101, ""), (102, items[0][1].upper().replace(" ", ", "))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(frame(spark, docs), benchmark).collect()
    expected = leaks_brute_force(docs, items)
    got = {(r.doc_id, r.item_id): r.similarity for r in found if r.doc_id != 102}
    assert got.keys() == expected.keys()
    assert all(abs(got[k] - expected[k]) < 1e-9 for k in got)
    assert (102, 0) in {(r.doc_id, r.item_id) for r in found}
    clean = decontaminate.clean_documents(frame(spark, docs), benchmark)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {k[0] for k in expected} - {102}


def test_leaks_with_portions_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", 2)
    items = [(i, " ".join(f"item{i}w{j}" for j in range(20))) for i in range(5)]
    docs = frame(spark, [(i, f"before {t} after") for i, t in items] + [(None, items[0][1])])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id, r.start) for r in found} == {(i, i, 1) for i in range(5)}
    assert decontaminate.contaminated(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.contaminated(docs.limit(0), benchmark).count() == 0


# licences


def test_licences(spark):
    mit = [s for i, s in licences.SENTENCES if i in ("mit-grant", "mit-notice", "mit-warranty", "mit-liability")]
    apache = (
        'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except '
        "in compliance with the License.\nYou may obtain a copy of the License at\n\n"
        "    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in "
        'writing,\nsoftware distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
        "WARRANTIES\nOR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
        "language governing permissions and limitations under the License."
    )
    bsd = [s for i, s in licences.SENTENCES if i in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse")]
    rows = [
        (1, "Some title\nReleased under the MIT License.\nMore."),
        (2, mit[0].replace(" to ", "\nto ") + "\n\n" + " ".join(mit[1:])),
        (3, apache),
        (4, "\n\n".join(bsd)),
        (5, "\n\n".join(bsd[:3])),
        (6, "nothing here"),
        (7, None),
        (8, "All rights reserved."),
        (None, "Released under the MIT License."),
        (9, "LICENSED UNDER CC BY-NC 4.0.  Licensed under the Apache License, Version 2.0."),
        (9, "LICENSED UNDER CC BY-NC 4.0.  Licensed under the Apache License, Version 2.0."),
    ]
    found = {r.doc_id: r for r in licences.licence_scan(frame(spark, rows)).collect()}
    assert {i: r.licences for i, r in found.items()} == {
        1: "MIT",
        2: "MIT",
        3: "Apache-2.0",
        4: "BSD-3-Clause",
        5: "BSD-2-Clause",
        8: "",
        9: "Apache-2.0,CC-BY-NC-4.0",
    }
    assert found[2].identifiers == "mit-grant mit-notice mit-warranty mit-liability"
    assert found[9].identifiers == "cc-by-nc-name apache2-name"
    assert licences.licence_scan(frame(spark, [])).count() == 0


def test_deduplicated_documents_keep_columns_of_any_name(spark):
    schema = "doc_id long, text string, _removed string, lines int, component string, row int"
    rows = [(1, "a line of text here\nother", "r", 1, "c", 2), (2, "a line of text here\nnew", None, None, None, None)]
    found = line_dedup.deduplicated(spark.createDataFrame(rows, schema))
    assert found.columns == ["doc_id", "text", "_removed", "lines", "component", "row"]
    assert sorted(map(tuple, found.collect())) == [rows[0], (2, "new", None, None, None, None)]


def test_intermediates_are_deleted_and_results_stay(spark, tmp_path):
    with storage.Intermediates() as outer:
        with storage.Intermediates() as inner:
            first = storage.Written(spark.range(3), "first")
            found = inner.result(first.df.where("id > 0"), "second")
        assert not exists(spark, first.path) and found.count() == 2
        last = outer.result(found.selectExpr("id + 1 AS id"), "third")
    with pytest.raises(Exception, match="not exist|No such file|FILE_NOT_EXIST"):
        found.count()
    assert sorted(r.id for r in last.collect()) == [2, 3]
    with pytest.raises(ValueError), storage.Intermediates():
        lost = storage.Written(spark.range(1), "lost")
        raise ValueError
    assert not exists(spark, lost.path)


def test_shuffle_files_go_once_a_frame_is_written(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffled()
    written = storage.Written(spark.range(1000).repartition(3).groupBy("id").count(), "counts")
    end = time.monotonic() + 20
    while shuffled() - before and time.monotonic() < end:
        time.sleep(0.2)
    assert not shuffled() - before and written.df.count() == 1000
    assert spark.conf.get(storage.CLEANUP) == "false"
    written.drop()


def test_the_hamming_index_selects(spark):
    """Of all windows and items of one size few come together, and none of other sizes."""
    rng = np.random.default_rng(4)
    words = [" ".join(f"w{rng.integers(3000)}" for _ in range(n)) for n in (40, 60, 80) for _ in range(20)]
    items = spark.createDataFrame(list(enumerate(words)), "item_id long, text string")
    hashed = decontaminate._hashed(items, "item_id")
    windows = hashed.selectExpr("item_id AS doc_id", "0 AS start", "size(hashes) AS size", "hashes")
    near = decontaminate._candidates(decontaminate.with_fingerprints(windows), hashed).distinct()
    pairs = {(r.doc_id, r.item_id) for r in near.select("doc_id", "item_id").collect()}
    assert {(i, i) for i in range(60)} <= pairs
    assert all(a // 20 == b // 20 for a, b in pairs)
    assert len(pairs) < 0.25 * 60 * 60


def test_near_duplicates_within_large_buckets(spark, monkeypatch):
    """Families around one template: most members are unlike it, some pairs are alike."""
    monkeypatch.setattr(order_minhash, "CHUNK", 1100)  # shingles of about eight of the texts
    rng = np.random.default_rng(11)
    template = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(40):
        own = [f"o{i}x{k}" for k in range(22)]
        rows.append((2 * i, " ".join(template + own)))
        rows.append((2 * i + 1, " ".join(template + own[:-1] + [f"e{i}"])))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(int(i), str(t)) for i, t in rows], "doc_id long, text string").repartition(4)
    found = {r.doc_id: r.class_id for r in order_minhash.near_duplicate_classes(docs).collect()}
    sequences = {int(i): order_minhash.shingle_hashes(str(t)) for i, t in rows}
    expected = {i: i for i in sequences}
    for a in sequences:
        for b in sequences:
            if a < b and order_minhash.similar(sequences[a], sequences[b]):
                low, high = sorted((expected[a], expected[b]))
                expected = {k: low if v == high else v for k, v in expected.items()}
    assert 1 < len(set(expected.values())) < 80
    assert found == expected


def test_links_of_a_document_with_two_texts(spark):
    words = [f"w{i}" for i in range(60)]
    first, second = " ".join(words), " ".join(f"v{i}" for i in range(60))
    rows = [(1, first), (1, second), (2, second + " more"), (3, first + " less"), (3, first + " less")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in order_minhash.near_duplicate_classes(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 1}
