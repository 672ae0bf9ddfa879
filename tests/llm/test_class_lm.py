import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import catalog, class_lm

SCHEMA = "doc_id long, text string, score double, word string, row int"


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w.encode() for w in re.findall(r"[^\x20\x09-\x0D]+", lowered)] + [b""]


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def brute_force(rows, model):
    """Token by token from all counts; the model gives only its classes and transitions."""
    lex, counts = model.lex, Counter(t for i, text in rows if not held(i) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    assert (lex.tokens, lex.distinct) == (total, distinct)
    own = {w: i + 1 for i, w in enumerate(lex.words[: lex.own])}

    def class_of(word):
        return 0 if not word else int(model.classes[own.get(word, 1 + lex.own + class_lm.form(word))])

    sizes, words = Counter(), Counter()
    for word, c in counts.items():
        sizes[class_of(word)] += c
        words[class_of(word)] += bool(word)
    out = []
    for i, text in rows:
        base = score = 0.0
        before = 0
        for t in tokens(text):
            c, here = counts[t], class_of(t)
            base += math.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
            inside = c if not t else c - lex.discount if c else lex.discount * words[here]
            score += model.transition[before, here]
            score += math.log10(inside / sizes[here]) if inside and sizes[here] else 0.0
            before = here
        out.append((i, held(i), len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), total, base, score))
    return out


def compared(spark, rows):
    table = spark.createDataFrame([(i, t, 0.5, "w", 3) for i, t in rows], SCHEMA).repartition(3)
    model = class_lm.train(table, 8)
    got = sorted(map(tuple, class_lm.score_documents(table, model).collect()), key=repr)
    want = sorted(brute_force(rows, model), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    key = lambda r: (repr(r[0]), r[2], r[5])
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9)
        assert g[6] == pytest.approx(w[6], rel=1e-9, abs=1e-9)
    return model


def texts(spark, sf_dir):
    return [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


@pytest.mark.parametrize("known", [1e-6, 2e-3])
def test_scores_equal_brute_force(spark, sf_dir, monkeypatch, known):
    """With ``known`` high, most words are looked up in the table of counts."""
    monkeypatch.setattr(class_lm, "KNOWN", known)
    monkeypatch.setattr(class_lm, "OWN", max(known, 1e-3))
    compared(spark, texts(spark, sf_dir))


def test_query_and_held_out_perplexity(spark, sf_dir):
    out = catalog.QUERIES["op11_class_lm"](spark, sf_dir).cache()
    rows = texts(spark, sf_dir)
    counts = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (distinct + 1))) for t in tokens(text))
        r = got[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held(i), len(tokens(text)), total)
        assert r.n_known == sum(counts[t] > 0 for t in tokens(text))
        assert r.base_score == pytest.approx(base, rel=1e-9)
    measured = {r.held_out: r for r in class_lm.perplexities(out).collect()}
    assert measured[True].perplexity < 0.6 * measured[True].base_perplexity
    assert measured[False].perplexity < measured[False].base_perplexity


def test_probabilities_add_up_to_one_after_any_word(spark, sf_dir):
    model = compared(spark, texts(spark, sf_dir)[:60])
    counts = {bytes(r.word): r.c for r in model.counts.collect()}
    lex = model.lex
    own = {w: i + 1 for i, w in enumerate(lex.words[: lex.own])}
    mass = 10.0 ** model.unknown * (model.unknown > 0)
    mass = np.where(np.bincount(model.classes, minlength=8) > 0, mass, 0.0)
    for word, c in counts.items():
        at = 0 if not word else model.classes[own.get(word, 1 + lex.own + class_lm.form(word))]
        mass[at] += c - lex.discount if word else c
    inside = mass / 10.0**model.class_size
    assert inside[mass > 0] == pytest.approx(1.0)
    assert (10.0**model.transition).sum(1) == pytest.approx(1.0)


def test_exchange_raises_the_likelihood_and_finds_the_classes(spark):
    """Nouns follow articles and verbs follow nouns: three classes and the end's."""
    rng = np.random.default_rng(0)
    kinds = [[f"{k}{i}" for i in range(12)] for k in ("art", "noun", "verb")]
    rows = [(i, " ".join(rng.choice(k) for _ in range(20) for k in kinds)) for i in range(120)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    lex = class_lm.lexicon(class_lm.word_counts(table))
    neighbours = class_lm.neighbours(table, lex)
    start = np.r_[0, 1 + np.arange(lex.own) % 3, 1 + np.arange(class_lm.FORMS) % 3]
    before = class_lm.likelihood(class_lm.class_bigrams(neighbours, start, 4))
    classes, bigrams = class_lm.exchange(neighbours, lex, 4)
    assert class_lm.likelihood(bigrams) > before
    found = {}
    for word, at in zip(lex.words, classes[1:]):
        found.setdefault(re.sub(rb"\d", b"", word), set()).add(int(at))
    assert sorted(map(len, found.values())) == [1, 1, 1] and len(set.union(*found.values())) == 3


def test_best_class_equals_the_likelihood_of_each_move():
    rng = np.random.default_rng(2)
    words, size = 30, 5
    pairs = rng.integers(0, 6, (words, words)).astype(float)
    np.fill_diagonal(pairs, 0)
    classes = rng.integers(1, size, words)
    one = np.eye(size)[classes]
    bigrams = one.T @ pairs @ one
    best, gain = class_lm.best_classes(pairs @ one, pairs.T @ one, classes, bigrams)
    exact = []
    for w in range(words):
        values = []
        for b in range(1, size):
            moved = one.copy()
            moved[w] = np.eye(size)[b]
            values.append(class_lm.likelihood(moved.T @ pairs @ moved))
        exact.append(values)
    exact = np.array(exact)
    # Cells that a move changes twice are counted once each, so close moves may be swapped.
    stay = exact[np.arange(words), classes - 1]
    assert (exact[np.arange(words), best - 1] - stay >= 0.5 * (exact.max(1) - stay) - 1.0).mean() > 0.9


def test_nulls_ties_repeats_and_long_texts(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "PIECE", 1000)
    rows = [(None, "a B a"), (1, None), (2, ""), (3, " \t\n"), (4, "x" * 5000 + " y"), (5, "é É z")]
    rows += [(6, "a b " * 3000), (6, "a b " * 3000), (7, "A\x0bb\x0cC"), (8, "a b c")] * 2
    compared(spark, rows)


def test_empty_and_all_held_out_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert class_lm.score_documents(empty, class_lm.train(empty)).count() == 0
    ids = [i for i in range(200) if held(i)][:3]
    table = spark.createDataFrame([(i, "a b", 0.0, "", 0) for i in ids], SCHEMA)
    out = class_lm.score_documents(table, class_lm.train(table)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.held_out) for r in out] == [(3, 0, 0, True)] * 3
    assert all(r.base_score == pytest.approx(0.0) and math.isfinite(r.score) for r in out)


def test_forms_agree_between_tasks_and_columns(spark):
    words = [b"a", b"ab", b"abc", b"abcd", "höß".encode(), b"x" * 100]
    table = spark.createDataFrame([(bytearray(w),) for w in words], "word binary")
    got = {bytes(r.word): r.f for r in table.select("word", class_lm._form_column(F.col("word")).alias("f")).collect()}
    assert got == {w: class_lm.form(w) for w in words}
