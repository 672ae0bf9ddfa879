import random
import zlib

import numpy as np

from tidemark.llm import toxicity

DOCS = "doc_id long, text string, lang string, score double"
LABELS = "doc_id long, quality int, toxic int"
PLAIN = [f"word{i}" for i in range(60)]


def corpus(n=1200, seed=3):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(PLAIN) for _ in range(rng.randint(3, 40))]
        toxic = rng.random() < 0.15
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["grobble", "snarkle", "vexnut"]))
        docs.append((i, " ".join(words), "xx", None))
        if rng.random() < 0.6:
            labels.append((i, 1, int(toxic)))
    truth = {d[0]: any(t in d[1] for t in ("grobble", "snarkle", "vexnut")) for d in docs}
    return docs, labels, truth


def test_held_out_accuracy(spark):
    docs, labels, truth = corpus()
    frame = spark.createDataFrame(docs, DOCS)
    model = toxicity.train(frame, spark.createDataFrame(labels, LABELS))
    scored = toxicity.score_documents(frame, model).withColumn("h", toxicity.held_out()).collect()
    assert len(scored) == len(docs)
    held = [r for r in scored if r.h]
    assert held and all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    assert sum((r.predicted == 1) == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scored)


def test_odd_rows(spark):
    docs, labels, _ = corpus(400)
    labels += [(None, 1, 1), (5, None, None), (99_999, 0, 1)]
    model = toxicity.train(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    long_text = " ".join(PLAIN * 3000) + " grobble"
    odd = [(1, None, None, None), (1, "", None, None), (None, "x", None, 2.0), (2, long_text, None, None)]
    rows = toxicity.score_documents(spark.createDataFrame(odd, DOCS), model).collect()
    assert len(rows) == 4
    assert rows[0].score == rows[1].score and rows[0].predicted == 0
    assert rows[3].score > 0.5


def test_empty_tables(spark):
    model = toxicity.train(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS))
    frame = spark.createDataFrame([(1, "a", "en", None)], DOCS)
    assert toxicity.score_documents(frame, model).first().predicted == 0
    assert toxicity.score_documents(frame.limit(0), model).count() == 0


def test_labels_of_held_out_rows_are_never_learned(spark):
    docs, labels, _ = corpus(600)
    flipped = [
        (i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels
    ]
    frame = spark.createDataFrame(docs, DOCS)
    first = toxicity.train(frame, spark.createDataFrame(labels, LABELS))
    second = toxicity.train(frame, spark.createDataFrame(flipped, LABELS))
    assert first.bias == second.bias and (first.weights == second.weights).all()


def test_the_risk_stays_non_negative():
    rng = np.random.default_rng(1)
    rows = [rng.choice(500, 12, replace=False) for _ in range(300)]
    model = toxicity.fit(rows[:40], rows[40:], 0.1, penalty=0.0)
    z = np.array([model.bias + model.weights[r].sum() for r in rows])
    second = np.logaddexp(0, z[40:]).mean() - 0.1 * np.logaddexp(0, z[:40]).mean()
    assert second > -0.05
