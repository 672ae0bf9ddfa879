import hashlib
import random

import public_tokenizers
import sentencepiece
from test_documents import leaks_brute_force, lines_brute_force, near_brute_force, prose
from test_toxicity import corpus

import corpus_pipeline

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
TOXIC = ("grobble", "snarkle", "vexnut")


def tables():
    """Toxic texts to learn from, and documents with planted cases; all with their own words."""
    rng = random.Random(12)
    trained, labels, _ = corpus(500, seed=5)
    docs = [(1000 + i, f"{text}\nend {i}x{i} of {i}y{i}") for i, text, *_ in trained]
    labels = [(1000 + i, q, t) for i, q, t in labels]
    benchmark = [(i, " ".join(prose(rng, 30))) for i in range(3)]
    repeated = " ".join(prose(rng, 55))
    for i in range(24):
        body = [" ".join(prose(rng, rng.randint(20, 60))) for _ in range(3)]
        if i % 4 == 1:
            body.insert(1, repeated)
        if i % 6 == 2:
            body.append(benchmark[i % 3][1])
        docs.append((i, "\n".join(body)))
    docs += [(40, docs[500][1]), (41, docs[503][1].replace(" ", "  ", 1)), (42, None), (43, ""), (44, "")]
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in docs]
    return rows, labels, benchmark


def without_repeated_lines(rows):
    kept = lines_brute_force(rows)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        some = [x for no, x in enumerate(lines) if kept.get((doc_id, no), True)]
        out.append((doc_id, text if len(some) == len(lines) else "\n".join(some)))
    return out


def test_run_equals_brute_force(spark, tmp_path):
    rows, labels, benchmark = tables()
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = [(i, t) for i, t, *_ in rows if not any(w in (t or "") for w in TOXIC)]
    planted = {i for i, _ in docs if i < 1000}
    # The stages look at all documents; only those with planted cases are followed by force.
    small = without_repeated_lines([d for d in docs if d[0] < 1000])
    classes = near_brute_force(small)
    small = [d for d in small if classes[d[0]] == d[0]]
    leaked = {doc_id for doc_id, _ in leaks_brute_force(small, benchmark)}
    small = [d for d in small if d[0] not in leaked]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def digest(text):
        ids = library.encode(text or "")
        decoded = library.decode(ids) if ids else ""
        return (
            len(ids),
            hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )

    found = {r.doc_id: tuple(r)[1:] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {i: d for i, d in found.items() if i in planted} == {i: digest(t) for i, t in small}
    toxic = {i for i, t, *_ in rows if any(w in (t or "") for w in TOXIC)}
    assert len(toxic & set(found)) <= 0.05 * len(toxic)


def test_stages_keep_the_columns_of_documents(spark, tmp_path):
    rows, labels, benchmark = tables()
    spark.createDataFrame(labels[:50], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(benchmark, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    some = spark.createDataFrame([*rows[-8:], (None, "no id", None, None, 5)], DOCUMENTS)
    for docs in (some, some.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == docs.columns and out.count() <= docs.count(), name
    assert len(corpus_pipeline.STAGES) == 5
