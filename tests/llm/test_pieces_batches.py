import hashlib

import public_tokenizers
import sentencepiece

from tidemark.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PIECES = sentencepiece.SentencePieceProcessor(model_file=MODEL)
TEXTS = [None, "", "a  b ", "  ", "é x▁y  ▁▁z 😀", " lead", "tab\tnew\nline  ", "a a a", "b"]


def test_ids_are_gathered_by_chunk_across_batches(spark, monkeypatch):
    monkeypatch.setattr(pieces, "_BATCH", 2)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    found = {r.doc_id: r for r in pieces.encoded(docs, MODEL, decoded=True).collect()}
    for doc_id, text in enumerate(TEXTS):
        ids = PIECES.encode(text or "")
        digits = ",".join(map(str, ids)).encode()
        assert found[doc_id].n_tokens == len(ids)
        assert found[doc_id].ids_sha256 == hashlib.sha256(digits).hexdigest()
        assert found[doc_id].decoded == PIECES.decode(ids)


def test_gathered_runs():
    import numpy as np

    flat = np.arange(10)
    runs, ends = pieces._gathered(flat, np.array([0, 3, 7]), np.array([3, 0, 3]), np.array([2, 1, 0, 2]))
    assert runs.tolist() == [7, 8, 9, 0, 1, 2, 7, 8, 9]
    assert ends.tolist() == [3, 3, 6, 9]
