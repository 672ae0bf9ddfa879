import hashlib
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidemark.llm import pieces, records, token_counts
from tidemark.llm.byte_bpe import encoder

BPE = public_tokenizers.path("byte_bpe_50k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(BPE)
PIECES = sentencepiece.SentencePieceProcessor(model_file=MODEL)
DOCS = "doc_id long, text string, n_tokens long, start string, file int"
TEXTS = st.lists(
    st.sampled_from(
        ["a", "the", " ", "  ", "\n", "\t", "'s", "1²", "日本", "é", " ", "▁", "<|endoftext|>", "!", "\r\n", "\x1c"]
    ),
    max_size=14,
).map("".join)
ROWS = [
    (3, "one two  three\n\nfour", 1, "x", 0),
    (1, "", 1, "x", 0),
    (2, None, 1, "x", 0),
    (1, " lead and trail ", 1, "x", 0),
    (None, "no id", 1, "x", 0),
    (3, "one two  three\n\nfour", 1, "x", 0),
    (9, "lang " * 30_000, 1, "x", 0),
]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_byte_bpe_equals_the_library(text):
    assert np.frombuffer(encoder(BPE).packed(text), "<u4").tolist() == library_ids(text)


@pytest.mark.parametrize(
    "text", ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> ", "x<|endoftext|", "\n<|endoftext|>\n  y"]
)
def test_special_tokens_equal_the_library(text):
    found = np.frombuffer(encoder(BPE).packed(text), "<u4").tolist()
    assert found == library_ids(text)
    assert (50256 in found) == ("<|endoftext|>" in text)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_chunks_equal_the_library(text):
    ids = [i for found in pieces.segmented(pieces.chunks(text), MODEL) for i in found]
    assert ids == PIECES.encode(text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_sentencepiece_rows(spark, monkeypatch):
    monkeypatch.setattr(pieces, "BLOCK_CHARS", 40_000)
    found = pieces.encoded(spark.createDataFrame(ROWS, DOCS), MODEL, decoded=True).collect()
    expected = []
    for doc_id, text, *_ in ROWS:
        ids = PIECES.encode(text or "")
        decoded = PIECES.decode(ids) if ids else ""
        expected.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(decoded), decoded))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert pieces.encoded(spark.createDataFrame([], DOCS), MODEL).count() == 0


def test_length_table_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "RANGE", 4)
    docs = spark.createDataFrame(ROWS, DOCS)
    lengths = [len(library_ids(r[1])) for r in ROWS]
    counted = token_counts.histogram(token_counts.document_lengths(docs, BPE))
    table = token_counts.length_table(counted)
    for row in table.collect():
        n = row.n_tokens
        assert row.docs == lengths.count(n)
        assert row.docs_at_least == sum(x >= n for x in lengths)
        assert row.tokens_at_least == sum(x for x in lengths if x >= n)
        assert row.cut_docs == sum(x > n for x in lengths)
        assert row.truncated_total == sum(min(x, n) for x in lengths)
        assert row.share_at_most == pytest.approx(sum(x <= n for x in lengths) / len(lengths))
    answers = {r.context: r for r in token_counts.limits(table, [0, 3, 10**6]).collect()}
    for context, row in answers.items():
        assert row.docs_fitting == sum(x <= context for x in lengths)
        assert row.truncated_total == sum(min(x, context) for x in lengths)
    picked = {r.share: r.n_tokens for r in token_counts.quantiles(table, [0.5, 1.0]).collect()}
    assert picked == {0.5: sorted(lengths)[3], 1.0: max(lengths)}
    empty = token_counts.length_table(counted.limit(0))
    assert empty.count() == 0


def test_records_round_trip(spark, monkeypatch):
    monkeypatch.setattr(records, "DOCS_PER_FILE_CHARS", 50_000)
    written = records.write_records(spark.createDataFrame(ROWS, DOCS), BPE, end_id=2)
    found = sorted(map(tuple, written.digests().collect()), key=lambda r: r[1])
    expected, start = [], 0
    for doc_id, text, *_ in sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*library_ids(text), 2], "<u4")
        expected.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert found == expected


def test_records_of_an_empty_table(spark):
    written = records.write_records(spark.createDataFrame([], DOCS), BPE, end_id=2)
    assert written.index.count() == 0 and written.digests().count() == 0


def test_damage_is_noticed():
    record = records.framed(b"payload")
    assert records.unframed(record) == b"payload"
    assert struct.unpack_from("<Q", record)[0] == 7
    for i in range(len(record)):
        damaged = bytearray(record)
        damaged[i] ^= 1
        with pytest.raises(records.CorruptRecord):
            records.unframed(bytes(damaged))
    with pytest.raises(records.CorruptRecord):
        records.unframed(record[:-1])
