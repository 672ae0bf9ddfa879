"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the model has a white-space mark after another character, so no piece
crosses into the next marked word: a text is the sequence of its chunks (some marks,
then other characters), and each chunk has the same ids wherever it stands.

Documents are dealt out to blocks.  A block lists its distinct chunks by hash bucket; a
bucket segments each chunk that any block listed once; the block then joins the ids back
by position.  What travels besides the texts is one packed list for a block and bucket.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_CHARS = 30_000_000
#: Documents whose ids are gathered at once.
_BATCH = 512
_MARK = "▁"
_CHUNK = re.compile(r" +[^ ]*")


@lru_cache(maxsize=2)
def processor(model: str) -> sentencepiece.SentencePieceProcessor:
    """The loaded model; refused if a piece could cross a white-space mark."""
    loaded = sentencepiece.SentencePieceProcessor(model_file=model)
    for i in range(loaded.get_piece_size()):
        if _MARK in loaded.id_to_piece(i).lstrip(_MARK):
            raise ValueError(f"piece {i} of {model} crosses a white-space mark")
    if loaded.encode("a  b ") != loaded.encode("a") + loaded.encode(" b") + _after_a(loaded):
        raise ValueError(f"{model} does not keep white space as it is")
    return loaded


def _after_a(loaded: sentencepiece.SentencePieceProcessor) -> list[int]:
    """Ids of a lone mark, which no text on its own has."""
    return loaded.encode("a ")[len(loaded.encode("a")) :]


def chunks(text: str | None) -> list[str]:
    """The chunks of a text in order, each without its first mark; marks are spaces."""
    if not text:
        return []
    marked = " " + (text.replace(_MARK, " ") if _MARK in text else text)
    if "  " in marked:
        return [c[1:] for c in _CHUNK.findall(marked)]
    return marked.split(" ")[1:]


def segmented(keys: list[str], model: str) -> list[list[int]]:
    """The ids of each chunk."""
    loaded = processor(model)
    ids = loaded.encode(keys, num_threads=1)
    return [_after_a(loaded) if key == "" else found for key, found in zip(keys, ids)]


def _pack(keys: list[str]) -> bytes:
    return zlib.compress(_MARK.join(keys).encode("utf-8", "surrogatepass"))


def _unpack(packed: bytes) -> list[str]:
    return zlib.decompress(packed).decode("utf-8", "surrogatepass").split(_MARK)


def _by_bucket(found: set[str], buckets: int) -> dict[int, list[str]]:
    """Chunks by hash bucket, each list in order, so that it need not travel back."""
    parts: dict[int, list[str]] = {}
    for key in sorted(found):
        bucket = zlib.crc32(key.encode("utf-8", "surrogatepass")) % buckets
        parts.setdefault(bucket, []).append(key)
    return parts


def _requests(batches: Iterator[pd.DataFrame], buckets: int) -> Iterator[pd.DataFrame]:
    """``(block, bucket, chunks)``: a block's distinct chunks, packed by bucket."""
    pending: dict[int, set[str]] = {}
    for batch in batches:
        for block, text in zip(batch["block"].to_numpy(), batch["text"]):
            pending.setdefault(int(block), set()).update(chunks(text))
    for block, found in pending.items():
        rows = [(block, b, _pack(keys)) for b, keys in _by_bucket(found, buckets).items()]
        if rows:
            yield pd.DataFrame(rows, columns=["block", "bucket", "chunks"])


def _answers(batches: Iterator[pd.DataFrame], model: str) -> Iterator[pd.DataFrame]:
    """Requests in bucket order become ``(block, bucket, ids)``; a bucket's table is kept
    while its requests pass, so each of its chunks is segmented once."""
    table: dict[str, bytes] = {}
    current = None
    for batch in batches:
        out = []
        for block, bucket, packed in zip(batch["block"], batch["bucket"], batch["chunks"]):
            if bucket != current:
                current, table = bucket, {}
            keys = _unpack(packed)
            fresh = [k for k in keys if k not in table]
            for key, ids in zip(fresh, segmented(fresh, model)):
                table[key] = np.array(ids, "<u4").tobytes()
            found = [table[k] for k in keys]
            sizes = np.array([len(f) // 4 for f in found], "<u4").tobytes()
            # Byte planes: the high bytes are alike and pack to almost nothing.
            planes = np.frombuffer(sizes + b"".join(found), np.uint8).reshape(-1, 4).T.tobytes()
            out.append((block, bucket, zlib.compress(planes, 9)))
        yield pd.DataFrame(out, columns=["block", "bucket", "ids"])


def _ids_by_chunk(keys: list[str], packed: bytes) -> Iterator[tuple[str, np.ndarray]]:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    flat = np.ascontiguousarray(planes.T).view("<u4").ravel()
    start = len(keys)
    for key, size in zip(keys, flat[:start].tolist()):
        yield key, flat[start : start + size]
        start += size


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, codes: np.ndarray):
    """The runs ``flat[starts[c]:starts[c] + sizes[c]]`` of ``codes`` back to back, and their ends."""
    n = sizes[codes]
    ends = np.cumsum(n)
    if not len(n) or not ends[-1]:
        return flat[:0], ends
    shift = np.repeat(starts[codes] - (ends - n), n)
    return flat[np.arange(ends[-1], dtype=np.int64) + shift], ends


def _joined(
    docs: pd.DataFrame, answers: pd.DataFrame, model: str, buckets: int, text_column: bool
) -> pd.DataFrame:
    """Ids of each document of a block, by the position of its chunks."""
    found: set[str] = set()
    for text in docs["text"]:
        found.update(chunks(text))
    asked = _by_bucket(found, buckets)
    keys: list[str] = []
    ids_of: list[np.ndarray] = []
    for bucket, answer in zip(answers["bucket"], answers["ids"]):
        for key, ids in _ids_by_chunk(asked[bucket], answer):
            keys.append(key)
            ids_of.append(ids)
    # Each chunk's ids, and their decimal texts each followed by a comma, back to back.
    id_sizes = np.array([len(ids) for ids in ids_of], np.int64)
    flat_ids = np.concatenate(ids_of) if ids_of else np.zeros(0, "<u4")
    texts = ["".join(f"{i}," for i in ids.tolist()).encode() for ids in ids_of]
    text_sizes = np.array([len(t) for t in texts], np.int64)
    flat_text = np.frombuffer(b"".join(texts), np.uint8)
    del texts, ids_of, found, asked
    id_starts, text_starts = np.cumsum(id_sizes) - id_sizes, np.cumsum(text_sizes) - text_sizes
    index = pd.Index(keys, dtype=object)
    loaded = processor(model)
    out = []
    all_texts = docs["text"]
    for first in range(0, len(all_texts), _BATCH):
        # Chunks are found again a batch at a time, so that a block's are never all held.
        batch = [chunks(text) for text in all_texts.iloc[first : first + _BATCH]]
        codes = index.get_indexer(pd.Index([c for each in batch for c in each], dtype=object))
        ids, id_ends = _gathered(flat_ids, id_starts, id_sizes, codes)
        listed, text_ends = _gathered(flat_text, text_starts, text_sizes, codes)
        bounds = np.concatenate([[0], np.cumsum([len(each) for each in batch])])
        id_at = np.concatenate([[0], id_ends])[bounds].tolist()
        text_at = np.concatenate([[0], text_ends])[bounds].tolist()
        for i in range(len(batch)):
            own = ids[id_at[i] : id_at[i + 1]]
            # Without the comma after the last id.
            digits = listed[text_at[i] : max(text_at[i], text_at[i + 1] - 1)].tobytes()
            decoded = loaded.decode(own.tolist()) if len(own) else ""
            raw = decoded.encode("utf-8", "surrogatepass")
            row = (len(own), hashlib.sha256(digits).hexdigest(), hashlib.sha256(raw).hexdigest())
            out.append((*row, decoded) if text_column else row)
    columns = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["decoded"] * text_column
    result = pd.DataFrame(out, columns=columns, index=docs.index)
    kept = docs.drop(columns=["block", "text"])
    return pd.concat([kept, result], axis=1)


def encoded(
    docs: DataFrame, model: str, columns: list[str] | None = None, decoded: bool = False
) -> DataFrame:
    """``columns`` of ``docs`` and ``n_tokens, ids_sha256, decoded_sha256`` of each text.

    With ``decoded`` also the decoded text.  Texts are encoded whole, exactly as the
    library does without begin and end ids, and decoded from all their ids.  Null and
    empty texts have no ids.  Every row gives a row, repeated ones and null keys
    included; an empty table gives none.  ``columns`` (doc_id by default) must not
    have the names of the results, ``text`` or ``block``.
    """
    columns = ["doc_id"] if columns is None else columns
    chars = docs.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // BLOCK_CHARS))
    block = F.pmod(F.xxhash64("text", *columns), F.lit(blocks)).cast("int").alias("block")
    dealt = docs.select(*columns, "text", block).repartition(blocks, "block")
    requests = dealt.mapInPandas(
        lambda batches: _requests(batches, blocks), "block int, bucket int, chunks binary"
    )
    answers = (
        requests.repartition(blocks, "bucket")
        .sortWithinPartitions("bucket")
        .mapInPandas(lambda batches: _answers(batches, model), "block int, bucket int, ids binary")
    )
    schema = ", ".join(
        [
            *(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*columns).schema),
            "n_tokens long, ids_sha256 string, decoded_sha256 string",
            *["decoded string"] * decoded,
        ]
    )
    return (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInPandas(lambda left, right: _joined(left, right, model, blocks, decoded), schema)
    )
