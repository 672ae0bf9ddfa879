"""Token ids in length-delimited binary record files with an offset index.

A record is ``length (8 bytes) | masked crc of those 8 bytes (4) | payload | masked crc
of the payload (4)``, little-endian.  The payload is a document's ids as unsigned 16-bit
integers if the vocabulary fits, else as 32-bit ones.  A masked checksum is the CRC-32
rotated right by 15 bits plus a constant, so that a record inside a record stays valid.

Each task writes one file under a name of its own and reports its records; the reports
are the offset index, written by Spark.  A file of a lost or repeated task is in no
index and is never read.  The index gives the place of every record for shuffled reads.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.byte_bpe import encoder
from tidemark.llm.storage import Written
from tidemark.plans.scratch import scratch_dir

#: Fixed values of the record format: bytes around a payload and the checksum mask.
HEADER = 12
FOOTER = 4
MASK = 0xA282EAD8
DOCS_PER_FILE_CHARS = 24_000_000
INDEX = "doc_id long, file string, offset long, size long, n_tokens long, place long"


class CorruptRecord(ValueError):
    """A record whose length or payload does not have its checksum."""


def masked_crc(raw: bytes) -> int:
    crc = zlib.crc32(raw)
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join(
        (length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload)))
    )


def unframed(raw: bytes) -> bytes:
    """The payload of one record; both checksums are verified."""
    if len(raw) < HEADER + FOOTER:
        raise CorruptRecord("a record is cut short")
    (length,) = struct.unpack_from("<Q", raw, 0)
    if masked_crc(raw[:8]) != struct.unpack_from("<I", raw, 8)[0] or length != len(raw) - HEADER - FOOTER:
        raise CorruptRecord("a record has a wrong length")
    payload = raw[HEADER : HEADER + length]
    if masked_crc(payload) != struct.unpack_from("<I", raw, HEADER + length)[0]:
        raise CorruptRecord("a record has a wrong checksum")
    return payload


def _file_system(folder: str) -> tuple[fs.FileSystem, str]:
    uri = folder if "://" in folder else folder.replace("file:", "", 1)
    return fs.FileSystem.from_uri(uri)


def _written(
    batches: Iterator[pd.DataFrame], folder: str, tokenizer: str, end_id: int, width: int
) -> Iterator[pd.DataFrame]:
    """Encode and append the documents of a task in their order; yield index rows."""
    bpe = encoder(tokenizer)
    end = np.array([end_id], "<u4").tobytes()
    system, root = _file_system(folder)
    name = f"part-{uuid.uuid4().hex}.rec"
    offset = place = 0
    stream = None
    try:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.frombuffer(bpe.packed(text) + end, "<u4")
                record = framed(ids.astype(f"<u{width}").tobytes())
                stream = stream or system.open_output_stream(f"{root}/{name}")
                stream.write(record)
                rows.append((doc_id, name, offset, len(record), len(ids), place))
                offset += len(record)
                place += 1
            if rows:
                columns = ["doc_id", "file", "offset", "size", "n_tokens", "place"]
                yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})
    finally:
        if stream is not None:
            stream.close()


def _read(batches: Iterator[pd.DataFrame], folder: str, width: int) -> Iterator[pd.DataFrame]:
    """Read indexed records, in any order, and digest their ids."""
    system, root = _file_system(folder)
    name, source = None, None
    for batch in batches:
        digests = []
        for file, offset, size in zip(batch["file"], batch["offset"], batch["size"]):
            if file != name:
                if source is not None:
                    source.close()
                name, source = file, system.open_input_file(f"{root}/{file}")
            payload = unframed(source.read_at(int(size), int(offset)))
            ids = np.frombuffer(payload, f"<u{width}").astype("<u4")
            digests.append((len(ids), zlib.crc32(ids.tobytes())))
        found = pd.DataFrame(digests, columns=["n_tokens", "ids_crc32"], index=batch.index)
        yield pd.concat([batch[["doc_id", "start"]], found], axis=1)
    if source is not None:
        source.close()


class RecordFiles:
    """A written set of record files: ``folder``, and ``index`` with a row for each record."""

    def __init__(self, folder: str, index: DataFrame, width: int) -> None:
        self.folder, self.index, self.width = folder, index, width

    def digests(self) -> DataFrame:
        """``(doc_id, start, n_tokens, ids_crc32)`` of every record, read from the files."""
        sizes = self.index.groupBy("file").agg(
            F.min("doc_id").alias("low"), F.sum("n_tokens").alias("tokens")
        )
        # One row for each file: files follow one another in doc_id order.
        before = Window.orderBy(F.col("low").asc_nulls_first(), "file")
        starts = sizes.select(
            "file",
            F.coalesce(
                F.sum("tokens").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("file_start"),
        )
        inside = Window.partitionBy("file").orderBy("place")
        inside = inside.rowsBetween(Window.unboundedPreceding, -1)
        own = F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
        placed = self.index.join(starts, "file").select(
            "doc_id", "file", "offset", "size", (own + F.col("file_start")).alias("start")
        )
        folder, width = self.folder, self.width
        return placed.mapInPandas(
            lambda batches: _read(batches, folder, width),
            "doc_id long, start long, n_tokens long, ids_crc32 long",
        )


def write_records(
    docs: DataFrame, tokenizer: str, end_id: int, folder: str | None = None, vocabulary: int = 50_257
) -> RecordFiles:
    """Write the ids of every whole text, each followed by ``end_id``, in doc_id order.

    Files hold ranges of doc_id and are dealt out by size.  A null or empty text has
    only the end id; null ids come first; rows that share a doc_id follow each
    other in the order of their texts.  An empty table gives no files and an empty index.
    Columns other than doc_id and text are not looked at.  ``folder`` must be shared by
    all executors; by default it is a new one below the scratch folder.
    """
    spark = docs.sparkSession
    folder = folder or scratch_dir(spark, "records")
    width = 2 if max(vocabulary, end_id + 1) <= 1 << 16 else 4
    system, root = _file_system(folder)
    system.create_dir(root, recursive=True)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chars = source.agg(F.coalesce(F.sum(F.char_length("text")), F.lit(0))).first()[0]
    files = max(1, -(-chars // DOCS_PER_FILE_CHARS))
    ordered = source.repartitionByRange(files, "doc_id").sortWithinPartitions("doc_id", "text")
    index = ordered.mapInPandas(
        lambda batches: _written(batches, folder, tokenizer, end_id, width), INDEX
    )
    return RecordFiles(folder, Written(index, "record-index").df, width)
