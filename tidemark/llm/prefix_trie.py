"""Trie of shared conversation prefixes, from collapsed whole sequences.

Conversations are ordered by turn (null first; equal turns by the SHA-256 of their
content) and rebuilt: a conversation takes over the first few turns of another one.
Identical rebuilt conversations collapse to one weighted sequence with a digest of its
members; sequences that are proper prefixes of others go by an anti-join, which leaves
the leaves; and every node of the trie is an aggregate over the weighted sequences that
start with it.

Nothing is collected per conversation, so one may hold any share of the turns.  A prefix
is known by its depth and a polynomial hash of its turns' SHA-256 digests modulo
``2^127 - 1``.  Such hashes compose: a sorted range of turns is hashed by itself and what
stood before it is added afterwards, and a rebuilt prefix follows from those of the two
conversations it was made of.

A node's words are spent by its smallest member and saved for all others.  A smallest
member stays the smallest further down, so each sequence has a depth up to which its
words are saved; that turns the sum over a subtree into one number for each turn.

A null role or text is empty, rows with a null ``conv_id`` are left out, repeated rows
are turns of their own, and other columns make no difference.  Of an empty table nothing
comes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import Written

WORD = r"[^\x20\x09-\x0D]+"
#: Turns taken over at most, and the ids that share the conversation they come from.
HEAD, FAMILY = 3, 20
#: Ids of members in one piece of an end list.
PIECE = 65_536
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

_PRIME = 2**127 - 1
_BASE = int.from_bytes(hashlib.sha256(b"prefix").digest()[:15], "big")
_LOW = 2**64


def _join(high: int, low: int) -> int:
    return (high << 64) | (low % _LOW)


def _split(value: int) -> tuple[int, int]:
    low = value % _LOW
    return value >> 64, low - _LOW if low >= _LOW // 2 else low


# --- prefixes of the conversations as they are ------------------------------------------


def _turns(conversations: DataFrame) -> DataFrame:
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.left(F.sha2(content, 256), F.lit(32))).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


_CHAIN = (
    "part int, edge boolean, conv_id long, pos long, high long, low long, "
    "before_high long, before_low long, words long, total long"
)


def _frame(rows: list[tuple], like: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in like.split(", ")]
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    arrays = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, [name for name, _ in fields])


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of the conversations of a sorted range, as if each began in the range.

    Rows flagged ``edge`` repeat the end of the first and of the last conversation,
    which alone may go on from the range before or into the next one.
    """
    part, conv, segments = TaskContext.get().partitionId(), None, 0
    pos = value = total = 0

    def end(conv: int) -> tuple:
        return (part, True, conv, pos, *_split(value), segments, 0, 0, total)

    for batch in batches:
        rows = []
        for c, digest, words in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "digest", "words")), strict=True):
            if c != conv:
                if segments == 1:
                    rows.append(end(conv))
                conv, segments, pos, value, total = c, segments + 1, 0, 0, 0
            before, pos, total = value, pos + 1, total + words
            value = (value * _BASE + int.from_bytes(digest, "big") + 1) % _PRIME
            rows.append((part, False, c, pos, *_split(value), *_split(before), words, total))
        yield _frame(rows, _CHAIN)
    if conv is not None:
        yield _frame([end(conv)], _CHAIN)


def _starts(edges: DataFrame) -> list[tuple]:
    """``(part, conv_id, pos, high, low, total)`` before ranges that go on with a conversation.

    Two rows for each range at most reach the driver.
    """
    starts, running = [], None
    for r in edges.orderBy("part", "before_high").toLocalIterator():
        own = (r.conv_id, r.pos, _join(r.high, r.low), r.total)
        if r.before_high == 1 and running and running[0] == r.conv_id:
            _, pos, value, total = running
            starts.append((r.part, r.conv_id, pos, *_split(value), total))
            joined = (value * pow(_BASE, own[1], _PRIME) + own[2]) % _PRIME
            own = (r.conv_id, pos + own[1], joined, total + own[3])
        elif r.before_high == 1 and running and r.conv_id < running[0]:
            raise RuntimeError("ranges are out of order")
        running = own
    return starts


def _shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            value = _join(r["start_high"], r["start_low"]) * pow(_BASE, r["pos"] - 1, _PRIME)
            before = (value + _join(r["before_high"], r["before_low"])) % _PRIME
            after = (value * _BASE + _join(r["high"], r["low"])) % _PRIME
            rows.append(
                (r["part"], False, r["conv_id"], r["pos"] + r["start"], *_split(after), *_split(before),
                 r["words"], r["total"] + r["start_total"])
            )
        yield _frame(rows, _CHAIN)


def prefixes(conversations: DataFrame) -> DataFrame:
    """Every turn with its position, prefix hash, the hash before it, and words so far."""
    spark = conversations.sparkSession
    order = ("conv_id", "turn", "digest")
    ranged = _turns(conversations).repartitionByRange(*order).sortWithinPartitions(*order)
    chain = Written(ranged.mapInArrow(_chained, _CHAIN), "prefixes").df
    starts = _starts(chain.where("edge"))
    rows = chain.where("NOT edge")
    if starts:
        # One row for each range of the shuffle at most.
        schema = "part int, conv_id long, start long, start_high long, start_low long, start_total long"
        begun = F.broadcast(spark.createDataFrame(starts, schema))
        moved = rows.join(begun, ["part", "conv_id"]).select(*chain.columns, *begun.columns[2:])
        others = rows.join(begun, ["part", "conv_id"], "left_anti").select(*chain.columns)
        rows = others.unionByName(moved.mapInArrow(_shifted, _CHAIN))
    return rows.drop("part", "edge")


# --- rebuilt conversations --------------------------------------------------------------

_INFO = (
    "conv_id long, own long, taken long, delta_high long, delta_low long, delta_total long, "
    "length long, high long, low long, total long"
)


def _head_columns(prefix: str = "") -> list[str]:
    return [f"{prefix}{name}{i}" for i in range(1, HEAD + 1) for name in ("h", "l", "w", "t")]


def _conversations(rows: DataFrame) -> DataFrame:
    """Length, whole hash and the first ``HEAD`` turns of each conversation."""
    aggregates = [
        F.max("pos").alias("n"),
        *[F.max_by(c, "pos").alias(f"all_{c}") for c in ("high", "low", "total")],
    ]
    for i in range(1, HEAD + 1):
        for name, column in (("h", "high"), ("l", "low"), ("w", "words"), ("t", "total")):
            aggregates.append(F.max(F.when(F.col("pos") == i, F.col(column))).alias(f"{name}{i}"))
    return rows.groupBy("conv_id").agg(*aggregates)


def _rebuilt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            own, taken = min(r["h"], r["n"]), min(r["h"], r["base_n"] or 0)
            mine = (_join(r[f"h{own}"], r[f"l{own}"]), r[f"t{own}"]) if own else (0, 0)
            base = (_join(r[f"base_h{taken}"], r[f"base_l{taken}"]), r[f"base_t{taken}"]) if taken else (0, 0)
            delta, words = (base[0] - mine[0]) % _PRIME, base[1] - mine[1]
            rest = r["n"] - own
            whole = (_join(r["all_high"], r["all_low"]) + delta * pow(_BASE, rest, _PRIME)) % _PRIME
            rows.append(
                (r["conv_id"], own, taken, *_split(delta), words, rest + taken, *_split(whole), r["all_total"] + words)
            )
        yield _frame(rows, _INFO)


def rebuilt_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """How each conversation is rebuilt, and the heads that others take over."""
    known = Written(_conversations(rows), "conversations").df
    base = known.select(
        F.col("conv_id").alias("base"), F.col("n").alias("base_n"),
        *[F.col(c).alias(f"base_{c}") for c in _head_columns()],
    )
    taken = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(HEAD + 1)).cast("long")
    mine = known.withColumn("h", taken).withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY)
    joined = mine.join(base, "base", "left")
    return Written(joined.mapInArrow(_rebuilt, _INFO), "rebuilt").df, known


_STEPS = (
    "conv_id long, depth long, high long, low long, before_high long, before_low long, "
    "words long, total long, length long"
)


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            delta, after = _join(r["delta_high"], r["delta_low"]), r["pos"] - r["own"]
            value, before = _join(r["high"], r["low"]), _join(r["before_high"], r["before_low"])
            if delta:
                shift = delta * pow(_BASE, after - 1, _PRIME)
                before = (before + shift) % _PRIME
                value = (value + shift * _BASE) % _PRIME
            rows.append(
                (r["conv_id"], after + r["taken"], *_split(value), *_split(before),
                 r["words"], r["total"] + r["delta_total"], r["length"])
            )
        yield _frame(rows, _STEPS)


def _steps(rows: DataFrame, chosen: DataFrame, known: DataFrame) -> DataFrame:
    """The rebuilt turns of the chosen conversations with their prefixes."""
    plan = chosen.select("conv_id", "own", "taken", "delta_high", "delta_low", "delta_total", "length")
    own = rows.join(plan, "conv_id").where(F.col("pos") > F.col("own")).mapInArrow(_moved, _STEPS)
    heads = known.select(F.col("conv_id").alias("base"), *_head_columns())
    takers = chosen.where("taken > 0").select(
        "conv_id", "taken", "length", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")
    )
    zero = F.lit(0).cast("long")
    turn = [
        F.struct(
            F.lit(i).cast("long").alias("depth"),
            F.col(f"h{i}").alias("high"),
            F.col(f"l{i}").alias("low"),
            (F.col(f"h{i - 1}") if i > 1 else zero).alias("before_high"),
            (F.col(f"l{i - 1}") if i > 1 else zero).alias("before_low"),
            F.col(f"w{i}").alias("words"),
            F.col(f"t{i}").alias("total"),
        )
        for i in range(1, HEAD + 1)
    ]
    taken = takers.join(heads, "base").select("conv_id", "taken", "length", F.inline(F.array(*turn)))
    return own.unionByName(taken.where("depth <= taken").drop("taken"))


# --- end lists --------------------------------------------------------------------------

_PIECES = "length long, high long, low long, first long, ids binary"
_ENDS = "length long, high long, low long, ends_sha256 string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, ids, out, held = None, [], [], 0

    def close() -> None:
        out.append((*key, ids[0], ",".join(map(str, ids)).encode()))

    for batch in batches:
        for *mine, conv_id in zip(*(batch.column(c).to_pylist() for c in ("length", "high", "low", "conv_id")), strict=True):
            if key != mine or len(ids) == PIECE:
                if ids:
                    close()
                    held += len(out[-1][-1]) + 64
                key, ids = mine, []
                if held > 8_000_000:
                    yield _frame(out, _PIECES)
                    out, held = [], 0
            ids.append(conv_id)
    if ids:
        close()
        yield _frame(out, _PIECES)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest = None, None
    for batch in batches:
        out = []
        for *mine, ids in zip(*(batch.column(c).to_pylist() for c in ("length", "high", "low", "ids")), strict=True):
            if key != mine:
                if digest:
                    out.append((*key, digest.hexdigest()))
                key, digest = mine, hashlib.sha256(ids)
            else:
                digest.update(b"," + ids)
        yield _frame(out, _ENDS)
    if digest:
        yield _frame([(*key, digest.hexdigest())], _ENDS)


def end_digests(info: DataFrame) -> DataFrame:
    """SHA-256 of each sequence's members, ascending and joined by commas.

    Sorted ranges join ids to pieces of text; a digest, which can only be made in order,
    reads one piece after the other and holds none.
    """
    order = ("length", "high", "low", "conv_id")
    ranged = info.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    pieces = ranged.mapInArrow(_pieces, _PIECES).repartition("length", "high", "low")
    return pieces.sortWithinPartitions("length", "high", "low", "first").mapInArrow(_hashed, _ENDS)


# --- the trie ---------------------------------------------------------------------------

_NODE = ["depth", "high", "low"]


def _saved(copies: Column, whole: Column, before: Column, until: Column) -> Column:
    """Words below ``before`` that a sequence's members need not spend."""
    return (copies - 1) * (whole - before) + F.greatest(F.lit(0).cast("long"), until - before)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row for each node, the root included, in numbers of type long.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256)``.
    """
    spark = conversations.sparkSession
    rows = prefixes(conversations)
    info, known = rebuilt_conversations(rows)
    sequences = info.groupBy("length", "high", "low").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("copies")
    )
    chosen = info.join(sequences.select("conv_id", "copies"), "conv_id")
    chosen = Written(chosen, "sequences").df
    steps = Written(_steps(rows, chosen, known), "steps").df

    # Leaves: sequences that no other one goes on from.
    proper = steps.where(F.col("depth") < F.col("length")).select(*_NODE).distinct()
    keyed = chosen.withColumn("depth", F.col("length"))
    leaves = keyed.where("depth > 0").join(proper, _NODE, "left_anti").select("conv_id", F.lit(1).alias("leaf"))

    # How far down each sequence's words are spent by a smaller member.
    smallest = steps.groupBy(*_NODE).agg(F.min("conv_id").alias("owner"))
    shared = steps.join(smallest, _NODE).where("owner <> conv_id")
    until = shared.groupBy("conv_id").agg(F.max("total").alias("until"))
    weights = chosen.select("conv_id", "copies", "length", F.col("total").alias("whole"))
    weights = weights.join(leaves, "conv_id", "left").join(until, "conv_id", "left")
    weights = weights.withColumn("until", F.coalesce("until", F.lit(0).cast("long")))
    weights = Written(weights.withColumn("leaf", F.coalesce("leaf", F.lit(0)).cast("long")), "weights").df

    before = F.col("total") - F.col("words")
    weighted = steps.join(weights.drop("length"), "conv_id")
    saved = _saved(F.col("copies"), F.col("whole"), before, F.col("until"))
    nodes = weighted.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("copies").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(saved).alias("saved_tokens"),
        F.max("before_high").alias("before_high"),
        F.max("before_low").alias("before_low"),
    )
    nodes = Written(nodes, "nodes").df

    zero = F.lit(0).cast("long")
    top = weights.agg(
        F.min("conv_id").alias("conv_id"),
        F.sum("copies").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(_saved(F.col("copies"), F.col("whole"), zero, F.col("until"))).alias("saved_tokens"),
    ).first()
    schema = "depth long, high long, low long, conv_id long, n_convs long, n_leaves long, saved_tokens long"
    roots = []
    if top.conv_id is not None:
        roots = [(0, 0, 0, top.conv_id, top.n_convs, top.n_leaves or 1, top.saved_tokens)]
    root = spark.createDataFrame(roots, schema)

    children = nodes.groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("before_high").alias("high"), F.col("before_low").alias("low")
    ).agg(F.count("*").alias("n_children"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("high").alias("before_high"),
        F.col("low").alias("before_low"), F.col("conv_id").alias("parent_conv_id"),
    )
    # All nodes of depth 1 have the root above them, without a join on that one key.
    deep = nodes.where("depth > 1").join(parents, ["depth", "before_high", "before_low"])
    first = nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(top.conv_id).cast("long"))
    all_nodes = deep.unionByName(first).drop("before_high", "before_low")
    all_nodes = all_nodes.unionByName(root.withColumn("parent_conv_id", F.lit(None).cast("long")))
    ends = end_digests(info).withColumnRenamed("length", "depth")
    out = all_nodes.join(children, _NODE, "left").join(ends, _NODE, "left")
    return out.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
