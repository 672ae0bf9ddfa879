"""Near-duplicate documents by Order MinHash and banded alignment.

Words are the text in lower case, split at white space.  A document is its sequence of
five-word shingles (all its words, if it has fewer).  Two documents are near
duplicates if an alignment of the two sequences matches ``m`` shingles in order with
``m / (n_a + n_b - m) >= 0.8``: Jaccard similarity that also respects order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.graph import central_pairs, components
from tidemark.llm.storage import Intermediates, Written, content_keys

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 20
DEPTH = 3
#: Longs of a bitmap; a power of two.
BITMAP = 8
#: Shingles of a bucket's documents that meet in one group, twice as many across two chunks.
CHUNK = 1 << 18
_WORD_CACHE = 200_000
_CELLS = 1_000_000
_ODD = np.random.default_rng(20260812).integers(1, 2**63, (SKETCHES + 2, 2), dtype=np.uint64) | np.uint64(1)


class _Hashes(dict):
    """Word to 64-bit hash; bounded, since a lost entry is only computed again."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _WORD_CACHE:
            self.clear()
        value = self[word] = xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hashes = _Hashes()


def _mixed(x: np.ndarray, row: int | slice) -> np.ndarray:
    """A bijection of 64-bit values like a random permutation, or one for each of some rows."""
    first, second = _ODD[row, 0], _ODD[row, 1]
    if isinstance(row, slice):
        first, second = first[:, None], second[:, None]
    x = (x ^ (x >> np.uint64(31))) * first
    x = (x ^ (x >> np.uint64(29))) * second
    return x ^ (x >> np.uint64(32))


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """Hashes of the shingles in text order; empty for a text without words."""
    found = (text or "").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, found), np.uint64, len(found))
    width = min(words, len(h))
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            out = _mixed(out ^ h[i : i + n], SKETCHES)
    return out


def _labelled(shingles: np.ndarray) -> np.ndarray:
    """Each shingle mixed with its occurrence number, so that repeats are told apart."""
    order = np.argsort(shingles, kind="stable")
    ranked = shingles[order]
    starts = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
    runs = np.arange(len(ranked)) - np.repeat(starts, np.diff(np.r_[starts, len(ranked)]))
    occurrence = np.empty(len(shingles), np.uint64)
    occurrence[order] = runs
    return _mixed(shingles + occurrence * np.uint64(0x9E3779B97F4A7C15), SKETCHES + 1)


def order_sketches(text: str | None) -> np.ndarray:
    """``SKETCHES`` hashes, each of the ``DEPTH`` smallest labelled shingles in text order."""
    return _sketches(_labelled_shingles(text))


def _labelled_shingles(text: str | None) -> np.ndarray:
    shingles = shingle_hashes(text)
    with np.errstate(over="ignore"):
        return _labelled(shingles) if len(shingles) else shingles


def bitmap(labelled: np.ndarray) -> np.ndarray:
    """Parity of the labelled shingles at each of ``64 * BITMAP`` bits, as longs."""
    places = (labelled & np.uint64(64 * BITMAP - 1)).astype(np.int64)
    odd = np.bincount(places, minlength=64 * BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketches(labelled: np.ndarray) -> np.ndarray:
    if not len(labelled):
        return np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        depth = min(DEPTH, len(labelled))
        at_once = max(1, _CELLS // len(labelled))
        picked = np.concatenate(
            [_smallest_in_order(labelled, rows, depth) for rows in _blocks(SKETCHES, at_once)]
        )
        value = np.arange(SKETCHES, dtype=np.uint64)
        for i in range(depth):
            value = (value ^ labelled[picked[:, i]]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
    return value.view(np.int64)


def _blocks(n: int, size: int) -> Iterator[slice]:
    for start in range(0, n, size):
        yield slice(start, min(n, start + size))


def _smallest_in_order(labelled: np.ndarray, rows: slice, depth: int) -> np.ndarray:
    """For each permutation, the places of its ``depth`` smallest shingles, ascending."""
    if len(labelled) == depth:
        return np.tile(np.arange(depth), (rows.stop - rows.start, 1))
    permuted = _mixed(labelled[None, :], rows)
    return np.sort(np.argpartition(permuted, depth - 1, axis=1)[:, :depth], axis=1)


def _sketch_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        labelled = [_labelled_shingles(t) for t in batch["text"]]
        bits = np.array([bitmap(found) for found in labelled], np.int64).reshape(-1, BITMAP)
        columns = {"doc_id": batch["doc_id"], "k1": batch["k1"], "k2": batch["k2"]}
        columns |= {"sketches": [_sketches(found) for found in labelled]}
        columns |= {"size": [len(found) for found in labelled]}
        yield pd.DataFrame(columns | {f"x{i}": bits[:, i] for i in range(BITMAP)})


def matched_in_order(a: np.ndarray, b: np.ndarray, needed: int) -> bool:
    """Whether an alignment matches at least ``needed`` items of both, in order.

    Only cells in the band of ``len(a) + len(b) - 2 * needed`` diagonals can lie on
    such an alignment.  The farthest reach of every diagonal of the band is advanced
    by one unmatched item at a time, so close sequences end after a few steps.
    """
    budget = len(a) + len(b) - 2 * needed
    if budget < 0 or needed > min(len(a), len(b)):
        return False
    n, m = len(a), len(b)
    if abs(n - m) > budget:
        return False
    goal, offset = n - m, budget + 1
    nowhere = -(1 << 40)
    reach = np.full(2 * budget + 3, nowhere, np.int64)
    reach[offset + 1] = 0
    for step in range(budget + 1):
        low, high = max(-step, goal - budget + step), min(step, goal + budget - step)
        ks = np.arange(low + (low + step) % 2, high + 1, 2)
        down, right = reach[offset + ks + 1], reach[offset + ks - 1] + 1
        x = np.maximum(
            np.where(down - ks > m, nowhere, down), np.where(right > n, nowhere, right)
        )
        there = x >= 0
        x[there] = _slide(a, b, x[there], x[there] - ks[there])
        reach[offset + ks] = x
        if reach[offset + goal] >= n:
            return True
    return False


def _slide(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Advance each (x, y) along its diagonal while the items match."""
    x = x.copy()
    active = np.arange(len(x))
    y = y.copy()
    while len(active):
        if len(active) <= 3:
            for i in active:
                x[i] += _run(a, b, int(x[i]), int(y[i]))
            break
        active = active[(x[active] < len(a)) & (y[active] < len(b))]
        active = active[a[x[active]] == b[y[active]]]
        x[active] += 1
        y[active] += 1
    return x


def _run(a: np.ndarray, b: np.ndarray, x: int, y: int) -> int:
    start, width = x, 32
    while True:
        left, right = a[x : x + width], b[y : y + width]
        size = min(len(left), len(right))
        differ = left[:size] != right[:size]
        if differ.any():
            return x + int(differ.argmax()) - start
        x, y = x + size, y + size
        if size < width:
            return x - start
        width *= 2


def needed_matches(n: int, m: int, similarity: float = SIMILARITY) -> int:
    """Fewest matches with ``matches / (n + m - matches) >= similarity``."""
    least = int(np.floor(similarity * (n + m) / (1 + similarity))) - 1
    while least < 1 or least / (n + m - least) < similarity - 1e-12:
        least += 1
    return least


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Near duplicates by banded alignment; two empty sequences are not."""
    if not len(a) or not len(b):
        return False
    needed = needed_matches(len(a), len(b), similarity)
    if needed > min(len(a), len(b)):
        return False
    with np.errstate(over="ignore"):
        shared = np.intersect1d(_labelled(a), _labelled(b), assume_unique=True)
    return len(shared) >= needed and matched_in_order(a, b, needed)


def _verified(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    last: tuple[str | None, np.ndarray] = (None, np.empty(0, np.uint64))
    for batch in batches:
        keep = []
        for left, right in zip(batch["left"], batch["right"]):
            if last[0] != left:
                last = (left, shingle_hashes(left))
            keep.append(similar(last[1], shingle_hashes(right)))
        yield batch.loc[keep, ["a", "b"]]


def _shared(buckets: DataFrame) -> DataFrame:
    """``(id, bucket, n)`` of the buckets with several documents."""
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    return Written(buckets.join(sizes.hint("rebalance"), "bucket"), "shared-sketches").df


def near_duplicate_classes(docs: DataFrame, passes: int = 2) -> DataFrame:
    """``(doc_id, class_id, kept)``: the smallest doc_id of each document's class.

    A class is a connected component of exact copies and near duplicates.  Copies
    are found by hash and take part once.  Each pass pairs every member of a sketch
    bucket with the bucket's most central document and verifies the new pairs; the
    next pass does the same with what differs from that document, which links most of a
    family with few pairs.  At last all pairs of a bucket that are in different
    components yet are verified where their texts meet, but for those that a bound shows to
    be unlike; links leave a task, never its pairs.

    Null texts count as empty.  Documents without words are in one class only if
    their texts are equal.  A null doc_id is left out; a doc_id carried by several rows
    is one document, in the smallest of its texts' classes.  Columns besides doc_id and text are
    not looked at, and an empty table gives an empty result.
    """
    with Intermediates() as kept:
        return kept.result(_classes(docs, passes), "classes")


def _classes(docs: DataFrame, passes: int) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    source = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")
    )
    keyed = source.select("doc_id", "text", *content_keys(F.col("text")))
    bits = [f"x{i}" for i in range(BITMAP)]
    schema = "doc_id long, k1 long, k2 long, sketches array<long>, size long, "
    schema += ", ".join(f"{x} long" for x in bits)
    sketched = Written(keyed.mapInPandas(_sketch_batches, schema), "sketches").df
    copies = sketched.groupBy("k1", "k2").agg(F.min("doc_id").alias("head"))
    firsts = Written(copies, "copies").df
    heads = sketched.join(firsts, ["k1", "k2"]).where(F.col("doc_id") == F.col("head"))
    buckets = heads.select(F.col("doc_id").alias("id"), F.explode("sketches").alias("bucket"))
    everyone = _shared(buckets.distinct())
    verified: DataFrame | None = None
    tried: DataFrame | None = None
    for _ in range(passes):
        shared = everyone if verified is None else _shared(buckets)
        placed = Written(central_pairs(shared), "placed").df
        pairs = placed.select("a", "b").distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        fresh = Written(pairs, "pairs").df
        links = Written(_verify(fresh, source), "verified").df
        verified = links if verified is None else verified.union(links)
        tried = fresh if tried is None else tried.union(fresh)
        unlinked = placed.join(verified, ["a", "b"], "left_anti")
        buckets = unlinked.select(F.col("b").alias("id"), "bucket")
    parts = Written(components(verified), "parts").df
    sets = heads.select(F.col("doc_id").alias("id"), "k1", "k2", "sketches", "size", *bits).distinct()
    links = Written(_apart_links(everyone.where("n > 2"), sets, parts, keyed), "verified").df
    links = links.union(parts.select(F.col("component").alias("a"), F.col("id").alias("b")))
    linked = components(links).withColumnRenamed("id", "head")
    classed = sketched.join(firsts, ["k1", "k2"]).join(linked, "head", "left")
    class_id = F.min(F.coalesce("component", "head")).alias("class_id")
    kept = (F.col("class_id") == F.col("doc_id")).alias("kept")
    return classed.groupBy("doc_id").agg(class_id).select("doc_id", "class_id", kept)


def _apart_links(
    placed: DataFrame, sets: DataFrame, parts: DataFrame, keyed: DataFrame
) -> DataFrame:
    """``(a, b)``: links between documents of a bucket that are in different components.

    Only buckets of several components are looked at.  Members of a large one meet by pairs
    of chunks, which are as many as its shingles fill, so a task holds about two chunks of
    texts however long they are.  ``sets`` and ``keyed`` have the sketches and the text of
    each different text of a document.
    """
    weights = sets.groupBy("id").agg(F.sum("size").alias("weight"))
    member = placed.select("id", "bucket").join(parts, "id", "left").join(weights, "id")
    member = member.withColumn("component", F.coalesce("component", "id"))
    mixed = member.groupBy("bucket").agg(
        F.sum("weight").alias("weight"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed = mixed.where("low != high").select("bucket", "weight").hint("rebalance")
    member = member.drop("weight")
    chunks = F.ceil(F.col("weight") / CHUNK).cast("long")
    member = member.join(mixed, "bucket").select(
        "id", "bucket", "component", chunks.alias("chunks"), F.pmod(F.xxhash64("id"), chunks).alias("side")
    )
    member = Written(member, "apart").df
    wanted = member.select(F.col("id").alias("doc_id")).distinct().hint("merge")
    texts = keyed.join(wanted, "doc_id", "left_semi").groupBy(F.col("doc_id").alias("id"), "k1", "k2")
    texts = texts.agg(F.min("text").alias("text")).hint("merge")
    known = Written(sets.join(texts, ["id", "k1", "k2"]).drop("k1", "k2"), "apart-texts").df
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other")
    dealt = member.select("id", "bucket", "component", "chunks", "side", others)
    low, high = F.least("side", "other"), F.greatest("side", "other")
    dealt = dealt.select(
        "id", "bucket", "component", "side",
        (low * F.col("chunks") + high).alias("pair"), (low != high).alias("crossing"),
    )
    blocks = dealt.join(known.hint("merge"), "id").repartition("bucket", "pair")
    blocks = blocks.sortWithinPartitions("bucket", "pair", "id")
    return blocks.mapInPandas(_linked_apart, "a long, b long").distinct()


def _linked_apart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by bucket and pair; an unfinished group is carried over."""
    held: pd.DataFrame | None = None
    for batch in batches:
        if not len(batch):
            continue
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = rows.iloc[-1]
        unfinished = (rows["bucket"] == last["bucket"]) & (rows["pair"] == last["pair"])
        held, done = rows[unfinished], rows[~unfinished]
        for _, group in done.groupby(["bucket", "pair"], sort=False):
            yield _links_of(group)
    if held is not None:
        yield _links_of(held)


def _links_of(group: pd.DataFrame) -> pd.DataFrame:
    """Links that join components of one group, one fewer than there are components at most.

    A pair is looked at in the first bucket that its documents share, and only while they
    are in different components.
    """
    ids, side = group["id"].to_numpy(), group["side"].to_numpy()
    size, texts = group["size"].to_numpy(), group["text"].to_numpy()
    bits = group[[f"x{i}" for i in range(BITMAP)]].to_numpy(np.int64).view(np.uint64)
    keys = np.stack(group["sketches"].to_numpy())
    bucket, crossing = group["bucket"].iloc[0], bool(group["crossing"].iloc[0])
    roots = group["component"].to_numpy().copy()
    sequences: dict[int, np.ndarray] = {}

    def sequence(i: int) -> np.ndarray:
        if i not in sequences:
            sequences[i] = shingle_hashes(texts[i])
        return sequences[i]

    links = []
    for i in range(len(ids) - 1):
        rest = np.arange(i + 1, len(ids))
        rest = rest[(roots[rest] != roots[i]) & ((side[rest] != side[i]) | (not crossing))]
        most = (size[rest] + size[i]) * ((1 - SIMILARITY) / (1 + SIMILARITY)) + 1e-6
        near = np.bitwise_count(bits[rest] ^ bits[i]).sum(axis=1) <= most
        rest = rest[near & (np.abs(size[rest] - size[i]) <= most)]
        equal = keys[rest] == keys[i]
        first = keys[i][equal.argmax(axis=1)] if len(rest) else keys[i][:0]
        for j in rest[first == bucket]:
            if roots[i] != roots[j] and similar(sequence(i), sequence(j)):
                links.append((ids[i], ids[j]))
                roots[roots == roots[j]] = roots[i]
    return pd.DataFrame(links, columns=["a", "b"], dtype="int64")


def _verify(pairs: DataFrame, source: DataFrame) -> DataFrame:
    """The pairs whose texts align; of the texts only those of a pair are written.

    The list of wanted documents grows with the input, so it is merged, never broadcast.
    """
    wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
    texts = Written(source.join(wanted.hint("merge"), "doc_id", "left_semi"), "candidates").df
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right"))
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left"))
    both = pairs.join(right.hint("merge"), "b").join(left.hint("merge"), "a")
    both = both.select("a", "b", "left", "right")
    return both.mapInPandas(_verified, "a long, b long").distinct()
