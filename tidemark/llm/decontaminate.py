"""Benchmark decontamination by SimHash windows, with DataFrame and SQL functions only.

Texts are words in lower case (runs of letters and digits); a shingle is five words in a
row.  Documents are searched for windows as long as a benchmark item whose bag of
shingles is similar to the item's: ``sum(min(counts)) / sum(max(counts)) >= 0.8``.

Such a window holds shingles of the item, and a best one begins at a shared shingle or is the
document's last, so only those, windows that end at a shared shingle and windows that put
one at its place in the item are fingerprinted.  Fingerprints are 64-bit SimHashes
of the counted shingles.  They are split into blocks; a window and an item within
``RADIUS`` differ in at most ``NEAR`` bits of some block, and an index with every block
value within ``NEAR`` bits of an item's finds them all.  Candidates are then verified.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import once
from tidemark.llm.storage import Written, content_keys

WORDS = 5
SIMILARITY = 0.8
BITS = 64
BLOCKS = 8
NEAR = 2
RADIUS = BLOCKS * (NEAR + 1) - 1
#: Items in one broadcast: their shingles and index entries stay within some tens of MB.
ITEMS_AT_ONCE = 5_000
ITEM_WORDS_AT_ONCE = 400_000


def words(text: Column) -> Column:
    """Words in lower case; null and empty texts have none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.filter(parts, lambda w: w != "")


def shingle_hashes(found: Column) -> Column:
    """Hashes of the shingles in order; none for fewer than five words."""
    last = F.size(found) - WORDS
    hashed = F.transform(
        found,
        lambda w, i: F.when(i <= last, F.xxhash64(w, *[F.get(found, i + k) for k in range(1, WORDS)])),
    )
    return F.when(last >= 0, F.slice(hashed, 1, F.greatest(last + 1, F.lit(1)))).otherwise(
        F.array().cast("array<bigint>")
    )


def _hashed(rows: DataFrame, key: str) -> DataFrame:
    """``(key, hashes)`` of rows that have a shingle."""
    hashes = once(words(F.col("text")), shingle_hashes)
    hashed = rows.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias(key), F.explode(F.array(hashes)).alias("hashes")
    )
    return hashed.where(F.size("hashes") > 0)


def with_fingerprints(rows: DataFrame) -> DataFrame:
    """``rows`` (all columns, one of them ``hashes``) with the SimHash of ``hashes``."""
    keys = rows.columns
    bit = F.explode("hashes").alias("_h")
    votes = [
        F.sum(F.getbit("_h", F.lit(i)).cast("int") * 2 - 1).alias(f"_v{i}") for i in range(BITS)
    ]
    summed = rows.select(*keys, bit).groupBy(*keys).agg(*votes)
    bits = [F.when(F.col(f"_v{i}") > 0, F.lit(_bit(i))).otherwise(F.lit(0)) for i in range(BITS)]
    joined = reduce(lambda a, b: a.bitwiseOR(b), [b.cast("long") for b in bits])
    return summed.select(*keys, joined.alias("simhash"))


def _bit(i: int) -> int:
    return -(1 << 63) if i == 63 else 1 << i


def _block(simhash: Column, block: int) -> Column:
    width = BITS // BLOCKS
    return F.shiftrightunsigned(simhash, block * width).bitwiseAND((1 << width) - 1).cast("int")


def _masks() -> list[int]:
    width = BITS // BLOCKS
    flips = [c for n in range(NEAR + 1) for c in combinations(range(width), n)]
    return [sum(1 << b for b in c) for c in flips]


def hamming_index(items: DataFrame) -> DataFrame:
    """``(size, block, value, item_id, item_hash)`` for every block value near an item's own.

    The size is part of the key: a window is compared with items of its size only.
    """
    entries = F.flatten(
        F.array(
            *[
                F.transform(
                    F.array(*[F.lit(m) for m in _masks()]),
                    _entry(b),
                )
                for b in range(BLOCKS)
            ]
        )
    )
    flat = items.select("item_id", "size", "simhash", F.explode(entries).alias("e"))
    return flat.select("item_id", "size", F.col("simhash").alias("item_hash"), "e.block", "e.value")


def _entry(block: int):
    own = _block(F.col("simhash"), block)
    return lambda mask: F.struct(
        F.lit(block).alias("block"), own.bitwiseXOR(mask).alias("value")
    )


def _spots(hashed: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, k1, k2, size, start)`` of the windows of a document that may match an item.

    A window that starts at a shared shingle, or is the document's last, holds most shared
    ones: moving a window past a shingle that is not shared loses none.  One that ends at a
    shared shingle is the earliest of equal ones.  Too few shared shingles cannot match.
    """
    anchors = items.select(
        "item_id", F.size("hashes").alias("size"), F.posexplode("hashes").alias("place", "hash")
    )
    placed = hashed.select(
        "doc_id", "k1", "k2", F.size("hashes").alias("length"), F.posexplode("hashes").alias("at", "hash")
    )
    met = placed.join(F.broadcast(anchors), "hash")
    own = F.greatest(F.col("at") - F.col("place"), F.lit(0))
    met = met.groupBy("doc_id", "k1", "k2", "length", "item_id", "size").agg(
        F.sort_array(F.collect_set("at")).alias("ats"), F.collect_set(own).alias("own")
    )
    size, ats = F.col("size"), F.col("ats")
    needed = F.ceil(size * SIMILARITY - 1e-9).cast("int")
    last = F.greatest(F.col("length") - size, F.lit(0))
    begins = F.filter(ats, lambda at, i: (F.get(ats, i + needed - 1) < at + size) & (at <= last))
    ends = F.filter(ats, lambda at, i: F.get(ats, i - needed + 1) > at - size)
    ends = F.transform(ends, lambda at: F.greatest(at - size + 1, F.lit(0)))
    starts = F.array_distinct(F.concat("own", begins, ends, F.array(last)))
    enough = met.where(F.size("ats") >= needed)
    return enough.select("doc_id", "k1", "k2", "size", F.explode(starts).alias("start")).distinct()


def _windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Windows as long as an item around the shingles that they share with it.

    Texts are hashed again for the documents that have such a window only.  Those are
    looked up by a merge at every size, since their list grows with the documents.
    """
    def keyed(rows: DataFrame) -> DataFrame:
        return _hashed(rows, "doc_id").select("doc_id", "hashes", *content_keys(F.col("hashes")))

    spots = Written(_spots(keyed(docs), items), "spots").df
    wanted = spots.select("doc_id").distinct().hint("merge")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    met = keyed(texts.join(wanted, "doc_id", "left_semi")).join(spots.hint("merge"), ["doc_id", "k1", "k2"])
    cut = F.slice("hashes", F.col("start") + 1, F.col("size"))
    return met.select("doc_id", "start", "size", cut.alias("hashes")).distinct()


def _shared(a: Column, b: Column) -> Column:
    """Size of the intersection of two bags."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    counted = F.aggregate(
        F.array_intersect(a, b),
        F.lit(0),
        lambda n, x: n
        + F.least(F.size(F.filter(a, lambda y: y == x)), F.size(F.filter(b, lambda y: y == x))),
    )
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(counted)


def _candidates(windows: DataFrame, items: DataFrame) -> DataFrame:
    """Windows with the items of their size within ``RADIUS``, from the Hamming index."""
    index = hamming_index(with_fingerprints(items).withColumn("size", F.size("hashes")))
    blocks = F.explode(
        F.array(
            *[
                F.struct(F.lit(b).alias("block"), _block(F.col("simhash"), b).alias("value"))
                for b in range(BLOCKS)
            ]
        )
    ).alias("e")
    probes = windows.select("doc_id", "start", "size", "hashes", "simhash", blocks)
    probes = probes.select("doc_id", "start", "size", "hashes", "simhash", "e.block", "e.value")
    near = probes.join(F.broadcast(index), ["size", "block", "value"])
    apart = F.bit_count(F.col("simhash").bitwiseXOR(F.col("item_hash")))
    return near.where(apart <= RADIUS)


def _matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    near = _candidates(with_fingerprints(_windows(docs, items)), items)
    bags = items.select("item_id", F.col("hashes").alias("bag"))
    pairs = near.join(F.broadcast(bags), "item_id")
    shared = _shared(F.col("hashes"), F.col("bag"))
    total = F.size("hashes") + F.size("bag")
    similarity = once(shared, lambda n: n / (total - n))
    scored = pairs.select("doc_id", "item_id", "start", similarity.alias("similarity"))
    return scored.where(F.col("similarity") >= SIMILARITY)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, start, similarity)``: the best window of each item in each document.

    ``start`` is the first shingle's number in the document; of equal windows it is the
    earliest.  Null and empty texts, rows with a null key and items of fewer than five
    words match nothing.  Rows that share a doc_id count as one document with several
    texts.  Other columns are not looked at; an empty table on either side gives no rows.

    A benchmark is searched for in portions whose size is measured first, so what is
    broadcast does not grow with it.
    """
    items = Written(_hashed(benchmark, "item_id").distinct(), "items").df
    counted = items.agg(F.count("*"), F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()
    portions = max(1, -(-counted[0] // ITEMS_AT_ONCE), -(-counted[1] // ITEM_WORDS_AT_ONCE))
    part = F.pmod(F.xxhash64("item_id"), F.lit(portions))
    found = [_matches(docs, items.where(part == i)) for i in range(portions)]
    union = reduce(DataFrame.union, found)
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best")
    grouped = union.groupBy("doc_id", "item_id").agg(best)
    return grouped.select(
        "doc_id",
        "item_id",
        (-F.col("best.back")).cast("int").alias("start"),
        F.col("best.similarity").alias("similarity"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; all columns as they are."""
    held = contaminated(docs, benchmark).select(F.col("doc_id").alias("_held")).distinct()
    return docs.join(held, docs["doc_id"] == held["_held"], "left_anti")
