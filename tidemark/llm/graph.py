"""Connected components by alternating star contraction, without collecting links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import Written


def components(links: DataFrame) -> DataFrame:
    """``(id, component)`` of every id on a link ``(a, b)``; the component is its smallest id.

    Each round hangs neighbours on their smallest neighbour, first from the larger
    side, then from the smaller one; depth shrinks geometrically, so the rounds grow
    with the logarithm of the longest chain.  Every round is written to the shared
    scratch folder and the round before it is deleted, so lineage and disk stay flat.
    A link with a null end, or from an id to itself, is ignored.
    """
    high, low = F.greatest("a", "b"), F.least("a", "b")
    pairs = links.where(F.col("a") != F.col("b")).select(high.alias("u"), low.alias("v"))
    current = Written(pairs.distinct(), "links")
    before = _fingerprint(current.df)
    while before[0]:
        following = Written(_small_star(_large_star(current.df)), "links")
        now = _fingerprint(following.df)
        current.drop()
        current = following
        if now == before:
            break
        before = now
    roots = current.df.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return current.df.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def central_pairs(shared: DataFrame) -> DataFrame:
    """``(a, b)``: each member of a bucket with the bucket's most central member.

    ``shared`` has ``(id, bucket, n)`` of the buckets with ``n > 1`` members.  The most
    central one meets the most others over all its buckets: of an original and its
    variants it is the original, which is closer to each variant than they are to one
    another.  Pairs are linear in the size of a bucket.
    """
    score = shared.groupBy("id").agg(F.sum("n").alias("score")).hint("rebalance")
    scored = Written(shared.join(score, "id").select("id", "bucket", "score"), "scored").df
    best = F.max(F.struct("score", (-F.col("id")).alias("back"))).alias("best")
    heads = scored.groupBy("bucket").agg(best).select("bucket", (-F.col("best.back")).alias("a"))
    pairs = scored.join(heads.hint("rebalance"), "bucket").where("id != a")
    return pairs.select("bucket", "a", F.col("id").alias("b"))


def near_pairs(pairs: DataFrame, sketches: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` that may be similar by the bound of :func:`apart_pairs`."""
    sketch = ["size", *(f"x{i}" for i in range(words))]
    left = sketches.select(F.col("id").alias("a"), *[F.col(c).alias(f"_{c}") for c in sketch])
    right = sketches.select(F.col("id").alias("b"), *sketch)
    both = pairs.join(left, "a").join(right, "b")
    return both.where(_may_be_similar(words, similarity)).select("a", "b")


def _may_be_similar(words: int, similarity: float) -> Column:
    """Whether the sketches ``size, x0, ..`` and ``_size, _x0, ..`` allow the similarity."""
    differ = sum(
        (F.bit_count(F.col(f"x{i}").bitwiseXOR(F.col(f"_x{i}"))) for i in range(words)), F.lit(0)
    )
    most = (F.col("size") + F.col("_size")) * ((1 - similarity) / (1 + similarity)) + 1e-6
    return (F.abs(F.col("size") - F.col("_size")) <= most) & (differ <= most)


#: Members of a bucket that meet in one group of a join.
CHUNK = 512
#: Members of buckets with more take those along, so that two of them meet in one of those.
MANY = 64


def apart_pairs(
    placed: DataFrame, sketches: DataFrame, parts: DataFrame, words: int, similarity: float
) -> DataFrame:
    """``(a, b)``: all pairs of a bucket that are in different parts and may be similar.

    ``placed`` has ``(id, bucket)``, ``parts`` the ``(id, component)`` of linked ids and
    ``sketches`` ``(id, size, x0, x1, ..)``: the size of the id's set and, in ``words``
    longs, the parity of its elements at each of their bits.  Two bitmaps differ in at most
    as many bits as the sets have elements that are not common, so the bound never leaves out
    a pair of the given Jaccard similarity.  Sizes apart by more than the similarity
    allows do not meet, and members of large buckets meet in chunks, spread over tasks; two
    that share several large buckets are joined in the first of those only.
    """
    member = placed.select("id", "bucket").join(parts, "id", "left")
    member = member.withColumn("component", F.coalesce("component", "id"))
    mixed = member.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")
    )
    mixed = mixed.where("low != high").select("bucket", "n").hint("rebalance")
    member = member.join(mixed, "bucket")
    own = member.where(F.col("n") > MANY).groupBy("id").agg(F.collect_list("bucket").alias("own"))
    member = member.join(own.hint("rebalance"), "id", "left").join(sketches.hint("rebalance"), "id")
    level = F.floor(F.log(F.col("size").cast("double")) / -F.log(F.lit(similarity - 1e-9)))
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    member = member.withColumn("level", level).withColumn("chunks", chunks)
    member = member.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    member = Written(member, "apart").df
    bits = [f"x{i}" for i in range(words)]
    others = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    own = [F.col(c).alias(f"_{c}") for c in ("id", "bucket", "n", "component", "size", "level", "own", *bits)]
    left = member.select("bucket", F.col("level").alias("meet"), "chunk", others.alias("other"), *own)
    right = member.select("*", F.explode(F.array("level", F.col("level") - 1)).alias("meet"))
    right = right.select(
        "bucket", "meet", F.col("chunk").alias("other"), others.alias("chunk"),
        "id", "component", "size", "level", "own", *bits,
    )
    on = [left[c] == right[c] for c in ("bucket", "meet", "chunk", "other")]
    common = F.array_min(F.array_intersect("own", "_own"))
    first = (F.col("_n") <= MANY) | (common == F.col("_bucket"))
    once = (F.col("level") != F.col("_level")) | (F.col("_id") < F.col("id"))
    apart = F.col("component") != F.col("_component")
    met = left.join(right, [*on, once, apart, _may_be_similar(words, similarity), first])
    return met.select(F.least("_id", "id").alias("a"), F.greatest("_id", "id").alias("b")).distinct()


def _fingerprint(pairs: DataFrame) -> tuple:
    return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def _smallest(pairs: DataFrame) -> DataFrame:
    # Dealt out evenly once more, so that the join below shuffles both of its sides
    # and adaptive execution may split the neighbours of a hub.
    return pairs.groupBy("u").agg(F.min("v").alias("m")).hint("rebalance")


def _large_star(pairs: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = _smallest(both).select("u", F.least("u", "m").alias("m"))
    hung = both.join(smallest, "u").where(F.col("v") > F.col("u"))
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the smallest of them."""
    hung = pairs.join(_smallest(pairs), "u")
    others = hung.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = hung.select("u", F.col("m").alias("v"))
    return own.union(others).distinct()
