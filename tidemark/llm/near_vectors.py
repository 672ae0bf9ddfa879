"""Near-duplicate embeddings by randomised-rotation binary codes.

A unit vector is rotated at random into more dimensions; its *code* is the signs of the
rotated components and its stored *correction factor* is the code's inner product with
the rotated vector.  ``<code, rotated other> / factor`` is an unbiased estimate of the
cosine, with an error of about ``sqrt(1 / factor**2 - 1) / sqrt(dimensions)``.

Equal stretches of codes make candidates.  For each, the estimate and its confidence
bound decide whether the cosine has to be computed exactly, in double precision; only
exact cosines make links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.graph import components
from tidemark.llm.storage import Written, content_keys

COSINE = 0.95
#: Chance that a pair at exactly ``COSINE`` shares no stretch of its codes.
MISSED = 1e-4
#: Standard errors of the estimate that a skipped pair is below the limit.
CONFIDENCE = 5.0
#: Vectors of a bucket that one task compares with one another at most, on average.
CHUNK = 512
_SEED = 20260812


def bands_for(rows: int, cosine: float = COSINE) -> tuple[int, int]:
    """Bits of a stretch, and the number of stretches: buckets stay small as rows grow."""
    bits = min(max(math.ceil(math.log2(max(rows, 2))), 8), 30)
    same = (1.0 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISSED) / math.log(1.0 - same)))


def rotation(dimensions: int, bits: int) -> np.ndarray:
    """A random map of unit vectors to unit vectors of at least ``bits`` components."""
    rng = np.random.default_rng(_SEED + dimensions)
    blocks = []
    for _ in range(-(-bits // dimensions)):
        q, r = np.linalg.qr(rng.standard_normal((dimensions, dimensions)))
        blocks.append(q * np.sign(np.diag(r)))
    return np.concatenate(blocks)[:bits] * math.sqrt(dimensions / bits)


class _Rotations(dict):
    """Rotations by number of dimensions, for one number of bits."""

    def __init__(self, bits: int) -> None:
        super().__init__()
        self.bits = bits

    def __missing__(self, dimensions: int) -> np.ndarray:
        value = self[dimensions] = rotation(dimensions, self.bits)
        return value


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _coded(batches: Iterator[pd.DataFrame], bits: int, bands: int) -> Iterator[pd.DataFrame]:
    """Code, correction factor and one key for each stretch of the code."""
    rotations = _Rotations(bits * bands)
    powers = 1 << np.arange(bits, dtype=np.int64)
    for batch in batches:
        sizes = batch["vector"].map(len)
        for size in sorted(sizes.unique()):
            part = batch[sizes == size]
            rotated = _unit(np.stack(part["vector"].to_numpy())) @ rotations[int(size)].T
            signs = rotated > 0
            factor = np.abs(rotated).sum(axis=1) / math.sqrt(bits * bands)
            keys = signs.reshape(len(part), bands, bits) @ powers
            keys = keys + (np.arange(bands, dtype=np.int64) << bits)
            yield pd.DataFrame(
                {
                    "id": part["id"].to_numpy(),
                    "n": part["n"].to_numpy(),
                    "size": int(size),
                    "vector": list(part["vector"]),
                    "code": [row.tobytes() for row in np.packbits(signs, axis=1)],
                    "factor": factor,
                    "keys": list(keys),
                }
            )


def _pairs_in_runs(group: np.ndarray, side: np.ndarray, crossing: np.ndarray):
    """Index pairs of rows with the same group, in blocks; across sides where crossing."""
    for step in range(1, len(group)):
        same = group[step:] == group[:-step]
        if not same.any():
            break
        same &= ~crossing[step:] | (side[step:] != side[:-step])
        left = np.flatnonzero(same)
        if len(left):
            yield left, left + step


def _linked(batches: Iterator[pd.DataFrame], bits: int, bands: int, cosine: float) -> Iterator[pd.DataFrame]:
    """Links found in buckets: ``(id, partner count)`` rows and a spanning forest of links.

    Rows come sorted by bucket; what may belong to an unfinished bucket is carried over.
    """
    width = bits * bands
    rotations = _Rotations(width)
    held: pd.DataFrame | None = None
    columns = ["bucket", "pair"]

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        group = rows.groupby(columns, sort=False).ngroup().to_numpy()
        ids, copies = rows["id"].to_numpy(), rows["n"].to_numpy()
        size = rows["size"].to_numpy()
        signs = np.unpackbits(np.stack([np.frombuffer(c, np.uint8) for c in rows["code"]]), axis=1)
        signs = signs[:, :width].astype(bool)
        band = (rows["bucket"].to_numpy() >> bits).astype(np.int64)
        factor = rows["factor"].to_numpy()
        keys = np.packbits(signs.reshape(len(rows), bands, bits), axis=2)
        unit = np.zeros((len(rows), int(size.max())))
        rotated = np.zeros((len(rows), width), np.float32)
        for s in np.unique(size):
            at = np.flatnonzero(size == s)
            unit[at, :s] = _unit(np.stack(rows["vector"].to_numpy()[at]))
            rotated[at] = unit[at, :s] @ rotations[int(s)].T
        out = []
        for left, right in _pairs_in_runs(group, rows["side"].to_numpy(), rows["crossing"].to_numpy()):
            left, right = left[size[left] == size[right]], right[size[left] == size[right]]
            for i in range(0, len(left), 20_000):
                a, b = left[i : i + 20_000], right[i : i + 20_000]
                code = np.where(signs[a], np.float32(1), np.float32(-1))
                estimate = np.einsum("ij,ij->i", code, rotated[b]) / math.sqrt(width) / factor[a]
                error = np.sqrt(np.maximum(1.0 / factor[a] ** 2 - 1.0, 0.0) / (width - 1))
                maybe = estimate + CONFIDENCE * error >= cosine
                a, b = a[maybe], b[maybe]
                exact = np.einsum("ij,ij->i", unit[a], unit[b]) >= cosine
                a, b = a[exact], b[exact]
                # A pair counts in the first stretch where its codes are equal.
                equal = (keys[a] == keys[b]).all(axis=2)
                first = equal.argmax(axis=1) == band[a]
                out.append((a[first], b[first]))
        if not out:
            return pd.DataFrame({"kind": [], "a": [], "b": []})
        a, b = (np.concatenate(x) for x in zip(*out))
        counts = np.bincount(a, weights=copies[b], minlength=len(rows))
        counts += np.bincount(b, weights=copies[a], minlength=len(rows))
        some = np.flatnonzero(counts)
        forest = _forest(ids[a], ids[b])
        return pd.DataFrame(
            {
                "kind": np.r_[np.zeros(len(some), np.int32), np.ones(len(forest), np.int32)],
                "a": np.r_[ids[some], forest[:, 0]],
                "b": np.r_[counts[some].astype(np.int64), forest[:, 1]],
            }
        )

    for batch in batches:
        rows = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = rows.iloc[-1]
        open_ = (rows["bucket"] == last["bucket"]) & (rows["pair"] == last["pair"])
        held, done = rows[open_].reset_index(drop=True), rows[~open_].reset_index(drop=True)
        if len(done):
            yield work(done)
    if held is not None and len(held):
        yield work(held)


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Links that connect what the links ``a[i], b[i]`` connect, one fewer than ids at most."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            kept.append((x, y))
    return np.array(kept, np.int64).reshape(-1, 2)


def _usable(vector: F.Column) -> F.Column:
    fine = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(fine & some, F.lit(False))


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` of every vector.

    Two vectors are linked if their cosine is at least ``cosine``.  Null and zero
    vectors, and those with null or non-finite components, are linked with nothing;
    neither are vectors of different lengths.  Equal vectors are compared once and
    count as often as they occur.  A bucket beyond ``CHUNK`` vectors is compared by
    pairs of chunks, so no task holds all of it.  Repeated rows count once; a vec_id
    with several vectors has a row for each; rows without a vec_id are left out.
    Columns other than vec_id and embedding are not looked at.
    """
    rows = vectors.where("vec_id IS NOT NULL").select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    keyed = rows.select("vec_id", "vector", *content_keys(F.col("vector")))
    light = keyed.select("vec_id", "k1", "k2", _usable(F.col("vector")).alias("usable")).distinct()
    light = Written(light, "vector-keys").df
    classes = light.where("usable").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("n")
    )
    classes = Written(classes, "vector-classes").df
    heads = keyed.join(classes, ["k1", "k2"]).where(F.col("vec_id") == F.col("id"))
    heads = heads.select("id", "n", "vector").dropDuplicates(["id", "n", "vector"])
    bits, bands = bands_for(classes.count(), cosine)
    schema = (
        "id long, n long, size int, vector array<double>, code binary, factor double, keys array<long>"
    )
    coded = Written(heads.mapInPandas(lambda b: _coded(b, bits, bands), schema), "codes").df
    members = coded.select("id", "size", F.explode("keys").alias("bucket"))
    sizes = members.groupBy("bucket", "size").agg(F.count("*").alias("m")).where("m > 1")
    shared = members.join(sizes.hint("rebalance"), ["bucket", "size"])
    chunks = F.ceil(F.col("m") / CHUNK).cast("long")
    chunk = F.pmod(F.xxhash64("id"), chunks)
    others = F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("other")
    dealt = shared.select("id", "bucket", chunks.alias("chunks"), chunk.alias("side"), others)
    low, high = F.least("side", "other"), F.greatest("side", "other")
    dealt = dealt.select(
        "id", "bucket", "side", (low * F.col("chunks") + high).alias("pair"), (low != high).alias("crossing")
    )
    blocks = dealt.join(coded.drop("keys"), "id")
    parts = max(1, vectors.sparkSession.sparkContext.defaultParallelism * 2)
    found = (
        blocks.repartition(parts, "bucket", "pair")
        .sortWithinPartitions("bucket", "pair")
        .mapInPandas(lambda b: _linked(b, bits, bands, cosine), "kind int, a long, b long")
    )
    found = Written(found, "vector-links").df
    counts = found.where("kind = 0").groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("others"))
    linked = components(found.where("kind = 1").select("a", "b"))
    placed = classes.join(counts, "id", "left").join(linked, "id", "left").select(
        "k1",
        "k2",
        (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    placed = Written(placed, "vector-places").df
    usable = light.where("usable").join(placed, ["k1", "k2"]).select("vec_id", "n_links", "component_id")
    alone = light.where("NOT usable").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    both = usable.union(alone)
    return both.withColumn("kept", F.col("vec_id") == F.col("component_id"))
