import math

import numpy as np
import pytest

from tidemark.llm import near_vectors as nv

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, cosine=0.95):
    good = {}
    for vec_id, vector, *_ in rows:
        fine = vector is not None and all(x is not None and math.isfinite(x) for x in vector)
        if fine and any(vector):
            v = np.array(vector, dtype=np.float32).astype(float)
            good[vec_id] = v / np.linalg.norm(v)
    links = {r[0]: set() for r in rows}
    ids = sorted(good)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if len(good[a]) == len(good[b]) and good[a] @ good[b] >= cosine:
                links[a].add(b)
                links[b].add(a)
    out = []
    for start in links:
        seen, todo = {start}, [start]
        while todo:
            for other in links[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        out.append((start, len(links[start]), min(seen), min(seen) == start))
    return sorted(out)


def noisy(rng, base, spread):
    return (base + rng.normal(0, spread, len(base))).tolist()


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows, vec_id = [], 0
    for _ in range(12):
        base = rng.normal(0, 1, 24)
        for _ in range(int(rng.integers(1, 7))):
            rows.append((vec_id, noisy(rng, base, 0.12), 0))
            vec_id += 1
    rows += [(vec_id + i, rows[3][1], 1) for i in range(4)]
    found = nv.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, found.collect())) == brute_force(rows)


def test_unusable_vectors_link_with_nothing(spark):
    rows = [
        (1, [1.0, 0.0], 0),
        (2, [2.0, 0.0], 0),
        (3, [0.0, 0.0], 0),
        (4, None, 0),
        (5, [1.0, None], 0),
        (6, [float("nan"), 1.0], 0),
        (7, [float("inf"), 1.0], 0),
        (8, [], 0),
        (9, [1.0, 0.0, 0.0], 0),
        (1, [1.0, 0.0], 0),
        (None, [1.0, 0.0], 0),
    ]
    found = nv.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    table = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found}
    assert len(found) == 9
    assert table[1] == (1, 1, True) and table[2] == (1, 1, False)
    assert all(table[i] == (0, i, True) for i in range(3, 10))


def test_empty_table(spark):
    assert nv.near_duplicate_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_large_buckets_are_compared_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(nv, "CHUNK", 8)
    rng = np.random.default_rng(6)
    base = rng.normal(0, 1, 16)
    rows = [(i, noisy(rng, base, 0.08), 0) for i in range(40)]
    found = nv.near_duplicate_vectors(spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, found.collect())) == brute_force(rows)


def test_estimates_are_unbiased_within_their_bound():
    rng = np.random.default_rng(7)
    width = 512
    turn = nv.rotation(32, width)
    x = rng.normal(0, 1, (400, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + rng.normal(0, 0.1, x.shape)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    assert np.allclose(np.linalg.norm(x @ turn.T, axis=1), 1.0)
    rotated = x @ turn.T
    factor = np.abs(rotated).sum(axis=1) / math.sqrt(width)
    code = np.where(rotated > 0, 1.0, -1.0) / math.sqrt(width)
    estimate = np.einsum("ij,ij->i", code, y @ turn.T) / factor
    exact = np.einsum("ij,ij->i", x, y)
    error = np.sqrt(1 / factor**2 - 1) / math.sqrt(width - 1)
    assert abs((estimate - exact).mean()) < 0.01
    assert (np.abs(estimate - exact) <= nv.CONFIDENCE * error).all()


@pytest.mark.parametrize("rows", [10, 50_000, 10**9])
def test_stretches_keep_the_chance_of_a_miss(rows):
    bits, bands = nv.bands_for(rows)
    same = (1 - math.acos(0.95) / math.pi) ** bits
    assert (1 - same) ** bands <= nv.MISSED
