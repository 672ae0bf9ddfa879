import numpy as np
import pytest
from fractions import Fraction

from tidemark.llm import catalog, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n int, whitened string"


def brute_force(vectors, components=8):
    x = np.floor(1024.0 * np.asarray(vectors, dtype=np.float64)) + 100_000
    n, sums = len(x), [int(s) for s in x.astype(object).sum(axis=0)]
    y = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    order = np.argsort(-values)[:components]
    white = y @ vectors[:, order] / np.sqrt(values[order])
    deviation = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
    return n, deviation, white, values[order] / values.sum()


def compared(rows, ids, vectors):
    n, deviation, white, explained = brute_force(vectors)
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) == len(ids) * len(explained)
    for c in range(len(explained)):
        mine = np.array([got[i, c + 1].whitened for i in ids])
        sign = np.sign(mine @ white[:, c])
        assert np.abs(mine * sign - white[:, c]).max() < 1e-8
    for at, i in enumerate(ids):
        r = got[i, 1]
        assert (r.n, r.deviation) == (n, deviation[at])
        assert r.explained == pytest.approx(explained[0], rel=1e-9)
        assert r.identity_error < 1e-9


def test_query_equals_brute_force(spark, sf_dir):
    rows = catalog.QUERIES["op13_whitening"](spark, sf_dir)
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    assert dict(rows.dtypes)["deviation"] == "bigint" and dict(rows.dtypes)["component"] == "int"
    compared(rows.collect(), [r.vec_id for r in table], [r.embedding for r in table])


def test_rows_without_a_usable_vector_are_left_out(spark):
    rng = np.random.default_rng(3)
    good = rng.normal(size=(40, 12)).astype(np.float32)
    rows = [(i, [float(c) for c in v], 0, 1, "x") for i, v in enumerate(good)]
    bad = [None, [], [0.5] * 11 + [None], [0.5] * 11 + [float("nan")], [float("inf")] * 12, [1.0]]
    rows += [(100 + i, v, None, None, None) for i, v in enumerate(bad)]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    compared(out, list(range(40)), good)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(7, [1.0, 2.0], 0, 0, "")] * 3 + [(None, [4.0, 1.0], 0, 0, ""), (8, [0.0, 0.5], 0, 0, "")]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA))
    assert [r.vec_id for r in out.collect()].count(7) == 6
    assert out.where("vec_id IS NULL").count() == 2
    for nothing in ([], [(1, None, 0, 0, "")], [(1, [2.0, 3.0], 0, 0, "")] * 4):
        assert whitening.whiten(spark.createDataFrame(nothing, SCHEMA)).count() == 0


@pytest.mark.parametrize("size", [1.0, 1e6, 4e12])
def test_sums_are_exact_for_entries_of_any_size(spark, size):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(30, 3)) * size / 8).astype(np.float32)
    table = spark.createDataFrame([(i, [float(c) for c in v], 0, 0, "") for i, v in enumerate(vectors)], SCHEMA)
    model = whitening.fit(table.repartition(5))
    x = [[int(np.floor(1024.0 * float(c))) + 100_000 for c in v] for v in vectors]
    assert model.sums == tuple(map(sum, zip(*x)))
    mean = [Fraction(s, 30) for s in model.sums]
    exact = sum(float(sum((row[i] - mean[i]) ** 2 for row in x) / 30) for i in range(3))
    assert model.trace == pytest.approx(exact, rel=1e-15)


def eigen_case(kind, d=32):
    rng = np.random.default_rng(kind)
    values = {
        0: rng.uniform(1, 100, d),
        1: np.r_[50 + np.arange(6) * 1e-9, rng.uniform(1, 10, d - 6)],
        2: np.r_[np.full(6, 50.0), rng.uniform(1, 10, d - 12), np.zeros(6)],
        3: 1e5 * np.exp(-np.arange(d) / 1.5),
    }[kind]
    q = np.linalg.qr(rng.normal(size=(d, d)))[0]
    a = (q * values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("kind", range(4))
def test_refinement_reaches_double_precision(kind):
    a = eigen_case(kind)
    values, x = whitening.refine(a)
    wide, vectors = a.astype(np.longdouble), x.astype(np.longdouble)
    scale = np.abs(values).max()
    assert float(np.abs(wide @ vectors - vectors * values).max()) < 4e-16 * scale
    assert float(np.abs(vectors.T @ vectors - np.eye(len(a))).max()) < 4e-15
    assert (np.diff(values) <= 0).all()


def test_vectors_of_a_cluster_are_told_apart():
    a = eigen_case(1)
    values, x = whitening.refine(a)
    inner = x[:, :6].T.astype(np.longdouble) @ a.astype(np.longdouble) @ x[:, :6].astype(np.longdouble)
    assert float(np.abs(inner - np.diag(np.diag(inner))).max()) < 2e-14


def test_products_have_about_twice_double_precision():
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(20, 20)), rng.normal(size=(20, 20)) * 10.0 ** rng.integers(-6, 6, (1, 20))
    high, low = whitening.product(a, b)
    for i, j in ((0, 0), (3, 7), (19, 19)):
        exact = sum(Fraction(a[i, k]) * Fraction(b[k, j]) for k in range(20))
        assert abs(float(Fraction(high[i, j]) + Fraction(low[i, j]) - exact)) < 1e-22 * abs(b[:, j]).max()
