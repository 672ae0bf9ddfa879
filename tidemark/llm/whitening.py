"""Embedding whitening: principal components refined from float32 to double precision.

Entries become integers ``x = floor(1024 * c) + 100000``, so the fit is exact: counts and
sums are integers, and the scatter matrix is gathered about the integer nearest to the
mean, in matrix products small enough to be exact and totals kept as two doubles.  Only
matrices of the vectors' length leave a task; they are merged in a tree of tasks.

The covariance is decomposed in float32, which is cheap, and the result is corrected by
the matrix-multiplication iteration of Ogita and Aishima, whose residuals are formed in
about twice double precision.  Eigenvalues too close for the iteration to tell apart are
solved again by themselves, in the space their vectors span.

Rows whose vector is null, or holds a null, a non-finite value or one beyond
``LARGEST``, are left out, and so are vectors whose length is not the most frequent one
(of equally frequent ones the smallest).  Every other row takes part, however often it
is repeated; a null ``vec_id`` stays null.  Of an empty table nothing comes.  Components
without variance cannot be whitened and are left out.  Columns other than ``vec_id`` and
``embedding`` make no difference.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import Written

SCALE, SHIFT = 1024.0, 100_000
#: Entries up to this size have an ``x`` that a double holds exactly.
LARGEST = float(2**42)
COMPONENTS = 8
#: Tasks of the last but one round of merging.
FAN_IN = 32
_EPS = float(np.finfo(np.float64).eps)


# --- exact arithmetic -------------------------------------------------------------------


def _two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a + b`` and its rounding error."""
    total = a + b
    part = total - a
    return total, (a - (total - part)) + (b - part)


def _added(pair: tuple[np.ndarray, np.ndarray], high: np.ndarray, low=0.0) -> tuple[np.ndarray, np.ndarray]:
    """A sum held as two doubles, and one more term."""
    total, error = _two_sum(pair[0], high)
    return _two_sum(total, pair[1] + error + low)


def _slices(a: np.ndarray, bits: int, count: int) -> list[np.ndarray]:
    """Matrices that add up to ``a``, each with at most ``bits`` bits below its row's largest."""
    parts, rest = [], a
    for _ in range(count - 1):
        top = np.abs(rest).max(axis=1, keepdims=True)
        unit = np.exp2(np.ceil(np.log2(np.where(top > 0, top, 1.0))) + 53 - bits)
        part = (rest + unit) - unit
        parts.append(part)
        rest = rest - part
    return [*parts, rest]


def product(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``a @ b`` as two doubles: products of slices with few enough bits to be exact."""
    bits = (53 - int(np.ceil(np.log2(max(a.shape[1], 2))))) // 2
    left = _slices(a, bits, 4)
    right = [part.T for part in _slices(np.ascontiguousarray(b.T), bits, 4)]
    out = (np.zeros((a.shape[0], b.shape[1])), np.zeros((a.shape[0], b.shape[1])))
    for level in range(6, -1, -1):
        for i in range(max(0, level - 3), min(level, 3) + 1):
            out = _added(out, left[i] @ right[level - i])
    return out


# --- eigenvectors -----------------------------------------------------------------------


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """One step towards orthonormal columns, from a Gram matrix in higher precision."""
    high, low = product(np.ascontiguousarray(x.T), x)
    return x + x @ (((np.eye(x.shape[1]) - high) - low) / 2.0)


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of at least two eigenvalues (by size) whose neighbours are at most ``gap`` apart."""
    order = np.argsort(values, kind="stable")
    ends = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [run for run in np.split(order, ends) if len(run) > 1]


def refine(v: np.ndarray, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix.

    Starts from float32.  Each step forms the residuals ``R = I - X'X`` and ``S = X'VX`` in
    higher precision and corrects ``X`` by a matrix product.  A correction divides by the
    difference of two eigenvalues; where that is below the error of the estimate, the
    vectors are only made orthogonal, and the cluster is solved by itself: ``V`` less the
    cluster's mean eigenvalue, in the cluster's space, is small there and keeps digits
    that are lost next to the large mean.
    """
    size = len(v)
    scale = float(np.abs(v).max()) if size else 0.0
    if not scale:
        return np.zeros(size), np.eye(size)
    a = v / 2.0 ** np.ceil(np.log2(scale))
    unit = np.eye(size)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    x, best, since = _orthonormal(_orthonormal(x)), np.inf, 0
    for _ in range(steps):
        xt = np.ascontiguousarray(x.T)
        gram = product(xt, x)
        r = (unit - gram[0]) - gram[1]
        ax = product(a, x)
        s, s_low = product(xt, ax[0])
        s_low = s_low + xt @ ax[1]
        values = (np.diag(s) + np.diag(s_low)) / (1.0 - np.diag(r))
        off = (s - np.diag(np.diag(s))) + (s_low - np.diag(np.diag(s_low)))
        error = np.linalg.norm(off) + np.abs(values).max() * np.linalg.norm(r)
        close = np.abs(values[None, :] - values[:, None]) <= 2.0 * error
        difference = np.where(close, 1.0, values[None, :] - values[:, None])
        e = np.where(close, r / 2.0, (off + values[None, :] * r) / difference)
        x = x + x @ e
        for run in _clusters(values, 2.0 * error):
            x[:, run] = _subsolve(a, _orthonormal(x[:, run]), values[run])
        # As good as rounding of X allows: no step makes it better any more.
        since = 0 if error < best / 2.0 else since + 1
        best = min(best, error)
        if since == 2:
            break
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    lead = x[np.abs(x).argmax(axis=0), np.arange(size)]
    return values[order] * 2.0 ** np.ceil(np.log2(scale)), x * np.where(lead < 0, -1.0, 1.0)


def _subsolve(a: np.ndarray, q: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The cluster's space, turned to the eigenvectors of the shifted matrix in it."""
    qt = np.ascontiguousarray(q.T)
    high, low = product(a, q)
    centre = float(values.mean())
    shifted = _added((high, low), -centre * q)
    small = product(qt, shifted[0])
    inner = small[0] + (small[1] + qt @ shifted[1])
    inner = (inner + inner.T) / 2.0
    top = np.abs(inner).max()
    return q @ np.linalg.eigh(inner / top)[1] if top > 0 else q


# --- distributed sums -------------------------------------------------------------------


def _usable(length: int) -> F.Column:
    """Rows whose vector has the length and only entries that count; nulls are not."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST)
    vector = F.col("embedding")
    return vector.isNotNull() & (F.size(vector) == length) & F.forall(vector, entry)


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, length)


def _integers(column: pa.Array, length: int) -> np.ndarray:
    return np.floor(SCALE * _matrix(column, length)) + SHIFT


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, rows = None, 0
    for batch in batches:
        for n, high, low in zip(*(batch.column(c) for c in ("n", "high", "low")), strict=True):
            h, w = (np.frombuffer(b.as_py()) for b in (high, low))
            total = _added(total or (np.zeros(len(h)), np.zeros(len(h))), h, w)
            rows += n.as_py()
    if total is not None:
        yield _row(rows, total)


_SUMS = "n long, high binary, low binary"


def _row(rows: int, total: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
    data = {"n": [rows], "high": [total[0].tobytes()], "low": [total[1].tobytes()]}
    return pa.RecordBatch.from_pydict(data, pa.schema([("n", pa.int64()), ("high", pa.binary()), ("low", pa.binary())]))


def _summed(rows: DataFrame, size: int, term: Callable[[pa.Array], Iterator[np.ndarray]]):
    """Rows, and the sum of the ``size`` numbers of each exact ``term`` of a vector column.

    Each task sends one sum; the shuffle's tasks, ``FAN_IN`` tasks and one task merge them
    in turn.  A task reads sums one after the other and never holds more than two.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = (np.zeros(size), np.zeros(size)), 0
        for batch in batches:
            n += batch.num_rows
            for exact in term(batch.column(0)) if batch.num_rows else ():
                total = _added(total, exact)
        if n:
            yield _row(n, total)

    key = F.xxhash64("high", "low", "n")
    sums = rows.mapInArrow(partial, _SUMS).repartition(key).mapInArrow(_merged, _SUMS)
    sums = sums.repartition(FAN_IN, key).mapInArrow(_merged, _SUMS)
    got = sums.coalesce(1).mapInArrow(_merged, _SUMS).collect()
    if not got:
        return 0, (np.zeros(size), np.zeros(size))
    return got[0]["n"], (np.frombuffer(got[0]["high"]), np.frombuffer(got[0]["low"]))


def _scatter_terms(y: np.ndarray) -> Iterator[np.ndarray]:
    """``y'y`` of whole numbers in products that a double holds exactly, upper half."""
    upper = np.triu_indices(y.shape[1])
    top = max(float(np.abs(y).max(initial=0.0)), 1.0)
    most = int(2.0**53 / (top * top))
    if most >= 1:
        for start in range(0, len(y), min(most, 65_536)):
            part = y[start : start + min(most, 65_536)]
            yield (part.T @ part)[upper]
    else:  # Thirds of the digits: each product of two of them is exact by itself.
        for row in y:
            low, most_of = np.remainder(row, 2.0**18), np.remainder(row, 2.0**36)
            thirds = (row - most_of, most_of - low, low)
            for part in (np.outer(a, b) for a in thirds for b in thirds):
                yield part[upper]


@dataclass(frozen=True)
class Whitener:
    """Exact statistics and refined components of a fit."""

    length: int
    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    vectors: np.ndarray  # columns
    trace: float

    @property
    def components(self) -> int:
        return self.vectors.shape[1]


def fit(table: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Fit on every usable vector; None if there is none.

    Two passes: sums first, then the scatter matrix about the integer nearest to the mean.
    The driver holds matrices of the vectors' length, never rows.
    """
    common = table.where("embedding IS NOT NULL").groupBy(F.size("embedding").alias("length"))
    common = common.agg(F.count("*").alias("n")).where("length > 0")
    first = common.orderBy(F.desc("n"), "length").first()
    if first is None:
        return None
    length = first["length"]
    rows = table.where(_usable(length)).select("embedding")
    n, (high, low) = _summed(rows, length, lambda c: _column_sums(_integers(c, length)))
    if not n:
        return None
    sums = tuple(int(h) + int(w) for h, w in zip(high, low, strict=True))
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.float64)
    half = length * (length + 1) // 2
    _, scatter = _summed(rows, half, lambda c: _scatter_terms(_integers(c, length) - centre))
    v = covariance(n, sums, centre, scatter)
    values, vectors = refine(v)
    trace = float(np.trace(v))
    used = int((values[:components] > trace * length * 4 * _EPS).sum()) if trace > 0 else 0
    return Whitener(length, n, sums, values[:used], vectors[:, :used], trace)


def _column_sums(x: np.ndarray) -> Iterator[np.ndarray]:
    # 4096 numbers of up to 2^51 may pass 2^53; their halves may not.
    low = np.remainder(x, 2.0**26)
    for start in range(0, len(x), 4096):
        yield (x - low)[start : start + 4096].sum(axis=0)
        yield low[start : start + 4096].sum(axis=0)


def covariance(n: int, sums: tuple[int, ...], centre: np.ndarray, scatter) -> np.ndarray:
    """``V`` from a scatter matrix about ``centre``, exact up to the last rounding."""
    length = len(sums)
    off = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    v = np.zeros((length, length))
    for (i, j), h, w in zip(zip(*np.triu_indices(length), strict=True), *scatter, strict=True):
        exact = n * (int(h) + int(w)) - off[i] * off[j]
        v[i, j] = v[j, i] = exact / (n * n)
    return v


# --- transform --------------------------------------------------------------------------


def whitened(table: DataFrame, model: Whitener) -> DataFrame:
    """``(vec_id, deviation, whitened)`` of every usable row.

    ``deviation`` is the exact ``sum((n*x - S)^2)`` as decimal(38, 0), null beyond that;
    ``whitened`` has one number for each component.
    """
    n, length = model.n, model.length
    centre = [s // n for s in model.sums]
    rest = np.array([(s - c * n) / n for s, c in zip(model.sums, centre, strict=True)])
    near = np.array(centre, dtype=np.float64)
    turn = model.vectors / np.sqrt(model.eigenvalues)
    sums = model.sums

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.float64())
        for batch in batches:
            if not batch.num_rows:
                continue
            y = _integers(batch.column(1), length) - near
            values = (y - rest) @ turn
            offsets = np.arange(batch.num_rows + 1, dtype=np.int32) * turn.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_deviations(y, near, n, sums)), lists.cast(kind)],
                ["vec_id", "deviation", "whitened"],
            )

    kind = table.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, deviation string, whitened array<double>"
    out = table.where(_usable(length)).select("vec_id", "embedding").mapInArrow(transform, schema)
    return out.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))


def _deviations(y: np.ndarray, near: np.ndarray, n: int, sums: tuple[int, ...]) -> list[str]:
    """``sum((n*x - S)^2)`` for the rows ``x = y + near``, in whole numbers."""
    less = [s - n * int(c) for s, c in zip(sums, near, strict=True)]
    top = float(np.abs(y).max(initial=0.0)) * n + max(map(abs, less), default=0)
    if top * top * y.shape[1] < 2.0**62:
        d = y.astype(np.int64) * n - np.array(less, dtype=np.int64)
        return [str(s) for s in (d * d).sum(axis=1).tolist()]
    rows = y.astype(np.int64).tolist()
    return [str(sum((n * v - s) ** 2 for v, s in zip(row, less, strict=True))) for row in rows]


def identity_error(rows: DataFrame, components: int) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity.

    ``rows`` has ``whitened``; its mean first, then products of what is left of it.
    """
    vectors = rows.select("whitened")
    n, (high, low) = _summed(vectors, components, lambda c: [_matrix(c, components).sum(axis=0)])
    if not n:
        return 0.0
    mean = (high + low) / n
    upper = np.triu_indices(components)

    def products(column: pa.Array) -> Iterator[np.ndarray]:
        y = _matrix(column, components) - mean
        yield (y.T @ y)[upper]

    _, (high, low) = _summed(vectors, len(upper[0]), products)
    return float(np.abs((high + low) / n - np.eye(components)[upper]).max())


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row for each usable row and component, numbered from 1 by falling variance.

    ``(vec_id, component, n, deviation, whitened, explained, identity_error)``; the
    whitened rows are written once, measured, and read back.
    """
    spark = table.sparkSession
    kind = table.schema["vec_id"].dataType.simpleString()
    model = fit(table, components)
    if model is None or not model.components:
        schema = (
            f"vec_id {kind}, component int, n long, deviation decimal(38,0), "
            "whitened double, explained double, identity_error double"
        )
        return spark.createDataFrame([], schema)
    rows = Written(whitened(table, model), "whitened").df
    error = identity_error(rows, model.components)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
    spread = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return spread.select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
