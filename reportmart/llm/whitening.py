"""Embeddings whitened along their leading principal components.

Entries become whole numbers (``floor(SCALE * entry)``), so counts, sums and deviations are
exact, and equal vectors are found by grouping. All statistics are those of the distinct
vectors, the fit list, which is written once:

1. their number and sums, added up in whole numbers;
2. their covariance: each task centres its vectors before it multiplies them, and sends one
   matrix; matrices are added up entry by entry;
3. on the driver, which gets a square matrix of the dimension and nothing that grows with the
   rows: Householder reflections to tridiagonal form, bisection by Sturm counts for the leading
   eigenvalues, inverse iteration for their vectors. Vectors of eigenvalues that lie close
   together are orthogonalised against each other;
4. every row is projected on the components, which travel with the task (dimension times
   components numbers).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..sources.staging import stage

SCALE = 256
COMPONENTS = 4
STEP = 4096
EPS = np.finfo(float).eps
LARGEST = np.iinfo(np.int64).max


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The diagonal, the entries beside it, and the orthogonal ``q`` with
    ``matrix = q @ t @ q.T``, by Householder reflections."""
    a = np.array(matrix, float)
    d = len(a)
    q = np.eye(d)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if np.linalg.norm(x[1:]) <= EPS * EPS * size or not size:
            continue
        x[0] += math.copysign(size, x[0])
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ x
        p -= (x @ p) * x
        rest -= 2 * (np.outer(x, p) + np.outer(p, x))
        a[k + 1 :, k] -= 2 * x * (x @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ x, x)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def below(diagonal: list[float], beside: list[float], x: float) -> int:
    """How many eigenvalues are less than ``x``: the negative terms of a Sturm sequence."""
    least = max(map(abs, beside), default=0.0) * EPS * EPS + np.finfo(float).tiny
    n, term = 0, 1.0
    for k, value in enumerate(diagonal):
        term = value - x - (beside[k - 1] ** 2 / term if k else 0.0)
        if abs(term) < least:
            term = -least
        n += term < 0
    return n


def eigenvalues(diagonal: np.ndarray, beside: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues, falling, by bisection."""
    around = np.abs(np.concatenate([[0], beside])) + np.abs(np.concatenate([beside, [0]]))
    least, most = float((diagonal - around).min()), float((diagonal + around).max())
    margin = EPS * max(abs(least), abs(most)) * len(diagonal) + np.finfo(float).tiny
    d, b = diagonal.tolist(), beside.tolist()
    found = []
    for number in range(1, count + 1):
        low, high = least - margin, (found[-1] if found else most) + margin
        while True:
            middle = (low + high) / 2
            if high - low <= 2 * EPS * max(abs(low), abs(high)) or not low < middle < high:
                break
            if len(d) - below(d, b, middle) >= number:
                low = middle
            else:
                high = middle
        found.append((low + high) / 2)
    return np.array(found)


def solver(diagonal: np.ndarray, beside: np.ndarray, shift: float) -> Callable[[np.ndarray], np.ndarray]:
    """Solves ``(t - shift) y = x`` by elimination with exchanged rows."""
    n = len(diagonal)
    size = np.abs(diagonal).max() + (2 * np.abs(beside).max() if n > 1 else 0)
    least = EPS * size + np.finfo(float).tiny
    main = (diagonal - shift).tolist()
    above, above2 = beside.tolist() + [0.0], [0.0] * n
    steps = []
    for k in range(n - 1):
        under = float(beside[k])
        swap = abs(under) > abs(main[k])
        if swap:
            main[k], under = under, main[k]
            above[k], main[k + 1] = main[k + 1], above[k]
            above2[k], above[k + 1] = above[k + 1], above2[k]
        if abs(main[k]) < least:
            main[k] = math.copysign(least, main[k])
        factor = under / main[k]
        main[k + 1] -= factor * above[k]
        above[k + 1] -= factor * above2[k]
        steps.append((swap, factor))
    if abs(main[-1]) < least:
        main[-1] = math.copysign(least, main[-1])

    def solve(x: np.ndarray) -> np.ndarray:
        y = x.tolist()
        for k, (swap, factor) in enumerate(steps):
            if swap:
                y[k], y[k + 1] = y[k + 1], y[k]
            y[k + 1] -= factor * y[k]
        for k in reversed(range(n)):
            if k + 1 < n:
                y[k] -= above[k] * y[k + 1]
            if k + 2 < n:
                y[k] -= above2[k] * y[k + 2]
            y[k] /= main[k]
        return np.array(y)

    return solve


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit vectors as
    columns. The largest entry of each vector is positive."""
    diagonal, beside, q = tridiagonal(matrix)
    values = eigenvalues(diagonal, beside, count)
    size = max(np.abs(diagonal).max(), np.abs(beside).max(initial=0.0))
    vectors = np.zeros((len(matrix), count))
    random = np.random.default_rng(0)
    cluster, shift = 0, math.inf
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * size:
            cluster = k
        # Equal eigenvalues get shifts of their own, so that each solution differs.
        shift = min(float(value), shift - 10 * EPS * size)
        solve = solver(diagonal, beside, shift)
        x = random.uniform(-1, 1, len(matrix))
        for _ in range(6):
            x = solve(x / np.abs(x).max())
            x /= np.abs(x).max()
            for _ in range(2):
                x -= vectors[:, cluster:k] @ (vectors[:, cluster:k].T @ x)
            x /= np.linalg.norm(x)
        vectors[:, k] = x
    vectors = q @ vectors
    vectors /= np.linalg.norm(vectors, axis=0)
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(count)]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)


def parts_of(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """A few rows at a time, and their vectors as a matrix."""
    for whole in batches:
        for at in range(0, whole.num_rows, STEP):
            part = whole.slice(at, STEP)
            entries = part.column(column).flatten().to_numpy()
            yield part, entries.reshape(part.num_rows, -1)


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``x`` of the rows without null or non-finite entries."""
    scaled = F.transform(vectors[vector_col], lambda c: F.floor(c.cast("double") * SCALE))
    finite = F.forall(
        vectors[vector_col],
        lambda c: c.isNotNull() & (F.abs(c.cast("double")) * SCALE < float(1 << 63)),
    )
    usable = vectors.where(F.coalesce(finite, F.lit(False)) & (F.size(vectors[vector_col]) > 0))
    return usable.select(vectors[id_col].alias("id"), scaled.cast("array<long>").alias("x"))


def whiten(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """``id_col``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained`` and
    ``identity_error`` of every remaining row and each leading component, from 1 on.

    ``n`` counts the fit list; ``deviation`` is the exact sum of the squares of
    ``n * x - sums``, null where it is no long. ``identity_error`` is the largest entry of
    the covariance of ``whitened`` over the fit list minus the identity.

    Vectors that are null or empty, hold null or non-finite entries or such as are no long
    when scaled, take no part; nor do vectors of another length than the commonest (of
    equally common lengths the largest). Rows that repeat an id, a null id included, are rows
    of their own; equal vectors count once. A component without variance has ``whitened``
    null; without any variance ``explained`` and ``identity_error`` are null too. An empty
    table gives an empty result. Other columns are not read."""
    rows = whole_vectors(vectors, id_col, vector_col)
    out = (
        f"`{id_col}` {vectors.schema[id_col].dataType.simpleString()}, component int, n long, "
        "deviation long, whitened double, explained double, identity_error double"
    )
    size = F.size("x").alias("d")
    common = rows.groupBy(size).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return vectors.sparkSession.createDataFrame([], out)
    d = common["d"]
    rows = rows.where(F.size("x") == d)
    fit = stage(rows.select("x").distinct(), "fit-list")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(d, np.int64)
        for _, x in parts_of(batches, 0):
            n += len(x)
            sums += x.sum(axis=0)
        columns = [pa.array([n]), pa.array([sums.tolist()], pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["n", "sums"])

    added = fit.mapInArrow(add_up, "n long, sums array<long>")
    entries = added.select("n", F.posexplode("sums").alias("i", "s")).groupBy("i")
    entries = entries.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("i").collect()
    n, sums = entries[0]["n"], np.array([r["s"] for r in entries], np.int64)
    mean = sums / n

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for _, x in parts_of(batches, 0):
            centred = x - mean
            total += centred.T @ centred
        places = pa.array(np.arange(d, dtype=np.int32))
        values = pa.array(total.tolist(), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([places, values], names=["i", "row"])

    products = fit.mapInArrow(multiply, "i int, row array<double>")
    products = products.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j")
    covariance = np.zeros((d, d))
    for r in products.agg(F.sum("v").alias("v")).collect():
        covariance[r["i"], r["j"]] = r["v"] / n
    covariance = (covariance + covariance.T) / 2

    k = min(components, d)
    values, axes = leading(covariance, k)
    trace = float(np.trace(covariance))
    varies = values > d * EPS * trace
    axes = np.where(varies, axes / np.sqrt(np.where(varies, values, 1.0)), np.nan)
    explained = [max(0.0, float(v)) / trace if trace > 0 else None for v in values]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in parts_of(batches, 0):
            w = (x - mean) @ axes
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in w.T], names=names)

    names = [f"w{i}" for i in range(k)]
    projected = fit.mapInArrow(project, ", ".join(f"{name} double" for name in names))
    pairs = [(i, j) for i in range(k) for j in range(i + 1) if varies[i] and varies[j]]
    error = None
    if pairs:
        found = projected.agg(*(F.covar_pop(names[i], names[j]) for i, j in pairs)).first()
        error = max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))

    def deviations(x: np.ndarray) -> list[int | None]:
        # Whole numbers of any size where 64 bits could be too few.
        most = n * max(int(x.max()), -int(x.min())) + int(np.abs(sums).max())
        kind = np.int64 if d * most * most <= LARGEST else object
        off = n * x.astype(kind) - sums.astype(kind)
        return [v if v <= LARGEST else None for v in (off * off).sum(axis=1).tolist()]

    def results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in parts_of(batches, 1):
            at = np.repeat(np.arange(len(x)), k)
            w = ((x - mean) @ axes).ravel()
            columns = [
                part.column(0).take(pa.array(at)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(len(at), n)),
                pa.array(deviations(x), pa.int64()).take(pa.array(at)),
                pa.array(w, mask=np.isnan(w)),
                pa.array(explained * len(x), pa.float64()),
                pa.array([error] * len(at), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=fields)

    fields = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return rows.mapInArrow(results, out)
