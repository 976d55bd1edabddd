"""Whitening, against a library's eigenvectors and exact whole numbers."""

import math
import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from reportmart.llm import whitening  # noqa: E402
from reportmart.llm.queries import QUERIES  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


def brute(rows, k=4):
    """(id, component) to what is expected, with the sign of ``whitened`` open."""
    rows = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    rows = [(i, [math.floor(256 * c) for c in v]) for i, v in rows]
    fit = sorted({tuple(x) for _, x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array(fit, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    found = []
    for i, x in rows:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for c in range(min(k, len(sums))):
            w = (np.array(x) - np.array(sums) / n) @ vectors[:, c] / math.sqrt(values[c])
            found.append((i, c + 1, n, deviation, w, values[c] / values.sum()))
    return found


def agrees(found, expected):
    key = lambda r: (r[0], r[1], r[3], abs(r[4]))
    found, expected = sorted(map(tuple, found), key=key), sorted(expected, key=key)
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    for c in {r[1] for r in expected}:
        mine = np.array([r[4] for r in found if r[1] == c])
        other = np.array([r[4] for r in expected if r[1] == c])
        sign = 1 if mine @ other > 0 else -1
        np.testing.assert_allclose(sign * mine, other, atol=1e-7)
    np.testing.assert_allclose([r[5] for r in found], [r[5] for r in expected], rtol=1e-9)
    assert all(0 <= r[6] <= 1e-9 for r in found)


def test_query_against_library(spark):
    given = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()
    rows = [(r.vec_id, None if r.embedding is None else list(r.embedding)) for r in given]
    agrees(QUERIES["op12_whitening"](spark, SF_DIR).collect(), brute(rows))


def test_rows_that_take_no_part_and_repeated_rows(spark):
    random = np.random.default_rng(3)
    rows = [(i, random.normal(size=6).tolist()) for i in range(50)]
    rows += [(7, rows[7][1]), (99, rows[8][1])]
    none = [(60, None), (61, []), (62, [1.0] * 5 + [None]), (63, [math.inf] * 6), (64, [math.nan] * 6)]
    none += [(65, [1e300] * 6), (66, [1.0, 2.0])]
    df = spark.createDataFrame(rows + none, "vec_id long, embedding array<double>")
    for name in ("id", "x", "n", "component", "d"):
        df = df.withColumn(name, df["vec_id"])
    agrees(whitening.whiten(df).collect(), brute(rows))


def test_tables_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 1.0])] * 2, schema)).collect()
    assert sorted(map(tuple, one)) == [(1, c, 1, 0, None, None, None) for c in (1, 1, 2, 2)]
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(5)]
    found = whitening.whiten(spark.createDataFrame(line, schema)).collect()
    assert {r.component for r in found if r.whitened is not None} == {1}
    assert all(r.explained == pytest.approx(1.0 if r.component == 1 else 0.0, abs=1e-12) for r in found)


def test_deviation_beyond_64_bits_on_the_way(spark):
    rows = [(i, [float(1 << 20) * (i % 2), 0.0]) for i in range(4)] + [(9, [1.0, 2.0])]
    rows += [(10, [2.0**40, 0.0])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    x = sorted({tuple(math.floor(256 * c) for c in v) for _, v in rows})
    sums = [sum(c) for c in zip(*x)]
    for r in found:
        v = [math.floor(256 * c) for c in dict(rows)[r.vec_id]]
        exact = sum((len(x) * c - s) ** 2 for c, s in zip(v, sums))
        assert r.deviation == (exact if exact < 1 << 63 else None)


@pytest.mark.parametrize("d", [1, 2, 3, 10, 64])
@pytest.mark.parametrize("kind", ["random", "equal", "cluster", "low rank", "split"])
def test_leading_eigenvectors(d, kind):
    random = np.random.default_rng(d)
    q, _ = np.linalg.qr(random.normal(size=(d, d)))
    values = {
        "random": random.uniform(0, 9, d),
        "equal": np.full(d, 3.0),
        "cluster": 5 + 1e-9 * np.arange(d),
        "low rank": np.where(np.arange(d) < 3, 7.0 - np.arange(d), 0),
        "split": np.repeat(np.arange(1, d + 1), 2)[:d].astype(float),
    }[kind]
    matrix = np.diag(values) if kind == "split" else (q * values) @ q.T
    k = min(4, d)
    found, vectors = whitening.leading((matrix + matrix.T) / 2, k)
    np.testing.assert_allclose(found, np.sort(values)[::-1][:k], atol=1e-12)
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(k), atol=1e-10)
    np.testing.assert_allclose(matrix @ vectors, vectors * found, atol=1e-10)
