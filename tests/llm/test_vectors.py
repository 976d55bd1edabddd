"""Nearest neighbours against brute force in double precision."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reportmart.llm import vector_search
from reportmart.llm.vector_search import Block, nearest

SCHEMA = "vec_id long, embedding array<float>, id string, dim string, block string"


def brute(rows, query_ids, k):
    usable = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        v = [float(np.float32(x)) for x in v]
        usable[i] = min(v, usable.get(i, v))
    found = []
    for q in sorted(query_ids & usable.keys()):
        a = usable[q]
        scored = []
        for c, b in usable.items():
            if c != q and len(a) == len(b):
                dot = sum(x * y for x, y in zip(a, b))
                scored.append((dot / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b)), c))
        scored.sort(key=lambda s: (-round(s[0], 12), s[1]))
        found += [(q, rank, c, round(s, 9)) for rank, (s, c) in enumerate(scored[:k], 1)]
    return found


@pytest.mark.parametrize("block, query_block", [(2048, 512), (7, 3)])
def test_neighbours(spark, block, query_block):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(150)]
    same = [rng.gauss(0, 1) for _ in range(16)]
    rows += [(200 + i, same) for i in range(30)]  # ties
    rows += [(300 + i, [2.0**-60 * x for x in same]) for i in range(3)]
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [float("nan")] * 16), (404, [None] * 16)]
    rows += [(405, [float("inf")] + [1.0] * 15), (None, same), (10, rows[10][1])]
    rows += [(500, [1.0, 2.0]), (501, [2.0, 1.0]), (502, [3.0])]  # other dimensions
    vectors = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA)
    queries = vectors.where("vec_id % 10 = 0 or vec_id >= 400")
    asked = {i for i, _ in rows if i is not None and (i % 10 == 0 or i >= 400)}
    found = nearest(vectors, queries, block=block, query_block=query_block).collect()
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in found)
    assert got == brute(rows, asked, 5)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, [1.0], "", "", "")], SCHEMA)
    for a, b in ((none, none), (some, none), (none, some), (some, some)):
        assert nearest(a, b).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(2)
    vecs = rng.normal(size=(60, 24)) * rng.choice([1e-6, 1, 1e6], size=(60, 1))
    a = Block(24, np.arange(60).tobytes(), vecs.tobytes())
    least, most = a.bounds(a)
    unit = vecs / np.linalg.norm(vecs, axis=1)[:, None]
    assert (least <= unit @ unit.T).all() and (unit @ unit.T <= most).all()
    assert (most - least).max() < 0.1


def test_blocks_are_not_broadcast(spark):
    """The planner takes the blocks of queries, one copy for each block of candidates, for a
    few kilobytes."""
    vectors = spark.createDataFrame([(i, [1.0, float(i)], "", "", "") for i in range(20)], SCHEMA)
    found = nearest(vectors, vectors.where("vec_id % 5 = 0"), block=4, query_block=2)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("other", ["array<float>", "array<double>"])
def test_many_parts(spark, monkeypatch, other):
    """Several parts, dimensions and blocks, also with queries of another type."""
    monkeypatch.setattr(vector_search, "PART", 40)
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(rng.choice([3, 4]))]) for i in range(90)]
    vectors = spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA)
    queries = vectors.where("vec_id % 3 = 0").withColumn("embedding", F.col("embedding").cast(other))
    found = nearest(vectors, queries, block=5, query_block=4).collect()
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in found)
    assert got == brute(rows, {i for i, _ in rows if i % 3 == 0}, 5)
