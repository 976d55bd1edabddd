"""Nearest neighbours by a blocked matrix product over 8-bit integers.

Vectors are scaled to unit length and rounded to int8 with a scale of their own. For
x = q + e with rounded q and error e, the product of two unit vectors differs from that
of their rounded forms by at most |e1| + |e2| + |e1||e2|, so a tile of products gives a
lower and an upper bound of each cosine. A candidate survives in a tile unless its upper
bound is below the k-th largest lower bound of the query. Survivors are computed again
in double precision on the original vectors and go to a heap of k for each query. No
true neighbour is lost: the result is exact.

Candidates are dealt into parts of about ``PART`` components, one task each, and every
query goes to every part; there a block of queries meets one block of candidates after
the other. So vectors are shuffled once, queries once a part, and a task holds one part.
The heaps of the tasks are merged by rank.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.types import FloatType

from ..sources.staging import stage

BLOCK = 2048
QUERY_BLOCK = 512
#: Components of the candidates of a task, which it holds with 12 bytes each.
PART = 1 << 22


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``vec`` of the rows that take part, one for each id: vectors that are
    null, empty, zero, or hold a null or non-finite component, or whose squares have no
    finite sum above zero, take no part. Of several rows with one id the least vector
    does."""
    component = "float" if component_type(vectors, vector_col) is np.float32 else "double"
    vector = vectors[vector_col].cast(f"array<{component}>")
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), vector.alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    squares = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = rows.where("id is not null and size(vec) > 0").where(F.coalesce(finite, F.lit(False)))
    rows = rows.where((squares > 0) & (squares < float("inf")))
    return rows.groupBy("id").agg(F.min("vec").alias("vec"))


def component_type(vectors: DataFrame, vector_col: str) -> type:
    """What holds the components exactly: float32 where the column has floats, so that
    there are half the bytes to shuffle, else float64."""
    element = vectors.schema[vector_col].dataType.elementType
    return np.float32 if isinstance(element, FloatType) else np.float64


def blocks_of(
    batches: Iterator[pa.RecordBatch], sizes: tuple[int, int]
) -> Iterator[tuple[int, bool, Block]]:
    """Rows ``dim``, ``asks``, ``id``, ``vec`` that come in this order, as blocks of one dimension
    and side, of at most ``sizes`` candidates and queries, each with its dimension and side."""
    key: tuple = ()
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    n = 0

    def block() -> Iterator[tuple[int, bool, Block]]:
        if n:
            ids, vecs = (np.concatenate(side) for side in zip(*waiting))
            yield *key, Block(key[0], ids, vecs, vecs.dtype)
            waiting.clear()

    for whole in batches:
        dims = whole.column("dim").to_numpy(zero_copy_only=False)
        asks = whole.column("asks").to_numpy(zero_copy_only=False)
        changes = np.flatnonzero((dims[1:] != dims[:-1]) | (asks[1:] != asks[:-1])) + 1
        edges = [0, *changes.tolist(), whole.num_rows]
        for at, stop in zip(edges, edges[1:]):
            while at < stop:
                now = int(dims[at]), bool(asks[at])
                if now != key or n == sizes[now[1]]:
                    yield from block()
                    key, n = now, 0
                part = whole.slice(at, min(stop - at, sizes[now[1]] - n))
                ids, vecs = part.column("id").to_numpy(), part.column("vec").flatten().to_numpy()
                waiting.append((ids, vecs))
                at, n = at + len(ids), n + len(ids)
    yield from block()


class Block:
    """Vectors of a block with their rounded forms and error bounds."""

    def __init__(
        self,
        dim: int,
        ids: bytes | np.ndarray,
        vecs: bytes | np.ndarray,
        component: type | np.dtype = np.float64,
    ) -> None:
        self.ids = np.frombuffer(ids, np.int64)
        self.vecs = np.frombuffer(vecs, component).reshape(-1, dim).astype(np.float64)
        self.norms = np.sqrt((self.vecs * self.vecs).sum(axis=1))
        unit = self.vecs / self.norms[:, None]
        self.scale = np.abs(unit).max(axis=1) / 127
        quantised = np.rint(unit / self.scale[:, None]).astype(np.int8)
        rest = unit - quantised * self.scale[:, None]
        self.error = np.sqrt((rest * rest).sum(axis=1)) + 1e-12
        # Sums of int8 products are exact in float32 up to 1,000 components.
        self.tile = quantised.astype(np.float32 if dim <= 1000 else np.float64)

    def bounds(self, other: Block) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest possible cosines of this block's vectors with the other's."""
        product = (self.tile @ other.tile.T).astype(np.float64)
        product *= self.scale[:, None]
        product *= other.scale
        error = self.error[:, None] + other.error + self.error[:, None] * other.error
        return product - error, product + error


class Neighbours:
    """A heap of the k nearest found so far, for each query."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.heaps: dict[int, list[tuple[float, int]]] = {}

    def add(self, queries: Block, candidates: Block) -> None:
        least, most = queries.bounds(candidates)
        own = queries.ids[:, None] == candidates.ids
        least[own] = most[own] = -np.inf
        for row, query in enumerate(queries.ids.tolist()):
            heap = self.heaps.setdefault(query, [])
            floor = heap[0][0] if len(heap) == self.k else -np.inf
            if least.shape[1] > self.k:
                floor = max(floor, np.partition(least[row], -self.k)[-self.k])
            near = np.flatnonzero((most[row] >= floor) & ~own[row])
            if not len(near):
                continue
            products = (candidates.vecs[near] * queries.vecs[row]).sum(axis=1)
            scores = products / (candidates.norms[near] * queries.norms[row])
            if len(near) > self.k:  # ids ascend, so ties keep the smaller ones
                best = np.argsort(-scores, kind="stable")[: self.k]
                near, scores = near[best], scores[best]
            for score, vec in zip(scores.tolist(), candidates.ids[near].tolist()):
                item = (score, -vec)
                if len(heap) < self.k:
                    heapq.heappush(heap, item)
                elif item > heap[0]:
                    heapq.heapreplace(heap, item)

    def batch(self) -> pa.RecordBatch:
        found = [(q, -v, s) for q, heap in self.heaps.items() for s, v in heap]
        columns = zip(*found) if found else ((), (), ())
        types = (pa.int64(), pa.int64(), pa.float64())
        self.heaps = {}
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types)],
            names=["query_id", "vec_id", "score"],
        )


def n_parts(rows: DataFrame, block: int) -> int:
    """The number of parts of the candidates: enough for the cores if each gets a block, and
    for parts that fit a task."""
    found = rows.agg(F.count(F.lit(1)), F.sum(F.size("vec").cast("long"))).first()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return max(1, min(-(-found[0] // block), cores), -(-(found[1] or 0) // PART))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest cosine to each row of ``queries``,
    its own id left out: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``. Ties go
    to the smaller id. Queries with fewer candidates get all of them.

    Vectors meet those of their own dimension only; see ``usable`` for the rows that take
    no part. An empty table on either side gives an empty result."""
    rows = stage(usable(vectors, id_col, vector_col), "vectors")
    wanted = stage(usable(queries, id_col, vector_col), "query-vectors")
    parts = n_parts(rows, block)
    exact = component_type(vectors, vector_col), component_type(queries, vector_col)
    shipped = "array<float>" if exact == (np.float32, np.float32) else "array<double>"
    columns = F.size("vec").alias("dim"), F.col("id"), F.col("vec").cast(shipped).alias("vec")
    own = F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int").alias("part")
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    candidates = rows.select(own, F.lit(False).alias("asks"), *columns)
    asked = wanted.select(every, F.lit(True).alias("asks"), *columns)
    # Of each dimension the candidates come first; ids ascend.
    met = candidates.union(asked).repartitionById(parts, "part")
    met = met.sortWithinPartitions("dim", "asks", "id").select("dim", "asks", "id", "vec")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: tuple[int, list[Block]] = (0, [])
        for dim, asks, block_of in blocks_of(batches, (block, query_block)):
            if dim != here[0]:
                here = dim, []
            if not asks:
                here[1].append(block_of)
                continue
            found = Neighbours(k)
            for candidates in here[1]:
                found.add(block_of, candidates)
            yield found.batch()

    found = met.mapInArrow(search, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
