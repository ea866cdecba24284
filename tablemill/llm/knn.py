"""Exact top-k by inner product: best-first search in M-trees.

Vectors are scaled to integers, so scores are exact. Each block of rows becomes one M-tree whose pages are a row of a
table in the shared folder. For the metric, a vector x gets one more coordinate, sqrt(R^2 - |x|^2) with R the longest
norm of its tree; a query gets 0 there. Then the squared distance is |q|^2 + R^2 - 2 q.x, and the nearest are those with
the largest inner product. A node holds its routing vector, the covering radius and the distance to its parent's
routing vector; a leaf holds its rows and their distances to its routing vector. The stored distances and the triangle
inequality rule out nodes and rows before their distance to the query is computed.

Queries go in blocks of bounded size, each block against all trees; a task carries a query's best rows from tree to
tree, and the tasks' best rows meet by query. The index is exact: recall is 1.

Edge cases: vectors that are null, empty or hold a null or non-finite component take no part, and neither do rows with
a null id; only vectors of the query's length are its candidates; a row is no candidate of a query with its id; of
queries that share an id the smallest vector is asked; rows that repeat are ranked each; fewer rows than k give all;
scores beyond 64 bits are held at the bounds; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablemill.llm.common import Scratch, read

SCALE, TREE, PAGE, FAN, QUERIES = 1024, 8192, 64, 16, 1024
LARGEST = 1e200


def scaled(vectors: list[list[float | None] | None], scale: int = SCALE) -> list[np.ndarray | None]:
    """floor(scale * x) of each component, as whole doubles; None for vectors that take no part: null or empty ones, and
    those with a component that is null or not finite, before or after the scaling."""
    out = []
    for v in vectors:
        if v is None or not len(v) or any(x is None for x in v):
            out.append(None)
            continue
        with np.errstate(over="ignore"):
            x = np.floor(scale * np.asarray(v, np.float64))
        out.append(x if np.isfinite(x).all() else None)
    return out


def products(x: np.ndarray, q: np.ndarray) -> list[int] | np.ndarray:
    """Exact inner products of the rows of x with q."""
    if len(x) == 0:
        return np.zeros(0, np.int64)
    if x.shape[1] * float(np.abs(x).max()) * float(np.abs(q).max()) < 2**53:
        return (x @ q).astype(np.int64)
    whole = [int(b) for b in q]
    return np.array([min(max(sum(int(a) * b for a, b in zip(row, whole)), -(2**63)), 2**63 - 1) for row in x], np.int64)


class MTree:
    """Pages of one block of rows. Node 0 is the root. A block with a vector so long that distances are no numbers has no
    pages: all its rows are compared."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        with np.errstate(over="ignore"):
            self.longest = float((x * x).sum(axis=1).max())
        self.ids, self.x = ids, x
        self.flat = not self.longest < LARGEST
        if self.flat:
            return
        self.point = np.hstack([x, np.sqrt(np.maximum(self.longest - (x * x).sum(axis=1), 0))[:, None]])
        self.nodes: list[tuple] = []  # internal: (False, children, centers, radii, to parent); leaf: (True, rows, to center)
        self._grow(np.arange(len(ids)), self.point[0])
        del self.point

    def _grow(self, rows: np.ndarray, center: np.ndarray) -> int:
        me = len(self.nodes)
        self.nodes.append(())
        if len(rows) <= PAGE:
            self.nodes[me] = (True, rows, np.linalg.norm(self.point[rows] - center, axis=1))
            return me
        pivots = self._pivots(rows)
        p = self.point[rows]
        near = ((p * p).sum(axis=1)[:, None] - 2 * p @ pivots.T + (pivots * pivots).sum(axis=1)[None, :]).argmin(axis=1)
        if (near == near[0]).all():  # copies: cut into even parts
            near = np.arange(len(rows)) * len(pivots) // len(rows)
        children, centers, radii = [], [], []
        for k in range(len(pivots)):
            own = rows[near == k]
            if len(own):
                children.append(self._grow(own, pivots[k]))
                centers.append(pivots[k])
                radii.append(np.linalg.norm(self.point[own] - pivots[k], axis=1).max())
        centers = np.array(centers)
        self.nodes[me] = (False, children, centers, np.array(radii), np.linalg.norm(centers - center, axis=1))
        return me

    def _pivots(self, rows: np.ndarray) -> np.ndarray:
        """Rows far from each other, from an even sample."""
        sample = self.point[rows[:: max(1, len(rows) // 512)]]
        picked, far = [sample[0]], np.linalg.norm(sample - sample[0], axis=1)
        while len(picked) < FAN:
            k = int(far.argmax())
            picked.append(sample[k])
            far = np.minimum(far, np.linalg.norm(sample - sample[k], axis=1))
        return np.array(picked)

    def _offer(self, rows: np.ndarray, query_id: int, q: np.ndarray, best: list[tuple[int, int]], k: int) -> None:
        scores = products(self.x[rows], q)
        for i in np.flatnonzero(scores >= best[0][0]) if len(best) >= k else range(len(rows)):
            row, s = int(self.ids[rows[i]]), int(scores[i])
            if row == query_id:
                continue
            if len(best) < k:
                heapq.heappush(best, (s, -row))
            elif (s, -row) > best[0]:
                heapq.heapreplace(best, (s, -row))

    def search(self, query_id: int, q: np.ndarray, best: list[tuple[int, int]], k: int) -> None:
        """best: a heap of (score, -id), the worst first; rows of the tree that belong to the best k go in."""
        if self.flat or not float(np.abs(q).max()) < LARGEST**0.5:
            self._offer(np.arange(len(self.ids)), query_id, q, best, k)
            return
        norm = float(q @ q) + self.longest
        point = np.append(q, 0.0)
        slack = 1e-7 * np.sqrt(norm) + 1e-6  # more than the root of a rounding error of norm

        def reach() -> float:
            """Distance beyond which no row can be among the best."""
            return np.inf if len(best) < k else float(np.sqrt(max(norm - 2 * best[0][0], 0))) * (1 + 1e-9) + slack

        root = np.append(self.x[0], np.sqrt(max(self.longest - self.x[0] @ self.x[0], 0)))
        heap = [(0.0, 0, float(np.linalg.norm(point - root)))]  # lower bound, node, distance of the query to its routing vector
        while heap:
            low, node, away = heapq.heappop(heap)
            far = reach()
            if low > far:
                break
            if self.nodes[node][0]:
                _, rows, stored = self.nodes[node]
                self._offer(rows[np.abs(away - stored) <= far + slack], query_id, q, best, k)
                continue
            _, children, centers, radii, stored = self.nodes[node]
            may = np.flatnonzero(np.abs(away - stored) - radii <= far + slack)
            d = np.linalg.norm(centers[may] - point, axis=1)
            for i, dist in zip(may, d):
                bound = max(low, dist - radii[i] - slack)
                if bound <= far:
                    heapq.heappush(heap, (float(bound), children[i], float(dist)))


def index(vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", tree: int = TREE) -> DataFrame:
    """A row a tree: its vectors' length and its pages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[int], list[np.ndarray]]] = {}

        def made(dim: int) -> pa.RecordBatch:
            ids, xs = held.pop(dim)
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([pickle.dumps(MTree(np.array(ids, np.int64), np.array(xs)), 5)], pa.binary())], names=["dim", "pages"])

        for b in batches:
            for row, x in zip(b.column(0).to_pylist(), scaled(b.column(1).to_pylist())):
                if row is None or x is None:
                    continue
                ids, xs = held.setdefault(len(x), ([], []))
                ids.append(row)
                xs.append(x)
                if len(ids) == tree:
                    yield made(len(x))
        for dim in list(held):
            yield made(dim)

    return vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v")).mapInArrow(run, "dim int, pages binary")


def blocks(queries: DataFrame, most: int) -> Iterator[list[tuple[int, list[float]]]]:
    held = []
    for r in queries.toLocalIterator():
        held.append((r.id, r.v))
        if len(held) == most:
            yield held
            held = []
    if held:
        yield held


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, *, id: str = "vec_id", vector: str = "embedding", block: int = QUERIES) -> DataFrame:
    """query_id, rank, vec_id, score. Both tables have the id and the vector column."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "knn")
    trees = scratch.table(index(vectors, id=id, vector=vector), "trees")
    asked = queries.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v")).where("id IS NOT NULL").groupBy("id").agg(F.min("v").alias("v"))
    out = None
    for n, rows in enumerate(blocks(asked, block)):
        held = spark.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            asked = [(q, x) for (q, _), x in zip(held.value, scaled([v for _, v in held.value])) if x is not None]
            best: dict[int, list] = {q: [] for q, _ in asked}
            for b in batches:
                for dim, pages in zip(b.column("dim").to_pylist(), b.column("pages")):
                    tree = pickle.loads(pages.as_buffer())
                    for q, x in asked:
                        if len(x) == dim:
                            tree.search(q, x, best[q], k)
            found = [(q, -row, s) for q, rows in best.items() for s, row in rows]
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in range(3)], names=["query_id", "vec_id", "score"])

        part = scratch.table(trees.mapInArrow(run, "query_id long, vec_id long, score long"), f"found-{n}")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5(spark, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where("vec_id % 100 = 0"))


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON len(q.e) = len(c.e) AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""
