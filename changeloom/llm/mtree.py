"""Exact top-k search by inner product in M-trees."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

PAGE, FANOUT = 512, 16
#: Vectors per tree and queries per block: what one task holds.
TREE_ROWS, BLOCK_ROWS = 4_096, 1_024
#: Float distances are trusted up to this part of the largest one.
SLACK = 1e-9


def quantized(embedding: Column) -> Column:
    """floor(1024 * x) of every component as a double; null for vectors that are null, empty or not finite throughout."""
    whole = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vector = F.transform(embedding, lambda x: F.floor(x.cast("double") * 1024.0))
    return F.when((F.size(embedding) > 0) & F.coalesce(whole, F.lit(False)), vector)


class MTree:
    """A tree of pages over vectors, searched best first.

    Inner products are turned into distances: with one more component, all vectors get the same length, and the one nearest to a query
    is the one with the largest product. A page has a routing vector, the radius that covers what is below it and, for each
    entry, the distance to the routing vector. Whatever these and the triangle inequality rule out is never compared.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        points = vectors.astype(np.float64)
        squares = (points**2).sum(axis=1)
        self.most = squares.max()
        self.points = np.hstack([points, np.sqrt(self.most - squares)[:, None]])
        self.computed = 0
        self.center = self.points[0]
        away = np.linalg.norm(self.points - self.center, axis=1)
        self.root = self._page(np.arange(len(ids)), self.center, away)

    def _page(self, rows: np.ndarray, center: np.ndarray, away: np.ndarray) -> dict:
        if len(rows) <= PAGE:
            return {"rows": rows, "away": away, "vectors": self.vectors[rows]}
        fanout = min(FANOUT, -(-2 * len(rows) // PAGE))
        routers = rows[np.linspace(0, len(rows) - 1, fanout).astype(int)]
        apart = np.stack([np.linalg.norm(self.points[rows] - self.points[r], axis=1) for r in routers], axis=1)
        nearest = apart.argmin(axis=1)
        if np.bincount(nearest, minlength=fanout).max() == len(rows):
            nearest = np.arange(len(rows)) * fanout // len(rows)
        below, kept, radii = [], [], []
        for k in np.unique(nearest):
            mine = nearest == k
            below.append(self._page(rows[mine], self.points[routers[k]], apart[mine, k]))
            kept.append(routers[k])
            radii.append(apart[mine, k].max())
        to_parent = np.linalg.norm(self.points[kept] - center, axis=1)
        return {"routers": np.array(kept), "radii": np.array(radii), "away": to_parent, "below": below}

    def search(self, query_id: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best (score, id), ties to the smaller id, without rows of the query's id."""
        point = np.append(query.astype(np.float64), 0.0)
        length = (point**2).sum() + self.most
        slack = SLACK * (1 + np.sqrt(length))
        best: list[tuple[int, int]] = []  # a heap of (score, -id), the worst first
        reach = np.inf  # no row farther than this can be among the best
        pages = [(0.0, 0, np.linalg.norm(point - self.center), self.root)]
        count = 0
        while pages and pages[0][0] <= reach:
            _, _, center, page = heapq.heappop(pages)
            if "rows" in page:
                open_ = np.flatnonzero(np.abs(center - page["away"]) <= reach + slack)
                self.computed += len(open_)
                scores = (page["vectors"] if len(open_) == len(page["rows"]) else page["vectors"][open_]) @ query
                # Of a page's scores, only its k + 1 highest (one may be the query's own) and those tied with them can matter.
                least = best[0][0] if len(best) == k else np.partition(scores, -k - 1)[-k - 1] if len(scores) > k else None
                some = np.arange(len(scores)) if least is None else np.flatnonzero(scores >= least)
                for score, vec in zip(scores[some].tolist(), self.ids[page["rows"][open_[some]]].tolist(), strict=True):
                    if vec == query_id:
                        continue
                    item = (int(score), -vec)
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                if len(best) == k:
                    reach = np.sqrt(max(0.0, length - 2.0 * best[0][0])) + slack
                continue
            open_ = np.flatnonzero(np.abs(center - page["away"]) - page["radii"] <= reach + slack)
            away = np.linalg.norm(self.points[page["routers"][open_]] - point, axis=1)
            self.computed += len(open_)
            for i, d in zip(open_, away, strict=True):
                least = max(0.0, d - page["radii"][i] - slack)
                if least <= reach:
                    count += 1
                    heapq.heappush(pages, (least, count, d, page["below"][i]))
        return [(score, -vec) for score, vec in sorted(best, reverse=True)]


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Vectors in a type in which their products are exact."""
    rows = np.stack(vectors.to_numpy())
    largest = int(np.abs(rows).max())
    return rows.astype(np.float64) if largest**2 * rows.shape[1] < 2**53 else rows.astype(object)


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k highest inner products of each query with all vectors: ``query_id``, ``rank``, ``vec_id``, ``score``.

    Both inputs have ``vec_id`` and ``vector`` (array of bigint). The vectors are dealt by a hash into trees of about 4 096, the
    queries into blocks of about 1 024; each tree meets each block once and gives k rows per query, of which the best k are kept. Vectors
    are compared with those of the same dimension. Ties go to the smaller ``vec_id``; a query's own id is no candidate. Rows equal in id
    and vector count once. Rows with a null take no part; k or fewer candidates are all returned; no queries give no rows.
    """

    def dealt(frame: DataFrame, size: int) -> tuple[DataFrame, int]:
        rows = frame.select("vec_id", "vector").dropna().dropDuplicates().withColumn("dim", F.size("vector"))
        parts = -(-rows.count() // size) or 1
        return rows.withColumn("part", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(parts)).cast("int")), parts

    trees, n_trees = dealt(vectors, TREE_ROWS)
    blocks, n_blocks = dealt(queries, BLOCK_ROWS)
    every = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    left = trees.select("dim", F.col("part").alias("tree"), every(n_blocks, "block"), "vec_id", "vector")
    right = blocks.select("dim", every(n_trees, "tree"), F.col("part").alias("block"), "vec_id", "vector")

    def search(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(asked):
            tree = MTree(rows["vec_id"].to_numpy(), _matrix(rows["vector"]))
            for vec, query in zip(asked["vec_id"].tolist(), _matrix(asked["vector"]), strict=True):
                found += [(vec, other, score) for score, other in tree.search(vec, query, k)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    key = ["dim", "tree", "block"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
