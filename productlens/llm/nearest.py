"""Approximate nearest neighbours with an inverted multi-index.

Each half of a vector is quantised by k-means of its own (``CENTROIDS`` per half), so a vector lies in the cell of two
centroids. The centroids are fitted on at most ``SAMPLE`` distinct vectors (smallest id hashes); every vector is indexed.
A query takes centroid pairs from a heap by the sum of its squared distances to both halves' centroids, until the cells
hold ``SHARE`` of all vectors (k + 1 at least); the entries of those cells are reranked by their exact distance in double
precision. Ids are read as longs: rows whose id is no number have none.

A cell of more than ``BLOCK`` entries is split by a hash of the row; a task keeps one block and streams the queries that visit it,
and of all its blocks sends on the k nearest of each query (of as many queries as ``HELD`` rows allow at once). So no task holds a whole cell, and copies of one vector spread over blocks; they
lie in the same cell, all of which is searched, so ties go to the smaller id.

Vectors that are NULL, zero, of another length than most, or hold NULL or non-finite components take no part, nor do rows
without id. Rows with the query's id are its own. Queries of a repeated id are one (the smallest vector). With fewer
candidates than k all found are returned; an empty table gives no rows. Other input columns are not read.
"""

from __future__ import annotations

import heapq
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from productlens.llm.tasks import prepare, written

CENTROIDS, SAMPLE, ROUNDS = 64, 20_000, 10
SHARE = 0.55
BLOCK = 8192
#: numbers that a task's distance table holds at once
TABLE = 1 << 22
#: found rows that a task holds at once
HELD = 1 << 20


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum(0, (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1))


def k_means(points: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """Centroids by Lloyd's rounds from distinct random points; at most as many as points."""
    rng = np.random.default_rng(seed)
    centre = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(ROUNDS):
        own = squared(points, centre).argmin(axis=1)
        total = np.zeros_like(centre)
        np.add.at(total, own, points)
        count = np.bincount(own, minlength=len(centre))
        centre = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centre)
    return centre


def usable(vector: Column, dim: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dim) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def visited(one: np.ndarray, two: np.ndarray, counts: np.ndarray, want: int) -> list[int]:
    """Cells in the order of the summed distances to both centroids until they hold ``want`` entries."""
    a, b = np.argsort(one, kind="stable"), np.argsort(two, kind="stable")
    heap, seen, cells, found = [(one[a[0]] + two[b[0]], 0, 0)], {(0, 0)}, [], 0
    while heap and found < want:
        _, i, j = heapq.heappop(heap)
        cell = int(a[i] * len(two) + b[j])
        if counts[cell]:
            cells.append(cell)
            found += counts[cell]
        for x, y in ((i + 1, j), (i, j + 1)):
            if x < len(one) and y < len(two) and (x, y) not in seen:
                seen.add((x, y))
                heapq.heappush(heap, (one[a[x]] + two[b[y]], x, y))
    return cells


class Nearest:
    """The k nearest of each query among the rows that a task has found so far, ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.size = k, 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def take(self, query: np.ndarray, vec: np.ndarray, score: np.ndarray) -> bool:
        """Add rows; False if those to be kept have grown to more than half of ``HELD`` and should be sent."""
        self.parts.append((query, vec, score))
        self.size += len(query)
        if self.size <= HELD:
            return True
        self._merge()
        return self.size <= HELD // 2

    def _merge(self) -> None:
        query, vec, score = map(np.concatenate, zip(*self.parts))
        order = np.lexsort((vec, score, query))
        query, vec, score = query[order], vec[order], score[order]
        begin = np.flatnonzero(np.append(True, query[1:] != query[:-1])[: len(query)])
        place = np.arange(len(query)) - np.repeat(begin, np.diff(np.append(begin, len(query))))
        near = place < self.k
        self.parts, self.size = [(query[near], vec[near], score[near])], int(near.sum())

    def sent(self) -> pa.RecordBatch:
        """All rows that are kept; none are left."""
        self.parts.append((np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)))
        self._merge()
        rows, self.parts, self.size = self.parts[0], [], 0
        return pa.RecordBatch.from_arrays([pa.array(c) for c in rows], ["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            share: float = SHARE) -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of each query row, by Euclidean distance, ties to smaller ids."""
    spark = vectors.sparkSession
    prepare(spark)
    out_schema = "query_id long, vec_id long, score double"
    named = vectors.select(vectors[id_col].try_cast("long").alias("id"), vectors[vector_col].alias("v"), is_query.alias("asks"),
                            F.monotonically_increasing_id().alias("n"))
    sizes = named.where("id is not null and size(v) > 0").groupBy(F.size("v").alias("n")).count()
    common = sizes.orderBy(F.desc("count"), "n").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = common.n
    rows = named.where(F.col("id").isNotNull() & usable(F.col("v"), dim))
    sample = [r.v for r in rows.orderBy(F.xxhash64("id"), "v").limit(SAMPLE).select("v").collect()]
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    points = np.unique(np.array(sample, np.float64), axis=0)
    half = dim // 2  # a vector of one component has an empty first half, with one centroid
    cut = slice(half, None)
    first, second = (k_means(np.unique(p, axis=0) if p.size else p[:1], CENTROIDS)
                     for p in (points[:, :half], points[:, cut]))

    def assign(batches):
        for b in batches:
            x = matrix(b.column("v"), dim)
            cell = squared(x[:, :half], first).argmin(1) * len(second) + squared(x[:, cut], second).argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32))], ["id", "v", "asks", "n", "cell"])

    kind = dict(vectors.dtypes)[vector_col]
    entries, _ = written(rows.mapInArrow(assign, f"id long, v {kind}, asks boolean, n long, cell int"), "multi-index")
    counts = np.zeros(len(first) * len(second), np.int64)
    for r in entries.groupBy("cell").count().collect():  # one row per cell
        counts[r["cell"]] = r["count"]
    want = max(k + 1, int(np.ceil(share * counts.sum())))
    blocks = np.maximum(1, -(-counts // BLOCK))

    def visits(batches):
        for b in batches:
            x = matrix(b.column("v"), dim)
            one, two = squared(x[:, :half], first), squared(x[:, cut], second)
            goals = [[(c, p) for c in visited(one[i], two[i], counts, want) for p in range(blocks[c])]
                     for i in range(len(x))]
            row = np.repeat(np.arange(len(x)), [len(g) for g in goals])
            cell, block = np.array([g for own in goals for g in own], np.int32).reshape(-1, 2).T
            for at in range(0, len(row), 4096):
                part = slice(at, at + 4096)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell[part]), pa.array(block[part]), pa.array(np.ones(len(row[part]), np.int32)),
                     b.column("id").take(pa.array(row[part])), b.column("v").take(pa.array(row[part]))],
                    ["cell", "block", "visitor", "id", "v"])

    split = spark.createDataFrame([(c, int(n)) for c, n in enumerate(blocks) if n > 1], "cell int, blocks int")  # cells at most
    block = F.pmod(F.xxhash64("n"), F.coalesce("blocks", F.lit(1)).cast("long")).cast("int")
    homes = entries.join(F.broadcast(split), "cell", "left").select(
        "cell", block.alias("block"), F.lit(0).alias("visitor"), "id", "v")
    queries = entries.where("asks").groupBy("id").agg(F.min("v").alias("v"))
    asked = queries.mapInArrow(visits, f"cell int, block int, visitor int, id long, v {kind}")

    def rerank(batches):
        key, ids, held, nearest = None, [], [], Nearest(k)
        own_ids = own = None
        for b in batches:
            cell, block, visitor, vec = (c.to_numpy() for c in b.columns[:4])
            both = cell.astype(np.int64) << 32 | block
            x = matrix(b.column("v"), dim)
            cuts = np.flatnonzero((np.diff(both) != 0) | (np.diff(visitor) != 0)) + 1
            for s, e in itertools.pairwise([0, *cuts.tolist(), len(both)]):
                if s == e:
                    continue
                if both[s] != key:
                    key, ids, held, own = both[s], [], [], None
                if not visitor[s]:
                    ids.append(vec[s:e])
                    held.append(x[s:e])
                    continue
                if not held:
                    continue
                if own is None:
                    own_ids, own = np.concatenate(ids), np.concatenate(held)
                    order = np.argsort(own_ids, kind="stable")
                    own_ids, own = own_ids[order], own[order]
                step = max(1, TABLE // own.size)
                for at in range(s, e, step):
                    part = slice(at, min(e, at + step))
                    d = np.sqrt(((x[part][:, None, :] - own[None]) ** 2).sum(axis=2))
                    d[vec[part][:, None] == own_ids[None]] = np.inf
                    best = np.argsort(d, axis=1, kind="stable")[:, :k]
                    score = np.take_along_axis(d, best, axis=1)
                    fine = np.isfinite(score)
                    if not nearest.take(np.repeat(vec[part], best.shape[1])[fine.ravel()], own_ids[best][fine], score[fine]):
                        yield nearest.sent()
        yield nearest.sent()

    found = (homes.union(asked.select("cell", "block", "visitor", "id", "v")).repartition("cell", "block")
             .sortWithinPartitions("cell", "block", "visitor").mapInArrow(rerank, out_schema))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
