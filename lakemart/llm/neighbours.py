"""Approximate nearest neighbours by inner product over balanced posting lists.

One more component, the root of the largest squared norm less the own one, makes the largest inner product the
smallest distance. Balanced k-means on a bounded sample gives the centroids. Every vector is posted to its nearest
centroid and, near a boundary, to a few further ones that are hardly more distant. A query walks a neighbour graph of the centroids held in memory and selects all lists whose distance is within
a ratio of the nearest's; there is no cap on them. The ratio is set for each index: the true neighbours of a bounded sample of
queries are found by brute force among all vectors, and it is raised until the selected lists hold enough of them. Lists and the queries that selected them are dealt out in blocks of
bounded size, so a list of any length, or one that all queries select, is spread over tasks.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakemart.session import apply_defaults, materialize

SAMPLE_VECTORS = 20_000
MIN_LISTS = 8
MAX_LISTS = 2048
COPIES = 4
BOUNDARY = 1.01
# The ratio is the least at which so many queries, on average, have this share of their true neighbours in their lists.
SAMPLE_QUERIES = 200
RECALL = 0.96
DEGREE = 16
BLOCK_VECTORS = 512
BLOCK_QUERIES = 256
NEIGHBOURS = 20
# The nearest lists of a query are searched first; from the others only what beats their k-th best leaves a task.
FIRST_LISTS = 4


@dataclass
class ListIndex:
    """Centroids in the lengthened space, their neighbour graph and the squared norm bound."""

    centroids: np.ndarray
    graph: np.ndarray
    bound: float
    dimension: int
    boundary: float = BOUNDARY
    ratio: float = math.inf
    # A nearest distance below this one counts as this one: a query that lies on a centroid selects others too.
    base: float = 0.0

    def lengthened(self, vectors: np.ndarray) -> np.ndarray:
        return np.c_[vectors, np.sqrt(np.maximum(self.bound - (vectors**2).sum(axis=1), 0.0))]

    def posted(self, vectors: np.ndarray) -> list[np.ndarray]:
        """The lists of each vector: the nearest centroid's and those across a near boundary."""
        points = self.lengthened(vectors)
        square = (points**2).sum(axis=1)[:, None] - 2 * points @ self.centroids.T + (self.centroids**2).sum(axis=1)[None, :]
        distance = np.sqrt(np.maximum(square, 0.0))
        nearest = np.argsort(distance, axis=1, kind="stable")[:, :COPIES]
        near = np.take_along_axis(distance, nearest, axis=1)
        kept = near <= self.boundary * near[:, :1]
        return [order[keep] for order, keep in zip(nearest, kept, strict=True)]

    def away(self, query: np.ndarray, nodes: np.ndarray | slice) -> np.ndarray:
        """Distances of a query, scaled to the largest norm, from centroids."""
        point = np.r_[query * (math.sqrt(self.bound) / max(np.sqrt((query**2).sum()), 1e-300)), 0.0]
        return np.sqrt(((self.centroids[nodes] - point) ** 2).sum(axis=1))

    def selected(self, query: np.ndarray, sizes: np.ndarray | None = None, least: int = 0) -> list[int]:
        """The lists within the ratio of the nearest, found on the graph, nearest first.

        With ``sizes``, further ones follow until they hold ``least`` vectors or no list is left.
        """

        def away(nodes: np.ndarray) -> np.ndarray:
            return self.away(query, nodes)

        seen = np.zeros(len(self.centroids), bool)
        seen[0] = True
        queue = [(float(away(np.array([0]))[0]), 0)]
        found: list[tuple[float, int]] = []
        best, held = math.inf, 0
        while queue:
            distance, node = heapq.heappop(queue)
            if len(found) >= DEGREE and distance > self.ratio * max(best, self.base) and (sizes is None or held >= least):
                break
            found.append((distance, node))
            held += 0 if sizes is None else int(sizes[node])
            best = min(best, distance)
            near = self.graph[node]
            near = near[~seen[near]]
            seen[near] = True
            for d, n in zip(away(near).tolist(), near.tolist(), strict=True):
                heapq.heappush(queue, (d, n))
        lists, held = [], 0
        for distance, node in sorted(found):
            if distance > self.ratio * max(best, self.base) and (sizes is None or held >= least):
                break
            lists.append(node)
            held += 0 if sizes is None else int(sizes[node])
        return lists


def _distances(points: np.ndarray) -> np.ndarray:
    square = (points**2).sum(axis=1)
    return np.sqrt(np.maximum(square[:, None] + square[None, :] - 2 * points @ points.T, 0.0))


def balanced_centroids(points: np.ndarray, lists: int, rounds: int = 8, seed: int = 1) -> np.ndarray:
    """k-means whose assignment adds a price to lists that are longer than the mean."""
    chosen = np.random.default_rng(seed).choice(len(points), lists, replace=False)
    centroids, price = points[np.sort(chosen)].copy(), np.zeros(lists)
    share = len(points) / lists
    for _ in range(rounds):
        square = -2 * points @ centroids.T + (centroids**2).sum(axis=1)[None, :] + price[None, :]
        own = square.argmin(axis=1)
        sizes = np.bincount(own, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, points)
        centroids = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centroids)
        price += 0.05 * points.var(axis=0).sum() * (sizes / share - 1).clip(-1, 1)
    return centroids


def _graph(centroids: np.ndarray, seed: int = 2) -> np.ndarray:
    """Nearest neighbours of each centroid, the next number (so that all are reachable) and some far links."""
    lists = len(centroids)
    near = np.argsort(_distances(centroids), axis=1, kind="stable")[:, 1 : DEGREE + 1]
    far = np.random.default_rng(seed).integers(0, lists, (lists, 4))
    return np.c_[near, (np.arange(lists) + 1) % lists, far]


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``id, vector`` of the rows with an id and a vector of finite doubles that are not all zero."""
    vector = F.col(vector_col).cast("array<double>")
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector")).where(
        F.col("id").isNotNull() & fine & F.exists("vector", lambda x: x != 0)
    )


def build_index(vectors: DataFrame, sample: int = SAMPLE_VECTORS, lists: int | None = None, queries: DataFrame | None = None, k: int = NEIGHBOURS) -> ListIndex | None:
    """An index from ``id, vector`` rows: norms of all of them, centroids from about ``sample`` chosen by a hash of the id.

    Its ratio is set for the ``k`` neighbours of ``queries``, by default of the vectors themselves. Vectors of another length than the most frequent one (the shorter of equally frequent ones) don't take part.
    """
    sizes = vectors.groupBy(F.size("vector").alias("dimension")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)).alias("bound")
    )
    top = sizes.orderBy(F.desc("n"), "dimension").first()
    if top is None:
        return None
    share = min(1.0, sample / top["n"])
    chosen = vectors.where((F.size("vector") == top["dimension"]) & (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < max(1, int(share * 1_000_000))))
    distinct = chosen.select("vector").distinct().orderBy("vector").limit(2 * sample).toPandas()
    points = np.array(distinct["vector"].to_list()).reshape(-1, top["dimension"])
    if not len(points):
        points = np.array([vectors.where(F.size("vector") == top["dimension"]).orderBy("id").first()["vector"]])
    lists = lists or min(MAX_LISTS, max(MIN_LISTS, round(math.sqrt(top["n"]) / 2)))
    index = ListIndex(np.zeros((1, 1)), np.zeros((1, 1), int), top["bound"], top["dimension"])
    index.centroids = balanced_centroids(index.lengthened(points), min(lists, len(points)))
    index.graph = _graph(index.centroids)
    _calibrate(index, vectors.where(F.size("vector") == top["dimension"]), vectors if queries is None else queries, points, k)
    return index


def _calibrate(index: ListIndex, vectors: DataFrame, queries: DataFrame, points: np.ndarray, k: int) -> None:
    """Set ``base`` and ``ratio`` so that sampled queries have ``RECALL`` of their true neighbours in their lists."""
    asked = queries.where(F.size("vector") == index.dimension).select("id", "vector")
    share = min(1.0, 2 * SAMPLE_QUERIES / max(1, asked.count()))
    place = F.xxhash64("id", F.lit(7))
    chosen = asked.where(F.pmod(place, F.lit(1_000_000)) <= int(share * 1_000_000)).orderBy(place, "id", "vector").limit(SAMPLE_QUERIES).toPandas()
    if not len(chosen):  # as few queries as this may all miss the share
        chosen = asked.orderBy(place, "id", "vector").limit(SAMPLE_QUERIES).toPandas()
    if not len(chosen):
        return
    left = np.array(chosen["vector"].to_list())
    true = _true_neighbours(index, vectors, chosen["id"].to_numpy(), left, points, k)
    distances = [index.away(query, slice(None)) for query in left]
    nearest = np.array([d.min() for d in distances])
    index.base = max(float(np.median(nearest)), 1e-6 * math.sqrt(index.bound))
    # The ratio at which a list that holds the neighbour is selected, for each query and true neighbour.
    needed = sorted((d[lists].min() / max(n, index.base), 1 / len(found)) for d, n, found in zip(distances, nearest, true, strict=True) for lists in found)
    if not needed:
        return
    held = np.cumsum([weight for _, weight in needed])
    index.ratio = max(1.0, float(needed[min(int(np.searchsorted(held, RECALL * held[-1])), len(needed) - 1)][0]) * (1 + 1e-9))
    while index.ratio < needed[-1][0]:  # the walk may miss lists
        found = [np.isin(np.concatenate(lists), index.selected(query)) if lists else None for query, lists in zip(left, true, strict=True)]
        reached = [np.mean([part.any() for part in np.split(hit, np.cumsum([len(x) for x in lists])[:-1])]) for hit, lists in zip(found, true, strict=True) if lists]
        if np.mean(reached) >= RECALL - 1e-9:
            break
        index.ratio *= 1.01


def _true_neighbours(index: ListIndex, vectors: DataFrame, own: np.ndarray, left: np.ndarray, points: np.ndarray, k: int) -> list[list[np.ndarray]]:
    """For each query the lists of each of its ``k`` true neighbours, from all vectors.

    A task returns only what reaches the score that ``k`` sampled vectors beside the query's own reach.
    """
    least = np.full(len(left), -np.inf)
    if len(points) > k:
        for row, query in enumerate(left):
            least[row] = np.partition(points @ query, len(points) - k - 1)[len(points) - k - 1]
        least -= 1e-9 * np.abs(least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[dict[int, tuple[float, np.ndarray]]] = [{} for _ in own]
        for batch in batches:
            ids, right = batch.column("id").to_numpy(), np.array(batch.column("vector").to_pylist()).reshape(batch.num_rows, -1)
            score = left @ right.T
            score[own[:, None] == ids[None, :]] = -np.inf
            for row, line in enumerate(score):
                mine = best[row]
                for at in np.flatnonzero((line >= least[row]) & (line > -np.inf)).tolist():
                    if ids[at] not in mine or mine[ids[at]][0] < line[at]:
                        mine[int(ids[at])] = (float(line[at]), right[at])
                if len(mine) > k:
                    best[row] = dict(sorted(mine.items(), key=lambda x: (-x[1][0], x[0]))[:k])
        for row, mine in enumerate(best):
            if mine:
                lists = index.posted(np.array([vector for _, vector in mine.values()]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(mine), row, np.int32)), pa.array(list(mine), pa.int64()), pa.array([s for s, _ in mine.values()], pa.float64()), pa.array([x.tolist() for x in lists], pa.list_(pa.int32()))],
                    ["query", "id", "score", "lists"],
                )

    found = vectors.select("id", "vector").mapInArrow(run, "query int, id long, score double, lists array<int>")
    found = found.groupBy("query", "id").agg(F.max(F.struct("score", "lists")).alias("top")).select("query", "id", "top.*")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    true: list[list[np.ndarray]] = [[] for _ in own]
    for r in found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query", "lists").collect():
        true[r["query"]].append(np.array(r["lists"]))
    return true


def _dealt(vectors: DataFrame, choose) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 1024):
                part = batch.slice(low, 1024)
                matrix = np.array(part.column("vector").to_pylist()).reshape(part.num_rows, -1)
                lists = choose(matrix)
                sizes = np.array([len(x) for x in lists])
                taken = pa.array(np.repeat(np.arange(part.num_rows), sizes))
                flat = pa.array(np.concatenate(lists).astype(np.int32))
                place = pa.array(np.concatenate([np.arange(n) for n in sizes]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column("id").take(taken), part.column("vector").take(taken), flat, place], ["id", "vector", "list", "place"])

    return vectors.select("id", "vector").mapInArrow(run, "id long, vector array<double>, list int, place int")


def _scored(k: int):
    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        """Each query's k best of one block of a list, as far as they reach its bound; an id takes one place."""
        if not len(queries) or not len(vectors):
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        vectors = vectors.sort_values("id", kind="stable")
        left, right = np.array(queries["vector"].to_list()), np.array(vectors["vector"].to_list())
        ids, own, bound = vectors["id"].to_numpy(), queries["id"].to_numpy(), queries["bound"].to_numpy()
        score = left @ right.T
        score[own[:, None] == ids[None, :]] = -np.inf
        # Products of matrices may round equal sums differently; what is near the edge is summed again one by one.
        margin = 1e-12 * np.sqrt((left**2).sum(axis=1) * (right**2).sum(axis=1).max())
        starts = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
        found = []
        for row in range(len(own)):
            line = score[row]
            once = np.maximum.reduceat(line, starts)
            edge = np.partition(once, len(once) - k)[len(once) - k] - margin[row] if len(once) > k else -np.inf
            place = np.flatnonzero((line >= max(edge, bound[row] - margin[row])) & (line > -np.inf))
            exact = (right[place] * left[row]).sum(axis=1)
            order = np.argsort(-exact, kind="stable")
            order = order[np.sort(np.unique(ids[place[order]], return_index=True)[1])][:k]
            found.append((np.full(len(order), own[row]), ids[place[order]], exact[order]))
        return pd.DataFrame({name: np.concatenate([f[i] for f in found]) for i, name in enumerate(("query_id", "vec_id", "score"))})

    return run


def search(vectors: DataFrame, queries: DataFrame, index: ListIndex, k: int = NEIGHBOURS) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest of the vectors found, ties to the smaller id.

    Both tables have ``id, vector`` as from :func:`usable`. A vector with the query's id is not its candidate. If fewer
    than ``k`` candidates exist, all that were found are returned. Scores are inner products in double precision.
    Rows that repeat an id count once in the result. An empty table gives an empty result.
    """
    fits = F.size("vector") == index.dimension
    posted = materialize(_dealt(vectors.where(fits), index.posted), "postings")
    sizes = np.zeros(len(index.centroids), int)
    for r in posted.where(F.col("place") == 0).groupBy("id").agg(F.min("list").alias("list")).groupBy("list").count().collect():  # one row for each list
        sizes[r["list"]] = r["count"]
    asked = materialize(_dealt(queries.where(fits), lambda matrix: [np.array(index.selected(q, sizes, k + 1)) for q in matrix]), "asked")
    first = materialize(_searched(posted, asked.where(F.col("place") < FIRST_LISTS).withColumn("bound", F.lit(float("-inf"))), k), "first_finds")
    bounds = materialize(_best(first, k).where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("bound")), "bounds")
    others = asked.where(F.col("place") >= FIRST_LISTS).join(bounds, "id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    return _best(first.union(_searched(posted, others, k)), k)


def _best(found: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best finds of each query, a vector once."""
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _searched(posted: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """``query_id, vec_id, score`` of the finds in the lists that ``asked`` names for each query."""
    blocks = posted.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_VECTORS).cast("int").alias("v")).join(
        asked.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("q")), "list"
    )  # at most one row for each centroid
    blocks = F.broadcast(materialize(blocks, "blocks"))
    place = F.xxhash64("id", F.lit(3))
    right = posted.join(blocks, "list").select("id", "vector", "list", F.pmod(place, F.col("v")).cast("int").alias("vb"), F.explode(F.sequence(F.lit(0), F.col("q") - 1)).alias("qb"))
    left = asked.join(blocks, "list").select("id", "vector", "bound", "list", F.explode(F.sequence(F.lit(0), F.col("v") - 1)).alias("vb"), F.pmod(place, F.col("q")).cast("int").alias("qb"))
    keys = ["list", "vb", "qb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_scored(k), "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = NEIGHBOURS) -> DataFrame:
    """The ``k`` nearest others of each row whose id is divisible by ``every``, among all rows."""
    apply_defaults(vectors.sparkSession)
    rows = usable(vectors, id_col, vector_col)
    queries = rows.where(F.col("id") % every == 0)
    index = build_index(rows, queries=queries, k=k)
    if index is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return search(rows, queries, index, k)
