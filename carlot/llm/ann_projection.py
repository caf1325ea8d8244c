"""Approximate nearest neighbours by stable projections and a chi-square stopping test.

Unit vectors are projected to a few dimensions with Gaussian weights, where the
squared distance of a pair, over its true squared distance, follows a chi-square
distribution.  Kd-trees index the projections.  Neighbours come in order of
projected distance and are verified on the original vectors; the search ends when
a closer vector than the k-th found would, with the given probability, have come.

The top of the tree is grown on a bounded sample and cuts space into cells; every
vector is indexed in its cell, a large cell in several blocks.  A query first
searches its own cell and then, with that bound, the cells that the test leaves.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carlot.session import stage

LEAF = 64


def chi_square_bound(dims: int, surety: float) -> float:
    """The quantile ``surety`` of a chi-square distribution with an even number of dims."""
    low, high = 0.0, 100.0 * dims
    for _ in range(200):
        x = (low + high) / 2
        tail = math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))
        low, high = (x, high) if 1 - tail < surety else (low, x)
    return high


@dataclass(frozen=True)
class Projection:
    """Gaussian weights and the cuts that make the cells of the top tree."""

    weights: np.ndarray
    #: Inner nodes as (axis, value, left, right); a negative child is cell -child - 1.
    cuts: tuple[tuple[int, float, int, int], ...]
    cells: int

    def project(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return unit @ self.weights

    def cell(self, points: np.ndarray) -> np.ndarray:
        out = np.zeros(len(points), np.int64)
        if not self.cuts:
            return out
        todo = [(0, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = -node - 1
                continue
            axis, value, left, right = self.cuts[node]
            below = points[rows, axis] < value
            todo += [(left, rows[below]), (right, rows[~below])]
        return out


def fit_projection(sample: np.ndarray, dims: int, cells: int, seed: int) -> Projection:
    weights = np.random.default_rng(seed).standard_normal((sample.shape[1], dims))
    points = sample / np.linalg.norm(sample, axis=1, keepdims=True) @ weights
    cuts: list[list] = []
    made = 0

    def grow(rows: np.ndarray, share: int) -> int:
        nonlocal made
        spread = np.ptp(points[rows], axis=0) if len(rows) > 1 else np.zeros(dims)
        axis = int(spread.argmax())
        if share <= 1 or spread[axis] == 0:
            made += 1
            return -made
        value = float(np.median(points[rows, axis]))
        below = points[rows, axis] < value
        if not below.any():
            value = float(points[rows, axis][~(points[rows, axis] <= value)].min())
            below = points[rows, axis] < value
        at = len(cuts)
        cuts.append([axis, value, 0, 0])
        cuts[at][2] = grow(rows[below], share // 2)
        cuts[at][3] = grow(rows[~below], share - share // 2)
        return at

    grow(np.arange(len(points)), cells)
    return Projection(weights, tuple(map(tuple, cuts)), max(1, made))


class KdTree:
    """Leaves of a kd-tree over projected points, with their boxes."""

    def __init__(self, points: np.ndarray) -> None:
        self.points = points
        self.leaves: list[np.ndarray] = []
        todo = [np.arange(len(points))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                self.leaves.append(rows)
                continue
            axis = int(np.ptp(points[rows], axis=0).argmax())
            order = rows[np.argsort(points[rows, axis], kind="stable")]
            todo += [order[: len(order) // 2], order[len(order) // 2 :]]
        self.low = np.array([points[r].min(0) for r in self.leaves])
        self.high = np.array([points[r].max(0) for r in self.leaves])

    def nearest(self, point: np.ndarray):
        """(rows, bound): points in order of distance; all others are at least ``bound`` away."""
        gaps = np.sqrt((np.maximum(0, np.maximum(self.low - point, point - self.high)) ** 2).sum(1))
        order = np.argsort(gaps, kind="stable")
        rows = np.zeros(0, np.int64)
        away = np.zeros(0)
        for at in range(0, len(order), 4):
            new = np.concatenate([self.leaves[i] for i in order[at : at + 4]])
            rows = np.concatenate([rows, new])
            away = np.concatenate([away, np.sqrt(((self.points[new] - point) ** 2).sum(1))])
            bound = gaps[order[at + 4]] if at + 4 < len(order) else np.inf
            ready = away <= bound
            yield rows[ready], bound
            rows, away = rows[~ready], away[~ready]


def search(tree: KdTree, vectors: np.ndarray, ids: list[list[int]], query: np.ndarray, point: np.ndarray,
           own: int, k: int, limit: float, stop: float) -> list[tuple[int, float]]:
    """The k best (id, cosine) that the stopping test lets through.

    ``limit`` is a known distance of a k-th neighbour; ``ids`` are the identifiers
    that share a vector, the least first.
    """
    norms = np.linalg.norm(vectors, axis=1)
    size = math.sqrt((query * query).sum())
    best: list[tuple[float, int]] = []
    for rows, bound in tree.nearest(point):
        if len(rows):
            cosines = (vectors[rows] * query).sum(1) / (norms[rows] * size)
            floor = -best[-1][0] if len(best) == k else -np.inf
            for at in np.flatnonzero(cosines >= floor):
                best += [(-float(cosines[at]), i) for i in ids[rows[at]] if i != own]
            best = sorted(best)[:k]
        kth = math.sqrt(max(0.0, 2 + 2 * best[-1][0])) if len(best) == k else np.inf
        if bound * bound > stop * min(kth, limit) ** 2:
            break
    return [(i, -c) for c, i in best]


def _searcher(projection: Projection, k: int, stop: float):
    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(queries):
            vectors = np.stack(rows["vector"].to_numpy()).astype(float)
            ids = [sorted(map(int, i)) for i in rows["ids"]]
            tree = KdTree(projection.project(vectors))
            asked = np.stack(queries["vector"].to_numpy()).astype(float)
            points = projection.project(asked)
            for own, limit, query, point in zip(queries["query_id"], queries["limit"], asked, points):
                out += [(own, i, c) for i, c in search(tree, vectors, ids, query, point, own, k, limit, stop)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return run


def nearest_neighbours(
    rows: DataFrame,
    is_query,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    dims: int = 8,
    surety: float = 0.99,
    per_block: int = 4000,
    sample: int = 16_384,
    seed: int = 11,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found, by cosine.

    ``is_query`` is a condition on ``rows``; a query's own row is no candidate.
    Vectors that are null, zero, or hold null or non-finite numbers take no part,
    nor do those of another length than most; so does a null key.  Equal vectors are
    indexed once with the k + 1 least keys, which are all that can be found.
    ``surety`` is the probability with which the test lets a true neighbour through.
    The cells come from at most ``sample`` vectors; every vector is indexed.
    """
    spark = rows.sparkSession
    given = rows.select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), is_query.alias("asks")
    )
    fit = given.filter(
        F.col("id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    fit = stage(fit, "vectors")
    lengths = fit.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    fit = fit.filter(F.size("vector") == lengths["n"])
    place = Window.partitionBy("vector").orderBy("id")
    least = fit.select("id", "vector").distinct().withColumn("no", F.row_number().over(place)).filter(F.col("no") <= k + 1)
    distinct = stage(least.groupBy("vector").agg(F.collect_list("id").alias("ids")), "vectors")
    total = distinct.count()
    chosen = distinct.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(sample).collect()
    cells = max(1, min(-(-total // per_block), sample // 16))
    projection = fit_projection(np.array([r["vector"] for r in chosen]), dims, cells, seed)
    stop = chi_square_bound(dims, surety)

    def placed(frames):
        for frame in frames:
            vectors = np.stack(frame["vector"].to_numpy()).astype(float) if len(frame) else np.zeros((0, 1))
            points = projection.project(vectors) if len(frame) else vectors
            frame["cell"] = projection.cell(points) if len(frame) else np.zeros(0, np.int64)
            frame["point"] = list(points)
            yield frame

    indexed = stage(
        distinct.mapInPandas(placed, "vector array<double>, ids array<long>, cell long, point array<double>"), "index"
    )
    boxes = indexed.groupBy("cell").agg(
        F.count("*").alias("n"),
        *(F.min(F.col("point")[i]).alias(f"low{i}") for i in range(dims)),
        *(F.max(F.col("point")[i]).alias(f"high{i}") for i in range(dims)),
    ).orderBy("cell").toPandas()
    low = boxes[[f"low{i}" for i in range(dims)]].to_numpy()
    high = boxes[[f"high{i}" for i in range(dims)]].to_numpy()
    parts = -(-boxes["n"].to_numpy() // per_block)
    blocks = {int(c): int(p) for c, p in zip(boxes["cell"], parts)}
    split = F.create_map(*(F.lit(x) for pair in blocks.items() for x in pair))[F.col("cell")]
    dealt = indexed.withColumn("part", F.pmod(F.xxhash64("vector"), split)).select("cell", "part", "vector", "ids")

    queries = fit.filter("asks").groupBy(F.col("id").alias("query_id")).agg(F.min("vector").alias("vector"))
    chunks = max(1, -(-queries.count() // 5000))

    def visits(first: bool):
        """The blocks that a query goes to: of its own cell, or of the others in reach."""

        def run(frames):
            for frame in frames:
                out = []
                for own, limit, query in zip(frame["query_id"], frame["limit"], frame["vector"]):
                    point = projection.project(np.asarray(query, float)[None, :])
                    home = int(projection.cell(point)[0])
                    gaps = np.maximum(0, np.maximum(low - point, point - high))
                    near = (gaps**2).sum(1) <= stop * limit**2 if not first else np.ones(len(low), bool)
                    for cell, reach in zip(boxes["cell"], near):
                        if reach and (cell == home) == first:
                            out += [(own, limit, query, cell, p) for p in range(blocks[int(cell)])]
                yield pd.DataFrame(out, columns=["query_id", "limit", "vector", "cell", "part"])

        return run

    def look(asked: DataFrame, first: bool) -> DataFrame:
        went = asked.mapInPandas(visits(first), "query_id long, limit double, vector array<double>, cell long, part long")
        went = went.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)))
        data = dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))))
        by = ["cell", "part", "chunk"]
        found = data.groupBy(*by).cogroup(went.groupBy(*by)).applyInPandas(
            _searcher(projection, k, stop), "query_id long, vec_id long, score double"
        )
        return stage(found, "found")

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    home = look(queries.withColumn("limit", F.lit(float("inf"))), True)
    kth = best(home).filter(F.col("rank") == k).select(
        "query_id", F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("score"))).alias("limit")
    )
    bounded = queries.join(kth, "query_id", "left").withColumn("limit", F.coalesce("limit", F.lit(float("inf"))))
    away = look(bounded.select("query_id", "vector", "limit"), False)
    return best(home.union(away)).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op2_ann_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest_neighbours(rows, F.col("vec_id") % 50 == 0)
