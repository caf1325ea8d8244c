"""Hard negatives by cover trees over norm-augmented candidates.

A candidate gets one more coordinate, the square root of what its squared norm lacks to
the largest one, so that all lie on one sphere and the inner product with an anchor
falls with the distance.  Candidates near one centre form a block, and each block is a
cover tree: the children of a node are centres further apart than the next level's
radius that cover the node's points within it.  The centre's own product and the
node's covering radius bound all products below the node.

Anchors go down the trees together, best bound first.  An anchor skips a node whose
products all lie outside of its windows still open, or below what it has found already;
what is left at the leaves is verified exactly, in whole numbers.  An anchor first visits the block
it lies in itself and then, with the bounds found there, those that may hold more.
"""

from __future__ import annotations

import heapq
import io
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carlot.session import stage

#: Factor between the radii of two levels.
BASE = 1.3
#: Nodes of no more points are leaves.
LEAF = 24
#: Floats hold whole numbers exactly below this.
EXACT = 1 << 53
#: An open end of a window.
FAR = 1 << 62
#: Anchors that travel to a block in one row.
PIECE = 64
#: Bytes of visits that a task hands on at a time.
HANDED = 8 << 20
#: Products that are looked through at a time.
TABLE = 1 << 18


def least(numbers: np.ndarray) -> np.ndarray:
    """Whole numbers in the smallest signed type that holds them; others as they are."""
    if numbers.dtype != np.int64 or not numbers.size:
        return numbers
    low, high = numbers.min(), numbers.max()
    for kind in (np.int8, np.int16, np.int32):
        if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max:
            return numbers.astype(kind)
    return numbers


def augmented(vectors: np.ndarray, square: float) -> np.ndarray:
    """The vectors with the coordinate that lifts their squared norm to ``square``."""
    lack = np.sqrt(np.maximum(0.0, square - (vectors * vectors).sum(1)))
    return np.concatenate([vectors, lack[:, None]], axis=1)


def cover(
    points: np.ndarray, first: int, away: np.ndarray, radius: float, most: int
) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(centres, owner, distance) of a greedy cover: the farthest point becomes a centre
    until all are within ``radius`` of one, or there are ``most``."""
    centres, owner, away = [first], np.zeros(len(points), np.int64), away.copy()
    squares = (points * points).sum(1)
    while len(centres) < most:
        far = int(away.argmax())
        if away[far] <= radius:
            break
        new = np.sqrt(np.maximum(0.0, squares + squares[far] - 2 * (points @ points[far])))
        new[far] = 0.0
        nearer = new < away
        owner[nearer] = len(centres)
        away[nearer] = new[nearer]
        centres.append(far)
    return centres, owner, away


@dataclass
class CoverTree:
    """Nodes by number, a node's children one after another; leaves list their points."""

    centre: np.ndarray
    radius: np.ndarray
    child: np.ndarray  # first child, and how many
    children: np.ndarray
    leaf: np.ndarray  # first of the leaf's points in ``rows``, and how many
    leaves: np.ndarray
    rows: np.ndarray

    @classmethod
    def grow(cls, points: np.ndarray) -> CoverTree:
        start = points - points[0]
        nodes: list[list] = [[0, 0.0, 0, 0, 0, 0]]
        rows: list[np.ndarray] = []
        placed = 0
        todo = [(0, np.arange(len(points)), np.sqrt((start * start).sum(1)))]
        while todo:
            node, own, away = todo.pop()
            widest = float(away.max())
            nodes[node][1] = widest
            if len(own) <= LEAF or widest == 0.0:
                nodes[node][4:] = [placed, len(own)]
                rows.append(own)
                placed += len(own)
                continue
            level = math.ceil(math.log(widest) / math.log(BASE) - 1e-9) - 1
            first = int(away.argmin())
            centres, owner, away = cover(points[own], first, away, BASE**level, len(own))
            nodes[node][2:4] = [len(nodes), len(centres)]
            order = np.argsort(owner, kind="stable")
            bounds = np.searchsorted(owner[order], np.arange(len(centres) + 1))
            for i, centre in enumerate(centres):
                some = order[bounds[i] : bounds[i + 1]]
                todo.append((len(nodes), own[some], away[some]))
                nodes.append([int(own[centre]), 0.0, 0, 0, 0, 0])
        columns = list(zip(*nodes))
        return cls(
            np.array(columns[0]), np.array(columns[1]), *(np.array(c, np.int64) for c in columns[2:]),
            np.concatenate(rows),
        )


@dataclass
class Block:
    """Candidates of one block: distinct (vector, label) with their least identifiers."""

    vectors: np.ndarray
    labels: np.ndarray
    ids: np.ndarray
    held: np.ndarray
    square: float
    tree: CoverTree

    def pack(self) -> bytes:
        out = io.BytesIO()
        own = {name: part for name, part in vars(self).items() if name != "tree"}
        np.savez(out, **{name: least(np.asarray(part)) for name, part in (own | vars(self.tree)).items()})
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> Block:
        with np.load(io.BytesIO(data)) as found:
            parts = {name: found[name] for name in found.files}
        parts = {name: p.astype(np.int64) if p.dtype.kind == "i" else p for name, p in parts.items()}
        own = {name: parts.pop(name) for name in ("vectors", "labels", "ids", "held")}
        square = float(parts.pop("square"))
        return cls(**own, square=square, tree=CoverTree(**parts))

    def products(self, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Whole-number products (queries x rows)."""
        some = self.vectors[rows]
        most = float((queries.astype(float) ** 2).sum(1).max(initial=0.0))
        if self.square * most < EXACT**2:  # no partial sum is larger
            return (queries.astype(float) @ some.T.astype(float)).astype(np.int64)
        return queries @ some.T


def product_bounds(centre: np.ndarray, radius: np.ndarray, norm: np.ndarray, square: float) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) inner product of anchors with the points of nodes (anchors x nodes).

    ``centre`` has the products with the nodes' centres, ``norm`` the anchors' norms;
    points have the squared norm ``square`` after augmentation, so products and
    distances tell one another.
    """
    norm = np.asarray(norm)[..., None]
    both = norm * norm + square
    away = np.sqrt(np.maximum(0.0, both - 2 * centre))
    slack = 1e-9 * both + 1e-6
    high = np.minimum(centre + norm * radius, (both - np.maximum(0.0, away - radius) ** 2) / 2)
    low = np.maximum(centre - norm * radius, (both - (away + radius) ** 2) / 2)
    return low - slack, high + slack


class Descent:
    """Anchors on their way down one block's tree, with the windows they look in.

    ``lows`` and ``highs`` are anchors x windows; a window with its low above its high is
    closed.  ``found`` has, per window, rows (anchor, product, id) of the ``k`` best.
    """

    def __init__(
        self, block: Block, queries: np.ndarray, own: np.ndarray, labels: np.ndarray, same: bool,
        lows: np.ndarray, highs: np.ndarray, k: int,
    ) -> None:
        self.block, self.queries, self.own, self.labels, self.same, self.k = block, queries, own, labels, same, k
        self.floors, self.highs = lows.astype(np.int64).copy(), highs
        self.norms = np.sqrt((queries.astype(float) ** 2).sum(1))
        self.found = [np.zeros((0, 3), np.int64) for _ in range(lows.shape[1])]

    def open(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether a window of the anchor may still gain from the node (anchors x nodes)."""
        out = np.zeros(low.shape, bool)
        for w in range(len(self.found)):
            floor, top = self.floors[anchors, w, None], self.highs[anchors, w, None]
            out |= (floor <= top) & (high >= floor) & (low <= top)
        return out

    def verify(self, anchors: np.ndarray, rows: np.ndarray) -> None:
        """The products of anchors and rows, a bounded number at a time."""
        if len(rows):
            step = max(1, TABLE // len(rows))
            for at in range(0, len(anchors), step):
                self.looked(anchors[at : at + step], rows)

    def looked(self, anchors: np.ndarray, rows: np.ndarray) -> None:
        products = self.block.products(self.queries[anchors], rows)
        least, most = self.floors[anchors].min(1), self.highs[anchors].max(1)
        a, r = np.nonzero((products >= least[:, None]) & (products <= most[:, None]))
        product, a, r = products[a, r], anchors[a], rows[r]
        right = (self.block.labels[r] == self.labels[a]) == self.same
        product, a, r = product[right], a[right], r[right]
        # one row per identifier
        held = self.block.held[r]
        nth = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
        product, a, ids = np.repeat(product, held), np.repeat(a, held), self.block.ids[np.repeat(r, held), nth]
        other = ids != self.own[a]
        rows = np.stack([a[other], product[other], ids[other]], axis=1)
        for w, known in enumerate(self.found):
            fit = (rows[:, 1] >= self.floors[rows[:, 0], w]) & (rows[:, 1] <= self.highs[rows[:, 0], w])
            if fit.any():
                self.found[w] = self.settle(w, np.concatenate([known, rows[fit]]))

    def settle(self, w: int, rows: np.ndarray) -> np.ndarray:
        """The best rows of each anchor; full windows get a higher floor."""
        rows = rows[np.lexsort((rows[:, 2], -rows[:, 1], rows[:, 0]))]
        starts = np.flatnonzero(np.diff(rows[:, 0], prepend=-1))
        nth = np.arange(len(rows)) - np.repeat(starts, np.diff(starts, append=len(rows)))
        last = rows[nth == self.k - 1]
        self.floors[last[:, 0], w] = np.maximum(self.floors[last[:, 0], w], last[:, 1])
        return rows[nth < self.k]

    def run(self) -> Descent:
        tree, block = self.block.tree, self.block
        everyone = np.arange(len(self.queries))
        start = np.full(len(everyone), -np.inf)
        heap = [(-math.inf, 0, everyone, start, -start)]
        while heap:
            _, node, anchors, low, high = heapq.heappop(heap)
            still = self.open(anchors, low[:, None], high[:, None])[:, 0]
            anchors = anchors[still]
            if not len(anchors):
                continue
            if tree.leaves[node]:
                at = tree.leaf[node]
                self.verify(anchors, tree.rows[at : at + tree.leaves[node]])
                continue
            below = np.arange(tree.child[node], tree.child[node] + tree.children[node])
            # points with nothing below them are verified together
            single = tree.leaves[below] == 1
            self.verify(anchors, tree.rows[tree.leaf[below[single]]])
            below = below[~single]
            centre = self.queries[anchors].astype(float) @ block.vectors[tree.centre[below]].T.astype(float)
            low, high = product_bounds(centre, tree.radius[below], self.norms[anchors], block.square)
            reach = self.open(anchors, low, high)
            for i, child in enumerate(below.tolist()):
                went = reach[:, i]
                if went.any():
                    heapq.heappush(heap, (-high[went, i].max(), child, anchors[went], low[went, i], high[went, i]))
        return self


@dataclass
class Asked:
    """Anchors with their windows, as ``Descent`` takes them."""

    no: np.ndarray
    own: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    lows: np.ndarray
    highs: np.ndarray

    @classmethod
    def of(cls, frame: pd.DataFrame, dims: int) -> Asked:
        windows = max(map(len, frame["lows"]), default=0)
        lows, highs = np.full((len(frame), windows), FAR), np.full((len(frame), windows), -FAR)
        for row, (low, high) in enumerate(zip(frame["lows"], frame["highs"])):
            lows[row, : len(low)], highs[row, : len(high)] = low, high
        vectors = _stacked(frame["vector"], dims)
        return cls(*(frame[c].to_numpy() for c in ("no", "id", "label")), vectors, lows, highs)

    def some(self, at) -> Asked:
        return Asked(*(part[at] for part in vars(self).values()))

    def pack(self) -> bytes:
        out = io.BytesIO()
        for part in vars(self).values():
            np.save(out, least(part))
        return out.getvalue()

    @classmethod
    def unpack(cls, pieces) -> Asked:
        """The anchors of all pieces; where some have fewer windows, the others are closed."""
        files = [io.BytesIO(piece) for piece in pieces]
        parts = [[np.load(file).astype(np.int64) for file in files] for _ in range(6)]
        for k, closed in ((4, FAR), (5, -FAR)):
            most = max(part.shape[1] for part in parts[k])
            parts[k] = [np.pad(p, ((0, 0), (0, most - p.shape[1])), constant_values=closed) for p in parts[k]]
        return cls(*map(np.concatenate, parts))


def _descents(same: bool, k: int):
    def run(blocks: pd.DataFrame, pieces: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"no": [], "window": [], "found_id": [], "score": []}, dtype="int64")]
        for packed in blocks["block"] if len(pieces) else ():
            asked = Asked.unpack(pieces["asked"])
            descent = Descent(
                Block.unpack(packed), asked.vectors, asked.own, asked.labels, same, asked.lows, asked.highs, k
            ).run()
            for w, rows in enumerate(descent.found):
                no = asked.no[rows[:, 0]]
                out.append(pd.DataFrame({"no": no, "window": w, "found_id": rows[:, 2], "score": rows[:, 1]}))
        return pd.concat(out)

    return run


def _stacked(vectors: pd.Series, dims: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    out = np.zeros((len(vectors), dims), np.int64)
    for row, vector in zip(out, vectors):
        row[: len(vector)] = vector
    return out


def valid_rows(rows: DataFrame, key: str, label: str, vector: str, scale: int) -> DataFrame:
    """(id, label, vector) of the rows that take part, components as floor(scale * x)."""
    given = rows.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
    )
    given = given.filter(
        F.col("id").isNotNull() & F.col("label").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    )
    return given.withColumn("vector", F.transform("vector", lambda x: F.floor(x * scale)))


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("no", "window").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


@dataclass
class Balls:
    """The balls around centres that hold the blocks; a cell's blocks share its ball."""

    dims: int
    square: float
    centres: np.ndarray
    radius: np.ndarray
    parts: np.ndarray

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        return augmented(vectors.astype(float), self.square)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, distance to its centre) of vectors."""
        cell, away = np.zeros(len(vectors), np.int64), np.zeros(len(vectors))
        step = max(1, TABLE // len(self.centres))
        for at in range(0, len(vectors), step):
            own = slice(at, at + step)
            spots = self.lifted(vectors[own])
            squares = (spots * spots).sum(1)[:, None] + (self.centres**2).sum(1) - 2 * spots @ self.centres.T
            cell[own] = squares.argmin(1)
            away[own] = np.sqrt(((spots - self.centres[cell[own]]) ** 2).sum(1)) * (1 + 1e-12)
        return cell, away

    def visits(self, home: bool):
        """The blocks that anchors go to: those of their own cell, or others in reach.

        A row holds some anchors of a chunk on their way to one block.
        """

        def run(frames):
            for frame in frames:
                rows, held = [], 0
                for chunk, own in frame.groupby("chunk"):
                    for at in range(0, len(own), PIECE):
                        asked = Asked.of(own[at : at + PIECE], self.dims)
                        cells, _ = self.nearest(asked.vectors)
                        went = cells[:, None] == np.arange(len(self.centres))
                        if not home:
                            went = ~went & self.reach(asked)
                        for cell in np.flatnonzero(went.any(0)):
                            packed = asked.some(went[:, cell]).pack()
                            rows += [(cell, part, chunk, packed) for part in range(self.parts[cell])]
                            held += len(packed) * self.parts[cell]
                            if held > HANDED:
                                yield pd.DataFrame(rows, columns=["cell", "part", "chunk", "asked"])
                                rows, held = [], 0
                yield pd.DataFrame(rows, columns=["cell", "part", "chunk", "asked"])

        return run

    def reach(self, asked: Asked) -> np.ndarray:
        """Whether the ball of a cell may hold products of a window (anchors x cells)."""
        queries = asked.vectors.astype(float)
        centre = queries @ self.centres[:, : self.dims].T
        low, high = product_bounds(centre, self.radius, np.sqrt((queries * queries).sum(1)), self.square)
        out = np.zeros(low.shape, bool)
        for floor, top in zip(asked.lows.T[:, :, None], asked.highs.T[:, :, None]):
            out |= (high >= floor) & (low <= top)
        return out


def plant(rows: DataFrame, keep: int, per_block: int, sample: int) -> tuple[Balls, DataFrame]:
    """The balls, and the staged blocks (cell, part, block) of all candidates with their trees."""
    sizes = rows.agg(
        F.max(F.size("vector")).alias("dims"),
        F.max(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("square"),
    ).first()
    dims, square = sizes["dims"], sizes["square"]
    # of equal vectors with one label only the least identifiers can ever be found
    place = Window.partitionBy("vector", "label").orderBy("id")
    least = rows.distinct().withColumn("nth", F.row_number().over(place)).filter(F.col("nth") <= keep)
    points = stage(least.groupBy("vector", "label").agg(F.collect_list("id").alias("ids")), "candidates")
    chosen = points.select("vector").orderBy(F.xxhash64("vector"), "vector").limit(sample).toPandas()
    near = augmented(_stacked(chosen["vector"], dims).astype(float), square)
    cells = max(1, min(-(-points.count() // per_block), sample // 16))
    centres, _, _ = cover(near, 0, np.sqrt(((near - near[0]) ** 2).sum(1)), 0.0, cells)
    balls = Balls(dims, square, near[centres], np.zeros(len(centres)), np.zeros(len(centres), np.int64))

    def placed(frames):
        for frame in frames:
            frame["cell"], frame["away"] = balls.nearest(_stacked(frame["vector"], dims))
            yield frame

    schema = "vector array<long>, label long, ids array<long>, cell long, away double"
    indexed = stage(points.mapInPandas(placed, schema), "cells")
    for cell in indexed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("radius")).collect():
        balls.radius[cell["cell"]] = cell["radius"]
        balls.parts[cell["cell"]] = -(-cell["n"] // per_block)
    parts = F.element_at(F.array(*(F.lit(int(p)) for p in balls.parts)), F.col("cell").cast("int") + 1)
    dealt = indexed.withColumn("part", F.pmod(F.xxhash64("vector", "label"), parts))

    def planted(frame: pd.DataFrame) -> pd.DataFrame:
        vectors = _stacked(frame["vector"], dims)
        held = np.array([len(i) for i in frame["ids"]])
        ids = np.zeros((len(frame), held.max()), np.int64)
        for row, own in zip(ids, frame["ids"]):
            row[: len(own)] = sorted(own)
        tree = CoverTree.grow(balls.lifted(vectors))
        block = Block(vectors, frame["label"].to_numpy(), ids, held, square, tree)
        return pd.DataFrame({"cell": frame["cell"][:1], "part": frame["part"][:1], "block": [block.pack()]})

    blocks = dealt.groupBy("cell", "part").applyInPandas(planted, "cell long, part long, block binary")
    return balls, stage(blocks, "blocks")


def search(balls: Balls, blocks: DataFrame, asked: DataFrame, same: bool, k: int, per_chunk: int = 4000) -> DataFrame:
    """(no, window, found_id, score, rank) for ``asked`` (no, id, label, vector, lows, highs).

    Only blocks that an anchor of a chunk visits travel to that chunk.
    """
    asked = stage(asked.select("no", "id", "label", "vector", "lows", "highs"), "asked")
    chunks = max(1, -(-asked.count() // per_chunk))

    def look(anchors: DataFrame, home: bool) -> DataFrame:
        dealt = anchors.withColumn("chunk", F.pmod(F.xxhash64("no"), F.lit(chunks)))
        # by rows and not by chunks: a task's anchors may visit every block
        went = dealt.sortWithinPartitions("chunk").mapInPandas(
            balls.visits(home), "cell long, part long, chunk long, asked binary"
        )
        went = stage(went, "visits")
        by = ["cell", "part", "chunk"]
        needed = went.select(*by).distinct().join(blocks, ["cell", "part"]).toDF("own_cell", "own_part", "own_chunk", "block")
        found = needed.groupBy("own_cell", "own_part", "own_chunk").cogroup(went.groupBy(*by)).applyInPandas(
            _descents(same, k), "no long, window int, found_id long, score long"
        )
        return stage(found, "found")

    first = look(asked, True)
    floors = _best(first, k).filter(F.col("rank") == k).select("no", "window", "score")
    floors = floors.groupBy("no").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("floors"))
    raised = F.transform("lows", lambda low, w: F.greatest(low, F.col("floors")[w]))
    bounded = asked.join(floors, "no", "left").withColumn("lows", F.coalesce(raised, "lows"))
    away = look(bounded.select(*asked.columns), False)
    return _best(first.union(away), k)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    key: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256,
    per_block: int = 2048, sample: int = 16_384,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of the vectors' components after floor(scale * x); they
    must fit 64 bits.  An anchor's positives are its ``positives`` best rows with its
    label; for each, the ``negatives`` best rows with another label are returned whose
    score is ``low`` to ``high`` per cent of the positive's.  Ties go to lesser ids.

    Rows with a null key or label, or a vector that is null or holds null or non-finite
    numbers, take no part.  A shorter vector counts as filled up with zeros.  Rows that
    repeat key, label and vector count once; different rows under one key count apart,
    but none is a positive or negative of an anchor with the same key.  A positive with
    a score below 0 has no negatives.  ``is_anchor`` is a condition on ``id``.

    Centres come from at most ``sample`` vectors; every row is indexed.  A cell of more
    than ``per_block`` vectors is several blocks, dealt by hash, and above
    ``sample // 16`` cells all grow.
    """
    spark = rows.sparkSession
    given = stage(valid_rows(rows, key, label, vector, scale), "vectors")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if given.isEmpty():
        return spark.createDataFrame([], schema)
    balls, blocks = plant(given, positives + 1, per_block, sample)
    anchors = given.filter(is_anchor).distinct().withColumn("no", F.xxhash64("id", "label", "vector"))
    anchors = stage(anchors, "anchors")
    open_ = anchors.withColumn("lows", F.array(F.lit(-FAR))).withColumn("highs", F.array(F.lit(FAR)))
    best = search(balls, blocks, open_, True, positives).filter("score >= 0")
    kin = best.select(
        "no", (F.col("rank") - 1).alias("window"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    kin = stage(kin, "positives")
    windows = kin.groupBy("no").agg(F.sort_array(F.collect_list(F.struct("window", "positive_score"))).alias("kin"))
    windows = windows.select(
        "no",
        F.expr(f"transform(kin, x -> (x.positive_score * {low} + 99) div 100)").alias("lows"),
        F.expr(f"transform(kin, x -> (x.positive_score * {high}) div 100)").alias("highs"),
    )
    found = search(balls, blocks, anchors.join(windows, "no"), False, negatives)
    return found.join(kin, ["no", "window"]).join(anchors.select("no", F.col("id").alias("anchor_id")), "no").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("found_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector; every seventh label is wrong by one."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", wrong), F.col("id") % 50 == 0)
