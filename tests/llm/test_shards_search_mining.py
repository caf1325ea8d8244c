"""Sharding, lexical search and hard negatives against brute force and on odd rows."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from carlot.llm import hard_negatives as mining
from carlot.llm import lexical_search, sharding
from carlot.session import scratch_path

ODD = [None, "", " \t\n", "Same Text", "same text", "Same Text", "é ÉCOLE x1y2", "a\x00b-c_d", "日本語 ok", "word " * 3000]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "x", 7, "y") for i, t in enumerate(ODD)]
    rows += [(None, "Same Text", "x", 7, "y"), (3, "Same Text", "x", 7, "y"), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, shard string, n long, __mark string")


@pytest.fixture(scope="module")
def no_rows(odd):
    return odd.limit(0)


@pytest.mark.parametrize("size", [1, 2, 3, 10, 99, 100, 101, 4097])
def test_permutation_is_one(size):
    chosen = sharding.Permutation(size, "k")
    places = chosen.of(np.arange(size))
    assert sorted(places) == list(range(size))
    assert (chosen.inverse(places) == np.arange(size)).all()
    if size > 50:
        assert (places != sharding.Permutation(size, "other").of(np.arange(size))).any()
        assert abs(np.corrcoef(places, np.arange(size))[0, 1]) < 0.35


def test_permutation_of_many_rows():
    size = 3 * 10**12 + 7
    numbers = np.random.default_rng(0).integers(0, size, 5000)
    chosen = sharding.Permutation(size, "k")
    places = chosen.of(numbers)
    assert places.min() >= 0 and places.max() < size and (chosen.inverse(places) == numbers).all()
    assert next(chosen.rows_of(3, 8))[:2].tolist() == chosen.inverse(np.array([3, 11])).tolist()


def check_law(rows, shards):
    for shard in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    counts = Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(shards)) <= 1


def test_shards(spark, odd, no_rows):
    rows = sharding.assign_shards(odd, 4, "s").collect()
    assert len(rows) == odd.count()
    check_law(rows, 4)
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in odd.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    chosen = sharding.Permutation(len(rows), "s")
    assert all(chosen.of([r.row_number])[0] == r.slot * 4 + r.shard for r in rows)
    other = sharding.assign_shards(odd.repartition(7), 4, "s").collect()
    assert sorted(map(str, rows)) == sorted(map(str, other))
    assert sharding.assign_shards(no_rows, 4, "s").count() == 0


def test_row_numbers_of_many_equal_rows(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("k"))
    found = sharding.numbered(rows, ["k"], per_run=64).collect()
    assert [r.row_number for r in sorted(found, key=lambda r: (r.k, r.row_number))] == list(range(5000))


def test_written_shards_hold_rows_in_slot_order(spark, odd):
    path = scratch_path(spark, "shards")
    sharding.write_shards(odd, path, 3, "s", per_file=4)
    back = spark.read.parquet(path)
    assert set(back.columns) == {*odd.columns, "shard", "slot"}
    rows = back.collect()
    check_law(rows, 3)
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in odd.collect())
    said = Counter((r.doc_id, r.shard, r.slot) for r in sharding.assign_shards(odd, 3, "s").collect())
    assert Counter((r.doc_id, r.shard, r.slot) for r in rows) == said
    files = back.select(F.input_file_name().alias("f"), "slot").collect()
    for name in {r.f for r in files}:
        own = [r.slot for r in files if r.f == name]
        assert own == list(range(min(own), min(own) + len(own)))


def test_sharding_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = sharding.op11_sharding(spark, folder).collect()
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(docs) and {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
    check_law(rows, 8)
    assert all((r.size, r.text_crc32) == (len(docs[r.doc_id].encode()) + 1, zlib.crc32(docs[r.doc_id].encode())) for r in rows)


def terms(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)


def ranking(docs, items, k):
    """All scores by the formula: docs and items are (key, text)."""
    held = [(key, Counter(terms(t)), len(terms(t))) for key, t in docs]
    n_docs, length = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, counts, n in held:
            m = 100 - 75 + (75 * n * n_docs) // max(1, length)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * counts[t]) // (1000 * counts[t] + 8 * m))
                for t in terms(text) if counts[t]
            )
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        out += [(item, rank + 1, key, -s) for rank, (s, _, _, key) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return Counter(out)


def random_texts(rng, n, words):
    return [" ".join(f"w{min(v, 60)}" for v in rng.zipf(1.3, int(rng.integers(0, words)))) for _ in range(n)]


@pytest.mark.parametrize("passes", [50_000, 40])
def test_search(spark, monkeypatch, passes):
    monkeypatch.setattr(lexical_search, "CELLS", 1)  # many small blocks
    rng = np.random.default_rng(1)
    docs = list(enumerate(ODD + random_texts(rng, 900, 60))) + [(None, "w1 w2 w3"), (None, "w1 w2 w3"), (5, "w1 w2 w3")]
    items = list(enumerate(random_texts(rng, 12, 30))) + [(3, "same SAME text, text!"), (20, None), (21, "?"), (None, "w1 w2"), (22, "nowhere")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = lexical_search.search(rows, asked, k=10, terms_a_pass=passes)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, found.collect())) == ranking(docs, items, 10)


def test_search_odd_rows(spark, odd, no_rows):
    items = spark.createDataFrame([(1, "same text école")], "item_id long, text string")
    want = ranking([(r.doc_id, r.text) for r in odd.collect()], [(1, "same text école")], 3)
    assert Counter(map(tuple, lexical_search.search(odd, items, k=3).collect())) == want
    assert lexical_search.search(no_rows, items).count() == 0
    assert lexical_search.search(odd, items.limit(0)).count() == 0


def test_best_positions_stop_early():
    """A document far ahead in all lists ends the search before the lists are read."""
    rng = np.random.default_rng(2)
    docs, lists = 4000, 6
    impact = rng.integers(1, 1000, (lists, docs))
    impact[:, 17] = 10_000
    term, doc = np.divmod(np.arange(lists * docs), docs)
    blocks = lexical_search.ImpactLists(term, doc, impact.ravel(), lists, docs)
    reads = []

    class Counting(np.ndarray):
        def __getitem__(self, at):
            out = super().__getitem__(at)
            if isinstance(at, slice):
                reads.append(len(out))
            return out

    blocks.doc = blocks.doc.view(Counting)
    found, scores = blocks.best(np.arange(lists), np.ones(lists, np.int64), 1, 0)
    assert found.tolist() == [17] and scores.tolist() == [60_000]
    assert sum(reads) <= 8 * lists


def brute_negatives(rows, anchors, k, m, low=50, high=95):
    """rows: distinct (id, label, whole-number vector)."""
    out = Counter()
    width = max(len(v) for *_, v in rows)
    full = [(i, lab, np.array([*v, *[0] * (width - len(v))], object)) for i, lab, v in rows]
    for a, lab, q in full:
        if a % anchors:
            continue
        scored = [(-int(q @ v), i, own) for i, own, v in full if i != a]
        kin = sorted((s, i) for s, i, own in scored if own == lab)[:k]
        for s, i in kin:
            fit = sorted((t, j) for t, j, own in scored if own != lab and low * -s <= 100 * -t <= high * -s)[:m]
            out.update((a, i, rank + 1, j, -s, -t) for rank, (t, j) in enumerate(fit))
    return out


def mined(found):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r[n] for n in names) for r in found.collect())


@pytest.mark.parametrize("per_block, spread", [(40, 0.05), (40, 3.0), (1000, 0.3)])
def test_hard_negatives(spark, per_block, spread):
    """Tight groups, spread ones, ties by small whole numbers, one hot vector."""
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(9, 6)) * 4
    rows = [(i, i % 4, [float(x) for x in np.floor(middles[i % 9] + rng.normal(size=6) * spread)]) for i in range(500)]
    rows += [(1000 + i, i % 3, [1.0] * 6) for i in range(120)] + [(900, 1, [2.0, 2.0]), (900, 2, [1.0])]
    # what takes no part, and what repeats
    odd = [(None, 1, [1.0] * 6), (901, None, [1.0] * 6), (902, 1, None), (903, 1, [1.0, None]), (904, 1, [float("nan")]),
           (905, 1, [float("inf")]), rows[0], rows[7]]
    frame = spark.createDataFrame(rows + odd, "vec_id long, label int, embedding array<double>")
    found = mining.hard_negatives(frame.repartition(3), F.col("id") % 20 == 0, scale=1, per_block=per_block, sample=256)
    assert mined(found) == brute_negatives(rows, 20, 5, 3)


def test_visits_and_products_come_in_bounded_amounts(monkeypatch):
    """Anchors that may visit every block are handed on bit by bit, and verified so."""
    rng = np.random.default_rng(5)
    n, cells = 700, 90
    vectors = rng.integers(-9, 10, (n, 4))
    balls = mining.Balls(4, 400.0, rng.normal(size=(cells, 5)) * 10, np.full(cells, 60.0), np.full(cells, 2))
    far = mining.FAR
    frame = pd.DataFrame({
        "no": np.arange(n) + 5000, "id": np.arange(n), "label": np.arange(n) % 3, "vector": list(vectors),
        "lows": [[-far, far]] * n, "highs": [[far, -far]] * n, "chunk": np.arange(n) % 2,
    })
    monkeypatch.setattr(mining, "HANDED", 50_000)
    handed = list(balls.visits(False)([frame]))
    assert max(f["asked"].map(len).sum() for f in handed) < 60_000
    seen = Counter()
    for row in pd.concat(handed).itertuples():
        asked = mining.Asked.unpack([row.asked])
        assert (asked.vectors == vectors[asked.own]).all() and set(asked.own % 2) == {row.chunk}
        assert asked.lows.tolist() == [[-far, far]] * len(asked.own)
        seen.update((int(a), row.cell, row.part) for a in asked.own)
    own, _ = balls.nearest(vectors)
    assert seen == Counter((a, c, p) for a in range(n) for c in range(cells) if c != own[a] for p in range(2))

    points = rng.integers(-9, 10, (300, 4))
    square = float((points * points).sum(1).max())
    one = np.ones(300, np.int64)
    block = mining.Block(points, one, np.arange(300)[:, None] + 9000, one, square, mining.CoverTree.grow(mining.augmented(points.astype(float), square)))
    sizes, products = [], mining.Block.products
    monkeypatch.setattr(mining.Block, "products", lambda self, q, r: sizes.append(len(q) * len(r)) or products(self, q, r))
    monkeypatch.setattr(mining, "TABLE", 4000)
    ends = np.full((n, 1), far)
    mining.Descent(block, vectors, np.arange(n), np.ones(n, np.int64), True, -ends, ends, 5).verify(np.arange(n), np.arange(300))
    assert max(sizes) <= 4000 and sum(sizes) == n * 300


def test_hard_negatives_without_rows(spark):
    none = spark.createDataFrame([(1, 1, None)], "vec_id long, label int, embedding array<float>")
    assert mining.hard_negatives(none, F.lit(True)).count() == 0
    zeros = spark.createDataFrame([(i, i % 2, [0.0] * 3) for i in range(6)], "vec_id long, label int, embedding array<float>")
    assert mined(mining.hard_negatives(zeros, F.col("id") < 2)) == brute_negatives([(i, i % 2, [0] * 3) for i in range(6)], 99, 5, 3) + Counter(
        {(1, p, r + 1, n, 0, 0): 1 for p in (3, 5) for r, n in enumerate((0, 2, 4))}
    )


def test_cover_tree_covers_and_parts():
    rng = np.random.default_rng(4)
    points = np.concatenate([rng.normal(size=(400, 5)), rng.normal(size=(300, 5)) * 0.01 + 4, np.ones((60, 5))])
    tree = mining.CoverTree.grow(points)
    assert sorted(tree.rows.tolist()) == list(range(len(points)))
    assert (tree.children > 0).sum() > 5

    def below(node):
        if tree.leaves[node]:
            return tree.rows[tree.leaf[node] : tree.leaf[node] + tree.leaves[node]]
        return np.concatenate([below(c) for c in range(tree.child[node], tree.child[node] + tree.children[node])])

    for node in range(len(tree.centre)):
        away = np.linalg.norm(points[below(node)] - points[tree.centre[node]], axis=1)
        assert away.max() <= tree.radius[node] + 1e-6
        kids = tree.centre[tree.child[node] : tree.child[node] + tree.children[node]]
        if len(kids) > 1:
            level = mining.BASE ** (math.ceil(math.log(tree.radius[node]) / math.log(mining.BASE) - 1e-9) - 1)
            gaps = np.linalg.norm(points[kids][:, None] - points[kids][None], axis=2) + 99 * np.eye(len(kids))
            assert gaps.min() > level - 1e-6  # apart
            assert tree.radius[tree.child[node] : tree.child[node] + len(kids)].max() <= level + 1e-6  # covered


def test_bounds_hold_products():
    rng = np.random.default_rng(5)
    vectors = rng.integers(-50, 50, (200, 8)).astype(float)
    square = float((vectors**2).sum(1).max())
    lifted = mining.augmented(vectors, square)
    assert np.allclose((lifted**2).sum(1), square)
    radius = np.linalg.norm(lifted - lifted[0], axis=1)
    for query in rng.integers(-50, 50, (20, 8)).astype(float):
        order = np.argsort(radius)
        low, high = mining.product_bounds(np.full(200, vectors[0] @ query), radius, math.sqrt(query @ query), square)
        products = vectors @ query
        for i, at in enumerate(order):
            some = products[order[: i + 1]]
            assert low[at] <= some.min() and some.max() <= high[at]


def test_descent_skips_what_lies_outside():
    """With tight groups only a few points are verified."""
    rng = np.random.default_rng(6)
    middles = rng.normal(size=(20, 8)) * 200
    vectors = np.floor(np.repeat(middles, 50, axis=0) + rng.normal(size=(1000, 8))).astype(np.int64)
    square = float((vectors**2).sum(1).max())
    tree = mining.CoverTree.grow(mining.augmented(vectors.astype(float), square))
    block = mining.Block(vectors, np.arange(1000) % 2, np.arange(1000)[:, None], np.ones(1000, int), square, tree)
    block = mining.Block.unpack(block.pack())
    verified = []
    plain = block.products
    block.products = lambda queries, rows: verified.append(len(queries) * len(rows)) or plain(queries, rows)
    one, far = np.zeros(1, np.int64), np.array([[mining.FAR]])
    best = mining.Descent(block, vectors[:1], one, one, True, -far, far, 5).run().found[0]
    products = vectors @ vectors[0]
    want = sorted((-products[i], i) for i in range(2, 1000, 2))[:5]
    assert [(i, p) for _, p, i in best.tolist()] == [(i, -s) for s, i in want]
    assert sum(verified) < 300
