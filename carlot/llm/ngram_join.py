"""Jaccard join of word n-grams with adaptive multi-match prefixes.

Shingles have one global order, rare before frequent, by their true number of texts.
Two sets that are similar enough share at least l of the first tokens,
n - ceil(t n) + l of them.  A longer prefix (larger l) costs more postings but asks
for more matches; every set takes the l with the least estimated cost of its lists
and candidates, and a pair has to show the lesser l of the two.

Most texts need no list at all: a set too few of whose tokens stand in any other text
has no partner.  A first pass counts tokens by slots of a hash, packed by task, and
leaves the sets that may have partners; only theirs are counted token by token.

Equal sets are one class from the start.  Where lists are long, candidates are
first matched with one pivot per token, round after round while components still grow, so
a large group of near copies is linked by few checks a member; only pairs of classes that
are still in different components are then listed and checked.
A candidate whose parity bitmaps differ in more bits than similar sets may differ
in tokens cannot be similar; all others are verified on whole sets, and no list is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carlot.llm.arrow_text import byte_slices
from carlot.llm.components import components
from carlot.llm.names import free_names
from carlot.llm.shingles import shingle_sets
from carlot.session import stage

#: Tokens that meet in one bucket of the first count, on average.
PER_BUCKET = 1_000_000
#: Texts of one pack; their numbers take two bytes.
PER_PACK = 1 << 14
#: Bits of a set's parity bitmap.
PARITY = 512
#: What a posting says of its class.
POSTING = ["cls", "n", "ell", "centre", *(f"bits{i}" for i in range(PARITY // 64))]
#: Cost of checking one candidate, in postings.
CHECK = 5.0
#: After the first round, pivots go on while listing all pairs left would compare more than
#: so many postings with each, and one of so many pivot pairs holds.
LISTED = 200
WORTH = 4
#: A key list of no more rows (of one number each) may be broadcast.
BROADCAST_ROWS = 500_000


def _batches(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    for part in byte_slices(batch, text):
        for at in range(0, part.num_rows, PER_PACK):
            yield part.slice(at, PER_PACK)


def _class_of(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def _least(n, percent: int):
    """Tokens that a set of ``n`` shares with any similar one, at least."""
    return -(-n * percent // 100)


def _parity(tokens: np.ndarray) -> np.ndarray:
    """One bit per slot: whether the set holds an odd number of the slot's tokens."""
    slots = ((tokens >> np.uint64(16)) & np.uint64(PARITY - 1)).astype(np.int64)
    odd = np.bincount(slots, minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _classed(words: int, key: str, text: str, row: str):
    """Rows (key, row, cls, n) of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _batches(whole, text):
                sets = shingle_sets(batch.column(text), words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key), batch.column(row), pa.array([_class_of(s) for s in sets], pa.int64()),
                     pa.array([len(s) for s in sets], pa.int64())],
                    names=[key, row, "cls", "n"],
                )

    return run


_PACKED = "bucket long, pack long, at binary, slots binary, held binary"


def _packs(words: int, buckets: int):
    """Tokens as (bucket, slot) with the number of their text in the pack; ``held`` says
    class and size of each number and goes to one bucket, the pack's own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _batches(whole, "text"):
                sets = shingle_sets(batch.column(0), words)
                held = np.array([(_class_of(s), len(s)) for s in sets], np.int64).reshape(-1, 2).tobytes()
                pack = xxhash.xxh3_64_intdigest(held) - (1 << 63)
                tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                number = np.repeat(np.arange(len(sets)), [len(s) for s in sets]).astype(np.uint16)
                bucket = ((tokens >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                used, starts = np.unique(bucket[order], return_index=True)
                ends = [*starts[1:].tolist(), len(order)]
                slots, number = (tokens[order] & np.uint64(0xFFFFFFFF)).astype(np.uint32), number[order]
                rows = list(zip(used.tolist(), starts.tolist(), ends))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([*(b for b, _, _ in rows), pack % buckets], pa.int64()),
                        pa.array([pack] * (len(rows) + 1), pa.int64()),
                        pa.array([*(number[a:b].tobytes() for _, a, b in rows), None], pa.binary()),
                        pa.array([*(slots[a:b].tobytes() for _, a, b in rows), None], pa.binary()),
                        pa.array([*[None] * len(rows), held], pa.binary()),
                    ],
                    names=["bucket", "pack", "at", "slots", "held"],
                )

    return run


def _shared_slots(rows: pd.DataFrame) -> pd.DataFrame:
    """Of each pack in a bucket, the text numbers of slots that several texts have."""
    plain = rows[rows["held"].isna()]
    slots = [np.frombuffer(s, np.uint32) for s in plain["slots"]]
    out = rows[rows["held"].notna()][["pack", "at", "held"]]
    if slots:
        joined = np.concatenate(slots)
        _, back, counts = np.unique(joined, return_inverse=True, return_counts=True)
        common = counts[back] > 1
        ends = np.cumsum([len(s) for s in slots])
        at = [np.frombuffer(a, np.uint16)[c].tobytes() for a, c in zip(plain["at"], np.split(common, ends[:-1]))]
        found = pd.DataFrame({"pack": plain["pack"], "at": at, "held": None})
        out = pd.concat([out, found[found["at"].map(len) > 0]])
    return out


def _promising(percent: int):
    """The classes of a pack that share enough slots with other texts."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros(0, np.int64)]
        for held in rows["held"].dropna():
            known = np.frombuffer(held, np.int64).reshape(-1, 2)
            numbers = [np.frombuffer(a, np.uint16) for a in rows["at"].dropna()]
            shared = np.bincount(np.concatenate(numbers), minlength=len(known)) if numbers else np.zeros(len(known))
            out.append(known[shared >= _least(known[:, 1], percent), 0])
            break
        return pd.DataFrame({"cls": np.concatenate(out)})

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _batches(whole, "text"):
                sets = shingle_sets(batch.column(0), words)
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                bits = np.concatenate([_parity(s) for s in sets]) if sets else np.zeros(0, np.int64)
                ends = np.arange(len(sets) + 1) * (PARITY // 64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_class_of(s) for s in sets], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bits)),
                    ],
                    names=["cls", "n", "tokens", "bits"],
                )

    return run


def choose_prefix(n: int, dfs: np.ndarray, percent: int) -> tuple[int, int]:
    """(ell, shared tokens in the prefix) of the least cost; (0, 0) if there can be no partner.

    ``dfs`` are the counts of the set's shared tokens in rising order; its other tokens
    come before them.  Sets that show ``ell`` matches in lists of s1 <= s2 <= ... number
    no more than all but the ``ell`` - 1 longest lists, divided by ``ell``; the prefix grows
    by one list per match, so those lists are the same for every ``ell``.
    """
    least, alone = _least(n, percent), n - len(dfs)
    if len(dfs) < least:
        return 0, 0
    spare = n - least - alone  # shared tokens of the prefix that asks for no match
    sums = np.concatenate([[0], np.cumsum(dfs - 1)]).astype(float)
    ells = np.arange(1, least + 1)
    cost = sums[spare + ells] + CHECK * sums[spare + 1] / ells
    ell = int(cost.argmin()) + 1
    return ell, spare + ell


def _prefixes(percent: int):
    """Rows (cls, n, ell, centre, tokens, places): the chosen prefix's shared tokens and their
    places in the order; ``centre`` is large where a set's tokens are frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"cls": [], "n": [], "ell": [], "centre": [], "tokens": [], "places": []}
            for cls, n, held in zip(*(batch.column(c).to_pylist() for c in ("cls", "n")), batch.column("held")):
                rows = held.values
                dfs = rows.field("df").to_numpy()
                ell, size = choose_prefix(n, dfs, percent)
                if not ell:
                    continue
                out["cls"].append(cls)
                out["n"].append(n)
                out["ell"].append(ell)
                out["centre"].append(int(dfs.sum()) // n)
                out["tokens"].append(rows.field("token").to_numpy()[:size])
                out["places"].append(np.arange(size) + (n - len(dfs)))
            kinds = {"tokens": pa.list_(pa.int64()), "places": pa.list_(pa.int64())}
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(c, pa.int64())) for c, v in out.items()], names=list(out))

    return run


def keep_rows(rows: DataFrame, keys: DataFrame, on: str, how: str = "left_semi") -> DataFrame:
    """Semi or anti join with a staged one-column key list, broadcast only if it is short."""
    if keys.count() <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return rows.join(keys, on, how)


def _least_overlap(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / 100).cast("long")


def _least_shared(na: Column, nb: Column, percent: int) -> Column:
    """Tokens that two sets of these sizes share if they are similar."""
    return F.ceil((na + nb) * percent / (100 + percent)).cast("long")


def _may_link(docs: DataFrame, rows: DataFrame, words: int, percent: int) -> DataFrame:
    """Staged (cls, n, tokens, bits) of the classes that may have partners.

    ``docs`` has (text, row), ``rows`` (row, cls, n).
    """
    single = rows.filter("n > 0").groupBy("cls").agg(F.min("row").alias("row"), F.first("n").alias("n"))
    single = stage(single, "classes")
    tokens = single.agg(F.sum("n")).first()[0] or 0
    buckets = int(max(64, tokens // PER_BUCKET))
    copies = stage(rows.join(single.select("row"), "row", "left_anti").select("row").distinct(), "copies")
    texts = keep_rows(docs, copies, "row", "left_anti").select("text")
    shared = texts.mapInArrow(_packs(words, buckets), _PACKED).groupBy("bucket").applyInPandas(
        _shared_slots, "pack long, at binary, held binary"
    )
    found = stage(shared.groupBy("pack").applyInPandas(_promising(percent), "cls long").distinct(), "promising")
    wanted = stage(single.join(found, "cls").select("row"), "rows")
    return stage(keep_rows(docs, wanted, "row").select("text").mapInArrow(
        _sets(words), "cls long, n long, tokens array<long>, bits array<long>"
    ).dropDuplicates(["cls"]), "sets")


def _posted(sets: DataFrame, percent: int) -> DataFrame:
    """Staged postings of the chosen prefixes: ``POSTING`` with token and place."""
    each = sets.select("cls", "n", F.explode("tokens").alias("token"))
    df = each.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1")
    held = each.join(df, "token").groupBy("cls").agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("held")
    )
    held = held.filter(F.size("held") >= _least_overlap(F.col("n"), percent))
    schema = "cls long, n long, ell long, centre long, tokens array<long>, places array<long>"
    words = [F.col("bits")[i].alias(f"bits{i}") for i in range(PARITY // 64)]
    chosen = held.mapInArrow(_prefixes(percent), schema).join(sets.select("cls", *words), "cls")
    chosen = chosen.withColumn("x", F.explode(F.arrays_zip("tokens", "places")))
    return stage(chosen.select(*POSTING, F.col("x.tokens").alias("token"), F.col("x.places").alias("place")), "postings")


def _larger(x: str, y: str) -> Column:
    return F.struct(F.col(f"{x}.n"), F.col(f"{x}.cls")) > F.struct(F.col(f"{y}.n"), F.col(f"{y}.cls"))


def _match(percent: int) -> Column:
    """Whether a token of postings ``x`` and ``y`` may be one of a similar pair's.

    It stands in both prefixes of the lesser ``ell``, the sizes are near enough, and so
    are the places: what the sets share up to there and behind is enough together.  The
    bitmaps differ in no more bits than similar sets may differ in tokens.
    """
    nx, ny, px, py = (F.col(c) for c in ("x.n", "y.n", "x.place", "y.place"))
    ell = F.least("x.ell", "y.ell")
    early = (px < nx - _least_overlap(nx, percent) + ell) & (py < ny - _least_overlap(ny, percent) + ell)
    most = F.least(px, py) + F.least(nx - px, ny - py)
    near = F.least(nx, ny) * 100 >= F.greatest(nx, ny) * percent
    shared = _least_shared(nx, ny, percent)
    differ = sum((F.bit_count(F.col(f"x.bits{i}").bitwiseXOR(F.col(f"y.bits{i}"))) for i in range(PARITY // 64)), F.lit(0))
    return (F.col("x.token") == F.col("y.token")) & near & early & (most >= shared) & (differ <= nx + ny - 2 * shared)


def _enough(matches: DataFrame, percent: int) -> DataFrame:
    """Pairs with as many matches as the lesser ``ell`` asks for, and as their sizes ask for.

    With all common tokens of both prefixes of that ``ell`` counted, what else two sets
    share lies behind the prefix of the one whose prefix ends first.
    """
    counted = matches.groupBy("a", "b").agg(F.count("*").alias("shared"), *(F.first(c).alias(c) for c in ("ell", "na", "nb")))
    na, nb, ell = F.col("na"), F.col("nb"), F.col("ell")
    behind = F.greatest(_least_overlap(na, percent), _least_overlap(nb, percent)) - ell
    needed = F.greatest(ell, _least_shared(na, nb, percent) - behind)
    return counted.filter(F.col("shared") >= needed).select("a", "b")


def _pivot_pairs(spread: DataFrame, percent: int, turn: int) -> DataFrame:
    """Classes with those pivots of their tokens that are of another component.

    A token's pivot is its most central class, from the second turn on of a quarter of
    its classes chosen by hash.
    """
    chosen = F.lit(True) if turn == 0 else F.pmod(F.xxhash64("cls", F.lit(turn)), F.lit(4)) == 0
    pivot = spread.groupBy("token").agg(
        F.max_by(F.struct(*POSTING, "place", "comp"), F.struct(chosen.alias("chosen"), "centre", "cls")).alias("p")
    )
    x, y = spread.alias("x"), pivot.select("token", "p.*").alias("y")
    near = x.join(y, _match(percent) & (F.col("x.comp") != F.col("y.comp")))
    return near.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct()


def _major(spread: DataFrame) -> DataFrame:
    """(token, major, k, most): a token's postings, and the component that has most of them."""
    held = spread.groupBy("token", "comp").agg(F.count("*").alias("k"))
    return held.groupBy("token").agg(
        F.max_by("comp", F.struct("k", "comp")).alias("major"), F.sum("k").alias("k"), F.max("k").alias("most")
    )


def _cross_cost(spread: DataFrame) -> float:
    """Pairs that ``_cross_pairs`` would list for each posting."""
    sums = _major(spread).agg(F.sum((F.col("k") - F.col("most")) * F.col("k")).alias("pairs"), F.sum("k").alias("k")).first()
    return (sums["pairs"] or 0) / max(1, sums["k"] or 0)


def _cross_pairs(spread: DataFrame, percent: int) -> DataFrame:
    """All candidates whose classes are in different components (column ``comp``).

    Of such two at least one is outside of the component with most of the token's
    postings; so those are matched with all, and the large component not with itself.
    """
    major = _major(spread).select("token", "major")
    own = stage(spread.join(major, "token").withColumn("minor", F.col("comp") != F.col("major")).drop("major"), "postings")
    x, y = own.filter("minor").alias("x"), own.alias("y")
    met = x.join(y, _match(percent) & (F.col("x.comp") != F.col("y.comp")) & (_larger("x", "y") | ~F.col("y.minor")))
    first = F.col("x.cls") < F.col("y.cls")
    named = {"a": ("x.cls", "y.cls"), "b": ("y.cls", "x.cls"), "na": ("x.n", "y.n"), "nb": ("y.n", "x.n")}
    met = met.select(
        F.least("x.ell", "y.ell").alias("ell"), *(F.when(first, F.col(p)).otherwise(F.col(q)).alias(n) for n, (p, q) in named.items())
    )
    return _enough(met, percent)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are similar enough, with ``shared`` tokens."""
    pairs = stage(pairs, "pairs")
    both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta")), "a").join(
        sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb")), "b"
    )
    shared = F.size(F.array_intersect("ta", "tb"))
    both = both.select("a", "b", F.size("ta").alias("na"), F.size("tb").alias("nb"), shared.alias("shared"))
    return stage(both.filter(F.col("shared") * 100 >= (F.col("na") + F.col("nb") - F.col("shared")) * percent), "links")


def _spread(posted: DataFrame, tied: DataFrame | None) -> DataFrame:
    """Staged postings of tokens that several components hold, with their component ``comp``."""
    if tied is not None:
        posted = posted.join(tied.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
            "comp", F.coalesce("component", "cls")
        ).drop("component")
    else:
        posted = posted.withColumn("comp", F.col("cls"))
    mixed = posted.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    return stage(posted.join(mixed.select("token"), "token", "left_semi"), "postings")


def _tied(sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the classes that have links."""
    spread = _spread(_posted(sets, percent), None)
    links, turn = sets.sparkSession.createDataFrame([], "a long, b long"), 0
    while turn == 0 or _cross_cost(spread) > LISTED:
        pairs = stage(_pivot_pairs(spread, percent, turn), "pivots")
        new = _verified(pairs, sets, percent).select("a", "b")
        links = links.union(new)
        spread = _spread(spread.drop("comp"), stage(components(links), "components"))
        turn += 1
        if new.count() * WORTH <= pairs.count():  # none at all ends it too
            break
    more = _verified(_cross_pairs(spread, percent), sets, percent).select("a", "b")
    return stage(components(links.union(more)), "components")


def _rows_of(docs: DataFrame, words: int, text: str, key: str, row: str) -> DataFrame:
    """Staged (key, row, cls, n)."""
    schema = T.StructType([docs.schema[key], *(T.StructField(c, T.LongType()) for c in (row, "cls", "n"))])
    return stage(docs.select(key, row, text).mapInArrow(_classed(words, key, text, row), schema), "rows")


def _grouped(docs: DataFrame, words: int, percent: int, text: str, key: str, row: str) -> tuple[DataFrame, DataFrame]:
    """Rows (key, row, cls, n) of ``docs``, and (cls, first) with the component's least (key, row)."""
    rows = _rows_of(docs, words, text, key, row)
    plain = rows.select(F.col(row).alias("row"), "cls", "n")
    sets = _may_link(docs.select(F.col(text).alias("text"), F.col(row).alias("row")), plain, words, percent)
    tied = _tied(sets, percent).withColumnRenamed("node", "cls")
    known = F.when(F.col(key).isNotNull(), F.struct(F.col(key).alias("key"), F.col(row).alias("row")))
    firsts = rows.filter("n > 0").groupBy("cls").agg(
        F.coalesce(F.min(known), F.min(F.struct(F.col(key).alias("key"), F.col(row).alias("row")))).alias("first")
    )
    named = firsts.join(tied, "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    with_key = F.when(F.col("first.key").isNotNull(), F.col("first"))
    least = named.groupBy("component").agg(F.coalesce(F.min(with_key), F.min("first")).alias("least"))
    named = named.drop("first").join(least, "component").select("cls", F.col("least").alias("first"))
    return rows, stage(named, "classes")


def similar_groups(
    docs: DataFrame, words: int, percent: int, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_shingles``, ``component_id``.

    Rows link when 100 * intersection >= ``percent`` * union of their sets of
    ``words``-word shingles; ``component_id`` is the least key that links reach.
    A row without words, or with a null text, has no shingles and links with
    nothing; its component is its own key.  Null keys lose to all others.  Rows that
    repeat, and other texts with the same set, are linked; an empty table gives no rows.
    Shingles and classes of equal sets are told apart by 64-bit hashes.
    """
    row = free_names(docs, "row")[0]
    marked = docs.select(key, text).withColumn(row, F.xxhash64(key, F.coalesce(text, F.lit(""))))
    rows, named = _grouped(marked, words, percent, text, key, row)
    linked = rows.filter("n > 0").join(named, "cls")
    alone = rows.filter("n = 0").select(key, F.col("n").alias("n_shingles"), F.col(key).alias("component_id"))
    return linked.select(key, F.col("n").alias("n_shingles"), F.col("first.key").alias("component_id")).union(alone)


def similar_pairs(
    docs: DataFrame, words: int, percent: int, text: str = "text", key: str = "doc_id"
) -> tuple[DataFrame, DataFrame]:
    """The whole join: (a, b, na, nb, shared) of all linked classes, and (key, cls, n_shingles, n_links).

    Texts with one set are a class, and their links are not listed one by one: a row's
    ``n_links`` are the other rows of its class and all rows of the classes linked with
    it.  Rows without words have no class and no links.  The pairs of a large group of
    near copies are as many as its classes squared; ``similar_groups`` does without.
    """
    row = free_names(docs, "row")[0]
    marked = docs.select(key, text).withColumn(row, F.xxhash64(key, F.coalesce(text, F.lit(""))))
    rows = _rows_of(marked, words, text, key, row)
    plain = rows.select(F.col(row).alias("row"), "cls", "n")
    sets = _may_link(marked.select(F.col(text).alias("text"), F.col(row).alias("row")), plain, words, percent)
    links = _verified(_cross_pairs(_spread(_posted(sets, percent), None), percent), sets, percent)
    sizes = stage(rows.filter("n > 0").groupBy("cls").agg(F.count("*").alias("members")), "sizes")
    both = links.select("a", "b").union(links.select("b", "a")).toDF("cls", "other")
    away = both.join(sizes.toDF("other", "weight"), "other").groupBy("cls").agg(F.sum("weight").alias("away"))
    counted = sizes.join(away, "cls", "left").select("cls", (F.col("members") - 1 + F.coalesce("away", F.lit(0))).alias("n_links"))
    linked = rows.filter("n > 0").join(counted, "cls").select(key, "cls", F.col("n").alias("n_shingles"), "n_links")
    alone = rows.filter("n = 0").select(key, F.lit(None).cast("long"), "n", F.lit(0).cast("long"))
    return links, linked.union(alone)


def drop_near_copies(
    docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """``docs`` with one document of each group of similar ones, the one with the least key.

    Rows that repeat a key and its text are one document and stay or go together; a null
    key loses to all others.  Documents without words, or with a null text, stay.  All
    columns of ``docs`` come back as they are.
    """
    row = free_names(docs, "row")[0]
    marked = docs.withColumn(row, F.xxhash64(key, F.coalesce(text, F.lit(""))))
    rows, named = _grouped(marked.select(key, text, row), words, percent, text, key, row)
    gone = rows.filter("n > 0").join(named, "cls").filter(F.col(row) != F.col("first.row")).select(row).distinct()
    return keep_rows(marked, stage(gone, "near-copies"), row, "left_anti").select(*docs.columns)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles agree by 90 per cent."""
    return similar_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), 3, 90)
