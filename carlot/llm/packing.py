"""Best-fit packing by linear grouping.

The packing is planned on the histogram of lengths, which has no more rows than a
sequence has tokens, however many documents there are.  Large lengths are sorted
into groups of equal cardinality and rounded up to their group's largest; a linear
program over configurations of these few sizes, with columns made by a knapsack,
says how often to use each; actual lengths are put in the places of their group;
what is left, and all small lengths, go by best fit.  The plan is a list of runs
(length, ranks, sequence, offset); Spark ranks the pieces within their length and
looks each one up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carlot.llm.token_pieces import token_pieces
from carlot.session import stage

#: A run of equal sequences: how many, and the lengths in each.
Bins = tuple[int, tuple[int, ...]]


def group_lengths(counts: np.ndarray, small: int, groups: int) -> list[tuple[int, list[list[int]]]]:
    """Linear grouping: (rounded size, [[length, count], ...] in falling order) per group."""
    lengths = [int(n) for n in np.flatnonzero(counts)[::-1] if n > small]
    total = int(sum(counts[n] for n in lengths))
    each = -(-total // groups) if total else 0
    out: list[tuple[int, list[list[int]]]] = []
    room = 0
    for n in lengths:
        left = int(counts[n])
        while left:
            if room == 0:
                if out and out[-1][0] == n:  # the same size again: one group
                    room = each
                else:
                    out.append((n, []))
                    room = each
            take = min(left, room)
            out[-1][1].append([n, take])
            left, room = left - take, room - take
    return out


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, steps: int = 800) -> list[tuple[float, np.ndarray]]:
    """Uses of each configuration in a least cover of the demand, by column generation."""
    n = len(sizes)
    most = capacity // sizes
    columns = [np.eye(n, dtype=int)[i] * most[i] for i in range(n)]
    inverse = np.diag(1.0 / most)
    use = demand / most
    for _ in range(steps):
        prices = inverse.sum(axis=0)
        best, item = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for room in range(int(sizes.min()), capacity + 1):
            best[room], item[room] = best[room - 1], -1
            fit = np.flatnonzero(sizes <= room)
            values = best[room - sizes[fit]] + prices[fit]
            top = int(values.argmax())
            if values[top] > best[room] + 1e-12:
                best[room], item[room] = values[top], fit[top]
        if best[capacity] <= 1 + 1e-6:
            break
        column, room = np.zeros(n, int), capacity
        while room > 0:
            if item[room] < 0:
                room -= 1
                continue
            column[item[room]] += 1
            room -= sizes[item[room]]
        step = inverse @ column
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        use = use - ratio[out] * step
        use[out] = ratio[out]
        columns[out] = column
        inverse[out] /= step[out]
        for i in range(n):
            if i != out:
                inverse[i] -= step[i] * inverse[out]
    return [(float(u), c) for u, c in zip(use, columns)]


def substitute(groups: list[tuple[int, list[list[int]]]], chosen: list[tuple[float, np.ndarray]]) -> list[Bins]:
    """Put actual lengths in the places of their group; used counts leave ``groups``."""
    bins: list[Bins] = []
    for uses, column in chosen:
        left = int(np.floor(uses + 1e-6))
        needs = [(g, int(k)) for g, k in enumerate(column) if k]
        while left > 0:
            for g, _ in needs:
                while groups[g][1] and groups[g][1][0][1] == 0:
                    groups[g][1].pop(0)
            if any(sum(c for _, c in groups[g][1]) < k for g, k in needs):
                break
            times = min([left, *(groups[g][1][0][1] // k for g, k in needs)])
            if times:
                items = tuple(groups[g][1][0][0] for g, k in needs for _ in range(k))
                for g, k in needs:
                    groups[g][1][0][1] -= times * k
            else:  # a length runs out within one sequence
                times, mixed = 1, []
                for g, k in needs:
                    while k:
                        run = groups[g][1][0]
                        take = min(k, run[1])
                        mixed += [run[0]] * take
                        run[1] -= take
                        k -= take
                        if run[1] == 0:
                            groups[g][1].pop(0)
                items = tuple(mixed)
            bins.append((times, items))
            left -= times
    return bins


def best_fit(bins: list[Bins], counts: np.ndarray, capacity: int) -> list[Bins]:
    """Place the lengths of ``counts``, long ones first, where least room is left."""
    open_bins: list[list[Bins]] = [[] for _ in range(capacity + 1)]
    for times, items in bins:
        open_bins[capacity - sum(items)].append((times, items))
    for length in map(int, np.flatnonzero(counts)[::-1]):
        left = int(counts[length])
        room = length
        while left:
            while room <= capacity and not open_bins[room]:
                room += 1
            if room > capacity:
                fit = capacity // length
                for times, held in ((left // fit, fit), (1, left % fit)):
                    if times and held:
                        open_bins[capacity - held * length].append((times, (length,) * held))
                break
            times, items = open_bins[room].pop()
            take = min(times, left)
            if times > take:
                open_bins[room].append((times - take, items))
            open_bins[room - length].append((take, (*items, length)))
            left -= take
            room = length
    return [b for some in open_bins for b in some]


def plan_packing(counts: np.ndarray, capacity: int, groups: int = 48, small_part: float = 3) -> list[Bins]:
    """All sequences for ``counts[length]`` pieces of each length up to ``capacity``.

    Rounding leaves gaps that small lengths may not fill.  Configured sequences
    with a gap above a tolerance are therefore taken apart before the best fit, and
    the tolerance that needs the fewest sequences is used.
    """
    grouped = group_lengths(counts, int(capacity / small_part), groups)
    if not grouped:
        return best_fit([], counts, capacity)
    sizes = np.array([s for s, _ in grouped])
    demand = np.array([float(sum(c for _, c in some)) for _, some in grouped])
    configured = substitute(grouped, configurations(sizes, demand, capacity))
    plans = []
    for gap in (capacity, 64, 16, 4, 1, 0):
        kept = [(times, items) for times, items in configured if capacity - sum(items) <= gap]
        rest = counts.copy()
        for times, items in kept:
            np.subtract.at(rest, list(items), times)
        plans.append(best_fit(kept, rest, capacity))
    return min(plans, key=lambda bins: sum(times for times, _ in bins))


def _runs(bins: list[Bins]) -> dict[str, np.ndarray]:
    """A row per place of a run of sequences: length, first rank, sequence, offset."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for times, items in bins:
        offset = 0
        for n in items:
            rows.append((n, used.get(n, 0), sequence, offset))
            used[n] = used.get(n, 0) + times
            offset += n
        sequence += times
    length, first, base, offset = np.array(sorted(rows), np.int64).reshape(-1, 4).T
    return {"key": (length << 44) + first, "first": first, "sequence": base, "offset": offset}


def _place(runs: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank = batch.column("__rank").to_numpy()
            at = np.searchsorted(runs["key"], (batch.column("length").to_numpy() << 44) + rank, "right") - 1
            found = {"sequence_id": runs["sequence"][at] + rank - runs["first"][at], "offset": runs["offset"][at]}
            names = [n for n in batch.schema.names if n != "__rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), *(pa.array(v, pa.int64()) for v in found.values())],
                names=[*names, *found],
            )

    return run


def pack(pieces: DataFrame, capacity: int, per_bucket: int = 50_000) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; ``length`` is 1 to ``capacity``.

    Pieces are ranked within their length in buckets of about ``per_bucket`` rows
    dealt by a hash of the row, so that a length that a third of the pieces share
    is no single task.  Sequence numbers start at 0 and have no gaps.  Other columns,
    token ids among them, go along.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    pieces = stage(pieces.select(columns), "pieces")
    found = pieces.groupBy("length").count().collect()
    counts = np.zeros(capacity + 1, np.int64)
    for row in found:
        counts[row["length"]] = row["count"]
    buckets = int(max(64, counts.sum() // per_bucket))
    dealt = pieces.withColumn("__bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    ahead = (
        dealt.groupBy("length", "__bucket").count()
        .withColumn("__ahead", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    )
    # arrays are long to compare; rows that agree in their hash and all else are equal
    plain = [f.name for f in pieces.schema if not isinstance(f.dataType, T.ArrayType)]
    arrays = [c for c in columns if c not in plain]
    own = Window.partitionBy("length", "__bucket").orderBy(*plain, *([F.xxhash64(*arrays)] if arrays else []))
    ranked = dealt.withColumn("__own", F.row_number().over(own)).join(ahead, ["length", "__bucket"])
    ranked = ranked.select(*columns, (F.col("__ahead") + F.col("__own") - 1).alias("__rank"))
    schema = T.StructType([*pieces.schema.fields, *(T.StructField(c, T.LongType()) for c in ("sequence_id", "offset"))])
    runs = _runs(plan_packing(counts, capacity)) if found else _runs([(1, (1,))])
    return ranked.mapInArrow(_place(runs), schema)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The column ids replaced by the crc32 of its little-endian words."""
    for batch in batches:
        lists = batch.column("ids")
        ids, bounds = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy().tolist()
        sums = [zlib.crc32(ids[a:b]) for a, b in zip(bounds, bounds[1:])]
        columns = [pa.array(sums, pa.int64()) if n == "ids" else batch.column(n) for n in batch.schema.names]
        yield pa.RecordBatch.from_arrays(columns, names=["ids_crc32" if n == "ids" else n for n in batch.schema.names])


def with_sums(placed: DataFrame) -> DataFrame:
    """``placed`` with ids_crc32 in place of ids."""
    fields = [T.StructField("ids_crc32", T.LongType()) if f.name == "ids" else f for f in placed.schema]
    return placed.mapInArrow(_sums, T.StructType(fields))


def op6_packing(spark: SparkSession, sf_dir: str, tokenizer: str | None = None, capacity: int = 2048) -> DataFrame:
    """Places of all token pieces, with a digest of their ids instead of these."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    return pack(token_pieces(docs, path, capacity, ids=False, sums=True), capacity)
