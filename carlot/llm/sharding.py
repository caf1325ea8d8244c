"""Shards by a keyed permutation of global row numbers.

Rows are numbered in the order of their key and content, whatever files and tasks they
lie in.  A Feistel network permutes the smallest grid that holds all numbers; where
it leads out of them it is applied again until it leads back in (cycle walking), which
is again a permutation.  The permuted number alone says shard and slot, and the inverse
finds the row of any slot, so a shuffle can be repeated, resumed or read in part without
a list of it.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carlot.llm.names import free_names
from carlot.session import stage

_ROW_BITS = 33  # low bits of monotonically_increasing_id: row number in its partition


@dataclass(frozen=True)
class Permutation:
    """A permutation of 0 .. ``size`` - 1 chosen by ``key``."""

    size: int
    key: str
    rounds: int = 8

    def _grid(self) -> tuple[int, int]:
        """Rows and columns of the grid: rows * columns >= size, by less than one row."""
        rows = max(1, math.isqrt(max(0, self.size - 1)) + 1)
        return rows, max(1, -(-self.size // rows))

    def _round(self, turn: int, half: np.ndarray, sides: int) -> np.ndarray:
        seed = hashlib.sha256(f"{self.key}:{self.size}:{turn}".encode()).digest()
        add, by = (np.frombuffer(seed[i : i + 8], "<u8")[0] | np.uint64(1) for i in (0, 8))
        with np.errstate(over="ignore"):
            x = half.astype(np.uint64) * by + add
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(29))) * by
        return ((x ^ (x >> np.uint64(32))) % np.uint64(sides)).astype(np.int64)

    def _step(self, x: np.ndarray, back: bool) -> np.ndarray:
        """The network on numbers left * columns + right of the whole grid."""
        rows, columns = self._grid()
        left, right = x // columns, x % columns
        turns = range(self.rounds)
        for turn in reversed(turns) if back else turns:
            if turn % 2:
                left = (left + (-1 if back else 1) * self._round(turn, right, rows)) % rows
            else:
                right = (right + (-1 if back else 1) * self._round(turn, left, columns)) % columns
        return left * columns + right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        x = self._step(np.asarray(x, np.int64), back)
        while (out := x >= self.size).any():
            x[out] = self._step(x[out], back)
        return x

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, False)

    def inverse(self, places: np.ndarray) -> np.ndarray:
        return self._walk(places, True)

    def rows_of(self, shard: int, shards: int) -> Iterator[np.ndarray]:
        """Row numbers of a shard in the order of its slots, in pieces."""
        for start in range(shard, self.size, shards << 16):
            yield self.inverse(np.arange(start, min(self.size, start + (shards << 16)), shards))


def numbered(rows: DataFrame, order: list[str], per_run: int = 100_000) -> DataFrame:
    """(``order``, row_number): global numbers from 0 in the order of the columns, nulls first.

    Rows that agree in all columns are counted before the shuffle and stand as one
    until the end, so that many copies of a row neither sort nor travel apart.
    Only one count per range goes through an undivided window.
    """
    n, start, chunk, run, spot = free_names(rows, "n", "start", "chunk", "run", "spot")
    at = F.monotonically_increasing_id()
    placed = stage(
        rows.groupBy(*order).agg(F.count("*").alias(n)).repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn(chunk, F.shiftright(at, _ROW_BITS)).withColumn(spot, at),
        "numbered",
    )
    # one row per range; as many as there are shuffle partitions
    earlier = Window.orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(chunk).agg(F.sum(n).alias("sum")).select(
        chunk, F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias(start)
    )
    inside = Window.partitionBy(chunk).orderBy(spot).rowsBetween(Window.unboundedPreceding, -1)
    known = placed.withColumn(spot, F.coalesce(F.sum(n).over(inside), F.lit(0))).join(F.broadcast(starts), chunk)
    known = known.withColumn(start, F.col(start) + F.col(spot))
    single = known.filter(F.col(n) == 1).select(*order, F.col(start).alias("row_number"))
    many = known.filter(F.col(n) > 1).select(
        *order, n, start, F.explode(F.sequence(F.lit(0).cast("long"), (F.col(n) - 1).cast("long"), F.lit(per_run).cast("long"))).alias(run)
    )
    last = F.least(F.col(run) + per_run, F.col(n)) - 1
    many = many.repartition(F.col(start), F.col(run)).select(
        *order, start, F.explode(F.sequence(F.col(run), last)).alias(run)
    ).select(*order, (F.col(start) + F.col(run)).alias("row_number"))
    return single.union(many)


def permuted(number: Column, size: int, key: str) -> Column:
    """The place of a row number in the permutation."""
    chosen = Permutation(size, key)

    @F.pandas_udf("long")
    def place(numbers: pd.Series) -> pd.Series:
        return pd.Series(chosen.of(numbers.to_numpy()))

    return place(number)


def text_size(text: str) -> Column:
    """UTF-8 bytes of a text and its end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def assign_shards(docs: DataFrame, shards: int, seed: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, size, text_crc32, row_number, shard, slot), one row per row of ``docs``.

    Rows are numbered by key, then size, CRC-32 and a hash of the text; null keys come
    first, a null text is empty.  The permuted number is dealt out in turn: it modulo
    ``shards`` is the shard, divided by it the slot, so counts are at most one apart and
    slots have no gaps.  Rows that agree in all of these are alike, and which of
    them gets which slot makes no difference.  An empty table has no shards.  Other
    columns take no part; ``row_number`` and ``seed`` lead back from a slot to its row.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    mark = free_names(docs, "mark")[0]
    rows = docs.select(
        key, text_size(text).alias("size"), F.crc32(body).alias("text_crc32"), F.xxhash64(body).alias(mark)
    )
    given = stage(numbered(rows, [key, "size", "text_crc32", mark]).drop(mark), "row-numbers")
    placed = given.withColumn("slot", permuted(F.col("row_number"), max(1, given.count()), seed))
    return placed.select(
        key, "size", "text_crc32", "row_number",
        F.pmod("slot", F.lit(shards)).cast("int").alias("shard"), F.expr(f"slot div {shards}").alias("slot"),
    )


def write_shards(
    docs: DataFrame, path: str, shards: int, seed: str, key: str = "doc_id", text: str = "text", per_file: int = 100_000
) -> None:
    """Write ``docs`` with ``slot`` as one folder ``shard=`` per shard, rows in the order of slots.

    A file has about ``per_file`` consecutive slots, so no task holds a whole shard.
    Columns ``shard`` and ``slot`` of ``docs`` are replaced.  Numbers are those of
    ``assign_shards``; rows that agree in key and text are told apart by their place.
    """
    docs = docs.drop("shard", "slot")
    mark, row = free_names(docs, "mark", "row")
    body = F.coalesce(F.col(text), F.lit(""))
    rows = stage(docs.withColumn(row, F.monotonically_increasing_id()), "shard-rows")
    total = rows.count()
    narrow = rows.select(
        key, text_size(text).alias("size"), F.crc32(body).alias("text_crc32"), F.xxhash64(body).alias(mark), row
    )
    places = numbered(narrow, [key, "size", "text_crc32", mark, row]).select(
        row, permuted(F.col("row_number"), max(1, total), seed).alias(mark)
    )
    placed = rows.join(places, row).withColumns({"shard": F.pmod(mark, F.lit(shards)), "slot": F.expr(f"{mark} div {shards}")})
    placed = placed.drop(row, mark).repartitionByRange(max(1, -(-total // per_file)), "shard", "slot")
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op11_sharding(spark: SparkSession, sf_dir: str, shards: int = 8, seed: str = "epoch-0") -> DataFrame:
    """Shard and slot of every document under the law ``rows``."""
    placed = assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards, seed)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )
