"""Order-dependent work without sending a whole group to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from carlot.session import stage

_ROW_BITS = 33  # low bits of monotonically_increasing_id: row number in its partition


def range_chunks(df: DataFrame, order: list[str], chunks: int | None = None) -> DataFrame:
    """Cut ``df`` into consecutive ranges of ``order``, numbered in column ``chunk``.

    Ranges come from a sample of the rows, so a value of the leading column that
    holds a large share of the rows is spread over several chunks.
    """
    parts = [chunks] if chunks else []
    return df.repartitionByRange(*parts, *order).withColumn("chunk", F.spark_partition_id())


def sorted_index(
    names: DataFrame, parents: list[str], name: str, out: str, chunks: int | None = None
) -> DataFrame:
    """Dense 0-based index of each distinct name within its parents, in sorted order.

    The distinct names are sorted by range over all tasks.  Each row's index is
    its place inside its chunk plus the sizes of the parent's earlier chunks;
    only those sizes (one row per parent and chunk) go through a window.
    """
    keys = [*parents, name]
    parts = [chunks] if chunks else []
    spot = F.monotonically_increasing_id()
    placed = stage(
        names.select(*keys)
        .distinct()
        .repartitionByRange(*parts, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_chunk", F.shiftright(spot, _ROW_BITS))
        .withColumn("_row", spot.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))),
        f"index-{name}",
    )
    group = [*parents, "_chunk"]
    earlier = Window.partitionBy(*parents).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        placed.groupBy(*group)
        .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .drop("_size")
    )
    return placed.join(starts, group).select(
        *keys, (F.col("_row") - F.col("_first") + F.col("_before")).cast("int").alias(out)
    )
