"""Putting pages, sites and images together, and setting rejects aside."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from carlot.functions.text import blank_to_null, slash_paths
from carlot.schema import KEY_COLUMNS, LISTING_COLUMNS, RAW_IMAGE_DIR


def assign_image_name(
    df: DataFrame, fetched_at: Column, unit: str = "page", prefix: str = ""
) -> DataFrame:
    """Add ``image_name`` for rows with an image address; null for the others.

    ``unit`` is ``page`` or ``offset``, ``prefix`` goes before the file name.
    """
    stamp = F.date_format(fetched_at, "yyyyMMdd_HHmmss")
    name = F.format_string(
        f"{RAW_IMAGE_DIR}/{prefix}car_%s_{unit}_%d_idx_%d.jpg", stamp, F.col("page"), F.col("idx")
    )
    return df.withColumn("image_name", F.when(F.col("img_url") != "", name))


def attach_image_paths(rows: DataFrame, fetched: DataFrame) -> DataFrame:
    """Bring the path of every fetched image back to its row, by key.

    A row whose image was not fetched keeps a null path.  Of several fetches of
    one key the greatest path counts; names carry the fetch time, so that is the
    latest.
    """
    paths = fetched.groupBy(*KEY_COLUMNS).agg(
        F.max(blank_to_null(slash_paths(F.col("path")))).alias("path")
    )
    return rows.drop("image_path").join(paths, KEY_COLUMNS, "left").withColumnRenamed(
        "path", "image_path"
    )


def union_sites(*tables: DataFrame) -> DataFrame:
    """All sites in one table with the same columns; nothing is deduplicated."""
    columns = [*KEY_COLUMNS, *LISTING_COLUMNS]
    return reduce(DataFrame.unionByName, [t.select(*columns) for t in tables])


def reject_rows(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split into accepted rows and rejected rows with ``reject_reason``.

    A row is rejected by the first check whose column is null.
    """
    reason = F.coalesce(*[F.when(c.isNull(), F.lit(why)) for why, c in checks.items()])
    return (
        df.where(reason.isNull()),
        df.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull()),
    )
