"""Brand, series and trim levels, their class indices and row labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from carlot.operators.ordering import sorted_index
from carlot.session import stage
from carlot.sources.listings import require_columns

LEVELS = ["brand", "series", "trim"]


def level_names(df: DataFrame) -> DataFrame:
    """Distinct ``brand, series, trim`` of a listing table."""
    return require_columns(df).select(
        F.col("marka").alias("brand"), F.col("seri").alias("series"), F.col("model").alias("trim")
    ).distinct()


def brand_dim(df: DataFrame) -> DataFrame:
    """Sorted distinct brands."""
    return df.select(F.col("marka").alias("brand")).distinct().orderBy("brand")


def series_dim(df: DataFrame) -> DataFrame:
    """Sorted distinct series of every brand."""
    return (
        df.select(F.col("marka").alias("brand"), F.col("seri").alias("series"))
        .distinct()
        .orderBy("brand", "series")
    )


def trim_dim(df: DataFrame) -> DataFrame:
    """Sorted distinct trims of every (brand, series)."""
    return level_names(df).orderBy(*LEVELS)


def hierarchy_config(df: DataFrame) -> DataFrame:
    """The nested hierarchy, one row per node: ``level, brand, series, classes``.

    The root row lists the brands, a brand row its series, a (brand, series) row
    its trims, each in sorted order.  A row is as long as one classifier head.
    """
    names = stage(level_names(df), "levels")
    none = F.lit(None).cast("string")

    def node(level: str, brand, series, member: str) -> DataFrame:
        return (
            names.select(brand.alias("brand"), series.alias("series"), F.col(member).alias("_name"))
            .distinct()
            .groupBy("brand", "series")
            .agg(F.array_sort(F.collect_list("_name")).alias("classes"))
            .select(F.lit(level).alias("level"), "brand", "series", "classes")
        )

    return (
        node("brand", none, none, "brand")
        .unionByName(node("model", F.col("brand"), none, "series"))
        .unionByName(node("trim", F.col("brand"), F.col("series"), "trim"))
    )


def class_index(df: DataFrame, chunks: int | None = None) -> dict[str, DataFrame]:
    """Index tables per level: brands overall, series in a brand, trims in a pair."""
    names = stage(level_names(df), "levels")
    return {
        "brand": sorted_index(names, [], "brand", "brand_idx", chunks),
        "series": sorted_index(names, ["brand"], "series", "series_idx", chunks),
        "trim": sorted_index(names, ["brand", "series"], "trim", "trim_idx", chunks),
    }


def joined_index(index: dict[str, DataFrame]) -> DataFrame:
    """One row per trim with all three indices."""
    return index["trim"].join(index["series"], ["brand", "series"]).join(index["brand"], "brand")


def label_rows(df: DataFrame, index: dict[str, DataFrame]) -> DataFrame:
    """Rows with ``brand_idx, series_idx, trim_idx``.

    The three index tables are joined with each other first, so that the rows
    pass one join.
    """
    dims = joined_index(index).select(
        F.col("brand").alias("marka"), F.col("series").alias("seri"), F.col("trim").alias("model"),
        "brand_idx", "series_idx", "trim_idx",
    )
    return df.join(dims, ["marka", "seri", "model"]).select(
        *df.columns, "brand_idx", "series_idx", "trim_idx"
    )


def hierarchy_counts(df: DataFrame) -> DataFrame:
    """Per brand: its rows and distinct series; with totals over all brands.

    Rows are counted per (brand, series) first, which is all that distinct
    counting needs; the counts per brand are kept for the totals.
    """
    pairs = df.groupBy(F.col("marka").alias("brand"), F.col("seri").alias("series")).agg(
        F.count(F.lit(1)).alias("n")
    )
    per_brand = stage(
        pairs.groupBy("brand").agg(
            F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_series")
        ),
        "brand-counts",
    )
    return per_brand.withColumns(
        {
            "total_rows": per_brand.agg(F.sum("n_rows")).scalar(),
            "n_brands": per_brand.agg(F.count(F.lit(1))).scalar(),
        }
    )


def decode_index(df: DataFrame, index: dict[str, DataFrame]) -> DataFrame:
    """Names for ``brand_idx, series_idx``; an unknown index gives null."""
    brands = index["brand"]
    series = index["series"].join(brands, "brand").select("brand_idx", "series_idx", "series")
    return df.join(brands, "brand_idx", "left").join(
        series, ["brand_idx", "series_idx"], "left"
    ).select(*df.columns, "brand", "series")
