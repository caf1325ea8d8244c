"""Hierarchy levels and labels over the cleaned listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from carlot.operators import hierarchy
from carlot.plans.fixtures import Views
from carlot.plans.sql_views import with_views
from carlot.session import stage


def _class_index(views: Views) -> DataFrame:
    index = hierarchy.class_index(views.listing_clean)
    none = F.lit(None).cast("string")
    parts = [
        index["brand"].select(
            F.lit("brand").alias("level"), "brand", none.alias("series"), none.alias("trim"),
            F.col("brand_idx").alias("class_idx"),
        ),
        index["series"].select(
            F.lit("series").alias("level"), "brand", "series", none.alias("trim"),
            F.col("series_idx").alias("class_idx"),
        ),
        index["trim"].select(
            F.lit("trim").alias("level"), "brand", "series", "trim",
            F.col("trim_idx").alias("class_idx"),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def _hierarchy_config(views: Views) -> DataFrame:
    return hierarchy.hierarchy_config(views.listing_clean).withColumn(
        "classes", F.array_join("classes", "|")
    )


def _label_rows(views: Views) -> DataFrame:
    rows = stage(
        views.listing_clean.select("site", "page", "idx", "marka", "seri", "model", "image_path"), "names"
    )
    return hierarchy.label_rows(rows, hierarchy.class_index(rows)).select(
        "site", "page", "idx", "marka", "seri", "model", "brand_idx", "series_idx", "trim_idx"
    )


def _decode_index(views: Views) -> DataFrame:
    index = hierarchy.class_index(views.listing_clean)
    guesses = views.table("orders").select(
        "o_orderkey",
        (F.col("o_custkey") % 40).cast("int").alias("brand_idx"),
        (F.col("o_orderkey") % 12).cast("int").alias("series_idx"),
    )
    return hierarchy.decode_index(guesses, index)


QUERIES = {
    "brand_dim": lambda v: hierarchy.brand_dim(v.listing_clean),
    "series_dim": lambda v: hierarchy.series_dim(v.listing_clean),
    "trim_dim": lambda v: hierarchy.trim_dim(v.listing_clean),
    "hierarchy_config": _hierarchy_config,
    "class_index": _class_index,
    "label_rows": _label_rows,
    "hierarchy_counts": lambda v: hierarchy.hierarchy_counts(v.listing_clean),
    "decode_index": _decode_index,
}

SQL = {
    "brand_dim": with_views(
        ["listing_clean"], "select distinct marka as brand from listing_clean"
    ),
    "series_dim": with_views(
        ["listing_clean"], "select distinct marka as brand, seri as series from listing_clean"
    ),
    "trim_dim": with_views(["class_rows"], "select brand, series, trim from class_rows"),
    "hierarchy_config": with_views(
        ["class_rows"],
        """
select 'brand' as level, null as brand, null as series,
  string_agg(brand, '|' order by brand) as classes
from (select distinct brand from class_rows)
union all
select 'model', brand, null, string_agg(series, '|' order by series)
from (select distinct brand, series from class_rows) group by brand
union all
select 'trim', brand, series, string_agg(trim, '|' order by trim)
from class_rows group by brand, series
""",
    ),
    "class_index": with_views(
        ["class_rows"],
        """
select distinct 'brand' as level, brand, null as series, null as trim, brand_idx as class_idx
from class_rows
union all select distinct 'series', brand, series, null, series_idx from class_rows
union all select 'trim', brand, series, trim, trim_idx from class_rows
""",
    ),
    "label_rows": with_views(
        ["listing_clean"],
        """
select site, page, idx, marka, seri, model, dense_rank() over (order by marka) - 1 as brand_idx,
  dense_rank() over (partition by marka order by seri) - 1 as series_idx,
  dense_rank() over (partition by marka, seri order by model) - 1 as trim_idx
from listing_clean
""",
    ),
    "hierarchy_counts": with_views(
        ["listing_clean"],
        """
select marka as brand, count(*) as n_rows, count(distinct seri) as n_series,
  (select count(*) from listing_clean) as total_rows,
  (select count(distinct marka) from listing_clean) as n_brands
from listing_clean group by marka
""",
    ),
    "decode_index": with_views(
        ["class_rows"],
        """
select o_orderkey, o_custkey % 40 as brand_idx, o_orderkey % 12 as series_idx, b.brand, s.series
from orders
left join (select distinct brand_idx, brand from class_rows) b on b.brand_idx = o_custkey % 40
left join (select distinct brand_idx, series_idx, series from class_rows) s
  on s.brand_idx = o_custkey % 40 and s.series_idx = o_orderkey % 12
""",
    ),
}
