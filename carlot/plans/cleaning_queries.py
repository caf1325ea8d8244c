"""The cleaning steps, the whole chain, and the flagship report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from carlot.operators import cleaning, masks, pricing
from carlot.plans.fixtures import Views
from carlot.plans.sql_views import strip, title, with_views
from carlot.schema import KEY_COLUMNS, LISTING_COLUMNS
from carlot.sources.listings import normalize_na


def _brand_prices(views: Views) -> DataFrame:
    priced = pricing.realistic_filter(pricing.price_casts(views.listing_clean))
    return priced.groupBy("marka").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg("fiyat").alias("avg_fiyat"),
        F.min("km").alias("min_km"),
    )


def _failed_images(views: Views) -> DataFrame:
    images = views.embeddings.select(
        "image_id",
        F.concat(F.lit("car_"), F.col("image_id").cast("string"), F.lit(".jpg")).alias("basename"),
        (F.col("image_id") % 11 != 0).alias("readable"),
    )
    return cleaning.failed_images(images, masks.main_mask(views.detections))


QUERIES = {
    "brand_prices": _brand_prices,
    "drop_incomplete": lambda v: cleaning.drop_incomplete(normalize_na(v.listing_raw)),
    "dedupe_listings": lambda v: cleaning.dedupe_listings(v.listing_raw),
    "min_samples": lambda v: cleaning.min_samples(v.listing_raw, 5, ("marka", "il_ilce")),
    "drop_failed_images": lambda v: cleaning.drop_failed_images(v.listing_raw, v.failed_images),
    "repair_series": lambda v: cleaning.repair_series(v.listing_raw).select(
        *KEY_COLUMNS, "seri", "model"
    ),
    "rename_brands": lambda v: cleaning.rename_brands(v.listing_raw).select(*KEY_COLUMNS, "marka"),
    "keep_existing_images": lambda v: cleaning.keep_existing_images(v.listing_raw, v.image_files),
    "clean_km": lambda v: cleaning.clean_km(v.listing_raw).select(*KEY_COLUMNS, "km"),
    "clean_price": lambda v: cleaning.clean_price(v.listing_raw).select(*KEY_COLUMNS, "fiyat"),
    "cast_year": lambda v: cleaning.cast_year(v.listing_raw).select(*KEY_COLUMNS, "yil"),
    "title_case": lambda v: cleaning.title_case(v.listing_raw).select(
        *KEY_COLUMNS, "marka", "seri", "model"
    ),
    "clean_listings": lambda v: v.listing_clean,
    "cleaning_audit": lambda v: cleaning.cleaning_audit(
        v.listing_raw, v.image_files, v.failed_images
    ),
    "failed_images": _failed_images,
}

_ALL = ", ".join([*KEY_COLUMNS, *LISTING_COLUMNS])


def _raw(columns: str) -> str:
    return with_views(["listing_raw"], f"select site, page, idx, {columns} from listing_raw")


SQL = {
    "brand_prices": with_views(
        ["price_rows"],
        "select marka, count(*) as n_rows, avg(fiyat) as avg_fiyat, min(km) as min_km "
        "from price_rows group by marka",
    ),
    "drop_incomplete": with_views(["listing_complete"], "select * from listing_complete"),
    "dedupe_listings": with_views(
        ["listing_raw"],
        f"""
select {_ALL} from (select *, row_number() over (
  partition by marka, seri, model, baslik, yil, km, fiyat, il_ilce
  order by site, page, idx, image_path) as rn from listing_raw) where rn = 1
""",
    ),
    "min_samples": with_views(
        ["listing_raw"],
        f"""
select {_ALL} from (
  select *, count(*) over (partition by il_ilce) as n2 from (
    select *, count(*) over (partition by marka) as n1 from listing_raw) where n1 >= 5)
where n2 >= 5
""",
    ),
    "drop_failed_images": with_views(
        ["failed_images"],
        f"select {_ALL} from listing_raw r where not exists (select 1 from failed_images f "
        "where f.basename = split_part(r.image_path, '/', 3))",
    ),
    "repair_series": _raw(
        "case when model like '%Serisi%' then seri || ' Serisi' else seri end as seri, "
        "replace(model, 'Serisi ', '') as model"
    ),
    "rename_brands": _raw(
        "case when marka like '%Mercedes%' then 'Mercedes-Benz' else marka end as marka"
    ),
    "keep_existing_images": with_views(
        ["image_files"],
        f"select {_ALL.replace('image_path', '')} 'data/processed_images/' || basename as "
        "image_path from (select *, split_part(image_path, '/', 3) as basename from listing_raw) r "
        "where basename in (select basename from image_files)",
    ),
    "clean_km": _raw(
        strip("replace(replace(replace(km, 'km', ''), '.', ''), '-', '0')") + " as km"
    ),
    "clean_price": _raw(
        strip("replace(replace(replace(fiyat, 'TL', ''), '₺', ''), '.', '')") + " as fiyat"
    ),
    "cast_year": _raw("cast(yil as int) as yil"),
    "title_case": _raw(
        f"{title('marka')} as marka, {title('seri')} as seri, {title('model')} as model"
    ),
    "clean_listings": with_views(["listing_clean"], "select * from listing_clean"),
    "cleaning_audit": with_views(
        ["listing_filed"],
        """
, n as (select
  (select count(*) from listing_raw) as total,
  (select count(*) from listing_complete) as complete,
  (select count(*) from listing_unique) as uniq,
  (select count(*) from listing_common) as common,
  (select count(*) from listing_shown) as shown,
  (select count(*) from listing_shown where marka like '%Mercedes%') as renamed,
  (select count(*) from listing_filed) as filed)
select 1 as step_no, 'drop_incomplete' as step, total - complete as rows_changed,
  complete as rows_left from n
union all select 2, 'dedupe_listings', complete - uniq, uniq from n
union all select 3, 'min_samples', uniq - common, common from n
union all select 4, 'drop_failed_images', common - shown, shown from n
union all select 5, 'rename_brands', renamed, shown from n
union all select 6, 'keep_existing_images', shown - filed, filed from n
""",
    ),
    "failed_images": with_views(
        ["mask_areas"],
        "select concat('car_', cast(image_id as string), '.jpg') as basename from vectors "
        "where image_id % 11 = 0 "
        "or image_id not in (select image_id from mask_areas where area > 0)",
    ),
}
