"""Image geometry, masks and pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from carlot.functions import pixels as px
from carlot.operators import masks
from carlot.plans.fixtures import Views
from carlot.plans.sql_views import with_views


def _composite(views: Views) -> DataFrame:
    """Pixels over white, by the image's values past the pixels as soft mask."""
    soft = F.transform(F.slice("v", 49, 16), lambda x: F.least(F.lit(1.0), F.abs(x) * 4))
    return (
        views.image_pixels.join(views.embeddings.select("image_id", soft.alias("mask")), "image_id")
        .select("image_id", F.posexplode(px.white_composite(F.col("pixels"), F.col("mask"))))
        .withColumnsRenamed({"col": "px"})
    )


def _normalized(views: Views) -> DataFrame:
    return views.image_pixels.select(
        "image_id", F.posexplode(px.normalize_pixels(F.col("pixels"), order="bgr"))
    ).select("image_id", "pos", F.round("col", 6).alias("px"))


QUERIES = {
    "fit_box": lambda v: v.image_files.withColumn(
        "_size", px.fit_box(F.col("width"), F.col("height"))
    ).select("basename", "width", "height", "_size.*"),
    "main_mask": lambda v: masks.main_mask(v.detections),
    "union_mask": lambda v: masks.union_mask(v.detections).withColumn(
        "mask", F.array_join("mask", "")
    ),
    "vehicle_filter": lambda v: masks.vehicle_filter(v.detections).select(
        "image_id", "mask_id", "class_id"
    ),
    "white_composite": _composite,
    "normalize_pixels": _normalized,
}

SQL = {
    "fit_box": with_views(
        ["image_files"],
        """
select *, case when wide then 240 else cast(trunc(180 * (width / height)) as int) end as new_w,
  case when wide then cast(trunc(240 / (width / height)) as int) else 180 end as new_h
from (select basename, width, height from image_files) f,
  lateral (select f.width / f.height > 240 / 180 as wide) w
""".replace("select *,", "select basename, width, height,"),
    ),
    "main_mask": with_views(
        ["mask_areas"],
        """
select image_id, mask_id, area from (select *, row_number() over (
  partition by image_id order by area desc, mask_id) as rn from mask_areas where area > 0)
where rn = 1
""",
    ),
    "union_mask": with_views(
        ["detections"],
        """
select image_id, string_agg(cast(hit as string), '' order by pos) as mask from (
  select image_id, pos, cast(max(cell) as int) as hit from detections
  where class_id in (2, 3, 5, 7) group by 1, 2)
group by image_id
""",
    ),
    "vehicle_filter": with_views(
        ["detections"],
        "select distinct image_id, cast(mask_id as int) as mask_id, class_id from detections "
        "where class_id in (2, 3, 5, 7)",
    ),
    "white_composite": with_views(
        ["image_pixels"],
        """
select image_id, cast(pos as int) as pos,
  cast(floor(px * m + cast(255 as double) * (1 - m)) as int) as px
from (select p.image_id, p.pos, p.px, least(cast(1 as double), abs(v[49 + pos // 3]) * 4) as m
      from image_pixels p join vectors using (image_id))
""",
    ),
    "normalize_pixels": with_views(
        ["image_pixels"],
        """
select image_id, cast(pos as int) as pos,
  round((px / cast(255 as double) - cast([0.406, 0.456, 0.485] as double[])[1 + pos % 3])
    / cast([0.225, 0.224, 0.229] as double[])[1 + pos % 3], 6) as px
from image_pixels
""",
    ),
}
