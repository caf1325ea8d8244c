"""The fixture views as SQL, for the comparison queries."""

from __future__ import annotations

from carlot.schema import NA_TOKENS, LISTING_COLUMNS

_TOKENS = ", ".join(f"'{t}'" for t in NA_TOKENS)


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def title(c: str) -> str:
    return (
        rf"array_to_string(list_transform(regexp_extract_all({c}, '[\p{{L}}]+|[^\p{{L}}]+'), "
        "lambda x: upper(x[1]) || lower(x[2:])), '')"
    )


_RAW = """
select * from listing_base
union all
select site, page, idx + 1000000000000 as idx, marka, seri, model, baslik, yil, km, fiyat,
  il_ilce, replace(image_path, '.jpg', '_copy.jpg') as image_path
from listing_base where page % 50 = 0
"""

_BASE = """
select l_orderkey % 4 as site, l_orderkey as page,
  cast((cast(l_linenumber as bigint) * 10000 + l_suppkey) * 1000000 + l_partkey as bigint) as idx,
  case when l_orderkey % 1000 = 0 then concat('Rare#', cast(l_suppkey % 20 as string))
       when p_brand = 'Brand#7' and l_orderkey % 4 = 1 then 'Mercedes - Benz'
       when p_brand = 'Brand#7' then 'Mercedes-Benz' else p_brand end as marka,
  p_type as seri,
  case when l_orderkey % 4 = 0 and p_size < 10 then concat('Serisi ', p_name)
       when l_orderkey % 4 = 2 and p_size < 3 then concat(p_name, ' Serisi')
       else p_name end as model,
  concat(p_brand, ' ', p_type, ' ', p_name, ' no ', cast(l_suppkey as string), '/',
         cast(cast(round(l_extendedprice * 100) as bigint) as string)) as baslik,
  cast(1985 + p_size % 40 as string) as yil,
  concat(cast(cast(floor(l_quantity) as int) * (l_orderkey % 11) as string), '.',
         lpad(cast(l_orderkey % 1000 as string), 3, '0'),
         case when l_orderkey % 4 = 3 then '' else ' km' end) as km,
  case when l_linenumber = 7 and l_orderkey % 4 = 1 then 'N/A'
       else concat(cast(cast(floor(l_extendedprice / 15) as int) as string), '.',
         lpad(cast(l_partkey % 1000 as string), 3, '0'),
         case when l_orderkey % 4 = 2 then ' ₺' else ' TL' end) end as fiyat,
  concat(s_name, ' / ', n_name) as il_ilce,
  case when l_orderkey % 97 = 0 then cast(null as string)
       else concat('data/images/car_', cast(l_orderkey as string), '_idx_',
                   cast(l_linenumber as string), '_', cast(l_partkey as string), '.jpg')
  end as image_path
from lineitem join part on p_partkey = l_partkey
join supplier on s_suppkey = l_suppkey join nation on n_nationkey = s_nationkey
"""

_IDENTITY = "marka, seri, model, baslik, yil, km, fiyat, il_ilce"

_HEADS = ", ".join(
    [f"('brand', '', 1, 4)"]
    + [f"('series', '{b}', {5 + 3 * b}, 3)" for b in range(4)]
    + [f"('trim', '{b}/{s}', {17 + 2 * (3 * b + s)}, 2)" for b in range(4) for s in range(3)]
)

# name -> (views it reads, SQL)
VIEWS: dict[str, tuple[list[str], str]] = {
    "listing_base": ([], _BASE),
    "listing_raw": (["listing_base"], _RAW),
    "failed_images": (
        ["listing_raw"],
        "select distinct split_part(image_path, '/', 3) as basename from listing_raw "
        "where page % 13 = 0 and image_path is not null",
    ),
    "image_files": (
        ["listing_raw"],
        "select split_part(image_path, '/', 3) as basename, "
        "cast(min(100 + page % 900) as int) as width, cast(min(80 + idx % 700) as int) as height "
        "from listing_raw where page % 17 <> 0 and image_path is not null group by 1",
    ),
    "listing_na": (
        ["listing_raw"],
        "select site, page, idx, "
        + ", ".join(
            f"case when {c} in ({_TOKENS}) then null else {c} end as {c}" for c in LISTING_COLUMNS
        )
        + " from listing_raw",
    ),
    "listing_complete": (
        ["listing_na"],
        "select * from listing_na where "
        + " and ".join(f"{c} is not null" for c in LISTING_COLUMNS),
    ),
    "listing_unique": (
        ["listing_complete"],
        "select * exclude (rn) from (select *, row_number() over (partition by "
        f"{_IDENTITY} order by site, page, idx, image_path) as rn from listing_complete) "
        "where rn = 1",
    ),
    "listing_common": (
        ["listing_unique"],
        "select * from listing_unique where marka in "
        "(select marka from listing_unique group by marka having count(*) >= 5)",
    ),
    "listing_shown": (
        ["listing_common", "failed_images"],
        "select * from listing_common where split_part(image_path, '/', 3) not in "
        "(select basename from failed_images)",
    ),
    "listing_filed": (
        ["listing_shown", "image_files"],
        "select * from listing_shown where split_part(image_path, '/', 3) in "
        "(select basename from image_files)",
    ),
    "listing_clean": (
        ["listing_filed"],
        f"""
select site, page, idx,
  {title("case when marka like '%Mercedes%' then 'Mercedes-Benz' else marka end")} as marka,
  {title("case when model like '%Serisi%' then seri || ' Serisi' else seri end")} as seri,
  {title("replace(model, 'Serisi ', '')")} as model,
  baslik, cast(yil as int) as yil,
  {strip("replace(replace(replace(km, 'km', ''), '.', ''), '-', '0')")} as km,
  {strip("replace(replace(replace(fiyat, 'TL', ''), '₺', ''), '.', '')")} as fiyat,
  il_ilce, 'data/processed_images/' || split_part(image_path, '/', 3) as image_path
from listing_filed
""",
    ),
    "price_rows": (
        ["listing_clean"],
        "select * from (select * replace (cast(km as double) as km, cast(fiyat as double) as "
        "fiyat) from listing_clean) where fiyat > 10000 and fiyat < 5000000 and km > 0 "
        "and km < 500000 and yil > 1990",
    ),
    "class_rows": (
        ["listing_clean"],
        """
select distinct marka as brand, seri as series, model as trim,
  dense_rank() over (order by marka) - 1 as brand_idx,
  dense_rank() over (partition by marka order by seri) - 1 as series_idx,
  dense_rank() over (partition by marka, seri order by model) - 1 as trim_idx
from listing_clean
""",
    ),
    "vectors": (
        [],
        "select vec_id as image_id, label, cast(embedding as double[]) as v from embeddings",
    ),
    "image_pixels": (
        ["vectors"],
        "select image_id, i - 1 as pos, least(255, cast(floor(abs(v[i]) * 600) as int)) as px "
        "from vectors, range(1, 49) t(i)",
    ),
    "detections": (
        ["vectors"],
        "select image_id, m as mask_id, cast((image_id + m) % 8 as int) as class_id, p as pos, "
        "case when v[1 + 16 * m + p] > 0 then 1.0 else 0.0 end as cell "
        "from vectors, range(0, 3) a(m), range(0, 16) b(p)",
    ),
    "mask_areas": (
        ["detections"],
        "select image_id, cast(mask_id as int) as mask_id, cast(sum(cell) as double) as area "
        "from detections "
        "where class_id in (2, 3, 5, 7) group by 1, 2",
    ),
    "score_long": (
        ["vectors"],
        "select image_id, cast(s as int) as sample, level, node, cast(c as int) as class_idx, "
        "v[start + c] * (1 + s / 10.0) as logit "
        f"from vectors, (values {_HEADS}) h(level, node, start, n), range(0, 10) a(s), "
        "range(0, 4) b(c) where c < n",
    ),
    "prob_long": (
        ["score_long"],
        "select *, e / sum(e) over (partition by image_id, sample, level, node) as prob from "
        "(select *, exp(logit - max(logit) over (partition by image_id, sample, level, node)) "
        "as e from score_long)",
    ),
    "moments": (
        ["prob_long"],
        "select image_id, level, node, class_idx, avg(prob) as mean, var_samp(prob) as variance "
        "from prob_long group by 1, 2, 3, 4",
    ),
    "head_best": (
        ["moments"],
        """
select image_id, level, node, class_idx, 100 * share as confidence,
  100 * sqrt(variance) as uncertainty,
  case when n = 1 then 'error' else 'ok' end as status
from (
  select *, exp(mean / 0.1) / sum(exp(mean / 0.1)) over (partition by image_id, level, node)
      as share,
    count(*) over (partition by image_id, level, node) as n,
    row_number() over (partition by image_id, level, node order by mean desc, class_idx) as rn
  from moments)
where rn = 1
""",
    ),
    "labels3": (
        ["vectors"],
        "select image_id, cast(label % 4 as int) as brand_idx, "
        "cast(image_id % 3 as int) as series_idx, cast(image_id % 2 as int) as trim_idx "
        "from vectors",
    ),
    "judged": (
        ["prob_long", "labels3"],
        """
select p.*, case level when 'brand' then brand_idx when 'series' then series_idx
    else trim_idx end as label,
  max(prob) over (partition by image_id, level) as top,
  count(*) over (partition by image_id, level) as n
from prob_long p join labels3 using (image_id)
where sample = 0 and node = case level when 'brand' then ''
  when 'series' then cast(brand_idx as string)
  else concat(cast(brand_idx as string), '/', cast(series_idx as string)) end
""",
    ),
    "fetch_log": (
        [],
        "select cast(user_id % 4 as int) as site, ts, event_id as page, "
        "event_type <> 'error' as ok from events",
    ),
}


def with_views(names: list[str], body: str) -> str:
    """``body`` preceded by the views it reads, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in VIEWS[name][0]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body
    return "with " + ",\n".join(f"{n} as ({VIEWS[n][1]})" for n in ordered) + "\n" + body
