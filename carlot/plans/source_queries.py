"""Reading, extracting, combining, landing and writing."""

from __future__ import annotations

import struct
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from carlot.operators import combine
from carlot.plans.fixtures import Views
from carlot.plans.sql_views import with_views
from carlot.schema import IDENTITY_COLUMNS, KEY_COLUMNS, KEYED_LISTING_RAW, LISTING_COLUMNS
from carlot.session import scratch_path, stage
from carlot.sources import crawl, images, listings, pages
from carlot.streaming.ingest import ingest_stream, read_latest, read_rejects, read_store

_ALL = [*KEY_COLUMNS, *LISTING_COLUMNS]
_QUOTED = "case when page % 5 = 0 then concat(baslik, ' \"x\",', chr(10), 'y') else baslik end"


def _read_listings(views: Views) -> DataFrame:
    """The raw listings written as CSV, some titles with quotes and line feeds, read back."""
    path = scratch_path(views.spark, "listings-csv")
    listings.append_listings(
        views.listing_raw.withColumn("baslik", F.expr(_QUOTED)), path, "csv"
    )
    return listings.read_listings(views.spark, path, KEYED_LISTING_RAW).select(*_ALL)


def _written_out_of_order(views: Views) -> str:
    """Listings as CSV with columns in another order and one more, and in files of their own
    every tenth page's rows cut behind the second field."""
    path = scratch_path(views.spark, "listings-csv")
    columns = [*reversed(LISTING_COLUMNS), "seen", *KEY_COLUMNS]
    whole = views.listing_raw.withColumn("seen", F.lit("x")).select(*columns)
    listings.csv_writer(whole).csv(path)
    cut = views.listing_raw.where("page % 10 = 0").select(F.concat_ws(",", "marka", "seri").alias(",".join(columns)))
    listings.csv_writer(cut).mode("append").option("sep", "\x01").csv(path)
    return path


def _read_listings_by_name(views: Views) -> DataFrame:
    rows = listings.read_listings(views.spark, _written_out_of_order(views), KEYED_LISTING_RAW)
    return rows.select(*_ALL)


def _read_listing_rejects(views: Views) -> DataFrame:
    """Records that have not as many fields as the header, by their text."""
    path = _written_out_of_order(views)
    found = listings.read_listings(views.spark, path, KEYED_LISTING_RAW, rejects=True)
    return found.groupBy("record").agg(F.count(F.lit(1)).alias("n_records"))


def _append_listings(views: Views) -> DataFrame:
    """Two appends to one store."""
    path = scratch_path(views.spark, "listings-store")
    for part in (0, 1):
        listings.append_listings(views.listing_raw.where(F.col("page") % 2 == part), path)
    return views.spark.read.parquet(path).select(*_ALL)


def _write_processed(views: Views) -> DataFrame:
    """Written twice to one place; the second replaces the first."""
    path = scratch_path(views.spark, "processed-csv")
    clean = stage(views.listing_clean.select(*LISTING_COLUMNS), "clean")
    for _ in range(2):
        listings.write_processed(clean, path)
    text = ", ".join(f"{c} string" for c in LISTING_COLUMNS)
    return listings.read_listings(views.spark, path, text, multi_line=False)


def _bitmap_files(rows: DataFrame, folder: str) -> DataFrame:
    """Write pixel rows as image files below a shared folder; one broken file in eleven."""

    def write(batches):
        from pyarrow import fs

        local = folder.removeprefix("file:") if "://" not in folder else None
        store, root = fs.FileSystem.from_uri(folder if local is None else f"file://{local}")
        store.create_dir(root)
        for pdf in batches:
            for r in pdf.itertuples():
                w, h = r.width, r.height
                line = w * 3
                body = b"".join(
                    r.pixels[y * line : (y + 1) * line].astype("uint8").tobytes()
                    for y in reversed(range(h))
                )
                head = struct.pack("<2sIHHI", b"BM", 54 + len(body), 0, 0, 54)
                info = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(body), 0, 0, 0, 0)
                data = b"broken" if r.image_id % 11 == 0 else head + info + body
                with store.open_output_stream(f"{root}/car_{r.image_id}.jpg") as out:
                    out.write(data)
            yield pd.DataFrame({"n": [len(pdf)]})

    return rows.mapInPandas(write, "n long")


def _scan_images(views: Views) -> DataFrame:
    """Images of the pixel view, written as files and decoded again."""
    folder = scratch_path(views.spark, "images")
    _bitmap_files(views.image_pixels, folder).agg(F.sum("n")).first()
    read = images.scan_images(views.spark, folder)
    return read.select(
        "basename", "width", "height", "readable",
        F.when(F.col("readable"), F.lower(F.hex("pixels"))).alias("pixels"),
    )


def _extracted(site: int):
    extract = [
        pages.extract_rows_cells9, pages.extract_rows_cells8, pages.extract_rows_card,
        pages.extract_rows_grid,
    ][site]
    return lambda v: extract(v.rendered_pages.where(F.col("site") == site)).select(
        *KEY_COLUMNS, *IDENTITY_COLUMNS, "img_url"
    )


def _broken_pages(views: Views) -> DataFrame:
    """Pages whose rows lose their last cell, place, city or property list."""
    html = F.col("html")
    return views.rendered_pages.withColumn(
        "html",
        F.when(F.col("site") == 0, F.regexp_replace(html, "<td> 1 Ocak\n</td>", ""))
        .when(F.col("site") == 1, F.regexp_replace(html, "<td> Beyaz\n</td>", ""))
        .when(F.col("site") == 2, F.replace(html, F.lit("Galeri, "), F.lit("")))
        .otherwise(F.replace(html, F.lit("propertyGrid"), F.lit("grid"))),
    )


def _extract_rejects(views: Views) -> DataFrame:
    """Rows that lose their last cell, image or city on the way, by reason."""
    broken = _broken_pages(views)
    return pages.extract_listings(broken, rejects=True).groupBy("site", "reject_reason").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


_BUTTONS = """
cast(o_custkey % 40 as int) as site,
case o_custkey % 4 when 0 then 'pager' when 2 then 'total' else 'button' end as kind,
case o_custkey % 4
  when 0 then concat(' ', cast(o_orderkey % 120 as string), ' ')
  when 1 then case when o_orderkey % 5 = 0 then 'Sonraki'
    else cast(o_orderkey % 90 as string) end
  when 2 then concat(cast(o_orderkey % 9 as string), '.',
    lpad(cast(o_orderkey % 1000 as string), 3, '0'), ' araç')
  else 'İleri' end as text
"""

_SITES = """
n_nationkey as site, case n_nationkey % 4 when 0 then 'offset' when 1 then 'sayfa'
  else 'page' end as kind,
concat('https://site', cast(n_nationkey as string), '.example/list',
  case when n_nationkey % 4 = 3 then '?take=50' else '' end) as base_url
"""

_DONE = """
c_nationkey as site, cast(case when c_nationkey % 4 = 0 then (c_custkey % 40) * 50
  else c_custkey % 100 end as bigint) as page
"""


def _site_page_count(views: Views) -> DataFrame:
    buttons = views.table("orders").selectExpr(*_split_top(_BUTTONS))
    return crawl.site_page_count(buttons)


def _split_top(columns: str) -> list[str]:
    """Column list at its top-level commas."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(columns):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(columns[start:i])
            start = i + 1
    return [*out, columns[start:]]


def _crawl_frontier(views: Views) -> DataFrame:
    customers = views.table("customer")
    counts = customers.groupBy(F.col("c_nationkey").alias("site")).agg(
        (F.count(F.lit(1)) + 50).alias("pages")
    )
    sites = views.table("nation").selectExpr(*_split_top(_SITES)).join(counts, "site")
    return crawl.crawl_frontier(sites, customers.selectExpr(*_split_top(_DONE)))


def _fetch_log_audit(views: Views) -> DataFrame:
    return crawl.fetch_log_audit(views.fetch_log).withColumn(
        "stopped_at", F.date_format("stopped_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def _assign_image_name(views: Views) -> DataFrame:
    """The three name forms, by site."""
    rows = views.listing_raw.select(
        *KEY_COLUMNS, F.expr("case when page % 9 = 0 then '' else image_path end").alias("img_url"),
        F.expr("timestampadd(SECOND, page % 86400, timestamp_ntz'2024-01-01 00:00:00')")
        .alias("at"),
    )
    at = F.col("at")
    parts = [
        combine.assign_image_name(rows.where("site = 0"), at, unit="offset"),
        combine.assign_image_name(rows.where("site in (1, 2)"), at),
        combine.assign_image_name(rows.where("site = 3"), at, prefix="site3_"),
    ]
    return reduce(DataFrame.unionByName, parts).select(*KEY_COLUMNS, "image_name")


def _attach_image_paths(views: Views) -> DataFrame:
    fetched = views.listing_raw.where("page % 13 <> 0 and image_path is not null").select(
        *KEY_COLUMNS, F.replace("image_path", F.lit("/"), F.lit("\\")).alias("path")
    )
    return combine.attach_image_paths(views.listing_raw, fetched).select(
        *KEY_COLUMNS, "image_path"
    )


def _union_sites(views: Views) -> DataFrame:
    raw = views.listing_raw
    return combine.union_sites(*[raw.where(F.col("site") == site) for site in range(4)])


def _land(pages: DataFrame, landing: str) -> DataFrame:
    """Adds pages to a landing folder; returns its pages as they stand now, whatever lands later."""
    pages.write.mode("append").option("compression", "zstd").parquet(landing)
    return pages.sparkSession.read.schema(pages.schema).parquet(landing)


def _ingest_stream(views: Views) -> DataFrame:
    """Pages landed in two lots that overlap, loaded by two runs of the stream."""
    landing, store, state = (
        scratch_path(views.spark, name) for name in ("landing", "store", "stream-state")
    )
    made = stage(views.rendered_pages, "pages")
    for lot in ("page % 3 <> 0", "page % 2 = 0 or page % 3 = 0"):
        _land(made.where(lot), landing)
        ingest_stream(views.spark, landing, store, state).awaitTermination()
    return read_store(views.spark, store).select(*KEY_COLUMNS, *IDENTITY_COLUMNS, "img_url")


def _ingest_versions(views: Views) -> DataFrame:
    """Three runs: all pages, every second one changed, every fourth changed back."""
    landing, store, state = (
        scratch_path(views.spark, name) for name in ("landing", "store", "stream-state")
    )
    changed = F.when(F.col("page") % 2 == 0, F.concat("html", F.lit("<!-- seen again -->")))
    made = _land(views.rendered_pages, landing)  # the later lots are made of the landed files
    ingest_stream(views.spark, landing, store, state).awaitTermination()
    for lot in (made.withColumn("html", F.coalesce(changed, "html")), made.where("page % 4 = 0")):
        _land(lot, landing)
        ingest_stream(views.spark, landing, store, state).awaitTermination()
    stored = read_store(views.spark, store).groupBy("site", "page").agg(
        F.max("version").alias("n_versions"), F.count(F.lit(1)).alias("n_rows")
    )
    latest = read_latest(views.spark, store).groupBy("site", "page").agg(
        F.count(F.lit(1)).alias("n_latest"), F.max("version").alias("latest_version")
    )
    return stored.join(latest, ["site", "page"])


def _ingest_rejects(views: Views) -> DataFrame:
    """What a run of the stream sets aside of pages whose rows lose a part, by reason."""
    landing, store, state = (
        scratch_path(views.spark, name) for name in ("landing", "store", "stream-state")
    )
    broken = _broken_pages(views)
    for _ in range(2):  # what lands again unchanged is not rejected again
        broken = _land(broken, landing)
        ingest_stream(views.spark, landing, store, state).awaitTermination()
    return read_rejects(views.spark, store).groupBy("site", "reject_reason").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("version").alias("n_versions")
    )


QUERIES = {
    "read_listings": _read_listings,
    "read_listings_by_name": _read_listings_by_name,
    "read_listing_rejects": _read_listing_rejects,
    "append_listings": _append_listings,
    "write_processed": _write_processed,
    "scan_images": _scan_images,
    "extract_rows_cells9": _extracted(0),
    "extract_rows_cells8": _extracted(1),
    "extract_rows_card": _extracted(2),
    "extract_rows_grid": _extracted(3),
    "extract_rejects": _extract_rejects,
    "extract_page_fields": lambda v: pages.extract_page_fields(v.table("pages")),
    "site_page_count": _site_page_count,
    "crawl_frontier": _crawl_frontier,
    "fetch_log_audit": _fetch_log_audit,
    "assign_image_name": _assign_image_name,
    "attach_image_paths": _attach_image_paths,
    "union_sites": _union_sites,
    "drop_stale_outputs": lambda v: images.drop_stale_outputs(v.image_files, v.failed_images),
    "ingest_stream": _ingest_stream,
    "ingest_versions": _ingest_versions,
    "ingest_rejects": _ingest_rejects,
}


def _extract_sql(site: str) -> str:
    """Rows as each page dialect shows them, numbered within their page."""
    return with_views(
        ["listing_raw"],
        f"""
select site, page, row_number() over (partition by site, page order by idx) - 1 as idx,
  case when site = 3 then trim(string_split(shown, '-')[1]) else marka end as marka,
  case when site = 3 then trim(string_split(shown, '-')[2]) else seri end as seri,
  case when site = 3 then trim(array_to_string(string_split(shown, '-')[3:], '-')) else model end
    as model,
  case when site = 2 then concat(marka, ' ', seri, ' ', model) when site = 3 then shown
    else baslik end as baslik,
  yil, km, fiyat, il_ilce, coalesce(image_path, 'data/images/none.jpg') as img_url
from (select *, concat(marka, ' - ', seri, ' - ', model) as shown from listing_raw)
where site {site}
""",
    )


_TEXT_OF = (
    "regexp_replace(regexp_extract(html, '(?is)<{0}[^>]*>(.*?)</{0}>', 1), '<[^>]*>', '', 'g')"
)
_DECODE = "trim(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&amp;', '&'))"

SQL = {
    "read_listings": with_views(
        ["listing_raw"],
        f"select {', '.join(_ALL)} from (select * replace ({_QUOTED} as baslik, "
        "nullif(fiyat, '') as fiyat) from listing_raw)",
    ),
    "read_listings_by_name": with_views(
        ["listing_raw"],
        f"select {', '.join(_ALL)} from (select * replace (nullif(fiyat, '') as fiyat) from listing_raw)",
    ),
    "read_listing_rejects": with_views(
        ["listing_raw"],
        "select concat(marka, ',', seri) as record, count(*) as n_records from listing_raw "
        "where page % 10 = 0 group by all",
    ),
    "append_listings": with_views(
        ["listing_raw"], f"select {', '.join(_ALL)} from listing_raw"
    ),
    "write_processed": with_views(
        ["listing_clean"],
        "select "
        + ", ".join(f"cast({c} as string) as {c}" for c in LISTING_COLUMNS)
        + " from listing_clean",
    ),
    "scan_images": with_views(
        ["image_pixels"],
        """
select concat('car_', cast(image_id as string), '.jpg') as basename,
  case when image_id % 11 = 0 then -1 else 4 end as width,
  case when image_id % 11 = 0 then -1 else 4 end as height, image_id % 11 <> 0 as readable,
  case when image_id % 11 <> 0
    then string_agg(lpad(to_hex(px), 2, '0'), '' order by pos) end as pixels
from image_pixels group by image_id
""".replace("to_hex(px)", "lower(hex(px))"),
    ),
    "extract_rows_cells9": _extract_sql("= 0"),
    "extract_rows_cells8": _extract_sql("= 1"),
    "extract_rows_card": _extract_sql("= 2"),
    "extract_rows_grid": _extract_sql("= 3"),
    "extract_rejects": with_views(
        ["listing_raw"],
        """
select site, case site when 0 then 'cell count' when 1 then 'no place cell' when 2 then 'no city'
  else 'no property list' end as reject_reason, count(*) as n_rows
from listing_raw group by site
union all
select 1, 'too few cells', 0 where false
""",
    ),
    "extract_page_fields": "select page_id, url, "
    + _DECODE.format(_TEXT_OF.format("title")) + " as title, "
    + _DECODE.format(_TEXT_OF.format("h1")) + " as h1, "
    + r"""len(regexp_extract_all(html, '(?is)<a\s[^>]*?href="[^"]*"')) as n_links,
  regexp_extract(html, '(?is)<a\s[^>]*?href="([^"]*)"', 1) as first_link from pages""",
    "site_page_count": f"""
with buttons as (select {_BUTTONS} from orders),
found as (select site,
    max(case when kind = 'pager' then cast(trim(text) as bigint) end) as pager,
    max(case when kind = 'button' then try_cast(text as bigint) end) as button,
    max(case when kind = 'total'
      then try_cast(regexp_replace(text, '[^0-9]', '', 'g') as bigint) end) as total
  from buttons group by site),
pages as (select site, coalesce(pager, case when button > 1 then button end, (total + 14) // 15, 50)
  as found from found)
select site, found, greatest(50, found) as pages from pages
""",
    "crawl_frontier": f"""
with sites as (select {_SITES} from nation),
wanted as (select s.*, case when kind = 'offset' then (i - 1) * 50 else i end as page
  from sites s join (select c_nationkey, count(*) + 50 as pages from customer group by 1) c
    on c.c_nationkey = s.site,
    range(1, 100000) t(i)
  where i <= pages),
done as (select {_DONE} from customer)
select site, page, concat(base_url, case when base_url like '%?%' then '&' else '?' end,
  case when kind = 'offset' then concat('pagingOffset=', cast(page as string), '&pagingSize=50')
    else concat(kind, '=', cast(page as string)) end) as url
from wanted w
where not exists (select 1 from done d where d.site = w.site and d.page = w.page)
""",
    "fetch_log_audit": with_views(
        ["fetch_log"],
        """
, runs as (select *, sum(case when ok then 1 else 0 end) over (partition by site order by ts, page)
    as island from fetch_log),
numbered as (select *, sum(case when ok then 0 else 1 end)
    over (partition by site, island order by ts, page) as run from runs)
select site, count(distinct case when ok then page end) as completed,
  count(*) filter (not ok) as failures,
  strftime(min(case when run = 3 and not ok then ts end), '%Y-%m-%d %H:%M:%S.%f') as stopped_at
from numbered group by site
""",
    ),
    "assign_image_name": with_views(
        ["listing_raw"],
        """
select site, page, idx, case when page % 9 <> 0 and image_path is not null then concat(
  'data/images/', case when site = 3 then 'site3_' else '' end, 'car_',
  strftime(timestamp '2024-01-01' + to_seconds(page % 86400), '%Y%m%d_%H%M%S'),
  case when site = 0 then '_offset_' else '_page_' end, cast(page as string), '_idx_',
  cast(idx as string), '.jpg') end as image_name
from listing_raw
""",
    ),
    "attach_image_paths": with_views(
        ["listing_raw"],
        "select site, page, idx, case when page % 13 <> 0 then image_path end as image_path "
        "from listing_raw",
    ),
    "union_sites": with_views(["listing_raw"], f"select {', '.join(_ALL)} from listing_raw"),
    "drop_stale_outputs": with_views(
        ["image_files", "failed_images"],
        "select * from image_files where basename not in (select basename from failed_images)",
    ),
    "ingest_stream": _extract_sql(">= 0"),
    "ingest_versions": with_views(
        ["listing_raw"],
        """
select site, page, n_versions, count(*) * n_versions as n_rows, count(*) as n_latest,
  n_versions as latest_version
from (select *, case when page % 4 = 0 then 3 when page % 2 = 0 then 2 else 1 end as n_versions
  from listing_raw)
group by site, page, n_versions
""",
    ),
    "ingest_rejects": with_views(
        ["listing_raw"],
        """
select site, case site when 0 then 'cell count' when 1 then 'no place cell' when 2 then 'no city'
  else 'no property list' end as reject_reason, count(*) as n_rows, 1 as n_versions
from listing_raw group by site
""",
    ),
}
