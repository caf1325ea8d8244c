"""Field functions over every row of the raw listing view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from carlot.functions import text as tx
from carlot.operators.combine import reject_rows
from carlot.plans.fixtures import Views
from carlot.plans.sql_views import strip, with_views
from carlot.schema import KEY_COLUMNS
from carlot.sources.listings import normalize_na, require_columns

# Input texts, in SQL that both engines read alike.
INPUT = {
    "squash_ws": "concat('  ', seri, '  ', chr(10), model, chr(9), marka, ' ')",
    "clean_line": "case when page % 11 = 0 then null when page % 11 = 1 then '' "
    "else concat(' ', seri, chr(13), chr(10), model, ' ') end",
    "parse_title_prefix": "case page % 6 when 0 then concat('alfa romeo ', seri, ' ', model) "
    "when 1 then concat('Mercedes - Benz ', seri, ' ', model) when 2 then marka "
    "when 3 then concat('ASTON MARTIN', seri) when 4 then concat(marka, ' ', seri) "
    "else concat(marka, ' ', seri, ' ', model) end",
    "parse_title_hyphen": "case page % 3 when 0 then concat(marka, ' - ', seri) "
    "when 1 then concat(marka, '-', seri, '-', model, '-', yil) else marka end",
    "last_price": "case page % 5 when 0 then concat('9.999 TL', chr(10), fiyat) "
    "when 1 then ' ' when 2 then replace(fiyat, ' TL', '') else fiyat end",
    "first_line_price": "concat(' ', fiyat, chr(10), 'indirim ')",
    "ensure_tl": "case page % 4 when 0 then '' when 1 then replace(fiyat, ' TL', '') "
    "else fiyat end",
    "strip_km": "case when page % 7 = 0 then null else concat(km, ' ') end",
    "split_specs": "case when page % 10 = 0 then yil else concat(yil, ', ', km, ', Dizel') end",
    "city_of": "case when page % 10 = 0 then il_ilce else concat('Galeri, ', il_ilce) end",
    "year_of_description": "case when page % 4 = 0 then seri "
    "else concat(yil, ' Model, Beyaz') end",
    "attribute": "case when page % 2 = 0 then '' when page % 3 = 0 then null else km end",
    "primary": "case when page % 3 = 0 then fiyat else null end",
    "span": "case when page % 2 = 0 then fiyat else 'x' end",
    "clean_colour": "concat(seri, ' TL')",
    "slash_paths": "replace(image_path, '/', chr(92))",
    "na_km": "case when page % 19 = 0 then 'nan' when page % 23 = 0 then '' else km end",
    "cell": "case when page % 3 = 0 then '' else seri end",
}


def _given(name: str) -> Column:
    return F.expr(INPUT[name])


def _rows(views: Views, **columns: Column) -> DataFrame:
    return views.listing_raw.select(*KEY_COLUMNS, *[c.alias(n) for n, c in columns.items()])


def _titles(views: Views, c: Column) -> DataFrame:
    return views.listing_raw.withColumn("_t", c).select(*KEY_COLUMNS, "_t.*")


def _normalize_na(views: Views) -> DataFrame:
    given = views.listing_raw.withColumn("km", _given("na_km"))
    return normalize_na(given).select(*KEY_COLUMNS, "km", "fiyat", "image_path")


def _require_columns(views: Views) -> DataFrame:
    return require_columns(views.listing_raw).groupBy("marka").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def _reject_rows(views: Views) -> DataFrame:
    parsed = views.listing_raw.select(
        "site",
        tx.split_specs(_given("split_specs"))["km"].alias("km"),
        tx.city_of(F.expr("case when page % 7 = 0 then 'Galeri' else 'a, b' end")).alias("city"),
    )
    good, bad = reject_rows(parsed, {"no km": F.col("km"), "no city": F.col("city")})
    return (
        good.withColumn("reject_reason", F.lit("none"))
        .unionByName(bad)
        .groupBy("site", "reject_reason")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


QUERIES = {
    "normalize_na": _normalize_na,
    "require_columns": _require_columns,
    "squash_ws": lambda v: _rows(v, out=tx.squash_ws(_given("squash_ws"))),
    "clean_line": lambda v: _rows(v, out=tx.clean_line(_given("clean_line"))),
    "nonempty_cells": lambda v: _rows(
        v,
        out=F.array_join(
            tx.nonempty_cells(
                F.array("marka", _given("cell"), F.concat("model", F.lit("\n"), "yil"))
            ),
            "|",
        ),
    ),
    "parse_title_prefix": lambda v: _titles(v, tx.parse_title_prefix(_given("parse_title_prefix"))),
    "parse_title_hyphen": lambda v: _titles(v, tx.parse_title_hyphen(_given("parse_title_hyphen"))),
    "last_price": lambda v: _rows(v, out=tx.last_price(_given("last_price"))),
    "first_line_price": lambda v: _rows(v, out=tx.first_line_price(_given("first_line_price"))),
    "ensure_tl": lambda v: _rows(v, out=tx.ensure_tl(_given("ensure_tl"))),
    "price_fallback": lambda v: _rows(
        v, out=tx.price_fallback(_given("primary"), F.array("seri", _given("span")))
    ),
    "strip_km": lambda v: _rows(v, out=tx.strip_km(_given("strip_km"))),
    "split_specs": lambda v: _titles(v, tx.split_specs(_given("split_specs"))),
    "city_of": lambda v: _rows(v, out=tx.city_of(_given("city_of"))),
    "year_of_description": lambda v: _rows(
        v, out=tx.year_of_description(_given("year_of_description"))
    ),
    "join_title": lambda v: _rows(
        v, out=tx.join_title(F.col("marka"), F.col("seri"), F.col("model"))
    ),
    "attr_or_text": lambda v: _rows(v, out=tx.attr_or_text(_given("attribute"), F.col("model"))),
    "first_last_item": lambda v: _titles(
        v,
        tx.first_last_item(
            F.slice(
                F.array("km", "yil", "il_ilce"), F.lit(1), (F.col("page") % 4).cast("int")
            )
        ),
    ),
    "clean_colour": lambda v: _rows(v, out=tx.clean_colour(_given("clean_colour"))),
    "slash_paths": lambda v: _rows(v, out=tx.slash_paths(_given("slash_paths"))),
    "reject_rows": _reject_rows,
}


def _sql(expression: str) -> str:
    return with_views(["listing_raw"], f"select site, page, idx, {expression} from listing_raw")


def _over(given: str, expression: str) -> str:
    return with_views(
        ["listing_raw"],
        f"select site, page, idx, {expression} "
        f"from (select *, {INPUT[given]} as x from listing_raw)",
    )


_TRIMMED = strip("x")
_KNOWN = (
    "case when lower(x) like 'alfa romeo%' then 'Alfa Romeo' "
    "when lower(x) like 'aston martin%' then 'Aston Martin' "
    "when lower(x) like 'ds automobiles%' then 'DS Automobiles' "
    "when lower(x) like 'mercedes - benz%' then 'Mercedes - Benz' end"
)

SQL = {
    "normalize_na": with_views(
        ["listing_raw"],
        f"select site, page, idx, case when x in ('nan', '') then null else x end as km, "
        f"nullif(fiyat, 'N/A') as fiyat, image_path "
        f"from (select *, {INPUT['na_km']} as x from listing_raw)",
    ),
    "require_columns": with_views(
        ["listing_raw"], "select marka, count(*) as n_rows from listing_raw group by marka"
    ),
    "squash_ws": _over("squash_ws", r"trim(regexp_replace(x, '\s+', ' ', 'g')) as out"),
    "clean_line": _over(
        "clean_line", f"coalesce(replace(replace({_TRIMMED}, chr(10), ' '), chr(13), ''), '') as out"
    ),
    "nonempty_cells": _sql(
        f"array_to_string(list_filter([marka, {INPUT['cell']}, concat(model, ' ', yil)], "
        "lambda c: c <> ''), '|') as out"
    ),
    "parse_title_prefix": with_views(
        ["listing_raw"],
        f"""
select site, page, idx, coalesce(b, split_part(x, ' ', 1)) as brand,
  case when b is null then split_part(x, ' ', 2) else split_part(rest, ' ', 1) end as series,
  case when b is null then array_to_string(string_split(x, ' ')[3:], ' ')
       else array_to_string(string_split(rest, ' ')[2:], ' ') end as trim
from (select *, {strip("substr(x, length(b) + 1)")} as rest
      from (select *, {_KNOWN} as b
            from (select *, {INPUT['parse_title_prefix']} as x from listing_raw)))
""",
    ),
    "parse_title_hyphen": _over(
        "parse_title_hyphen",
        f"{strip('split_part(x, chr(45), 1)')} as brand, "
        f"{strip('split_part(x, chr(45), 2)')} as series, "
        "trim(array_to_string(string_split(x, '-')[3:], '-')) as trim",
    ),
    "last_price": with_views(
        ["listing_raw"],
        f"""
select site, page, idx,
  case when len(p) > 0 then concat(p[-1], ' TL') else 'N/A' end as out
from (select *, list_filter(list_transform(string_split(replace(x, chr(10), ' '), 'TL'),
        lambda c: trim(c)), lambda c: c <> '') as p
      from (select *, {INPUT['last_price']} as x from listing_raw))
""",
    ),
    "first_line_price": _over(
        "first_line_price", f"concat(split_part({_TRIMMED}, chr(10), 1), ' ₺') as out"
    ),
    "ensure_tl": _over(
        "ensure_tl",
        "case when x = '' then '' when trim(x) like '%TL' then trim(x) "
        "else concat(trim(x), ' TL') end as out",
    ),
    "price_fallback": _sql(
        f"coalesce({INPUT['primary']}, list_filter([seri, {INPUT['span']}], "
        "lambda c: c like '%TL%' or c like '%₺%')[1], '') as out"
    ),
    "strip_km": _over("strip_km", "coalesce(trim(replace(x, ' km', '')), '') as out"),
    "split_specs": _over(
        "split_specs",
        "trim(string_split(x, ',')[1]) as year, trim(string_split(x, ',')[2]) as km, "
        "len(string_split(x, ',')) < 2 as rejected",
    ),
    "city_of": _over("city_of", "trim(string_split(x, ',')[2]) as out"),
    "year_of_description": _over(
        "year_of_description",
        "case when x like '%Model%' then trim(split_part(x, 'Model', 1)) else '' end as out",
    ),
    "join_title": _sql("marka || ' ' || seri || ' ' || model as out"),
    "attr_or_text": _over("attribute", "coalesce(nullif(x, ''), model) as out"),
    "first_last_item": _sql(
        "case when page % 4 > 0 then km else '' end as km, "
        "case page % 4 when 2 then yil when 3 then il_ilce else '' end as place"
    ),
    "clean_colour": _sql("seri as out"),
    "slash_paths": _sql("image_path as out"),
    "reject_rows": with_views(
        ["listing_raw"],
        "select site, case when page % 10 = 0 then 'no km' when page % 7 = 0 then 'no city' "
        "else 'none' end as reject_reason, count(*) as n_rows from listing_raw group by 1, 2",
    ),
}
