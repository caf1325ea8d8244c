"""Listing rows out of landed HTML pages, one function per page dialect.

Pages are rows of ``site, page, html``.  Every ``parse`` function reads the
markup of one known dialect with regular expressions on the JVM side.  The
``extract`` functions number the accepted rows of a page from 0 in document
order, or return the rejects instead.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, functions as F

from carlot.functions import text as tx
from carlot.functions.arrays import let
from carlot import schema as sc
from carlot.schema import IDENTITY_COLUMNS

_FIELDS = [*IDENTITY_COLUMNS, "img_url"]


# Names of the standard character entities, in parallel with their characters.
_ENTITIES = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'", "nbsp": " "}


def _numbered(name: Column) -> Column:
    """Character of '#231' or '#xE7'; null if there is no such character."""
    digits = F.when(name.rlike("^#[0-9]{1,7}$"), F.conv(F.substring(name, 2, 7), 10, 16)).when(
        name.rlike("(?i)^#x[0-9a-f]{1,6}$"), F.substring(name, 3, 6)
    )
    code = F.conv(digits, 16, 10).cast("long")
    known = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    char = F.when(known, F.decode(F.unhex(F.lpad(digits, 8, "0")), "UTF-32"))
    return F.replace(char, F.lit("\u00a0"), F.lit(" "))


def _decode(c: Column) -> Column:
    """Named and numeric entities as characters, each read once; others stay."""
    named = F.str_to_map(
        F.lit(",".join(f"{n}={x}" for n, x in _ENTITIES.items())), F.lit(","), F.lit("=")
    )

    def piece(p: Column) -> Column:
        name = F.regexp_extract(p, "^(#?[0-9A-Za-z]{1,31});", 1)
        char = F.when(name.startswith("#"), _numbered(name)).otherwise(F.try_element_at(named, name))
        return F.coalesce(
            F.concat(char, F.regexp_replace(p, "^[^;]*;", "")), F.concat(F.lit("&"), p)
        )

    parts = F.split(c, "&")
    rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), piece)
    return F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))


def _untag(c: Column) -> Column:
    gap = "(?: |<!--.*?-->)*"
    c = F.regexp_replace(c, rf"(?i){gap}(<br ?/?>|</(p|div|li|tr|h[1-6])>){gap}", "\n")
    return F.regexp_replace(c, r"<!--.*?-->|<[^>]*>", "")


# One element with text alone; its tags leave at most line feeds at the ends.
_BARE = r"^<[A-Za-z][^<>]*+>([^<]++)</[A-Za-z][^<>]*+>\z"


def html_text(markup: Column) -> Column:
    """Visible text of a fragment: tags gone, entities read, breaks as line feeds.

    Most fragments have neither tags nor entities, or are one element, and skip those steps.
    """
    def untagged(t: Column) -> Column:
        bare = F.regexp_extract(t, _BARE, 1)
        return let(bare, lambda x: F.when(x != "", x).otherwise(_untag(t)))

    squashed = F.regexp_replace(markup, r"[ \t\r\n\f]+", " ")
    plain = let(squashed, lambda t: F.when(t.contains("<"), untagged(t)).otherwise(t))
    return let(
        plain,
        lambda t: F.btrim(F.when(t.contains("&"), _decode(t)).otherwise(t), F.lit(" \n")),
    )


def _elements(html: Column, tag: str) -> Column:
    """Inner markup of every element of one tag."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))


def _opening(tag: str, attribute: str, part: str, whole_word: bool = False) -> str:
    """Pattern of an opening tag whose attribute holds a text or a whole word."""
    if whole_word:
        value = rf"(?:[^\"']*\s)?{part}(?:\s[^\"']*)?"
    else:
        value = rf"[^\"']*{part}[^\"']*"
    return rf"<{tag}\b[^>]*?\b{attribute}\s*=\s*[\"']{value}[\"'][^>]*>"


def _first(c: Column, pattern: str) -> Column:
    """First match of a pattern, whole; null when it does not occur."""
    return let(F.regexp_extract(c, pattern, 0), tx.blank_to_null)


# An element without another of its tag inside, from its opening to its closing tag.
_SIMPLE = r"(?is)^<(\w+)\b[^<>]*+>[^<]*+(?:<(?!/?\1\b)[^<]*+)*+</\1\s*>"


def _closed(rest: Column, tag: Column) -> Column:
    """The element that ``rest`` starts with, up to its own closing tag.

    Elements of the same tag inside it are counted; one that is never closed
    runs to the end, as a browser reads it.  Most elements hold none of their tag and are
    read by one fixed pattern; patterns made of the tag are compiled for each row.
    """
    def balanced(c: Column) -> Column:
        cuts = F.split(c, F.concat(F.lit("(?i)(?=</?"), tag, F.lit("\\b)")))
        start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(0).alias("end"))

        def walk(s: Column, cut: Column) -> Column:
            depth = s["depth"] + F.when(cut.startswith("</"), -1).otherwise(1)
            ends = (s["end"] == 0) & (depth == 0)
            return F.struct(
                (s["at"] + 1).alias("at"), depth.alias("depth"),
                F.when(ends, s["at"]).otherwise(s["end"]).alias("end"),
            )

        return let(
            cuts,
            lambda a: let(
                F.aggregate(a, start, walk)["end"],
                lambda end: F.when(end == 0, c).otherwise(
                    F.concat(F.array_join(F.slice(a, F.lit(1), end), ""), F.lit("</"), tag, F.lit(">"))
                ),
            ),
        )

    def read(c: Column) -> Column:
        short = F.regexp_substr(c, F.concat(F.lit("(?is)^.*?</"), tag, F.lit("\\s*>")))
        inside = F.concat(F.lit("(?is)^<[^>]*>.*<"), tag, F.lit("\\b"))
        simple = F.when(~F.regexp_like(short, inside), short)
        return let(simple, lambda x: F.when(x.isNotNull(), x).otherwise(balanced(c)))

    def quick(c: Column) -> Column:
        return let(F.regexp_extract(c, _SIMPLE, 0), lambda x: F.when(x != "", x).otherwise(read(c)))

    return let(rest, lambda c: F.when(c.isNotNull(), quick(c)))


def _by_class(c: Column, cls: str, tag: str, whole_word: bool = False) -> Column:
    """The first element with a class, tags included; null if there is none."""
    return _closed(_first(c, "(?is)" + _opening(tag, "class", cls, whole_word) + ".*"), F.lit(tag))


def _attribute(c: Column, name: str) -> Column:
    """Value of an attribute of an opening tag; '' if it has none, null without a tag."""
    return F.regexp_extract(c, rf"(?is)(?<![\w-]){name}\s*=\s*([\"'])(.*?)\1", 2)


def _image_src(c: Column) -> Column:
    return _attribute(_first(c, r"(?is)<img\b[^>]*>"), "src")


def _pieces(html: Column, opening: str) -> Column:
    """The page cut before every opening tag; the part before the first is dropped."""
    parts = F.split(html, f"(?is)(?={opening})")
    return F.filter(parts, lambda p: p.rlike(f"(?is)^{opening}"))


def _emit(pages: DataFrame, parsed: Column, rejects: bool) -> DataFrame:
    """One row per accepted (or rejected) struct of a page."""
    kept = [c for c in ("landed_at", "digest", "version") if c in pages.columns]
    if rejects:
        # an expression, not a column: Spark tests a column that it explodes for being empty
        # first, which would parse every page once more
        placed = F.transform(
            parsed, lambda r, i: F.struct(i.cast("long").alias("position"), r.alias("row"))
        )
        bad = F.filter(placed, lambda x: x["row"]["reject_reason"].isNotNull())
        out = pages.select("site", "page", *kept, F.inline(bad))
        return out.select(
            "site", "page", "position",
            *[F.col(f"row.{f}").alias(f) for f in [*_FIELDS, "reject_reason"]],
            *kept,
        )
    wanted = F.filter(parsed, lambda r: r["reject_reason"].isNull())
    out = pages.select("site", "page", *kept, F.posexplode(wanted).alias("idx", "row"))
    return out.select(
        "site",
        "page",
        F.col("idx").cast("long").alias("idx"),
        *[F.col(f"row.{f}").alias(f) for f in _FIELDS],
        F.lit(None).cast("string").alias("image_path"),
        *kept,
    )


def _reason(*checks: tuple[Column, str]) -> Column:
    """Text of the first failed check, or null."""
    return F.coalesce(*[F.when(failed, F.lit(why)) for failed, why in checks], F.lit(None))


def _table_rows(html: Column, attribute: str, value: str) -> Column:
    """``<tr>`` bodies of the listing table of a page.

    Cells of a table inside a cell count as further cells of the outer row.
    """
    opening = "(?is)" + _opening("table", attribute, value, whole_word=True) + ".*"
    table = F.coalesce(_closed(_first(html, opening), F.lit("table")), F.lit(""))
    inner = F.regexp_replace(table, r"(?is)^<table\b[^>]*>|</table\s*>$", "")
    return _elements(
        let(inner, lambda t: F.when(t.rlike(r"(?i)<table\b"), _flat_tables(t)).otherwise(t)), "tr"
    )


def _flat_tables(inner: Column) -> Column:
    """Markup of a table whose inner tables are reduced to their cells."""
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("out"))

    def walk(s: Column, cut: Column) -> Column:
        depth = (
            s["depth"] + cut.rlike(r"(?i)^<table\b").cast("int")
            - cut.rlike(r"(?i)^</table\b").cast("int")
        )
        bare = F.regexp_replace(cut, r"(?is)</?(table|thead|tbody|tfoot|tr)\b[^>]*>", "")
        inside = F.regexp_replace(bare, r"(?is)<td\b[^>]*>", "</td><td>")
        after = F.regexp_replace(cut, r"(?is)^</table\b[^>]*>", "")
        return F.struct(
            depth.alias("depth"),
            F.concat(s["out"], F.when(depth > 0, inside).otherwise(after)).alias("out"),
        )

    return F.aggregate(F.split(inner, r"(?i)(?=</?table\b)"), start, walk)["out"]


def parse_cells9(html: Column) -> Column:
    """Table dialect where an ad row has exactly nine cells with text.

    The image sits in a cell without text; the eighth text cell is a date.
    """
    with_cells = F.filter(
        F.transform(
            _table_rows(html, "id", sc.CELLS9_TABLE_ID),
            lambda r: F.struct(_elements(r, "td").alias("raw")),
        ),
        lambda r: F.size(r["raw"]) > 0,
    )
    read = F.transform(
        with_cells,
        lambda r: F.struct(
            tx.nonempty_cells(F.transform(r["raw"], html_text)).alias("cells"),
            _image_src(F.get(r["raw"], F.lit(0))).alias("img_url"),
        ),
    )
    return F.transform(
        read,
        lambda r: F.struct(
            *[F.get(r["cells"], F.lit(i)).alias(n) for i, n in zip(sc.CELLS9_CELL_ORDER, IDENTITY_COLUMNS)],
            r["img_url"].alias("img_url"),
            _reason(
                (F.size(r["cells"]) != sc.CELLS9_CELLS, "cell count"),
                (r["img_url"].isNull(), "no image"),
            ).alias("reject_reason"),
        ),
    )


def parse_cells8(html: Column) -> Column:
    """Table dialect with a header row; the title column carries brand, series, trim."""
    all_rows = _table_rows(html, "class", sc.CELLS8_TABLE_CLASS)
    body = F.slice(all_rows, F.lit(2), F.greatest(F.size(all_rows) - 1, F.lit(0)))
    read = F.transform(
        body,
        lambda r: F.struct(_elements(r, "td").alias("raw")),
    )
    cells = F.transform(
        read,
        lambda r: F.struct(
            F.transform(r["raw"], html_text).alias("cells"),
            _image_src(F.get(r["raw"], F.lit(0))).alias("img_url"),
        ),
    )
    split_title = F.transform(
        cells,
        lambda r: F.struct(
            let(tx.squash_ws(F.get(r["cells"], F.lit(1))), tx.parse_title_prefix).alias("title"),
            r["cells"].alias("cells"),
            r["img_url"].alias("img_url"),
        ),
    )

    def cell(r: Column, i: int) -> Column:
        return F.get(r["cells"], F.lit(i))

    return F.transform(
        split_title,
        lambda r: F.struct(
            r["title"]["brand"].alias("marka"),
            r["title"]["series"].alias("seri"),
            r["title"]["trim"].alias("model"),
            tx.squash_ws(cell(r, 2)).alias("baslik"),
            tx.squash_ws(cell(r, 3)).alias("yil"),
            tx.squash_ws(cell(r, 4)).alias("km"),
            tx.last_price(cell(r, 6)).alias("fiyat"),
            tx.squash_ws(cell(r, 8)).alias("il_ilce"),
            r["img_url"].alias("img_url"),
            _reason(
                (F.size(r["cells"]) < sc.CELLS8_MIN_CELLS, "too few cells"),
                (cell(r, 8).isNull(), "no place cell"),
            ).alias("reject_reason"),
        ),
    )


def _card_parts(card: Column) -> Column:
    """Names and markup of the parts of a card, in two scans for all of them."""
    names = "|".join(sc.CARD_PARTS)
    opening = _opening(r"(\w+)", "class", f"{sc.CARD_PREFIX}({names})", whole_word=True)
    named = F.transform(
        F.split(card, f"(?is)(?={opening})"),
        lambda p: F.struct(F.regexp_extract(p, f"(?is)^{opening}", 2).alias("name"), p.alias("rest")),
    )
    return let(
        F.filter(named, lambda x: x["name"] != ""),
        lambda cut: F.struct(
            cut["name"].alias("names"),
            F.transform(
                cut["rest"], lambda p: _closed(p, F.regexp_extract(p, r"^<(\w+)", 1))
            ).alias("parts"),
        ),
    )


def _card_fields(r: Column) -> Column:
    def part(name: str) -> Column:
        at = F.array_position(r["names"], F.lit(name)).cast("int") - 1
        return F.get(r["parts"], at)

    def in_title(tag: str) -> Column:
        return html_text(_first(part("title"), rf"(?is)<{tag}\b[^>]*>.*?</{tag}>"))

    return F.struct(
        in_title("strong").alias("brand"),
        in_title("span").alias("series"),
        _image_src(part("figure")).alias("img_url"),
        html_text(part("summary")).alias("trim"),
        let(html_text(part("specs-summary")), tx.split_specs).alias("specs"),
        tx.first_line_price(html_text(part("price"))).alias("price"),
        tx.city_of(html_text(part("footer-title"))).alias("city"),
    )


def parse_card(html: Column) -> Column:
    """Card dialect: one container element per ad."""
    container = _opening(r"\w+", "class", f"{sc.CARD_PREFIX}container", whole_word=True)
    cards = _pieces(html, container)
    read = F.transform(F.transform(cards, _card_parts), _card_fields)
    return F.transform(
        read,
        lambda r: F.struct(
            r["brand"].alias("marka"),
            r["series"].alias("seri"),
            r["trim"].alias("model"),
            tx.join_title(r["brand"], r["series"], r["trim"]).alias("baslik"),
            r["specs"]["year"].alias("yil"),
            r["specs"]["km"].alias("km"),
            r["price"].alias("fiyat"),
            r["city"].alias("il_ilce"),
            r["img_url"].alias("img_url"),
            _reason(
                (r["img_url"].isNull(), "no image"),
                (r["brand"].isNull() | r["series"].isNull(), "no title"),
                (r["trim"].isNull(), "no summary"),
                (r["specs"]["year"].isNull() | r["specs"]["km"].isNull(), "no specs"),
                (r["price"].isNull(), "no price"),
                (r["city"].isNull(), "no city"),
            ).alias("reject_reason"),
        ),
    )


def parse_grid(html: Column) -> Column:
    """Grid dialect: one section per ad, with a property list."""
    held = "".join(rf"(?=[^>]*\bclass\s*=\s*[\"'][^\"']*{word})" for word in sc.GRID_SECTION)
    opening = rf"<section\b{held}[^>]*>"
    sections = _pieces(html, opening)

    def slide_image(c: Column) -> Column:
        opening = "(?is)" + _opening("div", "class", sc.GRID_SLIDE, whole_word=True)
        slide = _first(c, opening + ".*")
        return _attribute(_first(slide, "(?is)" + _opening("img", "class", sc.GRID_IMAGE)), "src")

    def price(c: Column) -> Column:
        boxes = F.transform(
            _pieces(c, _opening("div", "class", sc.GRID_PRICE_BOX, whole_word=True)),
            lambda box: html_text(
                _by_class(_closed(box, F.lit("div")), sc.GRID_PRICE, tag="span")
            ),
        )
        spans = F.transform(_elements(c, "span"), html_text)
        found = tx.price_fallback(F.get(F.array_compact(boxes), F.lit(0)), spans)
        return let(found, tx.ensure_tl)

    def property_text(item: Column) -> Column:
        pattern = "(?is)" + _opening("span", "class", sc.GRID_PROPERTY)
        title = _attribute(_first(item, pattern), "title")
        return tx.attr_or_text(title, html_text(_by_class(item, sc.GRID_PROPERTY, tag="span")))

    read = F.transform(
        sections,
        lambda c: F.struct(
            slide_image(c).alias("img_url"),
            html_text(_by_class(c, sc.GRID_TITLE, tag="div")).alias("advert"),
            F.transform(
                _elements(_by_class(c, sc.GRID_PROPERTIES, tag="ul"), "li"), property_text
            ).alias("items"),
            price(c).alias("price"),
            html_text(_by_class(c, sc.GRID_DESCRIPTION, tag="small")).alias("description"),
        ),
    )
    titled = F.transform(
        read,
        lambda r: F.struct(
            let(tx.clean_line(r["advert"]), tx.parse_title_hyphen).alias("title"),
            tx.first_last_item(r["items"]).alias("ends"),
            r.alias("raw"),
        ),
    )
    return F.transform(
        titled,
        lambda r: F.struct(
            r["title"]["brand"].alias("marka"),
            r["title"]["series"].alias("seri"),
            r["title"]["trim"].alias("model"),
            tx.clean_line(r["raw"]["advert"]).alias("baslik"),
            F.coalesce(
                tx.year_of_description(r["raw"]["description"]), F.lit("")
            ).alias("yil"),
            tx.strip_km(r["ends"]["km"]).alias("km"),
            r["raw"]["price"].alias("fiyat"),
            tx.clean_line(r["ends"]["place"]).alias("il_ilce"),
            r["raw"]["img_url"].alias("img_url"),
            _reason(
                (r["raw"]["img_url"].isNull(), "no image"),
                (r["raw"]["advert"].isNull(), "no title"),
                (r["raw"]["items"].isNull(), "no property list"),
                (_end_unnamed(r["raw"]["items"]), "no property name"),
            ).alias("reject_reason"),
        ),
    )


def _end_unnamed(items: Column) -> Column:
    """Whether the first or last property has no name; the others are not read."""
    return (F.size(items) > 0) & (
        F.get(items, F.lit(0)).isNull() | F.get(items, F.size(items) - 1).isNull()
    )


# Page dialect of each site number.
DIALECTS = {0: parse_cells9, 1: parse_cells8, 2: parse_card, 3: parse_grid}


def extract_rows_cells9(pages: DataFrame, rejects: bool = False) -> DataFrame:
    return _emit(pages, parse_cells9(F.col("html")), rejects)


def extract_rows_cells8(pages: DataFrame, rejects: bool = False) -> DataFrame:
    return _emit(pages, parse_cells8(F.col("html")), rejects)


def extract_rows_card(pages: DataFrame, rejects: bool = False) -> DataFrame:
    return _emit(pages, parse_card(F.col("html")), rejects)


def extract_rows_grid(pages: DataFrame, rejects: bool = False) -> DataFrame:
    return _emit(pages, parse_grid(F.col("html")), rejects)


def extract_listings(pages: DataFrame, rejects: bool = False) -> DataFrame:
    """Listing rows of all sites, each page read in the dialect of its site."""
    return _emit(parse_pages(pages), F.col("parsed"), rejects)


def parse_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with ``parsed``, the structs of their ads, in place of ``html``."""
    parsed = None
    for site, parse in DIALECTS.items():
        here, rows = F.col("site") == site, parse(F.col("html"))
        parsed = F.when(here, rows) if parsed is None else parsed.when(here, rows)
    return pages.withColumn("parsed", parsed).drop("html")


def parsed_listings(parsed: DataFrame, rejects: bool = False) -> DataFrame:
    """Rows of ``parse_pages``; load time, digest and version of a page stay with its rows."""
    return _emit(parsed, F.col("parsed"), rejects)


def extract_page_fields(pages: DataFrame) -> DataFrame:
    """Title, first heading, number of links and first link of any HTML page."""
    html = F.col("html")
    links = F.regexp_extract_all(
        html, F.lit(r"(?is)<a\b[^>]*?\bhref\s*=\s*[\"']([^\"']*)[\"'][^>]*>"), F.lit(1)
    )
    return pages.withColumn("_links", links).select(
        *[c for c in pages.columns if c != "html"],
        html_text(F.get(_elements(html, "title"), F.lit(0))).alias("title"),
        html_text(F.get(_elements(html, "h1"), F.lit(0))).alias("h1"),
        F.size("_links").alias("n_links"),
        F.get("_links", F.lit(0)).alias("first_link"),
    )
