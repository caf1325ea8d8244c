"""String functions for scraped listing fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from carlot.schema import MULTI_WORD_BRANDS

# White space as Python's str.strip and str.split see it: Unicode White_Space
# and the four separators U+001C to U+001F.
_BLANKS = "".join(
    map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028,
              0x2029, 0x202F, 0x205F, 0x3000])
)
_CASED = r"[\p{IsUppercase}\p{IsLowercase}\p{IsTitlecase}]"


def strip(c: Column) -> Column:
    """Drop white space of any kind at both ends (F.trim drops blanks only)."""
    return F.btrim(c, F.lit(_BLANKS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def squash_ws(c: Column) -> Column:
    """Trim, and turn each run of white space into one blank."""
    blanks = F.translate(c, _BLANKS, " " * len(_BLANKS))
    return F.trim(F.regexp_replace(blanks, " {2,}", " "))


def clean_line(c: Column) -> Column:
    """One trimmed line: line feeds become blanks, carriage returns go; null is ''."""
    one_line = F.replace(F.replace(strip(c), F.lit("\n"), F.lit(" ")), F.lit("\r"), F.lit(""))
    return F.coalesce(one_line, F.lit(""))


def nonempty_cells(cells: Column) -> Column:
    """Cells that hold text, each on one line."""
    return F.filter(
        F.transform(cells, lambda x: F.replace(x, F.lit("\n"), F.lit(" "))),
        lambda x: x != "",
    )


def _part(parts: Column, i: int) -> Column:
    return F.coalesce(F.get(parts, F.lit(i)), F.lit(""))


def parse_title_prefix(title: Column) -> Column:
    """Struct of brand, series, trim read off the blanks of a title.

    Brands of several words are matched first, in any case, and come back in
    their usual spelling.
    """
    lowered = F.lower(title)

    def known(brand: str) -> Column:
        rest = F.split(strip(F.substring(title, len(brand) + 1, 2147483647)), " ", 2)
        return F.when(
            lowered.startswith(brand.lower()),
            F.struct(
                F.lit(brand).alias("brand"),
                _part(rest, 0).alias("series"),
                _part(rest, 1).alias("trim"),
            ),
        )

    words = F.split(title, " ", 3)
    plain = F.struct(
        _part(words, 0).alias("brand"),
        _part(words, 1).alias("series"),
        _part(words, 2).alias("trim"),
    )
    return F.coalesce(*[known(b) for b in MULTI_WORD_BRANDS], plain)


def parse_title_hyphen(title: Column) -> Column:
    """Struct of brand, series, trim cut at the first two hyphens."""
    parts = F.split(title, "-", 3)
    return F.struct(
        strip(_part(parts, 0)).alias("brand"),
        strip(_part(parts, 1)).alias("series"),
        strip(_part(parts, 2)).alias("trim"),
    )


def last_price(c: Column) -> Column:
    """The last amount before a 'TL' (the discounted one), or 'N/A'."""
    pieces = F.filter(F.transform(F.split(c, "TL"), _flat_strip), lambda x: x != "")
    return F.when(
        F.size(pieces) > 0, F.concat(F.element_at(pieces, -1), F.lit(" TL"))
    ).otherwise(F.lit("N/A"))


def _flat_strip(c: Column) -> Column:
    return strip(F.replace(c, F.lit("\n"), F.lit(" ")))


def first_line_price(c: Column) -> Column:
    return F.concat(F.substring_index(strip(c), "\n", 1), F.lit(" ₺"))


def ensure_tl(c: Column) -> Column:
    """End a price in 'TL'; empty stays empty, null becomes ''."""
    trimmed = strip(c)
    return (
        F.when(F.coalesce(c, F.lit("")) == "", F.lit(""))
        .when(trimmed.endswith("TL"), trimmed)
        .otherwise(F.concat(trimmed, F.lit(" TL")))
    )


def price_fallback(primary: Column, spans: Column) -> Column:
    """The primary price, else the first span that shows a currency, else ''."""
    priced = F.filter(spans, lambda x: x.contains("TL") | x.contains("₺"))
    return F.coalesce(primary, F.get(priced, F.lit(0)), F.lit(""))


def strip_km(c: Column) -> Column:
    return F.coalesce(strip(F.replace(c, F.lit(" km"), F.lit(""))), F.lit(""))


def split_specs(c: Column) -> Column:
    """Struct of year, km and whether the second part is missing."""
    parts = F.split(c, ",")
    return F.struct(
        strip(F.get(parts, F.lit(0))).alias("year"),
        strip(F.get(parts, F.lit(1))).alias("km"),
        F.get(parts, F.lit(1)).isNull().alias("rejected"),
    )


def city_of(c: Column) -> Column:
    """The part after the first comma; null (a reject) if there is none."""
    return strip(F.get(F.split(c, ","), F.lit(1)))


def year_of_description(c: Column) -> Column:
    return F.when(c.contains("Model"), strip(F.substring_index(c, "Model", 1))).otherwise(F.lit(""))


def join_title(brand: Column, series: Column, trim: Column) -> Column:
    return F.concat_ws(" ", brand, series, trim)


def attr_or_text(attribute: Column, text: Column) -> Column:
    return F.coalesce(blank_to_null(attribute), text)


def first_last_item(items: Column) -> Column:
    """Struct of km (first item, if any) and place (last item, if more than one)."""
    return F.struct(
        _part(items, 0).alias("km"),
        F.when(F.size(items) > 1, F.element_at(items, -1)).otherwise(F.lit("")).alias("place"),
    )


def clean_colour(c: Column) -> Column:
    return F.replace(c, F.lit(" TL"), F.lit(""))


def slash_paths(c: Column) -> Column:
    return F.replace(c, F.lit("\\"), F.lit("/"))


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _drop(c: Column, *words: str) -> Column:
    for word in words:
        c = F.replace(c, F.lit(word), F.lit(""))
    return c


def clean_km(c: Column) -> Column:
    """Digits of a mileage; every '-' reads as 0."""
    return strip(F.replace(_drop(c, "km", "."), F.lit("-"), F.lit("0")))


def clean_price(c: Column) -> Column:
    return strip(_drop(c, "TL", "₺", "."))


def title_case(c: Column) -> Column:
    """Upper-case the first letter of every run of cased letters, lower the rest.

    Unlike F.initcap a word also starts after a digit, hyphen or apostrophe.
    """
    runs = F.regexp_extract_all(c, F.lit(f"({_CASED}+|[^{_CASED[1:-1]}]+)"), F.lit(1))
    return F.array_join(
        F.transform(
            runs,
            lambda r: F.concat(
                F.upper(F.substring(r, 1, 1)), F.lower(F.substring(r, 2, 2147483647))
            ),
        ),
        "",
    )


def dotted_number(c: Column) -> Column:
    """A typed mileage such as '45.000' as a number."""
    return F.replace(c, F.lit("."), F.lit("")).cast("double")


def format_estimate(price: Column) -> Column:
    return F.concat(F.format_number(F.rint(price), 0), F.lit(" TL"))
