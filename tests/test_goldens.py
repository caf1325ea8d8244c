"""Fixed input and output pairs of the column functions and steps."""

import pytest
from pyspark.sql import functions as F

from carlot.functions import arrays as ar, pixels as px, text as tx
from carlot.operators import cleaning, pricing, scores, training
from carlot.sources import crawl
from carlot.sources.listings import normalize_na, require_columns
from carlot.schema import NA_TOKENS


def one(spark, column):
    value = spark.range(1).select(column.alias("v")).first().v
    return tuple(value) if hasattr(value, "asDict") else value


@pytest.mark.parametrize(
    "function, given, expected",
    [
        (tx.squash_ws, "  a \n b\t c ", "a b c"),
        (tx.squash_ws, " a \u001cb ", "a b"),
        (tx.strip, "\u001c  a\t\n", "a"),
        (tx.clean_line, " a\nb\r ", "a b"),
        (tx.clean_line, None, ""),
        (tx.parse_title_prefix, "Alfa Romeo Giulietta 1.6 JTD",
         ("Alfa Romeo", "Giulietta", "1.6 JTD")),
        (tx.parse_title_prefix, "mercedes - benz C 200 d", ("Mercedes - Benz", "C", "200 d")),
        (tx.parse_title_prefix, "Fiat Egea", ("Fiat", "Egea", "")),
        (tx.parse_title_prefix, "Alfa Romeo", ("Alfa Romeo", "", "")),
        (tx.parse_title_prefix, "", ("", "", "")),
        (tx.parse_title_hyphen, "Ford - Focus - 1.5 - Titanium",
         ("Ford", "Focus", "1.5 - Titanium")),
        (tx.parse_title_hyphen, "Mercedes-Benz-C 180", ("Mercedes", "Benz", "C 180")),
        (tx.parse_title_hyphen, "Ford", ("Ford", "", "")),
        (tx.last_price, "1.000.000 TL\n950.000 TL", "950.000 TL"),
        (tx.last_price, " ", "N/A"),
        (tx.last_price, "500", "500 TL"),
        (tx.first_line_price, "750.000\nindirim", "750.000 ₺"),
        (tx.ensure_tl, "1.000 ₺", "1.000 ₺ TL"),
        (tx.ensure_tl, "", ""),
        (tx.ensure_tl, None, ""),
        (tx.strip_km, "45.000 km", "45.000"),
        (tx.strip_km, None, ""),
        (tx.split_specs, "2020, 45.000 km, Dizel", ("2020", "45.000 km", False)),
        (tx.split_specs, "2020", ("2020", None, True)),
        (tx.city_of, "Galeri Maslak, İstanbul", "İstanbul"),
        (tx.city_of, "Maslak", None),
        (tx.year_of_description, "2020 Model, Beyaz", "2020"),
        (tx.year_of_description, "Beyaz", ""),
        (tx.slash_paths, "a\\b", "a/b"),
        (tx.clean_colour, "Beyaz TL", "Beyaz"),
        (tx.clean_km, "45.000 km", "45000"),
        (tx.clean_km, "-", "0"),
        (tx.clean_km, "10-20", "10020"),
        (tx.clean_price, "1.250.000 TL", "1250000"),
        (tx.clean_price, "99.900 ₺", "99900"),
        (tx.title_case, "mercedes-benz", "Mercedes-Benz"),
        (tx.title_case, "320d xDrive", "320D Xdrive"),
        (tx.title_case, "it's", "It'S"),
        (tx.title_case, "DİZEL", "Di̇zel"),
        (tx.dotted_number, "45.000", 45000.0),
    ],
)
def test_text(spark, function, given, expected):
    assert one(spark, function(F.lit(given).cast("string"))) == expected


@pytest.mark.parametrize("text", ["mercedes-benz AMG", "320d xDrive", "ığdır ŞAHİN", "o'neil 4x4"])
def test_title_case_is_python_title(spark, text):
    assert one(spark, tx.title_case(F.lit(text))) == text.title()


def test_array_fields(spark):
    cells = F.array(F.lit(""), F.lit("a\nb"), F.lit("c"))
    assert one(spark, tx.nonempty_cells(cells)) == ["a b", "c"]
    spans = F.array(F.lit("x"), F.lit("5 TL"))
    assert one(spark, tx.price_fallback(F.lit(None).cast("string"), spans)) == "5 TL"
    assert one(spark, tx.price_fallback(F.lit("7"), spans)) == "7"
    assert one(spark, tx.attr_or_text(F.lit(""), F.lit("x"))) == "x"
    assert one(spark, tx.first_last_item(F.array(F.lit("10 km")))) == ("10 km", "")
    assert one(spark, tx.first_last_item(F.array().cast("array<string>"))) == ("", "")


def test_format_estimate(spark):
    assert one(spark, tx.format_estimate(F.lit(1234567.4))) == "1,234,567 TL"


@pytest.mark.parametrize(
    "w, h, expected",
    [(480, 360, (240, 180)), (1000, 500, (240, 120)), (100, 300, (60, 180)), (24, 18, (240, 180))],
)
def test_fit_box(spark, w, h, expected):
    assert one(spark, px.fit_box(F.lit(w), F.lit(h))) == expected


def test_white_composite(spark):
    out = px.white_composite(
        F.array(F.lit(100), F.lit(100), F.lit(100)), F.array(F.lit(1.0), F.lit(0.0), F.lit(0.5)), 1
    )
    assert one(spark, out) == [100, 255, 177]


def test_normalize_pixels_by_channel_order(spark):
    given = F.array(*[F.lit(255)] * 3)
    rgb = one(spark, px.normalize_pixels(given))
    assert rgb == pytest.approx([(1 - 0.485) / 0.229, (1 - 0.456) / 0.224, (1 - 0.406) / 0.225])
    assert one(spark, px.normalize_pixels(given, "bgr")) == pytest.approx(rgb[::-1])


def doubles(*values):
    return F.array(*[F.lit(float(v)) for v in values])


def test_softmax(spark):
    assert one(spark, ar.softmax(doubles(0, 0), 0.1)) == [0.5, 0.5]
    assert sum(one(spark, ar.softmax(doubles(3, -2, 900)))) == pytest.approx(1.0)


def test_percentile_is_linear(spark):
    numpy = pytest.importorskip("numpy")
    values = [3.0, 1.0, 10.0, 2.0]
    for share in (0.85, 0.8, 0.75, 1.0):
        got = one(spark, ar.percentile_of(doubles(*values), F.lit(share)))
        assert got == pytest.approx(numpy.percentile(values, share * 100))


def test_mean_abs_channels(spark):
    maps = F.array(doubles(-1, 2), doubles(3, -4))
    assert one(spark, ar.mean_abs_channels(maps)) == [2.0, 3.0]


def test_saliency_keeps_the_top(spark):
    maps = spark.createDataFrame(
        [(1, "brand", [1.0, 2.0, 3.0, 10.0])], "image_id long, level string, values array<double>"
    )
    row = scores.saliency_threshold(maps).first()
    assert row.mask == [0, 0, 0, 1]
    assert row.damped == pytest.approx([0, 0, 0, 1])


def test_mean_and_variance_of_samples(spark):
    import math

    def logits(p):
        return [math.log(p), math.log(1 - p)]

    df = spark.createDataFrame(
        [(1, 0, "brand", "", logits(0.2)), (1, 1, "brand", "", logits(0.4))],
        "image_id long, sample int, level string, node string, logits array<double>",
    )
    row = scores.sample_mean_var(df).where("class_idx = 0").first()
    assert (row["mean"], row["variance"]) == (pytest.approx(0.3), pytest.approx(0.02))


@pytest.mark.parametrize("conf, unc, band", [(91, 4, "green"), (91, 5, "orange"), (75, 20, "red")])
def test_confidence_band(spark, conf, unc, band):
    assert one(spark, scores.confidence_band(F.lit(conf), F.lit(unc))) == band


def test_loss_without_confidence_is_brand_only(spark):
    df = spark.createDataFrame(
        [(1, "brand", "", [0.0, 0.0]), (1, "series", "0", [9.0, 0.0]), (1, "trim", "0/0", [1.0])],
        "image_id long, level string, node string, logits array<double>",
    )
    labels = spark.createDataFrame(
        [(1, 0, 0, 0)], "image_id long, brand_idx int, series_idx int, trim_idx int"
    )
    row = scores.hier_loss(df, labels, F.lit(0)).first()
    assert row.loss == pytest.approx(0.693147, abs=1e-6)


@pytest.mark.parametrize(
    "losses, best, stop",
    [([5, 4, 4, 6, 7, 8, 9], 2, 7), ([5, 4, 3], 3, None), ([1, 2, 2, 2, 2, 2, 0], 1, 6)],
)
def test_best_epoch(spark, losses, best, stop):
    df = spark.createDataFrame(
        [("r", i, float(x)) for i, x in enumerate(losses, 1)], "run string, epoch int, val_loss double"
    )
    row = training.best_epoch(df).first()
    assert (row.best_epoch, row.stop_epoch) == (best, stop)


def test_missing_tokens_become_null(spark):
    df = spark.createDataFrame([(t, 1) for t in [*NA_TOKENS, "x"]], "a string, b int")
    assert [r.a for r in normalize_na(df).collect() if r.a is not None] == ["x"]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="image_path"):
        require_columns(spark.createDataFrame([("a", "b", "c")], "marka string, seri string, model string"))


def test_series_repair(spark):
    df = spark.createDataFrame(
        [("3", "Serisi 320i"), ("3", "320 Serisi"), ("3", "320i")], "seri string, model string"
    )
    assert [tuple(r) for r in cleaning.repair_series(df).collect()] == [
        ("3 Serisi", "320i"), ("3 Serisi", "320 Serisi"), ("3", "320i"),
    ]


def test_brand_spelling(spark):
    df = spark.createDataFrame([("Mercedes - Benz",), ("Fiat",), (None,)], "marka string")
    assert [r.marka for r in cleaning.rename_brands(df).collect()] == ["Mercedes-Benz", "Fiat", None]


def test_bad_year_raises_or_is_null(spark):
    df = spark.createDataFrame([("2020",), ("x",)], "yil string")
    assert [r.yil for r in cleaning.cast_year(df, strict=False).collect()] == [2020, None]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cleaning.cast_year(df).collect()


def test_realistic_bounds_are_strict(spark):
    df = spark.createDataFrame(
        [(10000.0, 1.0, 1991), (10001.0, 1.0, 1991), (10001.0, 0.0, 1991), (10001.0, 1.0, 1990),
         (5000000.0, 1.0, 1991), (4999999.0, 500000.0, 1991)],
        "fiyat double, km double, yil int",
    )
    assert [tuple(r) for r in pricing.realistic_filter(df).collect()] == [(10001.0, 1.0, 1991)]


def test_page_count_fallbacks(spark):
    df = spark.createDataFrame(
        [(1, "total", "1.234 araç"), (2, "pager", " 77 "), (2, "button", "99"),
         (3, "button", "1"), (3, "button", "60"), (3, "button", "Sonraki"), (4, "total", "yok"),
         (5, "button", "1"), (5, "total", "30")],
        "site int, kind string, text string",
    )
    found = {r.site: (r.found, r.pages) for r in crawl.site_page_count(df).collect()}
    assert found == {1: (83, 83), 2: (77, 77), 3: (60, 60), 4: (50, 50), 5: (2, 50)}
