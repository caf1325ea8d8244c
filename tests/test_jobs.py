"""Files, streams and models."""

from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from carlot.operators import boosting, combine, heads, pricing, training
from carlot.plans import fixtures, price_queries, source_queries
from carlot.plans.fixtures import render_pages
from carlot.plans.score_queries import _labelled
from carlot.schema import KEY_COLUMNS
from carlot.session import shared_dir
from carlot.sources import crawl, images, listings, pages
from carlot.streaming import ingest
from carlot.streaming.ingest import ingest_stream, read_latest, read_rejects, read_store


def test_csv_with_quotes_and_line_feeds(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "marka,seri,model,baslik,yil,km,fiyat,il_ilce,image_path\n"
        'Fiat,Egea,1.4,"two ""quoted""\nlines",2020,10 km,N/A,Ankara,\n'
    )
    row = listings.read_listings(spark, str(tmp_path)).transform(listings.normalize_na).first()
    assert row.baslik == 'two "quoted"\nlines'
    assert row.fiyat is None and row.image_path is None


@pytest.mark.parametrize("keep", [None, "1 day"])
def test_stream_loads_each_page_once(spark, views, tmp_path, keep):
    landing, store, state = (str(tmp_path / n) for n in ("landing", "store", "state"))
    made = render_pages(views.listing_raw)
    made.where("page % 2 = 0").write.mode("append").parquet(landing)
    for _ in range(2):
        ingest_stream(spark, landing, store, state, keep_keys_for=keep).awaitTermination()
    made.write.mode("append").parquet(landing)
    ingest_stream(spark, landing, store, state, keep_keys_for=keep).awaitTermination()
    loaded = read_store(spark, store)
    assert loaded.count() == pages.extract_listings(made).count() == views.listing_raw.count()
    assert loaded.groupBy(*KEY_COLUMNS).count().where("count > 1").isEmpty()


def test_html_text(spark):
    df = spark.createDataFrame(
        [("<p>a &amp; <b>b</b><br>c</p><!-- x > y --> d&nbsp;&lt;",)], "html string"
    )
    assert df.select(pages.html_text(F.col("html"))).first()[0] == "a & b\nc\nd <"


def test_a_short_row_is_rejected_and_the_page_goes_on(spark):
    def row(n):
        return '<tr><td><img src="u"></td>' + "".join(f"<td>c{i}</td>" for i in range(n)) + "</tr>"

    html = f'<table id="searchResultsTable">{row(9)}{row(8)}<tr></tr>{row(9)}</table>'
    df = spark.createDataFrame([(0, 1, html)], "site int, page long, html string")
    assert [(r.idx, r.il_ilce) for r in pages.extract_rows_cells9(df).collect()] == [
        (0, "c8"), (1, "c8"),
    ]
    assert [r.reject_reason for r in pages.extract_rows_cells9(df, rejects=True).collect()] == [
        "cell count"
    ]


def test_image_paths_stay_with_their_rows(spark):
    rows = spark.createDataFrame(
        [(0, 1, 0, "", None), (0, 1, 1, "u1", None), (0, 1, 2, "u2", None)],
        "site int, page long, idx long, img_url string, image_path string",
    )
    fetched = spark.createDataFrame(
        [(0, 1, 1, "d\\1.jpg"), (0, 1, 2, None)], "site int, page long, idx long, path string"
    )
    out = combine.attach_image_paths(rows, fetched).orderBy("idx").collect()
    assert [r.image_path for r in out] == [None, "d/1.jpg", None]


def test_unknown_category_is_all_zeros(spark):
    fit = spark.createDataFrame([("a", "s", "m"), ("b", "s", "n")], "marka string, seri string, model string")
    new = spark.createDataFrame([("z", "s", "n")], fit.schema)
    row = Pipeline(stages=pricing.one_hot_stages()).fit(fit).transform(new).select(
        *[vector_to_array(f"{c}_hot").alias(c) for c in pricing.CATEGORIES]
    ).first()
    assert (row.marka, row.seri, row.model) == ([0.0, 0.0], [1.0], [0.0, 1.0])


def test_indicators_are_read_without_an_array_of_all_categories(spark):
    hot = [Vectors.sparse(100000, [70000], [1.0]), Vectors.sparse(3, [], []), Vectors.dense([0.0, 0.0, 1.0])]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(hot)], ["id", "hot"])
    at, ones = price_queries._place_and_ones(F.col("hot"))
    out = df.select("id", at.alias("at"), ones.alias("ones"))
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(0, 70000, 1), (1, -1, 0), (2, 2, 1)]
    assert "UDF(" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def priced(spark):
    """Listings whose price depends on brand, year and mileage."""
    df = spark.range(3000).select(
        F.concat(F.lit("b"), (F.col("id") % 3).cast("string")).alias("marka"),
        F.concat(F.lit("s"), (F.col("id") % 5).cast("string")).alias("seri"),
        F.lit("m").alias("model"),
        (1995 + F.col("id") % 25).cast("int").alias("yil"),
        (1000.0 + (F.col("id") * 7919) % 300000).alias("km"),
    )
    return df.withColumn(
        "fiyat",
        200000.0 + (F.col("yil") - 1995) * 20000 - F.col("km") / 4
        + F.when(F.col("marka") == "b1", 150000).otherwise(0),
    )


def test_price_model_beats_the_mean_and_reloads(spark, priced, tmp_path):
    path = str(tmp_path / "model")
    key = F.concat_ws("|", "marka", "seri", F.col("km").cast("string"), "yil")
    model = pricing.train_price_model(priced, path, key, rounds=10, depth=4, rate=0.3)
    _, test = pricing.split_80_20(pricing.realistic_filter(priced), key)
    scored = pricing.score_prices(model, test)
    err = scored.agg(
        F.avg((F.col("estimate") - F.col("fiyat")) ** 2).alias("model"),
        F.var_pop("fiyat").alias("mean"),
    ).first()
    assert err.model < err.mean / 4
    again = pricing.score_prices(pricing.load_price_model(spark, path), test)
    assert sorted(r.estimate for r in scored.collect()) == sorted(r.estimate for r in again.collect())


@pytest.fixture
def small_fits(spark, priced, monkeypatch):
    """Views of the priced listings, the sizes that models are asked for, and where they are saved."""
    sizes, paths = [], []
    whole, place = pricing.boosted_price_model, price_queries.scratch_path

    def fitted(*size):
        sizes.append(size)
        return whole(5, 3, 0.3)

    def placed(session, label):
        paths.append(place(session, label))
        return paths[-1]

    monkeypatch.setattr(pricing, "boosted_price_model", fitted)
    monkeypatch.setattr(price_queries, "scratch_path", placed)
    key = F.col("id")
    clean = priced.withColumn("id", F.monotonically_increasing_id()).select(
        (key % 4).cast("int").alias("site"), key.alias("page"), key.alias("idx"), "*"
    )
    return SimpleNamespace(spark=spark, listing_clean=clean), sizes, paths


@pytest.mark.parametrize("reload", [False, True])
def test_price_queries_fit_the_model_of_the_library(small_fits, reload):
    views, sizes, _ = small_fits
    assert price_queries._estimates(views, reload).count() == pricing.realistic_filter(views.listing_clean).count()
    assert sizes == [(1000, 7, 0.05)]


def test_training_query_saves_the_whole_model(spark, small_fits):
    views, sizes, paths = small_fits
    held = price_queries._hold_out(views).first()
    assert sizes == [(1000, 7, 0.05)] and len(paths) == 1
    _, test = pricing.split_80_20(pricing.realistic_filter(views.listing_clean), price_queries._row_key())
    scored = pricing.score_prices(pricing.load_price_model(spark, paths[0]), test)
    rmse = scored.agg(F.sqrt(F.avg((F.col("estimate") - F.col("fiyat")) ** 2))).first()[0]
    assert held.n_rows == test.count() and held.rmse_model == pytest.approx(rmse)


def test_trees_do_not_depend_on_how_rows_are_dealt(spark, priced, monkeypatch):
    """One task, and several that add up their histograms, fit the same trees."""
    key = F.concat_ws("|", "marka", "seri", F.col("km").cast("string"), "yil")

    def estimates(rows, rounds):
        model = pricing.train_price_model(rows, None, key, rounds=rounds, depth=4, rate=0.3)
        return sorted((r.km, r.yil, r.estimate) for r in pricing.score_prices(model, priced).collect())

    long, short = estimates(priced, 8), estimates(priced, 1)
    monkeypatch.setattr(boosting, "SHARE", 700)
    monkeypatch.setattr(boosting, "STEP", 100)
    assert estimates(priced.repartition(7), 8) == long
    monkeypatch.setattr(boosting, "_mounted", lambda path: None)  # no folder that Python can write to
    assert estimates(priced.repartition(5), 1) == short


def _boosting(n=400, **law):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame({"a": rng.normal(size=n).round(1), "b": rng.integers(0, 4, n)})
    target = (frame["a"] * 10 + (frame["b"] == 2) * 7 + rng.normal(size=n)).to_numpy()
    columns = boosting.Columns([np.unique(frame["a"])[:-1]], [3])
    whole = {"rounds": 1, "depth": 1, "rate": 0.5, "rows": 1.0, "columns": 1.0, "seed": 1, **law}
    model = boosting.Boosting(columns, boosting.Law(**whole), target.mean(), 2.0**-30)
    return frame, target, list(model.run(columns.binned(frame), target, np.arange(n).astype(np.uint64)))


def test_first_split_is_the_best_of_all():
    frame, target, (nodes,) = _boosting()
    rest = target - target.mean()

    def gain(right):
        return sum(rest[p].sum() ** 2 / (p.sum() + 1) for p in (right, ~right)) - rest.sum() ** 2 / (len(rest) + 1)

    cuts = [(gain((frame["a"] > t).to_numpy()), 0, t) for t in np.unique(frame["a"])[:-1]]
    cuts += [(gain((frame["b"] == k).to_numpy()), 1 + k, 0.5) for k in range(3)]
    root = nodes.iloc[0]
    assert (root["gain"], root["feature"], root["threshold"]) == (pytest.approx(max(cuts)[0]), *max(cuts)[1:])
    right = (frame["a"] > root["threshold"]).to_numpy()
    assert nodes["value"][2] == pytest.approx(rest[right].sum() / (right.sum() + 1))
    assert nodes["rows"].tolist() == [400, (~right).sum(), right.sum()]


def test_every_node_holds_its_rows():
    """What the larger child has is its parent less the smaller child; a part of the rows is drawn."""
    frame, _, trees = _boosting(rounds=3, depth=4, rows=0.5)
    for nodes in trees:
        assert 150 < nodes["rows"][0] < 250
        for n in nodes[nodes["left"] >= 0].itertuples():
            assert n.rows == nodes["rows"][n.left] + nodes["rows"][n.right]
            assert n.total == pytest.approx(nodes["total"][n.left] + nodes["total"][n.right])
    assert len({n["rows"][0] for n in trees}) > 1


def test_heads_beat_the_majority_class(spark, views):
    rows = heads.node_rows(_labelled(views)).where("node = ''")
    trained = heads.train_node_heads(rows, 64, steps=20, rate=2.0)
    scored = _labelled(views).select(
        heads.head_logits(F.col("features"), F.lit(None).cast("array<array<double>>")).alias("n")
    )
    assert scored.where("n is not null").isEmpty()
    vectors = _labelled(views)
    guess = heads.score_node_heads(vectors, trained, F.lit(""), "brand").select(
        (F.array_position("logits", F.array_max("logits")) - 1 == F.col("brand_idx")).alias("ok")
    )
    right = guess.where("ok").count()
    majority = vectors.groupBy("brand_idx").count().agg(F.max("count")).first()[0]
    assert right > majority


def test_heads_match_plain_gradient_descent(spark, views):
    import numpy as np

    rows = heads.node_rows(_labelled(views)).where("node = ''")
    got = heads.train_node_heads(rows.repartition(5), 64, steps=3, rate=1.0).first().weights
    data = rows.select("label", "x").toPandas()
    x = np.hstack([np.stack(data.x.to_list()), np.ones((len(data), 1))])
    w = np.zeros((data.label.max() + 1, 65))
    for _ in range(3):
        z = x @ w.T
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(x)), data.label] -= 1
        w = w - (p.T @ x / len(x) + 1e-4 * w)
    assert np.allclose(np.array(got), w)


def test_beta_draws_are_stable_and_in_range(spark):
    batches = spark.range(40).withColumnRenamed("id", "batch")

    def draws(df):
        out = df.withColumn("lam", training.beta_lambda(F.col("batch")))
        return {r.batch: r.lam for r in out.collect()}

    first = draws(batches)
    assert first == draws(batches.repartition(7))
    assert all(0 <= x <= 1 for x in first.values()) and len(set(first.values())) > 20
    assert batches.select(training.beta_lambda(F.col("batch"), alpha=0)).first()[0] == 1.0


def test_mixup_pairs_rows_within_their_batch(spark, views):
    rows = views.labels3.join(views.embeddings.select("image_id", "v"), "image_id")
    mixed = training.mixup(rows, "image_id", "v", ["brand_idx"], batch_size=32)
    assert mixed.count() == rows.count()
    assert mixed.select("partner").distinct().count() == rows.count()
    assert mixed.where("int(partner / 32) <> int(image_id / 32)").isEmpty()


def test_image_listing_has_names_and_sizes(spark, tmp_path):
    (tmp_path / "a.jpg").write_bytes(b"xyz")
    (tmp_path / "b.png").write_bytes(b"x")
    assert [(r.basename, r.length) for r in images.list_images(spark, str(tmp_path)).collect()] == [
        ("a.jpg", 3)
    ]
    assert [r.readable for r in images.scan_images(spark, str(tmp_path)).collect()] == [False]


def test_shared_folder_is_stable_and_the_configured_one_wins(spark):
    assert shared_dir(spark) == shared_dir(spark)

    class Conf:
        def get(self, key, default=None):
            return "/somewhere/shared" if key == "spark.checkpoint.dir" else default

    class Session:
        conf, sparkContext = Conf(), spark.sparkContext

    assert shared_dir(Session()) == "/somewhere/shared"


def test_entities_are_read_once(spark):
    given = "&#304;zmir &ouml;zel &#xC7;ok &amp;lt; &bogus; &#55296; a&b&nbsp;&#160;x"
    df = spark.createDataFrame([(given,)], "html string")
    assert df.select(pages.html_text(F.col("html"))).first()[0] == (
        "İzmir özel Çok &lt; &bogus; &#55296; a&b  x"
    )


def _grid(slide="", title="Ford - Focus - 1.6", items="", price='<div class="text-xs"><span class="text-lg">5</span></div>'):
    return (
        '<main><section class="product horizontal"><div class="swiper-slide">' + slide
        + '<img data-src="lazy" class="image" src="u"></div><div class="advert">' + title + "</div>"
        + '<ul class="propertyGrid"><li><span class="propertyName" title="10 km">x</span></li>' + items
        + """<li><span class="propertyName" title="Kayseri'nin yani">x</span></li></ul>"""
        + '<small class="description">2020 Model</small>' + price + "</section></main>"
    )


def test_grid_sections_are_read_as_shown(spark):
    shown = [
        _grid(),
        _grid(items="<li>plain</li>"),
        _grid(slide='<div class="badge">Yeni</div>'),
        _grid(title="<div>Ford -</div><div>Focus - 1.6</div>"),
        _grid(price='<div class="text-xs">x</div><div class="text-xs"><span class="text-lg">5</span></div>'),
    ]
    df = spark.createDataFrame([(3, i, h) for i, h in enumerate(shown)], "site int, page long, html string")
    rows = pages.extract_rows_grid(df).collect()
    assert len(rows) == len(shown)
    for row in rows:
        assert (row.marka, row.seri, row.model, row.img_url) == ("Ford", "Focus", "1.6", "u")
        assert (row.km, row.il_ilce, row.fiyat, row.yil) == ("10", "Kayseri'nin yani", "5 TL", "2020")


def test_inner_tables_and_reject_positions(spark):
    def row(first):
        cells = "".join(f"<td>c{i}</td>" for i in range(8))
        return f'<tr><td><img src="u"></td><td>{first}</td>{cells}</tr>'

    inner = row("a<table><tr><td>b</td></tr></table>")
    html = f'<table id="searchResultsTable">{inner}{row("x")}{row("y")}</table><p>end</p>'
    df = spark.createDataFrame([(0, 1, html)], "site int, page long, html string")
    assert [r.marka for r in pages.extract_rows_cells9(df).orderBy("idx").collect()] == ["x", "y"]
    reject = pages.extract_rows_cells9(df, rejects=True).first()
    assert (reject.position, reject.reject_reason, reject.img_url) == (0, "cell count", "u")


def test_card_parts_with_the_same_tag_inside(spark):
    parts = [
        ("figure", "figure", '<img src="u">'), ("div", "title", "<strong>Ford</strong><span>Focus</span>"),
        ("div", "summary", "<div>1.6</div> TDCi"), ("p", "specs-summary", "2020, 5 km"),
        ("p", "price", "7"), ("p", "footer-title", "G, Ankara"),
    ]
    body = "".join(f'<{t} class="do-vehicle-card__{n}">{x}</{t}> &amp; ' for t, n, x in parts)
    html = f'<div class="do-vehicle-card__container">{body}</div>'
    df = spark.createDataFrame([(2, 1, html)], "site int, page long, html string")
    row = pages.extract_rows_card(df).first()
    assert (row.marka, row.seri, row.model, row.il_ilce) == ("Ford", "Focus", "1.6\nTDCi", "Ankara")


def test_stream_keeps_changed_pages(spark, views, tmp_path):
    landing, store, state = (str(tmp_path / n) for n in ("landing", "store", "state"))
    made = render_pages(views.listing_raw).where("page % 100 = 1")
    for title in ("Brand", "Other"):
        made.withColumn("html", F.replace("html", F.lit("Brand"), F.lit(title))).write.mode(
            "append"
        ).parquet(landing)
        ingest_stream(spark, landing, store, state, keep_keys_for="1 day").awaitTermination()
    loaded = read_store(spark, store)
    assert loaded.count() == 2 * pages.extract_listings(made).count()
    assert loaded.select("landed_at").distinct().count() == 2


def test_a_second_fetch_does_not_repeat_a_row(spark):
    rows = spark.createDataFrame([(0, 1, 0, None)], "site int, page long, idx long, image_path string")
    fetched = spark.createDataFrame(
        [(0, 1, 0, "d\\1.jpg"), (0, 1, 0, "d\\2.jpg")], "site int, page long, idx long, path string"
    )
    assert [r.image_path for r in combine.attach_image_paths(rows, fetched).collect()] == ["d/2.jpg"]


def test_offsets_follow_the_page_count(spark):
    sites = spark.createDataFrame(
        [(1, "offset", 400, "u")], "site int, kind string, pages long, base_url string"
    )
    done = spark.createDataFrame([], "site int, page long")
    assert crawl.crawl_frontier(sites, done).count() == 400
    assert crawl.crawl_frontier(sites, done, max_offset=950).count() == 20


def _lands(spark, landing, pages_):
    spark.createDataFrame(pages_, "site int, page long, html string").coalesce(1).write.mode("append").parquet(landing)


def _row_page(*titles):
    """A table page of site 0; a title of None makes a row one cell short."""
    cell = "".join(f"<td>{x}</td>" for x in ("Marka", "Seri", "Model", "{}", "2020", "5", "7 TL", "d", "Ankara"))
    rows = "".join(f'<tr><td><img src="u"></td>{cell.format(t) if t else "<td>x</td>"}</tr>' for t in titles)
    return f'<table id="searchResultsTable">{rows}</table>'


def test_a_page_that_changes_back_is_a_third_version(spark, tmp_path):
    landing, store, state = (str(tmp_path / n) for n in ("landing", "store", "state"))
    a, b = _row_page("first"), _row_page("second", "third")
    for html in (a, b, a):
        _lands(spark, landing, [(0, 1, html), (0, 2, a)])
        ingest_stream(spark, landing, store, state, full_every=2).awaitTermination()
    stored = read_store(spark, store)
    assert sorted((r.page, r.version, r.idx, r.baslik) for r in stored.collect()) == [
        (1, 1, 0, "first"), (1, 2, 0, "second"), (1, 2, 1, "third"), (1, 3, 0, "first"), (2, 1, 0, "first"),
    ]
    assert sorted((r.page, r.version) for r in read_latest(spark, store).collect()) == [(1, 3), (2, 1)]


def test_versions_within_one_batch(spark, tmp_path):
    landing, store, state = (str(tmp_path / n) for n in ("landing", "store", "state"))
    a, b = _row_page("first"), _row_page("second")
    _lands(spark, landing, [(0, 1, a), (0, 1, a), (0, 1, b), (0, 1, b), (0, 1, a), (0, 3, None)])
    ingest_stream(spark, landing, store, state).awaitTermination()
    found = sorted((r.version, r.baslik) for r in read_store(spark, store).collect())
    assert found == [(1, "first"), (2, "second"), (3, "first")]


def test_a_batch_that_runs_again_stores_nothing_twice(spark, tmp_path):
    landing, store, state = (str(tmp_path / n) for n in ("landing", "store", "state"))
    _lands(spark, landing, [(0, 1, _row_page("a", None, "b")), (0, 2, _row_page("c"))])
    ingest_stream(spark, landing, store, state).awaitTermination()
    want = sorted(map(str, read_store(spark, store).drop("landed_at").collect()))
    again = spark.read.parquet(landing).withColumn("landed_at", F.current_timestamp()).withColumn(
        "place", F.struct(F.lit(None).cast("timestamp"), F.lit("f"), F.monotonically_increasing_id().alias("row"))
    )
    ingest._load_batch(store, None, 50)(again, 0)
    assert sorted(map(str, read_store(spark, store).drop("landed_at").collect())) == want
    ingest._load_batch(store, None, 50)(again, 1)  # the same landings as a batch of their own: no news
    assert read_store(spark, store).count() == len(want)
    rejects = read_rejects(spark, store).collect()
    assert [(r.page, r.position, r.reject_reason, r.version) for r in rejects] == [(1, 1, "cell count", 1)]


def test_a_batch_cut_short_is_not_read(spark, tmp_path):
    landing, store, state = (str(tmp_path / n) for n in ("landing", "store", "state"))
    _lands(spark, landing, [(0, 1, _row_page("a"))])
    ingest_stream(spark, landing, store, state).awaitTermination()
    read_store(spark, store).withColumn("site", F.lit(0)).drop("batch").write.parquet(f"{store}/listings/batch=1")
    assert read_store(spark, store).count() == 1


def test_store_and_checkpoint_belong_together(spark, tmp_path):
    landing, store, state, other = (str(tmp_path / n) for n in ("landing", "store", "state", "other"))
    _lands(spark, landing, [(0, 1, _row_page("a"))])
    ingest_stream(spark, landing, store, state).awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        ingest_stream(spark, landing, store, other)


def test_csv_columns_are_found_by_name(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    one.mkdir(), two.mkdir()
    (one / "a.csv").write_text('model,more,marka,seri\n1.4,x,Fiat,Egea\n1.6,Ford\n2.0,x,VW,Golf,5\n"a\nb",x,Kia,Rio\n')
    (two / "a.csv").write_text("marka,seri,model\nBMW,3,320i\n")
    schema = "marka string, seri string, model string"
    both = [str(one), str(two)]
    rows = sorted(map(tuple, listings.read_listings(spark, both, schema).collect()))
    assert rows == [("BMW", "3", "320i"), ("Fiat", "Egea", "1.4"), ("Kia", "Rio", "a\nb")]
    bad = listings.read_listings(spark, both, schema, rejects=True).collect()
    assert sorted(r.record for r in bad) == ["1.6,Ford", "2.0,x,VW,Golf,5"]
    assert all(r.file.endswith("one/a.csv") for r in bad)
    assert listings.read_listings(spark, both, "seri string").count() == 3


def test_csv_without_a_column_raises(spark, tmp_path):
    (tmp_path / "a.csv").write_text("marka,model\nFiat,1.4\n")
    with pytest.raises(ValueError, match="missing columns: seri"):
        listings.read_listings(spark, str(tmp_path), "marka string, seri string, model string")


def test_csv_of_two_headers_in_one_folder_stops(spark, tmp_path):
    (tmp_path / "a.csv").write_text("marka,model\nFiat,1.4\n")
    (tmp_path / "b.csv").write_text("model,marka\n1.4,Fiat\n")
    with pytest.raises(Exception, match="(?i)header|FAILED_READ_FILE"):
        listings.read_listings(spark, str(tmp_path), "marka string, model string").collect()


def test_csv_files_have_bounded_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(listings, "RECORDS_PER_FILE", 10)
    path = str(tmp_path / "out")
    listings.write_processed(spark.range(95).selectExpr("string(id) as a", "'x\n\"y' as b").coalesce(1), path)
    read = listings.read_listings(spark, path, "a string, b string")
    assert len(list((tmp_path / "out").glob("*.csv.gz"))) == 10
    assert read.count() == 95 and {r.b for r in read.collect()} == {'x\n"y'}


def test_line_items_come_in_slices_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(fixtures, "SLICE", 10_000)
    views = fixtures.Views(spark, "/root/testdata/sf0.001")
    size = sum(f.stat().st_size for f in [Path("/root/testdata/sf0.001/lineitem.parquet")])
    assert views.lineitem.rdd.getNumPartitions() == -(-size // 10_000) > 8


def test_line_items_of_a_busy_part_come_in_slices(spark, tmp_path, monkeypatch):
    """A third of the line items name one part, others one that is missing, none or a rare one."""
    part = "case when id % 3 = 0 then 1 when id % 7 = 0 then -5 when id % 50 <> 1 then id % 3000 end"
    made = {
        "lineitem": spark.range(6000).selectExpr(
            "id as l_orderkey", f"{part} as l_partkey", "id % 40 as l_suppkey", "int(id % 7) as l_linenumber",
            "double(id % 50) as l_quantity", "double(id * 20) as l_extendedprice",
        ),
        "part": spark.range(3001).selectExpr(
            "if(id = 3000, 1, id) as p_partkey", "sha2(string(id), 256) as p_name", "'Brand#7' as p_brand",
            "sha2(string(-id), 256) as p_type", "int(id % 50) as p_size",
        ),
        "supplier": spark.range(40).selectExpr("id as s_suppkey", "string(id) as s_name", "int(id % 5) as s_nationkey"),
        "nation": spark.range(5).selectExpr("int(id) as n_nationkey", "string(id) as n_name"),
    }
    for name, rows in made.items():
        rows.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    expected = sorted(map(str, fixtures.Views(spark, str(tmp_path)).listing_raw.collect()))
    monkeypatch.setattr(fixtures, "BUSY", 100, raising=False)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        found = fixtures.Views(spark, str(tmp_path)).listing_raw
        assert sorted(map(str, found.collect())) == expected
        most = found.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert most < len(expected) / 4


def test_rejects_parse_a_page_once(spark):
    made = spark.createDataFrame([], "site int, page long, html string")
    plan = pages.extract_listings(made, rejects=True)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan and plan.count("do-vehicle-card__container") == 2


def test_elements_end_at_their_own_closing_tag(spark):
    cases = {
        "<p>a</p>b": "<p>a</p>",
        "<P class='x'>a<b>c</b></p >d": "<P class='x'>a<b>c</b></p >",
        "<p>a<p>b</p>c</p>d": "<p>a<p>b</p>c</p>",
        "<p t='</p>'>a</p>": "<p t='</p>",
        "<p>a</px></p>b": "<p>a</px></p>",
        "<p>a": "<p>a",
    }
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    assert {r.c: r.x for r in df.select("c", pages._closed(F.col("c"), F.lit("p")).alias("x")).collect()} == cases


def test_text_of_one_element(spark):
    cases = {
        "<p> a  b </p>": "a b", "<p>a&nbsp;</p>": "a", "<br>a</p>": "a", "<p>a<br>b</p>": "a\nb",
        "<p></p>": "", "<p>a</p>b": "a\nb", "<b>a</b>b": "ab", "<!-- x -->a</p>": "a",
    }
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    assert {r.c: r.x for r in df.select("c", pages.html_text(F.col("c")).alias("x")).collect()} == cases


def test_landed_pages_are_rendered_once(spark):
    """Each lot is read from one written copy; pages made anew would not be the same ones."""
    table = '<table id="searchResultsTable"><tbody><tr></tr><tr><td> x</td></tr></tbody></table>'
    made = spark.range(8).selectExpr(
        "0 as site", "id as page",
        f"concat('{table}', '<!--', reflect('java.util.UUID', 'randomUUID'), '-->') as html",
    )
    found = source_queries._ingest_rejects(SimpleNamespace(spark=spark, rendered_pages=made))
    assert [tuple(r) for r in found.collect()] == [(0, "cell count", 8, 1)]


@pytest.mark.parametrize("query", ["_ingest_versions", "_ingest_rejects"])
def test_ingest_keeps_its_pages_once(spark, query):
    """Beside what lands there is no other copy of the pages, and parsed rows go with their batch."""
    table = '<table id="searchResultsTable"><tbody><tr></tr><tr><td> x</td></tr></tbody></table>'
    made = spark.range(8).selectExpr("0 as site", "id as page", f"concat('{table}', id) as html")
    shared = Path(shared_dir(spark).removeprefix("file:"))
    before = set(shared.iterdir())
    getattr(source_queries, query)(SimpleNamespace(spark=spark, rendered_pages=made)).collect()
    new = {p.name.rpartition("-")[0]: p for p in set(shared.iterdir()) - before}
    assert set(new) == {"landing", "store", "stream-state"}
    files = [*new["landing"].glob("*.parquet"), *new["store"].glob("rejects/*/*/*.parquet")]
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files if pq.ParquetFile(f).num_row_groups}
    assert codecs == {"ZSTD"}
