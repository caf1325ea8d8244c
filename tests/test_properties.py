"""Properties that hold for any data: stability, skew, brute-force agreement."""

import random

import pytest
from pyspark.sql import functions as F

from carlot.operators import cleaning, hierarchy, masks, pricing, scores
from carlot.operators.ordering import sorted_index
from carlot.schema import IDENTITY_COLUMNS, KEY_COLUMNS, LISTING_COLUMNS, PROCESSED_IMAGE_DIR
from carlot.session import stage
from carlot.sources import crawl, images
from carlot.sources.listings import normalize_na


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_dedupe_ignores_partitioning(spark, views):
    raw = views.listing_raw
    one, many = (cleaning.dedupe_listings(raw.repartition(n)) for n in (1, 8))
    assert rows_of(one) == rows_of(many)
    assert one.groupBy(*IDENTITY_COLUMNS).count().where("count > 1").isEmpty()


def test_dedupe_survives_a_huge_group_of_copies(spark, views):
    """A third of the rows are copies of one listing; they are combined before the shuffle."""
    raw = views.listing_raw.where("image_path is not null")
    n = raw.count()
    first = raw.orderBy(*KEY_COLUMNS).limit(1)
    copies = first.join(spark.range(n // 2)).withColumn("idx", F.col("idx") + F.col("id") + 1)
    df = raw.unionByName(copies.drop("id"))
    assert rows_of(cleaning.dedupe_listings(df)) == rows_of(cleaning.dedupe_listings(raw))


def test_min_samples_counts_at_each_step(spark):
    df = spark.createDataFrame(
        [("a", "x")] * 5 + [("a", "y")] * 2 + [("b", "x")] * 4 + [(None, "x")] * 9,
        "marka string, il_ilce string",
    )
    out = cleaning.min_samples(df, 5, ("marka", "il_ilce"))
    assert rows_of(out.groupBy("marka", "il_ilce").count()) == [("a", "x", 5)]


def test_cleaning_clean_rows_again_removes_nothing(spark, views):
    clean = stage(views.listing_clean)
    again = cleaning.clean_listings(
        clean.withColumn("yil", F.col("yil").cast("string")), views.image_files,
        views.failed_images, min_sample=1,
    )
    assert again.count() == clean.count() > 0


def test_skewed_brand_is_split_when_counts_are_too_large_to_broadcast(spark):
    """Without broadcast, one brand with most rows is cut into several join tasks."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, value in settings.items():
            spark.conf.set(k, value)
        df = spark.range(60000).select(
            F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(
                F.concat(F.lit("b"), (F.col("id") % 500).cast("string"))
            ).alias("marka"),
            F.md5(F.col("id").cast("string")).alias("baslik"),
        ).repartition(8)
        out = cleaning.min_samples(df, 5)
        assert len(out.collect()) == 60000
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, value in old.items():
            spark.conf.unset(k) if value is None else spark.conf.set(k, value)


def test_small_brand_set_is_broadcast_without_shuffling_rows(spark, views):
    plan = cleaning.min_samples(stage(views.listing_raw), 5)._jdf.queryExecution()
    text = plan.sparkPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


@pytest.mark.parametrize("chunks", [1, 3, 7])
def test_sorted_index_equals_brute_force(spark, chunks):
    rng = random.Random(chunks)
    names = [("hot" if rng.random() < 0.7 else rng.choice("abc"), f"n{rng.randrange(400)}")
             for _ in range(1500)]
    got = sorted_index(
        spark.createDataFrame(names, "brand string, series string"), ["brand"], "series", "i", chunks
    )
    expected = {
        (b, s, i)
        for b in {n[0] for n in names}
        for i, s in enumerate(sorted({s for bb, s in names if bb == b}))
    }
    assert {tuple(r) for r in got.collect()} == expected


def test_indices_are_dense(spark, views):
    index = hierarchy.class_index(views.listing_clean)
    for level, parents in (("series", ["brand"]), ("trim", ["brand", "series"])):
        spans = index[level].groupBy(*parents).agg(
            F.min(f"{level}_idx").alias("low"), F.max(f"{level}_idx").alias("high"),
            F.countDistinct(f"{level}_idx").alias("n"), F.count(F.lit(1)).alias("rows"),
        )
        assert spans.where("low <> 0 or high <> n - 1 or n <> rows").isEmpty()


@pytest.mark.parametrize("chunks", [1, 2, 5, 16])
def test_fetch_log_audit_equals_brute_force(spark, chunks):
    rng = random.Random(chunks)
    log = []
    for site, share in ((0, 0.5), (1, 0.2), (2, 1.0), (3, 0.9)):
        log += [(site, t // 2, t, rng.random() < share) for t in range(400 if site == 0 else 60)]
    rng.shuffle(log)
    df = spark.createDataFrame(log, "site int, t long, page long, ok boolean").select(
        "site", F.timestamp_seconds("t").alias("ts"), "page", "ok"
    )
    got = {
        r.site: (r.completed, r.failures, r.stopped)
        for r in crawl.fetch_log_audit(df, chunks=chunks)
        .withColumn("stopped", F.unix_seconds("stopped_at")).collect()
    }
    for site in range(4):
        run, stop, done, failed = 0, None, set(), 0
        for _, t, page, ok in sorted(r for r in log if r[0] == site):
            run = 0 if ok else run + 1
            failed += not ok
            if ok:
                done.add(page)
            if run == 3 and stop is None:
                stop = t
        assert got[site] == (len(done), failed, stop)


def test_split_is_stable_and_near_the_share(spark, views):
    key = F.concat_ws("|", *KEY_COLUMNS)
    train, test = pricing.split_80_20(views.listing_raw, key)
    again, _ = pricing.split_80_20(views.listing_raw.repartition(7), key)
    assert rows_of(train.select(*KEY_COLUMNS)) == rows_of(again.select(*KEY_COLUMNS))
    n, k = train.count(), test.count()
    assert n + k == views.listing_raw.count() and 0.77 < n / (n + k) < 0.83


def test_union_mask_equals_brute_force(spark):
    rng = random.Random(1)
    data = []
    for image, cells in ((1, 70), (2, 32), (3, 1), (4, 64)):
        for m in range(3):
            data.append((image, m, [2, 3, 1][m], [float(rng.random() < 0.3) for _ in range(cells)]))
    df = spark.createDataFrame(data, "image_id long, mask_id int, class_id int, mask array<double>")
    for row in masks.union_mask(df).collect():
        used = [d[3] for d in data if d[0] == row.image_id and d[2] != 1]
        assert row["mask"] == [int(any(c)) for c in zip(*used)]


def test_main_mask_prefers_the_first_of_equal_masks(spark):
    df = spark.createDataFrame(
        [(1, 0, 2, [1.0, 0.0]), (1, 1, 3, [0.0, 1.0]), (1, 2, 1, [1.0, 1.0]), (2, 0, 2, [0.0])],
        "image_id long, mask_id int, class_id int, mask array<double>",
    )
    assert [tuple(r) for r in masks.main_mask(df).collect()] == [(1, 0, 1.0)]


def test_softmax_rows_sum_to_one(spark, views):
    total = F.aggregate("probs", F.lit(0.0), lambda s, x: s + x)
    bad = scores.softmax_scores(views.scores).where(F.abs(total - 1) > 1e-9)
    assert bad.isEmpty()


def test_listing_columns_survive_the_chain(spark, views):
    assert views.listing_clean.columns == [*KEY_COLUMNS, *LISTING_COLUMNS]


def _shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_decoding_shuffles_scores_once(spark):
    from carlot.operators import scores

    rows = [(i, k, level, node, [0.1 * k, 0.2, 0.7 - 0.1 * k]) for i in range(5) for k in range(3)
            for level, node in (("brand", ""), ("series", "2"), ("trim", "2/2"))]
    table = spark.createDataFrame(rows, "image_id long, sample int, level string, node string, logits array<double>")
    assert _shuffles(scores.decode_top1(scores.head_moments(table))) == 1
    assert scores.decode_top1(scores.head_moments(table)).count() == 5


def test_true_heads_are_joined_by_three_keys(spark):
    from carlot.operators import scores

    table = spark.createDataFrame([(1, "brand", "", [1.0])], "image_id long, level string, node string, logits array<double>")
    labels = spark.createDataFrame([(1, 0, 0, 0)], "image_id long, brand_idx int, series_idx int, trim_idx int")
    plan = scores.hier_accuracy(table, labels)._jdf.queryExecution().optimizedPlan().toString()
    joined = [line for line in plan.splitlines() if "Join Inner" in line]
    assert len(joined) == 1 and all(joined[0].count(f"{k}#") == 2 for k in ("image_id", "level", "node"))


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_only_rows_with_copies_are_grouped(spark, tmp_path, monkeypatch, words):
    """Rows of a hash of their own pass by; a full bitmap changes nothing but the work."""
    monkeypatch.setattr(cleaning, "HASH_WORDS", words)
    kept = []
    monkeypatch.setattr(cleaning, "stage", lambda df, label="stage": kept.append((label, df)) or df)
    rows = [(0, i, 0, "a", str(i % 900) if i % 7 else None, f"p{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "site int, page long, idx long, marka string, seri string, image_path string")
    found = {tuple(r) for r in cleaning.dedupe_listings(df).collect()}
    first = {}
    for r in rows:
        first.setdefault(r[3:5], r)
    assert found == set(first.values())
    grouped = dict(kept)["copies"]
    assert grouped.count() < (200 if words > 1 else 1000)


def test_counts_per_brand_read_the_listings_once(spark):
    """Totals come from the counts per brand, not from the listings again."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "marka string, seri string")
    got = hierarchy.hierarchy_counts(df.mapInArrow(count, df.schema)).orderBy("brand").collect()
    assert [tuple(r) for r in got] == [("a", 2, 2, 3, 2), ("b", 1, 1, 3, 2)]
    assert seen.value == 3


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_rows_whose_image_is_sure_pass_without_a_shuffle(spark, monkeypatch, words):
    """Only rows in the bitmap are joined; a full one, nulls and repeats change no result."""
    monkeypatch.setattr(cleaning, "HASH_WORDS", words)
    parts, parted = [], cleaning._parted
    monkeypatch.setattr(cleaning, "_parted", lambda *a: parts.append(parted(*a)) or parts[-1])
    images = [f"d/p{i % 400}.jpg" if i % 9 else None for i in range(1000)]
    rows = [(0, i, 0, p) for i, p in enumerate(images)]
    df = stage(spark.createDataFrame(rows, "site int, page long, idx long, image_path string"))
    bad, there = ["p3.jpg", "p5.jpg", "p5.jpg", None], [f"p{i}.jpg" for i in range(0, 390)] * 2 + [None]
    failed, files = (spark.createDataFrame([(n,) for n in names], "basename string") for names in (bad, there))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        left = cleaning.drop_failed_images(df, failed)
        found = cleaning.keep_existing_images(df, files, df)
        assert rows_of(left) == sorted((r for r in rows if not r[3] or r[3][2:] not in bad), key=repr)
        assert rows_of(found) == sorted(
            ((*r[:3], f"{PROCESSED_IMAGE_DIR}/{r[3][2:]}") for r in rows if r[3] and r[3][2:] in there), key=repr
        )
        for joined, passed in parts:
            assert joined.count() + passed.count() == 1000
            assert joined.count() <= (150 if words > 1 else 1000)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clean_chain_agrees_with_its_steps(spark, views):
    """The chain, which joins only rows of missing names, and its steps one by one."""
    raw, files, failed = views.listing_raw, views.image_files, views.failed_images
    whole = cleaning.clean_listings(raw, files, failed)
    steps = cleaning.dedupe_listings(cleaning.drop_incomplete(normalize_na(raw)))
    steps = cleaning.drop_failed_images(cleaning.min_samples(steps), failed)
    steps = cleaning.keep_existing_images(cleaning.rename_brands(cleaning.repair_series(steps)), files)
    assert rows_of(whole.select(*KEY_COLUMNS, "image_path")) == rows_of(steps.select(*KEY_COLUMNS, "image_path"))
    names = rows_of(views.image_files.select("basename"))
    assert names == rows_of(raw.where("page % 17 <> 0 and image_path is not null").selectExpr(
        "substring_index(image_path, '/', -1) as basename").distinct())


def test_clean_chain_reads_hashes_and_missing_names_only(spark, views, monkeypatch):
    """Copies are found from staged hashes, and the chain's rows meet missing names, not all files."""
    kept = []
    whole = cleaning.stage
    monkeypatch.setattr(cleaning, "stage", lambda df, label="stage": kept.append((label, df)) or whole(df, label))
    files = stage(views.image_files, "files-of-test")
    clean = cleaning.clean_listings(views.listing_raw, files, views.failed_images)
    plan = clean._jdf.queryExecution().executedPlan().toString()
    assert "files-of-test" not in plan
    repeated = dict(kept)["repeated"]._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<_spot:bigint>" in repeated
    assert dict(kept)["missing"].count() < files.count() / 4


def test_names_without_a_partner_keep_nulls_and_repeats(spark):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "basename string, n int")
    right = spark.createDataFrame([("b",), ("b",), (None,)], "basename string")
    assert rows_of(images.drop_stale_outputs(left, right)) == [("a", 1), ("a", 2), (None, 4)]
    assert rows_of(images.drop_stale_outputs(left, left)) == [(None, 4)]
