"""The cleaning chain: every step is a DataFrame-to-DataFrame function.

Whole listing rows are shuffled only where they may have copies or may lose their
image; bitmaps of bounded size tell which.  Key sets are never hinted for broadcast.
The set of common brands is staged, so the planner sees its size and broadcasts it only
when small; image names join by shuffle or, once adaptive execution has measured them
as small, by broadcast.  Skewed join partitions (one brand, one placeholder image) are
split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from carlot.functions import text as tx
from carlot.schema import KEY_COLUMNS, MIN_BRAND_ROWS, PROCESSED_IMAGE_DIR
from carlot.session import stage
from carlot.sources.images import drop_stale_outputs, without_names
from carlot.sources.listings import normalize_na


#: Words of the bitmap of repeated hashes: 64 million places, 16 MB.
HASH_WORDS = 1 << 20


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Rows without a null in any column."""
    return df.na.drop("any")


def _identity(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("image_path", "_spot", *KEY_COLUMNS)]


def _stage_spots(df: DataFrame) -> DataFrame:
    """Staged rows with the hash of their listing, which later passes read instead of the texts."""
    return stage(df.withColumn("_spot", F.xxhash64(*_identity(df))), "rows")


def _marked(df: DataFrame, spot: Column) -> DataFrame:
    """Rows with the place of a hash in a table of 64-bit words."""
    return df.withColumns(
        {
            "_word": F.shiftrightunsigned(spot, 6).bitwiseAND(F.lit(HASH_WORDS - 1)),
            "_bit": spot.bitwiseAND(F.lit(63)).cast("int"),
        }
    )


def _bitmap(marked: DataFrame, label: str) -> DataFrame:
    """The places of marked rows, at most ``HASH_WORDS`` rows whatever their number."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit"))
    return stage(marked.groupBy("_word").agg(F.bit_or(bit).alias("_bits")), label)


def _parted(df: DataFrame, spot: Column, bitmap: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose place is in the bitmap, and the others; neither is shuffled."""
    tagged = _marked(df, spot).join(F.broadcast(bitmap), "_word", "left")
    inside = F.coalesce(F.getbit("_bits", F.col("_bit")) == 1, F.lit(False))
    return tagged.where(inside).select(*df.columns), tagged.where(~inside).select(*df.columns)


def _group_copies(rows: DataFrame) -> DataFrame:
    """One row per distinct listing, with its first copy and the number of copies.

    ``rows`` come from ``_stage_spots``.  Hashes alone are read and counted for all rows.  A row whose hash occurs once has no copy and is
    passed on without a shuffle; only rows that share a place with a repeated hash are
    grouped, by their whole content.  Those places are a bitmap of at most ``HASH_WORDS``
    rows, whatever the table's size.  Copies are combined before either shuffle, so a group
    that holds a large share of the table arrives as one row per map task.
    """
    identity = _identity(rows)
    first = F.struct(*[c for c in KEY_COLUMNS if c in rows.columns], "image_path")
    repeated = rows.groupBy("_spot").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    bitmap = _bitmap(_marked(repeated, F.col("_spot")), "repeated")
    shared, others = _parted(rows, F.col("_spot"), bitmap)
    copies = shared.groupBy(*identity).agg(
        F.min(first).alias("_first"), F.count(F.lit(1)).alias("copies")
    )
    lone = others.select(
        *identity, first.alias("_first"), F.lit(1).cast("long").alias("copies")
    )
    return lone.unionByName(stage(copies, "copies"))


def _first_copy(groups: DataFrame, columns: list[str]) -> DataFrame:
    inside = set(groups.schema["_first"].dataType.names)
    return groups.select(
        *[F.col(f"_first.{c}").alias(c) if c in inside else F.col(c) for c in columns]
    )


def dedupe_listings(df: DataFrame) -> DataFrame:
    """Rows equal in everything but the image path (and our keys) become one.

    The copy with the smallest ``site, page, idx`` stays, whatever the
    partitioning.
    """
    return _first_copy(_group_copies(_stage_spots(df)), df.columns)


def key_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def min_samples(
    df: DataFrame, min_sample: int = MIN_BRAND_ROWS, keys: tuple[str, ...] = ("marka",)
) -> DataFrame:
    """Rows whose key occurs often enough; keys in turn, counted anew each time.

    The counts are taken right away, in a pass over the key column alone.
    """
    for key in keys:
        common = key_counts(df, key).where(F.col("n_rows") >= min_sample).select(key)
        df = df.join(stage(common, f"common-{key}"), key, "left_semi").select(*df.columns)
    return df


def drop_failed_images(df: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Rows whose image is not among the failed ones (``basename``).

    Most rows are not in the bitmap of failed names and pass without a shuffle; the others
    are joined by name.  The bitmap is written when this is called.
    """
    if failed is None:
        return df
    names = failed.select("basename")
    named = df.withColumn("basename", tx.basename(F.col("image_path")))
    spot = F.xxhash64("basename")
    maybe, passed = _parted(named, spot, _bitmap(_marked(names, spot), "failed-names"))
    kept = maybe.join(names, "basename", "left_anti")
    return passed.select(*df.columns).unionByName(kept.select(*df.columns))


def repair_series(df: DataFrame) -> DataFrame:
    """Move the series word from the trim to the series column."""
    word = F.col("model").contains("Serisi")
    return df.withColumns(
        {
            "seri": F.when(word, F.concat("seri", F.lit(" Serisi"))).otherwise(F.col("seri")),
            "model": F.when(word, F.replace("model", F.lit("Serisi "), F.lit(""))).otherwise(
                F.col("model")
            ),
        }
    )


def _is_renamed(marka: Column) -> Column:
    return F.coalesce(marka.contains("Mercedes"), F.lit(False))


def rename_brands(df: DataFrame) -> DataFrame:
    """One spelling for a brand that two sites write differently."""
    return df.withColumn(
        "marka",
        F.when(_is_renamed(F.col("marka")), F.lit("Mercedes-Benz")).otherwise(F.col("marka")),
    )


def keep_existing_images(
    df: DataFrame, files: DataFrame, named: DataFrame | None = None
) -> DataFrame:
    """Point rows at the processed image folder and keep those whose file exists.

    ``named`` is a table whose ``image_path`` holds every one of ``df``, and which is cheaper
    to read.  Its names without a file are then found first, in a shuffle of names alone, and
    written when this is called.  Only rows in the bitmap of those are shuffled whole, and
    joined with the missing names, not with all.
    """
    names = files.select("basename")
    rows = df.withColumn("basename", tx.basename(F.col("image_path")))
    if named is None:
        kept = rows.join(names, "basename", "left_semi")
    else:
        spot = F.xxhash64("basename")
        wanted = named.select(tx.basename(F.col("image_path")).alias("basename"))
        missing = stage(without_names(wanted, names).distinct(), "missing")
        maybe, passed = _parted(rows, spot, _bitmap(_marked(missing, spot), "missing-names"))
        there = maybe.where("basename is not null").join(missing, "basename", "left_anti")
        kept = passed.unionByName(there.select(*passed.columns))
    return kept.withColumn(
        "image_path", F.concat(F.lit(f"{PROCESSED_IMAGE_DIR}/"), F.col("basename"))
    ).select(*df.columns)


def clean_km(df: DataFrame) -> DataFrame:
    return df.withColumn("km", tx.clean_km(F.col("km")))


def clean_price(df: DataFrame) -> DataFrame:
    return df.withColumn("fiyat", tx.clean_price(F.col("fiyat")))


def cast_year(df: DataFrame, strict: bool = True) -> DataFrame:
    """``yil`` as int.  Bad text is an error, or null when not ``strict``."""
    year = tx.strip(F.col("yil"))
    return df.withColumn("yil", year.cast("int") if strict else year.try_cast("int"))


def title_case(df: DataFrame) -> DataFrame:
    return df.withColumns({c: tx.title_case(F.col(c)) for c in ("marka", "model", "seri")})


def clean_listings(
    raw: DataFrame,
    files: DataFrame,
    failed: DataFrame | None = None,
    min_sample: int = MIN_BRAND_ROWS,
    strict: bool = True,
    recheck: bool = False,
) -> DataFrame:
    """The whole chain.  ``km`` and ``fiyat`` stay digit texts, as written to file.

    Brands are counted under their raw spelling, before images drop rows;
    ``recheck`` counts once more at the end.  The complete rows are written to the shared
    folder, and copies and missing images are looked for when this is called; the steps
    after that stay lazy.
    """
    rows = _stage_spots(raw.transform(normalize_na).transform(drop_incomplete))
    unique = _first_copy(_group_copies(rows), raw.columns)
    # A failed image has no finished file, so both image steps are one join here.
    finished = files if failed is None else drop_stale_outputs(files, failed)
    out = (
        unique.transform(min_samples, min_sample)
        .transform(repair_series)
        .transform(rename_brands)
        .transform(keep_existing_images, finished, rows)
        .transform(clean_km)
        .transform(clean_price)
        .transform(cast_year, strict)
        .transform(title_case)
    )
    return out.transform(min_samples, min_sample) if recheck else out


def cleaning_audit(
    raw: DataFrame,
    files: DataFrame,
    failed: DataFrame,
    min_sample: int = MIN_BRAND_ROWS,
) -> DataFrame:
    """Rows removed (or renamed) by each step, and rows left after it.

    The distinct listings are found once; they are then tagged with the step that
    removes them and counted, where a filter per step would repeat the work.
    """
    rows = normalize_na(raw)
    complete = F.lit(True)
    for c in rows.columns:
        complete = complete & F.col(c).isNotNull()
    groups = stage(
        _group_copies(_stage_spots(rows.where(complete))).select(
            "marka", "copies", tx.basename(F.col("_first.image_path")).alias("basename")
        ),
        "groups",
    )
    brands = stage(key_counts(groups, "marka").withColumnRenamed("n_rows", "brand_rows"), "brands")
    tagged = (
        groups.join(brands, "marka")
        .join(failed.select("basename").distinct().withColumn("_failed", F.lit(True)),
              "basename", "left")
        .join(files.select("basename").distinct().withColumn("_file", F.lit(True)),
              "basename", "left")
    )
    rare = F.col("brand_rows") < min_sample
    failing = ~rare & F.col("_failed").isNotNull()
    renamed = ~rare & F.col("_failed").isNull() & _is_renamed(F.col("marka"))
    missing = ~rare & F.col("_failed").isNull() & F.col("_file").isNull()

    def number(c: Column) -> Column:
        return F.coalesce(F.sum(c.cast("long")), F.lit(0))

    sums = tagged.agg(
        number(F.col("copies")).alias("complete"),
        number(F.col("copies") - 1).alias("duplicates"),
        number(rare).alias("rare"),
        number(failing).alias("failed"),
        number(renamed).alias("renamed"),
        number(missing).alias("missing"),
    )
    totals = sums.withColumn("total", rows.agg(F.count(F.lit(1))).scalar())
    steps = [
        ("drop_incomplete", F.col("total") - F.col("complete"), 1),
        ("dedupe_listings", F.col("duplicates"), 1),
        ("min_samples", F.col("rare"), 1),
        ("drop_failed_images", F.col("failed"), 1),
        ("rename_brands", F.col("renamed"), 0),
        ("keep_existing_images", F.col("missing"), 1),
    ]
    left, entries = F.col("total"), []
    for place, (step, changed, removes) in enumerate(steps, start=1):
        left = left - changed * removes
        entries.append(
            F.struct(
                F.lit(place).alias("step_no"),
                F.lit(step).alias("step"),
                changed.alias("rows_changed"),
                left.alias("rows_left"),
            )
        )
    return totals.select(F.inline(F.array(*entries)))


def failed_images(images: DataFrame, winners: DataFrame) -> DataFrame:
    """Basenames that could not be read, or in which no vehicle was found.

    ``images`` has ``image_id, basename, readable``; ``winners`` has the
    ``image_id`` of every image with a main mask.
    """
    without = images.where("readable").join(winners.select("image_id"), "image_id", "left_anti")
    return (
        images.where("not readable").select("basename")
        .unionByName(without.select("basename"))
        .distinct()
    )
