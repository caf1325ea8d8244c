"""Score tables of a hierarchical classifier: sampling, decoding, accuracy, loss.

Scores are rows ``image_id, sample, level, node, logits``: one array per head.
``node`` is the parent of the head's classes, as index text: '' for the brand
head, ``b`` for the series of brand b, ``b/s`` for the trims of series s.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from carlot.functions import arrays as ar
from carlot.schema import (
    BATCH_SIZE,
    CONFIDENCE_GATE,
    DECODE_TEMPERATURE,
    LABEL_SMOOTHING,
    LEVEL_WEIGHTS,
    SALIENCY_RULES,
)


def series_node(brand: Column) -> Column:
    return brand.cast("string")


def trim_node(brand: Column, series: Column) -> Column:
    return F.concat_ws("/", brand.cast("string"), series.cast("string"))


def softmax_scores(scores: DataFrame, temperature: float = 1.0) -> DataFrame:
    """Add ``probs``, the softmax of every head's logits."""
    return scores.withColumn("probs", ar.softmax(F.col("logits"), temperature))


def head_moments(scores: DataFrame) -> DataFrame:
    """``means`` and ``variances`` over repeated predictions, one entry per class of a head.

    Rows are dealt by image, which serves all later grouping by head or image: this is
    the only shuffle up to the decoded path.  A group has as many rows as there are samples
    of one head.  One sample has no variance.
    """
    runs, n = F.col("runs"), F.size("runs")
    zeros = F.transform(F.get("runs", F.lit(0)), lambda x: F.lit(0.0))
    total = F.aggregate(runs, zeros, lambda acc, run: F.zip_with(acc, run, lambda s, x: s + x))
    apart = F.aggregate(
        runs, zeros,
        lambda acc, run: F.zip_with(
            acc, F.zip_with(run, "means", lambda x, m: (x - m) * (x - m)), lambda s, x: s + x
        ),
    )
    return (
        softmax_scores(scores.repartition("image_id"))
        .groupBy("image_id", "level", "node")
        .agg(F.collect_list("probs").alias("runs"))
        .withColumn("means", F.transform(total, lambda s: s / n))
        .withColumn("variances", F.transform(apart, lambda s: F.when(n > 1, s / (n - 1))))
        .drop("runs")
    )


def sample_mean_var(scores: DataFrame) -> DataFrame:
    """Mean and sample variance over repeated predictions, per image, head and class."""
    both = F.arrays_zip(F.col("means").alias("mean"), F.col("variances").alias("variance"))
    return head_moments(scores).select(
        "image_id", "level", "node", F.posexplode(both).alias("class_idx", "x")
    ).select("image_id", "level", "node", "class_idx", "x.mean", "x.variance")


def head_summary(heads: DataFrame) -> DataFrame:
    """Best class of every head of ``head_moments`` with confidence and uncertainty in percent.

    Confidence is the softmax of the means at a low temperature, uncertainty the
    deviation of the chosen class.  A head with one class is marked as an error.
    """
    best = F.col("class_idx")
    return heads.withColumn("class_idx", ar.first_argmax(F.col("means"))).select(
        "image_id",
        "level",
        "node",
        "class_idx",
        (F.get(ar.softmax(F.col("means"), DECODE_TEMPERATURE), best) * 100).alias("confidence"),
        (F.sqrt(F.get("variances", best)) * 100).alias("uncertainty"),
        F.when(F.size("means") == 1, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
    )


def decode_top1(heads: DataFrame) -> DataFrame:
    """The best brand, the best series under it, the best trim under that pair.

    ``heads`` is ``head_moments``.  The heads of an image are gathered into a map by node and looked up along
    the predicted path; a map has one entry per head of the model.
    """
    parts = ["class_idx", "confidence", "uncertainty", "status"]
    by_node = (
        head_summary(heads)
        .groupBy("image_id")
        .agg(
            F.map_from_entries(
                F.collect_list(
                    F.struct(F.concat_ws(":", "level", "node"), F.struct(*parts))
                )
            ).alias("heads")
        )
    )

    def head(level: str, node: Column) -> Column:
        return F.try_element_at(F.col("heads"), F.concat(F.lit(f"{level}:"), node))

    placed = (
        by_node.withColumn("b", head("brand", F.lit("")))
        .withColumn("s", head("series", series_node(F.col("b.class_idx"))))
        .withColumn("t", head("trim", trim_node(F.col("b.class_idx"), F.col("s.class_idx"))))
    )
    return placed.select(
        "image_id",
        *[
            F.col(f"{short}.{part}").alias(
                f"{level}_idx" if part == "class_idx" else f"{level}_{part}"
            )
            for short, level in (("b", "brand"), ("s", "series"), ("t", "trim"))
            for part in parts
        ],
    )


def confidence_band(confidence: Column, uncertainty: Column) -> Column:
    return (
        F.when((confidence > 90) & (uncertainty < 5), F.lit("green"))
        .when((confidence > 70) & (uncertainty < 15), F.lit("orange"))
        .otherwise(F.lit("red"))
    )


def single_class_status(decoded: DataFrame) -> DataFrame:
    """Image status: an error as soon as a head on the decoded path has one class."""
    broken = F.lit(False)
    for level in LEVEL_WEIGHTS:
        broken = broken | (F.coalesce(F.col(f"{level}_status"), F.lit("error")) == "error")
    return decoded.withColumn(
        "status", F.when(broken, F.lit("error")).otherwise(F.lit("ok"))
    )


def _on_true_path(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """Heads that judge each image: the brand head and the heads of its true parents.

    Labels become rows of the three heads they stand for, so scores of all other heads
    find no partner and are not carried further.
    """
    brand, series, trim = (F.col(f"{level}_idx") for level in LEVEL_WEIGHTS)
    nodes = (F.lit(""), series_node(brand), trim_node(brand, series))
    heads = F.array(
        *[
            F.struct(F.lit(level).alias("level"), node.alias("node"), label.cast("int").alias("label"))
            for level, node, label in zip(LEVEL_WEIGHTS, nodes, (brand, series, trim))
        ]
    )
    return scores.join(labels.select("*", F.inline(heads)), ["image_id", "level", "node"])


def hier_accuracy(scores: DataFrame, labels: DataFrame) -> DataFrame:
    """Right predictions per level, series and trim inside the true parent's head."""
    judged = _on_true_path(scores, labels)
    right = (ar.first_argmax(F.col("logits")) == F.col("label")).cast("long")
    return (
        judged.groupBy("level")
        .agg(F.sum(right).alias("correct"), F.count(F.lit(1)).alias("total"))
        .withColumn("accuracy", F.col("correct") / F.col("total"))
    )


def _level_values(judged: DataFrame, value: Column, keys: list[str]) -> DataFrame:
    """One row per image with the value of each level."""
    return judged.withColumn("_value", value).groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("level") == level, F.col("_value"))).alias(f"{level}_ce")
            for level in LEVEL_WEIGHTS
        ],
        *[
            F.max(
                F.when(F.col("level") == level, F.array_max(ar.softmax(F.col("logits"))))
            ).alias(f"{level}_top")
            for level in ("brand", "series")
        ],
    )


def _weighted(batches: DataFrame) -> DataFrame:
    total = sum(
        F.lit(weight) * F.col(f"{level}_loss") for level, weight in LEVEL_WEIGHTS.items()
    )
    return batches.withColumn("loss", total)


def batch_of(position: Column, batch_size: int = BATCH_SIZE) -> Column:
    return F.floor(position / batch_size).cast("long")


def hier_loss(
    scores: DataFrame,
    labels: DataFrame,
    batch: Column,
    smoothing: float = LABEL_SMOOTHING,
) -> DataFrame:
    """Label-smoothed cross-entropy per batch over the three levels.

    Series count only for images with a confident brand, trims also need a
    confident series.  A level without counted images adds nothing.
    """
    judged = _on_true_path(scores, labels).withColumn("batch", batch)
    value = ar.smoothed_cross_entropy(F.col("logits"), F.col("label"), smoothing)
    images = _level_values(judged, value, ["batch", "image_id"])
    sure_brand = F.col("brand_top") > CONFIDENCE_GATE
    sure_both = sure_brand & (F.col("series_top") > CONFIDENCE_GATE)
    return _weighted(
        images.groupBy("batch").agg(
            F.avg("brand_ce").alias("brand_loss"),
            F.coalesce(F.avg(F.when(sure_brand, F.col("series_ce"))), F.lit(0.0)).alias(
                "series_loss"
            ),
            F.coalesce(F.avg(F.when(sure_both, F.col("trim_ce"))), F.lit(0.0)).alias("trim_loss"),
        )
    )


def masked_loss(scores: DataFrame, labels: DataFrame, batch: Column) -> DataFrame:
    """Plain cross-entropy per batch; labels below 0 or past the head are left out."""
    judged = (
        _on_true_path(scores, labels)
        .where((F.col("label") >= 0) & (F.col("label") < F.size("logits")))
        .withColumn("batch", batch)
    )
    value = ar.smoothed_cross_entropy(F.col("logits"), F.col("label"))
    images = _level_values(judged, value, ["batch", "image_id"])
    return _weighted(
        images.groupBy("batch").agg(
            *[
                F.coalesce(F.avg(f"{level}_ce"), F.lit(0.0)).alias(f"{level}_loss")
                for level in LEVEL_WEIGHTS
            ]
        )
    )


def saliency_threshold(maps: DataFrame) -> DataFrame:
    """Scale every map to 0..1, damp what lies under its level's percentile.

    ``maps`` has ``image_id, level, values``.  Adds ``threshold``, ``damped`` and
    the 0/1 ``mask`` of the values above the threshold.
    """
    share = F.lit(None).cast("double")
    factor = F.lit(None).cast("double")
    for level, (cut, keep) in SALIENCY_RULES.items():
        share = F.when(F.col("level") == level, F.lit(cut)).otherwise(share)
        factor = F.when(F.col("level") == level, F.lit(keep)).otherwise(factor)
    return (
        maps.withColumn("scaled", ar.min_max_scale(F.col("values")))
        .withColumn("threshold", ar.percentile_of(F.col("scaled"), share))
        .withColumn("factor", factor)
        .select(
            "image_id",
            "level",
            "threshold",
            ar.let(
                F.struct("threshold", "factor"),
                lambda r: F.transform(
                    "scaled",
                    lambda x: F.when(x < r["threshold"], x * r["factor"]).otherwise(x),
                ),
            ).alias("damped"),
            ar.let(
                F.col("threshold"),
                lambda cut: F.transform("scaled", lambda x: (x > cut).cast("int")),
            ).alias("mask"),
        )
    )
