"""Training tables: mixup batches, epoch metrics, best epoch."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from carlot.operators.scores import batch_of
from carlot.schema import BATCH_SIZE, MIXUP_ALPHA, PATIENCE


def beta_lambda(batch: Column, alpha: float = MIXUP_ALPHA, seed: int = 42) -> Column:
    """A Beta(alpha, alpha) draw per batch, the same on every run."""
    if alpha <= 0:
        return F.lit(1.0)

    @F.pandas_udf("double")
    def draw(batches: pd.Series) -> pd.Series:
        return batches.map(
            lambda b: np.random.default_rng([seed, int(b)]).beta(alpha, alpha)
        ).astype("float64")

    return draw(batch)


def mixup(
    rows: DataFrame,
    position: str,
    features: str,
    labels: list[str],
    lam: Column | None = None,
    batch_size: int = BATCH_SIZE,
    seed: int = 42,
) -> DataFrame:
    """Blend every row with a partner of its batch; both label sets are kept.

    ``position`` numbers the rows from 0, so a batch has ``batch_size`` rows and
    can be gathered whole.  Partners are the rows of the batch in md5 order.
    ``lam`` may use the column ``batch``; by default it is a Beta draw.
    """
    kept = [position, *labels, features]
    row = F.struct(*kept)
    shuffled = F.struct(
        F.md5(F.concat_ws("|", F.col(position).cast("string"), F.lit(str(seed))).cast("binary"))
        .alias("_order"),
        *kept,
    )
    batches = (
        rows.withColumn("batch", batch_of(F.col(position), batch_size))
        .groupBy("batch")
        .agg(
            F.array_sort(F.collect_list(row)).alias("a"),
            F.array_sort(F.collect_list(shuffled)).alias("b"),
        )
        .withColumn("lam", beta_lambda(F.col("batch"), seed=seed) if lam is None else lam)
    )
    pair = F.col("pair")
    lam_col = F.col("lam")
    return batches.select(
        "batch", "lam", F.explode(F.arrays_zip("a", "b")).alias("pair")
    ).select(
        "batch",
        "lam",
        pair["a"][position].alias(position),
        pair["b"][position].alias("partner"),
        F.zip_with(
            pair["a"][features], pair["b"][features], lambda x, y: x * lam_col + y * (1 - lam_col)
        ).alias(features),
        *[pair["a"][c].alias(c) for c in labels],
        *[pair["b"][c].alias(f"partner_{c}") for c in labels],
    )


def mixup_loss(loss_a: Column, loss_b: Column, lam: Column) -> Column:
    return lam * loss_a + (F.lit(1.0) - lam) * loss_b


def epoch_metrics(batches: DataFrame, levels: tuple[str, ...] = ("brand", "series", "trim")):
    """One row per run and epoch: mean batch loss and accuracies by phase.

    ``batches`` has ``run, epoch, phase, loss, lr`` and ``<level>_correct``,
    ``<level>_total`` counts.
    """

    def of(phase: str, c: str) -> Column:
        return F.when(F.col("phase") == phase, F.col(c))

    columns = []
    for phase in ("train", "val"):
        columns.append(F.avg(of(phase, "loss")).alias(f"{phase}_loss"))
        columns += [
            (F.sum(of(phase, f"{lv}_correct")) / F.sum(of(phase, f"{lv}_total"))).alias(
                f"{phase}_{lv}_acc"
            )
            for lv in levels
        ]
    return batches.groupBy("run", "epoch").agg(*columns, F.min("lr").alias("lr"))


def best_epoch(epochs: DataFrame, patience: int = PATIENCE) -> DataFrame:
    """Per run: the epoch saved last before stopping, and the epoch that stops it.

    An epoch counts as better only if its validation loss is below all earlier
    ones; after ``patience`` epochs without that the run stops.  A run has one
    row per epoch of its training plan.
    """
    before = Window.partitionBy("run").orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("run").orderBy("epoch").rowsBetween(Window.unboundedPreceding, 0)
    marked = (
        epochs.withColumn("_low", F.min("val_loss").over(before))
        .withColumn(
            "_better", F.coalesce(F.col("val_loss") < F.col("_low"), F.col("val_loss").isNotNull())
        )
        .withColumn("_place", F.count(F.lit(1)).over(so_far))
        .withColumn("_last", F.max(F.when(F.col("_better"), F.col("_place"))).over(so_far))
        .withColumn("_waited", F.col("_place") - F.coalesce("_last", F.lit(0)))
    )
    stops = marked.withColumn(
        "_stop", F.min(F.when(F.col("_waited") >= patience, F.col("_place"))).over(
            Window.partitionBy("run")
        )
    )
    counted = F.col("_stop").isNull() | (F.col("_place") <= F.col("_stop"))
    return stops.groupBy("run").agg(
        F.max(F.when(F.col("_better") & counted, F.col("epoch"))).alias("best_epoch"),
        F.min(F.when(F.col("_better") & counted, F.col("val_loss"))).alias("best_val_loss"),
        F.min(F.when(F.col("_place") == F.col("_stop"), F.col("epoch"))).alias("stop_epoch"),
    )
