"""Linear classifier heads, one per node of the hierarchy, trained all at once.

A head is a row ``node, weights`` with one weight vector (bias last) per class.
Training is full-batch softmax regression.  Each step joins rows with their
head and scores them on the JVM side, adds up gradients per head inside the
tasks, and sums them over tasks, so a node that holds most of the rows is spread
over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F

from carlot.functions.arrays import dot, let, softmax
from carlot.operators.scores import series_node, trim_node
from carlot.session import stage

_HEADS_IN_MEMORY = 256  # gradient sums a task holds before it hands them on


def node_rows(labelled: DataFrame, features: str = "features") -> DataFrame:
    """Three training rows per labelled row: one for each level's head."""
    x = F.col(features).cast("array<double>")
    heads = F.array(
        F.struct(F.lit("").alias("node"), F.col("brand_idx").cast("int").alias("label")),
        F.struct(
            series_node(F.col("brand_idx")).alias("node"),
            F.col("series_idx").cast("int").alias("label"),
        ),
        F.struct(
            trim_node(F.col("brand_idx"), F.col("series_idx")).alias("node"),
            F.col("trim_idx").cast("int").alias("label"),
        ),
    )
    return labelled.select(F.inline(heads), x.alias("x"))


def _residuals(x: Column, weights: Column, label: Column) -> Column:
    """Probability of every class of a head, less 1 for the true class."""
    return let(
        softmax(head_logits(x, weights)),
        lambda p: F.transform(p, lambda v, i: v - (i == label).cast("double")),
    )


def _gradients(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per head and class: summed gradient over the rows seen by this task."""
    sums: dict[str, np.ndarray] = {}

    def flush() -> pd.DataFrame:
        out = pd.DataFrame(
            [(n, k, g.tolist()) for n, grad in sums.items() for k, g in enumerate(grad)],
            columns=["node", "class_idx", "gradient"],
        )
        sums.clear()
        return out

    for pdf in batches:
        for node, part in pdf.groupby("node", sort=False):
            x = np.stack(part["x"].to_list())
            grad = np.stack(part["residual"].to_list()).T @ np.hstack([x, np.ones((len(x), 1))])
            sums[node] = sums[node] + grad if node in sums else grad
        if len(sums) > _HEADS_IN_MEMORY:
            yield flush()
    if sums:
        yield flush()


def train_node_heads(
    rows: DataFrame, width: int, steps: int = 50, rate: float = 1.0, ridge: float = 1e-4
) -> DataFrame:
    """Heads for every node in ``rows`` (``node, label, x`` of length ``width``).

    Weights start at zero and move by the mean gradient, so the result does not
    depend on the partitioning beyond rounding.
    """
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    heads = rows.groupBy("node").agg(
        F.count(F.lit(1)).alias("n_rows"), (F.max("label") + 1).alias("n_classes")
    )
    zero = F.array_repeat(F.lit(0.0), width + 1)
    weights = stage(
        heads.select(
            "node", "n_rows",
            F.transform(F.sequence(F.lit(1), "n_classes"), lambda i: zero).alias("weights"),
        ),
        "heads",
    )
    for _ in range(steps):
        summed = (
            rows.join(weights.select("node", "weights"), "node")
            .select("node", "x", _residuals(F.col("x"), F.col("weights"), F.col("label"))
                    .alias("residual"))
            .mapInPandas(_gradients, "node string, class_idx int, gradient array<double>")
            .groupBy("node", "class_idx")
            .agg(*[F.sum(F.col("gradient")[i]).alias(f"g{i}") for i in range(width + 1)])
            .select(
                "node", "class_idx", F.array(*[f"g{i}" for i in range(width + 1)]).alias("g")
            )
        )
        moved = (
            weights.select("node", "n_rows", F.posexplode("weights").alias("class_idx", "w"))
            .join(summed, ["node", "class_idx"])
            .select(
                "node",
                "n_rows",
                "class_idx",
                F.zip_with(
                    "w", "g", lambda w, g: w - F.lit(rate) * (g / F.col("n_rows") + w * ridge)
                ).alias("w"),
            )
        )
        weights = stage(
            moved.groupBy("node", "n_rows")
            # one entry per class of the head
            .agg(F.array_sort(F.collect_list(F.struct("class_idx", "w"))).alias("c"))
            .select("node", "n_rows", F.transform("c", lambda c: c["w"]).alias("weights")),
            "heads",
        )
    rows.unpersist()
    return weights.select("node", "weights")


def head_logits(features: Column, weights: Column) -> Column:
    """Logits of every class of a head."""
    x = F.concat(features.cast("array<double>"), F.array(F.lit(1.0)))
    return let(x, lambda v: F.transform(weights, lambda w: dot(v, w)))


def score_node_heads(
    rows: DataFrame, heads: DataFrame, node: Column, level: str, features: str = "features"
) -> DataFrame:
    """Rows with ``level, node, logits`` of the head that ``node`` names."""
    return (
        rows.withColumn("node", node)
        .join(heads, "node")
        .withColumn("level", F.lit(level))
        .withColumn("logits", head_logits(F.col(features), F.col("weights")))
        .drop("weights")
    )
