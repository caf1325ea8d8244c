"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carlot.session import stage


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b); the component is its least node.

    Large-star and small-star steps alternate until no link changes; more than
    ``rounds`` rounds, which chains of 2 ** (rounds / 2) nodes do not need, are an error.  Each round is
    written to the shared folder; nothing is collected but two counts.
    """
    links = links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v").distinct()
    links = stage(links, "links")
    state = None
    for _ in range(rounds):
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        small_least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(small_least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(small_least.select("u", F.col("m").alias("v")))
        links = stage(small.distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"links still change after {rounds} rounds")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
