"""Quality classifier: a sparse ensemble of rules over text statistics.

A small forest is grown on statistics of labelled documents; every path from a
root to a node becomes a conjunction of thresholds.  A logistic regression with
an L1 penalty gives most rules weight zero; the others are compiled into one
Spark column expression, so scoring is a projection without Python.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carlot.llm.names import shielded
from carlot.session import stage

#: A rule is a conjunction of (statistic, "<=" or ">", threshold).
Rule = tuple[tuple[str, str, float], ...]

STATS = (
    "chars", "words", "word_length", "distinct_words", "upper", "digits", "symbols", "pipes",
    "lines", "distinct_lines", "line_chars", "commas",
)


def with_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``__stats`` of whole-text statistics.

    A null text counts as empty; every ratio over nothing is 0, so statistics are
    never null or NaN.
    """
    columns = docs.columns
    docs = docs.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    docs = docs.withColumn("__words", F.filter(F.split("__text", r"[ \t\n\r\f\x0B]+"), lambda w: w != ""))
    docs = docs.withColumn("__lines", F.split("__text", "\n"))
    chars, words, lines = F.length("__text"), F.size("__words"), F.size("__lines")

    def part(count: Column, whole: Column) -> Column:
        return count / F.greatest(whole, F.lit(1))

    def matches(pattern: str) -> Column:
        return chars - F.length(F.regexp_replace("__text", pattern, ""))

    spaces = words - 1
    values = {
        "chars": F.log1p(chars),
        "words": F.log1p(words),
        "word_length": part(chars - F.greatest(spaces, F.lit(0)), words),
        "distinct_words": part(F.size(F.array_distinct("__words")), words),
        "upper": part(matches(r"\p{Lu}+"), chars),
        "digits": part(matches("[0-9]+"), chars),
        "symbols": part(matches(r"[^\p{L}\p{N}\s.,|]+"), chars),
        "pipes": part(matches("[|]+"), words),
        "lines": F.log1p(lines),
        "distinct_lines": part(F.size(F.array_distinct("__lines")), lines),
        "line_chars": F.log1p(part(chars, lines)),
        "commas": part(matches("[,.]+"), words),
    }
    stats = F.struct(*(values[s].cast("double").alias(s) for s in STATS))
    return docs.select(*columns, stats.alias("__stats"))


def tree_rules(description: str) -> list[Rule]:
    """The conjunctions of all paths in a forest's ``toDebugString``."""
    rules: list[Rule] = []
    path: list[tuple[int, tuple[str, str, float]]] = []
    for line in description.splitlines():
        depth = len(line) - len(line.lstrip())
        found = re.search(r"(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if "Tree" in line:
            path = []
        if not found:
            continue
        path = [p for p in path if p[0] < depth]
        path.append((depth, (STATS[int(found[1])], found[2], float(found[3]))))
        rules.append(tuple(sorted({c for _, c in path})))
    return list(dict.fromkeys(rules))


def rule_column(rule: Rule) -> Column:
    """1.0 where all conditions of ``rule`` hold, else 0.0."""
    whole = F.lit(True)
    for stat, sign, value in rule:
        field = F.col("__stats")[stat]
        whole = whole & (field <= value if sign == "<=" else field > value)
    return whole.cast("double")


class RuleEnsemble:
    """An intercept and weighted rules."""

    def __init__(self, intercept: float, weights: dict[Rule, float]) -> None:
        self.intercept, self.weights = intercept, weights

    def score(self) -> Column:
        """The probability of a good document, over the column ``__stats``."""
        total = F.lit(float(self.intercept))
        for rule, weight in self.weights.items():
            total = total + rule_column(rule) * weight
        return 1 / (1 + F.exp(-total))


def fit_rules(
    train: DataFrame, trees: int = 16, depth: int = 3, penalty: float = 0.002, seed: int = 7
) -> RuleEnsemble:
    """Fit on columns ``__stats`` and ``label`` (0 or 1).

    With labels of one kind only, or none, the ensemble has no rules and scores
    that kind's share, 0.5 for no rows.
    """
    counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    if len(counts) < 2:
        share = {0: 0.01, 1: 0.99}.get(next(iter(counts), None), 0.5)
        return RuleEnsemble(math.log(share / (1 - share)), {})
    vector = array_to_vector(F.array(*(F.col("__stats")[s] for s in STATS)))
    rows = train.select(F.col("label").cast("double").alias("label"), vector.alias("features"), "__stats")
    total = sum(counts.values())
    rows = rows.withColumn(
        "weight", F.when(F.col("label") == 1, total / (2 * counts[1])).otherwise(total / (2 * counts[0]))
    )
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, weightCol="weight", featureSubsetStrategy="onethird",
    ).fit(rows)
    rules = tree_rules(forest.toDebugString)
    if not rules:
        return RuleEnsemble(math.log(counts[1] / counts[0]), {})
    held = rows.select("label", array_to_vector(F.array(*map(rule_column, rules))).alias("features"))
    lasso = LogisticRegression(
        elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=60
    ).fit(held)
    weights = {r: float(w) for r, w in zip(rules, lasso.coefficients) if w}
    return RuleEnsemble(float(lasso.intercept), weights)


def fit_quality(
    docs: DataFrame, labels: DataFrame, usable: Column, sample: int = 20_000, text: str = "text", key: str = "doc_id"
) -> RuleEnsemble:
    """Learn from the labelled rows for which ``usable`` holds.

    ``labels`` has ``key`` and ``label``; other labels than 0 and 1, and null keys, are not
    used, and of several of one key the largest counts.  About ``sample`` keys at most are taken,
    by a hash of the key, and only their texts are read whole for it.
    """
    known = (
        labels.filter(F.col("label").isin(0, 1)).groupBy(key).agg(F.max("label").cast("int").alias("label"))
    )
    known = known.filter(usable)
    share = min(1.0, sample / max(1, known.count()))
    known = known.filter(F.pmod(F.xxhash64(key), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select(key, F.col(text).alias("__body")).join(F.broadcast(known), key)
    return fit_rules(stage(with_stats(rows, "__body").select("__stats", "label"), "quality-train"))


def quality_scores(docs: DataFrame, model: RuleEnsemble, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``score``, the probability of a good document.

    A column ``score`` is replaced, all others come back.  Null and empty texts have the
    score of their statistics, which are 0; repeated rows and null keys score alike.
    """
    docs, back = shielded(docs, text)
    return back(with_stats(docs, text).withColumn("score", model.score()).drop("__stats"))


def keep_good(docs: DataFrame, model: RuleEnsemble, least: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, columns unchanged."""
    docs, back = shielded(docs, text)
    columns = docs.columns
    return back(with_stats(docs, text).filter(model.score() >= least).select(*columns))


def remainder(key: str, by: int) -> Column:
    """crc32 of the key as text, modulo ``by``; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % by


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    scored = quality_scores(docs, fit_quality(docs, labels, ~held_out))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
