"""Callers' columns come back whatever their names, and nothing of the operators' own does."""

import pytest
from pyspark.sql import functions as F

from carlot.llm import exact_dedup, pii_surrogates, quality_rules, toxicity

NAMES = ["__text", "__words", "__found", "__list", "__map", "__length", "__hash", "__row", "kept0"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "Write to Dr. Anna Meyer, anna@example.com", *NAMES), (2, None, *NAMES), (3, "plain", *NAMES)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} string" for n in NAMES))


@pytest.mark.parametrize("run", [
    lambda d: pii_surrogates.replace_pii(d, "k"),
    lambda d: quality_rules.quality_scores(d, quality_rules.RuleEnsemble(0.0, {})).drop("score"),
    lambda d: quality_rules.keep_good(d, quality_rules.RuleEnsemble(0.0, {})),
    lambda d: exact_dedup.owners(d).drop("group_size", "text_sha256"),
])
def test_columns_come_back(docs, run):
    out = run(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == 3 and all([r[n] for n in NAMES] == NAMES for r in rows)


def test_counts_replace_columns_of_their_name(docs):
    out = pii_surrogates.replace_pii(docs.withColumn("n_email", F.lit("x")), "k", counts=True)
    assert sorted(r.n_email for r in out.collect()) == [0, 0, 1] and len(set(out.columns)) == len(out.columns)


def test_labels_other_than_two(spark, docs):
    labels = spark.createDataFrame([(1, 1), (2, 2), (3, 0), (None, 1)], "doc_id long, label int")
    assert quality_rules.fit_quality(docs, labels, F.lit(True)) is not None
    assert quality_rules.fit_quality(docs, labels.where("label = 2"), F.lit(True)).weights == {}


def test_toxicity_without_a_dictionary_scores_the_share(spark):
    rows = [(i, f"some ordinary words number {i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 10 == 0).cast("int").alias("label"))
    model = toxicity.train(docs, labels)
    assert {round(r.score, 6) for r in toxicity.toxicity_scores(docs, model).collect()} == {0.1}
    model = toxicity.train(docs, labels.where("label = 0"))
    assert max(r.score for r in toxicity.toxicity_scores(docs, model).collect()) < 0.3
