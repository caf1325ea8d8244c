"""The corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carlot.llm.exact_dedup import COUNT, DIGEST, owners
from carlot.llm.ngram_join import drop_near_copies
from carlot.llm.packing import pack
from carlot.llm.pii_surrogates import replace_pii
from carlot.llm.quality_rules import fit_quality, keep_good, remainder
from carlot.llm.token_pieces import token_pieces
from carlot.session import scratch_path

CAPACITY = 2048
SECRET = "rotate-this-key"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more; labels of the held-out third are not used.

    Null and empty texts are scored by their statistics, rows that repeat score alike, null
    keys have no label but are scored.  Without labels of both kinds all rows get that
    kind's share; an empty table stays empty.  All columns come back.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    used = F.coalesce(remainder("doc_id", 3) != 1, F.lit(True))
    return keep_good(docs, fit_quality(docs, labels, used))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for case, the row with the largest doc_id stays.

    A null text counts as empty, a null key yields to any other; of rows that repeat one
    stays.  An empty table stays empty.  Columns ``group_size`` and ``text_sha256`` of the
    input are dropped, all others come back.
    """
    return owners(docs).drop(COUNT, DIGEST)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word shingles stays.

    It is the one with the least key, null keys last.  Null texts and texts without words are
    in no group and stay; rows that repeat key and text stay or go together.  An empty
    table stays empty.  All columns come back.
    """
    return drop_near_copies(docs, words=5, percent=80)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced; ``n_chars`` follows the text.

    A null text stays null, and so does its ``n_chars``; rows that repeat get the same
    surrogates.  An empty table stays empty.  All columns come back.
    """
    return replace_pii(docs, SECRET).withColumn("n_chars", F.length("text").cast("long"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents with their ids, sequence and offset.

    A null text counts as empty and is one piece, id 0; rows that repeat are packed each on
    their own.  An empty table gives no pieces.
    """
    return pack(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"), CAPACITY), CAPACITY)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("pii", pii),
    ("packing", packing),
]
#: No stage but the second can be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
