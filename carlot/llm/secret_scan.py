"""Secret scan with an incremental ledger of content-addressed blobs.

Every version of every path names a blob, the SHA-256 of its text.  The ledger
is a Parquet folder with one row per scanned blob and run: the rule versions
applied and the spans they found.  A run scans only the (blob, rule version)
pairs that the ledger lacks and joins findings back to all paths.  A row holds
both the marks and the findings and appears when its job commits, so a run that
dies leaves no half-scanned blob.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carlot.session import scratch_path, stage


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern and the least length of one of its groups."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def version(self) -> str:
        text = f"{self.pattern}\n{self.group}\n{self.least}"
        return f"{self.kind}:{hashlib.sha256(text.encode()).hexdigest()[:16]}"

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        """Leftmost matches that do not overlap; matches that are too short are dropped."""
        for m in re.compile(self.pattern, re.ASCII).finditer(text):
            if m.end(self.group) - m.start(self.group) >= self.least:
                yield m.span()


#: Fixed kinds and patterns of the contract, in their order.
BASE = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
)
#: Further kinds: key blocks, signed web tokens, URLs with a password.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\s]+-----END [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,15}://[^\s:/@]{1,64}:[^\s/@]{1,64}@"),
)
RULES = BASE + MORE

FINDINGS = "array<struct<kind:string,start:int,end:int>>"
LEDGER = "blob_id string, rules array<string>, findings array<struct<rule:string,start:int,end:int>>"


def _scan(rules: tuple[Rule, ...]):
    by_version = {r.version: r for r in rules}

    def found(text: str, versions: list[str]) -> list[dict]:
        return [
            {"rule": v, "start": start, "end": end}
            for v in versions
            for start, end in by_version[v].spans(text)
        ]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame(
                {
                    "blob_id": frame["blob_id"],
                    "rules": frame["rules"],
                    "findings": [found(t, list(v)) for t, v in zip(frame["text"], frame["rules"])],
                }
            )

    return run


def _ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows; an absent or empty folder has none."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path)


def scan_versions(
    versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES, text: str = "text"
) -> DataFrame:
    """Every row of ``versions`` with ``blob_id`` and the ``findings`` of the given rules.

    A null text is the empty blob.  ``findings`` is sorted by start, then by the
    order of the rules, in code points.  The text column is dropped; a column
    called ``blob_id`` or ``findings`` is replaced.  A blob's text crosses the
    shuffle once per task that holds it, whatever the number of its paths.
    """
    spark = versions.sparkSession
    wanted = F.array(*(F.lit(r.version) for r in rules))
    blob = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    paths = versions.drop("findings").withColumn("blob_id", blob)
    blobs = paths.groupBy("blob_id").agg(F.any_value(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    seen = _ledger(spark, ledger).groupBy("blob_id").agg(
        F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen")
    )
    unseen = (
        blobs.join(seen, "blob_id", "left")
        .withColumn("rules", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>"))))
        .filter(F.size("rules") > 0)
        .select("blob_id", "text", "rules")
    )
    unseen.mapInPandas(_scan(rules), LEDGER).write.mode("append").parquet(ledger)
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    known = (
        _ledger(spark, ledger)
        .filter(F.arrays_overlap("rules", wanted) & (F.size("findings") > 0))
        .groupBy("blob_id")
        .agg(F.array_distinct(F.flatten(F.collect_list("findings"))).alias("findings"))
    )
    placed = F.transform(
        F.filter("findings", lambda f: F.array_contains(wanted, f["rule"])),
        lambda f: F.struct(
            f["start"].alias("start"),
            F.array_position(wanted, f["rule"]).cast("int").alias("place"),
            f["end"].alias("end"),
        ),
    )
    none = F.array().cast(FINDINGS)
    ordered = F.transform(
        F.array_sort(placed),
        lambda f: F.struct(
            F.element_at(kinds, f["place"]).alias("kind"), f["start"].alias("start"), f["end"].alias("end")
        ),
    )
    known = stage(known.withColumn("findings", ordered), "findings")  # a plain side lets hot blobs be split
    return (
        paths.drop(text)
        .join(known, "blob_id", "left")
        .withColumn("findings", F.coalesce("findings", none))
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's digest over ``documents``, from a ledger that starts empty."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = scan_versions(docs, scratch_path(spark, "secret-ledger"))
    base = F.filter("findings", lambda f: f["kind"].isin(*(r.kind for r in BASE)))

    def joined(spans):
        return F.array_join(
            F.transform(spans, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])), ","
        )

    def count(kind):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(r.kind).alias(f"n_{r.kind}") for r in BASE),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("findings")).alias("spans"),
    )
