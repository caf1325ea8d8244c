"""Toxicity by compression: which of two zstandard dictionaries shortens a text more.

Each dictionary is a tail of word stems typical of its class, then a body that
zstandard trains on windows of both classes.  The body is the same and stands
nearer to the window, so ordinary prose costs the same with either dictionary and
the difference in length comes from the class's own words.  A document is cut into
windows of words; the differences of all its windows are summed up in a few
numbers, which a logistic fit turns into a probability.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carlot.llm.quality_rules import remainder
from carlot.session import stage

WORDS = 8
LONGEST = 512
STEM_LENGTHS = range(4, 13)
FEATURES = ("largest", "total", "share", "windows")
_MARKS = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words; ASCII marks and white space part them."""
    return (text or "").lower().encode("utf-8", "replace").translate(_MARKS).split()


def windows(text: str | None) -> list[bytes]:
    """The whole text in windows of eight words, cut again where words are very long."""
    words = words_of(text)
    out = []
    for at in range(0, len(words), WORDS):
        piece = b" " + b" ".join(words[at : at + WORDS]) + b" "
        out.extend(piece[i : i + LONGEST] for i in range(0, len(piece), LONGEST))
    return out


def stems(words: list[bytes]) -> set[bytes]:
    """The words of up to three bytes and the prefixes of the others."""
    return {w[:k] for w in set(words) for k in STEM_LENGTHS} | {w for w in words if len(w) < 4}


def _count_stems(known: frozenset[bytes] | None):
    """Documents per stem within a task, of all stems or of the known ones."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts: Counter[bytes] = Counter()
            for text in frame["text"]:
                found = stems(words_of(text))
                counts.update(found & known if known is not None else found)
            yield pd.DataFrame({"stem": list(counts), "n": list(counts.values())})

    return run


def _frequent(texts: DataFrame, least: float, known: frozenset[bytes] | None = None) -> dict[bytes, int]:
    """Stems in at least ``least`` documents; with a sum of n over all, fewer than sum / least."""
    counted = texts.select("text").mapInPandas(_count_stems(known), "stem binary, n long")
    rows = counted.groupBy("stem").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).collect()
    return {bytes(r["stem"]): r["n"] for r in rows}


def typical(own: dict[bytes, int], n_own: int, other: dict[bytes, int], n_other: int, ratio: float) -> list[bytes]:
    """Stems that are ``ratio`` times as frequent in the own class, rare ones first.

    Of prefixes of one another the one is taken beyond which support falls.
    """
    good = {s: n for s, n in own.items() if n / n_own > ratio * (other.get(s, 0) + 1) / n_other}
    tops = {s for s, n in good.items() if not any(good.get(s[:k], 0) > 1.3 * n for k in range(4, len(s)))}
    ends = [s for s in tops if not any(o != s and o.startswith(s) and good[o] * 1.3 >= good[s] for o in tops)]
    return sorted(ends, key=lambda s: (good[s], s))


@dataclass
class Dictionaries:
    """Raw dictionary contents of both classes and the weights of :data:`FEATURES`."""

    toxic: bytes = b""
    ordinary: bytes = b""
    mean: tuple[float, ...] = (0.0,) * len(FEATURES)
    scale: tuple[float, ...] = (1.0,) * len(FEATURES)
    weights: tuple[float, ...] = (0.0,) * len(FEATURES)
    intercept: float = 0.0

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        level = zstandard.ZstdCompressionParameters(
            window_log=15, chain_log=13, hash_log=13, search_log=5, min_match=5,
            strategy=zstandard.STRATEGY_LAZY, write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        made = []
        for content in (self.toxic, self.ordinary):
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=level)
            made.append(zstandard.ZstdCompressor(compression_params=level, dict_data=held))
        return made

    def features(self, texts: list[str | None]) -> np.ndarray:
        """A row per text: the largest and the summed advantage, its share, the windows."""
        out = np.zeros((len(texts), len(FEATURES)))
        if not self.toxic:
            return out
        toxic, ordinary = (c.compress for c in self.compressors())
        for at, text in enumerate(texts):
            gains = [len(ordinary(w)) - len(toxic(w)) for w in windows(text)]
            positive = sum(g for g in gains if g > 0)
            out[at] = (
                max(gains, default=0), np.log1p(positive), positive / max(1, len(gains)), np.log1p(len(gains))
            )
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        z = (features - np.array(self.mean)) / np.array(self.scale) @ np.array(self.weights) + self.intercept
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Newton steps of a logistic fit with a small ridge."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        w = w + np.linalg.solve(curve, slope)
    return w[:-1], float(w[-1])


def _trained(samples: list[bytes], size: int) -> bytes:
    """The content of a dictionary that zstandard trains, without its tables."""
    try:
        made = zstandard.train_dictionary(size, samples, k=64, d=6).as_bytes()
    except zstandard.ZstdError:  # too few samples
        return b" ".join(samples)[-size:]
    # the tables end with the three offsets that a new frame starts from: 1, 4, 8
    mark = b"\x01\0\0\0\x04\0\0\0\x08\0\0\0"
    return made[made.find(mark) + len(mark) :]


def _window_sample(each: int, tails: list[bytes]):
    """Runs of windows without the classes' own stems, which only the tails shall hold."""
    own = [b" " + s for s in tails]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for text in frame["text"]:
                cut = [w for w in windows(text) if not any(s in w for s in own)]
                out += [b"".join(cut[i : i + 4]) for i in range(0, len(cut), max(4, len(cut) // each))][:each]
            yield pd.DataFrame({"window": out})

    return run


def _features(model: Dictionaries):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = pd.DataFrame(model.features(list(frame["text"])), columns=list(FEATURES))
            yield pd.concat([frame[["label"]].reset_index(drop=True), found], axis=1)

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    per_class: int = 8000,
    body: int = 8192,
    support: float = 0.03,
    ratio: float = 10.0,
    windows_total: int = 60_000,
) -> Dictionaries:
    """Fit on at most ``per_class`` labelled documents of each class, chosen by a hash.

    ``docs`` has doc_id and text, ``labels`` doc_id and label (1 is toxic).  Stems
    are counted by Spark over the whole texts of the sample.  What reaches the
    driver is bounded: ids of the sample, stems in ``support`` of a class's
    documents, ``windows_total`` runs of windows and one row of numbers per sampled document.
    Without documents of both classes, or where no stem tells them apart, the model scores
    the toxic share of the sample everywhere, at least 0.01, and 0.5 without labels.  Other labels than 0
    and 1 are not used; of several of one document the largest counts.
    """
    known = labels.filter(F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.max("label").alias("label"))
    picked = [
        known.filter(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)
    ]
    sample = docs.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id").select("doc_id", "text", "label")
    sample = stage(sample, "toxicity-sample").repartition(64, "doc_id")
    toxic, ordinary = sample.filter("label = 1"), sample.filter("label = 0")
    n_toxic, n_ordinary = toxic.count(), ordinary.count()
    n_known = n_toxic + n_ordinary
    share = min(0.99, max(0.01, n_toxic / n_known)) if n_known else 0.5
    unknowing = Dictionaries(intercept=math.log(share / (1 - share)))
    if not n_toxic or not n_ordinary:
        return unknowing
    own = _frequent(toxic, max(3, support * n_toxic))
    other = _frequent(ordinary, max(3, support * n_ordinary))
    own_tail = typical(own, n_toxic, _frequent(ordinary, 1, frozenset(own)), n_ordinary, ratio)
    other_tail = typical(other, n_ordinary, _frequent(toxic, 1, frozenset(other)), n_toxic, 1.0)
    if not own_tail:
        return unknowing
    each = max(1, windows_total // (n_toxic + n_ordinary))
    cut = sample.select("text").mapInPandas(_window_sample(each, own_tail), "window binary").orderBy(F.xxhash64("window"), "window")
    shared = _trained([bytes(r["window"]) for r in cut.collect()], body)
    tail = b" " + b"  ".join(own_tail) + b" "
    plain = (b" " + b"  ".join(other_tail) + b" ")[: len(tail)].ljust(len(tail))
    model = Dictionaries(tail + shared, plain + shared)
    schema = "label int, " + ", ".join(f"{f} double" for f in FEATURES)
    fitted = (
        sample.select("text", F.col("label").cast("int").alias("label"))
        .mapInPandas(_features(model), schema)
        .toPandas()
        .sort_values(["label", *FEATURES])
    )
    x, y = fitted[list(FEATURES)].to_numpy(), fitted["label"].to_numpy(float)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    weights, intercept = _logistic((x - mean) / scale, y)
    model.mean, model.scale, model.weights, model.intercept = tuple(mean), tuple(scale), tuple(weights), intercept
    return model


def toxicity_scores(docs: DataFrame, model: Dictionaries, text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the probability of being toxic; a null text counts as empty."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(model.features(list(texts))))

    return docs.withColumn("score", score(F.coalesce(F.col(text), F.lit(""))))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col("toxic").alias("label"))
    held_out: Column = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = train(docs, labels.filter(~held_out))
    return toxicity_scores(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
