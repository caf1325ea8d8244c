"""Ranked lexical search by the Best Position Algorithm.

Every block of documents holds one impact list per query term, highest impact first.
Lists are read side by side; a document that turns up is looked up directly in all
lists, which marks its position in each.  The best position of a list is the end of
its run of marked positions, often far beyond what was read in order, and no unseen
document can score more than the impacts behind the best positions allow.  An item is
done in a block when that bound is strictly below its k-th score.

Documents stay where they are: counts and document frequencies come from one pass,
each task answers all items over its own documents, block by block, and only the best
of each task are merged.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from carlot.llm.arrow_text import byte_slices, whole
from carlot.session import stage

#: Cells of a block's table of positions (terms x documents).
CELLS = 1 << 23


def _table() -> np.ndarray:
    """Bytes of terms as they are, A-Z lower-cased; all other ASCII is a space."""
    out = np.arange(256, dtype=np.uint8)
    for code in range(128):
        char = chr(code)
        out[code] = ord(char.lower()) if char.isalnum() else 0x20
    return out


_FOLD = _table()


def terms_of(text: str | None) -> list[str]:
    """The terms of one text in order."""
    return [t for t in (text or "").encode().translate(_FOLD.tobytes()).decode().split(" ") if t]


def _split(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(document of each term, code of each term, terms by code); no empty terms."""
    texts = whole(texts)
    data = texts.buffers()[2]
    folded = _FOLD[np.frombuffer(data, np.uint8)] if data is not None else np.zeros(0, np.uint8)
    texts = pa.StringArray.from_buffers(len(texts), texts.buffers()[1], pa.py_buffer(folded), offset=texts.offset)
    parts = pc.ascii_split_whitespace(texts)
    coded = parts.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    doc = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    empty = pc.equal(coded.dictionary, "").to_numpy(zero_copy_only=False)
    real = ~empty[codes] if len(codes) else np.zeros(0, bool)
    return doc[real], codes[real], coded.dictionary


def _held_terms(key: str, text: str, terms: list[str]):
    """Rows (key, n, terms, tfs): a text's length and its counts of the given terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = pa.array(terms, pa.string())
        for batch in batches:
            for part in byte_slices(batch, text):
                rows = part.num_rows
                doc, codes, known = _split(part.column(text))
                number = pc.fill_null(pc.index_in(known, wanted), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                term = number[codes] if len(codes) else np.zeros(0, np.int64)
                hit = term >= 0
                pairs, tfs = np.unique(doc[hit] * len(terms) + term[hit], return_counts=True)
                held = np.bincount(pairs // max(1, len(terms)), minlength=rows)
                ends = pa.array(np.concatenate([[0], np.cumsum(held)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(key),
                        pa.array(np.bincount(doc, minlength=rows), pa.int64()),
                        pa.ListArray.from_arrays(ends, pa.array(pairs % max(1, len(terms)), pa.int32())),
                        pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
                    ],
                    names=[key, "n", "terms", "tfs"],
                )

    return run


@dataclass(frozen=True)
class Corpus:
    """Counts of all documents and the weight of each term."""

    documents: int
    length: int
    weights: np.ndarray

    def impacts(self, tfs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        m = 100 - 75 + (75 * lengths * self.documents) // self.length
        return (1_000_000_000 * tfs) // (1000 * tfs + 8 * m)


class ImpactLists:
    """The documents of a block by term, highest impact first, and their positions."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, terms: int, docs: int) -> None:
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact, sorted_terms = doc[order], impact[order], term[order]
        self.starts = np.searchsorted(sorted_terms, np.arange(terms + 1))
        # one behind a document's position in a term's list; 0 where it is not in there
        self.place = np.zeros((terms, docs), np.int32)
        self.place[sorted_terms, self.doc] = np.arange(len(order)) - self.starts[sorted_terms] + 1
        self.docs = docs

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the ``k`` best with a score above 0, ties to the lesser document.

        What scores strictly below ``floor`` may be missing.
        """
        starts, sizes = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        held = (sizes > 0) & (weights > 0)
        terms, weights, starts, sizes = terms[held], weights[held], starts[held], sizes[held]
        lists = len(terms)
        place = self.place[terms]
        # marks of all lists, one behind the other, each with a mark that stays open at its end
        at = np.concatenate([[0], np.cumsum(sizes + 1)])
        marked = np.zeros(at[-1], bool)
        seen = np.zeros(self.docs, bool)
        best_at = np.zeros(lists, np.int64)
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, 8
        while lists:
            read = [self.doc[s + depth : s + min(depth + step, n)] for s, n in zip(starts, sizes) if n > depth]
            new = np.unique(np.concatenate(read)) if read else np.zeros(0, np.int64)
            new = new[~seen[new]]
            seen[new] = True
            spots = place[:, new]  # direct accesses
            row, column = np.nonzero(spots)
            spot = spots[row, column].astype(np.int64) - 1
            marked[at[row] + spot] = True
            gain = np.zeros(len(new), np.int64)
            np.add.at(gain, column, weights[row] * self.impact[starts[row] + spot])
            docs, scores = np.concatenate([docs, new]), np.concatenate([scores, gain])
            order = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[order], scores[order]
            depth, step = depth + step, step * 2
            bound = 0
            for i in range(lists):
                best_at[i] += int(marked[at[i] + best_at[i] : at[i + 1]].argmin())
                if best_at[i] < sizes[i]:
                    bound += int(weights[i]) * int(self.impact[starts[i] + best_at[i]])
            kth = int(scores[-1]) if len(scores) == k else 0
            if bound < max(kth, floor, 1):
                break
        return docs[scores > 0], scores[scores > 0]


def _search(key: str, kind: pa.DataType, items: list[tuple[int, np.ndarray, np.ndarray]], corpus: Corpus, k: int):
    """Rows (item, key, score): the best of a task's documents for each item."""
    terms = len(corpus.weights)
    per_block = int(min(8192, max(256, CELLS // max(1, terms))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: list[list[tuple]] = [[] for _ in items]
        for batch in batches:
            for start in range(0, batch.num_rows, per_block):
                part = batch.slice(start, per_block)
                # documents in the order of their keys, so that ties fall to the lesser one
                part = part.take(pc.sort_indices(part.column(key), null_placement="at_end"))
                keys = part.column(key).to_pylist()
                held = part.column("terms")
                sizes = np.diff(held.offsets.to_numpy())
                doc = np.repeat(np.arange(part.num_rows), sizes)
                term = held.flatten().to_numpy().astype(np.int64)
                tfs = part.column("tfs").flatten().to_numpy()
                lengths = part.column("n").to_numpy()
                lists = ImpactLists(term, doc, corpus.impacts(tfs, lengths[doc]), terms, part.num_rows)
                for top, (_, wanted, times) in zip(tops, items):
                    floor = -top[-1][0] if len(top) == k else 0
                    docs, scores = lists.best(wanted, times * corpus.weights[wanted], k, floor)
                    if len(docs):
                        top += [(-s, keys[d] is None, keys[d]) for d, s in zip(docs.tolist(), scores.tolist())]
                        top.sort(key=lambda x: (x[0], x[1]) if x[1] else x)
                        del top[k:]
        rows = [(number, -s, x) for top, (number, _, _) in zip(tops, items) for s, _, x in top]
        numbers, scores, found = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(found, kind), pa.array(scores, pa.int64())],
            names=["item", key, "score"],
        )

    return run


def _ranked(docs: DataFrame, items: list, key: str, text: str, k: int) -> DataFrame:
    """(item, key, score) of the tasks' best for items (number, id, text)."""
    counted = [(number, Counter(terms_of(body))) for number, _, body in items]
    terms = sorted(set().union(*(c.keys() for _, c in counted)))
    at = {t: i for i, t in enumerate(terms)}
    schema = T.StructType(
        [docs.schema[key], T.StructField("n", T.LongType()),
         T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("tfs", T.ArrayType(T.LongType()))]
    )
    held = stage(docs.select(key, text).mapInArrow(_held_terms(key, text, terms), schema), "terms")
    total = held.filter("n > 0").agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
    weights = np.zeros(len(terms), np.int64)
    for row in held.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[row["term"]] = math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * row["count"] + 1)))
    asked = [
        (number, np.array([at[t] for t in c], np.int64), np.array(list(c.values()), np.int64)) for number, c in counted if c
    ]
    corpus = Corpus(total["docs"], total["length"] or 1, weights)
    kind = to_arrow_type(docs.schema[key].dataType)
    schema = T.StructType([T.StructField("item", T.LongType()), docs.schema[key], T.StructField("score", T.LongType())])
    return held.mapInArrow(_search(key, kind, asked, corpus, k), schema)


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text", terms_a_pass: int = 50_000,
) -> DataFrame:
    """(``item_key``, rank, ``key``, score): the ``k`` best documents of each item, best first.

    Terms are runs of ASCII letters, digits and all other than ASCII signs, A-Z
    lower-cased.  An item's term counts as often as it stands there.  Equal scores go by
    ascending key, null keys last; only scores above 0 are returned.  Null and empty
    texts have no terms: such documents count for nothing and such items return nothing.
    Rows that repeat are documents, or items, of their own; an item key that repeats
    returns a ranking for each of its rows.

    Items are answered in passes of about ``terms_a_pass`` terms at most (an item is
    never parted), whose texts go through the driver; each pass reads the documents once.
    """
    spark = docs.sparkSession
    sized = items.select(F.col(item_key).alias("id"), F.col(item_text).alias("body"))
    sized = stage(sized.withColumn("size", F.octet_length("body")).filter("size > 0"), "items")
    # a term has a byte at least, and a space behind it
    passes = max(1, -(-(sized.agg(F.sum("size")).first()[0] or 0) // (2 * terms_a_pass)))
    answered = None
    for turn in range(passes):
        own = sized.filter(F.pmod(F.xxhash64("id", "body"), F.lit(passes)) == turn)
        asked = [(n, r["id"], r["body"]) for n, r in enumerate(own.collect())]
        if not any(terms_of(body) for _, _, body in asked):
            continue
        schema = T.StructType([T.StructField("item", T.LongType()), sized.schema["id"]])
        ids = spark.createDataFrame([(n, i) for n, i, _ in asked], schema)
        found = _ranked(docs, asked, key, text, k)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last(key))
        ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        ranked = ranked.join(F.broadcast(ids), "item")  # a pass has no more items than bytes
        ranked = ranked.select(F.col("id").alias(item_key), F.col("rank").cast("int").alias("rank"), F.col(key), "score")
        answered = ranked if answered is None else answered.union(ranked)
    if answered is None:
        schema = T.StructType([T.StructField(item_key, sized.schema["id"].dataType), T.StructField("rank", T.IntegerType()),
                               docs.schema[key], T.StructField("score", T.LongType())])
        return spark.createDataFrame([], schema)
    return answered


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
