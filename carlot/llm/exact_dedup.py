"""Exact dedup with Patricia tries that store the owner of every distinct text.

Texts are partitioned by byte length and content hash.  Within a partition the
full byte strings go into a compressed radix trie; the terminal node of a text
stores its owner, the row that stays.  A task first reduces its own rows, so a
group of copies of any size reaches the shuffle as one row per task and buffer.
When the texts held by a task pass ``buffer_mb`` its subtrees are spilled: their
terminals go to the shuffle as partial owners and are merged behind it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carlot.llm.arrow_text import whole
from carlot.llm.names import shielded

LENGTH, HASH, COUNT, DIGEST = "__length", "__hash", "group_size", "text_sha256"


class RadixTrie:
    """A compressed trie over byte strings; each terminal holds one value."""

    __slots__ = ("edge", "children", "value")

    def __init__(self, edge: bytes = b"") -> None:
        self.edge = edge
        self.children: dict[int, RadixTrie] = {}
        self.value = None

    def terminal(self, text: bytes) -> RadixTrie:
        """The node that ends ``text``; it is made, and edges are split, as needed."""
        node = self
        while text:
            child = node.children.get(text[0])
            if child is None:
                child = node.children[text[0]] = RadixTrie(text)
                return child
            if text.startswith(child.edge):
                node, text = child, text[len(child.edge):]
                continue
            shared = _shared(child.edge, text)
            upper = RadixTrie(text[:shared])
            child.edge = child.edge[shared:]
            upper.children[child.edge[0]] = child
            node.children[text[0]] = upper
            node, text = upper, text[shared:]
        return node


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _normal(column: pa.Array, fold_case: bool) -> pa.Array:
    column = whole(column)
    return pc.ascii_lower(column) if fold_case else column


def _better(a: int | None, b: int | None, largest: bool) -> bool:
    """Whether identifier ``a`` takes a text from ``b``; any identifier beats null."""
    if a is None or b is None:
        return b is None and a is not None
    return a > b if largest else a < b


def _reduce(rows: pa.Table, text: str, key: str, fold_case: bool, largest: bool) -> pa.Table:
    """One row per distinct text: its owner's row, with the copies counted."""
    tries: dict[tuple[int, int], RadixTrie] = {}
    ends: list[RadixTrie] = []
    texts = _normal(rows[text].combine_chunks(), fold_case).cast(pa.large_binary())
    for at, (ident, size, n, h) in enumerate(
        zip(*(rows[c].to_pylist() for c in (key, COUNT, LENGTH, HASH)))
    ):
        root = tries.get((n, h))
        if root is None:
            root = tries[n, h] = RadixTrie()
        node = root.terminal(texts[at].as_py())
        if node.value is None:
            node.value = [ident, at, size]
            ends.append(node)
        else:
            node.value[2] += size
            if _better(ident, node.value[0], largest):
                node.value[:2] = ident, at
    kept = rows.take(pa.array([e.value[1] for e in ends], pa.int64()))
    counts = pa.array([e.value[2] for e in ends], pa.int64())
    return kept.set_column(kept.schema.get_field_index(COUNT), COUNT, counts)


def _local(text: str, key: str, fold_case: bool, largest: bool, limit: int):
    def keyed(batch: pa.RecordBatch) -> pa.Table:
        texts = _normal(batch.column(text), fold_case).cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        hashes = [xxhash.xxh3_64_intdigest(x.as_buffer() or b"") for x in texts]
        table = pa.Table.from_batches([batch])
        table = table.append_column(LENGTH, pa.array(np.diff(offsets), pa.int64()))
        table = table.append_column(HASH, pa.array(np.array(hashes, np.uint64).view(np.int64)))
        return table.append_column(COUNT, pa.array(np.ones(len(batch), np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(_reduce(keyed(batch), text, key, fold_case, largest))
            if sum(t.nbytes for t in held) > limit:
                yield from _reduce(pa.concat_tables(held), text, key, fold_case, largest).to_batches()
                held = []
        if held:
            yield from _reduce(pa.concat_tables(held), text, key, fold_case, largest).to_batches()

    return run


def _merge(text: str, key: str, fold_case: bool, largest: bool):
    """Rows come sorted by partition key; the last partition of a batch may go on."""

    def finish(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        texts = _normal(rows[text].combine_chunks(), fold_case).cast(pa.large_binary())
        digests = [hashlib.sha256(x.as_buffer() or b"").hexdigest() for x in texts]
        rows = rows.drop_columns([LENGTH, HASH]).append_column(DIGEST, pa.array(digests, pa.string()))
        yield from rows.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: pa.Table | None = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([open_rows, rows]) if open_rows is not None else rows
            rows = _reduce(rows, text, key, fold_case, largest)
            last = rows.num_rows - 1
            going_on = pc.and_(
                pc.equal(rows[LENGTH], rows[LENGTH][last]), pc.equal(rows[HASH], rows[HASH][last])
            )
            open_rows = rows.filter(going_on)
            yield from finish(rows.filter(pc.invert(going_on)))
        if open_rows is not None:
            yield from finish(open_rows)

    return run


def owners(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    fold_case: bool = True,
    keep_largest: bool = True,
    buffer_mb: int = 48,
) -> DataFrame:
    """The row that stays of every distinct text, with ``group_size`` and ``text_sha256``.

    Texts are equal when identical, after lower-casing A-Z with ``fold_case``; a
    null text counts as empty.  The row with the largest (or smallest) ``key``
    stays; a null key yields to any other, and of rows with the same key and text
    exactly one stays.  All columns of ``docs`` are returned, whatever their
    names, except ``group_size`` and ``text_sha256``, which are replaced.  An
    empty table gives an empty table.
    """
    docs, back = shielded(docs.drop(COUNT, DIGEST), text, key)
    inner = T.StructType(
        [*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in (LENGTH, HASH, COUNT))]
    )
    outer = T.StructType(
        [
            *docs.schema.fields,
            T.StructField(COUNT, T.LongType()),
            T.StructField(DIGEST, T.StringType()),
        ]
    )
    partial = docs.mapInArrow(_local(text, key, fold_case, keep_largest, buffer_mb << 20), inner)
    dealt = partial.repartition(LENGTH, HASH).sortWithinPartitions(LENGTH, HASH)
    return back(dealt.mapInArrow(_merge(text, key, fold_case, keep_largest), outer))


def _digests(text: str, key: str, fold_case: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _normal(batch.column(text), fold_case).cast(pa.large_binary())
            digests = [hashlib.sha256(x.as_buffer() or b"").hexdigest() for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(digests, pa.string())], names=[key, DIGEST]
            )

    return run


def dedup_report(
    docs: DataFrame, text: str = "text", key: str = "doc_id", fold_case: bool = True
) -> DataFrame:
    """One row per row of ``docs``: key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    ``kept`` marks the rows with the owner's key; where a key and text repeat, all
    of those rows are marked, while :func:`owners` returns one.
    """
    docs = docs.select(key, text)
    kept = owners(docs, text, key, fold_case).select(F.col(key).alias("keep_id"), COUNT, DIGEST)
    schema = T.StructType([docs.schema[key], T.StructField(DIGEST, T.StringType())])
    rows = docs.mapInArrow(_digests(text, key, fold_case), schema)
    return rows.join(kept, DIGEST).select(
        key, "keep_id", COUNT, F.col(key).eqNullSafe(F.col("keep_id")).alias("kept"), DIGEST
    )
