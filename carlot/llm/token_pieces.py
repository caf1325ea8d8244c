"""Whole texts to token ids, cut into pieces of a given length."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from carlot.llm.arrow_text import byte_slices, whole

#: A run of letters, then a run of marks; either may be empty.  The tokenizer's own
#: split parts them, so each is encoded apart.  Apostrophes and "<" stay with
#: what surrounds them: contractions and special tokens need it.
_PARTS = re.compile(r"([^\W\d_]*)([.,!?;:#$%&*|()\"@=+-]*)")
_MARKS = ".,!?;:#$%&*|()\"@=+-"
#: Bytes that an encoder remembers, about; the process forgets all beyond.
CACHED = 192 << 20
#: The same where ids leave the worker, which takes memory of its own.
CACHED_BESIDE_IDS = 64 << 20
#: Bytes of one remembered part besides its text and ids.
_ENTRY = 150


class WordEncoder:
    """Encodes texts through their distinct parts.

    White space parts tokens in this tokenizer, so a text's ids are those of its
    white-space separated chunks in order.  Ids of parts are remembered, up to a fixed
    number of bytes; what a batch with longer parts adds is forgotten behind it.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.room = CACHED
        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for word, i in vocab.items() if word.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        # part 0 is empty, part 1 is the id 0 that closes a document; other chunks are kept behind a space
        self.known: dict[str, int] = {"": 0}
        # sizes and ids of the parts in order, in runs that encode() joins
        self.sizes, self.ids = [np.array([0, 1], np.int64)], [np.zeros(1, np.uint32)]
        self.used = 0

    def _add(self, keys: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        first = len(self.known) + 1
        self.known.update(zip(keys, range(first, first + len(keys))))
        self.sizes.append(sizes)
        self.ids.append(ids)
        self.used += sum(map(len, keys)) + 4 * len(ids) + _ENTRY * len(keys)

    def _add_each(self, keys: list[str], texts: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self._add(keys, np.array([len(own) for own in found], np.int64), np.array(sum(found, []), np.uint32))

    def _learn(self, runs: list[str], odd: list[str]) -> None:
        """Runs of one kind of character are one word each: encode many at once."""
        for at in range(0, len(runs), 500):
            some = runs[at : at + 500]
            found = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            ids = np.array(found[0].ids, np.uint32)
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(some):
                self._add(some, np.diff(stops, prepend=0), ids)
            else:
                self._add_each(some, some)
        for at in range(0, len(odd), 500):
            self._add_each([" " + o for o in odd[at : at + 500]], odd[at : at + 500])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, with id 0 behind each text, and the texts' offsets in them."""
        if self.used > self.room:
            self._forget()
        chunks = pc.ascii_split_whitespace(whole(texts))
        coded = chunks.flatten().dictionary_encode()
        known, first, second, open_, runs, odd = self.known, [], [], [], {}, {}
        for chunk in coded.dictionary.to_pylist():
            letters = chunk.rstrip(_MARKS)
            a, b = known.get(letters), known.get(chunk[len(letters) :])
            if a is None or b is None:  # not by parts that are known as they stand
                letters, marks = _PARTS.match(chunk).groups()
                if len(letters) + len(marks) == len(chunk):
                    parts = letters.lower() if letters.isascii() else letters, marks
                    for part in parts:
                        if part not in known:
                            runs[part] = None
                else:
                    parts = " " + chunk, ""
                    if parts[0] not in known:
                        odd[chunk] = None
                a, b = 0, 0
                open_.append((len(first), *parts))
            first.append(a)
            second.append(b)
        self._learn(list(runs), list(odd))
        for at, letters, marks in open_:
            first[at], second[at] = known[letters], known[marks]
        pairs = np.array([first, second], np.int64).T
        offsets = chunks.offsets.to_numpy() - chunks.offsets[0].as_py()
        parts = np.insert(pairs[coded.indices.to_numpy(zero_copy_only=False)].ravel(), 2 * offsets[1:], 1)
        sizes, flat = np.concatenate(self.sizes), np.concatenate(self.ids)
        self.sizes, self.ids = [sizes], [flat]
        starts = np.cumsum(sizes) - sizes
        long = sizes[parts]
        ends = np.cumsum(long)
        ids = flat[np.repeat(starts[parts] - (ends - long), long) + np.arange(ends[-1] if len(ends) else 0)]
        closing = 2 * offsets[1:] + np.arange(1, len(offsets)) - 1
        return ids, np.concatenate([[0], ends[closing]]) if len(closing) else np.zeros(1, np.int64)


_ENCODERS: dict[str, WordEncoder] = {}


def _pieces(path: str, text: str, key: str, capacity: int, keep: bool, sums: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get(path) or _ENCODERS.setdefault(path, WordEncoder(path))
        encoder.room, slice_bytes = (CACHED_BESIDE_IDS, 2 << 20) if keep else (CACHED, 8 << 20)
        for full in batches:
            for batch in byte_slices(full, text, slice_bytes):
                ids, offsets = encoder.encode(batch.column(text))
                counts = -(-np.diff(offsets) // capacity)
                row = np.repeat(np.arange(len(counts)), counts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * capacity
                first = offsets[row] + start
                last = np.minimum(first + capacity, offsets[row + 1])
                # a text's pieces follow one another, so all ids lie in the order of the pieces
                bounds = np.concatenate([[0], last]).astype(np.int32)
                columns = {
                    key: batch.column(key).take(pa.array(row)), "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()), "length": pa.array(last - first, pa.int64()),
                }
                if keep:
                    columns["ids"] = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32)))
                if sums:
                    words, ends = ids.astype("<u4"), bounds.tolist()
                    columns["ids_crc32"] = pa.array([zlib.crc32(words[a:b]) for a, b in zip(ends, ends[1:])], pa.int64())
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
                pa.default_memory_pool().release_unused()

    return run


def token_pieces(
    docs: DataFrame, path: str, capacity: int, text: str = "text", key: str = "doc_id",
    ids: bool = True, sums: bool = False,
) -> DataFrame:
    """A row per piece of a row of ``docs``: key, piece, start, length, and with ``ids`` its ids.

    A text becomes its token ids and id 0; null is empty, so every row has at
    least one piece.  Only texts of more than ``capacity`` ids are cut.  With ``sums``
    there is also ids_crc32, of the ids as little-endian unsigned 32-bit numbers.
    """
    schema = T.StructType(
        [
            docs.schema[key],
            T.StructField("piece", T.IntegerType()),
            *(T.StructField(c, T.LongType()) for c in ("start", "length")),
            *([T.StructField("ids", T.ArrayType(T.IntegerType(), False))] if ids else []),
            *([T.StructField("ids_crc32", T.LongType())] if sums else []),
        ]
    )
    return docs.select(key, text).mapInArrow(_pieces(path, text, key, capacity, ids, sums), schema)
