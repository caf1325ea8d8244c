"""SentencePiece encoding and decoding by Viterbi over sorted words.

A batch's distinct words, marked with the space sign, are sorted, so that they
stand as in a depth-first walk of their trie.  The forward states of a word are
kept per character; the next word reuses those of the prefix that both share and
computes only the rest.

With a unigram model a state is the best sum of scores.  With a BPE model the
lattice has a step between two pieces only if merging would leave them apart; this
leaves one path, the one that merging itself arrives at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carlot.llm.arrow_text import byte_slices

SPACE = "▁"
_WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Bytes that a model remembers of words and pairs, about; the process forgets all beyond.
CACHED = 160 << 20
#: Bytes of a remembered word or pair besides its text.
_ENTRY = 260
#: Longer words are encoded each time.
LONG = 100


class Tree(NamedTuple):
    """A piece's last merge: its rank and two parts.

    ``rising``: merges below it rank before it, and no other piece has their ranks.
    """

    rank: float
    left: str
    right: str
    rising: bool


_LEAF = Tree(-1, "", "", True)


def _number(i: int) -> bytes:
    return i.to_bytes(4, "little", signed=True)


class Model:
    """Pieces and scores of a SentencePiece file; no piece may hold a space after other signs."""

    def __init__(self, path: str) -> None:
        self.native = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.scores = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        self.longest = max(map(len, self.ids), default=1)
        self.lowest = min(self.scores.values(), default=0.0) - 10.0
        self.ended = None  # the scores that ``endings`` holds
        self.numbers = {p: _number(i) for p, i in self.ids.items()}
        self.unknown = sp.unk_id()
        self.bytes = {int(sp.id_to_piece(i)[3:-1], 16): i for i in range(size) if sp.is_byte(i)}
        # scores of merges are minus their rank; probabilities are not whole numbers
        self.merges = all(s == int(s) for s in self.scores.values())
        held = Counter(s for p, s in self.scores.items() if len(p) > 1)
        self.shared = {s for s, n in held.items() if n > 1}
        self.trees: dict[str, Tree | None] = {}
        self.whole = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.spelled = [b""] * size
        for i in plain:
            self.spelled[i] = sp.id_to_piece(i).replace(SPACE, " ").encode()
        for value, i in self.bytes.items():
            self.spelled[i] = bytes([value])
        if self.unknown >= 0:
            self.spelled[self.unknown] = " ⁇ ".encode()
        self.forget()

    def forget(self) -> None:
        if self.ended is not self.scores:
            # every text that a piece ends with: its score if it is a piece or a sign, else False
            self.endings: dict[str, float | bool] = {p[at:]: False for p in self.ids for at in range(len(p))}
            self.endings.update({p[-1]: self.lowest for p in self.ids})
            self.endings.update(self.scores)
            self.ended = self.scores
        # by the piece before, then by the piece behind the border
        self.apart: dict[str, dict[str, bool]] = {"": {}}
        self.known: dict[str, bytes] = {}
        self.used = 0
        self.lasts: list[str] = [""]
        self.best: list[float] = [0.0]
        self.behind: list[dict[str, bool]] = [self.apart[""]]
        self.last = ""

    def merged(self, text: str) -> list[str]:
        """Pieces left when the best neighbouring pair is merged again and again."""
        parts = list(text)
        while len(parts) > 1:
            scored = [(self.scores.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            score, at = max(scored)
            if score == -np.inf:
                break
            parts[-at : 2 - at] = [parts[-at] + parts[1 - at]]
        return parts

    def tree(self, piece: str) -> Tree | None:
        """How merging arrives at a piece; None if it does not."""
        if len(piece) == 1:
            return _LEAF
        if piece not in self.trees:
            parts, last = list(piece), ("", "")
            while len(parts) > 1:
                scored = [(self.scores.get(a + b, -np.inf), -i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
                score, at = max(scored)
                if score == -np.inf:
                    break
                last = parts[-at], parts[1 - at]
                parts[-at : 2 - at] = ["".join(last)]
            found = None
            if len(parts) == 1:
                rank, (left, right) = -self.scores[piece], map(self.tree, last)
                rising = left.rising and right.rising and rank > max(left.rank, right.rank) and -rank not in self.shared
                found = Tree(rank, *last, rising)
            self.trees[piece] = found
        return self.trees[piece]

    def _parted(self, a: str, b: str) -> bool:
        """Whether no merge crosses the border of ``a`` and ``b``.

        Both are taken apart again, the latest merge first.  At each stage the two parts
        at the border must not have a merge that is due before the one just undone; of
        merges that are equally due the left one comes first.
        """
        left, right = self.tree(a) if a else _LEAF, self.tree(b)
        if left is None or right is None:
            return False
        if not a:
            return True
        if not (left.rising and right.rising):
            return self.merged(a + b) == [a, b]
        scores, due = self.scores, np.inf
        while True:
            score = scores.get(a + b)
            if score is not None and -score < due:
                return False
            if left.rank > right.rank:
                due, a = left.rank, left.right
                left = self.tree(a)
            elif right.rank >= 0:
                due, b = right.rank + 1, right.left
                right = self.tree(b)
            else:
                return True

    def stay_apart(self, a: str, b: str) -> bool:
        """Whether merging ``a`` + ``b`` ends at these two; ``a`` may be empty."""
        behind = self.apart.setdefault(a, {})
        known = behind.get(b)
        if known is None:
            known = behind[b] = self._parted(a, b)
            self.used += len(b) + _ENTRY
        return known

    def _step(self, word: str, end: int) -> tuple[str, float]:
        """Last piece and score of the best path to ``word[:end]``."""
        endings, best, lasts, found = self.endings, self.best, self.lasts, []
        for start in range(end - 1, max(-1, end - self.longest - 1), -1):
            piece = word[start:end]
            if piece not in endings:
                break
            score = endings[piece]
            if score is not False:
                found.append((start, piece, score))
        if not found:  # a sign of no piece
            found.append((end - 1, word[end - 1], self.lowest))
        if self.merges:
            for start, piece, score in reversed(found):
                if self.stay_apart(lasts[start], piece):
                    return piece, best[start] + score
            return self.merged(word[:end])[-1], -np.inf
        start, piece, score = max(reversed(found), key=lambda one: best[one[0]] + one[2])
        return piece, best[start] + score

    def _extend(self, word: str, shared: int) -> None:
        """States behind ``word[:shared]`` where one piece alone stays apart from what is before it.

        That holds for pieces whose merges have ranks of their own, so the first that is found is taken.
        """
        endings, lasts, best, behind, longest = self.endings, self.lasts, self.best, self.behind, self.longest
        for end in range(shared + 1, len(word) + 1):
            found = None
            for start in range(end - 1, max(-1, end - longest - 1), -1):
                piece = word[start:end]
                if piece not in endings:
                    break
                if endings[piece] is not False:
                    known = behind[start].get(piece)
                    if known or (known is None and self.stay_apart(lasts[start], piece)):
                        found, score = piece, best[start] + endings[piece]
                        break
            if found is None:  # a sign of no piece, or merges that are no tree
                found, score = self._step(word, end)
            lasts.append(found)
            best.append(score)
            behind.append(self.apart.setdefault(found, {}))

    def _walk(self, word: str) -> list[str]:
        """Pieces of a word; states of the prefix shared with the last word are reused."""
        shared = len(commonprefix([self.last, word]))
        del self.lasts[shared + 1 :], self.best[shared + 1 :], self.behind[shared + 1 :]
        if self.merges and 2 * SPACE not in word:
            self._extend(word, shared)
        else:
            for end in range(shared + 1, len(word) + 1):
                piece, score = self._step(word, end)
                self.lasts.append(piece)
                self.best.append(score)
                self.behind.append(self.apart.setdefault(piece, {}))
        self.last = word
        pieces, end = [], len(word)
        while end:
            pieces.append(self.lasts[end])
            end -= len(pieces[-1])
        return pieces[::-1]

    def _coded(self, pieces: list[str]) -> bytes:
        """Ids of the pieces of a word as little-endian 32-bit numbers."""
        try:
            return b"".join([self.numbers[p] for p in pieces])
        except KeyError:
            out: list[bytes] = []
            for piece in pieces:
                if piece in self.numbers:
                    out.append(self.numbers[piece])
                elif self.bytes:
                    out += [_number(self.bytes[b]) for b in piece.encode()]
                elif not out or out[-1] != _number(self.unknown):
                    out.append(_number(self.unknown))
            return b"".join(out)

    def words(self, text: str) -> list[str]:
        """The marked words of a text, after the model's own normalisation."""
        marked = self.native.normalize(text) if text else ""
        if self.whole and marked:
            return [marked]
        parts = marked.split(SPACE)
        if parts[0] == "" and "" not in parts[1:]:  # one space before each word
            return [SPACE + p for p in parts[1:]]
        return _WORDS.findall(marked)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        split = [self.words(t) for t in texts]
        if self.used > CACHED:
            self.forget()
        long = {}
        for word in sorted(set().union(*split) - self.known.keys()):
            ids = self._coded(self._walk(word))
            if len(word) > LONG:
                long[word] = ids
            else:
                self.known[word] = ids
                self.used += 2 * len(word) + len(ids) + _ENTRY
        if long:
            return [b"".join([long.get(w) or self.known[w] for w in words]) for words in split]
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; the space that encoding puts first is taken off."""
        text = b"".join(map(self.spelled.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_MODELS: dict[str, Model] = {}


def _model(path: str) -> Model:
    return _MODELS.get(path) or _MODELS.setdefault(path, Model(path))


def _encoded(path: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for whole in batches:
            for batch in byte_slices(whole, text, 4 << 20):
                ids = model.encode([t or "" for t in batch.column(text).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])])
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                column = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, "ids"])

    return run


def _decoded(path: str, ids: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(path)
        for batch in batches:
            texts = [model.decode(x.values.to_numpy()) if x.is_valid else None for x in batch.column(ids)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "decoded"]
            )

    return run


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids``, the token ids of the whole text; null or empty has none.

    A column ``ids`` of ``docs`` is replaced.
    """
    docs = docs.drop("ids")
    return docs.mapInArrow(_encoded(path, text), T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(docs: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``docs`` with ``decoded``, the text of ``ids``; null for null."""
    docs = docs.drop("decoded")
    return docs.mapInArrow(_decoded(path, ids), T.StructType([*docs.schema.fields, T.StructField("decoded", T.StringType())]))


def encode_and_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``, both in one pass of a task's worker."""
    docs = docs.drop("ids", "decoded")
    there, back = _encoded(path, text), _decoded(path, "ids")
    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return docs.mapInArrow(lambda batches: back(there(batches)), T.StructType([*docs.schema.fields, *fields]))


def op8_sentencepiece(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    """Ids of every document, their digest, and whether decoding gives the text again."""
    path = model or public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    both = encode_and_decode(docs, path)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
        "ids",
    )
