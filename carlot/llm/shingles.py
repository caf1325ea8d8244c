"""Distinct word shingles of whole texts as 64-bit numbers."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

from carlot.llm.arrow_text import whole

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, words: int) -> list[np.ndarray]:
    """A sorted array of distinct shingles of ``words`` words per text.

    Words are what ASCII white space parts, A-Z lower-cased.  A text of fewer words
    is one shingle, the whole sequence; without words, or null, it has none.
    """
    folded = pc.ascii_lower(whole(texts))
    split = pc.ascii_split_whitespace(folded)
    coded = split.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    known = coded.dictionary.to_numpy(zero_copy_only=False)
    hashes = pd.util.hash_array(known, categorize=False).astype(np.uint64)
    offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
    real = (known != "")[codes] if len(codes) else np.zeros(0, bool)
    counts = np.add.reduceat(np.append(real, False), offsets[:-1]) * (np.diff(offsets) > 0)
    word = hashes[codes[real]]
    starts = np.cumsum(counts) - counts
    rolled = np.zeros(max(0, len(word) - words + 1), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(words):
            rolled = _mixed((rolled ^ word[i : i + len(rolled)]) + _ODD)
        out = []
        for start, count in zip(starts.tolist(), counts.tolist()):
            if count >= words:
                out.append(np.unique(rolled[start : start + count - words + 1]))
            elif count:
                single = np.full(1, count, np.uint64)
                for i in range(start, start + count):
                    single = _mixed((single ^ word[i : i + 1]) + _ODD)
                out.append(single)
            else:
                out.append(np.zeros(0, np.uint64))
    return out
