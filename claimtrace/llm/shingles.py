"""Words and word shingles of whole texts as 64-bit numbers, for many texts at once.

Words are what stands between ASCII white space. A word's number is its xxHash; a shingle's is
mixed from its words' numbers, so equal shingles have equal numbers in every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

from claimtrace.llm.common import U64, pair, seed

MOST_WORDS = 250_000


class Numbers(dict):
    """The number of each word, kept for the next time; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        number = xxhash.xxh64_intdigest(word)
        if len(word) < 100:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = number
        return number


_KEPT = Numbers()


def word_numbers(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts in a row, and where each text's words end."""
    split = [(t.as_py().lower() if lower else t.as_py()).split() for t in texts]
    ends = np.cumsum([len(w) for w in split])
    numbers = np.empty(int(ends[-1]) if len(ends) else 0, U64)
    at = 0
    for words in split:
        numbers[at : at + len(words)] = np.fromiter(map(_KEPT.__getitem__, words), U64, len(words))
        at += len(words)
    return numbers, ends


def sets(texts: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each lower-cased text, sorted; and where each text's end.

    Texts with fewer words have one shingle, all their words; texts without words have none.
    """
    numbers, ends = word_numbers(texts, True)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    found, sizes = [], []
    mixed = numbers
    for i in range(1, width):  # position p holds the words p .. p+i
        mixed = pair(mixed[: len(mixed) - 1], numbers[i:], i) if len(mixed) else mixed
    for first, last in zip(starts, ends):
        n = int(last - first)
        if n >= width:
            own = np.unique(mixed[first : last - width + 1])
        elif n:
            own = numbers[first : first + 1]
            for i in range(1, n):
                own = pair(own, numbers[first + i : first + i + 1], i)
            own = own ^ seed(1000 + n)  # apart from full shingles
        else:
            own = numbers[:0]
        found.append(own)
        sizes.append(len(own))
    return (np.concatenate(found) if found else numbers[:0]), np.cumsum(sizes)
