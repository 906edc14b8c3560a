"""Sets of word shingles, as sorted 64-bit hashes, inside a task."""

import numpy as np
import xxhash

from starmill.llm.common import sole

WORDS = 5
MOST_KEPT = 250_000  # words a worker remembers before it starts afresh
# Odd multipliers of a 64-bit mix; any would do.
MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_kept = _Hashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_kept) > MOST_KEPT or not _kept:
        sole(_kept).clear()
    return np.fromiter(map(_kept.__getitem__, words), np.uint64, len(words))


def chained(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` hashes, in order."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = hashes[:n] * MIX[0]
    for k in range(1, size):
        found ^= found >> np.uint64(29)
        found += hashes[k:n + k] * MIX[1 + k % 3]
        found *= MIX[0]
    found ^= found >> np.uint64(32)
    found *= MIX[1]
    return found ^ (found >> np.uint64(29))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted hashes of a text's distinct shingles of five words, A-Z in lower case.

    Fewer words make one shingle of all of them; none make an empty set.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.int64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64).view(np.int64)
    return np.unique(chained(word_hashes(words), WORDS).view(np.int64))


def longest_first(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_set`` of a text, and the places of its shingles in one order of all: those of most letters first.

    Short words are the common ones, so long shingles are rarely shared by chance,
    however many texts there are; no counts are needed to know them.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if len(words) < WORDS:
        found = shingle_set(text)
        return found, np.arange(len(found))
    found, first = np.unique(chained(word_hashes(words), WORDS).view(np.int64), return_index=True)
    upto = np.concatenate(([0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))))
    return found, np.argsort(upto[first] - upto[first + WORDS], kind="stable")
