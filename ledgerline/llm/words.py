"""Words of whole texts and 64-bit hashes of words and word sequences, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

from ledgerline.llm.common import at_work

#: Odd multiplier of the sequence hashes and the constants that mix them.  Fixed values.
FACTOR = np.uint64(0x9E3779B97F4A7C15)
MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
#: Words whose hashes a worker keeps; beyond, its table starts anew.
KEPT_WORDS = 200_000


class WordHashes(dict):
    """word (bytes) -> its 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        at_work("words", self.clear)
        if len(self) > KEPT_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


word_hashes = WordHashes()


def split_words(text: str | None, lower: bool = False) -> list[bytes]:
    """Runs of bytes other than [\\x20\\x09-\\x0D]; ``lower`` lower-cases A-Z."""
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX[0]
    h = (h ^ (h >> np.uint64(27))) * MIX[1]
    return h ^ (h >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words (empty if there are fewer)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out = out * FACTOR + words[k: k + n]
    return mixed(out)


def prefix_hashes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(prefix sums, inverse powers) from which :func:`range_hashes` makes the hash of any range of words."""
    power = np.cumprod(np.full(len(words), FACTOR, np.uint64))
    inverse = np.cumprod(np.full(len(words), pow(int(FACTOR), -1, 1 << 64), np.uint64))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * power, dtype=np.uint64)]), inverse


def range_hashes(prefix: np.ndarray, inverse: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Hash of ``length`` words from ``start`` on; equal ranges have equal hashes wherever they are."""
    return mixed((prefix[start + length] - prefix[start]) * inverse[start] + length.astype(np.uint64))
