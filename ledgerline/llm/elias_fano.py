"""Elias-Fano sequences and a two-level trie of them, over numpy arrays and memory-mapped files."""

from __future__ import annotations

import os
import tempfile

import numpy as np

DISCOUNT = 0.75
#: Words of 64 bits in a block of a bit vector's directory; searches done at once.
BLOCK, AT_ONCE = 8, 1 << 16
#: For each byte, the place of its k-th set bit.
_PLACE = np.array([([k for k in range(8) if b >> k & 1] + [0] * 8)[:8] for b in range(256)], np.uint8)


def _pack(values: np.ndarray, bits: int) -> np.ndarray:
    """``bits`` low bits of each value one after another, as 64-bit words with one word to spare."""
    words = np.zeros((len(values) * bits + 63) // 64 + 1, np.uint64)
    if not bits or not len(values):
        return words
    if len(values) > AT_ONCE:  # as many values as bits in a word begin with a word
        for k in range(0, len(values), AT_ONCE):
            part = _pack(values[k: k + AT_ONCE], bits)[:-1]
            words[k * bits // 64: k * bits // 64 + len(part)] = part
        return words
    at = np.arange(len(values), dtype=np.uint64) * np.uint64(bits)
    word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    first = np.concatenate([[0], np.flatnonzero(word[1:] != word[:-1]) + 1])
    words[word[first]] = np.bitwise_or.reduceat(values << off, first)
    over = np.flatnonzero(off + np.uint64(bits) > 64)  # at most one value runs from a word into the next
    words[word[over] + 1] |= values[over] >> (np.uint64(64) - off[over])
    return words


def _unpack(words: np.ndarray, bits: int, index: np.ndarray) -> np.ndarray:
    if not bits:
        return np.zeros(len(index), np.uint64)
    at = index.astype(np.uint64) * np.uint64(bits)
    word, off = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
    high = np.where(off > 0, words[word + 1] << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
    return ((words[word] >> off) | high) & np.uint64((1 << bits) - 1)


def _chunked(f, *arrays: np.ndarray) -> np.ndarray:
    """``f`` over equal parts of the arrays, so that what it gathers stays small."""
    n = len(arrays[0])
    if n <= AT_ONCE:
        return f(*arrays)
    return np.concatenate([f(*(a[k: k + AT_ONCE] for a in arrays)) for k in range(0, n, AT_ONCE)])


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits as a unary bit vector with a directory of its set bits.

    ``ones[j]``: set bits before block j.  Values are found where they lie; no
    level is ever unpacked.
    """

    def __init__(self, n: int, bits: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray):
        self.n, self.bits, self.low, self.high, self.ones = n, bits, low, high, ones

    @classmethod
    def build(cls, values: np.ndarray, universe: int) -> EliasFano:
        """``values``: uint64, ascending, all below ``universe``."""
        n = len(values)
        bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        low = _pack(values & np.uint64((1 << bits) - 1), bits)
        places = (values >> np.uint64(bits)).astype(np.int64)
        places += np.arange(n)
        size = n + ((universe - 1) >> bits) + 1
        flags = np.zeros(-(-size // (64 * BLOCK)) * 64 * BLOCK, np.uint8)
        flags[places] = 1
        high = np.packbits(flags, bitorder="little").view(np.uint64)
        in_block = np.bitwise_count(high.reshape(-1, BLOCK)).sum(axis=1, dtype=np.uint64)
        return cls(n, bits, low, high, np.concatenate([np.zeros(1, np.uint64), np.cumsum(in_block, dtype=np.uint64)]))

    def arrays(self) -> list[np.ndarray]:
        return [np.array([self.n, self.bits], np.uint64), self.low, self.high, self.ones]

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        """Place of the k-th set (or clear) bit: the directory's block, then the word, then the byte."""
        before = self.ones.astype(np.int64)
        if not ones:
            before = np.arange(len(before)) * (64 * BLOCK) - before

        def one(k: np.ndarray) -> np.ndarray:
            block = np.searchsorted(before, k, side="right") - 1
            rest = k - before[block]
            words = self.high[block[:, None] * BLOCK + np.arange(BLOCK)]
            if not ones:
                words = ~words
            upto = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int64)
            word = (upto <= rest[:, None]).sum(axis=1)
            at = np.arange(len(k))
            rest = rest - np.where(word > 0, upto[at, word - 1], 0)
            octets = words[at, word].astype("<u8")[:, None].view(np.uint8)
            upto = np.cumsum(np.bitwise_count(octets), axis=1, dtype=np.int64)
            octet = (upto <= rest[:, None]).sum(axis=1)
            rest = rest - np.where(octet > 0, upto[at, octet - 1], 0)
            return (block * BLOCK + word) * 64 + octet * 8 + _PLACE[octets[at, octet], rest]
        return _chunked(one, k)

    def get(self, index: np.ndarray) -> np.ndarray:
        """The values at the indices."""
        if not len(index):
            return np.zeros(0, np.uint64)
        return ((self._select(index, True) - index).astype(np.uint64) << np.uint64(self.bits)) | _unpack(self.low, self.bits, index)

    def find(self, x: np.ndarray, begin: np.ndarray | int = 0, end: np.ndarray | int | None = None) -> np.ndarray:
        """Index of the first value not below each ``x`` among those from ``begin`` to ``end`` if it equals ``x``, else -1."""
        if not self.n or not len(x):
            return np.full(len(x), -1)
        top = (x >> np.uint64(self.bits)).astype(np.int64)
        # Values of this high part and below lie before its clear bit.
        last = len(self.high) * 64 - int(self.ones[-1]) - 1
        some = top <= last
        top = np.minimum(top, last)
        hi = self._select(top, False) - top
        lo = np.where(top > 0, self._select(np.maximum(top - 1, 0), False) - np.maximum(top - 1, 0), 0)
        lo, end = np.maximum(lo, begin), np.minimum(hi, self.n if end is None else end)
        hi = end.copy()
        want = x & np.uint64((1 << self.bits) - 1)
        active = np.flatnonzero(some & (lo < hi))
        while len(active):
            mid = (lo[active] + hi[active]) >> 1
            less = _unpack(self.low, self.bits, mid) < want[active]
            lo[active[less]] = mid[less] + 1
            hi[active[~less]] = mid[~less]
            active = active[lo[active] < hi[active]]
        hit = some & (lo < end) & (_unpack(self.low, self.bits, np.minimum(lo, self.n - 1)) == want)
        return np.where(hit, lo, -1)


def _codes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(256 values, the code of each value): equally wide bins, by the means of what lies in them."""
    if not len(values):
        return np.zeros(256, np.float32), np.zeros(0, np.uint8)
    low, width = values.min(), max(float(np.ptp(values)), 1e-9)
    code = np.minimum((values - low) * (256 / width), 255).astype(np.uint8)
    n = np.bincount(code, minlength=256)
    return (np.bincount(code, values, 256) / np.maximum(n, 1)).astype(np.float32), code


def summed(context: np.ndarray, successor: np.ndarray, times: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct contexts ascending, successors of each, those ascending in each, how often each pair occurs)."""
    words, at = np.unique(context, return_inverse=True)
    key = (at.astype(np.uint64) << np.uint64(bits)) | successor
    del at
    by = np.argsort(key)
    key = key[by]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
    pair = np.add.reduceat(times[by], starts) if len(key) else np.zeros(0, np.int64)
    key = key[starts]
    kinds = np.bincount((key >> np.uint64(bits)).astype(np.int64), minlength=len(words))
    return words, kinds, key & np.uint64((1 << bits) - 1), pair


class Trie:
    """Levels of one shard: words with counts, pointers and back-off; their successors with probabilities.

    ``pointers`` ends each context's range of successors.  A successor is stored
    relative to its context: the last value of the range before plus the low
    bits of its hash, so that the whole level is one monotone sequence, and
    only who knows the range can tell what a value in it stands for.
    """

    def __init__(self, words: EliasFano, counts: EliasFano, pointers: EliasFano, successors: EliasFano,
                 backoff: np.ndarray, backoff_codes: np.ndarray, prob: np.ndarray, prob_codes: np.ndarray):
        self.words, self.successors = words, successors
        self.count_sums, self.pointers = counts, pointers
        self.backoff, self.backoff_codes, self.prob, self.prob_codes = backoff, backoff_codes, prob, prob_codes

    @classmethod
    def build(cls, context: np.ndarray, successor: np.ndarray, times: np.ndarray, bits: int = 24) -> Trie:
        """From context hashes, ``bits`` low bits of the successors' hashes, and how often the pair occurs."""
        return cls.of_sorted(*summed(context, successor, times, bits), bits)

    @classmethod
    def of_sorted(cls, words: np.ndarray, kinds: np.ndarray, low: np.ndarray, pair: np.ndarray, bits: int = 24) -> Trie:
        """From what :func:`summed` gives, also of one range of contexts after another."""
        if len(words) << bits >= 1 << 64:
            raise ValueError("too many words in one shard")
        of = np.repeat(np.arange(len(words), dtype=np.uint32), kinds)
        total = np.bincount(of, pair, len(words))
        prob, prob_codes = _codes(np.log10((pair - DISCOUNT) / total[of])) if len(low) else _codes(np.zeros(0))
        backoff, backoff_codes = _codes(np.log10(DISCOUNT * kinds / total)) if len(words) else _codes(np.zeros(0))
        sums, ends = np.cumsum(total).astype(np.uint64), np.cumsum(kinds).astype(np.uint64)
        # Each context has a successor, so the last of each range is there.
        bases = np.concatenate([np.zeros(1, np.uint64), np.cumsum(low[ends.astype(np.int64) - 1], dtype=np.uint64)])
        values = bases[of] + low
        del of
        return cls(EliasFano.build(words, 1 << 64), EliasFano.build(sums, int(sums[-1]) + 1 if len(sums) else 1),
                   EliasFano.build(ends, int(ends[-1]) + 1 if len(ends) else 1),
                   EliasFano.build(values, int(values[-1]) + 1 if len(values) else 1), backoff, backoff_codes, prob, prob_codes)

    def pack(self, levels: int = 2) -> bytes:
        """All levels in a row, each array after its length; with 1 only words and counts."""
        parts = [*self.words.arrays(), *self.count_sums.arrays()]
        if levels > 1:
            parts += [*self.pointers.arrays(), *self.successors.arrays(), self.backoff, self.backoff_codes, self.prob, self.prob_codes]
        out = []
        for p in parts:
            raw = p.tobytes()
            out += [len(raw).to_bytes(8, "little"), raw, bytes(-len(raw) % 8)]
        return b"".join(out)

    @classmethod
    def open(cls, blob: bytes) -> Trie:
        """Map the packed levels from a file that is gone when the mapping is."""
        file, path = tempfile.mkstemp(prefix="trie-")
        with os.fdopen(file, "wb") as f:
            f.write(blob)
        data = np.memmap(path, np.uint8, "r")
        os.unlink(path)
        parts, at = [], 0
        while at < len(data):
            n = int(data[at: at + 8].view(np.uint64)[0])
            parts.append(data[at + 8: at + 8 + n])
            at += 8 + n + -n % 8

        def sequence(k: int) -> EliasFano:
            n, bits = parts[k].view(np.uint64).tolist()
            return EliasFano(n, bits, *(parts[k + j].view(np.uint64) for j in (1, 2, 3)))
        more = [sequence(8), sequence(12), parts[16].view(np.float32), parts[17], parts[18].view(np.float32), parts[19]] \
            if len(parts) > 8 else [None] * 6
        return cls(sequence(0), sequence(4), *more)

    def counts(self, index: np.ndarray) -> np.ndarray:
        """Occurrences of the words at ``index``; 0 for -1."""
        out = np.zeros(len(index), np.int64)
        known = np.flatnonzero(index >= 0)
        out[known] = _step(self.count_sums, index[known])[1]
        return out

    def after(self, index: np.ndarray, runs: np.ndarray, successor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(log10 of the probability of a successor or of the back-off weight of its context, is it a successor)

        ``index``: contexts, each of the next ``runs`` successors.  An unknown
        context (-1) has a back-off weight of 1.
        """
        known = np.flatnonzero(index >= 0)
        begin, size = _step(self.pointers, index[known])
        base = np.where(begin > 0, self.successors.get(np.maximum(begin - 1, 0)), np.uint64(0)) if len(known) else np.zeros(0, np.uint64)
        out, at = np.zeros(len(successor)), np.full(len(successor), -1)
        asked = np.flatnonzero(np.repeat(index >= 0, runs))
        times = runs[known]
        at[asked] = self.successors.find(np.repeat(base, times) + successor[asked], np.repeat(begin, times), np.repeat(begin + size, times))
        seen = at >= 0
        out[seen] = self.prob[self.prob_codes[at[seen]]]
        context = np.repeat(index, runs)
        back = ~seen & (context >= 0)
        out[back] = self.backoff[self.backoff_codes[context[back]]]
        return out, seen


def _step(sums: EliasFano, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the sum before each index, what it adds) of running sums, by two accesses."""
    if not len(index):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.where(index > 0, sums.get(np.maximum(index - 1, 0)), np.uint64(0)).astype(np.int64)
    return before, sums.get(index).astype(np.int64) - before
