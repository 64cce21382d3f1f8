"""Periodic runs of words by branching tandem repeats on an enhanced suffix array.

The documents of a batch lie one after another in one array of words; no suffix
is compared beyond its document.

1. Suffixes are sorted by rank doubling; a round sorts only the groups that are
   still tied.  The ranks of each round are kept: two stretches of 2**k words
   are equal where their ranks of round k are, which gives every longest common
   prefix in a few steps and makes the LCP array.
2. LCP intervals are bounds in the suffix array, found by range minima; there
   is no tree.  An interval of depth d splits into children where the LCP is d.
   For each suffix i of all children but the largest, i + d and i - d are looked
   up in the inverse suffix array: if they lie in the same interval, two equal
   halves of d words meet there.  Such a square is kept where it can't be
   shifted by a word to the right (it branches).
3. Each branching square is rotated to the left as far as the words repeat, and
   what has the same bounds is one run, with its smallest period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.words import split_words

#: Words and documents of one batch; a longer document is a batch of its own.
BATCH_WORDS, BATCH_DOCS = 120_000, 2048
#: Distinct words whose numbers a batch series keeps; beyond, its table starts anew with the next batch.
KEPT_WORDS = 400_000

RUNS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))


class Ranks:
    """Rank doubling over documents laid one after another.

    ``at[k][i]``: a number that equal stretches of 2**k words share; a stretch
    that runs over its document's end equals no other.
    """

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        """``words``: a number of each word; ``ends``: the end of the document that each word is in."""
        n = len(words)
        self.at: list[np.ndarray] = []
        last, tied, step = np.zeros(n, np.int32), np.arange(n), 0
        # Suffixes of one document stay together, so those of different ones are never tied.
        key = (ends << 32) | words
        while len(tied):
            if step:
                # The tied suffixes by what follows after ``step`` words; one that ends comes before any that goes on.
                behind = tied + step
                follow = np.where(behind < ends[tied], last[np.minimum(behind, n - 1)].astype(np.int64) + 1, 0)
                key = (last[tied].astype(np.int64) << 32) | follow
            by = np.argsort(key, kind="stable")
            tied, key = tied[by], key[by]
            # The new rank: the place of the first equal key, counted from the rank that the group had.
            new, group = np.ones(len(key), bool), np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            group[1:] = last[tied[1:]] != last[tied[:-1]]
            place = np.arange(len(key))
            first, start = (np.maximum.accumulate(np.where(x, place, 0)) for x in (new, group))
            rank = last.copy()
            rank[tied] = last[tied] + first - start
            self.at.append(rank)
            alone = new.copy()
            alone[:-1] &= new[1:]
            last, tied, step = rank, tied[~alone], step * 2 or 1
        self.suffixes = np.empty(n, np.int64)
        self.suffixes[last] = np.arange(n)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that the suffixes at a and b (different ones) have in common."""
        out, n = np.zeros(len(a), np.int64), len(self.suffixes)
        for k in range(len(self.at) - 1, -1, -1):
            x, y = a + out, b + out
            same = (x < n) & (y < n) & (self.at[k][np.minimum(x, n - 1)] == self.at[k][np.minimum(y, n - 1)])
            out[same] += 1 << k
        return out

    def common_before(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Words, at most ``limit``, that the stretches ending before a and b have in common."""
        out = np.zeros(len(a), np.int64)
        for k in range(len(self.at) - 1, -1, -1):
            more = out + (1 << k)
            ok = more <= limit
            same = ok & (self.at[k][np.where(ok, a - more, 0)] == self.at[k][np.where(ok, b - more, 0)])
            out[same] += 1 << k
        return out


def _range_minima(values: np.ndarray) -> list[np.ndarray]:
    """Minima of all stretches of 2**k values, by k, as far as a stretch without 0 can be that long."""
    out = [values]
    while len(out[-1]) > 1 << (len(out) - 1) and out[-1].any():
        half = 1 << (len(out) - 1)
        out.append(np.minimum(out[-1][:-half], out[-1][half:]))
    return out


def _reach(minima: list[np.ndarray], at: np.ndarray, depth: np.ndarray, above: np.ndarray | int, forward: bool) -> np.ndarray:
    """Number of values next to ``at`` (before or behind) that are all at least ``depth + above``."""
    n = len(minima[0])
    out = np.zeros(len(at), np.int64)
    least = depth + above
    for k in range(len(minima) - 1, -1, -1):
        size = 1 << k
        lo = at + 1 + out if forward else at - out - size
        ok = (lo >= 0) & (lo + size <= n)
        hit = ok & (minima[k][np.where(ok, lo, 0)] >= least) if len(minima[k]) else np.zeros(len(at), bool)
        out[hit] += size
    return out


def _spread(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the range, element) of all elements of the ranges."""
    which = np.repeat(np.arange(len(starts)), sizes)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, np.int64)
    return which, np.arange(len(which)) - first[which] + starts[which]


def branching_squares(words: np.ndarray, ends: np.ndarray, ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """(start, length of a half) of the squares that can't be shifted to the right by a word."""
    sa = ranks.suffixes
    isa = ranks.at[-1].astype(np.int64)
    n = len(sa)
    # lcp[x]: common words of the suffixes at places x - 1 and x.
    lcp = np.zeros(n, np.int64)
    near = np.flatnonzero(ranks.at[0][sa[1:]] == ranks.at[0][sa[:-1]]) + 1
    lcp[near] = ranks.common(sa[near - 1], sa[near])
    minima = _range_minima(lcp)

    # Each place with an LCP d > 0 parts two children of an interval of depth d.
    at = np.flatnonzero(lcp)
    depth = lcp[at]
    lo = at - _reach(minima, at, depth, 0, False) - 1
    hi = at + _reach(minima, at, depth, 0, True)
    # Children: behind each such place up to the next LCP of d or less, and from the interval's begin to its first place.
    right = _reach(minima, at, depth, 1, True) + 1
    key = lo * (n + 1) + hi
    by = np.lexsort((at, key))
    lead = by[np.concatenate([[True], key[by][1:] != key[by][:-1]])] if len(by) else by
    child_start = np.concatenate([at, lo[lead]])
    child_size = np.concatenate([right, at[lead] - lo[lead]])
    child_of = np.concatenate([key, key[lead]])
    source = np.concatenate([np.arange(len(at)), lead])
    # All but the largest child of each interval.
    by = np.lexsort((child_start, -child_size, child_of))
    small = np.ones(len(by), bool)
    small[by[np.concatenate([[True], child_of[by][1:] != child_of[by][:-1]])] if len(by) else by] = False
    which, place = _spread(child_start[small], child_size[small])
    source = source[small][which]
    i, d, lo, hi = sa[place], depth[source], lo[source], hi[source]

    starts, halves = [], []
    for left in (i, i - d):  # the square's first half at i, or its second
        ok = (left >= 0) & (left + d < n)
        other = np.where(ok, left + d if left is i else left, 0)
        ok &= (isa[other] >= lo) & (isa[other] <= hi)
        left, half = left[ok], d[ok]
        end = left + 2 * half
        open_ = end < ends[left]
        goes_on = open_ & (words[np.where(open_, end, 0)] == words[left + half])
        starts.append(left[~goes_on]), halves.append(half[~goes_on])
    return np.concatenate(starts), np.concatenate(halves)


def runs_of(words: np.ndarray, ends: np.ndarray, least: int = 6, times: int = 4) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of at least ``least`` words and ``times`` periods (two at least), by start and period."""
    if not len(words):
        return (np.zeros(0, np.int64),) * 3
    ranks = Ranks(words, ends)
    start, half = branching_squares(words, ends, ranks)
    if not len(start):
        return (np.zeros(0, np.int64),) * 3
    start, half = np.divmod(np.unique(start * (len(words) + 1) + half), len(words) + 1)
    begin = np.concatenate([[0], np.flatnonzero(ends[1:] != ends[:-1]) + 1])
    first = begin[np.searchsorted(begin, start, side="right") - 1]  # word of the document
    back = ranks.common_before(start, start + half, start - first)
    end = start + 2 * half
    start = start - back
    by = np.lexsort((half, end, start))
    start, end, half = start[by], end[by], half[by]
    keep = np.ones(len(start), bool)
    keep[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    length = end - start
    keep &= (length >= least) & (length >= times * half)
    start, length, half = start[keep], length[keep], half[keep]
    by = np.lexsort((half, start))
    return start[by], length[by], half[by]


class WordNumbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self)
        return k


def _collapsed(words: list[bytes], dropped: np.ndarray) -> str:
    return b" ".join([w for w, gone in zip(words, dropped.tolist()) if not gone] if dropped.any() else words).decode()


def find_runs(docs: DataFrame, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_words, runs (start, length, period; by start, then period), collapsed.

    Words are runs of characters other than [\\x20\\x09-\\x0D], numbered from 0.
    A run is a stretch of words with smallest period q, ``least`` words and
    ``times`` * q words at least, that no neighbouring word extends.
    ``collapsed`` is the text without the words that any run holds after its
    first q words, the others joined by one space.  A null, empty or blank text
    has no words, no runs and an empty result.  Texts of any length are searched
    whole.  Repeated rows and null ids come back as given, other columns (also
    ones named like a result) are ignored, an empty table gives an empty result.
    """
    if times < 2:
        raise ValueError("a run has two periods at least")
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()),
                           T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    run_type = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))

    def solve(ids: pa.Array, texts: list[list[bytes]], numbers: list[list[int]]) -> pa.RecordBatch:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        words = np.fromiter((x for w in numbers for x in w), np.int64, int(sizes.sum()))
        start, length, period = runs_of(words, np.repeat(ends, sizes), least, times)
        # A word goes if it lies between a run's first period and its end.
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, start + length, -1)
        gone = np.cumsum(change)[:-1] > 0
        doc = np.searchsorted(ends, start, side="right")
        cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
        flat = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (start - (ends - sizes)[doc], length, period)],
                                          names=["start", "length", "period"])
        runs = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), flat).cast(run_type)
        collapsed = [_collapsed(w, gone[e - n: e]) for w, e, n in zip(texts, ends.tolist(), sizes.tolist())]
        return pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), runs, pa.array(collapsed, pa.string())], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = WordNumbers()
        for batch in batches:
            texts, numbers, size, lo = [], [], 0, 0
            for k, text in enumerate(batch.column(1)):
                words = split_words(text.as_py())
                if texts and (size + len(words) > BATCH_WORDS or len(texts) >= BATCH_DOCS):
                    yield solve(batch.column(0).slice(lo, k - lo), texts, numbers)
                    texts, numbers, size, lo = [], [], 0, k
                    if len(number) > KEPT_WORDS:
                        number.clear()
                texts.append(words), numbers.append(list(map(number.__getitem__, words)))
                size += len(words)
            if texts:
                yield solve(batch.column(0).slice(lo), texts, numbers)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)
