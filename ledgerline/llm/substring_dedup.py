"""Removal of repeated word windows by suffix automata of reference shards.

1. Every window of ``length`` words has an anchor: the leftmost smallest hash
   among its runs of ``ANCHOR_WORDS`` words.  Windows of a document that follow
   each other and share an anchor form a segment, so a document becomes some
   overlapping segments, each window in exactly one, and equal windows always
   lie under equal anchors.
2. Equal segments are counted, those of one batch of documents in the task that
   cuts them: they stay one row with a list of places, so a text with very many
   copies has a row a batch and not one a copy.  Segments under an anchor that occurs only once
   in the corpus are done with.  Of the others each distinct text is fetched
   once: this is the reference, dealt by anchor into shards of bounded size.
3. A shard goes to the task that builds its suffix automaton and streams the
   segments under the shard's anchors through it; other texts can't match it.
   Matching statistics of at least ``length`` words in a state with two or more
   occurrences (counting every copy) give a segment's repeated windows.
4. The span of words that these windows cover, one a segment, goes back to the
   batches that hold the segment, there to all its places, and is taken out of the
   documents.

Anchors under which very many distinct segments lie are split once more, window
by window, by a hash of the whole window; equal windows are found by their words.
Copies of a segment are told by two 64-bit hashes, of its anchor and of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import stored
from ledgerline.llm.rows import numbered
from ledgerline.llm.words import mixed, prefix_hashes, range_hashes, shingle_hashes, split_words, word_hashes

ANCHOR_WORDS = 8
#: Words of reference text for one automaton.
SHARD_WORDS = 60_000
#: Distinct segments of one anchor, beyond which it is split by window.
CROWDED = 1_000

#: The equal segments of one batch of documents: the first one's place, then all places.
SEGMENTS = "anchor long, seg long, batch long, times long, _row long, start int, n int, rows array<long>, starts array<int>"


def cut_segments(words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, segment hash, first word, number of words) of each segment of a document's word hashes."""
    if len(words) < length:
        e = np.zeros(0, np.int64)
        return e, e, e, e
    k = min(ANCHOR_WORDS, length)
    grams = shingle_hashes(words, k)
    windows = len(words) - length + 1
    at = sliding_window_view(grams, length - k + 1).argmin(axis=1) + np.arange(windows)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    size = np.diff(np.concatenate([first, [windows]])) + length - 1
    prefix, inverse = prefix_hashes(words)
    return grams[at[first]].view(np.int64), range_hashes(prefix, inverse, first, size).view(np.int64), first, size


def packed(parts: list[np.ndarray], batch: int) -> pa.RecordBatch:
    """One row (see ``SEGMENTS``) for the equal segments among anchors, segment hashes, rows, first words and sizes."""
    order = np.lexsort((parts[3], parts[2], parts[1], parts[0]))
    anchor, seg, row, start, size = (p[order] for p in parts)
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (seg[1:] != seg[:-1])]))
    ends = np.concatenate([first, [len(row)]])
    lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x)) for x in (row, start)]
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (anchor[first], seg[first], np.full(len(first), batch), np.diff(ends), row[first], start[first], size[first])] + lists,
        names=["anchor", "seg", "batch", "times", "_row", "start", "n", "rows", "starts"])


class SuffixAutomaton:
    """Of several word sequences, with the number of occurrences of each state's words."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len, self.count = [-1], [0], [0]

    def _state(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves), self.len.append(length), self.link.append(link), self.count.append(0)
        return len(self.len) - 1

    def _split(self, p: int, w: int, q: int) -> int:
        """A copy of q for the words that reach it from p and shorter suffixes."""
        nexts, link = self.next, self.link
        clone = self._state(self.len[p] + 1, link[q], nexts[q].copy())
        link[q] = clone
        while p >= 0 and nexts[p].get(w) == q:
            nexts[p][w] = clone
            p = link[p]
        return clone

    def add(self, words: list[int], times: int) -> None:
        last, nexts, link, length, count = 0, self.next, self.link, self.len, self.count
        for w in words:
            q = nexts[last].get(w)
            if q is not None:  # this far the words are known from another sequence
                last = q if length[q] == length[last] + 1 else self._split(last, w, q)
            else:
                cur = self._state(length[last] + 1, 0, {})
                p = last
                while p >= 0 and w not in nexts[p]:
                    nexts[p][w] = cur
                    p = link[p]
                if p >= 0:
                    q = nexts[p][w]
                    link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q)
                last = cur
            count[last] += times

    def finish(self) -> None:
        """Hand every state's occurrences on to its suffixes."""
        count, link = self.count, self.link
        for s in sorted(range(1, len(link)), key=self.len.__getitem__, reverse=True):
            count[link[s]] += count[s]

    def repeated(self, words: list[int], length: int) -> list[int]:
        """Starts of the windows of ``length`` words that occur twice or more."""
        out, s, matched = [], 0, 0
        nexts, link, lens, count = self.next, self.link, self.len, self.count
        for i, w in enumerate(words):
            while s and w not in nexts[s]:
                s = link[s]
                matched = lens[s]
            t = nexts[s].get(w)
            if t is not None:
                s, matched = t, matched + 1
            while link[s] >= 0 and lens[link[s]] >= length:
                s = link[s]
                matched = lens[s]
            if matched >= length and count[s] > 1:
                out.append(i - length + 1)
        return out


def remove_repeats(docs: DataFrame, length: int = 35, id_col: str = "doc_id", text_col: str = "text",
                   keep: list[str] | None = None, untouched_as_is: bool = False) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_text, and the columns ``keep``.

    Words are runs of characters other than [\\x20\\x09-\\x0D].  Every word that a
    repeated window of ``length`` words covers goes, in all places where the
    window occurs, the first included; kept words are joined by one space, with
    ``untouched_as_is`` only in texts that lose words.  A null text is empty.  Texts shorter than a window stay whole.  Repeated rows
    and rows with equal or null ids are documents of their own, so their windows
    repeat each other.  An empty table gives an empty result; columns not in
    ``keep`` are ignored, and kept ones must not be named like a result.
    """
    keep = list(keep or [])
    rows = numbered(docs, id_col, text_col, keep)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list = [[], [], [], [], []]
            ids = np.array(batch.column(0).to_pylist(), np.int64)
            for row, text in zip(ids, batch.column(1)):
                anchor, seg, first, size = cut_segments(word_hashes.of(split_words(text.as_py())), length)
                for to, part in zip(parts, (anchor, seg, np.full(len(first), row), first, size)):
                    to.append(part)
            if any(map(len, parts[0])):
                yield packed([np.concatenate(p).astype(t) for p, t in zip(parts, ("i8", "i8", "i8", "i4", "i4"))],
                             xxhash.xxh64_intdigest(ids.tobytes()) >> 1)

    found = stored(rows.select("_row", "_text").mapInArrow(segments, SEGMENTS), "segments")
    kinds = found.groupBy("anchor", "seg").agg(F.sum("times").alias("times"), F.min(F.struct("_row", "start", "n")).alias("at"))
    anchors = kinds.groupBy("anchor").agg(F.sum("times").alias("_all"), F.count("*").alias("_kinds")).where(F.col("_all") > 1)
    reference = stored(
        kinds.join(anchors, "anchor").select("anchor", "seg", "times", "at.*", (F.col("_kinds") > CROWDED).alias("crowded")), "reference-places")

    # The text of each distinct segment, from the first document that has it.
    wanted = reference.groupBy("_row").agg(F.collect_list(F.struct("anchor", "seg", "times", "start", "n", "crowded")).alias("_wanted"))
    texts = stored(rows.join(wanted, "_row").select("_text", "_wanted").mapInArrow(
        _fetch(length), "anchor long, seg long, part int, key long, window long, times long, words string, n int"), "reference")
    # Windows of crowded anchors are counted across the segments that hold them, by their words; a window alone can't repeat.
    windows = texts.where("part >= 0")
    split = windows.groupBy("key", "window", F.col("words").alias("same")).agg(F.sum("times").alias("times"), F.min("n").alias("n")) \
        .where("times > 1").withColumn("words", F.col("same"))
    pieces = texts.where("part < 0").select("key", "window", F.lit("").alias("same"), "times", "n", "words").unionByName(split)
    total = pieces.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // SHARD_WORDS))

    def stream(frame: pd.DataFrame) -> pd.DataFrame:
        ids: dict[str, int] = {}
        seqs = [[ids.setdefault(w, len(ids)) for w in x.split(" ")] for x in frame["words"]]
        automaton = SuffixAutomaton()
        for words, times in zip(seqs, frame["times"]):
            automaton.add(words, times)
        automaton.finish()
        starts = [automaton.repeated(words, length) for words in seqs]
        hit = [bool(x) for x in starts]
        out = frame.loc[hit, ["key", "window", "same"]]
        return out.assign(lo=[x[0] for x in starts if x], hi=[x[-1] + length for x in starts if x])

    matched = pieces.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards))).groupBy("shard") \
        .applyInPandas(stream, "key long, window long, same string, lo int, hi int")
    matched = stored(matched, "repeated")
    # Back to the segments that the windows are part of.  All windows of a segment hold its anchor, so any two of them
    # overlap, and the words that its repeated ones cover are one span.
    whole = texts.where("part < 0").select("anchor", "seg", "key", "window", F.lit("").alias("same"), F.lit(0).alias("part")).unionByName(
        windows.select("anchor", "seg", "key", "window", F.col("words").alias("same"), "part"))
    of_segment = whole.join(matched, ["key", "window", "same"]).groupBy("anchor", "seg").agg(
        F.min(F.col("lo") + F.col("part")).alias("lo"), F.max(F.col("hi") + F.col("part")).alias("hi"))
    hits = found.join(of_segment, ["anchor", "seg"]).groupBy("batch").agg(
        F.collect_list(F.struct("rows", "starts", "lo", "hi")).alias("_hits"))  # bounded by the batch of documents
    removed = hits.select("_hits").mapInArrow(_spans, "_row long, _spans array<int>")

    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType()),
                           *[docs.schema[c] for c in keep]])
    return rows.join(removed, "_row", "left").select("_id", "_text", "_spans", *keep).mapInArrow(_without(schema, untouched_as_is), schema)


def _fetch(length: int):
    """For mapInArrow on (_text, _wanted): the words of each wanted segment, or of its windows if the anchor is crowded."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "seg", "part", "key", "window", "times", "words", "n"]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32()]
        for batch in batches:
            out = []
            for text, wanted in zip(batch.column(0), batch.column(1)):
                words = (text.as_py() or "").encode().split()
                for w in wanted.as_py():
                    part = words[w["start"]: w["start"] + w["n"]]
                    if not w["crowded"]:
                        out.append((w["anchor"], w["seg"], -1, w["anchor"], w["seg"], w["times"], b" ".join(part).decode(), w["n"]))
                        continue
                    hashes = word_hashes.of(part)
                    prefix, inverse = prefix_hashes(hashes)
                    starts = np.arange(w["n"] - length + 1)
                    windows = range_hashes(prefix, inverse, starts, np.full(len(starts), length)).view(np.int64)
                    keys = mixed(windows.view(np.uint64) ^ np.uint64(w["anchor"] % 2**64)).view(np.int64)
                    for i in starts.tolist():
                        out.append((w["anchor"], w["seg"], i, int(keys[i]), int(windows[i]), w["times"],
                                    b" ".join(part[i: i + length]).decode(), length))
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
    return run


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For mapInArrow on (_hits), each the repeated segments of one batch of documents: the spans of each document."""
    for batch in batches:
        rows, starts, lo, hi = batch.column(0).flatten().flatten()
        if not len(rows):
            continue
        places = rows.value_lengths().to_numpy(zero_copy_only=False)
        row, start = rows.flatten().to_numpy(), starts.flatten().to_numpy()
        order = np.argsort(row, kind="stable")
        spans = np.stack([np.repeat(x.to_numpy(), places) + start for x in (lo, hi)], axis=1)[order].astype(np.int32)
        row = row[order]
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        ends = 2 * np.concatenate([first, [len(row)]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(row[first]), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(spans.ravel()))], names=["_row", "_spans"])


def _without(schema: T.StructType, as_is: bool):
    """For mapInArrow on (_id, _text, _spans): what is left of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, kept = [], [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                words = (text.as_py() or "").encode().split()
                stay = words
                if spans.is_valid:
                    ends = np.zeros(len(words) + 1, np.int64)
                    s = np.array(spans.as_py(), np.int64)
                    np.add.at(ends, s[::2], 1)
                    np.add.at(ends, s[1::2], -1)
                    stay = [w for w, c in zip(words, np.cumsum(ends)) if not c]
                n.append(len(words))
                removed.append(len(words) - len(stay))
                kept.append(text.as_py() if as_is and stay is words else b" ".join(stay).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()), *batch.columns[3:]],
                names=schema.names)
    return run
