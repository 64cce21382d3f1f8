"""SentencePiece BPE by vectorised merge rounds over flat symbol arrays.

All new words of a batch lie one after another in one numpy array of symbols,
cut into segments that no piece can cross.  In each round the smallest rank of
a segment's adjacent pairs is found (a segmented minimum), all its leftmost
non-overlapping pairs of that rank are merged at once, and the array is
compacted; segments without any pair leave it.  Merging one pair at a time from
the left gives the same symbols unless a merge makes a pair of equal or smaller
rank; in such a round the segment merges its leftmost pair only.

Distinct words are encoded once and kept in a bounded table per worker.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import at_work

KEPT_WORDS = 400_000
ROWS_AT_ONCE = 512
#: Segments of more symbols take the same merges through a heap: rounds over one very long segment would be quadratic.
LONG_SEGMENT = 2048
NO_RANK = np.int32(1 << 30)
#: The letter that stands for a blank.  Fixed value.
BLANK = "▁"
#: Texts whose ids must equal the library's before a model is used.
PROBES = ["", " ", "  a  b ", "A\n\n\tb\x00", "▁x ▁▁", "<s> </s> <unk> <0x41>", "é ﬁ \U0001F600͸", "      if x:"]


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _utf8(raw: bytes) -> str:
    """The text of bytes; U+FFFD for each byte that belongs to no character."""
    out = ""
    while True:
        try:
            return out + raw.decode()
        except UnicodeDecodeError as e:
            out += raw[:e.start].decode() + "�"
            raw = raw[e.start + 1:]


class PieceBpe:
    """Encoder and decoder of one model: BPE, blanks escaped and one put before the text, no other normalising, byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        library = SentencePieceProcessor(model_file=path)
        n = self.size = library.vocab_size()
        self.piece = [library.id_to_piece(i) for i in range(n)]
        self.byte = {i: int(self.piece[i][3:5], 16) for i in range(n) if library.is_byte(i)}
        self.silent = {i for i in range(n) if library.is_control(i)}
        usual = [i for i in range(n) if i not in self.byte and i not in self.silent and not library.is_unknown(i)]
        self.byte_id = {b: i for i, b in self.byte.items()}
        id_of = {self.piece[i]: i for i in usual}

        self.symbol_of = np.arange(n, n + 0x110000, dtype=np.int32)  # letters without a piece: n + code point
        for p, i in id_of.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = i
        # Equal scores are equal ranks; the highest score is rank 0.
        rank_of = {s: k for k, s in enumerate(sorted({library.get_score(i) for i in usual}, reverse=True))}
        pairs = {}
        for p, i in id_of.items():
            for k in range(1, len(p)):
                a, b = id_of.get(p[:k]), id_of.get(p[k:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (rank_of[library.get_score(i)], i)
        self.pairs = pairs
        keys = np.fromiter(pairs, np.int64, len(pairs))
        order = keys.argsort()
        values = np.array(list(pairs.values()), np.int32).reshape(-1, 2)[order]
        # One entry behind the last stands for "no pair".
        self.pair_keys = np.append(keys[order], np.int64(1) << 62)
        self.pair_ranks = np.append(values[:, 0], NO_RANK)
        self.pair_merged = np.append(values[:, 1], np.int32(-1))
        self.none = len(keys)
        inside = {ord(x) << 32 | ord(y) for p in id_of if len(p) > 1 for x, y in zip(p, p[1:])}
        self.neighbours = np.array(sorted(inside) + [1 << 62], np.int64)

        # Words are cut where no piece goes on: before a blank behind another letter, and around line ends.
        pieces = [p for p in id_of if len(p) > 1]
        ends = "" if any("\n" in p for p in pieces) else "\n"
        if any(x != BLANK and y == BLANK for p in pieces for x, y in zip(p, p[1:])):
            self.split = re.compile(f"[^{ends}]+|{ends}+" if ends else "(?s:.+)")
        else:
            self.split = re.compile(f"{BLANK}+[^{BLANK}{ends}]*|[^{BLANK}{ends}]+" + (f"|{ends}+" if ends else ""))
        self.ids_of: dict[str, str] = {}
        self.text_of: dict[str, str] = {}
        if [self.encode(t) for t in PROBES] != [list(library.encode(t)) for t in PROBES]:
            raise ValueError(f"{path}: not a BPE model with escaped blanks, a blank before the text and byte fallback only")

    def _look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of each pair of symbols among the pairs; ``none`` where there is none."""
        key = a.astype(np.int64) << 32 | b.astype(np.int64)
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[np.minimum(at, self.none)] == key, at, self.none).astype(np.int32)

    def merge_segments(self, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of each left symbol's first letter, symbol) after all merges.

        ``first`` marks the letters that begin a segment.
        """
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int32))]
        place, symbol, segment = np.arange(len(symbols)), symbols, np.cumsum(first) - 1
        sizes = np.bincount(segment)
        for s in np.flatnonzero(sizes > LONG_SEGMENT):
            lo = int(np.searchsorted(segment, s))
            out.append(self._merge_long(symbols[lo: lo + sizes[s]].tolist(), lo))
        if (sizes > LONG_SEGMENT).any():
            short = (sizes <= LONG_SEGMENT)[segment]
            place, symbol, segment = place[short], symbol[short], segment[short]

        pair = np.full(len(symbol), self.none, np.int32)  # of each symbol with the next one
        same = segment[1:] == segment[:-1]
        pair[:-1][same] = self._look(symbol[:-1][same], symbol[1:][same])
        while len(symbol):
            rank = self.pair_ranks[pair]
            begin = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
            least = np.minimum.reduceat(rank, begin)
            length = np.diff(np.append(begin, len(symbol)))
            if (least == NO_RANK).any():
                over = np.repeat(least == NO_RANK, length)
                out.append((place[over], symbol[over]))
                place, symbol, segment, pair, rank = (x[~over] for x in (place, symbol, segment, pair, rank))
                length, least = length[least < NO_RANK], least[least < NO_RANK]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(least, length))
            # Of pairs that overlap, every second one from the left.
            fresh = np.concatenate([[True], at[1:] != at[:-1] + 1])
            run = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            made = self.pair_merged[pair[at]]

            # What each merge puts side by side, with merges on its left done and those on its right not.
            low, mine = rank[at], segment[at]
            left = symbol[at - 1]
            behind = np.flatnonzero(at[1:] == at[:-1] + 2) + 1
            left[behind] = made[behind - 1]
            has_left = (at > 0) & (segment[at - 1] == mine)
            after = np.minimum(at + 2, len(symbol) - 1)
            has_right = (at + 2 < len(symbol)) & (segment[after] == mine)
            early = has_left & (self.pair_ranks[self._look(left, made)] <= low)
            early |= has_right & (self.pair_ranks[self._look(made, symbol[after])] <= low)
            if early.any():
                alone = np.isin(mine, mine[early])
                leftmost = np.concatenate([[True], mine[1:] != mine[:-1]])
                at, made = at[~alone | leftmost], made[~alone | leftmost]

            symbol = symbol.copy()
            symbol[at] = made
            stay = np.ones(len(symbol), bool)
            stay[at + 1] = False
            place, symbol, segment, pair = place[stay], symbol[stay], segment[stay], pair[stay]
            at = at - np.arange(len(at))
            for k in (at, at[at > 0] - 1):
                k = k[k + 1 < len(symbol)]
                pair[k] = np.where(segment[k] == segment[k + 1], self._look(symbol[k], symbol[k + 1]), self.none)
            pair[-1] = self.none
        place, symbol = (np.concatenate(x) for x in zip(*out))
        order = place.argsort(kind="stable")
        return place[order], symbol[order]

    def _merge_long(self, parts: list[int], lo: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(parts)
        after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
        heap = [(r[0], i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := self.pairs.get(a << 32 | b))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], gone[j], after[i] = self.pairs[a << 32 | b][1], True, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.pairs.get(parts[x] << 32 | parts[y])):
                    heapq.heappush(heap, (r[0], x, parts[x], parts[y]))
        left = np.flatnonzero(~np.array(gone))
        return left + lo, np.array(parts, np.int32)[left]

    def learn(self, words: list[str]) -> list[list[int]]:
        """Ids of each word (not empty, blanks escaped)."""
        if not words:
            return []
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        starts = np.cumsum([0, *map(len, words)])
        first = np.ones(len(points), bool)
        both = points[:-1] << 32 | points[1:]
        first[1:] = self.neighbours[np.searchsorted(self.neighbours, both)] != both
        first[starts[:-1]] = True
        place, symbol = self.merge_segments(self.symbol_of[points], first)
        cuts = np.searchsorted(place, starts).tolist()
        symbol = symbol.tolist()
        return [self._with_bytes(symbol[lo:hi]) for lo, hi in zip(cuts, cuts[1:])]

    def _with_bytes(self, symbols: list[int]) -> list[int]:
        if max(symbols) < self.size:
            return symbols
        out = []
        for s in symbols:
            out += [s] if s < self.size else [self.byte_id[b] for b in chr(s - self.size).encode()]
        return out

    def _words(self, text: str) -> list[str]:
        return self.split.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.learn(self._words(text)) for i in ids]

    def _text(self, ids: list[int]) -> str:
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte:
                raw.append(self.byte[i])
                continue
            if raw:
                out.append(_utf8(bytes(raw)))
                raw.clear()
            if i not in self.silent:
                out.append(self.piece[i])
        if raw:
            out.append(_utf8(bytes(raw)))
        return "".join(out).replace(BLANK, " ")

    def decode(self, ids: list[int]) -> str:
        """The text of ids that :meth:`encode` gives: without the blank that encoding puts before it."""
        return self._text(ids).removeprefix(" ")

    def both(self, texts: list[str]) -> tuple[list[int], list[str], list[str]]:
        """Of each text: number of ids, decimal ids joined by commas, decoded text."""
        if len(self.ids_of) > KEPT_WORDS:
            self.ids_of.clear(), self.text_of.clear()
        words = [self._words(t) for t in texts]
        new = list(set().union(*words).difference(self.ids_of))
        for word, ids in zip(new, self.learn(new)):
            self.ids_of[word] = ",".join(map(str, ids))
            self.text_of[word] = self._text(ids)
        ids = [",".join(map(self.ids_of.__getitem__, w)) for w in words]
        return ([x.count(",") + 1 if x else 0 for x in ids], ids,
                ["".join(map(self.text_of.__getitem__, w)).removeprefix(" ") for w in words])


_made: dict[str, PieceBpe] = {}


def piece_bpe(path: str | None) -> PieceBpe:
    path = path or default_path()
    at_work("piece_bpe", _made.clear)
    if path not in _made:
        _made[path] = PieceBpe(path)
    return _made[path]


def encode_documents(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, ids (decimal, joined by commas), decoded.

    A null or empty text has no tokens and two empty strings; a text of blanks
    is encoded like any other.  Texts of any length are encoded whole.  Repeated
    rows and null ids come back as given, other columns (also ones named like a
    result) are ignored, an empty table gives an empty result.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.StringType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = piece_bpe(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(lo, ROWS_AT_ONCE)
                n, ids, text = bpe.both([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(text, pa.string())],
                    names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n_tokens and the SHA-256 of the ids and of the decoded text of :func:`encode_documents`."""
    return encoded.select(
        id_col, "n_tokens", F.sha2(F.col("ids").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
