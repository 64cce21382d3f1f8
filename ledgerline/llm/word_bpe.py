"""BPE with word ends by a contiguous rank array.

A short word is a row of part ids (its boundaries) beside a row with the rank of
each adjacent pair.  The smallest rank is found by a scan, the boundary inside
that pair is deleted, and the ranks of its two neighbours are looked up anew,
until no pair has a rank.  New words of a batch go through these steps together,
as the rows of two arrays.  Words over ``LONG_WORD`` parts use the same merges
through a heap, which keeps them from taking quadratic time.

Distinct chunks between white space are encoded once and kept in a bounded
table per worker.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import at_work

LONG_WORD = 64
KEPT_CHUNKS = 600_000
ROWS_AT_ONCE = 1024
NO_RANK = 1 << 60

#: Chunks of these characters need no normalising but lower-casing, and have the same classes in every Unicode version.
_PLAIN = re.compile(r"[\x21-\x7e\xc0-įı-ſ]*")
#: The file's pattern, for chunks of such characters.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_CONTROLS = re.compile("[\x1c-\x1f]")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 for itself, the rest from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class WordBpe:
    """Encoder and decoder of one tokenizer file (BPE, byte letters, a word-end suffix)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.token = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.final = [vocab[c + suffix] for c in letters]
        self.rank: dict[tuple[int, int], int] = {}
        merged = []
        for k, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank.setdefault((vocab[a], vocab[b]), k)
            merged.append(vocab[a + b])
        self.merged = np.array(merged)
        keys = np.array([(a << 32) | b for a, b in self.rank], np.int64)
        order = keys.argsort()
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(self.rank.values()))[order]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        library = Tokenizer.from_file(path)
        self.normalize, self.pre = library.normalizer, library.pre_tokenizer
        self.unletter = {c: b for b, c in enumerate(letters)}
        self.ids_of: dict[str, str] = {}
        self.words: dict[bytes, list[int]] = {}
        self.number = {i: str(i) for i in self.token}
        self.text_of: dict[str, str] = {}

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids; NO_RANK where there is none (a negative id: no part)."""
        key = (a.astype(np.int64) << 32) | b.astype(np.int64)
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_ranks[at], NO_RANK)

    def merge_rows(self, parts: np.ndarray) -> np.ndarray:
        """Rows of part ids, filled up with -1, after all merges: lowest rank first, leftmost of equals."""
        done = np.full_like(parts, -1)
        rows = np.arange(len(parts))
        ranks = self.ranks(parts[:, :-1], parts[:, 1:])
        while len(rows):
            at = ranks.argmin(axis=1)
            low = ranks[np.arange(len(rows)), at]
            over = low == NO_RANK
            if over.any():
                done[rows[over], :parts.shape[1]] = parts[over]
                keep = ~over
                rows, parts, ranks, at, low = rows[keep], parts[keep], ranks[keep], at[keep], low[keep]
                if not len(rows):
                    break
            n, width = np.arange(len(rows)), parts.shape[1]
            later = np.arange(width - 1) > at[:, None]  # what lies after the boundary moves one place to the left
            parts[n, at] = self.merged[low]
            parts = np.where(later, parts[:, 1:], parts[:, :-1])
            ranks = np.where(later[:, :-1], ranks[:, 1:], ranks[:, :-1])
            if not ranks.shape[1]:
                done[rows, :1] = parts
                break
            for left in (at - 1, at):
                some = (left >= 0) & (left < ranks.shape[1])
                r, c = n[some], left[some]
                ranks[r, c] = self.ranks(parts[r, c], parts[r, c + 1])
        return done

    def learn(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word's bytes."""
        out: list = [None] * len(words)
        by_width: dict[int, list[int]] = {}
        for k, w in enumerate(words):
            n = len(w)
            if n == 1:
                out[k] = [self.final[w[0]]]
            elif n > LONG_WORD:
                out[k] = self._merge_long([*(self.inner[b] for b in w[:-1]), self.final[w[-1]]])
            else:
                by_width.setdefault(4 if n <= 4 else 8 if n <= 8 else 12 if n <= 12 else 16 if n <= 16 else 32 if n <= 32 else LONG_WORD, []).append(k)
        inner, final = np.array(self.inner), np.array(self.final)
        for width, ks in by_width.items():
            sizes = np.array([len(words[k]) for k in ks])
            raw = np.frombuffer(b"".join(words[k].ljust(width, b"\0") for k in ks), np.uint8).reshape(-1, width)
            parts = np.where(np.arange(width) < sizes[:, None], inner[raw], -1)
            n = np.arange(len(ks))
            parts[n, sizes - 1] = final[raw[n, sizes - 1]]
            for k, row in zip(ks, self.merge_rows(parts).tolist()):
                out[k] = row[:row.index(-1)] if row[-1] < 0 else row
        return out

    def _merge_long(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after, before, gone = list(range(1, n + 1)), list(range(-1, n - 1)), [False] * n
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := self.rank.get((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if gone[i] or j >= n or parts[i] != a or parts[j] != b:
                continue
            parts[i], gone[j], after[i] = int(self.merged[r]), True, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (q := self.rank.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (q, x, parts[x], parts[y]))
        return [p for p, g in zip(parts, gone) if not g]

    def _words(self, text: str) -> list[bytes | int]:
        """The bytes of the words that the tokenizer splits a text into; added tokens as their ids."""
        if text.isascii() and text.isalpha():
            return [text.lower().encode()]
        if "<|" not in text and _PLAIN.fullmatch(text):
            return [w.encode() for w in _WORDS.findall(text.lower())]
        out: list[bytes | int] = []
        parts = self.split_added.split(text) if self.split_added else [text]
        for k, part in enumerate(parts):
            if k % 2:
                out.append(self.added[part])
            elif part:
                if self.normalize is not None:
                    part = self.normalize.normalize_str(part)
                out += [bytes(self.unletter[c] for c in w) for w, _ in self.pre.pre_tokenize_str(part)]
        return out

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text; added tokens in it count as such."""
        split = [self._words(t) for t in texts]
        new = list({w for ws in split for w in ws if not isinstance(w, int) and w not in self.words})
        self.words.update(zip(new, self.learn(new)))
        known = self.words
        return [known[ws[0]] if len(ws) == 1 and ws[0] in known else
                [i for w in ws for i in ((w,) if isinstance(w, int) else known[w])] for ws in split]

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.token[i] for i in ids])

    def both(self, texts: list[str]) -> tuple[list[int], list[str], list[str]]:
        """Of each text: number of ids, decimal ids joined by one space, decoded text."""
        if len(self.ids_of) > KEPT_CHUNKS:
            self.ids_of.clear(), self.text_of.clear(), self.words.clear()
        # Python takes some controls for white space that the tokenizer doesn't; such texts stay whole.
        chunks = [[t] if _CONTROLS.search(t) else t.split() for t in texts]
        new = list(set().union(*chunks).difference(self.ids_of))
        number = self.number
        for chunk, ids in zip(new, self.encode_many(new)):
            self.ids_of[chunk] = " ".join([number[i] for i in ids])
            self.text_of[chunk] = self.decode(ids)
        ids = [" ".join(map(self.ids_of.__getitem__, c)) for c in chunks]
        return [x.count(" ") + 1 if x else 0 for x in ids], ids, [" ".join(map(self.text_of.__getitem__, c)) for c in chunks]


_made: dict[str, WordBpe] = {}


def word_bpe(path: str | None) -> WordBpe:
    path = path or default_path()
    at_work("word_bpe", _made.clear)
    if path not in _made:
        _made[path] = WordBpe(path)
    return _made[path]


def encode_documents(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_tokens, ids (decimal, joined by one space), decoded.

    A null or blank text has no tokens and two empty strings.  Repeated rows and
    null ids come back as given, other columns are ignored, an empty table
    gives an empty result.
    """
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.StringType()), T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(tokenizer)
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
