"""Language-model scores from a sharded Elias-Fano n-gram trie (words and pairs).

Training: each task counts the pairs (word, next token) of its texts; words are
dealt over shards by hash, so all successors of a word meet in one shard, summed
already per batch of texts.  A shard's trie holds its words, their counts, and
their successors with quantised discounted probabilities (see ``elias_fano``).

Scoring: tasks send each batch's distinct pairs, with the documents that hold
them, to the shards; there the trie is mapped into memory, each pair is searched
once, and sums per document come back.  A pair that training doesn't have costs
the back-off weight of its word and the unigram probability of the next token.
The next token's count is at another shard, which answers the same batch since
the token is a context there: both answers, the pairs left and the counts of the
words asked for, meet where the batch is put together.  A batch and a shard thus
exchange one message each way, however many shards there are.

    p(c | b) = (C(bc) - D) / C(b)           if the pair bc was seen
             = (D T(b) / C(b)) p(c)         if only b was (T(b): its successors)
             = p(c) = (C(c) + 1) / (N + V + 1)   else

What p(c) gives to a word's seen successors stays unassigned, so the
probabilities of a context sum to at most 1.  A shard with much more than its
share of tokens is copied to several tasks, each with part of the batches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import stored
from ledgerline.llm.elias_fano import Trie, summed
from ledgerline.llm.rows import numbered
from ledgerline.llm.words import split_words, word_hashes

#: Stand for the start and the end of a text; no word holds a blank.
START, END = (np.uint64(xxhash.xxh64_intdigest(w)) for w in (b" start", b" end"))
#: Bytes of text for one shard, tokens and documents of one batch.
SHARD_BYTES, BATCH_TOKENS, BATCH_DOCS = 28_000_000, 1_500_000, 60_000
#: Pairs in messages that a shard sums at once: that of a very common word gets more of them than fit into memory.
SUM_PAIRS = 2_000_000
#: Where the ranges of words begin that a shard sums one after another.
RANGES = [np.uint64(k << 61) for k in range(8)]
#: Tokens that a shard searches at once, of as many messages as it takes: these get shorter with more shards.
AT_ONCE = 1 << 17

MESSAGE = "shard int, salt int, batch long, kind int, data binary"


def _join(*arrays: np.ndarray) -> bytes:
    """Arrays in a row, each after its number of bytes, compressed."""
    return zstandard.compress(b"".join(x for a in arrays for x in (a.nbytes.to_bytes(8, "little"), a.tobytes())), 1)


def _split(data: bytes, *types: str) -> list[np.ndarray]:
    data, out, at = zstandard.decompress(data), [], 0
    for t in types:
        n = int.from_bytes(data[at: at + 8], "little")
        out.append(np.frombuffer(data, t, n // np.dtype(t).itemsize, at + 8))
        at += 8 + n
    return out


def successor_bytes(size: int) -> int:
    """Bytes of its hash by which a word is told from other successors of one context, for ``size`` bytes of text.

    Three up to 2 GB and one more for 256 times as much, so that the widest
    context's share of false matches doesn't grow with the corpus.
    """
    return min(5, max(3, -(-(max(size, 1).bit_length() - 7) // 8)))


def _low_bytes(values: np.ndarray, n: int) -> np.ndarray:
    """``n`` bytes of each value."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n].ravel()


def _from_bytes(raw: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((len(raw) // n, 8), np.uint8)
    out[:, :n] = raw.reshape(-1, n)
    return out.view("<u8").ravel()


def _batches(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, whether each is learnt from, hashes of all tokens with starts and ends, document of each token).

    A text of more tokens than a batch holds goes on in the next batch, which
    repeats its last token as the first context.
    """
    rows, learn, parts, docs, size = [], [], [], [], 0
    for frame in frames:
        for row, text, use in zip(frame.column(0).to_pylist(), frame.column(1), frame.column(2).to_pylist()):
            words = word_hashes.of(split_words(text.as_py(), lower=True))
            tokens = np.concatenate([[START], words, [END]]).astype(np.uint64)
            while True:
                part, tokens = tokens[:BATCH_TOKENS], tokens[BATCH_TOKENS - 1:]
                docs.append(np.full(len(part), len(rows)))
                rows.append(row), learn.append(use), parts.append(part)
                size += len(part)
                if size >= BATCH_TOKENS or len(rows) >= BATCH_DOCS:
                    yield rows, np.array(learn), np.concatenate(parts), np.concatenate(docs)
                    rows, learn, parts, docs, size = [], [], [], [], 0
                if len(tokens) < 2:
                    break
    if rows:
        yield rows, np.array(learn), np.concatenate(parts), np.concatenate(docs)


def _counted(words: np.ndarray, runs: np.ndarray, following: np.ndarray, times: np.ndarray, wide: int) -> list[np.ndarray]:
    """Counts as a message holds them: ascending words, successors of each, their low bytes, how often (in a byte; larger ones aside)."""
    often = np.flatnonzero(times > 254)
    return [words, runs.astype("<u4"), _low_bytes(following, wide), np.minimum(times, 255).astype(np.uint8),
            often.astype("<u4"), times[often].astype("<i8")]


def _summed(parts: list[list[np.ndarray]], wide: int) -> tuple[np.ndarray, ...]:
    """What ``summed`` gives for all parts, one range of words after another."""
    return tuple(map(np.concatenate, zip(*(
        summed(*_pairs_of_range(parts, wide, lo, hi), 8 * wide) for lo, hi in zip(RANGES, [*RANGES[1:], None])))))


def _pairs_of_range(parts: list[list[np.ndarray]], wide: int, lo: np.uint64, hi: np.uint64 | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, successor, times) of the pairs in parts as of :func:`_counted` whose words lie from ``lo`` to ``hi``."""
    out = []
    for words, runs, raw, few, often, many in parts:
        a, b = int(np.searchsorted(words, lo)), len(words) if hi is None else int(np.searchsorted(words, hi))
        begin, n = int(runs[:a].sum()), int(runs[a:b].sum())
        times = few[begin: begin + n].astype(np.int64)
        x, y = np.searchsorted(often, (begin, begin + n))
        times[often[x:y] - begin] = many[x:y]
        out.append((np.repeat(words[a:b], runs[a:b]), _from_bytes(raw[begin * wide: (begin + n) * wide], wide), times))
    return tuple(map(np.concatenate, zip(*out)))


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Messages of what is written meanwhile leave the disk with it, not when the driver's garbage is collected."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _pairs(tokens: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, next token, document) of a batch."""
    inside = docs[1:] == docs[:-1]
    return tokens[:-1][inside], tokens[1:][inside], docs[1:][inside]


def _together(messages: Iterable[tuple[int, bytes]]) -> Iterator[list[tuple[int, list[np.ndarray]]]]:
    """(batch, parts of its message) in lists of about AT_ONCE tokens."""
    some, size = [], 0
    for batch, data in messages:
        some.append((batch, _split(data, "<u8", "<u4", "u1", "<u4", "<u2")))
        size += len(some[-1][1][4])
        if size >= AT_ONCE:
            yield some
            some, size = [], 0
    if some:
        yield some


def _cuts(arrays: Iterable[np.ndarray]) -> np.ndarray:
    """Where each array begins, and the last one ends, in all of them in a row."""
    return np.cumsum([0, *map(len, arrays)])


def _shard_cuts(words: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the words by shard and where each shard begins in it."""
    shard = (words % np.uint64(shards)).astype(np.int64)
    by = np.argsort(shard, kind="stable")
    return by, np.searchsorted(shard[by], np.arange(shards + 1))


def score_documents(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, learnt, n_tokens, n_known, train_tokens, base_score, score.

    ``learn`` tells which rows are learnt from; null means no.  Tokens are the
    runs of characters other than [\\x20\\x09-\\x0D], A-Z lower-cased, and one end
    of the text.  ``base_score`` is the sum of log10((c + 1) / (N + V + 1)) over
    the tokens (c: a token's count, N: all tokens, V: distinct ones learnt),
    ``score`` the model's log10 probability of the text, ``n_known`` the tokens
    with c > 0.  A null or blank text is one token, the end.  With nothing to
    learn from, N and V are 0 and both scores are 0.  Repeated rows count each.
    An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    marked = docs.withColumn("_learn", F.coalesce(learn, F.lit(False)))
    rows = numbered(marked, id_col, text_col, keep=["_learn"])
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    wide = successor_bytes(size)
    bits, low = 8 * wide, np.uint64((1 << 8 * wide) - 1)

    def count(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, learnt, tokens, of in _batches(frames):
            b, c, d = _pairs(tokens, of)
            b, c = b[learnt[d]], c[learnt[d]]
            words, rank = np.unique(b, return_inverse=True)
            key, times = np.unique((rank.astype(np.uint64) << np.uint64(bits)) | (c & low), return_counts=True)
            runs = np.bincount((key >> np.uint64(bits)).astype(np.int64), minlength=len(words))
            starts = np.concatenate([[0], np.cumsum(runs)])
            by, cuts = _shard_cuts(words, shards)
            out = []
            for shard, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                if hi > lo:
                    w = by[lo:hi]
                    at = _ranges(starts[w], runs[w])
                    out.append((shard, 0, 0, 0, _join(*_counted(words[w], runs[w], key[at] & low, times[at], wide))))
            if out:
                yield _messages(out)

    def build(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, most, waiting, size = [], 2 * SUM_PAIRS, [], 0
        for frame in frames:
            shard = frame["shard"].iloc[0]
            for data in frame["data"]:
                waiting.append(_split(data, "<u8", "<u4", "u1", "u1", "<u4", "<i8"))
                size += len(waiting[-1][3])
                if size >= SUM_PAIRS:
                    sums.append(_counted(*_summed(waiting, wide), wide))
                    waiting, size = [], 0
                    if sum(len(x[3]) for x in sums) >= most:
                        sums = [_counted(*_summed(sums, wide), wide)]
                        most = max(most, 2 * len(sums[0][3]))
        words, kinds, following, pair = _summed([*sums, *waiting], wide)
        trie = Trie.of_sorted(words, kinds, following, pair, bits)
        start = np.flatnonzero(words == START)
        begin = int(kinds[:start[0]].sum()) if len(start) else 0
        starts = int(pair[begin: begin + int(kinds[start[0]])].sum()) if len(start) else 0
        yield pd.DataFrame({"shard": [shard], "trie": [trie.pack()],
                            "tokens": [int(pair.sum()) - starts], "words": [trie.words.n - (starts > 0)], "texts": [starts]})

    source = rows.select("_row", "_text", "_learn")
    with _shuffles_dropped(spark):
        tries = stored(source.mapInArrow(count, MESSAGE).groupBy("shard").applyInPandas(
            build, "shard int, trie binary, tokens long, words long, texts long"), "tries")
    stats = tries.select("shard", "tokens", "words", "texts").collect()  # one row a shard
    texts = sum(r["texts"] for r in stats)
    n_all, v_all = sum(r["tokens"] for r in stats) + texts, sum(r["words"] for r in stats) + (texts > 0)
    bottom = np.log10(n_all + v_all + 1)
    share = max(1, sum(r["tokens"] for r in stats) // max(1, shards))
    copies = np.ones(shards, np.int64)
    for r in stats:
        copies[r["shard"]] = max(1, round((r["tokens"] + r["texts"]) / (2 * share)))

    def ask(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, (ids, learnt, tokens, of) in enumerate(_batches(frames)):
            ids, b, c, d = np.array(ids, np.int64), *_pairs(tokens, of)
            batch = xxhash.xxh64_intdigest(ids.tobytes(), seed=k) >> 1  # a long text may fill several batches
            sizes = np.bincount(of, minlength=len(ids)) - 1
            last = np.flatnonzero(np.diff(of, append=-1))
            cut_off = tokens[last][(tokens[last] != END) & ~learnt[of[last]]]  # no contexts here, the text goes on in the next batch
            known = np.bincount(d, learnt[d] & (b != START), len(ids)).astype(np.int64)  # training has all words of what is learnt
            out = [(batch % shards, 0, batch, 2, _join(ids, sizes, known))]
            for kind, side, more in ((0, learnt[d], cut_off[:0]), (1, ~learnt[d], cut_off)):
                out += _asked(b[side], c[side], d[side], more, kind, batch, shards, copies, wide)
            yield _messages(out)

    def answer(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        trie = Trie.open(right["trie"].iloc[0]) if len(right) else None
        out = [(batch, 2, data) for batch, kind, data in zip(left["batch"], left["kind"], left["data"]) if kind == 2]
        for kind in (0, 1):
            asked = left[left["kind"] == kind]
            for some in _together(zip(asked["batch"], asked["data"])):
                batches, parts = zip(*some)
                words, runs, raw, lengths, docs_of = map(np.concatenate, zip(*parts))
                following = raw.view("<u8") if kind else _from_bytes(raw, wide)
                at = trie.words.find(words) if trie else np.full(len(words), -1)
                counts = trie.counts(at) if trie else np.zeros(len(words), np.int64)
                value, seen = trie.after(at, runs.astype(np.int64), following & low) if trie else (np.zeros(len(following)), np.zeros(len(following), bool))
                pair = np.repeat(np.arange(len(following)), lengths)
                first = np.repeat(np.repeat(np.arange(len(words)), runs), lengths)
                known = (words != START) & (counts > 0)
                base = np.where(known, np.log10(counts + 1), 0.0)
                # The end's count is the number of learnt texts; other tokens left get theirs where the batch is put together.
                at_end = ~seen & (following == END) if kind else np.zeros(len(seen), bool)
                score = value - np.where(seen, 0, bottom) + np.where(at_end, np.log10(texts + 1), 0)
                # Documents are numbered one message after another.
                begins = np.cumsum([0, *(int(p[4].max()) + 1 if len(p[4]) else 0 for p in parts)])
                doc = docs_of + np.repeat(begins[:-1], [len(p[4]) for p in parts])
                n = int(begins[-1])
                here = np.bincount(doc, minlength=n) > 0
                cuts = np.searchsorted(np.flatnonzero(here), begins)
                sums = [np.bincount(doc, w, n)[here].astype(t) for w, t in ((score[pair], "<f4"), (base[first], "<f8"))]
                if kind:
                    sums.append(np.bincount(doc, known[first], n)[here].astype("<u4"))
                bodies = [[np.packbits(here[begin:end]), *(x[lo:hi] for x in sums)]
                          for begin, end, lo, hi in zip(begins, begins[1:], cuts, cuts[1:])]
                if kind:
                    rest = np.flatnonzero(~seen & ~at_end)
                    rest_cuts = np.searchsorted(rest, _cuts(p[3] for p in parts))
                    rest_docs = docs_of[(~seen & ~at_end)[pair]]
                    doc_cuts = np.concatenate([[0], np.cumsum(lengths[rest], dtype=np.int64)])[rest_cuts]
                    held_words = np.flatnonzero(known)
                    word_cuts = np.searchsorted(held_words, _cuts(p[0] for p in parts))
                    for k, body in enumerate(bodies):
                        r, w = rest[rest_cuts[k]: rest_cuts[k + 1]], held_words[word_cuts[k]: word_cuts[k + 1]]
                        body += [following[r], lengths[r], rest_docs[doc_cuts[k]: doc_cuts[k + 1]], words[w], counts[w].astype("<i8")]
                out += [(batch, kind, _join(*body)) for batch, body in zip(batches, bodies)]
        return pd.DataFrame(out, columns=["batch", "kind", "data"])

    # One row a shard and copy, so it may be sent to all tasks; the tries themselves stay where they are.
    deals = spark.createDataFrame([(s, k) for s in range(shards) for k in range(int(copies[s]))], "shard int, salt int")
    held = tries.join(F.broadcast(deals), "shard")
    answers = source.mapInArrow(ask, MESSAGE).groupBy("shard", "salt").cogroup(
        held.select("shard", "salt", "trie").groupBy("shard", "salt")).applyInPandas(
            lambda left, right: answer(left, right) if len(left) else _nothing(), "batch long, kind int, data binary")

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        ids, sizes, known = _split(frame[frame["kind"] == 2]["data"].iloc[0], "<i8", "<i8", "<i8")
        total, left = [np.zeros(len(ids)), np.zeros(len(ids)), known.copy()], []
        for kind, data in zip(frame["kind"], frame["data"]):
            if kind == 2:
                continue
            bits, *parts = _split(data, "u1", "<f4", "<f8", *(("<u4", "<u8", "<u4", "<u2", "<u8", "<i8") if kind else ()))
            d = np.flatnonzero(np.unpackbits(bits))
            for t, s in zip(total, parts):
                t[d] += s
            if kind:
                left.append(parts[3:])
        if left:
            following, lengths, docs_of, words, counts = map(np.concatenate, zip(*left))
            by = np.argsort(words)
            words, counts = np.append(words[by], np.uint64(0)), np.append(counts[by], 0)  # words that training doesn't have are left out
            at = np.searchsorted(words[:-1], following)
            times = np.where(words[at] == following, counts[at], 0)
            total[0] += np.bincount(docs_of, np.repeat(np.log10(times + 1), lengths), len(ids)).astype("<f4")  # as all sums of scores are
        return pd.DataFrame({"_row": ids, "n": sizes, "known": total[2], "base": total[1], "model": total[0]})

    with _shuffles_dropped(spark):
        per_batch = stored(answers.groupBy("batch").applyInPandas(
            finish, "_row long, n long, known long, base double, model double"), "scores")
    of_row = per_batch.groupBy("_row").agg(*[F.sum(c).alias(c) for c in ("n", "known", "base", "model")])
    ends = (1, float(np.log10(texts + 1))) if texts else (0, 0.0)
    return rows.select("_row", "_id", "_learn").join(of_row, "_row").select(
        F.col("_id").alias(id_col), F.col("_learn").alias("learnt"), F.col("n").alias("n_tokens"),
        (F.col("known") + F.lit(ends[0])).alias("n_known"), F.lit(int(n_all)).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(ends[1]) - F.col("n") * F.lit(float(bottom))).alias("base_score"), F.col("model").alias("score"))


def _nothing() -> pd.DataFrame:
    return pd.DataFrame({"batch": [], "kind": [], "data": []})


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)],
                                      names=["shard", "salt", "batch", "kind", "data"])


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices of the ranges, one range after another."""
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return np.arange(lengths.sum()) + shift


def _asked(b: np.ndarray, c: np.ndarray, d: np.ndarray, more: np.ndarray, kind: int, batch: int, shards: int, copies: np.ndarray, wide: int) -> list[tuple]:
    """Messages with the distinct pairs of a batch and the documents of each occurrence; ``more``: words without a pair."""
    if not len(b):
        return []
    words, rank = np.unique(np.concatenate([b, more]), return_inverse=True)
    rank = rank[:len(b)]
    if kind == 0:
        c = c & np.uint64((1 << 8 * wide) - 1)
    short = kind == 0 and wide <= 4  # then the bits themselves fit into the key
    nexts, c_rank = (c, None) if short else np.unique(c, return_inverse=True)
    key = (rank.astype(np.uint64) << np.uint64(32)) | (nexts if short else c_rank.astype(np.uint64))
    by_doc = np.argsort(key)  # the order of a pair's documents doesn't matter
    key = key[by_doc]
    pair_start = np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1])
    lengths = np.diff(np.concatenate([pair_start, [len(key)]]))
    pairs_of = np.bincount((key[pair_start] >> np.uint64(32)).astype(np.int64), minlength=len(words))
    following = key[pair_start] & np.uint64(0xFFFFFFFF)
    following = following if short else nexts[following.astype(np.int64)]
    docs_sorted = d[by_doc].astype("<u2")
    first_pair = np.concatenate([[0], np.cumsum(pairs_of)])
    first_doc = np.concatenate([[0], np.cumsum(lengths)])
    by, cuts = _shard_cuts(words, shards)
    out = []
    for shard, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        if hi <= lo:
            continue
        w = by[lo:hi]
        p = _ranges(first_pair[w], pairs_of[w])
        docs_at = _ranges(first_doc[p], lengths[p])
        out.append((shard, int(batch % copies[shard]), batch, kind, _join(
            words[w], pairs_of[w].astype("<u4"), _low_bytes(following[p], wide if kind == 0 else 8),
            lengths[p].astype("<u4"), docs_sorted[docs_at])))
    return out
