"""Packing token pieces into sequences by exact complements.

Only the histogram of piece lengths matters for the plan, and it has at most
``limit`` entries whatever the input's size.  The plan works on its counts:

1. Longest first, a length's gap is looked up among single lengths, then in an
   index of pair sums, then as one length plus a pair.  A combination that fills
   the gap exactly is used as often as the counts of its lengths allow.
2. What has no exact complement is packed best-fit decreasing, again many equal
   sequences at a time.

The plan is a list of patterns with multiplicities.  Each place in a pattern
claims a range of ranks among the pieces of its length.  Spark ranks the pieces
(range partitions of length and keys, with prefix sums of their counts, so that a
hot length spreads), and each piece finds its place by a binary search.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import shuffle_partitions, stored


def plan_patterns(counts: dict[int, int], limit: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths (each summing to at most ``limit``) and how often each is used; every piece has one place."""
    left = Counter({k: v for k, v in counts.items() if v > 0})
    patterns: list[tuple[tuple[int, ...], int]] = []

    def use(lengths: tuple[int, ...]) -> int:
        need = Counter(lengths)
        times = min(left[k] // n for k, n in need.items())
        if times:
            patterns.append((lengths, times))
            for k, n in need.items():
                left[k] -= n * times
        return times

    def alive() -> list[int]:
        return sorted(k for k, v in left.items() if v > 0)

    def pairs_of(total: int) -> list[tuple[int, int]]:
        """Pairs with this sum; those with a length that is used up are taken out for good."""
        pairs[total] = [p for p in pairs.get(total, ()) if left[p[0]] and left[p[1]]]
        return pairs[total]

    use((limit,))
    for a in reversed(alive()):  # singles
        if left[a] and left[limit - a]:
            use((a, limit - a))
    # Pair sums of the lengths that are left, with the pairs that make them.
    kinds = alive()
    pairs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for i, b in enumerate(kinds):
        for c in kinds[i:]:
            if b + c >= limit:
                break
            pairs[b + c].append((c, b))
    for a in reversed(kinds):
        for b, c in sorted(pairs_of(limit - a), reverse=True):
            if not left[a]:
                break
            use((a, b, c))
    for a in reversed(kinds):  # triples: one length and a pair
        if not left[a]:
            continue
        gap = limit - a
        for b in reversed([k for k in kinds if k <= gap]):
            if not left[a]:
                break
            if left[b]:
                for c, d in pairs_of(gap - b):
                    if not left[a] or not left[b]:
                        break
                    if c <= b and left[c] and left[d]:
                        use((a, b, c, d))

    # Best fit, longest first; sequences with equal contents are one entry.
    gaps: list[int] = []
    open_at: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)

    def put(lengths: tuple[int, ...], times: int) -> None:
        gap = limit - sum(lengths)
        if not open_at[gap]:
            insort(gaps, gap)
        open_at[gap].append((lengths, times))

    for a in reversed(alive()):
        rest = left[a]
        while rest:
            at = bisect_left(gaps, a)
            if at < len(gaps):
                gap = gaps[at]
                lengths, times = open_at[gap].pop()
                if not open_at[gap]:
                    gaps.pop(at)
                k = min(times, rest)
                if times > k:
                    put(lengths, times - k)
                put((*lengths, a), k)
                rest -= k
            else:
                each = limit // a
                if rest >= each:
                    put((a,) * each, rest // each)
                    rest %= each
                else:
                    put((a,) * rest, 1)
                    rest = 0
    return patterns + [x for held in open_at.values() for x in held]


class Places:
    """Of each length: the first rank of every place, ascending, with its first sequence and its offset."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]]):
        held: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
        taken, sequence = Counter(), 0
        for lengths, times in patterns:
            offset = 0
            for a in lengths:
                held[a].append((taken[a], sequence, offset))
                taken[a] += times
                offset += a
            sequence += times
        self.of = {a: np.array(rows, np.int64).T for a, rows in held.items()}

    def find(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces of one length with these ranks."""
        first, sequence, offset = self.of[length]
        at = np.searchsorted(first, ranks, side="right") - 1
        return sequence[at] + ranks - first[at], offset[at]


def pack(pieces: DataFrame, limit: int, keys: list[str], length_col: str = "length", partitions: int | None = None) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; every length must be from 1 to ``limit``.

    ``keys`` order the pieces of one length; equal keys are interchangeable, and
    only such pieces can't be spread over ranges.  An empty table gives an empty
    result.  Pieces of null length or out of range make the job fail, as no
    sequence can hold them.  Other columns are handed on, whatever their names.
    """
    spark = pieces.sparkSession
    bad = F.raise_error(F.lit("a piece's length is null or out of range")).cast("long")
    fit = F.when(F.col(length_col).between(1, limit), F.col(length_col).cast("long")).otherwise(bad)
    rows = pieces.select(F.struct(*[F.col(f"`{c}`") for c in pieces.columns]).alias("row"), fit.alias("length"))
    order = [F.col("row").getField(k) for k in keys]
    # Ranges of (length, keys): a hot length takes many of them.  The partition number is written with the row.
    ranged = stored(rows.repartitionByRange(partitions or shuffle_partitions(spark), "length", *order)
                    .withColumn("part", F.spark_partition_id()), "piece-ranges")
    held = ranged.groupBy("length", "part").count().collect()  # no more rows than partitions and lengths together
    counts, before = Counter(), []
    for r in sorted(held, key=lambda r: (r["length"], r["part"])):
        before.append((r["length"], r["part"], counts[r["length"]]))
        counts[r["length"]] += r["count"]
    places = spark.sparkContext.broadcast(Places(plan_patterns(counts, limit)))  # the plan, made from ``limit`` counts

    offsets = F.broadcast(spark.createDataFrame(before, "length long, part int, before long"))
    w = Window.partitionBy("length", "part").orderBy(*order)
    ranked = ranged.withColumn("nth", F.row_number().over(w)).join(offsets, ["length", "part"]).select(
        "row", "length", (F.col("before") + F.col("nth") - 1).alias("rank"))
    schema = T.StructType([ranked.schema["row"], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            sequence, offset = np.empty_like(ranks), np.empty_like(ranks)
            for a in np.unique(lengths):
                at = lengths == a
                sequence[at], offset[at] = places.value.find(int(a), ranks[at])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.mapInArrow(place, schema).select("row.*", "sequence_id", "offset")


def pack_documents(docs: DataFrame, limit: int = 2048, tokenizer: str | None = None, end_id: int = 0,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise, cut and pack: id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its token ids and ``end_id``.  One longer than ``limit`` is cut
    into pieces of ``limit`` tokens, of which the first may be shorter.  A null
    text is an empty one, so it is a piece of one token.  Repeated rows and rows
    with equal or null ids are packed each.  An empty table gives an empty
    result.  Other columns are ignored.
    """
    from ledgerline.llm.byte_bpe import piece_frames

    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType())])
    cut = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text")).mapInArrow(
        piece_frames(schema, limit, tokenizer, end_id), schema)
    return pack(stored(cut, "pieces"), limit, [id_col, "piece", "start", "ids_crc32"])
