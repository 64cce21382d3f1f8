"""Exact n-gram Jaccard join as a join in the metric space of shingle sets.

Documents with equal sets are one point.  Shingles are ordered, rare ones first
as far as a counting sketch of bounded size tells, then by hash; any order gives
the same links.

1. The pivots of the first level are single shingles.  With weights that fall
   steeply along the order, the nearest pivot of a set is its first shingle: the
   Voronoi region that it lies in.  To come into the region of its i-th shingle
   a set must lose the i-1 before it, a distance of (i-1)/n; so it is replicated
   into the regions within the allowed distance and no others.  Two linked sets
   meet in the region of the first shingle they share.
2. In each region the document with the smallest number is the pivot of the next
   level.  All others' distances to it are bounded by counts of the shingles in
   hash classes, and computed exactly where the bound allows a link.  Linked
   points fall into components.
3. Points of one region in different components are compared only if the
   shingles that each loses before the region's own leave enough in common,
   their distances to the pivot differ by no more than the allowed distance
   (triangle inequality), and their parity signatures differ in no more bits
   than linked sets differ in shingles; then by class counts, then exactly.
   Regions with many such points are cut into bands of set sizes, and these into
   units of bounded size; points that no window meets leave them, and points of
   the region's largest component meet the others only.  So no region has to fit
   into one task.

A large group of near copies thus falls together in step 2, with as many
comparisons as it has members.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import shuffle_partitions, stored
from ledgerline.llm.components import components
from ledgerline.llm.rows import numbered
from ledgerline.llm.words import FACTOR, mixed, shingle_hashes, split_words, word_hashes

#: Cells of the sketch that tells common shingles from rare ones; its size never grows.
SKETCH_BITS, SKETCH_PARTS = 20, 64
#: Least and most classes that a set's shingles are counted in; about a quarter of its size between these.
CLASSES = (64, 4096)
#: Bits of a set's parity signature.
SIGNATURE_BITS = 512
#: Added to the allowed distance in bounds: floating point must not rule out a pair that lies exactly on it.
SLACK = 1e-9
#: Points of an open region that are searched together, on each side; about how many rows of such units a task takes at once.
UNIT_ROWS, BUCKET_ROWS = 1_000, 20_000


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; the whole sequence is one if it is shorter, none without words."""
    words = word_hashes.of(split_words(text, lower=True))
    if not len(words):
        return np.zeros(0, np.uint64)
    if len(words) < size:
        return mixed(shingle_hashes(words, len(words)) + np.array([len(words)], np.uint64) * FACTOR)
    return np.unique(shingle_hashes(words, size))


def prefix_length(n: int, percent: int) -> int:
    """Shingles of a set of n of which a set at ``percent`` or more must share one."""
    return n - -(-n * percent // 100) + 1


def _digest(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set."""
    m = mixed(s)
    return int(m.sum(dtype=np.uint64).view(np.int64)), int(np.bitwise_xor.reduce(mixed(m * FACTOR)).view(np.int64))


def _cells(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def linked_groups(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the smallest id that links lead to, its own included).

    Words are runs of characters other than [\\x20\\x09-\\x0D], A-Z lower-cased;
    the set holds the distinct shingles of ``size`` words, or the whole sequence
    if it is shorter.  Two documents link when 100 * intersection >= ``percent``
    * union.  Null and blank texts have an empty set and link with nothing.
    Repeated rows, and rows with equal ids, are documents of their own and link
    with each other; null ids never are a ``component_id`` unless a component
    has no other.  An empty table gives an empty result; other columns are
    ignored.
    """
    rows = numbered(docs, id_col, text_col)
    sets, of_row = _groups(rows, size, percent)
    tagged = rows.select("_row", "_id").join(sets.select("_row", "n"), "_row").join(of_row, "_row", "left") \
        .withColumn("_group", F.coalesce("_group", "_row"))
    names = tagged.groupBy("_group").agg(F.min("_id").alias("component_id"))
    return tagged.join(names, "_group").select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def without_linked(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                   keep: list[str] | None = None) -> DataFrame:
    """(id, text, ``keep``) of one row of each group that links connect: the smallest id, null ids last.

    Links as in :func:`linked_groups`.  Rows are told apart by themselves, not
    by their ids: of repeated rows, and of linked rows with equal or null ids,
    one stays; a text without words links with nothing and always stays.
    """
    keep = list(keep or [])
    rows = numbered(docs, id_col, text_col, keep)
    _, of_row = _groups(rows, size, percent)
    tagged = of_row.join(rows.select("_row", "_id"), "_row")
    first = tagged.groupBy("_group").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")).alias("_first"))
    # A stored table, so Spark knows its size and sends it to the texts where that is below its broadcast threshold.
    gone = stored(tagged.join(first, "_group").where(F.col("_row") != F.col("_first._row")).select("_row"), "linked-rows")
    return rows.join(gone, "_row", "left_anti").select(F.col("_id").alias(id_col), F.col("_text").alias(text_col), *keep)


def _groups(rows: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """((_row, n, ...) of all rows, (_row, _group) of those with a shingle) of ``rows``(_row, _text)."""
    spark = rows.sparkSession
    scanned = stored(rows.select("_row", "_text").mapInArrow(
        _scan(size), "_row long, n long, d1 long, d2 long, part int, cells binary"), "shingle-sets")
    sets = scanned.where("part is null").select("_row", "n", "d1", "d2")
    order = _order(scanned.where("part is not null").select("part", "cells"))
    order_b = spark.sparkContext.broadcast(order)  # 2 ** SKETCH_BITS bytes

    # Documents with equal sets are one point, named by the smallest row number.
    full = sets.where("n > 0")
    points = full.groupBy("d1", "d2", "n").agg(F.min("_row").alias("point"))
    member = full.join(points, ["d1", "d2", "n"]).select("_row", "point")

    near = stored(
        rows.select("_row", "_text").mapInArrow(_regions_of(size, percent, order_b), "_row long, n long, vec binary, signature binary, pivots binary")
        .join(points.select(F.col("point").alias("_row")), "_row", "left_semi"), "points")
    regions = _shared(near, 2 * shuffle_partitions(spark))
    vectors = near.select("_row", "n", "vec")

    # Second level: distances to the region's pivot.
    first = stored(regions.groupBy("s").agg(F.min("_row").alias("p")), "pivots")
    in_region = regions.join(first, "s")
    star = in_region.where("_row != p").select(F.col("p").alias("a"), F.col("_row").alias("b")).distinct()
    bounded = stored(_with_bounds(star, vectors), "pivot-bounds")
    limit = 1 - percent / 100 + SLACK
    links = stored(_compare(bounded.where(F.col("low") <= limit).select("a", "b"), rows, size, percent), "pivot-links")
    joined = components(links.where("linked").select("a", "b"))

    # Third level: points of one region in different components, within the windows.
    known = bounded.join(links, ["a", "b"], "left").select(
        F.col("a").alias("p"), F.col("b").alias("_row"), F.coalesce("distance", "low").alias("low"),
        F.coalesce("distance", F.lit(1.0)).alias("high"))
    placed = in_region.join(joined.withColumnRenamed("node", "_row"), "_row", "left") \
        .withColumn("component", F.coalesce("component", "_row"))
    # Neighbouring shingles often have the same points around them; once is enough, with the widest of their windows.
    # The hash of the points stands for them: two regions of one pivot under one hash would only be searched together.
    open_ = placed.groupBy("s").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.bit_xor(F.xxhash64("_row")).alias("region")).where("lo != hi")
    left = placed.join(open_.select("s", "region"), "s").groupBy("p", "region", "_row") \
        .agg(F.first("component").alias("component"), F.min("at").alias("lost")) \
        .join(known, ["p", "_row"], "left").join(near.select("_row", "n", "signature"), "_row") \
        .select("p", "region", "_row", "component", "n", F.coalesce("low", F.lit(0.0)).alias("low"), F.coalesce("high", F.lit(0.0)).alias("high"),
                "lost", F.expr(f"(n - lost) * {100 + percent} div {percent} - n").alias("most"), "signature")
    pairs = _window_pairs(stored(left, "open-points"), percent, limit, 2 * shuffle_partitions(spark)).distinct().join(links.select("a", "b"), ["a", "b"], "left_anti")
    close = _with_bounds(stored(pairs, "window-pairs"), vectors).where(F.col("low") <= limit).select("a", "b")
    more = _compare(stored(close, "close-pairs"), rows, size, percent)
    groups = components(links.where("linked").select("a", "b").unionByName(more.where("linked").select("a", "b")))

    return sets, member.join(groups, member["point"] == groups["node"], "left").select(
        "_row", F.coalesce("component", "point").alias("_group"))


def _scan(size: int):
    """For mapInArrow on (_row, _text): set size and digest of each row; at the end, the task's part of the sketch."""
    names = ["_row", "n", "d1", "d2", "part", "cells"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(1 << SKETCH_BITS, np.uint32)
        any_row = False
        for batch in batches:
            out = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = shingle_set(text.as_py(), size)
                d = _digest(s) if len(s) else (0, 0)
                np.add.at(cells, _cells(s), 1)
                out.append((row, len(s), *d, None, None))
            if out:
                any_row = True
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        if any_row:
            parts = [(None, None, None, None, k, p.tobytes()) for k, p in enumerate(np.split(cells, SKETCH_PARTS))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*parts), types)], names=names)
    return run


def _order(parts: DataFrame) -> np.ndarray:
    """Class of each cell: 0 for what may be rare, higher the commoner it is."""
    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << SKETCH_BITS) // SKETCH_PARTS, np.uint64)
        for c in frame["cells"]:
            total += np.frombuffer(c, np.uint32)
        return pd.DataFrame({"part": [frame["part"].iloc[0]], "cells": [total.tobytes()]})

    got = parts.groupBy("part").applyInPandas(add, "part int, cells binary").collect()  # the sketch, of fixed size
    cells = np.concatenate([np.frombuffer(r["cells"], np.uint64) for r in sorted(got, key=lambda r: r["part"])]).astype(float) \
        if got else np.zeros(1 << SKETCH_BITS)
    common = cells > cells.mean() + 6 * np.sqrt(cells.mean()) + 3
    return np.where(common, 1 + 3 * np.log2(np.maximum(cells, 1)), 0).astype(np.uint8)


def _regions_of(size: int, percent: int, order_b):
    """For mapInArrow on (_row, _text): set size, class counts, signature, and the shingles whose regions the set is replicated into."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = order_b.value
        for batch in batches:
            out = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                s = shingle_set(text.as_py(), size)
                if len(s):
                    pivots = s[np.argsort(order[_cells(s)], kind="stable")[:prefix_length(len(s), percent)]]
                    out.append((row, len(s), class_counts(s).tobytes(), signature(s).tobytes(), pivots.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                    names=["_row", "n", "vec", "signature", "pivots"])
    return run


def _shared(near: DataFrame, buckets: int) -> DataFrame:
    """(s, _row, at) of the regions with two or more points; at: shingles of the set before s in the order."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [np.frombuffer(x.as_py(), np.uint64) for x in batch.column(1)]
            if not parts:
                continue
            s = np.concatenate(parts)
            row = np.repeat(batch.column(0).to_numpy(), [len(p) for p in parts])
            at = np.concatenate([np.arange(len(p), dtype=np.int32) for p in parts])
            bucket = (s % np.uint64(buckets)).astype(np.int32)
            by = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
            out = [(b, s[by[lo:hi]].tobytes(), row[by[lo:hi]].tobytes(), at[by[lo:hi]].tobytes())
                   for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if hi > lo]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))],
                names=["bucket", "s", "rows", "ats"])

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        s = np.concatenate([np.frombuffer(x, np.uint64) for x in frame["s"]])
        rows = np.concatenate([np.frombuffer(x, np.int64) for x in frame["rows"]])
        ats = np.concatenate([np.frombuffer(x, np.int32) for x in frame["ats"]])
        by = np.argsort(s, kind="stable")
        s, rows, ats = s[by], rows[by], ats[by]
        same = s[1:] == s[:-1]
        keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        return pd.DataFrame({"s": s[keep].view(np.int64), "_row": rows[keep], "at": ats[keep]})

    dealt = near.select("_row", "pivots").mapInArrow(deal, "bucket int, s binary, rows binary, ats binary")
    return stored(dealt.groupBy("bucket").applyInPandas(meet, "s long, _row long, at int"), "regions")


def _least_distance(na: np.ndarray, nb: np.ndarray, off: np.ndarray) -> np.ndarray:
    """The least Jaccard distance of sets whose class counts differ by ``off`` in sum."""
    off = np.maximum(off, np.abs(na - nb))
    return 2 * off / (na + nb + off)


def class_counts(s: np.ndarray) -> np.ndarray:
    """Counts of a set's shingles by their low bits; 255 stands for more, which only loosens the bound."""
    classes = min(max(CLASSES[0], 1 << (len(s) // 4).bit_length()), CLASSES[1])
    return np.minimum(np.bincount((s & np.uint64(classes - 1)).astype(np.int64), minlength=classes), 255).astype(np.uint8)


def signature(s: np.ndarray) -> np.ndarray:
    """Bit k: is the number of the set's shingles with low bits k odd?  Sets differ in as many shingles as signatures in bits, or more."""
    counts = np.bincount((s & np.uint64(SIGNATURE_BITS - 1)).astype(np.int64), minlength=SIGNATURE_BITS)
    return np.packbits((counts & 1).astype(np.uint8))


def folded(counts: np.ndarray, classes: int) -> np.ndarray:
    """The same counts (one set a row) in fewer classes."""
    counts = counts.astype(np.int32)
    if counts.shape[-1] == classes:
        return counts
    # A count of 255 may stand for more, so it can't be added to others; a class that holds one stays at 255.
    full = (counts == 255).reshape(*counts.shape[:-1], -1, classes).any(-2)
    return np.where(full, 255, np.minimum(counts.reshape(*counts.shape[:-1], -1, classes).sum(-2), 255))


def _with_bounds(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """(a, b, low) with the least distance that sizes and class counts allow."""
    def bound(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                off = np.zeros(len(f), np.int64)
                sizes = np.stack([f["va"].map(len), f["vb"].map(len)], axis=1)
                for ca, cb in np.unique(sizes, axis=0):
                    at = np.flatnonzero((sizes == (ca, cb)).all(axis=1))
                    va, vb = (np.frombuffer(b"".join(f[c].iloc[at]), np.uint8).reshape(len(at), -1) for c in ("va", "vb"))
                    off[at] = np.abs(folded(va, min(ca, cb)) - folded(vb, min(ca, cb))).sum(1)
                yield pd.DataFrame({"a": f["a"], "b": f["b"], "low": _least_distance(f["na"].to_numpy(), f["nb"].to_numpy(), off)})
    ends = [vectors.select(F.col("_row").alias(c), F.col("n").alias(f"n{c}"), F.col("vec").alias(f"v{c}")) for c in "ab"]
    return pairs.join(ends[0], "a").join(ends[1], "b").mapInPandas(bound, "a long, b long, low double")


def _units(left: DataFrame, percent: int, limit: float) -> DataFrame:
    """(unit, probe, ...): the points of large open regions, dealt into units of about ``UNIT_ROWS`` homes and as many probes.

    ``most`` is the largest set that a point can link with if they first meet in
    this region.  A pair is looked for where its smaller set (equal ones by row
    number) is at home, by band of set sizes; ``stray`` tells the homes outside
    the region's largest component.  Points of that component probe strays only,
    and are probed by strays only.  Points that no window meets are dropped.
    """
    of = ["p", "region"]
    largest = left.groupBy(*of, "component").count().groupBy(*of).agg(F.max(F.struct("count", "component"))["component"].alias("main"))
    points = left.join(largest, of).withColumn("off_main", F.col("component") != F.col("main")) \
        .withColumn("band", F.floor(F.log("n") / F.log(F.lit(100 / percent)) + SLACK).cast("int") if percent < 100 else F.col("n").cast("int"))
    fields = ["_row", "component", "n", "low", "high", "lost", "signature"]
    place = [*of, "band", "stray"]
    homes = points.where("most >= n").select(*of, "band", F.col("off_main").alias("stray"), "most", *fields)
    # The smaller set has at least ``percent`` of the larger one's size, so it is in the same band or the one below.
    probes = points.withColumn("band", F.explode(F.array(F.col("band"), F.col("band") - 1))) \
        .withColumn("stray", F.explode(F.when(F.col("off_main"), F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True))))) \
        .select(*place, "most", *fields)

    def met(rows: DataFrame, others: DataFrame, larger: bool) -> DataFrame:
        hull = others.groupBy(*place).agg(
            F.min("n").alias("n0"), F.max("n").alias("n1"), F.max("most").alias("most1"), F.min("low").alias("low0"), F.max("high").alias("high1"),
            F.min("component").alias("c0"), F.max("component").alias("c1"))
        sizes = f"n0 <= n and 100 * n1 >= {percent} * n" if larger else f"n <= n1 and 100 * n >= {percent} * n0"
        return rows.join(hull, place).where(sizes).where("n0 <= most and n <= most1 and (c0 != component or c1 != component)") \
            .where((F.col("low") <= F.col("high1") + limit) & (F.col("low0") <= F.col("high") + limit)).select(rows.columns)

    probes = met(probes, homes, True)
    homes = met(homes, probes, False)
    cells = homes.groupBy(*place).agg(F.ceil(F.count("*") / UNIT_ROWS).cast("int").alias("hc")).join(
        probes.groupBy(*place).agg(F.ceil(F.count("*") / UNIT_ROWS).cast("int").alias("pc")), place)
    own = "cast(pmod(xxhash64(_row), {}) as int)"
    dealt = [rows.join(cells, place).withColumn("own", F.expr(own.format(mine))).withColumn("other", F.explode(F.sequence(F.lit(0), F.col(theirs) - 1)))
             .select(F.xxhash64(*place, *ends).alias("unit"), F.lit(probe).alias("probe"), *fields)
             for rows, mine, theirs, ends, probe in ((homes, "hc", "pc", ("own", "other"), False), (probes, "pc", "hc", ("other", "own"), True))]
    return dealt[0].unionByName(dealt[1])


def _fitting(f: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, percent: int, limit: float) -> np.ndarray:
    """Which of the pairs (a, b) of points differ in component and aren't ruled out by shingles lost, pivot distances and signatures."""
    n, low, high = f["n"], f["low"], f["high"]
    common = -(-percent * (n[a] + n[b]) // (100 + percent))  # shingles that a linked pair shares, at least
    ok = (f["component"][a] != f["component"][b]) & (np.minimum(n[a] - f["lost"][a], n[b] - f["lost"][b]) >= common) \
        & (low[a] <= high[b] + limit) & (low[b] <= high[a] + limit)
    at = np.flatnonzero(ok)
    a, b = a[at], b[at]
    ok[at] = np.bitwise_count(f["signature"][a] ^ f["signature"][b]).sum(axis=1) <= n[a] + n[b] - 2 * common[at]
    return ok


def _columns(f: pd.DataFrame) -> dict[str, np.ndarray]:
    out = {c: f[c].to_numpy() for c in f.columns if c != "signature"}
    out["signature"] = np.frombuffer(b"".join(f["signature"]), np.uint64).reshape(len(f), -1)
    return out


def region_pairs(frame: pd.DataFrame, percent: int, limit: float) -> np.ndarray:
    """(a, b): the pairs of each ``unit`` that :func:`_fitting` leaves, for units of few points."""
    f = _columns(frame.sort_values(["unit", "n", "_row"], kind="stable"))
    unit, n, row = f["unit"], f["n"], f["_row"]
    out = [np.zeros((0, 2), np.int64)]
    # Each point with the k-th behind it, as long as that one lies in its unit and isn't too large for it.
    left, k = np.arange(len(n)), 1
    while len(left):
        left = left[left + k < len(n)]
        left = left[(unit[left] == unit[left + k]) & (100 * n[left] >= percent * n[left + k])]
        x = left[_fitting(f, left, left + k, percent, limit)]
        out.append(np.stack([np.minimum(row[x], row[x + k]), np.maximum(row[x], row[x + k])], axis=1))
        k += 1
    return np.unique(np.concatenate(out), axis=0)


def dealt_pairs(frame: pd.DataFrame, percent: int, limit: float) -> np.ndarray:
    """(a, b): the pairs of a home and a probe of each ``unit`` that :func:`_fitting` leaves; the home is the smaller set."""
    f = _columns(frame.sort_values(["unit", "probe", "n", "_row"], kind="stable"))
    unit, n, row = f["unit"], f["n"], f["_row"]
    homes = np.flatnonzero(~f["probe"])
    out = [np.zeros((0, 2), np.int64)]
    for k in np.flatnonzero(f["probe"]):
        lo, hi = np.searchsorted(unit[homes], [unit[k], unit[k] + 1]) if unit[k] < np.iinfo(np.int64).max \
            else (np.searchsorted(unit[homes], unit[k]), len(homes))
        of = homes[lo:hi]
        of = of[np.searchsorted(100 * n[of], percent * n[k]): np.searchsorted(n[of], n[k], side="right")]
        of = of[(n[of] < n[k]) | (row[of] < row[k])]
        x = of[_fitting(f, of, np.full(len(of), k), percent, limit)]
        out.append(np.stack([np.minimum(row[x], row[k]), np.maximum(row[x], row[k])], axis=1))
    return np.unique(np.concatenate(out), axis=0)


def _window_pairs(left: DataFrame, percent: int, limit: float, buckets: int) -> DataFrame:
    """(a, b): the pairs of all open regions, small ones as one unit, larger ones dealt."""
    def searched(units: DataFrame, search) -> DataFrame:
        n = max(buckets, -(-units.count() // BUCKET_ROWS))

        def bucket(frame: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame(search(frame, percent, limit), columns=["a", "b"])
        return units.withColumn("bucket", F.pmod("unit", F.lit(n))).groupBy("bucket").applyInPandas(bucket, "a long, b long")

    sized = left.join(left.groupBy("p", "region").agg(F.count("*").alias("m")), ["p", "region"])
    small = sized.where(F.col("m") <= UNIT_ROWS).select(F.xxhash64("p", "region").alias("unit"), "_row", "component", "n", "low", "high", "lost", "signature")
    large = stored(_units(sized.where(F.col("m") > UNIT_ROWS).drop("m"), percent, limit), "window-units")
    return searched(small, region_pairs).unionByName(searched(large, dealt_pairs))


def _compare(pairs: DataFrame, rows: DataFrame, size: int, percent: int) -> DataFrame:
    """(a, b, distance, linked) of each pair, from the whole sets."""
    # A stored table, so Spark knows its size and sends it to the texts where that is below its broadcast threshold.
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("_row")).distinct(), "compared")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [shingle_set(t.as_py(), size).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], names=["_row", "hashes"])

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            far, linked = [], []
            for x, y in zip(f["x"], f["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                all_ = len(x) + len(y) - both
                far.append(1 - both / all_)
                linked.append(100 * both >= percent * all_)
            yield pd.DataFrame({"a": f["a"], "b": f["b"], "distance": far, "linked": linked})

    whole = stored(rows.join(wanted, "_row").select("_row", "_text").mapInArrow(sets, "_row long, hashes binary"), "sets")
    ends = [whole.select(F.col("_row").alias(c), F.col("hashes").alias(h)) for c, h in (("a", "x"), ("b", "y"))]
    return pairs.join(ends[1], "b").join(ends[0], "a").mapInPandas(measure, "a long, b long, distance double, linked boolean")
