import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import components, jaccard_join, substring_dedup
from tests.llm import brute
from tests.llm.helpers import EDGE, documents, edge_docs, empty_docs, texts


def bag(rows):
    return Counter(tuple(str(x) for x in r) for r in rows)


def noisy_groups(seed, groups=12, copies=9):
    """Groups of texts some edits apart, around the similarity of the links, plus a passage that many share."""
    rng = random.Random(seed)
    shared = [f"p{i}" for i in range(40)]
    rows = []
    for g in range(groups):
        base = [f"g{g}w{rng.randint(0, 60)}" for _ in range(rng.choice([3, 6, 30, 90, 150]))]
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 18))):
                w[rng.randrange(len(w))] = f"x{rng.randint(0, 10**6)}"
            if rng.random() < 0.3:
                at = rng.randrange(len(w) + 1)
                w[at:at] = shared
            if rng.random() < 0.3:
                w = [x.upper() for x in w]
            rows.append((len(rows) * 3 % 1000 + 1000 * (g % 2), " ".join(w)))
    return rows


@pytest.mark.parametrize("case", ["edge", "documents", 1, 2, 3])
def test_links_against_brute_force(spark, case):
    rows = EDGE if case == "edge" else texts(spark) if case == "documents" else noisy_groups(case)
    df = documents(spark) if case == "documents" else edge_docs(spark, rows)
    got = jaccard_join.linked_groups(df).select("doc_id", "n_shingles", "component_id").collect()
    assert bag(got) == bag(brute.linked(rows))


def test_other_sizes_and_limits(spark):
    rows = noisy_groups(5)
    got = jaccard_join.linked_groups(edge_docs(spark, rows), size=2, percent=60).collect()
    assert bag(got) == bag(brute.linked(rows, 2, 60))


@pytest.mark.parametrize("percent,words,changed", [(80, 13, 12), (80, 49, 24), (90, 23, 22)])
def test_pairs_exactly_at_the_limit(spark, percent, words, changed):
    rows = []
    for g in range(12):
        w = [f"g{g}w{i}" for i in range(words)]
        rows += [(2 * g, " ".join(w)), (2 * g + 1, " ".join([*w[:changed], f"other{g}", *w[changed + 1:]]))]
    want = brute.linked(rows, 5, percent)
    assert [c for *_, c in want] == [i - i % 2 for i, _ in rows]
    assert bag(jaccard_join.linked_groups(edge_docs(spark, rows), percent=percent).collect()) == bag(want)


def open_points(spark, n, most, stray):
    """``n`` points of one region, each ``stray``-th a component of its own."""
    return spark.createDataFrame([(0, 7, k, k if k % stray == 0 else 1, 10 + k % 2, 0.0, 0.5, 0, most, bytes(64))
                                  for k in range(1, n + 1)],
                                 "p long, region long, _row long, component long, n long, low double, high double, lost int, most long, signature binary")


def test_a_large_open_region_is_dealt_into_bounded_units(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "UNIT_ROWS", 50)
    units = jaccard_join._units(open_points(spark, 600, 12, 3), 80, 0.2).groupBy("unit", "probe").count().collect()
    assert max(r["count"] for r in units) <= 100  # the cells are dealt by hash, 50 on average
    # One stray: the closed component's points are sent on once each, not to each other.
    lone = jaccard_join._units(open_points(spark, 600, 12, 600), 80, 0.2).groupBy("_row").count().orderBy(F.desc("count")).collect()
    assert [r["_row"] for r in lone if r["count"] > 4] == [600]
    # Points that have lost too many shingles before the region's own need no comparison at all.
    assert jaccard_join._units(open_points(spark, 600, 8, 1), 80, 0.2).count() == 0


@pytest.mark.parametrize("case", ["template", "passages", 4])
def test_links_in_regions_of_many_units(spark, monkeypatch, case):
    monkeypatch.setattr(jaccard_join, "UNIT_ROWS", 3)
    monkeypatch.setattr(jaccard_join, "BUCKET_ROWS", 40)
    rng = random.Random(11)
    common = [f"c{i}" for i in range(12)]
    if case == "template":  # 8 shingles in common, 0 to 3 of their own
        rows = [(k, " ".join([*common, *[f"o{k}_{i}" for i in range(rng.randint(0, 3))]])) for k in range(120)]
    elif case == "passages":
        rows = [(k, " ".join(x for i in rng.sample(range(7), 5) for x in [f"q{i}_{j}" for j in range(rng.choice([9, 10]))])) for k in range(120)]
    else:
        rows = noisy_groups(case, 4, 30)
    got = jaccard_join.linked_groups(edge_docs(spark, rows)).collect()
    assert bag(got) == bag(brute.linked(rows))


def test_one_large_group_of_near_copies_and_its_strays(spark):
    rng = random.Random(9)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(400):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(120)] = f"y{k}_{rng.randint(0, 9)}"
        rows.append((k, " ".join(w)))
    got = jaccard_join.linked_groups(edge_docs(spark, rows)).collect()
    assert bag(got) == bag(brute.linked(rows))


def test_joins_of_an_empty_table(spark):
    assert jaccard_join.linked_groups(empty_docs(spark)).count() == 0
    assert substring_dedup.remove_repeats(empty_docs(spark)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 230)] + [(5, 5), (9, 8), (8, 9)]
    edges += [(rng.randint(300, 360), rng.randint(300, 360)) for _ in range(40)]
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    around = {}
    for a, b in edges:
        if a != b:
            around.setdefault(a, set()).add(b)
            around.setdefault(b, set()).add(a)
    for node in around:
        seen, todo = {node}, [node]
        while todo:
            new = around[todo.pop()] - seen
            seen |= new
            todo += new
        assert got.pop(node) == min(seen)
    assert not got
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def repeated_texts(seed):
    """Texts over few words, so that windows repeat inside a text, across texts and with shifts."""
    rng = random.Random(seed)
    pool = [[f"{rng.choice('abcd')}{rng.randint(0, 3)}" for _ in range(rng.randint(5, 70))] for _ in range(12)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(rng.randint(0, 5)):
            part = list(rng.choice(pool))
            lo = rng.randrange(len(part))
            w += part[lo // 3:] if rng.random() < 0.6 else [f"u{rng.randint(0, 999)}"] * rng.randint(1, 3)
        rows.append((i, rng.choice([" ", "\n", "  "]).join(w)))
    return rows


@pytest.mark.parametrize("case,length,crowded", [("edge", 35, 1000), ("documents", 35, 1000), (1, 12, 1000), (2, 12, 1), (3, 35, 1), (4, 5, 2)])
def test_repeats_against_brute_force(spark, monkeypatch, case, length, crowded):
    monkeypatch.setattr(substring_dedup, "CROWDED", crowded)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 3000)
    rows = EDGE if case == "edge" else texts(spark) if case == "documents" else repeated_texts(case)
    df = documents(spark) if case == "documents" else edge_docs(spark, rows)
    got = substring_dedup.remove_repeats(df, length=length).collect()
    assert bag(got) == bag(brute.without_repeats(rows, length))


def test_copies_of_a_segment_are_one_row_a_batch():
    """However often a line is repeated, what is joined has one row for it in each batch of documents."""
    words = np.arange(40, dtype=np.uint64)
    parts = [[], [], [], [], []]
    for row in (9, 4):
        for k, of in enumerate(np.tile(words, 25).reshape(25, 40)):
            anchor, seg, first, size = substring_dedup.cut_segments(of, 35)
            for to, part in zip(parts, (anchor, seg, np.full(len(first), row), first + 40 * k, size)):
                to.append(part)
    rows = substring_dedup.packed([np.concatenate(p).astype(t) for p, t in zip(parts, ("i8", "i8", "i8", "i4", "i4"))], 7).to_pylist()
    kinds = len(substring_dedup.cut_segments(words, 35)[0])
    assert len(rows) == kinds and {r["times"] for r in rows} == {50} and {r["_row"] for r in rows} == {4}
    assert all(r["rows"] == [4] * 25 + [9] * 25 and r["starts"] == [r["start"] + 40 * k for k in range(25)] * 2 for r in rows)
    hits = [[{"rows": r["rows"], "starts": r["starts"], "lo": 0, "hi": r["n"]} for r in rows], []]
    kind = pa.list_(pa.struct([("rows", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32())), ("lo", pa.int32()), ("hi", pa.int32())]))
    batch = pa.RecordBatch.from_arrays([pa.array([*hits, hits[0]], kind)[:2]], names=["_hits"])
    spans = {r["_row"]: r["_spans"] for b in substring_dedup._spans([batch]) for r in b.to_pylist()}
    assert set(spans) == {4, 9} and all(len(x) == 50 * kinds and (min(x), max(x)) == (0, 1000) for x in spans.values())


def test_columns_to_keep(spark):
    got = substring_dedup.remove_repeats(edge_docs(spark), keep=["score", "host"])
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_text", "score", "host"]
    assert got.where(F.col("score") == "s").count() == len(EDGE)


def test_windows_of_a_crowded_anchor_have_keys_of_their_own():
    line = [f"line{i}" for i in range(30)]
    texts_, wanted = [], []
    for k in range(50):
        w = [*line, *[f"own{k}_{i}" for i in range(10)]]
        texts_.append(" ".join(w))
        wanted.append([{"anchor": -7, "seg": k, "times": 1, "start": 0, "n": 40, "crowded": True}])
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("anchor", "seg", "times", "start", "n")] + [("crowded", pa.bool_())]))
    batch = pa.RecordBatch.from_arrays([pa.array(texts_), pa.array(wanted, kind)], names=["_text", "_wanted"])
    rows = [r for b in substring_dedup._fetch(35)([batch]) for r in b.to_pylist()]
    keys = Counter(r["key"] for r in rows)
    assert len(rows) == 300 and max(keys.values()) == 1  # no window of 35 words repeats here
    again = [r for b in substring_dedup._fetch(35)([batch]) for r in b.to_pylist()]
    assert [r["key"] for r in again] == [r["key"] for r in rows]
