import random
import zlib
from array import array
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

from ledgerline.llm import byte_bpe, packing
from tests.llm.helpers import EDGE, documents, edge_docs, empty_docs, texts


def test_plan_places_every_piece_once_and_fills_exactly_where_it_can():
    rng = random.Random(4)
    for limit in (16, 100, 2048):
        for _ in range(15):
            counts = Counter(rng.randint(1, limit) for _ in range(rng.randint(0, 400)))
            plan = packing.plan_patterns(dict(counts), limit)
            used = Counter()
            for lengths, times in plan:
                assert times > 0 and sum(lengths) <= limit
                for a in lengths:
                    used[a] += times
            assert used == counts
            bins, total = sum(t for _, t in plan), sum(a * n for a, n in counts.items())
            assert bins <= max(-(-total // limit) * 1.25 + 1, sum(n for a, n in counts.items() if 2 * a > limit) + 1)


def test_exact_complements_are_found():
    assert sum(t for _, t in packing.plan_patterns({60: 5, 40: 5}, 100)) == 5
    assert sum(t for _, t in packing.plan_patterns({50: 4, 30: 4, 20: 4}, 100)) == 4
    assert sum(t for _, t in packing.plan_patterns({40: 3, 30: 3, 20: 3, 10: 3}, 100)) == 3


def fewest(sizes, limit):
    """The least number of sequences, by trying every place for every piece, longest first."""
    sizes, best = sorted(sizes, reverse=True), len(sizes)

    def go(i, room):
        nonlocal best
        if len(room) >= best:
            return
        if i == len(sizes):
            best = len(room)
            return
        for k in {r: k for k, r in enumerate(room) if r >= sizes[i]}.values():
            go(i + 1, [*room[:k], room[k] - sizes[i], *room[k + 1:]])
        go(i + 1, [*room, limit - sizes[i]])
    go(0, [])
    return best


def test_plan_against_the_optimum():
    rng = random.Random(8)
    more = 0
    for _ in range(300):
        limit = rng.choice([10, 20, 50])
        sizes = [rng.randint(1, limit) for _ in range(rng.randint(1, 9))]
        used = sum(t for _, t in packing.plan_patterns(Counter(sizes), limit))
        assert fewest(sizes, limit) <= used <= fewest(sizes, limit) + 1
        more += used > fewest(sizes, limit)
    assert more <= 15


def test_pieces_used_up_leave_the_plan_quickly():
    import time
    t = time.perf_counter()
    packing.plan_patterns({k: 1000 + k * 7919 % 997 for k in range(1, 2049)}, 2048)
    assert time.perf_counter() - t < 8


def test_a_hot_length_is_dealt_over_ranges_and_names_may_clash(spark):
    rows = spark.range(4000).selectExpr("id AS k", "CASE WHEN id % 10 = 0 THEN id % 7 + 1 ELSE 8 END AS length", "id AS part", "'x' AS row")
    got = packing.pack(rows, 8, ["k"], partitions=6)
    assert got.columns == ["k", "length", "part", "row", "sequence_id", "offset"]
    got = got.collect()
    assert sorted(r["k"] for r in got) == list(range(4000)) and all(r["part"] == r["k"] for r in got)
    inside = defaultdict(list)
    for r in got:
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in inside.values():
        assert [o for o, _ in sorted(places)] == [sum(n for _, n in sorted(places)[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 8
    assert len(inside) <= 3600 + -(-sum(r["length"] for r in got if r["k"] % 10 == 0) // 8) + 1


@pytest.mark.parametrize("edge", [True, False])
def test_pieces_cover_the_librarys_ids(spark, edge):
    rows = EDGE + [(20, "x <|endoftext|> y"), (21, "  two  spaces \n \n\t z  ")] if edge else texts(spark)
    df = edge_docs(spark, rows) if edge else documents(spark)
    limit = 64 if edge else 2048
    library = Tokenizer.from_file(byte_bpe.default_path())
    want = Counter()
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        first = len(ids) % limit or limit
        cuts = [0, len(ids)] if len(ids) <= limit else [0, *range(first, len(ids) + 1, limit)]
        for k, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            want[(i, k, lo, hi - lo, zlib.crc32(array("I", ids[lo:hi]).tobytes()))] += 1
    got = packing.pack_documents(df, limit=limit).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    inside = defaultdict(list)
    for r in got:
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in inside.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= limit
    total = sum(r["length"] for r in got)
    assert len(inside) <= 1.02 * total / limit + 2


def test_an_empty_table_and_bad_lengths(spark):
    assert packing.pack_documents(empty_docs(spark)).count() == 0
    bad = spark.createDataFrame([(1, 5), (2, 0)], "k long, length long")
    with pytest.raises(Exception, match="out of range"):
        packing.pack(bad, 10, ["k"]).collect()


def test_chunks_match_the_library_on_odd_text():
    table = byte_bpe.chunk_ids(None)
    rng = random.Random(1)
    for _ in range(3000):
        t = "".join(rng.choice("aB é'sS12½\n\t \u00a0\u2003\x1c!?汉🙂ſ<|endoftext|>") for _ in range(30))
        assert table.ids(t) == array("I", table.tokenizer.encode(t, add_special_tokens=False).ids).tobytes()
