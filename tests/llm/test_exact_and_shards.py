import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import exact_dedup, sharding
from tests.llm.helpers import EDGE, edge_docs, empty_docs, texts, documents

BLANK = str.maketrans("", "", " \t\n\x0b\x0c\r")


def want_groups(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[(t or "").translate(BLANK)].append((-len(t or ""), i is None, i if i is not None else 0, i))
    return {n: (min(g)[3], len(g), hashlib.sha256(n.encode()).hexdigest()) for n, g in groups.items()}


@pytest.mark.parametrize("edge", [True, False])
def test_exact_dedup_against_brute_force(spark, edge):
    rows = EDGE if edge else texts(spark)
    df = edge_docs(spark) if edge else documents(spark)
    want = want_groups(rows)
    got = exact_dedup.dedup_groups(df, salts=3).collect()
    assert len(got) == len(rows)
    for r in got:
        keep, size, digest = want[(r["text"] or "").translate(BLANK)]
        assert (r["keep_id"], r["group_size"], r["text_sha256"], r["kept"]) == (keep, size, digest, r["doc_id"] == keep)


def test_exact_dedup_keeps_other_columns_and_takes_an_empty_table(spark):
    out = exact_dedup.dedup_groups(edge_docs(spark))
    assert [c for c in out.columns if c in ("score", "shard", "host")] == ["score", "shard", "host"]
    assert out.schema["kept"].dataType.simpleString() == "boolean"
    assert exact_dedup.dedup_groups(empty_docs(spark)).count() == 0


def test_exact_dedup_uses_no_python(spark):
    plan = exact_dedup.dedup_groups(documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("edge,shards", [(True, 4), (False, 40), (False, 7)])
def test_shards_are_contiguous_and_balanced(spark, edge, shards):
    rows = EDGE if edge else texts(spark)
    got = sharding.byte_shards(edge_docs(spark) if edge else documents(spark), shards=shards, partitions=5).collect()
    sizes = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t in rows)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == sizes
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r)
    assert set(by) <= set(range(shards))
    for rs in by.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))
    # In order of shard and slot ids never go down (null first).
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for s in sorted(by) for r in sorted(by[s], key=lambda r: r["slot"])]
    assert ids == sorted(ids)
    total, most = sum(s for s, _ in sizes), max(s for s, _ in sizes)
    for rs in by.values():
        assert sum(r["size"] for r in rs) <= total / shards + most


def placed(rows, shards):
    """[(id, size, checksum, shard, slot)]: each row by the prefix sum up to its middle byte."""
    order = sorted(((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16, i) for i, t in rows))
    total, end, out, first = sum(r[3] for r in order), 0, [], {}
    for k, (_, _, crc, size, i) in enumerate(order):
        end += size
        shard = min(shards - 1, (2 * end - size) * shards // (2 * total))
        out.append((i, size, crc, shard, k - first.setdefault(shard, k)))
    return out


@pytest.mark.parametrize("edge,shards,partitions", [(True, 4, 5), (True, 40, 3), (False, 40, 5), (False, 7, 1)])
def test_every_row_lies_where_the_prefix_sums_put_it(spark, edge, shards, partitions):
    rows = EDGE if edge else texts(spark)
    got = sharding.byte_shards(edge_docs(spark) if edge else documents(spark), shards=shards, partitions=partitions).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got), key=key) == sorted(placed(rows, shards), key=key)


def test_shards_of_an_empty_table(spark):
    assert sharding.byte_shards(empty_docs(spark)).count() == 0


def test_a_hot_text_is_spread_over_salts(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("the same")).otherwise(F.col("id").cast("string")).alias("text"))
    got = exact_dedup.dedup_groups(df).groupBy("kept").agg(F.count("*").alias("n"), F.max("group_size").alias("g")).collect()
    assert {(r["kept"], r["n"], r["g"]) for r in got} == {(True, 1001, 2000), (False, 1999, 2000)}
