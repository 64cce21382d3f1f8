"""Surrogate ids over narrow keys and ids that stay (DML9)."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.keys import new_ids, with_key_index, with_row_index
from ledgerline.plans import loads, reports
from ledgerline.sinks import writers as WR
from ledgerline.sources.tables import Tables

from conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_key_index_equals_row_index(spark):
    df = spark.range(3000).select((F.col("id") % 50).alias("a"), (F.col("id") * 7 % 3000).alias("b"), F.repeat(F.lit("x"), 50).alias("wide"))
    assert rows(with_key_index(df, ["a", "b"], "rid", base=10)) == rows(with_row_index(df, ["a", "b"], "rid", base=10))


def test_key_index_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, 1, "p"), (2, None, "q"), (2, 1, "r")], "k int, `a.b` int, v string")
    assert rows(with_key_index(df, ["k", "a.b"], "rid").select("v", "rid")) == [("p", 1), ("q", 2), ("r", 3)]
    assert with_key_index(df.limit(0), ["k"], "rid").count() == 0


def test_key_index_refuses_repeated_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="two rows with one key"):
        with_key_index(df, ["k"], "rid").collect()


def test_json_loads_sort_keys_only(spark):
    """Neither load stores its wide rows: what is checkpointed holds the key and nothing else."""
    plan = loads.json_shred_load(Tables(spark, SF_SMALL))._jdf.queryExecution().optimizedPlan().toString()
    stored = [line for line in plan.splitlines() if "LogicalRDD" in line]
    assert stored and all("doc_id" in line and "stock_item_name" not in line for line in stored)


def test_ids_stay_across_loads(spark, tmp_dir):
    path = os.path.join(tmp_dir, "ledger")
    load = lambda values: dict(rows(WR.stable_ids(
        spark.createDataFrame([(v,) for v in values], "k string"), ["k"], path, base=100).distinct()))
    first = load(["c", "a", "c", None])
    assert first == {None: 101, "a": 102, "c": 103}
    assert load(["c", "b", "a"]) == {"a": 102, "b": 104, "c": 103}
    assert load([None, "b", "c", "a"]) == {None: 101, "a": 102, "b": 104, "c": 103}
    assert load([]) == {}
    assert spark.read.parquet(path).count() == 4


def test_ids_after_a_half_written_append(spark, tmp_dir):
    """Some of a load's keys have their ids, the others don't: no id is given twice."""
    path = os.path.join(tmp_dir, "ledger")
    df = spark.range(100).select(F.col("id").alias("k"))
    WR.append_rows(new_ids(None, df, ["k"]).where("k % 3 = 0"), path)
    kept = dict(rows(spark.read.parquet(path)))
    got = dict(rows(WR.stable_ids(df, ["k"], path)))
    assert len(got) == len(set(got.values())) == 100 and {k: got[k] for k in kept} == kept


def narrow_tables(spark, base):
    """Orders, lines and parts whose keys compress to next to nothing, as consecutive ones do."""
    n = 300
    spark.range(n).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(10.5).alias("o_totalprice"),
        F.expr("timestamp_ntz'1997-01-01 00:00:00'").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(f"{base}/orders.parquet")
    spark.range(2 * n).select(
        (F.col("id") % n).alias("l_orderkey"), (F.col("id") % 5).alias("l_partkey"), F.lit(2.0).alias("l_quantity"),
        F.when(F.col("id") < n, "O").otherwise("F").alias("l_linestatus")).write.parquet(f"{base}/lineitem.parquet")
    spark.range(5).select(F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("b").alias("p_brand"), F.lit("t").alias("p_type")) \
        .write.parquet(f"{base}/part.parquet")
    return Tables(spark, base)


def broadcast_by_file_size(df, *keys):
    """Joins on ``keys`` that the plan broadcasts before anything is measured."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return [line for line in plan.splitlines() if "BroadcastHashJoin" in line and any(k in line for k in keys)]


def test_json_loads_broadcast_no_rows(spark, tmp_dir):
    """However small the files are, neither the shredded rows nor their ids go through the driver."""
    t = narrow_tables(spark, tmp_dir)
    for load in (loads.json_shred_load, loads.json_shred_purchase_orders):
        df = load(t)
        assert not broadcast_by_file_size(df, "doc_id")
        assert df.count() == 294


def test_group_sums_broadcast_no_keys(spark, tmp_dir):
    t = narrow_tables(spark, tmp_dir)
    df = reports.purchased_sold_by_group(t)
    for each in (df, reports.purchased_more_than_sold(t)):
        assert not broadcast_by_file_size(each, "l_orderkey", "p_partkey", "g_partkey")
    assert {tuple(r) for r in df.collect()} == {(g, 5 * 60 * 60 * 2, 5 * 60 * 60 * 2, 0) for g in "bt"}
