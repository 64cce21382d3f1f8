"""Scale rewrites against the naive form they replace, with NULLs present."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import aggregates as A
from ledgerline.operators import joins as JN
from ledgerline.operators.keys import with_row_index


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_or_join_equals_disjunctive_join(spark):
    people = spark.createDataFrame([(1,), (2,), (3,), (None,), (5,)], "pid int")
    comp = spark.createDataFrame([("a", 1, 2), ("b", 3, 3), ("c", None, 1), ("d", None, None), ("e", 2, 9)],
                                 "name string, p int, q int")
    naive = people.join(comp, (people.pid == comp.p) | (people.pid == comp.q), "left").select("pid", "name")
    fast = JN.or_join(people, comp, "pid", ["p", "q"]).select("pid", "name")
    assert rows(fast) == rows(naive)


@pytest.mark.parametrize("sub", [[], [1, 2], [1, None], [None, None], [7]])
def test_not_in_equals_sql_not_in(spark, sub):
    left = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    s = spark.createDataFrame([(x,) for x in sub], "k2 int")
    left.createOrReplaceTempView("l_nin")
    s.createOrReplaceTempView("s_nin")
    want = spark.sql("SELECT k FROM l_nin WHERE k NOT IN (SELECT k2 FROM s_nin)")
    got = JN.not_in(left, "k", s, "k2").select("k")
    assert rows(got) == rows(want)


def test_fanout_pair_sums_equals_join(spark):
    a = spark.createDataFrame([(1, 5), (1, None), (1, 2), (2, 4), (3, 1)], "item int, x int")
    b = spark.createDataFrame([(1, 3), (1, 1), (2, None), (2, None), (4, 9)], "item int, y int")
    j = a.join(b, "item")
    naive = j.groupBy("item").agg(F.sum("x").cast("decimal(38,0)").alias("a_total"),
                                  F.sum("y").cast("decimal(38,0)").alias("b_total"),
                                  F.sum(F.col("x") - F.col("y")).cast("decimal(38,0)").alias("diff_total"))
    fast = A.fanout_pair_sums(a, b, "item", "x", "y")
    assert rows(fast.select("item", "a_total", "b_total", "diff_total")) == rows(naive)


def test_top_per_group_equals_dense_rank(spark):
    df = spark.createDataFrame([("x", 1, 5), ("x", 2, 5), ("x", 3, 4), ("y", 1, None), ("y", 2, None),
                                ("z", 1, 1), ("z", 2, None)], "g string, item int, n int")
    w = Window.partitionBy("g").orderBy(F.col("n").desc())
    naive = df.withColumn("r", F.dense_rank().over(w)).where("r = 1").drop("r")
    assert rows(A.top_per_group(df, ["g"], "n")) == rows(naive)


def test_dedupe_first_is_deterministic_min(spark):
    df = spark.createDataFrame([(1, 3, "b"), (1, 2, "z"), (1, 2, "a"), (2, 1, "q")], "k int, o int, v string")
    assert rows(A.dedupe_first(df, ["k"], ["o"])) == [(1, 2, "a"), (2, 1, "q")]


def test_with_row_index_consecutive(spark):
    df = spark.range(0, 5000, 3).withColumnRenamed("id", "k").repartition(7)
    out = with_row_index(df, ["k"], "rid", base=10).orderBy("k").collect()
    assert [r.rid for r in out] == list(range(11, 11 + len(out)))


def test_union_distinct(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([(2,), (3,), (3,)], "x int")
    assert rows(A.union_distinct(a, b, a)) == [(1,), (2,), (3,)]


def test_pivot_drops_values_outside_list(spark):
    df = spark.createDataFrame([("g", 1996, 1), ("g", 1996, 2), ("g", 2001, 5), ("h", 1997, 3)],
                               "grp string, y int, q int")
    out = A.pivot_sum(df, ["grp"], "y", [1996, 1997], F.col("q"), names=["a", "b"])
    assert rows(out.select("grp", "a", "b")) == [("g", 3, None), ("h", None, 3)]


def test_split_lead_equals_window_lead(spark):
    import datetime as dt
    from ledgerline.operators.windows import split_lead
    base = dt.datetime(2024, 1, 1)
    data = [(1, base + dt.timedelta(hours=h)) for h in (0, 5, 5, 30, 49, 49, 100)] + \
           [(2, base), (2, None), (2, None), (None, base), (None, base + dt.timedelta(days=3)), (3, None)]
    df = spark.createDataFrame(data, "k int, ts timestamp_ntz")
    naive = df.withColumn("nxt", F.lead("ts").over(Window.partitionBy("k").orderBy("ts")))
    assert rows(split_lead(df, "k", "ts", "nxt")) == rows(naive)


def test_with_row_index_ties_get_distinct_ids(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (0, "z")], "k int, v string")
    out = with_row_index(df, ["k"], "rid").collect()
    assert sorted(r.rid for r in out) == [1, 2, 3, 4]
    assert [r.v for r in out if r.rid == 1] == ["z"]
