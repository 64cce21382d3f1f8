"""Hot keys: one key holds a third of all rows.  The rewritten operators must give the
naive results and must not gather the hot key into one group."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import aggregates as A
from ledgerline.operators import joins as JN
from ledgerline.operators.keys import with_row_index
from ledgerline.operators.windows import day_bucket, split_lead

N = 3000


def skewed(spark):
    # key 0 owns every third row; the others are spread over 200 keys.
    base = dt.datetime(2024, 1, 1)
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 200 + 1).alias("k"),
        (F.lit(base) + F.make_dt_interval(F.col("id") % 40, F.col("id") % 24)).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 17).alias("v"),
    )


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_hot_key_lead_is_split_and_exact(spark):
    df = skewed(spark)
    naive = df.withColumn("nxt", F.lead("ts").over(Window.partitionBy("k").orderBy("ts")))
    assert rows(split_lead(df, "k", "ts", "nxt")) == rows(naive)
    chunks = df.where("k = 0").select(day_bucket("ts")).distinct().count()
    assert chunks >= 30          # the hot key's window work is spread over many chunks


def test_hot_key_top_and_fanout(spark):
    df = skewed(spark)
    counted = df.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("k").orderBy(F.col("n").desc())
    naive = counted.withColumn("r", F.dense_rank().over(w)).where("r = 1").drop("r")
    assert rows(A.top_per_group(counted, ["k"], "n")) == rows(naive)
    a = df.select(F.col("k").alias("item"), F.col("v").alias("x"))
    b = df.where("v < 5").select(F.col("k").alias("item"), F.col("v").alias("y"))
    fast = A.fanout_pair_sums(a, b, "item", "x", "y").where("item = 0").first()
    na, nb = a.where("item = 0").count(), b.where("item = 0").count()
    sa = a.where("item = 0").agg(F.sum("x")).first()[0]
    sb = b.where("item = 0").agg(F.sum("y")).first()[0]
    assert (int(fast.a_total), int(fast.b_total)) == (sa * nb, sb * na)


def test_hot_key_not_in_and_row_index(spark):
    df = skewed(spark)
    sub = df.where("v = 3").select(F.col("k").alias("k2"))
    df.createOrReplaceTempView("skew_l")
    sub.createOrReplaceTempView("skew_s")
    want = spark.sql("SELECT k, ts, v FROM skew_l WHERE k NOT IN (SELECT k2 FROM skew_s)")
    assert rows(JN.not_in(df, "k", sub, "k2")) == rows(want)
    ids = with_row_index(df, ["k"], "rid")
    got = ids.select("rid").collect()
    assert sorted(r.rid for r in got) == list(range(1, N + 1))
    first_hot = ids.where("k = 0").agg(F.min("rid"), F.max("rid")).first()
    assert (first_hot[0], first_hot[1]) == (1, N // 3)
