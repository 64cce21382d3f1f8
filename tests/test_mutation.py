"""Table-state operators: upsert, delete, keyed update, guarded and rolling loads."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import mutation as M


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_merge_upsert_updates_and_inserts(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert rows(M.merge_upsert(target, batch, ["k"])) == [(1, "a"), (2, "B"), (3, "c")]


def test_latest_per_key_and_duplicates(spark):
    b = spark.createDataFrame([(1, 5, "old"), (1, 9, "new"), (2, 1, "x")], "k int, ts int, v string")
    assert rows(M.latest_per_key(b, ["k"], "ts")) == [(1, 9, "new"), (2, 1, "x")]
    assert rows(M.duplicate_keys(b, ["k"])) == [(1, 2)]


def test_delete_keeps_null_predicate(spark):
    t = spark.createDataFrame([(1,), (5,), (None,)], "d int")
    assert rows(M.delete_where(t, F.col("d") < 3)) == [(5,), (None,)]


def test_update_matched_constant_and_column(spark):
    t = spark.createDataFrame([("x", "new"), ("y", "new"), ("z", "new")], "value string, status string")
    s = spark.createDataFrame([("x", "loaded"), ("y", "quarantined")], "value string, st string")
    assert rows(M.update_matched(t, s, "value", "status", source_col="st")) == \
        [("x", "loaded"), ("y", "quarantined"), ("z", "new")]
    assert rows(M.update_matched(t, s.where("value = 'x'"), "value", "status", "done")) == \
        [("x", "done"), ("y", "new"), ("z", "new")]


def test_guarded_append_rejects_existing_date(spark):
    t = spark.createDataFrame([(1, dt.date(2020, 1, 1))], "id int, d date")
    new = spark.createDataFrame([(2, dt.date(2020, 1, 1))], "id int, d date")
    r = M.guarded_append(t, new, "d", dt.date(2020, 1, 1))
    assert r.error_number == 50000 and rows(r.state) == rows(t)
    r2 = M.guarded_append(t, new.withColumn("d", F.lit(dt.date(2020, 1, 2))), "d", dt.date(2020, 1, 2))
    assert r2.error_number is None and len(r2.state.collect()) == 2


def test_rolling_reload_idempotent(spark):
    t = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, dt.date(2020, 1, 3))], "id int, d date")
    rows_in = spark.createDataFrame([(2, dt.date(2020, 1, 3)), (3, dt.date(2020, 1, 4))], "id int, d date")
    once = M.rolling_reload(t, rows_in, "d", dt.date(2020, 1, 2), ["id"])
    twice = M.rolling_reload(once, rows_in, "d", dt.date(2020, 1, 2), ["id"])
    assert rows(once) == rows(twice) == [(2, dt.date(2020, 1, 3)), (3, dt.date(2020, 1, 4))]
