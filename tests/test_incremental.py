"""Watermark-bounded incremental loads (INC1-INC6, DML1, DML2, S17, S34)."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import incremental as INC

SPEC = INC.TableSpec("t", ["id"], "edited")


def src(spark, rows):
    return spark.createDataFrame(rows, "id int, v string, edited string")


def test_two_rounds_load_only_new_interval(spark):
    control = INC.control_table(spark, {"t": dt.datetime(2000, 1, 1)})
    s1 = src(spark, [(1, "a", "2020-01-01 00:00:00"), (2, "b", "2020-01-02 00:00:00")])
    target = s1.limit(0)
    target, control = INC.incremental_upsert(target, s1, control, SPEC)
    assert control.where("TableName = 't'").first().WatermarkValue == dt.datetime(2020, 1, 2)
    s2 = src(spark, [(1, "a", "2020-01-01 00:00:00"), (2, "B", "2020-01-05 00:00:00"),
                     (2, "B0", "2020-01-03 00:00:00"), (3, "c", "2020-01-04 00:00:00"), (4, "n", None)])
    old = INC.watermark(control, "t")
    batch = INC.bounded_extract(s2, "edited", old, INC.new_watermark(s2, "edited", old))
    assert sorted(r.id for r in batch.collect()) == [2, 2, 3]
    target, control = INC.incremental_upsert(target, s2, control, SPEC)
    assert sorted((r.id, r.v) for r in target.collect()) == [(1, "a"), (2, "B"), (3, "c")]
    assert [r.id for r in INC.null_watermarks(s2, "edited").collect()] == [4]


def test_failed_load_leaves_watermark(spark):
    control = INC.control_table(spark, {"t": dt.datetime(2000, 1, 1), "u": dt.datetime(2001, 1, 1)})
    before = sorted(tuple(r) for r in control.collect())
    s = src(spark, [(1, "a", "2020-01-01 00:00:00")])
    target, new_control = INC.incremental_upsert(s.limit(0), s, control, SPEC)
    # Nothing is written until the caller persists; the old control state is untouched.
    assert sorted(tuple(r) for r in control.collect()) == before
    adv = {r.TableName: r.WatermarkValue for r in new_control.collect()}
    assert adv == {"t": dt.datetime(2020, 1, 1), "u": dt.datetime(2001, 1, 1)}


def test_advance_only_named_table(spark):
    control = INC.control_table(spark, {"a": dt.datetime(2000, 1, 1), "b": dt.datetime(2000, 1, 1)})
    out = {r.TableName: r.WatermarkValue for r in INC.advance(control, "a", F.lit("2021-01-01 00:00:00")).collect()}
    assert out == {"a": dt.datetime(2021, 1, 1), "b": dt.datetime(2000, 1, 1)}


def test_an_empty_source_keeps_the_watermark(spark):
    control = INC.control_table(spark, {"t": dt.datetime(2000, 1, 1)})
    empty = src(spark, []).limit(0)
    r = INC.incremental_upsert(empty, empty, control, SPEC)
    assert r.new == dt.datetime(2000, 1, 1) and r.target.count() == 0
    assert [x.WatermarkValue for x in r.control.collect()] == [dt.datetime(2000, 1, 1)]
    again = INC.incremental_upsert(empty, src(spark, [(1, "a", "2020-01-01 00:00:00")]), r.control, SPEC)
    assert again.target.count() == 1


def test_mixed_text_forms_compare_as_timestamps(spark):
    control = INC.control_table(spark, {"t": dt.datetime(2000, 1, 1)})
    s = src(spark, [(1, "older", "2024-01-01T01:00:00"), (1, "newer", "2024-01-01 09:00:00"), (2, "x", "no time"), (3, "y", None)])
    r = INC.incremental_upsert(s.limit(0), s, control, SPEC)
    assert [(x.id, x.v) for x in r.target.collect()] == [(1, "newer")]
    assert sorted(x.id for x in r.rejected.collect()) == [2, 3]
    assert r.new == dt.datetime(2024, 1, 1, 9)


def test_a_source_that_grows_during_the_load(spark, tmp_dir):
    path = tmp_dir + "/source"
    src(spark, [(1, "a", "2020-01-01 00:00:00")]).write.parquet(path)
    schema = spark.read.parquet(path).schema
    control = INC.control_table(spark, {"t": dt.datetime(2000, 1, 1)})
    r = INC.incremental_upsert(src(spark, []).limit(0), spark.read.schema(schema).parquet(path), control, SPEC)
    src(spark, [(2, "b", "2020-01-05 00:00:00")]).write.mode("append").parquet(path)
    now = spark.read.schema(schema).parquet(path)
    assert [x.WatermarkValue for x in r.control.collect()] == [dt.datetime(2020, 1, 1)]
    _, control = r
    later = INC.incremental_upsert(src(spark, [(1, "a", "2020-01-01 00:00:00")]), now, control, SPEC)
    assert sorted(x.id for x in later.target.collect()) == [1, 2]


def test_the_bound_reaches_the_scan_of_a_timestamp_column(spark, tmp_dir):
    path = tmp_dir + "/typed"
    spark.sql("SELECT 1 AS id, TIMESTAMP_NTZ'2020-01-01 00:00:00' AS edited").write.parquet(path)
    bounded = INC.bounded_extract(spark.read.parquet(path), "edited", dt.datetime(2019, 1, 1), dt.datetime(2021, 1, 1))
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "GreaterThan(edited" in pushed and "LessThanOrEqual(edited" in pushed
    assert bounded.count() == 1
