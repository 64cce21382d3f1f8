"""Published tables: atomic commits (SNK3, SNK4, SNK15), bucketed upsert (DML1, INC5), incremental dimension (DIM2)."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import warehouse as W
from ledgerline.sinks import published as PB


def name():
    return f"t_{uuid.uuid4().hex}"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def locations(spark, table):
    """Where each partition lies, by its value."""
    out = {}
    for r in spark.sql(f"SHOW PARTITIONS {table}").collect():
        key, value = r[0].split("=")
        info = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION ({key} = '{value}')").collect()
        out[value] = next(x.data_type for x in info if x.col_name == "Location")
    return out


class Died(Exception):
    pass


def dying(monkeypatch, spark, word):
    """The session dies at the first statement that holds ``word``."""
    real = type(spark).sql

    def sql(self, text, *args, **kw):
        if word in text:
            raise Died(text)
        return real(self, text, *args, **kw)
    monkeypatch.setattr(type(spark), "sql", sql)


def test_whole_table_is_old_or_new(spark, tmp_dir, monkeypatch):
    table = name()
    assert PB.table_or_none(spark, table) is None
    PB.publish(spark.range(5).toDF("x"), table, tmp_dir)
    assert rows(spark.table(table)) == [(k,) for k in range(5)]
    PB.publish(spark.table(table).where("x > 2").unionAll(spark.range(9, 10)), table, tmp_dir)  # reads what it replaces
    assert rows(spark.table(table)) == [(3,), (4,), (9,)]
    with monkeypatch.context() as m:
        dying(m, spark, "SET LOCATION")
        with pytest.raises(Died):
            PB.publish(spark.range(1).toDF("x"), table, tmp_dir)
    assert rows(spark.table(table)) == [(3,), (4,), (9,)]
    PB.publish(spark.range(0).toDF("x"), table, tmp_dir)
    assert rows(spark.table(table)) == []


def test_a_write_that_dies_leaves_the_table(spark, tmp_dir, monkeypatch):
    table = name()
    PB.publish_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "x int, day string"), table, tmp_dir, "day")

    bad = spark.table(table).withColumn("x", F.when(F.col("x") == 2, F.raise_error(F.lit("died")).cast("int")).otherwise(F.col("x")))
    with pytest.raises(Exception, match="died"):
        PB.publish_partitions(bad, table, tmp_dir, "day")
    assert rows(spark.table(table)) == [(1, "a"), (2, "b")]


@pytest.mark.parametrize("word", ["CREATE TABLE", "SHOW PARTITIONS", " ADD ", " SET LOCATION"])
def test_partitions_are_old_or_new_and_a_commit_can_be_repeated(spark, tmp_dir, monkeypatch, word):
    table = name()
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "its")], "x int, day string")
    second = spark.createDataFrame([(20, "b"), (40, "d"), (30, "its")], "x int, day string")
    with monkeypatch.context() as m:
        if word == "CREATE TABLE":  # the very first commit dies
            dying(m, spark, word)
            with pytest.raises(Died):
                PB.publish_partitions(first, table, tmp_dir, "day")
    PB.publish_partitions(first, table, tmp_dir, "day")
    untouched = locations(spark, table)["a"]
    with monkeypatch.context() as m:
        dying(m, spark, word)
        if word != "CREATE TABLE":
            with pytest.raises(Died):
                PB.publish_partitions(second, table, tmp_dir, "day")
    seen = {day: x for x, day in rows(spark.table(table))}
    assert seen["a"] == 1 and seen["b"] in (2, 20) and seen["its"] in (3, 30) and seen.get("d", 40) == 40
    assert PB.publish_partitions(second, table, tmp_dir, "day") == ["b", "d", "its"]
    assert rows(spark.table(table)) == [(1, "a"), (20, "b"), (30, "its"), (40, "d")]
    assert locations(spark, table)["a"] == untouched


def test_partition_without_a_value_is_refused(spark, tmp_dir):
    for value in (None, "it's", "a/b", ""):
        table = name()
        with pytest.raises(ValueError):
            PB.publish_partitions(spark.createDataFrame([(1, value), (2, "b")], "x int, day string"), table, tmp_dir, "day")
        assert PB.table_or_none(spark, table) is None


def test_one_row_rewrites_one_bucket(spark, tmp_dir):
    table = name()
    base = spark.range(400).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    assert PB.upsert_buckets(base, ["k"], table, tmp_dir, 8) == list(range(8))
    before = locations(spark, table)
    one = spark.createDataFrame([(7, "new")], "k long, v string")
    touched = PB.upsert_buckets(one, ["k"], table, tmp_dir, 8)
    after = locations(spark, table)
    assert len(touched) == 1 and {b for b in after if after[b] != before[b]} == {str(touched[0])}
    assert rows(spark.table(table).select("k", "v")) == sorted([(k, "new" if k == 7 else "old") for k in range(400)], key=str)
    again = rows(spark.table(table))
    PB.upsert_buckets(one, ["k"], table, tmp_dir, 8)
    assert rows(spark.table(table)) == again
    assert PB.upsert_buckets(one.limit(0), ["k"], table, tmp_dir, 8) == []
    assert rows(spark.table(table)) == again


def test_upsert_reads_only_its_buckets(spark, tmp_dir):
    table = name()
    PB.upsert_buckets(spark.range(400).select(F.col("id").alias("k")), ["k"], table, tmp_dir, 8)
    batch = spark.createDataFrame([(7,)], "k long").withColumn(PB.BUCKET, PB.bucket_of(["k"], 8))
    plan = PB._touched(spark.table(table), batch)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan.replace("PartitionFilters: [isnotnull(bucket", "PartitionFilters: [bucket")


def facts(spark, pairs):
    return spark.createDataFrame([(c, None if d is None else dt.datetime(2020, 1, 1) + dt.timedelta(hours=d)) for c, d in pairs],
                                 "CustomerKey long, CreatedAt timestamp_ntz")


CASES = {
    "late change splits": ([(1, 0), (1, 100)], [(1, 50)]),
    "before the first": ([(1, 100)], [(1, 5)]),
    "after the last": ([(1, 0), (2, 3)], [(1, 100)]),
    "already there": ([(1, 0), (1, 100)], [(1, 100), (1, 0)]),
    "new customer": ([(1, 0)], [(2, 0), (2, 7)]),
    "nulls": ([(1, 0), (None, 4)], [(1, None), (None, 2), (None, None)]),
    "nothing new": ([(1, 0), (1, 9)], []),
    "from nothing": ([], [(1, 0), (1, 9)]),
}


@pytest.mark.parametrize("case", CASES)
def test_merged_dimension_equals_a_rebuild(spark, case):
    old, new = CASES[case]
    merged = W.merge_customer_changes(W.build_customer_dimension(facts(spark, old)), facts(spark, new))
    assert rows(merged) == rows(W.build_customer_dimension(facts(spark, old + new)))


def test_merged_dimension_of_many_batches_and_a_hot_customer(spark, tmp_dir):
    rng = random.Random(4)
    table, seen = name(), []
    before = {}
    for k in range(4):
        batch = [(rng.choice([1, 1, 1, *range(12)]), rng.randrange(900)) for _ in range(150)] if k < 3 else [(5, 17)]
        touched = PB.update_dimension(facts(spark, batch), table, tmp_dir, 4)
        seen += batch
        want = W.build_customer_dimension(facts(spark, seen))
        assert rows(spark.table(table).drop(PB.BUCKET)) == rows(want)
        places = locations(spark, table)
        assert {b for b in places if places[b] != before.get(b)} == set(map(str, touched))
        before = places
    assert len(touched) == 1
    assert isinstance(want, DataFrame)


# --- the flows on published tables ---------------------------------------------------------------

def flow_state(spark, cfg):
    from ledgerline.plans import flows as FL
    return {"bronze": rows(FL.read_bronze(spark, cfg).select("value", "status")), "silver": rows(FL.read_silver(spark, cfg)),
            "genres": rows(spark.read.parquet(cfg.lookup("genres")))}


def test_movie_flow_on_published_tables_survives_a_failure_at_every_commit(spark, tmp_dir, monkeypatch):
    import os

    from ledgerline.plans import flows as FL
    from ledgerline.sinks import writers as WR
    from test_flows import movie_cfg, write_raw
    write_raw(os.path.join(tmp_dir, "raw"))
    plain = movie_cfg(tmp_dir, "plain")
    summary = FL.run_movie_flow(spark, plain)
    want = flow_state(spark, plain)
    for stop in range(50):
        cfg = movie_cfg(tmp_dir, f"lake{stop}")
        cfg.catalog = name()
        commits = 0
        real_sql, real_append = type(spark).sql, WR.append_rows

        def commit():
            nonlocal commits
            commits += 1
            if commits == stop + 1:
                raise Died

        def sql(self, text, *args, **kw):
            if text.startswith("ALTER TABLE"):
                commit()
            return real_sql(self, text, *args, **kw)

        def append(*args, **kw):
            commit()
            return real_append(*args, **kw)
        with monkeypatch.context() as m:
            m.setattr(type(spark), "sql", sql)
            m.setattr(WR, "append_rows", append)
            try:
                FL.run_movie_flow(spark, cfg)
                break
            except Died:
                pass
        assert FL.run_movie_flow(spark, cfg) == summary
        assert flow_state(spark, cfg) == want, f"after a failure at commit {stop + 1}"
    assert stop == commits >= 6
    assert flow_state(spark, cfg) == want


def test_warehouse_flow_on_published_tables(spark, tmp_dir):
    import os

    from ledgerline.plans import flows as FL
    from ledgerline.plans import warehouse_load as WL
    from ledgerline.sources.tables import Tables
    from conftest import SF_SMALL
    t = Tables(spark, SF_SMALL)
    lines = WL.order_lines_table(t)
    cfg = FL.WarehouseConfig(os.path.join(tmp_dir, "wh"), [WL.ORDERS_SPEC, WL.LINES_SPEC], seed=dt.datetime(1990, 1, 1), catalog=name(), buckets=4)
    for phase in (1, 2):
        FL.run_warehouse_flow(spark, {"orders_table": WL.source_snapshot(t, phase), "order_lines_table": lines}, cfg)
    assert rows(FL.read_integration(spark, "orders_table", cfg).select(*WL.incremental_upsert(t).columns)) == rows(WL.incremental_upsert(t))
    assert rows(FL.read_integration(spark, "order_lines_table", cfg).select(*lines.columns)) == rows(WL.incremental_upsert_lines(t))
    # Edits of the second round are further changes; the dimension keeps the first round's as well.
    edits = [W.build_fact_orders(WL.source_snapshot(t, p), lines, with_key=False).select("CustomerKey", "CreatedAt") for p in (1, 2)]
    assert rows(FL.read_dimension(spark, cfg)) == rows(W.build_customer_dimension(edits[0].unionByName(edits[1])))
    before = {x: locations(spark, f"{cfg.catalog}_{x}") for x in ("orders_table", "dim_customers")}
    FL.run_warehouse_flow(spark, {"orders_table": WL.source_snapshot(t, 2), "order_lines_table": lines}, cfg)
    assert {x: locations(spark, f"{cfg.catalog}_{x}") for x in before} == before  # nothing new, nothing written


def test_a_first_write_that_died_is_no_table(spark, tmp_dir):
    import os

    from ledgerline.plans import flows as FL
    from ledgerline.sinks import writers as WR
    from test_flows import movie_cfg, write_raw
    write_raw(os.path.join(tmp_dir, "raw"))
    cfg = movie_cfg(tmp_dir)
    for path in (cfg.bronze, cfg.silver, cfg.lookup("genres")):
        os.makedirs(os.path.join(path, "_temporary", "0"))
    assert WR.read_or_none(spark, cfg.bronze) is None
    assert FL.run_movie_flow(spark, cfg)["bronze"] == 8
