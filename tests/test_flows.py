"""File-backed flows: movie lake (P1-P3, twice) and warehouse load."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from ledgerline.operators import incremental as INC
from ledgerline.operators import projection as P
from ledgerline.plans import flows as FL
from ledgerline.plans import warehouse_load as WL
from ledgerline.sinks import writers as WR
from ledgerline.sources.tables import Tables

from conftest import SF_SMALL


def movie(i, runtime, budget, genres, **extra):
    m = {"Id": i, "Title": f"M{i}", "Overview": "o", "Tagline": "t", "Budget": budget, "Revenue": 1.0,
         "ImdbUrl": "u", "TmdbUrl": "u", "PosterUrl": "p", "BackdropUrl": "b", "OriginalLanguage": "en",
         "ReleaseDate": "2001-02-03", "RunTime": runtime, "Price": 1.5, "CreatedDate": "2020-01-01T10:00:00",
         "UpdatedDate": None, "UpdatedBy": None, "CreatedBy": None, "genres": genres}
    m.update(extra)
    return m


FILE1 = [movie(1, 100, 2e6, [{"id": 1, "name": "Drama"}, {"id": 2, "name": ""}]),
         movie(2, -90, 2e6, [{"id": 3, "name": "Comedy"}]),
         movie(3, 90, 10.0, None),
         movie(4, -5, 5.0, []),
         movie(5, None, 2e6, [{"id": 1, "name": "Drama"}]),
         movie(6, -7, None, [])]
FILE2 = [movie(1, 100, 2e6, [{"id": 1, "name": "Drama"}, {"id": 2, "name": ""}]),   # same movie, second file
         movie(7, 120, 3e6, [{"id": 4, "name": "Horror"}])]


def write_raw(d):
    os.makedirs(d, exist_ok=True)
    for i, rows in enumerate((FILE1, FILE2), start=1):
        with open(os.path.join(d, f"movie_{i}.json"), "w") as f:
            json.dump({"movie": rows}, f, indent=2)


def state(spark, cfg):
    """Everything that the flow has written, in an order of its own."""
    rows = lambda df: sorted(map(str, df.collect()))
    return {"bronze": rows(spark.read.parquet(cfg.bronze).select("value", "status")), "silver": rows(FL.read_silver(spark, cfg)),
            "genres": rows(spark.read.parquet(cfg.lookup("genres"))),
            "languages": rows(spark.read.parquet(cfg.lookup("original_languages")))}


def movie_cfg(tmp_dir, name="lake", day=1):
    return FL.MovieFlowConfig(os.path.join(tmp_dir, "raw", "movie_*.json"), os.path.join(tmp_dir, name), as_of=dt.datetime(2024, 1, day))


def test_movie_flow_three_times(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    write_raw(raw)
    cfg = movie_cfg(tmp_dir)
    first = FL.run_movie_flow(spark, cfg)
    assert first["bronze"] == 8
    assert first["status"] == {"loaded": 6, "unclassified": 2}
    got = {r.movie_id: (r.runtime, r.budget) for r in FL.read_silver(spark, cfg).collect()}
    assert got == {1: (100, 2e6), 2: (90, 2e6), 3: (90, 1e6), 4: (5, 1e6), 7: (120, 3e6)}
    genres = lambda: [tuple(r) for r in spark.read.parquet(cfg.lookup("genres")).orderBy("id").collect()]
    assert genres() == [(1, "Drama"), (3, "Comedy"), (4, "Horror")]
    assert spark.table("original_languages").collect()[0].language == "English"
    before = state(spark, cfg)
    assert FL.run_movie_flow(spark, cfg) == first
    assert state(spark, cfg) == before
    # A new file adds its rows and genres on a later day; what was there stays, its files untouched.
    with open(os.path.join(raw, "movie_3.json"), "w") as f:
        json.dump({"movie": [movie(8, -60, 4e6, [{"id": 4, "name": "Horror"}, {"id": 9, "name": "Noir"}]),
                             movie(9, 60, 4e6, [])]}, f)
    old_day = os.path.join(cfg.bronze, "p_ingestdate=2024-01-01")
    files = sorted(os.listdir(old_day))
    third = FL.run_movie_flow(spark, movie_cfg(tmp_dir, day=2))
    assert third["bronze"] == 10 and third["silver"] == 7 and third["status"] == {"loaded": 8, "unclassified": 2}
    assert genres() == [(1, "Drama"), (3, "Comedy"), (4, "Horror"), (9, "Noir")]
    assert spark.table("original_languages").count() == 1
    assert sorted(os.listdir(old_day)) == files
    after = state(spark, cfg)
    assert all(set(before[k]) <= set(after[k]) for k in before)


def test_rows_equal_but_for_their_raw_text_all_stay(spark, tmp_dir):
    raw = os.path.join(tmp_dir, "raw")
    os.makedirs(raw)
    for i, extra in enumerate((None, "someone")):
        with open(os.path.join(raw, f"movie_{i}.json"), "w") as f:
            json.dump({"movie": [movie(1, -100, 2e6, [], UpdatedBy=extra)]}, f)
    cfg = movie_cfg(tmp_dir)
    summary = FL.run_movie_flow(spark, cfg)
    assert summary["bronze"] == summary["silver"] == summary["status"]["loaded"] == 2


def test_movie_flow_survives_a_failure_at_every_commit(spark, tmp_dir, monkeypatch):
    write_raw(os.path.join(tmp_dir, "raw"))
    whole = movie_cfg(tmp_dir, "whole")
    FL.run_movie_flow(spark, whole)
    want = state(spark, whole)
    commits = 0
    for stop in range(50):
        cfg = movie_cfg(tmp_dir, f"lake{stop}")
        commits = 0

        def counted(f):
            def call(*args, **kw):
                nonlocal commits
                commits += 1
                if commits == stop + 1:
                    raise RuntimeError("injected")
                return f(*args, **kw)
            return call
        with monkeypatch.context() as m:
            m.setattr(WR, "append_rows", counted(WR.append_rows))
            m.setattr(WR, "replace_partitions", counted(WR.replace_partitions))
            try:
                FL.run_movie_flow(spark, cfg)
                break
            except RuntimeError:
                pass
        FL.run_movie_flow(spark, cfg)
        assert state(spark, cfg) == want, f"after a failure at commit {stop + 1}"
    assert stop == commits == 7


def test_warehouse_flow_two_rounds(spark, tmp_dir):
    t = Tables(spark, SF_SMALL)
    lines = WL.order_lines_table(t)
    cfg = FL.WarehouseConfig(os.path.join(tmp_dir, "wh"), [WL.ORDERS_SPEC, WL.LINES_SPEC], seed=dt.datetime(1990, 1, 1))
    FL.run_warehouse_flow(spark, {"orders_table": WL.source_snapshot(t, 1), "order_lines_table": lines}, cfg)
    FL.run_warehouse_flow(spark, {"orders_table": WL.source_snapshot(t, 2), "order_lines_table": lines}, cfg)
    ods = FL.read_ods(spark, WL.ORDERS_SPEC, cfg)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(ods) == rows(WL.incremental_upsert(t))
    assert rows(FL.read_ods(spark, WL.LINES_SPEC, cfg)) == rows(WL.incremental_upsert_lines(t))
    marks = {r.TableName: r.m for r in spark.read.parquet(cfg.path("control", "watermarks"))
             .groupBy("TableName").agg(F.max("WatermarkValue").alias("m")).collect()}
    assert marks["orders_table"] > dt.datetime(1998, 1, 1)
    fact = spark.read.parquet(cfg.path("olap", "fact_orders"))
    assert fact.count() == ods.join(FL.read_ods(spark, WL.LINES_SPEC, cfg), "OrderID").count()
    assert fact.select("OrderKey").distinct().count() == fact.count()
    dim = spark.read.parquet(cfg.path("olap", "dim_customers"))
    assert dim.where("ValidFrom = ValidTo").count() == 0
    assert dim.groupBy("CustomerKey").agg(F.sum("Active").alias("a")).where("a != 1").count() == 0


def test_warehouse_load_again_after_a_lost_watermark_and_empty_sources(spark, tmp_dir, monkeypatch):
    spec = INC.TableSpec("t", ["id"], "edited")
    cfg = FL.WarehouseConfig(os.path.join(tmp_dir, "wh"), [spec], seed=dt.datetime(2000, 1, 1))
    source = spark.createDataFrame([(1, "a", "2020-01-01 00:00:00"), (2, "b", "2020-01-02T00:00:00"), (3, "c", None), (4, "d", "soon")],
                                   "id int, v string, edited string")
    control = INC.control_table
    with monkeypatch.context() as m:
        calls = []
        m.setattr(INC, "control_table", lambda *a: calls.append(1) or (control(*a) if len(calls) == 1 else 1 / 0))
        try:
            FL.load_table(spark, source, spec, cfg)
        except ZeroDivisionError:
            pass
    FL.load_table(spark, source, spec, cfg)
    assert sorted((r.id, r.v) for r in FL.read_ods(spark, spec, cfg).collect()) == [(1, "a"), (2, "b")]
    assert sorted(r.id for r in spark.read.parquet(cfg.path("rejected", "t")).collect()) == [3, 4]
    FL.load_table(spark, source.limit(0), spec, cfg)
    more = source.unionByName(spark.createDataFrame([(5, "e", "2020-01-03 00:00:00")], source.schema))
    assert FL.load_table(spark, more, spec, cfg).batch.count() == 1
    assert FL.read_ods(spark, spec, cfg).count() == 3


def test_projection_helpers(spark):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType
    df = spark.createDataFrame([(1, "a", "x")], "Id int, Title string, Extra string")
    r = P.rename_map(df, [("Id", "movie_id"), ("Id", "other"), ("Title", "title"), ("Extra", "title")])
    assert r.columns == ["movie_id", "title"]
    h = df.select(P.row_sha256("Id", "Title").alias("h")).first().h
    assert len(h) == 64
    schema = StructType([StructField("Id", IntegerType(), False), StructField("Missing", StringType(), True)])
    assert tuple(P.cast_to_schema(df, schema).first()) == (1, None)
    bad = spark.createDataFrame([(None,)], "Id int")
    try:
        P.cast_to_schema(bad, schema).collect()
        raise AssertionError("NOT NULL violation not raised")
    except Exception as e:  # noqa: BLE001
        assert "NOT NULL" in str(e)
