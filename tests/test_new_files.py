"""New files only (P1, SRC3) and counts on the way (QA2, QA4)."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import flows as FL
from ledgerline.sinks import writers as WR
from ledgerline.streaming import ingest as IN

from test_flows import FILE1, FILE2, movie, write_raw


def cfg_of(tmp_dir, **more):
    return FL.MovieFlowConfig(os.path.join(tmp_dir, "raw", "movie_*.json"), os.path.join(tmp_dir, "stream"),
                              as_of=dt.datetime(2024, 1, 1), new_files_only=True, **more)


def put(tmp_dir, name, text):
    with open(os.path.join(tmp_dir, "raw", name), "w") as f:
        f.write(text)


def silver(spark, cfg):
    return sorted(map(str, FL.read_silver(spark, cfg).collect()))


def bronze(spark, cfg):
    return sorted((r.value, r.status) for r in FL.read_bronze(spark, cfg).collect())


@pytest.mark.parametrize("catalog", [None, "newfiles"])
def test_stream_flow_equals_batch_flow(spark, tmp_dir, catalog):
    write_raw(os.path.join(tmp_dir, "raw"))
    plain = FL.MovieFlowConfig(os.path.join(tmp_dir, "raw", "movie_*.json"), os.path.join(tmp_dir, "lake"), as_of=dt.datetime(2024, 1, 1))
    cfg = cfg_of(tmp_dir, files_per_batch=1, catalog=catalog)
    try:
        assert FL.run_movie_flow(spark, cfg) == FL.run_movie_flow(spark, plain)
        assert silver(spark, cfg) == silver(spark, plain)
        before = bronze(spark, cfg)
        FL.run_movie_flow(spark, cfg)  # no new file: nothing to do
        assert bronze(spark, cfg) == before
        old_files = {f for d, _, fs in os.walk(cfg.bronze) for f in fs if f.endswith(".parquet")}
        put(tmp_dir, "movie_3.json", json.dumps({"movie": [movie(9, 80, 3e6, [], Unheard={"of": ["ü", None]})]}))
        FL.run_movie_flow(spark, cfg)
        got = FL.read_bronze(spark, cfg)
        assert got.count() == len(before) + 1
        kept = json.loads(got.where(F.get_json_object("value", "$.Id") == "9").first().value)
        assert kept["Unheard"] == {"of": ["ü", None]}  # a field that no schema names
        now = {f for d, _, fs in os.walk(cfg.bronze) for f in fs if f.endswith(".parquet")}
        assert old_files <= now  # the earlier batches' files weren't written again
        assert got.select(IN.BATCH).distinct().count() == 3
    finally:
        if catalog:
            spark.sql(f"DROP TABLE IF EXISTS {catalog}_bronze")


def test_a_batch_that_died_is_repeated_once(spark, tmp_dir, monkeypatch):
    """The bronze write succeeds, the second sink fails: the batch comes again and replaces its own rows."""
    write_raw(os.path.join(tmp_dir, "raw"))
    cfg = cfg_of(tmp_dir)
    real, calls = WR.replace_partitions, []

    def dies(rows, path, *columns):
        calls.append(path)
        if path == cfg.unreadable and calls.count(path) == 1:
            raise OSError("disk gone")
        return real(rows, path, *columns)
    monkeypatch.setattr(WR, "replace_partitions", dies)
    with pytest.raises(Exception, match="disk gone"):
        FL.raw_to_bronze(spark, cfg)
    assert FL.read_bronze(spark, cfg).count() == len(FILE1) + len(FILE2)
    FL.raw_to_bronze(spark, cfg)
    assert calls.count(cfg.bronze) == 2 and FL.read_bronze(spark, cfg).count() == len(FILE1) + len(FILE2)
    FL.raw_to_bronze(spark, cfg)
    assert calls.count(cfg.bronze) == 2  # taken: not read again


def test_files_that_are_no_document(spark, tmp_dir):
    write_raw(os.path.join(tmp_dir, "raw"))
    bad = {"movie_b.json": "{broken", "movie_c.json": "[1, 2]", "movie_d.json": '{"movies": []}', "movie_e.json": '{"movie": 3}'}
    for name, text in {**bad, "movie_f.json": '{"movie": []}', "movie_g.json": ""}.items():
        put(tmp_dir, name, text)
    cfg = cfg_of(tmp_dir)
    FL.raw_to_bronze(spark, cfg)
    assert FL.read_bronze(spark, cfg).count() == len(FILE1) + len(FILE2)
    found = {os.path.basename(r.file): r.text for r in spark.read.parquet(cfg.unreadable).collect()}
    found.pop("movie_g.json", None)  # the text reader may give an empty file no row
    assert found == bad


def test_counts_on_the_way_and_stop_rule(spark, tmp_dir):
    write_raw(os.path.join(tmp_dir, "raw"))
    cfg = cfg_of(tmp_dir, max_defect_share=0.5)
    FL.raw_to_bronze(spark, cfg)
    with pytest.raises(FL.DefectLimit, match="71.4%"):  # 5 of 7 distinct values
        FL.bronze_to_silver(spark, cfg)
    assert {r.status for r in FL.read_bronze(spark, cfg).collect()} == {"new"}
    cfg.max_defect_share = 0.8
    FL.bronze_to_silver(spark, cfg)
    rows = [r.asDict() for r in spark.read.parquet(cfg.metrics).drop("counted_at").collect()]
    assert rows == 2 * [{"n_rows": 7, "clean": 2, "negative_runtime": 3, "low_budget": 2, "unclassified": 1}]
    assert FL.read_silver(spark, cfg).count() == 2
    FL.bronze_to_silver(spark, cfg)  # nothing is new: nothing counted
    assert spark.read.parquet(cfg.metrics).count() == 2
