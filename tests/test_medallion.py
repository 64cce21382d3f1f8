"""Raw -> bronze -> silver lifecycle invariants."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.operators import quality as Q
from ledgerline.plans import medallion as MD
from ledgerline.sources.tables import Tables

from conftest import SF_SMALL


def test_bronze_is_lossless_and_statuses_partition_rows(spark):
    t = Tables(spark, SF_SMALL)
    b = MD.bronze(t)
    sw = MD.status_write_back(t)
    assert sw.count() == b.count()
    by = {r.status: r["count"] for r in sw.groupBy("status").count().collect()}
    assert set(by) <= {Q.CLEAN, Q.QUARANTINED, Q.UNCLASSIFIED}
    assert by.get(Q.CLEAN, 0) == MD.silver_clean(t).count()
    assert by.get(Q.QUARANTINED, 0) == MD.silver_quarantine(t).count()


def test_repaired_silver_has_no_defects(spark):
    t = Tables(spark, SF_SMALL)
    s = MD.silver_repaired(t)
    assert s.where((F.col("runtime") < 0) | (F.col("budget") < Q.MIN_BUDGET)).count() == 0
    assert "value" not in s.columns
    assert s.count() == s.select("movie_id").distinct().count()


def test_transform_raw_metadata(spark):
    raw = spark.createDataFrame([('{"Id": 1}',)], "value string")
    r = MD.transform_raw(raw, "src", dt.datetime(2024, 5, 6, 7, 8, 9)).first()
    assert (r.datasource, r.status, r.p_ingestdate) == ("src", "new", dt.date(2024, 5, 6))
    live = MD.transform_raw(raw, "src").first()
    assert live.ingesttime is not None and live.p_ingestdate == live.ingesttime.date()


def test_dedupe_by_value_in_silver(spark):
    doc = '{"Id": 7, "RunTime": 5, "Budget": 2000000.0, "genres": [{"id": 1, "name": "a"}]}'
    bronze = spark.createDataFrame([(doc,), (doc,)], "value string")
    s = MD.refactor_silver(MD.transform_bronze(bronze))
    rows = s.collect()
    assert len(rows) == 1 and rows[0].genre_id == [1] and rows[0].original_language_id == 1


def test_lake_form(spark):
    rows = [(1, dt.datetime(2020, 1, 1, 5), [2])]
    silver = spark.createDataFrame(rows, "movie_id long, created_time timestamp_ntz, genre_id array<long>")
    lake = MD.silver_lake_form(silver).first()
    assert lake.genre_id == "[2]" and lake.created_date == dt.date(2020, 1, 1)
