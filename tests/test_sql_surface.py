"""SQL functions, table functions and views against their DataFrame forms (UDF1, UDF2, Q18-Q20)."""

import datetime as dt

import pytest

from ledgerline.plans import loads, reports, sql_surface as SQ
from ledgerline.sources.tables import Tables

from conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r[c] for c in sorted(df.columns)) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_equal_to_the_dataframe_forms(spark):
    t = Tables(spark, SF_SMALL)
    assert rows(SQ.order_totals(t)) == rows(reports.invoice_with_total(t))
    assert rows(SQ.sales_by_group(t)) == rows(reports.pivot_group_by_year(t))
    assert rows(SQ.sales_by_year(t)) == rows(reports.pivot_year_by_group(t))
    days = [dt.date(1996, 1, d) for d in range(1, 6)]
    assert rows(SQ.orders_between(t)) == rows(loads.orders_of_day_set(t, days))


def test_functions_by_hand(spark):
    t = Tables(spark, SF_SMALL)
    p = SQ.install(spark, t)
    want = reports.invoice_with_total(t).where("o_orderkey = 1").first()
    got = spark.sql(f"SELECT {p}order_total(1) AS x, {p}order_total(-1) AS none, {p}order_total(NULL) AS unknown").first()
    assert got.x == (want.order_total if want else None) and got.none is None and got.unknown is None
    one = spark.sql(f"SELECT * FROM {p}orders_of_day(DATE'1996-01-03')")
    assert rows(one) == rows(loads.orders_of_day_set(t, [dt.date(1996, 1, 3)]))
    assert spark.sql(f"SELECT * FROM {p}orders_between(DATE'1996-01-05', DATE'1996-01-01')").count() == 0


def test_plans(spark):
    """The scalar function is one aggregate and a join; the day range is pushed to the scan."""
    t = Tables(spark, SF_SMALL)
    total = plan(SQ.order_totals(t))
    assert "LeftOuter" in total and "NestedLoop" not in total and "Cartesian" not in total
    between = plan(SQ.orders_between(t))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00), LessThan(o_orderdate,1" in between  # the rest is cut off


def test_objects_of_the_catalog(spark):
    t = Tables(spark, SF_SMALL)
    spark.sql("CREATE DATABASE IF NOT EXISTS sqlsurface")
    try:
        for name in SQ.TABLES:
            spark.catalog.createTable(f"sqlsurface.{name}", path=t.path(name), source="parquet")
        assert SQ.install(spark, schema="sqlsurface") == "sqlsurface."
        SQ.install(spark, schema="sqlsurface")  # again: replaced
        assert rows(spark.sql("SELECT o.*, sqlsurface.order_total(o_orderkey) AS order_total FROM sqlsurface.orders o")) == rows(
            reports.invoice_with_total(t))
        assert rows(spark.table("sqlsurface.sales_by_group")) == rows(reports.pivot_group_by_year(t))
        other = spark.newSession()
        other.sql("USE sqlsurface")
        assert rows(other.sql("SELECT * FROM orders_of_day(DATE'1996-01-03')")) == rows(
            loads.orders_of_day_set(t, [dt.date(1996, 1, 3)]))
    finally:
        spark.sql("DROP DATABASE sqlsurface CASCADE")
    with pytest.raises(ValueError):
        SQ.install(spark, schema="x; DROP")
