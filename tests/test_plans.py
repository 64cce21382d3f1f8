"""Physical-plan properties that must hold for every registered query (scale guards)."""

import re

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

KEYS = sorted(E.queries())
FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


def executed(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_nested_loop_cartesian_or_python(spark, key):
    text = executed(E.queries()[key](spark, SF_SMALL))
    assert not [f for f in FORBIDDEN if f in text]


def test_flagship_pushes_filters_and_prunes(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        text = executed(E.queries()["item_quantity_in_year"](spark, SF_SMALL))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = [line for line in text.splitlines() if "lineitem.parquet" in line][0]
    assert "EqualTo(l_linestatus,O)" in scan and "GreaterThanOrEqual(l_shipdate" in scan and "LessThan(l_shipdate" in scan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
    assert sorted(f.split(":")[0] for f in schema.split(",")) == ["l_linestatus", "l_partkey", "l_quantity", "l_shipdate"]


def test_top_per_group_has_no_window(spark):
    assert "Window" not in executed(E.queries()["top_item_per_region"](spark, SF_SMALL))


def test_dimension_window_is_split_by_day(spark):
    text = executed(E.queries()["dim_customers"](spark, SF_SMALL))
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert windows and all("_bucket" in w or "CustomerKey" not in w.split("windowspecdefinition(")[1].split(",")[0]
                           for w in windows)


def test_status_write_back_is_map_only(spark):
    text = executed(E.queries()["status_write_back"](spark, SF_SMALL))
    # The classification itself adds no join; the only joins build the raw documents.
    docs = executed(E.queries()["bronze_ingest"](spark, SF_SMALL))
    assert text.count("Join") == docs.count("Join")


def test_no_key_deals_rows_out_round_robin(spark):
    from ledgerline.plans import registry
    for key in registry.PLANS:
        plan = registry.run(spark, SF_SMALL, key)._jdf.queryExecution().executedPlan().toString()
        assert "RoundRobin" not in plan, key


def test_facts_are_read_once_per_use(spark):
    from ledgerline.plans import registry
    uses = {"constraint_violations": {"lineitem": 2, "orders": 4}, "lapsed_customers": {"orders": 2}, "bronze_ingest": {"lineitem": 0, "orders": 1},
            "dim_customers": {"lineitem": 2, "orders": 2}}
    for key, tables in uses.items():
        plan = registry.run(spark, SF_SMALL, key)._jdf.queryExecution().optimizedPlan().toString()
        for table, most in tables.items():
            column = {"lineitem": "l_", "orders": "o_"}[table]
            scans = [x for x in plan.splitlines() if "Relation" in x and column in x]
            assert len(scans) <= most, (key, table, len(scans))
