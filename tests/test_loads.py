"""Procedures (Q21-Q24) on small fixtures and on sf0.001."""

import datetime as dt
import json

from pyspark.sql import functions as F

from ledgerline.operators.keys import with_row_index
from ledgerline.plans import file_jobs, loads
from ledgerline.sources import files as S
from ledgerline.sources.tables import Tables

from conftest import SF_SMALL

# Two invented purchase orders; the day of the second is malformed.
FIRST = dict(zip(loads.PURCHASE_ORDER_FIELDS, (
    "Tin lantern", "12", "3", "4", "Oldmill", "9", "2", "7.5", "18.40", "23.00", "1.25", "Norway", "Garden", "2021-03-04",
    "Rail", "2021-03-30", "REF-1")))
SECOND = {**FIRST, "StockItemName": "Clay jug", "Supplier": "31", "OuterPackageId": "8", "OrderDate": "2021-03-004",
          "SupplierReference": "REF-2"}
PO = {"PurchaseOrders": [FIRST, SECOND]}


def test_shred_inline_document(spark):
    rows = loads.shred_purchase_orders(S.inline_json(spark, json.dumps(PO)))
    out = rows.collect()
    assert len(out) == 2
    assert out[0].order_date == dt.date(2021, 3, 4) and out[1].order_date is None
    assert str(out[0].tax_rate) == "7.500" and str(out[0].unit_price) == "18.40"
    assert out[1].supplier_id == 31 and out[1].outer_package_id == 8
    assert [r.bad_fields for r in out] == [[], ["OrderDate"]]
    assert [r.supplier_reference for r in loads.good_rows(rows).collect()] == ["REF-1"]
    ids = with_row_index(rows.drop("bad_fields"), ["supplier_reference"], "sid", base=227)
    assert sorted(r.sid for r in ids.collect()) == [228, 229]


def test_guarded_load_matches_sequential_calls(spark):
    t = Tables(spark, SF_SMALL)
    days = [r[0].date() for r in t.orders.select("o_orderdate").distinct().orderBy("o_orderdate").limit(3).collect()]
    fast = loads.guarded_daily_load(t, days=tuple(days))
    state = loads.empty_ods_orders(t)
    errors = []
    for d in days + [days[0]]:
        r = loads.load_day(t, state, d)
        state = r.state
        errors.append(r.error_number)
    assert errors == [None, None, None, 50000]
    assert sorted(tuple(r) for r in fast.collect()) == sorted(tuple(r) for r in state.collect())


def test_strict_pk_rejects_multi_line_day(spark):
    t = Tables(spark, SF_SMALL)
    o = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_orderkey", "o_orderdate") \
        .count().where("count > 1").orderBy("o_orderdate").first()
    r = loads.load_day(t, loads.empty_ods_orders(t), o.o_orderdate.date(), strict_pk=True)
    assert r.error_number == 2627


def test_split_keeps_remainder(spark):
    items = spark.range(0, 21).withColumnRenamed("id", "k")
    got = {r.split_id: r["count"] for r in file_jobs.assign_splits(items, ["k"]).groupBy("split_id").count().collect()}
    assert got == {1: 2, 2: 2, 3: 2, 4: 2, 5: 2, 6: 2, 7: 2, 8: 7}
    tiny = {r.split_id for r in file_jobs.assign_splits(spark.range(3).withColumnRenamed("id", "k"), ["k"]).collect()}
    assert tiny == {8}


def test_clean_people_lines(spark):
    lines = spark.createDataFrame([
        ("first last middle phone address_no address",), ("o'neil mc-donald x 1234567890 123456 main st",),
        ("O'NEIL  MC-DONALD\tx 1234567890 123456 main st",), ("ann lee x 123-456 99 elm",)], "value string")
    got = sorted(r.line for r in file_jobs.clean_people(lines).collect())
    assert got == ["Ann,Lee,x,123-456,99,elm", "O'Neil,Mc-Donald,x,123-456-7890,3456,main,st"]
