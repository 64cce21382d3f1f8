"""Procedures that load tables (Q21-Q24): guarded daily load, typed migration,
rolling reload, JSON purchase-order shredding.

Each returns the resulting table state as a DataFrame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DateType, DecimalType, LongType, StringType, StructField,
                               StructType)

from ledgerline.functions import dialect as D
from ledgerline.functions import json as J
from ledgerline.operators import mutation as M
from ledgerline.operators.keys import with_key_index
from ledgerline.plans.reports import YEARS, line_total
from ledgerline.sources.tables import Tables

ODS_ORDERS = StructType([
    StructField("order_id", LongType(), False),
    StructField("order_date", DateType(), False),
    StructField("order_total", DecimalType(19, 4), False),
    StructField("customer_id", LongType(), False),
])


def _day_ranges(col: str, days) -> F.Column:
    """OR of half-open day ranges on the raw timestamp column (pushed into the scan)."""
    cond = None
    for d in days:
        c = (F.col(col) >= D.ntz(d)) & (F.col(col) < D.ntz(d + dt.timedelta(days=1)))
        cond = c if cond is None else cond | c
    return cond if cond is not None else F.lit(False)


def orders_of_day_set(t: Tables, days) -> DataFrame:
    """Rows for ``ods.Orders``: one per order dated on one of ``days``.

    The reference inserts one row per order *line* under an OrderID primary
    key (S12), which rejects every day with a multi-line order; here lines
    are summed to one row per order (``strict_pk`` in :func:`load_day`
    reproduces the rejection instead).
    """
    o = t.orders.where(_day_ranges("o_orderdate", days))
    lines = t.lineitem.select("l_orderkey", line_total().alias("line_total"))
    j = o.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return j.groupBy("o_orderkey", "o_orderdate", "o_custkey").agg(F.sum("line_total").alias("t")).select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("t").cast("decimal(19,4)").alias("order_total"), F.col("o_custkey").alias("customer_id"))


def orders_of_days(t: Tables, first: dt.date, last: dt.date) -> DataFrame:
    """As :func:`orders_of_day_set` for every day in [first, last]."""
    return orders_of_day_set(t, [first + dt.timedelta(days=i) for i in range((last - first).days + 1)])


def empty_ods_orders(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([], ODS_ORDERS)


def load_day(t: Tables, state: DataFrame, day: dt.date, strict_pk: bool = False) -> M.LoadResult:
    """UDF2 ``uspGetOrdersByDate(@OrderDate)`` version 1 for one day (DML6)."""
    rows = orders_of_day_set(t, [day])
    if strict_pk:
        per_line = (t.orders.where(_day_ranges("o_orderdate", [day]))
                    .join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")))
        if M.exists(per_line.groupBy("o_orderkey").count().where(F.col("count") > 1)):
            return M.LoadResult(state, 2627, "Violation of PRIMARY KEY constraint")
    return M.guarded_append(state, rows, "order_date", day)


DEFAULT_DAYS = [dt.date(YEARS[2013], 1, d) for d in range(1, 6)]


def guarded_days(state: DataFrame, date_col: str, run) -> tuple[list, list]:
    """Split a sequence of procedure calls into accepted and rejected days.

    A call is rejected when its day is already in the table, either from
    before the run or from an earlier call of the same run.  The only
    action reads the distinct already-present days among ``run`` (at most
    ``len(run)`` values), so all accepted days then load in one job.
    """
    present = {r[0] for r in state.where(F.col(date_col).isin(list(run))).select(date_col).distinct().collect()}
    accepted, rejected = [], []
    for d in run:
        (rejected if d in present else accepted).append(d)
        present.add(d)
    return accepted, rejected


def guarded_daily_load(t: Tables, days=tuple(DEFAULT_DAYS), repeat_first: bool = True,
                       start: DataFrame | None = None) -> DataFrame:
    """Q21: the guarded load called once per day; a repeated day is rejected.

    Same final state as calling :func:`load_day` in sequence, without
    re-evaluating the growing table before every call.
    """
    state = start if start is not None else empty_ods_orders(t)
    run = list(days) + ([days[0]] if repeat_first else [])
    accepted, _ = guarded_days(state, "order_date", run)
    if not accepted:
        return state
    return state.unionByName(orders_of_day_set(t, accepted).select(*state.columns))


def rolling_reload(t: Tables, day: dt.date = DEFAULT_DAYS[2], horizon: int = 7,
                   start: DataFrame | None = None) -> DataFrame:
    """Q23: version 2 of the procedure: purge before ``day``, load ``day .. day+horizon``.

    ``DATEDIFF(DAY, @d, OrderDate) BETWEEN 0 AND 7`` spans eight days (S13).
    Starts from the state left by :func:`guarded_daily_load`.
    """
    state = start if start is not None else guarded_daily_load(t)
    rows = orders_of_days(t, day, day + dt.timedelta(days=horizon))
    return M.rolling_reload(state, rows, "order_date", day, ["order_id"])


def typed_migration(t: Tables) -> DataFrame:
    """Q22: migrate items into a typed table with JSON and date-difference columns.

    Items = events; custom fields = ``props``; valid-from = ``ts`` and
    valid-to = ``ts`` plus ``floor(value)`` days.  ``Range`` counts day
    boundaries and ``Shelflife`` month boundaries between them (S14), and
    the weight column is filled from ``value`` as in the reference.  All 21
    columns of the target are filled; what events have no role for comes from
    their id, user and time.
    """
    e = t.events
    money = F.col("value").cast("decimal(18,2)")
    valid_to = F.col("ts") + F.make_dt_interval(F.floor("value").cast("int"))
    return e.select(
        F.col("event_id").alias("stock_item_id"),
        F.col("event_type").alias("stock_item_name"),
        F.col("user_id").alias("supplier_id"),
        F.when(F.col("user_id") % 3 != 0, F.col("user_id") % 36).cast("int").alias("color_id"),
        (F.col("event_id") % 14 + 1).cast("int").alias("unit_package_id"),
        (F.col("event_id") % 7 + 1).cast("int").alias("outer_package_id"),
        F.upper("event_type").alias("brand"),
        F.when(F.col("event_id") % 5 == 0, F.lit("L")).alias("size"),
        F.hour("ts").alias("lead_time_days"),
        F.minute("ts").alias("quantity_per_outer"),
        (F.col("event_id") % 10 == 0).alias("is_chiller_stock"),
        F.col("event_id").cast("string").alias("barcode"),
        F.lit("15").cast("decimal(18,3)").alias("tax_rate"),
        money.alias("unit_price"),
        (money * F.lit("1.25").cast("decimal(3,2)")).cast("decimal(18,2)").alias("recommended_retail_price"),
        F.col("value").cast("decimal(18,3)").alias("typical_weight_before_unit"),
        F.lit(None).cast("string").alias("marketing_comments"),
        F.lit(None).cast("string").alias("internal_comments"),
        J.json_value("props", '$."k"').alias("country_of_manufacture"),
        D.datediff_days(F.col("ts"), valid_to).alias("range_days"),
        D.datediff_months(F.col("ts"), valid_to).alias("shelf_life_months"),
    )


# The purchase-order document's field names, in document order.
PURCHASE_ORDER_FIELDS = [
    "StockItemName", "Supplier", "UnitPackageId", "OuterPackageId", "Brand", "LeadTimeDays",
    "QuantityPerOuter", "TaxRate", "UnitPrice", "RecommendedRetailPrice", "TypicalWeightPerUnit",
    "CountryOfManufacture", "Range", "OrderDate", "DeliveryMethod", "ExpectedDeliveryDate",
    "SupplierReference",
]

# Declared types of the fields that aren't text.
TYPED_FIELDS = {
    "Supplier": "bigint", "UnitPackageId": "int", "OuterPackageId": "int", "LeadTimeDays": "int", "QuantityPerOuter": "int",
    "TaxRate": "decimal(18,3)", "UnitPrice": "decimal(18,2)", "RecommendedRetailPrice": "decimal(18,2)",
    "TypicalWeightPerUnit": "decimal(18,3)", "OrderDate": "date", "ExpectedDeliveryDate": "date",
}

PURCHASE_ORDER_SCHEMA = StructType([StructField(
    "PurchaseOrders", ArrayType(StructType([StructField(f, StringType()) for f in PURCHASE_ORDER_FIELDS])))])


def purchase_order_documents(t: Tables) -> DataFrame:
    """One purchase-order JSON document per order; every value is a string (FIXTURES 1.9)."""
    o = t.orders
    s = lambda c: c.cast("string")
    po = F.struct(
        F.col("o_orderpriority").alias("StockItemName"),
        s(F.col("o_custkey")).alias("Supplier"),
        F.lit("1").alias("UnitPackageId"),
        s(F.length("o_orderpriority")).alias("OuterPackageId"),
        F.col("o_orderstatus").alias("Brand"),
        F.lit("5").alias("LeadTimeDays"),
        F.lit("1").alias("QuantityPerOuter"),
        F.lit("6").alias("TaxRate"),
        s(F.col("o_totalprice").cast("decimal(18,2)")).alias("UnitPrice"),
        s((F.col("o_totalprice").cast("decimal(18,2)") * F.lit(1.25).cast("decimal(3,2)"))
          .cast("decimal(18,2)")).alias("RecommendedRetailPrice"),
        F.lit("0.5").alias("TypicalWeightPerUnit"),
        F.col("o_orderstatus").alias("CountryOfManufacture"),
        F.lit("Adult").alias("Range"),
        # Every fiftieth document has a malformed day.
        F.when(F.col("o_orderkey") % 50 == 0, F.date_format("o_orderdate", "yyyy-MM-0dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("OrderDate"),
        F.lit("Post").alias("DeliveryMethod"),
        F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 32), "yyyy-MM-dd").alias("ExpectedDeliveryDate"),
        F.concat(F.lit("WWI"), s(F.col("o_orderkey"))).alias("SupplierReference"),
    )
    return o.select(F.col("o_orderkey").alias("doc_id"),
                    F.to_json(F.struct(F.array(po).alias("PurchaseOrders"))).alias("doc"))


def shred_purchase_orders(docs: DataFrame) -> DataFrame:
    """JS6 / SRC10: parse string-typed documents, unroll the array, type each field.

    Declared types are applied with ``try_cast``; the names of fields whose text
    doesn't fit its type (a day such as ``01-025``) are listed in
    ``bad_fields``.  Loads take :func:`good_rows`, the others are quarantined.
    A document's id and a row's place in it (``doc_line``) are the row's key.
    """
    parsed = docs.select("doc_id", F.posexplode_outer(F.from_json("doc", PURCHASE_ORDER_SCHEMA)["PurchaseOrders"])
                         .alias("doc_line", "po")).where(F.col("po").isNotNull())
    # A generator, so that each text is cast once: a filter on the casts can't be pushed below it.
    casts = F.struct(*[F.col(f"po.{f}").try_cast(kind).alias(f) for f, kind in TYPED_FIELDS.items()])
    rows = parsed.select("doc_id", "doc_line", "po", F.explode_outer(F.array(casts)).alias("typed"))
    bad = F.filter(F.array(*[F.when(F.col(f"po.{f}").isNotNull() & F.col(f"typed.{f}").isNull(), F.lit(f))
                             for f in TYPED_FIELDS]), lambda x: x.isNotNull())
    field = lambda f: F.col(f"typed.{f}" if f in TYPED_FIELDS else f"po.{f}")
    return rows.select(
        "doc_id", "doc_line",
        field("StockItemName").alias("stock_item_name"),
        field("Supplier").alias("supplier_id"),
        field("UnitPackageId").alias("unit_package_id"),
        field("OuterPackageId").alias("outer_package_id"),
        field("Brand").alias("brand"),
        field("LeadTimeDays").alias("lead_time_days"),
        field("QuantityPerOuter").alias("quantity_per_outer"),
        field("TaxRate").alias("tax_rate"),
        field("UnitPrice").alias("unit_price"),
        field("RecommendedRetailPrice").alias("recommended_retail_price"),
        field("TypicalWeightPerUnit").alias("typical_weight_per_unit"),
        field("CountryOfManufacture").alias("country_of_manufacture"),
        field("OrderDate").alias("order_date"),
        field("ExpectedDeliveryDate").alias("expected_delivery_date"),
        field("SupplierReference").alias("supplier_reference"),
        bad.alias("bad_fields"),
    )


def good_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("bad_fields") == 0).drop("bad_fields")


def json_shred_quarantine(t: Tables) -> DataFrame:
    """Purchase orders that don't fit their declared types, with the fields that don't."""
    rows = shred_purchase_orders(purchase_order_documents(t))
    return rows.where(F.size("bad_fields") > 0).select(
        "doc_id", "supplier_reference", F.array_join("bad_fields", ",").alias("bad_fields"))


# Defaults the reference inserts for new stock items.
VALID_FROM = "2016-05-31 23:00:00"
VALID_TO = "9999-12-31 23:59:59.999999"


def json_shred_load(t: Tables) -> DataFrame:
    """Q24 (stock items): new items from the shredded documents.

    Ids continue after the current maximum item id (``MAX(id) + 1`` per row,
    corrected to ``+n`` so consecutive rows do not collide, S15).  Custom
    fields are built as JSON with escaping (JS10) instead of concatenation.
    """
    rows = good_rows(shred_purchase_orders(purchase_order_documents(t)))
    base = t.part.select(F.max("p_partkey")).scalar()
    rows = with_key_index(rows, ["doc_id", "doc_line"], "stock_item_id", base=base)
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    return rows.select(
        "stock_item_id", "stock_item_name", "supplier_id", none("int", "color_id"), "unit_package_id", "outer_package_id",
        "brand", none("string", "size"), "lead_time_days", "quantity_per_outer", F.lit(False).alias("is_chiller_stock"),
        none("string", "barcode"), "tax_rate", "unit_price", "recommended_retail_price", "typical_weight_per_unit",
        none("string", "marketing_comments"), none("string", "internal_comments"), none("string", "photo"),
        J.build_json(CountryOfManufacture=F.col("country_of_manufacture")).alias("custom_fields"),
        F.lit("[]").alias("tags"), F.lit("None").alias("search_details"), F.lit(1).alias("last_edited_by"),
        D.ntz(VALID_FROM).alias("valid_from"), D.ntz(VALID_TO).alias("valid_to"),
    )


def json_shred_purchase_orders(t: Tables) -> DataFrame:
    """Q24 (purchase orders): one order per document, all 12 target columns.

    ``LastEditedWhen = DATEADD(DAY, 1, OrderDate)`` (FN5).  The reference's
    random supplier and editor ids (FN14) are hashes of the document id, so
    that a repeated load gives the same rows; constants are FN27's defaults.
    """
    rows = good_rows(shred_purchase_orders(purchase_order_documents(t)))
    base = t.orders.select(F.max("o_orderkey")).scalar()
    rows = with_key_index(rows, ["doc_id", "doc_line"], "purchase_order_id", base=base)
    return rows.select(
        "purchase_order_id", D.pseudo_random_key(F.col("doc_id"), 13).alias("supplier_id"), "order_date",
        F.lit(1).alias("delivery_method_id"), F.lit(2).alias("contact_person_id"), "expected_delivery_date",
        "supplier_reference", F.lit(True).alias("is_order_finalized"), F.lit(None).cast("string").alias("comments"),
        F.lit(None).cast("string").alias("internal_comments"),
        D.pseudo_random_key(F.col("doc_id"), 20, seed=7).alias("last_edited_by"),
        F.date_add("order_date", 1).alias("last_edited_when"))
