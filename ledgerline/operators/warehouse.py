"""Star-schema builders (DIM1, DIM2, WIN2, WIN3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.keys import with_row_index
from ledgerline.operators.windows import split_lead


def build_fact_orders(orders: DataFrame, lines: DataFrame, with_key: bool = True) -> DataFrame:
    """DIM1: ``Fact.Orders`` = order header x order lines with money columns.

    Each money column is computed from the typed inputs and rounded to
    ``decimal(18,2)`` on its own (S19: total may differ from excl + tax by
    0.01).  ``CreatedAt`` is the header's last-edit time cast to timestamp.
    ``OrderKey`` (IDENTITY) is assigned by :func:`with_row_index`.
    """
    o, ol = orders.alias("o"), lines.alias("ol")
    qty = F.col("ol.Quantity")
    price = F.col("ol.UnitPrice")
    rate = F.col("ol.TaxRate")
    excl = qty * price
    tax = qty * price * rate
    fact = o.join(ol, F.col("o.OrderID") == F.col("ol.OrderID")).select(
        F.col("o.CustomerID").alias("CustomerKey"),
        F.col("ol.StockItemID").alias("StockItemKey"),
        F.col("o.OrderDate").alias("OrderDateKey"),
        F.col("o.PickingCompletedWhen").cast("date").alias("PickedDateKey"),
        F.col("o.SalespersonPersonID").alias("SalespersonKey"),
        F.col("o.PickedByPersonID").alias("PickerKey"),
        F.col("o.OrderID").alias("WWIOrderID"),
        F.col("o.BackorderOrderID").alias("WWIBackorderID"),
        F.col("ol.Description").alias("Description"),
        qty.alias("Quantity"), price.alias("UnitPrice"), rate.alias("TaxRate"),
        excl.cast("decimal(18,2)").alias("TotalExcludingTax"),
        tax.cast("decimal(18,2)").alias("TaxAmount"),
        (excl + tax).cast("decimal(18,2)").alias("TotalIncludingTax"),
        F.col("o.LastEditedWhen").cast("timestamp_ntz").alias("CreatedAt"),
    )
    if with_key:
        fact = with_row_index(fact, ["WWIOrderID", "StockItemKey", "Quantity", "UnitPrice", "TaxRate"], "OrderKey")
    return fact


def build_customer_dimension(fact: DataFrame, partition_col: str = "CustomerKey") -> DataFrame:
    """DIM2: validity intervals from consecutive change times (WIN2, WIN3).

    ``ValidTo = LEAD(CreatedAt) OVER (PARTITION BY partition_col ORDER BY CreatedAt)``,
    ``Active = 1`` when there is no later change.  The reference partitions
    by the unique ``OrderKey`` (S20), which makes every row active; the
    default here is the customer, and ``partition_col="OrderKey"`` gives
    the faithful form.  By customer, lines of one change time are one change,
    so there is no interval of length zero.
    """
    base = fact.select("CustomerKey", partition_col, "CreatedAt") if partition_col != "CustomerKey" \
        else fact.select("CustomerKey", "CreatedAt").distinct()
    if partition_col == "OrderKey":
        # Unique key: every window partition has one row, nothing can be hot.
        led = base.withColumn("ValidTo", F.lead("CreatedAt").over(Window.partitionBy(partition_col).orderBy("CreatedAt")))
    else:
        # A customer may own a large share of the rows: split its history by day.
        led = split_lead(base, partition_col, "CreatedAt", "ValidTo")
    return _intervals(led)


def _intervals(led: DataFrame) -> DataFrame:
    return led.select(
        F.col("CustomerKey"), F.col("CreatedAt").alias("ValidFrom"), F.col("ValidTo"),
        F.when(F.col("ValidTo").isNull(), 1).otherwise(0).alias("Active"))


def merge_customer_changes(dim: DataFrame, changes: DataFrame) -> DataFrame:
    """DIM2, incrementally: the dimension after further changes (CustomerKey, CreatedAt), of customers known or new.

    Customers without a change, and intervals that ended before a customer's
    first new change, stay as they are.  The interval that holds the change is
    closed by it and another one opened; a late change so splits the interval
    it falls into, one before the first interval opens an earlier one, and one
    that is already there changes nothing.  Equal to a rebuild from all changes.
    """
    new = changes.select("CustomerKey", "CreatedAt").distinct()
    # A change without a time sorts before all others.
    first = new.groupBy(F.col("CustomerKey").alias("_customer")).agg(
        F.min("CreatedAt").alias("_first"), F.max(F.col("CreatedAt").isNull()).alias("_timeless"))
    held = dim.join(first, F.col("CustomerKey").eqNullSafe(F.col("_customer")), "left")
    over = F.col("_timeless").isNull() | (~F.col("_timeless") & (F.col("ValidTo") <= F.col("_first")))
    over = F.coalesce(over, F.lit(False))
    columns = ["CustomerKey", "ValidFrom", "ValidTo", "Active"]
    starts = held.where(~over).select("CustomerKey", F.col("ValidFrom").alias("CreatedAt")).unionByName(new).distinct()
    return held.where(over).select(columns).unionByName(_intervals(split_lead(starts, "CustomerKey", "CreatedAt", "ValidTo")))
