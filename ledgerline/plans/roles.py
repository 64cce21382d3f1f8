"""Role mapping: the reference's wholesale schema expressed over the test tables.

The reference queries run against an order-management database
(orders, invoices, purchase orders, stock items, cities ...).  The test
tables are TPC-H shaped, so each reference table is a *view* over them:

=========================  ==================================================
reference role             test-table expression
=========================  ==================================================
Orders / Invoices /        ``orders`` (transaction date = ``o_orderdate``)
CustomerTransactions
OrderLines / InvoiceLines  ``lineitem``; sold lines ``l_linestatus = 'F'``,
/ PurchaseOrderLines       purchased lines ``l_linestatus = 'O'``
StockItems                 ``part`` (item name = ``p_name``)
StockItemStockGroups       bridge ``explode(array(p_type, p_brand))``
Customers / Suppliers      ``customer`` / ``supplier``
Cities / StateProvinces    ``nation`` / ``region``
JSON custom fields         ``events.props`` (``{"k": n}``)
=========================  ==================================================

Quantities are integral doubles in the test data and are cast to ``bigint``;
money is cast to decimal before any arithmetic so that sums are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.tables import Tables

SOLD = "F"
PURCHASED = "O"


def lines(t: Tables, status: str | None = None) -> DataFrame:
    df = t.lineitem
    if status is not None:
        df = df.where(F.col("l_linestatus") == status)
    return df


def quantity() -> F.Column:
    return F.col("l_quantity").cast("bigint")


def stock_groups(t: Tables) -> DataFrame:
    """Many-to-many item -> group bridge: every part is in its type and its brand group."""
    return t.part.select(
        F.col("p_partkey").alias("g_partkey"),
        F.explode(F.array(F.col("p_type"), F.col("p_brand"))).alias("group_name"),
    )


def order_lines_typed(t: Tables) -> DataFrame:
    """Order lines in the reference's typed shape (order-lines table, FIXTURES 1.6)."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("OrderID"),
        F.col("l_linenumber").alias("OrderLineID"),
        F.col("l_partkey").alias("StockItemID"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("UnitPrice"),
        F.col("l_tax").cast("decimal(18,3)").alias("TaxRate"),
        F.col("l_shipdate").alias("PickingCompletedWhen"),
    )
