"""OLTP -> ODS -> integration -> star schema (P4, P5) over the test tables.

``orders_table`` / ``order_lines_table`` are typed views of ``orders`` /
``lineitem`` (FIXTURES 1.6).  The incremental load runs two watermark
rounds against two snapshots of the source: first everything ordered before
the cut-off, then everything, with the orders of the month before the
cut-off edited after it (so the second round both inserts and updates).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import dialect as D
from ledgerline.operators import incremental as INC
from ledgerline.operators import warehouse as W
from ledgerline.plans import roles as R
from ledgerline.session import checkpoint_dir
from ledgerline.sinks import published as PB
from ledgerline.sources.tables import Tables

WATERMARK_SEED = dt.datetime(1990, 1, 1, 0, 0, 0)
CUTOFF = "1998-01-01"
EDIT_FROM = "1997-12-01"
EDITED_AT = "1998-06-30 12:00:00"

ORDERS_SPEC = INC.TableSpec("orders_table", ["OrderID"], "LastEditedWhen")
# Line numbers start anew in every order, so the key has all three parts.
LINES_SPEC = INC.TableSpec("order_lines_table", ["OrderID", "OrderLineID", "StockItemID"], "LastEditedWhen")


def orders_table(t: Tables) -> DataFrame:
    """Typed order headers; ``LastEditedWhen`` is text as in the reference."""
    o = t.orders
    day = F.col("o_orderdate").cast("date")
    return o.select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("SalespersonPersonID"),
        F.when(F.col("o_orderstatus") == "F", F.substring("o_orderpriority", 1, 1).cast("int")).alias("PickedByPersonID"),
        (F.col("o_custkey") % 100).cast("int").alias("ContactPersonID"),
        F.lit(None).cast("bigint").alias("BackorderOrderID"),
        day.alias("OrderDate"),
        F.date_add(day, 7).alias("ExpectedDeliveryDate"),
        F.col("o_orderpriority").alias("CustomerPurchaseOrderNumber"),
        (F.col("o_orderstatus") == "P").alias("IsUndersupplyBackordered"),
        F.col("o_orderstatus").alias("Comments"),
        F.lit(None).cast("string").alias("DeliveryInstructions"),
        F.lit(None).cast("string").alias("InternalComments"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(1))).alias("PickingCompletedWhen"),
        F.lit(1).alias("LastEditedBy"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("LastEditedWhen"),
    )


def order_lines_table(t: Tables) -> DataFrame:
    """Typed order lines, all 12 columns; a line was last edited when its picking was completed."""
    lines = R.order_lines_typed(t)
    return lines.select(
        "OrderLineID", "OrderID", "StockItemID",
        F.concat_ws(" ", F.lit("line"), F.col("OrderLineID").cast("string")).alias("Description"),
        (F.col("StockItemID") % 14 + 1).cast("int").alias("PackageTypeID"), "Quantity", "UnitPrice", "TaxRate",
        F.col("Quantity").alias("PickedQuantity"), "PickingCompletedWhen", F.lit(1).alias("LastEditedBy"),
        F.col("PickingCompletedWhen").alias("LastEditedWhen"))


def source_snapshot(t: Tables, phase: int) -> DataFrame:
    """The OLTP orders table as seen by load round ``phase`` (1 or 2)."""
    o = orders_table(t)
    if phase == 1:
        return o.where(F.col("OrderDate") < D.date_lit(CUTOFF))
    edited = (F.col("OrderDate") >= D.date_lit(EDIT_FROM)) & (F.col("OrderDate") < D.date_lit(CUTOFF))
    return (o.withColumn("Comments", F.when(edited, F.lit("edited")).otherwise(F.col("Comments")))
            .withColumn("LastEditedWhen", F.when(edited, F.lit(EDITED_AT)).otherwise(F.col("LastEditedWhen"))))


def _two_rounds(t: Tables, spec: INC.TableSpec, first: DataFrame, second: DataFrame) -> DataFrame:
    control = INC.control_table(t.spark, {ORDERS_SPEC.name: WATERMARK_SEED, LINES_SPEC.name: WATERMARK_SEED})
    target, control = INC.incremental_upsert(first.limit(0), first, control, spec)
    target, control = INC.incremental_upsert(target, second, control, spec)
    return target


def incremental_upsert(t: Tables) -> DataFrame:
    """Two watermark-bounded rounds of extract -> upsert (INC1-INC5, DML1, DML2).

    Round 1 loads everything up to the first watermark; round 2 loads
    ``(old, new]``: orders after the cut-off plus the re-edited ones, which
    replace their earlier versions by key.
    """
    return _two_rounds(t, ORDERS_SPEC, source_snapshot(t, 1), source_snapshot(t, 2))


def incremental_upsert_lines(t: Tables) -> DataFrame:
    """P4 for the second configured table (INC6): lines completed before the cut-off, then all."""
    lines = order_lines_table(t)
    return _two_rounds(t, LINES_SPEC, lines.where(F.col("LastEditedWhen") < D.ntz(CUTOFF)), lines)


def null_watermark_report(t: Tables) -> DataFrame:
    """Orders whose watermark text is missing or no timestamp; no load would ever pick them up."""
    damaged = orders_table(t).withColumn("LastEditedWhen", F.when(F.col("OrderID") % 97 == 0, F.lit(None).cast("string"))
                                         .when(F.col("OrderID") % 101 == 0, F.lit("not yet")).otherwise(F.col("LastEditedWhen")))
    return INC.null_watermarks(damaged, "LastEditedWhen").select("OrderID", "LastEditedWhen")


def fact_orders(t: Tables) -> DataFrame:
    """P5/DIM1: the fact table (surrogate ``OrderKey`` omitted for the oracle check)."""
    return W.build_fact_orders(orders_table(t), order_lines_table(t), with_key=False)


def dim_customers(t: Tables) -> DataFrame:
    """P5/DIM2: customer validity intervals from the fact's change times."""
    return W.build_customer_dimension(fact_orders(t), "CustomerKey")


#: Buckets of the published tables of the queries below.
BUCKETS = 16


def _published(t: Tables, name: str) -> tuple[str, str]:
    """(table, folder) of a published table of this run's own."""
    own = f"{name}_{uuid.uuid4().hex}"
    return own, f"{checkpoint_dir(t.spark).rstrip('/')}/published/{own}"


def incremental_upsert_buckets(t: Tables) -> DataFrame:
    """P4 into a published table (DML1, INC5, SNK4): the second round writes only the buckets of its keys, each by a change of
    its place in the catalog."""
    table, base = _published(t, "orders_by_key")
    control = INC.control_table(t.spark, {ORDERS_SPEC.name: WATERMARK_SEED})
    for phase in (1, 2):
        source = source_snapshot(t, phase)
        round_ = INC.incremental_upsert(source.limit(0), source, control, ORDERS_SPEC)
        PB.upsert_buckets(round_.batch, ORDERS_SPEC.keys, table, base, BUCKETS)
        control = round_.control
    return t.spark.table(table).drop(PB.BUCKET)


def dim_customers_incremental(t: Tables) -> DataFrame:
    """P5/DIM2 over two batches: the second one's orders lie between those of the first, so their changes come late."""
    table, base = _published(t, "dim_customers")
    late = F.col("WWIOrderID") % 3 == 0
    for batch in (fact_orders(t).where(~late), fact_orders(t).where(late)):
        PB.update_dimension(batch, table, base, BUCKETS)
    return t.spark.table(table).drop(PB.BUCKET)


def compacted_orders(t: Tables, target_bytes: int = 32 * 1024 * 1024) -> DataFrame:
    """SNK9: a published table of orders by year, written in many small files, compacted and read back with its files' number."""
    table, base = _published(t, "orders_by_year")
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").alias("year"))
    PB.publish_partitions(orders.repartition("o_custkey"), table, base, "year")
    PB.compact(t.spark, table, base, "year", target_bytes)
    crowded = PB.crowded_partitions(t.spark, table, "year", target_bytes).select("year", F.lit(True).alias("_crowded"))
    out = t.spark.table(table).join(F.broadcast(crowded), "year", "left")  # one row a year at most
    return out.select("o_orderkey", "o_custkey", "o_orderstatus", "year", F.coalesce("_crowded", F.lit(False)).alias("crowded"))
