"""Scan / dedupe / constraint queries over the raw test tables (SRC4, PRJ1, FLT1-FLT5,
AGG12-AGG13, QA1, JN15) and the batch form of the sensor window (P6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

from ledgerline.functions import dialect as D
from ledgerline.functions import json as J
from ledgerline.operators import aggregates as A
from ledgerline.operators import joins as JN
from ledgerline.operators import keys as K
from ledgerline.operators import projection as P
from ledgerline.operators import quality as Q
from ledgerline.sources.tables import Tables
from ledgerline.plans import medallion as MD
from ledgerline.streaming import ingest as IN
from ledgerline.streaming import sensor as S


def scan_filter_project(t: Tables, first: str = "1996-01-01", last: str = "1996-12-31",
                        min_quantity: int = 25) -> DataFrame:
    """Projection with aliases and a conjunctive filter that reaches the Parquet scan."""
    li = t.lineitem
    return li.where(F.col("l_shipdate").between(D.ntz(first), D.ntz(last)) &
                    (F.col("l_quantity") >= min_quantity) & F.col("l_discount").isNotNull()).select(
        F.col("l_orderkey").alias("order_key"), F.col("l_partkey").alias("item_key"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))


def dedupe_first_by_key(t: Tables) -> DataFrame:
    """One line per (order, line number); the earliest-shipped one, ties by the other columns."""
    return A.dedupe_first(t.lineitem, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def constraint_violations(t: Tables) -> DataFrame:
    """QA1: primary-key, not-null and foreign-key violations as one table."""
    li, o = t.lineitem, t.orders
    parts = [
        Q.primary_key_violations(li, "lineitem", ["l_orderkey", "l_linenumber"]),
        Q.primary_key_violations(o, "orders", ["o_orderkey"]),
        Q.not_null_violations(o, "orders", ["o_custkey", "o_orderdate"], ["o_orderkey"]),
        Q.foreign_key_violations(li, "lineitem", {
            "l_orderkey": (o, "o_orderkey"), "l_partkey": (t.part, "p_partkey"), "l_suppkey": (t.supplier, "s_suppkey")}),
        Q.foreign_key_violations(o, "orders", {"o_custkey": (t.customer, "c_custkey")}),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sensor_tumbling_avg(t: Tables) -> DataFrame:
    """P6 over the whole events table as a batch (complete-mode result of the stream).

    The uv average is rounded in the result, as sums of doubles depend on their order.
    """
    out = S.five_second_averages(S.sensor_readings(t.events))
    return out.withColumn("average_uv", F.round("average_uv", 6))


def renamed_columns(t: Tables) -> DataFrame:
    """PRJ2: a rename map with a repeated input and a repeated output; the first mapping of each counts."""
    return P.rename_map(t.customer, [("c_custkey", "customer_id"), ("c_custkey", "again"), ("c_name", "title"),
                                     ("c_mktsegment", "title"), ("c_mktsegment", "segment")])


def trimmed_columns(t: Tables) -> DataFrame:
    """PRJ8: one rule for every column but the key."""
    df = t.part.select("p_partkey", "p_name", "p_brand", "p_type")
    return df.select("p_partkey", *P.each_column(df, ["p_partkey"], lambda c: F.upper(F.trim(c))))


def row_hashes(t: Tables) -> DataFrame:
    """FN22: the hash of the whole row."""
    return t.orders.select("o_orderkey", P.row_sha256("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority").alias("row_hash"))


def never_pending(t: Tables) -> DataFrame:
    """JN9: customers NOT IN those with a pending order, by the null rules of SQL."""
    pending = t.orders.where(F.col("o_orderstatus") == "P")
    return JN.not_in(t.customer, "c_custkey", pending, "o_custkey").select("c_custkey", "c_name")


def line_kinds(t: Tables) -> DataFrame:
    """AGG14: one row of each combination of item, flag and status."""
    return A.distinct_by_row_hash(t.lineitem.select("l_partkey", "l_returnflag", "l_linestatus"))


def json_objects(t: Tables) -> DataFrame:
    """FN16: JSON_QUERY gives the object, and NULL for the scalar in it."""
    return t.events.select("event_id", J.json_query("props", "$").alias("whole"), J.json_query("props", "$.k").alias("scalar"))


TYPED_TARGET = StructType([
    StructField("o_orderkey", LongType(), False), StructField("o_totalprice", DecimalType(18, 2), False),
    StructField("o_comment", StringType()), StructField("o_orderpriority", StringType(), False)])


def typed_target(t: Tables) -> DataFrame:
    """DML8: rows projected onto a target's typed columns; a missing nullable column is NULL."""
    return P.cast_to_schema(t.orders, TYPED_TARGET)


def days_with_orders(t: Tables) -> DataFrame:
    """JN10: of each day on which something was shipped, is there an order of that day; one scan of each table."""
    days = t.lineitem.select(F.col("l_shipdate").cast("date").alias("day")).distinct()
    ordered = t.orders.select(F.col("o_orderdate").cast("date").alias("_day")).distinct().withColumn("_found", F.lit(True))
    return days.join(ordered, F.col("day") == F.col("_day"), "left").select(
        F.col("day").cast("string").alias("day"), F.coalesce("_found", F.lit(False)).alias("found"))


def top_orders_in_order(t: Tables, n: int = 50) -> DataFrame:
    """SRT1-SRT3: the sorted result with the place of each row; a top-``n`` report."""
    top = t.orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(n)
    return top.select(F.row_number().over(Window.orderBy(F.desc("o_totalprice"), "o_orderkey")).alias("place"),
                      "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))


def ledger_ids(t: Tables, before: str = "1996-01-01") -> DataFrame:
    """DML9 over two loads: customers numbered by the orders before a day keep their ids, those who come later follow."""
    early = t.orders.where(F.col("o_orderdate") < D.ntz(before))
    held = K.new_ids(None, early, ["o_custkey"], "customer_no")
    return held.unionByName(K.new_ids(held, t.orders, ["o_custkey"], "customer_no"))


def late_readings(t: Tables, delay: str = "1 hour") -> DataFrame:
    """ST5 over daily batches: which events came after their window had closed, per day of arrival.

    Every eleventh event arrives two days after its time, the others on their day.
    """
    late_by = F.when(F.col("event_id") % 11 == 0, 2).otherwise(0)
    rows = t.events.select("event_id", "user_id", "ts", F.date_add(F.col("ts").cast("date"), late_by).alias("arrived"))
    return S.split_late(rows, "arrived", "ts", delay).where("late").select(
        "event_id", "user_id", "ts", F.col("arrived").cast("string").alias("arrived"))


def document_items(t: Tables, per_file: int = 40) -> DataFrame:
    """SRC1/SRC3 without inference: documents with the movies of ``per_file`` consecutive ids, read as variants, typed by name."""
    movies = MD.movie_documents(t).select("value", F.floor(F.get_json_object("value", "$.Id").cast("bigint") / per_file).alias("n"))
    docs = movies.groupBy("n").agg(F.array_join(F.collect_list("value"), ",").alias("items"))
    docs = docs.select(F.concat(F.lit('{"movie": ['), "items", F.lit("]}")).alias("text"), F.lit(None).cast("timestamp").alias("arrived"))
    item = F.parse_json("value")
    get = lambda path, kind: F.try_variant_get(item, path, kind)
    return IN.item_texts(IN.with_items(docs, "movie")).select(
        get("$.Id", "bigint").alias("movie_id"), get("$.Title", "string").alias("title"), get("$.RunTime", "int").alias("runtime"),
        get("$.ReleaseDate", "date").alias("release_date"), get("$.genres[1].name", "string").alias("second_genre"))
