"""The reports as SQL objects (UDF1, UDF2, Q18-Q21): functions, table functions and pivot views.

``install`` defines them in the session, over the tables' views, or, given a
schema, in the catalog, over its tables, so that people who write SQL call them
by name.  Bodies are single queries, which Spark expands in the caller's plan:
the scalar function becomes one aggregate and a left join, not a lookup a row,
and a table function's day range reaches the scan.  Each is equal to its
DataFrame form (``reports``, ``loads``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ledgerline.plans.reports import PIVOT_GROUPS, YEARS, group_column
from ledgerline.sources.tables import Tables

TABLES = ("orders", "lineitem", "part")
SESSION_PREFIX = "ledgerline_"


def _orders(prefix: str, first_day: str, last_day: str) -> str:
    return f"""RETURNS TABLE (order_id BIGINT, order_date DATE, order_total DECIMAL(19,4), customer_id BIGINT)
            RETURN SELECT o_orderkey, CAST(o_orderdate AS DATE), CAST(sum(line_total) AS DECIMAL(19,4)), o_custkey
                   FROM {prefix}orders JOIN {prefix}line_totals ON o_orderkey = l_orderkey
                   WHERE o_orderdate >= CAST({first_day} AS TIMESTAMP_NTZ)
                     AND o_orderdate < CAST({last_day} + 1 AS TIMESTAMP_NTZ)
                   GROUP BY o_orderkey, o_orderdate, o_custkey"""


def statements(prefix: str, temporary: bool, first: int, last: int) -> list[str]:
    """The definitions, each relying on those before it."""
    kind = "OR REPLACE TEMPORARY" if temporary else "OR REPLACE"
    years = ", ".join(f"{y} AS y{y}" for y in range(first, last + 1))
    groups = ", ".join(f"'{g}' AS {group_column(g)}" for g in PIVOT_GROUPS)
    return [
        f"""CREATE {kind} VIEW {prefix}line_totals AS
            SELECT l_orderkey, l_linenumber,
                   CAST(price + price * tax AS DECIMAL(19,4)) AS line_total
            FROM (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
                         CAST(l_tax AS DECIMAL(18,3)) AS tax
                  FROM {prefix}lineitem)""",
        # UDF1: the order's last line.
        f"""CREATE {kind} FUNCTION {prefix}order_total(order_key BIGINT) RETURNS DECIMAL(19,4)
            RETURN SELECT max(struct(l_linenumber, line_total)).line_total
                   FROM {prefix}line_totals WHERE l_orderkey = order_key""",
        # UDF2: one row per order (S12), days included at both ends.
        f"""CREATE {kind} FUNCTION {prefix}orders_between(first_day DATE, last_day DATE)
            {_orders(prefix, "first_day", "last_day")}""",
        f"""CREATE {kind} FUNCTION {prefix}orders_of_day(day DATE)
            {_orders(prefix, "day", "day")}""",
        # Lines are summed per item and year before they meet the items' groups.
        f"""CREATE {kind} VIEW {prefix}group_sales AS
            SELECT group_name, transaction_year, qty
            FROM (SELECT l_partkey, year(o_orderdate) AS transaction_year, sum(CAST(l_quantity AS BIGINT)) AS qty
                  FROM {prefix}orders JOIN {prefix}lineitem ON o_orderkey = l_orderkey
                  WHERE l_linestatus = 'F' AND o_orderdate >= TIMESTAMP_NTZ'{first}-01-01 00:00:00'
                    AND o_orderdate < TIMESTAMP_NTZ'{last + 1}-01-01 00:00:00'
                  GROUP BY l_partkey, year(o_orderdate)) s
            JOIN (SELECT p_partkey, explode(array(p_type, p_brand)) AS group_name FROM {prefix}part) g
              ON s.l_partkey = g.p_partkey""",
        f"""CREATE {kind} VIEW {prefix}sales_by_group AS
            SELECT * FROM {prefix}group_sales PIVOT (sum(qty) FOR transaction_year IN ({years}))""",
        f"""CREATE {kind} VIEW {prefix}sales_by_year AS
            SELECT * FROM {prefix}group_sales PIVOT (sum(qty) FOR group_name IN ({groups}))""",
    ]


def install(spark: SparkSession, tables: Tables | None = None, schema: str | None = None,
            first: int = YEARS[2013], last: int = YEARS[2017]) -> str:
    """Define the objects and return the prefix of their names.

    With ``schema`` they last as long as its tables ``orders``, ``lineitem`` and
    ``part``; otherwise they belong to the session and read ``tables``.  Spark
    takes no schema before a table function's name: ``USE`` the schema to call it.
    """
    if schema is not None:
        if not re.fullmatch(r"\w+(\.\w+)*", schema):
            raise ValueError(f"not a schema's name: {schema!r}")
        prefix = f"{schema}."
    else:
        prefix = SESSION_PREFIX
        for name in TABLES:
            tables.table(name).createOrReplaceTempView(prefix + name)
    for text in statements(prefix, schema is None, first, last):
        spark.sql(text)
    return prefix


def order_totals(t: Tables) -> DataFrame:
    """Q20 through the SQL function."""
    p = install(t.spark, t)
    return t.spark.sql(f"SELECT o.*, {p}order_total(o_orderkey) AS order_total FROM {p}orders o")


def orders_between(t: Tables, first: str = "1996-01-01", last: str = "1996-01-05") -> DataFrame:
    """Q21's rows through the table function."""
    p = install(t.spark, t)
    return t.spark.sql(f"SELECT * FROM {p}orders_between(:first, :last)", args={"first": first, "last": last})


def sales_by_group(t: Tables) -> DataFrame:
    """Q18 from its view."""
    return t.spark.table(f"{install(t.spark, t)}sales_by_group")


def sales_by_year(t: Tables) -> DataFrame:
    """Q19 from its view."""
    return t.spark.table(f"{install(t.spark, t)}sales_by_year")
