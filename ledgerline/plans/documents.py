"""Result sets rendered as JSON / XML text (Q25-Q27; JS7, JS8, JS9, UDF3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.keys import with_key_index
from ledgerline.plans import reports
from ledgerline.sources.tables import Tables

# XML element names without blanks, as aliased in the reference (Q26).
XML_NAMES = {"economy": "Economy", "large": "Large", "medium": "Medium", "promo": "Promo",
             "small": "Small", "standard": "Standard", "brand_1": "Brand1", "brand_2": "Brand2",
             "brand_3": "Brand3"}


def pivot_to_json(t: Tables) -> DataFrame:
    """Q25: the year x group pivot as one ``FOR JSON PATH`` array text.

    Rendered only after the pivot, whose size is bounded by the year list;
    ``sort_array`` on the row structs orders the array by year.  NULL
    cells are omitted from the objects, as ``FOR JSON PATH`` does.
    """
    pv = reports.pivot_year_by_group(t)
    rows = F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in pv.columns])))
    return pv.agg(F.to_json(rows).alias("json_text"))


def pivot_to_xml(t: Tables) -> DataFrame:
    """Q26: ``FOR XML PATH``: one ``<row>`` element per pivot row, concatenated.

    ``to_xml`` escapes text and omits NULL cells; blanks are not allowed in
    element names, hence the aliases.
    """
    pv = reports.pivot_year_by_group(t)
    named = pv.select(F.col("transaction_year").alias("TransactionYear"),
                      *[F.col(c).alias(XML_NAMES[c]) for c in pv.columns if c != "transaction_year"])
    xml = F.regexp_replace(F.to_xml(F.struct(*[F.col(c) for c in named.columns]),
                                    {"rowTag": "row", "indent": ""}), "\n$", "")
    rows = F.sort_array(F.collect_list(F.struct(F.col("TransactionYear"), xml.alias("x"))))
    return named.agg(F.array_join(F.transform(rows, lambda r: r["x"]), "").alias("xml_text"))


def nested_invoice_json(t: Tables, customer: int = 1) -> DataFrame:
    """Q27: per invoice, the invoice with its lines as nested JSON (JS9), for every
    date on which ``customer`` was invoiced (UDF3).

    Corrected per S16: the reference's inner query is uncorrelated and
    stores *all* invoices in every row; here each row holds its own
    invoice.  The per-date cursor becomes one set-based semi join on the
    distinct dates, and the identity column is assigned by
    :func:`with_key_index` in (date, invoice) order.
    """
    o = t.orders
    dates = o.where(F.col("o_custkey") == customer).select(F.col("o_orderdate").alias("d")).distinct()
    inv = o.join(dates, F.col("o_orderdate") == F.col("d"), "left_semi")
    line = F.struct(
        F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
        F.col("l_quantity").cast("decimal(18,2)").alias("l_quantity"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("l_extendedprice"),
        F.col("l_discount").cast("decimal(18,2)").alias("l_discount"),
        F.col("l_tax").cast("decimal(18,2)").alias("l_tax"),
        F.col("l_returnflag"), F.col("l_linestatus"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"))
    lines = (t.lineitem.join(inv.select(F.col("o_orderkey").alias("k")), F.col("l_orderkey") == F.col("k"), "left_semi")
             .groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("IL")))
    doc = F.to_json(F.struct(
        F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"),
        F.col("o_orderpriority"), F.col("IL")))
    j = inv.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    out = j.select(F.col("o_orderdate").cast("date").alias("confirmed_delivery_date"),
                   F.col("o_orderkey"), doc.alias("confirmed_delivery_info"))
    out = with_key_index(out, ["confirmed_delivery_date", "o_orderkey"], "confirmed_delivery_id")
    return out.select("confirmed_delivery_id", "confirmed_delivery_date", "confirmed_delivery_info")
