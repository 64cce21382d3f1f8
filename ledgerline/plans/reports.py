"""The analytical T-SQL queries (Q1-Q20) as DataFrame plans over the test tables.

Year constants of the reference (2013-2017) map to 1996-2000 in the test
data (``YEARS``); every other constant is a keyword parameter.  Each
function takes a :class:`Tables` and returns a lazy DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import dialect as D
from ledgerline.functions import json as J
from ledgerline.operators import aggregates as A
from ledgerline.operators import joins as JN
from ledgerline.plans import roles as R
from ledgerline.sources.tables import Tables

# Reference year -> test-data year.
YEARS = {2013: 1996, 2014: 1997, 2015: 1998, 2016: 1999, 2017: 2000}


def contact_or_join(t: Tables, excluded_name: str = "Customer#000000000") -> DataFrame:
    """Q1: every person with the phone of the company they work for, if any.

    People = customers; the first company table is ``nation`` (contacts
    ``n_nationkey`` / ``n_regionkey``), the second ``supplier`` (contacts
    ``s_suppkey`` / ``s_nationkey``).  Both joins are the disjunctive
    ``ON p = primary OR p = alternate`` left joins, rewritten as equi-joins.
    """
    people = t.customer.select(
        F.col("c_custkey").alias("person_id"),
        F.col("c_name").alias("full_name"),
        F.col("c_mktsegment").alias("personal_segment"),
    ).where(F.col("full_name") != excluded_name)
    first = t.nation.select(
        F.col("n_nationkey").alias("a_primary"), F.col("n_regionkey").alias("a_alternate"),
        F.col("n_name").alias("a_name"), F.col("n_nationkey").cast("bigint").alias("a_key"))
    second = t.supplier.select(
        F.col("s_suppkey").alias("b_primary"), F.col("s_nationkey").alias("b_alternate"),
        F.col("s_name").alias("b_name"), F.col("s_suppkey").alias("b_key"))
    j = JN.or_join(people, first, "person_id", ["a_primary", "a_alternate"])
    j = JN.or_join(j, second, "person_id", ["b_primary", "b_alternate"])
    return j.select(
        "full_name", "personal_segment",
        F.coalesce("a_name", "b_name").alias("company_name"),
        F.coalesce("a_key", "b_key").alias("company_key"),
    )


def composite_key_join(t: Tables) -> DataFrame:
    """Q2: a join on two columns at once (person id and phone in the reference)."""
    s, c = t.supplier, t.customer
    return s.join(c, (s.s_suppkey == c.c_custkey) & (s.s_nationkey == c.c_nationkey)) \
        .select(c.c_name.alias("customer_name"))


def lapsed_customers(t: Tables, cutoff: str = "1999-01-01", on_cutoff: str | None = None) -> DataFrame:
    """Q3: customers with a sale before ``cutoff`` and none after it (NOT IN subquery).

    Orders are first reduced to two flags per customer.  Faithful to the
    reference (S1): sales *on* the cutoff day count in neither set, and one
    later sale without a customer leaves no row at all.  Corrected: ``on_cutoff``
    ``"before"`` or ``"after"`` counts that day in one of the sets, and sales
    without a customer are ignored.
    """
    day = F.col("o_orderdate")
    before = day <= D.ntz(cutoff) if on_cutoff == "before" else day < D.ntz(cutoff)
    after = day >= D.ntz(cutoff) if on_cutoff == "after" else day > D.ntz(cutoff)
    flags = t.orders.groupBy("o_custkey").agg(F.max(before).alias("_before"), F.max(after).alias("_after"))
    kept = flags.where(F.col("_before") & ~F.coalesce(F.col("_after"), F.lit(False)))
    if on_cutoff is None:
        nobody = flags.where(F.col("o_custkey").isNull() & F.col("_after")).select(F.count(F.lit(1))).scalar()
        kept = kept.where(nobody == 0)
    return t.customer.join(kept, F.col("c_custkey") == F.col("o_custkey")) \
        .select(F.col("c_name").alias("customer_name")).distinct()


def item_quantity_in_year(t: Tables, year: int = YEARS[2013]) -> DataFrame:
    """Q4 (flagship): purchased quantity per item name for lines received in ``year``.

    Lines are summed per item id before meeting ``part`` (eager aggregation):
    the join then sees one row per item instead of one per line, and the
    final grouping by name adds the per-item sums.
    """
    lines = R.lines(t, R.PURCHASED).where(D.in_year("l_shipdate", year))
    per_item = lines.groupBy("l_partkey").agg(F.sum(R.quantity()).alias("_q"))
    j = per_item.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return (j.groupBy(F.col("p_name").alias("stock_item_name"))
            .agg(F.sum("_q").alias("total_quantity"))
            .orderBy(F.col("total_quantity").desc()))


def long_name_union(t: Tables, min_len: int = 10) -> DataFrame:
    """Q5: items with a line description of at least ``min_len`` characters, three sources.

    Descriptions: purchase lines use the order priority, sold lines the
    brand padded with blanks (``LEN`` ignores trailing blanks), all lines
    the item name.  ``UNION`` removes duplicates across the three.  Each
    source is reduced to its distinct item ids before the item table is
    joined, so the joins see one row per item, not per line.
    """
    o, p = t.orders, t.part
    purchased_items = (R.lines(t, R.PURCHASED)
                       .join(o.where(D.tsql_len("o_orderpriority") > min_len - 1), F.col("l_orderkey") == F.col("o_orderkey"))
                       .select("l_partkey").distinct())
    purchased = purchased_items.join(p, F.col("l_partkey") == F.col("p_partkey")).select("p_name")
    sold_items = R.lines(t, R.SOLD).select("l_partkey").distinct()
    sold = (sold_items.join(p.where(D.tsql_len(F.concat(F.col("p_brand"), F.lit("   "))) > min_len - 1),
                            F.col("l_partkey") == F.col("p_partkey")).select("p_name"))
    ordered_items = t.lineitem.select("l_partkey").distinct()
    ordered = (ordered_items.join(p.where(D.tsql_len("p_name") > min_len - 1), F.col("l_partkey") == F.col("p_partkey"))
               .select("p_name"))
    return A.union_distinct(purchased, sold, ordered).select(F.col("p_name").alias("stock_item_name"))


def items_sold_outside(t: Tables, year: int = YEARS[2014],
                       excluded=("AFRICA", "ASIA"), never_inside: bool = False) -> DataFrame:
    """Q6: items with some sale in ``year`` to a state outside ``excluded``.

    Faithful (S3): existential, and the WHERE on the outer-joined state
    makes the left joins inner.  Corrected (``never_inside``): items sold in
    ``year`` and never to a state in ``excluded``.
    """
    cte = (t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
           .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
           .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
           .select("o_orderkey", "o_orderdate", "r_name"))
    outside = ~F.col("r_name").isin(*excluded)
    sold = cte.where(D.in_year("o_orderdate", year) & (F.lit(True) if never_inside else outside)) \
        .join(R.lines(t, R.SOLD), F.col("o_orderkey") == F.col("l_orderkey"))
    if never_inside:
        items = sold.groupBy("l_partkey").agg(F.bool_and(F.coalesce(outside, F.lit(True))).alias("_never")).where("_never").select("l_partkey")
    else:
        items = sold.select("l_partkey").distinct()
    j = items.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return j.select(F.col("p_name").alias("stock_item_name")).distinct()


def _processing_sums(t: Tables, by_month: bool) -> DataFrame:
    """Q7/Q8 inner part, pre-aggregated per city (and month) before the outer join.

    ``orders JOIN invoices JOIN customers`` is large; the reference then RIGHT
    JOINs the (small) cities table, which forces the large side to be shuffled
    for a sort-merge join.  AVG is decomposed into SUM and COUNT, summed per
    city first (partial aggregation, no wide shuffle), and only the per-city
    sums meet the cities table.  Result identical to averaging after the join.
    """
    d = D.datediff_days("o_orderdate", "l_shipdate").cast("long")
    inner = (t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
             .join(t.customer, F.col("o_custkey") == F.col("c_custkey")))
    keys = [F.col("c_nationkey").alias("city_id")] + ([F.month("o_orderdate").alias("month_ordered")] if by_month else [])
    per_city = inner.groupBy(*keys).agg(F.sum(d).alias("_s"), F.count(d).alias("_n"))
    return (per_city.join(t.nation, F.col("city_id") == F.col("n_nationkey"), "right")
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey")))


def avg_processing_days(t: Tables) -> DataFrame:
    """Q7: integer-average days from order to delivery per state (AGG3, S4, S5).

    States whose cities have no orders keep a NULL average (S5).
    """
    j = _processing_sums(t, by_month=False)
    return (j.groupBy(F.col("r_name").alias("state_name"))
            .agg(D.div_trunc(F.sum("_s"), F.coalesce(F.sum("_n"), F.lit(0))).alias("avg_processing"))
            .orderBy(F.col("avg_processing").desc()))


def avg_processing_days_by_month(t: Tables) -> DataFrame:
    """Q8: as Q7 per order month; the NULL month of unmatched cities is removed."""
    j = _processing_sums(t, by_month=True)
    return (j.groupBy(F.col("month_ordered"), F.col("r_name").alias("state_name"))
            .agg(D.div_trunc(F.sum("_s"), F.coalesce(F.sum("_n"), F.lit(0))).alias("avg_processing"))
            .where(F.col("month_ordered").isNotNull())
            .orderBy(F.col("month_ordered").asc(), F.col("avg_processing").desc()))


def _purchased_sold(t: Tables, year: int | None):
    """(purchased, sold) lines of the year's orders: item and quantity.

    The orders' keys grow with the lines and compress to about a byte each, so
    that millions of them pass for a small table by their files' size: merge
    joins, here and with the items, keep them out of the driver.
    """
    o = t.orders
    if year is not None:
        o = o.where(D.in_year("o_orderdate", year))
    o = o.select("o_orderkey").hint("merge")

    def side(status):
        return (R.lines(t, status).join(o, F.col("l_orderkey") == F.col("o_orderkey"))
                .select(F.col("l_partkey").alias("item"), R.quantity().alias("qty")))
    return side(R.PURCHASED), side(R.SOLD)


def _plain_pair_sums(a: DataFrame, b: DataFrame) -> DataFrame:
    """Per item the sum of either side by itself; 0 where a side has no rows."""
    both = a.select("item", F.col("qty").alias("a"), F.lit(0).alias("b")).unionByName(
        b.select("item", F.lit(0).alias("a"), F.col("qty").alias("b")))
    sums = both.groupBy("item").agg(F.sum("a").alias("a_total"), F.sum("b").alias("b_total"))
    return sums.withColumn("diff_total", F.col("a_total") - F.col("b_total"))


def purchased_more_than_sold(t: Tables, year: int = YEARS[2015], fan_out: bool = True) -> DataFrame:
    """Q9: item names whose purchased quantity exceeds the sold quantity in ``year``.

    Faithful to the reference's fan-out join (S6): the compared sums are
    the ones over ``purchases JOIN sales USING (item)``, computed from
    per-item aggregates instead of the m*n joined rows.  Corrected
    (``fan_out=False``): either side is summed by itself, items bought and
    never sold included.
    """
    purchased, sold = _purchased_sold(t, year)
    pairs = A.fanout_pair_sums(purchased, sold, "item", "qty", "qty") if fan_out else _plain_pair_sums(purchased, sold)
    j = pairs.join(t.part.hint("merge"), F.col("item") == F.col("p_partkey"))
    return (j.groupBy(F.col("p_name").alias("stock_item_name"))
            .agg(F.sum("a_total").alias("_p"), F.sum("b_total").alias("_s"))
            .where(F.col("_p") > F.col("_s")).select("stock_item_name"))


def small_buyers_of_item(t: Tables, year: int = YEARS[2016], pattern: str = "%widget%",
                         max_quantity: int = 10, with_none: bool = False) -> DataFrame:
    """Q10: customers who bought at most ``max_quantity`` matching items in ``year``.

    Faithful (S7): customers who bought none are not listed; corrected
    (``with_none``): they are.  ``LIKE`` under
    the reference's default collation is case-insensitive (``ilike``).
    """
    sales = (t.orders.where(D.in_year("o_orderdate", year))
             .join(R.lines(t, R.SOLD), F.col("o_orderkey") == F.col("l_orderkey"))
             .join(t.part.where(F.col("p_name").ilike(pattern)), F.col("l_partkey") == F.col("p_partkey")))
    relevant = (sales.groupBy(F.col("o_custkey").alias("buyer"))
                .agg(F.sum(R.quantity()).alias("_q")))
    bought = relevant.join(t.customer, F.col("buyer") == F.col("c_custkey"), "right" if with_none else "inner")
    j = (bought.where(F.coalesce("_q", F.lit(0)) < max_quantity + 1)
         .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")))
    return j.select(F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("phone_number"),
                    F.col("n_name").alias("primary_contact"))


def changed_after(t: Tables, since: str = "1998-01-01") -> DataFrame:
    """Q11: rows changed after a date, joined to their parent (JN1 + FLT1)."""
    o = t.orders.where(F.col("o_orderdate") > D.ntz(since))
    return o.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("order_id"), F.col("c_name").alias("customer_name"),
        F.col("o_orderdate").alias("changed_at"))


def order_detail_for_day(t: Tables, day: str = "1997-07-01") -> DataFrame:
    """Q12: order detail with a concatenated delivery address for one day (FN11).

    ``+`` on strings is NULL-propagating, so ``concat`` (not ``concat_ws``).
    The LEFT JOIN to customers followed by INNER JOINs is kept as written.
    """
    d0 = D.ntz(f"{day} 00:00:00")
    cte = (t.orders.where(F.col("o_orderdate") == d0)
           .join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
           .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
           .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select(
               D.plus_concat(F.col("c_mktsegment"), F.lit(", "), F.col("n_name"), F.lit(", "),
                             F.col("r_name"), F.lit(" "), F.col("c_custkey").cast("string")).alias("delivery_address"),
               F.col("n_name").alias("delivery_city"), F.col("r_name").alias("delivery_state"),
               F.col("c_name").alias("customer_name"), F.col("c_mktsegment").alias("phone_number"),
               "o_orderkey"))
    j = (cte.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey"))
         .join(t.part, F.col("l_partkey") == F.col("p_partkey")))
    return j.select(F.col("p_name").alias("stock_item_name"), "delivery_address", "delivery_city",
                    "delivery_state", "customer_name", "phone_number", R.quantity().alias("quantity"))


def purchased_sold_by_group(t: Tables, fan_out: bool = True) -> DataFrame:
    """Q13: purchased / sold / remaining per stock group over the fan-out join (S6; ``fan_out=False``: plain sums)."""
    purchased, sold = _purchased_sold(t, None)
    pairs = A.fanout_pair_sums(purchased, sold, "item", "qty", "qty") if fan_out else _plain_pair_sums(purchased, sold)
    pairs = pairs.join(t.part.select("p_partkey").hint("merge"), F.col("item") == F.col("p_partkey"))
    j = pairs.join(R.stock_groups(t).hint("merge"), F.col("item") == F.col("g_partkey"))
    return j.groupBy(F.col("group_name")).agg(
        F.sum("a_total").cast("bigint").alias("total_purchased"),
        F.sum("b_total").cast("bigint").alias("total_sold"),
        F.sum("diff_total").cast("bigint").alias("remaining"),
    )


def top_item_per_region(t: Tables, year: int = YEARS[2016], country: str = "AMERICA", corrected: bool = False) -> DataFrame:
    """Q14: per city, the item(s) delivered most often in ``year`` (ties kept, S8/S9).

    Customer deliveries and supplier deliveries are counted separately and
    combined with ``UNION`` (distinct), as in the reference.  ``corrected``:
    the two counts of an item are added, and cities without deliveries are
    listed with "No Sales".
    """
    tx = t.lineitem.where(D.in_year("l_shipdate", year))
    city = D.plus_concat(F.col("n_name"), F.lit(", "), F.col("r_name"))

    def counted(with_party: DataFrame) -> DataFrame:
        j = (with_party.join(t.nation, F.col("party_nation") == F.col("n_nationkey"), "right")
             .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
             .where(F.col("l_shipdate").isNotNull() & D.in_year("l_shipdate", year) & (F.col("r_name") == country)))
        return j.groupBy(city.alias("city"), F.col("l_partkey").alias("item")) \
            .agg(F.count("l_partkey").alias("item_count"))

    by_customer = (tx.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
                   .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
                   .select("l_partkey", "l_shipdate", F.col("c_nationkey").alias("party_nation")))
    by_supplier = (tx.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
                   .select("l_partkey", "l_shipdate", F.col("s_nationkey").alias("party_nation")))
    if corrected:
        counts = counted(by_customer).unionByName(counted(by_supplier)).groupBy("city", "item").agg(F.sum("item_count").alias("item_count"))
        cities = t.nation.join(t.region.where(F.col("r_name") == country), F.col("n_regionkey") == F.col("r_regionkey")).select(city.alias("city"))
        ranked = cities.join(A.top_per_group(counts, ["city"], "item_count"), "city", "left")
    else:
        ranked = A.top_per_group(A.union_distinct(counted(by_customer), counted(by_supplier)), ["city"], "item_count")
    j = ranked.join(t.part, F.col("item") == F.col("p_partkey"), "left")
    return j.select("city", F.coalesce(F.col("p_name"), F.lit("No Sales")).alias("most_delivered"))


def delivery_fragments(t: Tables) -> DataFrame:
    """Delivery-events JSON per order line: ``{"Events":[{"Event":..,"EventTime":..}, ..]}``.

    A line has an attempt for every started 20 units beyond the first 10 (at most
    two) and, if it is not a return (``l_returnflag = 'R'``), a delivery: 0 to 3
    events.  An order's delivery document is the concatenation of its lines'
    event arrays.
    """
    day = F.date_format("l_shipdate", "yyyy-MM-dd").alias("EventTime")
    attempt = F.struct(F.lit("DeliveryAttempt").alias("Event"), day)
    done = F.struct(F.lit("Delivered").alias("Event"), day)
    events = F.array(F.when(F.col("l_quantity") > 10, attempt), F.when(F.col("l_quantity") > 30, attempt),
                     F.when(F.col("l_returnflag") != "R", done))
    return t.lineitem.select(F.col("l_orderkey").alias("invoice_order"),
                             F.to_json(F.struct(F.filter(events, lambda e: e.isNotNull()).alias("Events"))).alias("fragment"))


def repeated_event_in_json(t: Tables, event: str = "DeliveryAttempt") -> DataFrame:
    """Q15: orders whose delivery document holds more than one ``event`` (JS5).

    The events of a document are counted by parsing its JSON array; since
    the document is the concatenation of per-line fragments, the count is
    the sum of the fragments' counts.  That sum is a partial aggregate, so
    an order with a huge number of lines is never gathered into one array.
    """
    counts = (delivery_fragments(t)
              .groupBy("invoice_order").agg(F.sum(J.count_events("fragment", event)).alias("n_events"))
              .where(F.col("n_events") > 1))
    o = t.orders
    return counts.join(o, F.col("invoice_order") == F.col("o_orderkey")).select(*[o[c] for c in o.columns])


def json_value_filter(t: Tables, value: str = "42") -> DataFrame:
    """Q16: distinct keys whose JSON field equals a value (JSON_VALUE, JS4)."""
    e = t.events
    return e.where(J.json_value("props", "$.k") == value).select("user_id").distinct()


def json_value_group(t: Tables, year: int = 2024) -> DataFrame:
    """Q17: totals grouped by a JSON field (JSON_VALUE as group key)."""
    e = t.events.where(D.in_year("ts", year))
    return (e.groupBy(J.json_value("props", '$."k"').alias("k"))
            .agg(F.sum(F.col("value").cast("decimal(18,2)")).cast("decimal(38,2)").alias("total_value"))
            .orderBy(F.col("total_value").desc()))


def _group_year_sales(t: Tables, first: int, last: int) -> DataFrame:
    """Sold quantity per (stock group, year).

    Lines are summed per (item, year) first; only those sums meet the item
    table and the many-to-many group bridge.
    """
    o = t.orders.where(D.in_years("o_orderdate", first, last))
    per_item = (o.join(R.lines(t, R.SOLD), F.col("o_orderkey") == F.col("l_orderkey"))
                .groupBy("l_partkey", F.year("o_orderdate").alias("transaction_year"))
                .agg(F.sum(R.quantity()).alias("qty")))
    j = (per_item.join(t.part.select("p_partkey").hint("merge"), F.col("l_partkey") == F.col("p_partkey"))
         .join(R.stock_groups(t).hint("merge"), F.col("p_partkey") == F.col("g_partkey")))
    return j.select("group_name", "transaction_year", "qty")


def pivot_group_by_year(t: Tables, first: int = YEARS[2013], last: int = YEARS[2017]) -> DataFrame:
    """Q18: stock group x year pivot of sold quantity (AGG16, AGG18)."""
    years = list(range(first, last + 1))
    src = _group_year_sales(t, first, last)
    return A.pivot_sum(src, ["group_name"], "transaction_year", years, F.col("qty"),
                       names=[f"y{y}" for y in years])


# The nine pivot groups (reference S10 lists nine names).
PIVOT_GROUPS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "Brand#1", "Brand#2", "Brand#3"]


def group_column(name: str) -> str:
    return name.lower().replace("#", "_")


def pivot_year_by_group(t: Tables, groups=tuple(PIVOT_GROUPS), first: int = YEARS[2013],
                        last: int = YEARS[2017]) -> DataFrame:
    """Q19: year x stock group pivot; groups outside the list are dropped (AGG17)."""
    src = _group_year_sales(t, first, last)
    return A.pivot_sum(src, ["transaction_year"], "group_name", list(groups), F.col("qty"),
                       names=[group_column(g) for g in groups])


def line_total(tax_is_percent: bool = False) -> F.Column:
    """``UnitPrice + UnitPrice * TaxRate`` in the reference's decimal types (no quantity, S11).

    The reference's sample tax rate ``"6"`` looks like a percentage but is
    used as a fraction; ``tax_is_percent=True`` divides it by 100.
    """
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    tax = F.col("l_tax").cast("decimal(18,3)")
    if tax_is_percent:
        tax = (tax / 100).cast("decimal(18,5)")
    return D.money(price + price * tax)


def invoice_with_total(t: Tables, mode: str = "last_line", tax_is_percent: bool = False) -> DataFrame:
    """Q20: every invoice with its order total from the scalar function (UDF1, JN12).

    ``mode="last_line"`` (faithful, S11): the function assigns from "some"
    line of the order, made deterministic as the line with the highest line
    number (ties: highest total).  ``mode="sum_lines"`` sums all lines.
    """
    lines = t.lineitem.select("l_orderkey", "l_linenumber", line_total(tax_is_percent).alias("line_total"))
    if mode == "last_line":
        pick = F.max(F.struct(F.col("l_linenumber"), F.col("line_total")))["line_total"]
    elif mode == "sum_lines":
        pick = D.money(F.sum("line_total"))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    o = t.orders
    return JN.lateral_total(o, "o_orderkey", lines, "l_orderkey", pick, "order_total")
