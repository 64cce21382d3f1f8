"""Independent SQL formulations of every registered query (DuckDB dialect).

They are written the way the reference writes them (fan-out joins, NOT IN,
DENSE_RANK, OR joins, conditional-sum pivots) so that they check the
rewritten Spark plans rather than repeat them.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["contact_or_join"] = """
SELECT c.c_name AS full_name, c.c_mktsegment AS personal_segment,
       COALESCE(n.n_name, s.s_name) AS company_name,
       COALESCE(CAST(n.n_nationkey AS BIGINT), s.s_suppkey) AS company_key
FROM customer c
LEFT JOIN nation n ON c.c_custkey = n.n_nationkey OR c.c_custkey = n.n_regionkey
LEFT JOIN supplier s ON c.c_custkey = s.s_suppkey OR c.c_custkey = s.s_nationkey
WHERE c.c_name != 'Customer#000000000'
"""

ORACLE["composite_key_join"] = """
SELECT c.c_name AS customer_name
FROM supplier s JOIN customer c ON s.s_suppkey = c.c_custkey AND s.s_nationkey = c.c_nationkey
"""

ORACLE["lapsed_customers"] = """
SELECT DISTINCT c.c_name AS customer_name
FROM customer c JOIN orders t ON c.c_custkey = t.o_custkey
WHERE t.o_orderdate < TIMESTAMP '1999-01-01'
  AND t.o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate > TIMESTAMP '1999-01-01')
"""

ORACLE["item_quantity_in_year"] = """
SELECT p.p_name AS stock_item_name, CAST(SUM(CAST(l.l_quantity AS BIGINT)) AS BIGINT) AS total_quantity
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_linestatus = 'O' AND year(l.l_shipdate) = 1996
GROUP BY p.p_name
ORDER BY total_quantity DESC
"""

ORACLE["long_name_union"] = """
SELECT p.p_name AS stock_item_name
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_linestatus = 'O' AND length(rtrim(o.o_orderpriority)) > 9
UNION
SELECT p.p_name FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_linestatus = 'F' AND length(rtrim(p.p_brand || '   ')) > 9
UNION
SELECT p.p_name FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE length(rtrim(p.p_name)) > 9
"""

ORACLE["items_sold_outside"] = """
WITH cte AS (
  SELECT o.o_orderkey, o.o_orderdate, r.r_name
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)
SELECT DISTINCT p.p_name AS stock_item_name
FROM cte JOIN lineitem l ON cte.o_orderkey = l.l_orderkey JOIN part p ON l.l_partkey = p.p_partkey
WHERE l.l_linestatus = 'F' AND year(cte.o_orderdate) = 1997 AND cte.r_name NOT IN ('AFRICA', 'ASIA')
"""

_PROCESSING = """
  SELECT r.r_name, o.o_orderdate,
         date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE)) AS d
  FROM orders o
  JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  RIGHT JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
"""

ORACLE["avg_processing_days"] = f"""
SELECT r_name AS state_name,
       CAST(CASE WHEN count(d) = 0 THEN NULL ELSE sum(d) // count(d) END AS BIGINT) AS avg_processing
FROM ({_PROCESSING}) x
GROUP BY r_name
ORDER BY avg_processing DESC
"""

ORACLE["avg_processing_days_by_month"] = f"""
SELECT CAST(month(o_orderdate) AS INTEGER) AS month_ordered, r_name AS state_name,
       CAST(CASE WHEN count(d) = 0 THEN NULL ELSE sum(d) // count(d) END AS BIGINT) AS avg_processing
FROM ({_PROCESSING}) x
GROUP BY month(o_orderdate), r_name
HAVING month(o_orderdate) IS NOT NULL
ORDER BY month_ordered ASC, avg_processing DESC
"""

_PS = """
WITH p AS (
  SELECT CAST(l.l_quantity AS BIGINT) AS q, l.l_partkey AS k
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part pp ON l.l_partkey = pp.p_partkey
  WHERE l.l_linestatus = 'O' {year}),
s AS (
  SELECT CAST(l.l_quantity AS BIGINT) AS q, l.l_partkey AS k
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part pp ON l.l_partkey = pp.p_partkey
  WHERE l.l_linestatus = 'F' {year}),
cte AS (SELECT p.q AS oo, s.q AS qq, p.k FROM p JOIN s ON p.k = s.k)
"""

ORACLE["purchased_more_than_sold"] = _PS.format(year="AND year(o.o_orderdate) = 1998") + """
SELECT pt.p_name AS stock_item_name
FROM cte JOIN part pt ON cte.k = pt.p_partkey
GROUP BY pt.p_name
HAVING SUM(cte.oo) > SUM(cte.qq)
"""

ORACLE["small_buyers_of_item"] = """
WITH cte AS (
  SELECT o.o_custkey
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_linestatus = 'F' AND year(o.o_orderdate) = 1999 AND p.p_name ILIKE '%widget%'
  GROUP BY o.o_custkey
  HAVING SUM(CAST(l.l_quantity AS BIGINT)) < 11)
SELECT c.c_name AS customer_name, c.c_mktsegment AS phone_number, n.n_name AS primary_contact
FROM cte JOIN customer c ON cte.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
"""

ORACLE["changed_after"] = """
SELECT o.o_orderkey AS order_id, c.c_name AS customer_name, o.o_orderdate AS changed_at
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE o.o_orderdate > TIMESTAMP '1998-01-01'
"""

ORACLE["order_detail_for_day"] = """
WITH cte AS (
  SELECT c.c_mktsegment || ', ' || n.n_name || ', ' || r.r_name || ' ' || CAST(c.c_custkey AS VARCHAR) AS delivery_address,
         n.n_name AS delivery_city, r.r_name AS delivery_state, c.c_name AS customer_name,
         c.c_mktsegment AS phone_number, o.o_orderkey
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE o.o_orderdate = TIMESTAMP '1997-07-01')
SELECT p.p_name AS stock_item_name, cte.delivery_address, cte.delivery_city, cte.delivery_state,
       cte.customer_name, cte.phone_number, CAST(l.l_quantity AS BIGINT) AS quantity
FROM cte JOIN lineitem l ON cte.o_orderkey = l.l_orderkey JOIN part p ON l.l_partkey = p.p_partkey
"""

ORACLE["purchased_sold_by_group"] = _PS.format(year="") + """
, g AS (SELECT p_partkey, unnest([p_type, p_brand]) AS group_name FROM part)
SELECT g.group_name,
       CAST(SUM(CAST(cte.oo AS BIGINT)) AS BIGINT) AS total_purchased,
       CAST(SUM(CAST(cte.qq AS BIGINT)) AS BIGINT) AS total_sold,
       CAST(SUM(CAST(cte.oo - cte.qq AS BIGINT)) AS BIGINT) AS remaining
FROM cte JOIN g ON cte.k = g.p_partkey
GROUP BY g.group_name
"""

ORACLE["top_item_per_region"] = """
WITH cte AS (
  SELECT n.n_name || ', ' || r.r_name AS city, l.l_partkey AS item, COUNT(l.l_partkey) AS item_count
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  RIGHT JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE year(l.l_shipdate) = 1999 AND r.r_name = 'AMERICA'
  GROUP BY n.n_name || ', ' || r.r_name, l.l_partkey
  UNION
  SELECT n.n_name || ', ' || r.r_name AS city, l.l_partkey AS item, COUNT(l.l_partkey) AS item_count
  FROM lineitem l
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  RIGHT JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE year(l.l_shipdate) = 1999 AND r.r_name = 'AMERICA'
  GROUP BY n.n_name || ', ' || r.r_name, l.l_partkey)
SELECT ranked.city, COALESCE(p.p_name, 'No Sales') AS most_delivered
FROM (SELECT *, DENSE_RANK() OVER (PARTITION BY city ORDER BY item_count DESC) AS ranking FROM cte) ranked
LEFT JOIN part p ON ranked.item = p.p_partkey
WHERE ranked.ranking = 1
"""

ORACLE["repeated_event_in_json"] = """
SELECT o.*
FROM orders o
JOIN (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey
      HAVING sum(CASE WHEN l_quantity > 30 THEN 2 WHEN l_quantity > 10 THEN 1 ELSE 0 END) > 1) i
  ON i.l_orderkey = o.o_orderkey
"""

ORACLE["json_value_filter"] = """
SELECT DISTINCT user_id FROM events WHERE json_extract_string(props, '$.k') = '42'
"""

ORACLE["json_value_group"] = """
SELECT json_extract_string(props, '$.k') AS k,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_value
FROM events
WHERE year(ts) = 2024
GROUP BY json_extract_string(props, '$.k')
ORDER BY total_value DESC
"""

_GROUP_YEAR = """
WITH src AS (
  SELECT g.group_name, CAST(year(o.o_orderdate) AS INTEGER) AS transaction_year, CAST(l.l_quantity AS BIGINT) AS qty
  FROM orders o
  JOIN lineitem l ON o.o_orderkey = l.l_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN (SELECT p_partkey AS g_partkey, unnest([p_type, p_brand]) AS group_name FROM part) g
    ON p.p_partkey = g.g_partkey
  WHERE l.l_linestatus = 'F' AND year(o.o_orderdate) BETWEEN 1996 AND 2000),
agg AS (SELECT group_name, transaction_year, SUM(qty) AS total FROM src GROUP BY ALL)
"""

ORACLE["pivot_group_by_year"] = _GROUP_YEAR + "SELECT group_name, " + ", ".join(
    f"CAST(SUM(CASE WHEN transaction_year = {y} THEN total END) AS BIGINT) AS y{y}" for y in range(1996, 2001)
) + " FROM agg GROUP BY group_name"

_PIVOT_GROUPS = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD", "Brand#1", "Brand#2", "Brand#3"]


def _gcol(name: str) -> str:
    return name.lower().replace("#", "_")


_YEAR_BY_GROUP = _GROUP_YEAR + "SELECT transaction_year, " + ", ".join(
    f"CAST(SUM(CASE WHEN group_name = '{g}' THEN total END) AS BIGINT) AS {_gcol(g)}" for g in _PIVOT_GROUPS
) + " FROM agg WHERE group_name IN (" + ", ".join(f"'{g}'" for g in _PIVOT_GROUPS) + ") GROUP BY transaction_year"

ORACLE["pivot_year_by_group"] = _YEAR_BY_GROUP

_LINE_TOTAL = ("CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + CAST(l_extendedprice AS DECIMAL(18,2)) "
               "* CAST(l_tax AS DECIMAL(18,3)) AS DECIMAL(19,4))")

ORACLE["invoice_with_total"] = f"""
SELECT o.*, x.order_total
FROM orders o
LEFT JOIN (
  SELECT l_orderkey, order_total FROM (
    SELECT l_orderkey, {_LINE_TOTAL} AS order_total,
           row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, {_LINE_TOTAL} DESC) AS rn
    FROM lineitem) WHERE rn = 1) x
  ON o.o_orderkey = x.l_orderkey
"""

_ODS = f"""
SELECT o.o_orderkey AS order_id, CAST(o.o_orderdate AS DATE) AS order_date,
       CAST(SUM({_LINE_TOTAL}) AS DECIMAL(19,4)) AS order_total, o.o_custkey AS customer_id
FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey
WHERE CAST(o.o_orderdate AS DATE) BETWEEN DATE '{{first}}' AND DATE '{{last}}'
GROUP BY o.o_orderkey, o.o_orderdate, o.o_custkey
"""

ORACLE["guarded_daily_load"] = _ODS.format(first="1996-01-01", last="1996-01-05")

ORACLE["rolling_reload"] = _ODS.format(first="1996-01-03", last="1996-01-10")

ORACLE["typed_migration"] = """
SELECT event_id AS stock_item_id, event_type AS stock_item_name, user_id AS supplier_id,
       CAST(CASE WHEN user_id % 3 <> 0 THEN user_id % 36 END AS INTEGER) AS color_id,
       CAST(event_id % 14 + 1 AS INTEGER) AS unit_package_id, CAST(event_id % 7 + 1 AS INTEGER) AS outer_package_id,
       upper(event_type) AS brand, CASE WHEN event_id % 5 = 0 THEN 'L' END AS size,
       CAST(hour(ts) AS INTEGER) AS lead_time_days, CAST(minute(ts) AS INTEGER) AS quantity_per_outer,
       event_id % 10 = 0 AS is_chiller_stock, CAST(event_id AS VARCHAR) AS barcode,
       CAST(15 AS DECIMAL(18,3)) AS tax_rate, CAST(value AS DECIMAL(18,2)) AS unit_price,
       CAST(CAST(value AS DECIMAL(18,2)) * CAST(1.25 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS recommended_retail_price,
       CAST(value AS DECIMAL(18,3)) AS typical_weight_before_unit,
       CAST(NULL AS VARCHAR) AS marketing_comments, CAST(NULL AS VARCHAR) AS internal_comments,
       json_extract_string(props, '$.k') AS country_of_manufacture,
       CAST(date_diff('day', CAST(ts AS DATE), CAST(ts + to_days(CAST(floor(value) AS INTEGER)) AS DATE)) AS INTEGER) AS range_days,
       CAST((year(ts + to_days(CAST(floor(value) AS INTEGER))) - year(ts)) * 12
            + month(ts + to_days(CAST(floor(value) AS INTEGER))) - month(ts) AS INTEGER) AS shelf_life_months
FROM events
"""

ORACLE["json_shred_load"] = """
SELECT (SELECT max(p_partkey) FROM part) + row_number() OVER (ORDER BY o_orderkey) AS stock_item_id,
       o_orderpriority AS stock_item_name, o_custkey AS supplier_id, CAST(NULL AS INTEGER) AS color_id, 1 AS unit_package_id,
       CAST(length(o_orderpriority) AS INTEGER) AS outer_package_id, o_orderstatus AS brand,
       CAST(NULL AS VARCHAR) AS size, 5 AS lead_time_days, 1 AS quantity_per_outer, false AS is_chiller_stock,
       CAST(NULL AS VARCHAR) AS barcode, CAST(6 AS DECIMAL(18,3)) AS tax_rate,
       CAST(o_totalprice AS DECIMAL(18,2)) AS unit_price,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(1.25 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS recommended_retail_price,
       CAST(0.5 AS DECIMAL(18,3)) AS typical_weight_per_unit,
       CAST(NULL AS VARCHAR) AS marketing_comments, CAST(NULL AS VARCHAR) AS internal_comments, CAST(NULL AS VARCHAR) AS photo,
       '[]' AS tags, 'None' AS search_details, 1 AS last_edited_by,
       to_json(struct_pack("CountryOfManufacture" := o_orderstatus))::VARCHAR AS custom_fields,
       TIMESTAMP '2016-05-31 23:00:00' AS valid_from, TIMESTAMP '9999-12-31 23:59:59.999999' AS valid_to
FROM orders WHERE o_orderkey % 50 <> 0
"""

ORACLE["json_shred_purchase_orders"] = """
SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY o_orderkey) AS purchase_order_id,
       CAST(CAST('0x' || substr(md5('0:' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 13 + 1 AS INTEGER) AS supplier_id,
       CAST(o_orderdate AS DATE) AS order_date, 1 AS delivery_method_id, 2 AS contact_person_id,
       CAST(o_orderdate AS DATE) + 32 AS expected_delivery_date,
       'WWI' || CAST(o_orderkey AS VARCHAR) AS supplier_reference, true AS is_order_finalized,
       CAST(NULL AS VARCHAR) AS comments, CAST(NULL AS VARCHAR) AS internal_comments,
       CAST(CAST('0x' || substr(md5('7:' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 20 + 1 AS INTEGER) AS last_edited_by,
       CAST(o_orderdate AS DATE) + 1 AS last_edited_when
FROM orders WHERE o_orderkey % 50 <> 0
"""

ORACLE["json_shred_quarantine"] = """
SELECT o_orderkey AS doc_id, 'WWI' || CAST(o_orderkey AS VARCHAR) AS supplier_reference, 'OrderDate' AS bad_fields
FROM orders WHERE o_orderkey % 50 = 0
"""

ORACLE["pivot_to_json"] = "WITH pv AS (" + _YEAR_BY_GROUP + ") SELECT to_json(list(struct_pack(transaction_year := transaction_year, " + ", ".join(
    f"{_gcol(g)} := {_gcol(g)}" for g in _PIVOT_GROUPS) + ") ORDER BY transaction_year))::VARCHAR AS json_text FROM pv"

_XML_NAMES = {"economy": "Economy", "large": "Large", "medium": "Medium", "promo": "Promo",
              "small": "Small", "standard": "Standard", "brand_1": "Brand1", "brand_2": "Brand2",
              "brand_3": "Brand3"}

ORACLE["pivot_to_xml"] = "WITH pv AS (" + _YEAR_BY_GROUP + ") SELECT string_agg('<row><TransactionYear>' || transaction_year || '</TransactionYear>' || " + " || ".join(
    f"coalesce('<{_XML_NAMES[_gcol(g)]}>' || {_gcol(g)} || '</{_XML_NAMES[_gcol(g)]}>', '')" for g in _PIVOT_GROUPS
) + " || '</row>', '' ORDER BY transaction_year) AS xml_text FROM pv"

ORACLE["nested_invoice_json"] = """
WITH inv AS (
  SELECT * FROM orders WHERE o_orderdate IN (SELECT o_orderdate FROM orders WHERE o_custkey = 1)),
ln AS (
  SELECT l_orderkey, list(struct_pack(
           l_linenumber := l_linenumber, l_partkey := l_partkey, l_suppkey := l_suppkey,
           l_quantity := CAST(l_quantity AS DECIMAL(18,2)), l_extendedprice := CAST(l_extendedprice AS DECIMAL(18,2)),
           l_discount := CAST(l_discount AS DECIMAL(18,2)), l_tax := CAST(l_tax AS DECIMAL(18,2)),
           l_returnflag := l_returnflag, l_linestatus := l_linestatus, l_shipdate := strftime(l_shipdate, '%Y-%m-%d'))
         ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)), CAST(l_extendedprice AS DECIMAL(18,2)),
                  CAST(l_discount AS DECIMAL(18,2)), CAST(l_tax AS DECIMAL(18,2)), l_returnflag, l_linestatus, l_shipdate) AS il
  FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM inv) GROUP BY l_orderkey)
SELECT row_number() OVER (ORDER BY CAST(inv.o_orderdate AS DATE), inv.o_orderkey) AS confirmed_delivery_id,
       CAST(inv.o_orderdate AS DATE) AS confirmed_delivery_date,
       to_json(struct_pack(o_orderkey := inv.o_orderkey, o_custkey := inv.o_custkey, o_orderstatus := inv.o_orderstatus,
                           o_totalprice := CAST(inv.o_totalprice AS DECIMAL(18,2)),
                           o_orderdate := strftime(inv.o_orderdate, '%Y-%m-%d'),
                           o_orderpriority := inv.o_orderpriority, "IL" := ln.il))::VARCHAR AS confirmed_delivery_info
FROM inv JOIN ln ON inv.o_orderkey = ln.l_orderkey
"""

_MOVIES = """
WITH m AS (
  SELECT o.o_orderkey AS movie_id, 'Order ' || CAST(o.o_orderkey AS VARCHAR) AS title,
         o.o_orderpriority AS overview, o.o_orderstatus AS tagline,
         CAST(o.o_totalprice * 4 AS DECIMAL(18,2)) AS budget_d,
         CAST(o.o_totalprice AS DECIMAL(18,2)) AS revenue_d,
         'https://imdb.example/' || CAST(o.o_orderkey AS VARCHAR) AS imdb_url,
         'https://tmdb.example/' || CAST(o.o_orderkey AS VARCHAR) AS tmdb_url,
         '/poster/' || CAST(o.o_orderkey AS VARCHAR) || '.jpg' AS poster_url,
         '/backdrop/' || CAST(o.o_orderkey AS VARCHAR) || '.jpg' AS backdrop_url,
         CAST(o.o_orderdate AS DATE) AS release_date,
         CAST(trunc(c.c_acctbal) AS INTEGER) AS runtime,
         CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(18,2)) AS price_d,
         o.o_orderdate AS created_time,
         CASE WHEN o.o_orderkey % 7 = 0 THEN [] ELSE [
           struct_pack(id := CAST(substr(o.o_orderpriority, 1, 1) AS BIGINT), name := o.o_orderpriority),
           struct_pack(id := 100 + o.o_custkey % 50, name := 'Segment ' || CAST(o.o_custkey % 50 AS VARCHAR)),
           struct_pack(id := CAST(200 + ascii(o.o_orderstatus) AS BIGINT),
                       name := CASE WHEN o.o_orderstatus = 'P' THEN '' ELSE o.o_orderstatus END)] END AS genres
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
docs AS (
  SELECT m.*, to_json(struct_pack(
      "Id" := movie_id, "Title" := title, "Overview" := overview, "Tagline" := tagline,
      "Budget" := budget_d, "Revenue" := revenue_d, "ImdbUrl" := imdb_url, "TmdbUrl" := tmdb_url,
      "PosterUrl" := poster_url, "BackdropUrl" := backdrop_url, "OriginalLanguage" := 'en',
      "ReleaseDate" := strftime(created_time, '%Y-%m-%d'), "RunTime" := runtime, "Price" := price_d,
      "CreatedDate" := strftime(created_time, '%Y-%m-%dT%H:%M:%S'), "genres" := genres))::VARCHAR AS value
  FROM m),
silver AS (
  SELECT value, movie_id, title, overview, tagline, CAST(budget_d AS DOUBLE) AS budget,
         CAST(revenue_d AS DOUBLE) AS revenue, imdb_url, tmdb_url, poster_url, backdrop_url,
         1 AS original_language_id, release_date, runtime, CAST(price_d AS DOUBLE) AS price,
         created_time, list_transform(genres, lambda x: x.id) AS genre_id
  FROM docs)
"""

_SILVER_COLS = ("movie_id, title, overview, tagline, budget, revenue, imdb_url, tmdb_url, poster_url, "
                "backdrop_url, original_language_id, release_date, runtime, price, created_time, genre_id")

ORACLE["bronze_ingest"] = _MOVIES + """
SELECT 'testdata/orders' AS datasource, TIMESTAMP '2024-01-01 00:00:00' AS ingesttime, value,
       'new' AS status, DATE '2024-01-01' AS p_ingestdate
FROM docs
"""

ORACLE["silver_clean"] = _MOVIES + f"""
SELECT {_SILVER_COLS} FROM silver WHERE runtime >= 0 AND budget >= 1000000
"""

ORACLE["silver_quarantine"] = _MOVIES + f"""
SELECT {_SILVER_COLS} FROM silver WHERE runtime < 0 OR budget < 1000000
"""

ORACLE["silver_repaired"] = _MOVIES + """
SELECT movie_id, title, overview, tagline,
       CASE WHEN budget < 1000000 THEN 1000000.0 ELSE budget END AS budget,
       revenue, imdb_url, tmdb_url, poster_url, backdrop_url, original_language_id, release_date,
       abs(runtime) AS runtime, price, created_time, genre_id
FROM silver
WHERE (runtime >= 0 AND budget >= 1000000) OR (runtime < 0 OR budget < 1000000)
"""

ORACLE["status_write_back"] = _MOVIES + """
SELECT 'testdata/orders' AS datasource, TIMESTAMP '2024-01-01 00:00:00' AS ingesttime, value,
       CASE WHEN runtime >= 0 AND budget >= 1000000 THEN 'loaded'
            WHEN runtime < 0 OR budget < 1000000 THEN 'quarantined'
            ELSE 'unclassified' END AS status,
       DATE '2024-01-01' AS p_ingestdate
FROM silver
"""

ORACLE["status_merge"] = ORACLE["status_write_back"]

ORACLE["defect_counts"] = _MOVIES + """
SELECT count(*) FILTER (WHERE runtime < 0) AS negative_runtime, count(*) FILTER (WHERE budget < 1000000) AS low_budget
FROM (SELECT DISTINCT value, runtime, budget FROM silver)
"""

ORACLE["defect_counts_on_the_way"] = _MOVIES + """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE runtime >= 0 AND budget >= 1000000) AS clean,
       count(*) FILTER (WHERE runtime < 0) AS negative_runtime, count(*) FILTER (WHERE budget < 1000000) AS low_budget,
       count(*) FILTER (WHERE NOT coalesce(runtime >= 0 AND budget >= 1000000, false)
                          AND NOT coalesce(runtime < 0 OR budget < 1000000, false)) AS unclassified
FROM (SELECT DISTINCT value, runtime, budget FROM silver)
"""

ORACLE["document_items"] = _MOVIES + """
SELECT movie_id, title, runtime, release_date, genres[2].name AS second_genre FROM m
"""

ORACLE["genre_lookup"] = _MOVIES + """
SELECT DISTINCT g.id AS id, g.name AS name FROM (SELECT unnest(genres) AS g FROM m) WHERE g.name != ''
"""

ORACLE["genre_lookup_merge"] = ORACLE["genre_lookup"]

ORACLE["genre_texts"] = _MOVIES + """
SELECT movie_id, to_json(genre_id)::VARCHAR AS genre_ids FROM silver WHERE runtime >= 0 AND budget >= 1000000
"""

ORACLE["language_lookup"] = """
SELECT CAST(row_number() OVER (ORDER BY lang) AS INTEGER) AS id, lang AS language
FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)
"""

_OLTP_ORDERS = """
SELECT o_orderkey AS OrderID, o_custkey AS CustomerID,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS SalespersonPersonID,
       CASE WHEN o_orderstatus = 'F' THEN CAST(substr(o_orderpriority, 1, 1) AS INTEGER) END AS PickedByPersonID,
       CAST(o_custkey % 100 AS INTEGER) AS ContactPersonID,
       CAST(NULL AS BIGINT) AS BackorderOrderID, CAST(o_orderdate AS DATE) AS OrderDate,
       CAST(NULL AS VARCHAR) AS DeliveryInstructions, CAST(NULL AS VARCHAR) AS InternalComments,
       CAST(o_orderdate AS DATE) + 7 AS ExpectedDeliveryDate, o_orderpriority AS CustomerPurchaseOrderNumber,
       o_orderstatus = 'P' AS IsUndersupplyBackordered, o_orderstatus AS Comments,
       o_orderdate + INTERVAL 1 DAY AS PickingCompletedWhen, 1 AS LastEditedBy,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS LastEditedWhen
FROM orders
"""

ORACLE["incremental_upsert"] = f"""
WITH base AS ({_OLTP_ORDERS})
SELECT OrderID, CustomerID, SalespersonPersonID, PickedByPersonID, ContactPersonID, BackorderOrderID, OrderDate,
       DeliveryInstructions, InternalComments, ExpectedDeliveryDate, CustomerPurchaseOrderNumber, IsUndersupplyBackordered,
       CASE WHEN OrderDate >= DATE '1997-12-01' AND OrderDate < DATE '1998-01-01' THEN 'edited' ELSE Comments END AS Comments,
       PickingCompletedWhen, LastEditedBy,
       CASE WHEN OrderDate >= DATE '1997-12-01' AND OrderDate < DATE '1998-01-01' THEN '1998-06-30 12:00:00'
            ELSE LastEditedWhen END AS LastEditedWhen
FROM base
"""

# However the table is kept, its rows are the same.
ORACLE["incremental_upsert_buckets"] = ORACLE["incremental_upsert"]

ORACLE["incremental_upsert_lines"] = """
WITH l AS (
  SELECT l_linenumber AS OrderLineID, l_orderkey AS OrderID, l_partkey AS StockItemID,
         'line ' || CAST(l_linenumber AS VARCHAR) AS Description, CAST(l_partkey % 14 + 1 AS INTEGER) AS PackageTypeID,
         CAST(l_quantity AS INTEGER) AS Quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS UnitPrice,
         CAST(l_tax AS DECIMAL(18,3)) AS TaxRate, CAST(l_quantity AS INTEGER) AS PickedQuantity,
         l_shipdate AS PickingCompletedWhen, 1 AS LastEditedBy, l_shipdate AS LastEditedWhen
  FROM lineitem WHERE l_shipdate > TIMESTAMP '1990-01-01')
SELECT * EXCLUDE (k) FROM (
  SELECT *, row_number() OVER (PARTITION BY OrderID, OrderLineID, StockItemID
                               ORDER BY LastEditedWhen DESC, Quantity DESC, UnitPrice DESC, TaxRate DESC) AS k FROM l)
WHERE k = 1
"""

ORACLE["null_watermark_report"] = """
SELECT o_orderkey AS OrderID, CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE 'not yet' END AS LastEditedWhen
FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 101 = 0
"""

ORACLE["renamed_columns"] = "SELECT c_custkey AS customer_id, c_name AS title, c_mktsegment AS segment FROM customer"

ORACLE["trimmed_columns"] = """
SELECT p_partkey, upper(trim(p_name)) AS p_name, upper(trim(p_brand)) AS p_brand, upper(trim(p_type)) AS p_type FROM part
"""

ORACLE["row_hashes"] = """
SELECT o_orderkey, sha256('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus
                          || '","o_orderpriority":"' || o_orderpriority || '"}') AS row_hash
FROM orders
"""

ORACLE["never_pending"] = """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
"""

ORACLE["line_kinds"] = "SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem"

ORACLE["json_objects"] = """
SELECT event_id, json(props)::VARCHAR AS whole, CAST(NULL AS VARCHAR) AS scalar FROM events
"""

ORACLE["typed_target"] = """
SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS o_totalprice, CAST(NULL AS VARCHAR) AS o_comment, o_orderpriority
FROM orders
"""

ORACLE["days_with_orders"] = """
SELECT CAST(d AS VARCHAR) AS day, EXISTS (SELECT 1 FROM orders WHERE CAST(o_orderdate AS DATE) = d) AS found
FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem)
"""

ORACLE["top_orders_in_order"] = """
SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place, o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price
FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50
"""

_FACT = f"""
WITH o AS ({_OLTP_ORDERS}),
ol AS (
  SELECT l_orderkey AS OrderID, l_linenumber AS OrderLineID, l_partkey AS StockItemID,
         CAST(l_quantity AS INTEGER) AS Quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS UnitPrice,
         CAST(l_tax AS DECIMAL(18,3)) AS TaxRate, 'line ' || CAST(l_linenumber AS VARCHAR) AS Description
  FROM lineitem),
fact AS (
  SELECT o.CustomerID AS CustomerKey, ol.StockItemID AS StockItemKey, o.OrderDate AS OrderDateKey,
         CAST(o.PickingCompletedWhen AS DATE) AS PickedDateKey, o.SalespersonPersonID AS SalespersonKey,
         o.PickedByPersonID AS PickerKey, o.OrderID AS WWIOrderID, o.BackorderOrderID AS WWIBackorderID,
         ol.Description, ol.Quantity, ol.UnitPrice, ol.TaxRate,
         CAST(ol.Quantity * ol.UnitPrice AS DECIMAL(18,2)) AS TotalExcludingTax,
         CAST(ol.Quantity * ol.UnitPrice * ol.TaxRate AS DECIMAL(18,2)) AS TaxAmount,
         CAST(ol.Quantity * ol.UnitPrice + ol.Quantity * ol.UnitPrice * ol.TaxRate AS DECIMAL(18,2)) AS TotalIncludingTax,
         CAST(o.LastEditedWhen AS TIMESTAMP) AS CreatedAt
  FROM o JOIN ol ON o.OrderID = ol.OrderID)
"""

ORACLE["fact_orders"] = _FACT + "SELECT * FROM fact"

ORACLE["dim_customers"] = _FACT + """, changes AS (SELECT DISTINCT CustomerKey, CreatedAt FROM fact)
SELECT CustomerKey, CreatedAt AS ValidFrom,
       LEAD(CreatedAt) OVER (PARTITION BY CustomerKey ORDER BY CreatedAt) AS ValidTo,
       CASE WHEN LEAD(CreatedAt) OVER (PARTITION BY CustomerKey ORDER BY CreatedAt) IS NULL THEN 1 ELSE 0 END AS Active
FROM changes
"""

ORACLE["dim_customers_incremental"] = ORACLE["dim_customers"]

ORACLE["scan_filter_project"] = """
SELECT l_orderkey AS order_key, l_partkey AS item_key, CAST(l_quantity AS BIGINT) AS quantity,
       CAST(l_extendedprice AS DECIMAL(18,2)) AS price
FROM lineitem
WHERE l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'
  AND l_quantity >= 25 AND l_discount IS NOT NULL
"""

ORACLE["dedupe_first_by_key"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                            l_discount, l_tax, l_returnflag, l_linestatus) AS rn
      FROM lineitem)
WHERE rn = 1
"""

ORACLE["constraint_violations"] = """
SELECT 'primary_key' AS check_name, 'lineitem' AS table_name,
       CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) AS key_value, CAST(count(*) AS BIGINT) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL
UNION ALL
SELECT 'primary_key', 'orders', CAST(o_orderkey AS VARCHAR), count(*)
FROM orders GROUP BY o_orderkey HAVING count(*) > 1 OR o_orderkey IS NULL
UNION ALL
SELECT 'not_null:o_custkey', 'orders', CAST(o_orderkey AS VARCHAR), count(*) FROM orders WHERE o_custkey IS NULL GROUP BY o_orderkey
UNION ALL
SELECT 'not_null:o_orderdate', 'orders', CAST(o_orderkey AS VARCHAR), count(*) FROM orders WHERE o_orderdate IS NULL GROUP BY o_orderkey
UNION ALL
SELECT 'foreign_key:l_orderkey', 'lineitem', CAST(l_orderkey AS VARCHAR), count(*) FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL) GROUP BY l_orderkey
UNION ALL
SELECT 'foreign_key:l_partkey', 'lineitem', CAST(l_partkey AS VARCHAR), count(*) FROM lineitem
WHERE l_partkey IS NOT NULL AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey IS NOT NULL) GROUP BY l_partkey
UNION ALL
SELECT 'foreign_key:l_suppkey', 'lineitem', CAST(l_suppkey AS VARCHAR), count(*) FROM lineitem
WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey IS NOT NULL) GROUP BY l_suppkey
UNION ALL
SELECT 'foreign_key:o_custkey', 'orders', CAST(o_custkey AS VARCHAR), count(*) FROM orders
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey IS NOT NULL) GROUP BY o_custkey
"""

ORACLE["sensor_tumbling_avg"] = """
WITH r AS (
  SELECT user_id AS id, ts, value,
         TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS temperature,
         CAST(floor(value) AS INTEGER) AS humidity,
         CAST(floor(epoch_us(ts) / 5000000) AS BIGINT) AS bucket
  FROM events),
g AS (
  SELECT id, bucket,
         round(avg(value), 6) AS average_uv,
         CAST(sum(CAST(temperature AS BIGINT)) AS DOUBLE) / count(temperature) AS average_temperature,
         CAST(sum(CAST(humidity AS BIGINT)) AS DOUBLE) / count(humidity) AS average_humidity,
         make_timestamp(CAST((sum(CAST(floor(epoch_us(ts) / 1000000) AS BIGINT)) // count(ts)) * 1000000 AS BIGINT)) AS estimated_time
  FROM r GROUP BY id, bucket)
SELECT id, make_timestamp(bucket * 5000000) AS window_start, make_timestamp((bucket + 1) * 5000000) AS window_end,
       average_uv, average_temperature, average_humidity,
       CASE WHEN average_temperature > 85 AND average_humidity > 85 THEN 1 ELSE 0 END AS is_sweaty,
       estimated_time
FROM g
"""

_TITLE = ("array_to_string(list_transform(regexp_extract_all({s}, '(\\p{{L}}+|[^\\p{{L}}]+)'), "
          "lambda r: upper(substr(r, 1, 1)) || lower(substr(r, 2))), '')")

ORACLE["people_clean"] = """
WITH c AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey),
lines AS (
  SELECT lower(c_mktsegment) AS t0, 'o''' || lower(n_name) AS t1, '-' AS t2,
         lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS t3, CAST(c_custkey * 7919 AS VARCHAR) AS t4,
         lower(n_name) AS t5, 'street' AS t6 FROM c
  UNION ALL
  SELECT upper(lower(c_mktsegment)), upper('o''' || lower(n_name)), '-', lpad(CAST(c_custkey AS VARCHAR), 10, '0'),
         CAST(c_custkey * 7919 AS VARCHAR), lower(n_name), 'street' FROM c WHERE c_acctbal < 0
  UNION ALL
  SELECT 'supplier', lower(s_name), '-', CAST(s_suppkey * 7 AS VARCHAR), CAST(s_nationkey AS VARCHAR), 'mc-donald', 'street'
  FROM supplier)
SELECT DISTINCT """ + _TITLE.format(s="t0") + " || ',' || " + _TITLE.format(s="t1") + """ || ',' || t2 || ',' ||
       CASE WHEN length(t3) = 10 THEN substr(t3, 1, 3) || '-' || substr(t3, 4, 3) || '-' || substr(t3, 7, 4) ELSE t3 END
       || ',' || right(t4, 4) || ',' || t5 || ',' || t6 AS line
FROM lines
"""

ORACLE["json_split"] = """
WITH n AS (SELECT count(*) AS n FROM part),
idx AS (SELECT p_partkey AS k, row_number() OVER (ORDER BY p_partkey) - 1 AS i FROM part)
SELECT CAST(CASE WHEN n.n // 8 = 0 THEN 7 ELSE least(i // (n.n // 8), 7) END + 1 AS INTEGER) AS split_id,
       count(*) AS n_items, min(k) AS first_key, max(k) AS last_key, CAST(sum(k) AS BIGINT) AS key_sum
FROM idx, n
GROUP BY 1
"""

ORACLE["ledger_ids"] = """
WITH held AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS customer_no
              FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01'))
SELECT * FROM held
UNION ALL
SELECT o_custkey, (SELECT count(*) FROM held) + row_number() OVER (ORDER BY o_custkey) AS customer_no
FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM held))
"""

ORACLE["late_readings"] = """
WITH r AS (SELECT event_id, user_id, ts, CAST(ts AS DATE) + CASE WHEN event_id % 11 = 0 THEN 2 ELSE 0 END AS arrived FROM events),
b AS (SELECT arrived, max(max(ts)) OVER (ORDER BY arrived ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR AS mark
      FROM r GROUP BY arrived)
SELECT event_id, user_id, ts, CAST(CAST(arrived AS DATE) AS VARCHAR) AS arrived
FROM r JOIN b USING (arrived)
WHERE make_timestamp((CAST(floor(epoch_us(ts) / 5000000) AS BIGINT) + 1) * 5000000) <= mark
"""

ORACLE["compacted_orders"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(year(o_orderdate) AS INTEGER) AS year, false AS crowded FROM orders
"""

# The SQL objects give the rows of their DataFrame forms.
ORACLE["sql_order_totals"] = ORACLE["invoice_with_total"]
ORACLE["sql_orders_between"] = ORACLE["guarded_daily_load"]
ORACLE["sql_sales_by_group"] = ORACLE["pivot_group_by_year"]
ORACLE["sql_sales_by_year"] = ORACLE["pivot_year_by_group"]

# Output columns that leave the engines in a portable form: decimals as DOUBLE
# (both engines convert a decimal to the same nearest double) and nested values
# as JSON text.  Spark applies the same rule generically (``__spark_entry__``).
PORTABLE = {
    "json_value_group": {"total_value": "double"},
    "invoice_with_total": {"order_total": "double"},
    "guarded_daily_load": {"order_total": "double"},
    "sql_order_totals": {"order_total": "double"},
    "sql_orders_between": {"order_total": "double"},
    "typed_migration": {"typical_weight_before_unit": "double", "tax_rate": "double", "unit_price": "double",
                        "recommended_retail_price": "double"},
    "incremental_upsert_lines": {"UnitPrice": "double", "TaxRate": "double"},
    "typed_target": {"o_totalprice": "double"},
    "top_orders_in_order": {"price": "double"},
    "rolling_reload": {"order_total": "double"},
    "json_shred_load": {"tax_rate": "double", "unit_price": "double", "recommended_retail_price": "double",
                        "typical_weight_per_unit": "double"},
    "silver_clean": {"genre_id": "json"},
    "silver_quarantine": {"genre_id": "json"},
    "silver_repaired": {"genre_id": "json"},
    "fact_orders": {"UnitPrice": "double", "TaxRate": "double", "TotalExcludingTax": "double",
                    "TaxAmount": "double", "TotalIncludingTax": "double"},
    "scan_filter_project": {"price": "double"},
}


def portable_sql(key: str) -> str:
    sql = ORACLE[key]
    cols = PORTABLE.get(key)
    if not cols:
        return sql
    repl = ", ".join(f'CAST("{c}" AS DOUBLE) AS "{c}"' if kind == "double" else f'to_json("{c}")::VARCHAR AS "{c}"'
                     for c, kind in cols.items())
    return f"SELECT * REPLACE ({repl}) FROM ({sql}) AS q"
