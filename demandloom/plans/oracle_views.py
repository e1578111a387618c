"""DuckDB text of the retail tables, for the oracle side only."""

VIEWS: dict[str, str] = {
    "v_lines": """
        SELECT CAST(o.o_orderdate AS DATE) AS date, s.s_nationkey AS store_id,
          CAST(replace(p.p_brand, 'Brand#', '') AS INTEGER) AS product_id,
          l.l_orderkey, l.l_linenumber, l.l_quantity, l.l_extendedprice, l.l_discount
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
          JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "v_sales": """
        SELECT date, store_id, product_id, SUM(l_quantity) AS sales,
          CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT) * (100 - CAST(ROUND(l_discount * 100) AS BIGINT)))
            AS DOUBLE) / CAST(10000 AS DOUBLE) AS revenue,
          CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS DOUBLE)
            / (CAST(100 AS DOUBLE) * SUM(l_quantity)) AS price
        FROM v_lines GROUP BY 1, 2, 3""",
    "v_gappy": """
        SELECT date, store_id, product_id, CASE WHEN day(date) % 7 <> 0 THEN sales END AS sales FROM v_sales""",
    "v_store_days": "SELECT store_id, date, SUM(l_quantity) AS sales FROM v_lines GROUP BY 1, 2",
    "v_stores": """
        SELECT n.n_nationkey AS store_id, n.n_name AS store_name, r.r_name AS region,
          CASE n.n_nationkey % 5 WHEN 0 THEN 'Corner' WHEN 1 THEN 'Market Hall' WHEN 2 THEN 'Outlet'
            WHEN 3 THEN 'Depot' ELSE 'Kiosk' END AS store_type,
          1000 + 2000 * n.n_nationkey AS size_sqft, DATE '1990-01-01' + CAST(n.n_nationkey AS INTEGER) AS opening_date,
          n.n_nationkey % 10 <> 9 AS is_active
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey""",
    "v_products": """
        SELECT CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS product_id, p_brand AS product_name,
          concat('Cat', CAST(CAST(replace(p_brand, 'Brand#', '') AS INTEGER) % 5 AS VARCHAR)) AS category,
          CAST(SUM(CAST(ROUND(p_retailprice * 100) AS BIGINT)) AS DOUBLE) / (CAST(100 AS DOUBLE) * COUNT(*)) AS price,
          CAST(SUM(CAST(ROUND(p_retailprice * 100) AS BIGINT)) AS DOUBLE) * 6 / (CAST(1000 AS DOUBLE) * COUNT(*)) AS cost,
          CAST(MIN(p_size) AS INTEGER) AS lead_time_days
        FROM part GROUP BY 1, 2, 3""",
    "v_dates": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders",
    "v_weather": """
        SELECT date, CAST(day(date) + month(date) * 2 - 10 AS DOUBLE) AS temperature,
          CAST((day(date) * 7 + month(date)) % 23 - 8 AS DOUBLE) AS precipitation FROM v_dates""",
    "v_economy": """
        SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
          CAST(100 + (year(o_orderdate) * 12 + month(o_orderdate)) % 7 AS DOUBLE) AS consumer_confidence_index,
          CAST(4 + (year(o_orderdate) + month(o_orderdate)) % 4 AS DOUBLE) AS unemployment_rate FROM orders""",
    "v_competitors": """
        SELECT CAST(o_orderdate AS DATE) AS date, 'A' AS competitor, CAST(COUNT(*) + 1 AS DOUBLE) AS price_index
        FROM orders GROUP BY 1
        UNION ALL SELECT CAST(o_orderdate AS DATE), 'B', CAST(COUNT(*) + 4 AS DOUBLE) FROM orders GROUP BY 1""",
    "v_social": """
        SELECT CAST(o_orderdate AS DATE) AS date, CAST(COUNT(*) AS DOUBLE) AS retail_trend
        FROM orders WHERE isodow(o_orderdate) = 7 GROUP BY 1""",
    "v_inventory": """
        SELECT DISTINCT store_id, product_id, CAST((store_id * 37 + product_id * 11) % 200 AS INTEGER) AS current_stock,
          CAST(40 AS INTEGER) AS safety_stock, CAST(70 AS INTEGER) AS reorder_point FROM v_lines""",
    "v_ledger": """
        SELECT s.s_nationkey AS store_id, CAST(l.l_shipdate AS DATE) AS date,
          SUM(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE CAST(0 AS DOUBLE) END) AS receipts,
          SUM(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE CAST(0 AS DOUBLE) END) AS demand
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY 1, 2""",
    "v_stock_ledger": """
        SELECT store_id, date, receipts + 20 AS level, CASE WHEN receipts > demand THEN receipts ELSE 0.0 END AS order_qty,
          demand, greatest(demand - receipts - 20, CAST(0 AS DOUBLE)) AS short FROM v_ledger""",
    "v_promotions": """
        SELECT o_orderkey AS promo_seq, CAST(o_custkey % 25 + 1 AS INTEGER) AS product_id,
          CASE o_orderkey % 3 WHEN 0 THEN 'Two For One' WHEN 1 THEN 'Markdown' ELSE 'Weekend Deal' END AS promotion_type,
          CAST(o_orderkey % 5 + 1 AS DOUBLE) / 10 AS discount_rate, CAST(o_orderdate AS DATE) AS start_date,
          CAST(o_orderdate AS DATE) + CAST(o_orderkey % 15 AS INTEGER) AS end_date
        FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "v_holidays": """
        SELECT date, holiday_name, holiday_name IN ('New Year''s Day', 'Independence Day', 'Thanksgiving',
            'Christmas Day', 'Memorial Day', 'Labor Day') AS is_major_holiday
        FROM (
          SELECT make_date(y, m, d) AS date, n AS holiday_name FROM v_years, (VALUES ('New Year''s Day', 1, 1),
            ('Independence Day', 7, 4), ('Veterans Day', 11, 11), ('Christmas Day', 12, 25)) AS f(n, m, d)
          UNION ALL
          SELECT make_date(y, m, 1) + CAST((dow + 7 - isodow(make_date(y, m, 1))) % 7 + 7 * (nth - 1) AS INTEGER), n
          FROM v_years, (VALUES ('Martin Luther King Jr. Day', 1, 1, 3), ('Washington''s Birthday', 2, 1, 3),
            ('Labor Day', 9, 1, 1), ('Columbus Day', 10, 1, 2), ('Thanksgiving', 11, 4, 4)) AS g(n, m, dow, nth)
          UNION ALL
          SELECT make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INTEGER), 'Memorial Day' FROM v_years
        ) WHERE date BETWEEN (SELECT min(date) FROM v_dates) AND (SELECT max(date) FROM v_dates)""",
    "v_years": "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders",
    "v_dated_events": """
        SELECT CAST(o_orderdate AS DATE) AS event_date, o_orderpriority AS event_type
        FROM orders WHERE o_totalprice > 400000""",
    "v_forecasts": """
        SELECT store_id, date AS ds, sales AS y,
          lag(sales, 7) OVER w AS naive7, lag(sales, 28) OVER w AS naive28,
          CASE WHEN count(sales) OVER p = 7 THEN avg(sales) OVER p END AS mean7
        FROM v_store_days
        WINDOW w AS (PARTITION BY store_id ORDER BY date),
          p AS (PARTITION BY store_id ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    "v_long": """
        SELECT store_id, ds, y, 'naive7' AS model, naive7 AS yhat FROM v_forecasts
        UNION ALL SELECT store_id, ds, y, 'naive28', naive28 FROM v_forecasts
        UNION ALL SELECT store_id, ds, y, 'mean7', mean7 FROM v_forecasts""",
    "v_dense": """
        SELECT c.store_id, c.date, s.sales
        FROM (SELECT store_id, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date
              FROM v_store_days GROUP BY 1) c
        LEFT JOIN v_store_days s USING (store_id, date)""",
}
