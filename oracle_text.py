"""DuckDB SQL that states, over the driver's tables, what each registered query must return.

The statements follow the plain definition of every table (date spine, windows, percent_rank, ntile), not the way
the Spark code computes it. Tables that queries share are named building blocks; a statement lists only its own last
step and receives the blocks it mentions.
"""

from __future__ import annotations

import re

from tablespoon import fixtures as X

M = "DECIMAL(18,2)"


def _select(columns: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in columns.items())


_HOLIDAY = "CASE strftime(d, '%m-%d') " + " ".join(
    f"WHEN '{day}' THEN '{name.replace(chr(39), chr(39) * 2)}'" for day, name in X.HOLIDAYS.items()
) + " END"


def _mean(x: str) -> str:
    return f"CAST(SUM({x}) AS DOUBLE) / CAST(COUNT({x}) AS DOUBLE)"


def _share(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100"


def _money(x: str) -> str:
    return f"CAST(SUM({x}) AS {M})"


def _count_if(x: str) -> str:
    return f"COUNT(CASE WHEN {x} THEN 1 END)"


def _pct1(part: str, whole: str) -> str:
    """part / whole in percent, one decimal, ties to even, on whole numbers."""
    t, w = f"({part} * 1000)", f"NULLIF({whole}, 0)"
    q, r = f"({t} // {w})", f"(({t} % {w}) * 2)"
    up = f"(CASE WHEN {r} > {w} OR ({r} = {w} AND {q} % 2 = 1) THEN 1 ELSE 0 END)"
    return f"CAST(CAST({q} + {up} AS DECIMAL(15,0)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(5,1))"


def _label(flag: str) -> str:
    return f"CASE WHEN {flag} THEN 'Loyalty Member' WHEN NOT {flag} THEN 'Non-Member' END"


_OPTION_TOTALS = f"""
  CAST(SUM(CASE WHEN option_price >= 0 THEN option_revenue ELSE 0 END) AS {M}) AS option_revenue,
  CAST(SUM(CASE WHEN option_price < 0 THEN ABS(option_revenue) ELSE 0 END) AS {M}) AS discount_amount,
  CAST(MAX(CAST(is_discount AS INT)) AS INT) AS discounted"""

BLOCKS = {
    "landing_items": f"""SELECT {_select(X.ITEM_COLUMNS)} FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "landing_options": f"""SELECT {_select(X.ADD_ON_COLUMNS)} FROM lineitem WHERE {X.ADD_ON_FILTER}
  UNION ALL SELECT {_select(X.DISCOUNT_COLUMNS)} FROM lineitem WHERE {X.DISCOUNT_FILTER}""",
    "landing_dates": f"""SELECT strftime(d, '%d-%m-%Y') AS date_key, CAST(year(d) AS STRING) AS year,
  CAST(month(d) AS STRING) AS month, CAST(weekofyear(d) AS STRING) AS week, dayname(d) AS day_of_week,
  CASE WHEN dayofweek(d) IN (0, 6) THEN 'TRUE' ELSE 'FALSE' END AS is_weekend,
  CASE WHEN {_HOLIDAY} IS NOT NULL THEN 'TRUE' ELSE 'FALSE' END AS is_holiday, {_HOLIDAY} AS holiday_name
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)""",
    "typed_items": """SELECT ORDER_ID AS order_id, LINEITEM_ID AS lineitem_id, APP_NAME AS app_name,
  RESTAURANT_ID AS restaurant_id, CAST(substr(CREATION_TIME_UTC, 1, 10) AS DATE) AS order_date,
  CAST(replace(replace(CREATION_TIME_UTC, 'T', ' '), 'Z', '') AS TIMESTAMP) AS order_timestamp,
  COALESCE(USER_ID, 'GUEST') AS user_id, CAST(IS_LOYALTY AS BOOLEAN) AS is_loyalty, CURRENCY AS currency,
  ITEM_CATEGORY AS raw_category,
  CASE WHEN contains(ITEM_CATEGORY, 'BBQ Plateshttps') THEN 'BBQ Plates'
    WHEN contains(ITEM_CATEGORY, 'Drip Chttps') THEN 'Drip Coffee'
    WHEN contains(ITEM_CATEGORY, 'Kid''shttps') THEN 'Kids' WHEN ITEM_CATEGORY = 'Kid''s' THEN 'Kids'
    WHEN ITEM_CATEGORY = 'Sqalads' THEN 'Salads' WHEN ITEM_CATEGORY = 'Bowls0' THEN 'Bowls'
    WHEN starts_with(ITEM_CATEGORY, 'Sandwiches') THEN 'Sandwiches' ELSE ITEM_CATEGORY END AS item_category,
  ITEM_NAME AS item_name, CAST(ITEM_PRICE AS DECIMAL(10,2)) AS item_price,
  CAST(ITEM_QUANTITY AS INT) AS item_quantity,
  CAST(CAST(ITEM_PRICE AS DECIMAL(10,2)) * CAST(ITEM_QUANTITY AS INT) AS DECIMAL(10,2)) AS line_item_revenue
  FROM landing_items""",
    "kept_lines": """SELECT * FROM typed_items WHERE item_category <> 'Test Items' AND item_price < 1000 AND item_quantity < 100
  AND line_item_revenue < 2000""",
    "order_times": """SELECT user_id, order_id, MIN(order_timestamp) AS t, MIN(order_date) AS d FROM kept_lines GROUP BY ALL""",
    "activity_of": """SELECT user_id, COUNT(*) AS orders, COUNT(gap) AS gaps, COUNT(CASE WHEN gap <= 300 THEN 1 END) AS quick_gaps
  FROM (SELECT *, epoch(t) - epoch(lag(t) OVER (PARTITION BY user_id ORDER BY t)) AS gap FROM order_times) GROUP BY user_id""",
    "account_activity": """SELECT a.user_id, orders, gaps, quick_gaps,
  CASE WHEN gaps > 0 THEN CAST(quick_gaps AS DOUBLE) / CAST(gaps AS DOUBLE) ELSE 0.0 END AS quick_share, most_a_day, locations
  FROM activity_of a JOIN (SELECT user_id, MAX(n) AS most_a_day FROM (SELECT user_id, d, COUNT(*) AS n FROM order_times GROUP BY ALL)
    GROUP BY user_id) m ON a.user_id = m.user_id
  JOIN (SELECT user_id, COUNT(DISTINCT restaurant_id) AS locations FROM kept_lines GROUP BY user_id) p ON a.user_id = p.user_id""",
    "si": """SELECT order_id, lineitem_id, app_name, restaurant_id, order_date, order_timestamp, user_id, is_loyalty,
  currency, item_category, item_name, item_price, item_quantity, line_item_revenue FROM typed_items
  WHERE item_category <> 'Test Items' AND item_price < 1000 AND item_quantity < 100 AND line_item_revenue < 2000
  AND user_id NOT IN ('u7', 'u257')""",
    "so": """SELECT ORDER_ID AS order_id, LINEITEM_ID AS lineitem_id, OPTION_GROUP_NAME AS option_group_name,
  OPTION_NAME AS option_name, CAST(OPTION_PRICE AS DECIMAL(10,2)) AS option_price,
  CAST(OPTION_QUANTITY AS INT) AS option_quantity,
  CAST(CAST(OPTION_PRICE AS DECIMAL(10,2)) * CAST(OPTION_QUANTITY AS INT) AS DECIMAL(10,2)) AS option_revenue,
  CAST(OPTION_PRICE AS DECIMAL(10,2)) < 0 AS is_discount FROM landing_options""",
    "sd": """SELECT CAST(strptime(date_key, '%d-%m-%Y') AS DATE) AS date_key, day_of_week,
  CAST(week AS INT) AS week_number, monthname(strptime(date_key, '%d-%m-%Y')) AS month_name,
  CAST(month AS INT) AS month_number, CAST(year AS INT) AS year, CAST(is_weekend AS BOOLEAN) AS is_weekend,
  CAST(is_holiday AS BOOLEAN) AS is_holiday, holiday_name FROM landing_dates""",
    "spine_days": """SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date_key
  FROM (SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM si)""",
    "calendar": """SELECT date_key, dayname(date_key) AS day_of_week, dayofweek(date_key) IN (0, 6) AS is_weekend,
  monthname(date_key) AS month_name, CAST(month(date_key) AS INT) AS month_number,
  CAST(weekofyear(date_key) AS INT) AS week_number, CAST(year(date_key) AS INT) AS year FROM spine_days""",
    "holidays": """SELECT strftime(date_key, '%m-%d') AS month_day, MIN(holiday_name) AS holiday_name FROM sd WHERE is_holiday
  GROUP BY 1""",
    "dim_date": """SELECT c.*, h.holiday_name, h.holiday_name IS NOT NULL AS is_holiday FROM calendar c
  LEFT JOIN holidays h ON strftime(c.date_key, '%m-%d') = h.month_day""",
    "dim_restaurant": """SELECT restaurant_id, app_name FROM (SELECT restaurant_id, app_name, row_number() OVER
  (PARTITION BY restaurant_id ORDER BY COUNT(order_id) DESC, app_name) AS rn
  FROM si GROUP BY restaurant_id, app_name) WHERE rn = 1""",
    "spans": """SELECT user_id, MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date
  FROM si GROUP BY user_id""",
    "loyal": """SELECT user_id, is_loyalty FROM (SELECT user_id, is_loyalty, row_number() OVER (PARTITION BY user_id
  ORDER BY order_timestamp DESC NULLS LAST, order_id DESC NULLS LAST, is_loyalty DESC NULLS LAST) AS rn FROM si)
  WHERE rn = 1""",
    "favourite": """SELECT user_id, restaurant_id AS primary_restaurant_id, app_name AS primary_app FROM
  (SELECT user_id, restaurant_id, app_name, row_number() OVER (PARTITION BY user_id
   ORDER BY COUNT(order_id) DESC, restaurant_id, app_name) AS rn FROM si GROUP BY user_id, restaurant_id, app_name)
  WHERE rn = 1""",
    "dim_customer": """SELECT s.user_id, first_order_date, last_order_date, is_loyalty, primary_restaurant_id,
  primary_app FROM spans s JOIN loyal l ON s.user_id = l.user_id LEFT JOIN favourite f ON s.user_id = f.user_id""",
    "order_lines": f"""SELECT h.order_id, h.user_id, h.restaurant_id, h.order_date AS date_key, h.app_name,
  h.is_loyalty, total_items, gross_revenue, distinct_categories FROM
  (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_timestamp NULLS LAST, user_id NULLS FIRST,
   restaurant_id NULLS FIRST, order_date NULLS FIRST, app_name NULLS FIRST, is_loyalty NULLS FIRST) AS rn
   FROM si) h JOIN
  (SELECT order_id, CAST(SUM(item_quantity) AS BIGINT) AS total_items, {_money('line_item_revenue')} AS gross_revenue,
   COUNT(DISTINCT item_category) AS distinct_categories FROM si GROUP BY order_id) t
  ON h.order_id = t.order_id WHERE rn = 1""",
    "order_options": f"SELECT order_id, {_OPTION_TOTALS} FROM so GROUP BY order_id",
    "order_joined": f"""SELECT l.*, CAST(COALESCE(option_revenue, 0) AS {M}) AS option_revenue,
  CAST(COALESCE(discount_amount, 0) AS {M}) AS discount_amount, COALESCE(discounted, 0) AS discounted
  FROM order_lines l LEFT JOIN order_options o ON l.order_id = o.order_id""",
    "fos": f"""SELECT order_id, user_id, restaurant_id, date_key, app_name, is_loyalty, total_items, gross_revenue,
  distinct_categories, option_revenue, discount_amount,
  CAST(gross_revenue + option_revenue - discount_amount AS {M}) AS net_revenue, discounted = 1 AS has_discount
  FROM order_joined""",
    "line_options": f"SELECT order_id, lineitem_id, {_OPTION_TOTALS} FROM so GROUP BY order_id, lineitem_id",
    "lines": f"""SELECT i.*, CAST(COALESCE(o.option_revenue, 0) AS {M}) AS option_revenue,
  CAST(COALESCE(o.discount_amount, 0) AS {M}) AS discount_amount, COALESCE(o.discounted, 0) AS discounted,
  CAST(i.line_item_revenue + COALESCE(o.option_revenue, 0) - COALESCE(o.discount_amount, 0) AS {M}) AS line_net_revenue
  FROM si i LEFT JOIN line_options o ON i.order_id = o.order_id AND i.lineitem_id = o.lineitem_id""",
    "order_flags": "SELECT order_id, MAX(discounted) AS order_discounted FROM lines GROUP BY order_id",
    "sales_sums": f"""SELECT order_date AS date_key, restaurant_id, item_category,
  COUNT(DISTINCT l.order_id) AS total_orders, CAST(SUM(item_quantity) AS BIGINT) AS total_items_sold,
  {_money('line_item_revenue')} AS gross_revenue, {_money('line_net_revenue')} AS net_revenue,
  {_money('discount_amount')} AS discount_amount,
  COUNT(DISTINCT CASE WHEN order_discounted = 1 THEN l.order_id END) AS discounted_order_count,
  COUNT(DISTINCT CASE WHEN order_discounted = 0 THEN l.order_id END) AS non_discounted_order_count
  FROM lines l LEFT JOIN order_flags f ON l.order_id = f.order_id GROUP BY ALL""",
    "fds": f"""SELECT *, CASE WHEN total_orders > 0 THEN
  CAST(CAST((2 * CAST(net_revenue * 100 AS BIGINT) + total_orders) // (2 * total_orders) AS DECIMAL(15,0))
  * CAST(0.01 AS DECIMAL(3,2)) AS {M}) ELSE CAST(0 AS {M}) END AS avg_order_value FROM sales_sums""",
    "spine": """SELECT user_id, is_loyalty, first_order_date, d.date_key FROM dim_customer
  JOIN dim_date d ON d.date_key >= first_order_date""",
    "activity": f"""SELECT user_id, date_key, COUNT(order_id) AS daily_order_count,
  {_money('gross_revenue')} AS daily_gross_revenue, {_money('net_revenue')} AS daily_net_revenue,
  {_money('discount_amount')} AS daily_discount_amount FROM fos GROUP BY user_id, date_key""",
    "spine_activity": f"""SELECT s.*, COALESCE(daily_order_count, 0) AS daily_order_count,
  CAST(COALESCE(daily_gross_revenue, 0) AS {M}) AS daily_gross_revenue,
  CAST(COALESCE(daily_net_revenue, 0) AS {M}) AS daily_net_revenue,
  CAST(COALESCE(daily_discount_amount, 0) AS {M}) AS daily_discount_amount
  FROM spine s LEFT JOIN activity a ON s.user_id = a.user_id AND s.date_key = a.date_key""",
    "running": f"""SELECT *, CAST(SUM(daily_order_count) OVER w AS INT) AS cumulative_order_count,
  CAST(SUM(daily_net_revenue) OVER w AS {M}) AS cumulative_ltv,
  MAX(CASE WHEN daily_order_count > 0 THEN date_key END) OVER w AS last_order_so_far FROM spine_activity
  WINDOW w AS (PARTITION BY user_id ORDER BY date_key ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "states": """SELECT *, CAST(datediff('day', last_order_so_far, date_key) AS INT) AS days_since_last_order,
  CASE WHEN cumulative_order_count > 1 THEN CAST(CAST(
    (200 * datediff('day', first_order_date, last_order_so_far) + (cumulative_order_count - 1))
    // (2 * (cumulative_order_count - 1)) AS DECIMAL(12,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) END
  AS avg_order_gap_days FROM running""",
    "snap": """SELECT user_id, date_key, is_loyalty, daily_order_count, daily_gross_revenue, daily_net_revenue,
  daily_discount_amount, cumulative_order_count, cumulative_ltv, days_since_last_order, avg_order_gap_days,
  CASE WHEN p >= 0.8 THEN 'High' WHEN p >= 0.2 THEN 'Medium' ELSE 'Low' END AS clv_segment,
  CASE WHEN days_since_last_order <= 30 THEN 'Active' WHEN days_since_last_order <= 90 THEN 'At Risk'
    ELSE 'Churned' END AS churn_risk_flag
  FROM (SELECT *, percent_rank() OVER (PARTITION BY date_key ORDER BY cumulative_ltv) AS p FROM states)""",
    "latest": "SELECT * FROM snap WHERE date_key = (SELECT MAX(date_key) FROM dim_date)",
    "metrics": f"""SELECT user_id, CAST(datediff('day', MAX(date_key), (SELECT MAX(date_key) FROM fos)) AS INT)
  AS recency_days, COUNT(order_id) AS frequency, {_money('net_revenue')} AS monetary,
  (SELECT MAX(date_key) FROM fos) AS date_key FROM fos GROUP BY user_id""",
    "scores": """SELECT *, CAST(6 - ntile(5) OVER (ORDER BY recency_days NULLS FIRST, user_id) AS INT) AS r_score,
  CAST(ntile(5) OVER (ORDER BY frequency NULLS FIRST, user_id) AS INT) AS f_score,
  CAST(ntile(5) OVER (ORDER BY monetary NULLS FIRST, user_id) AS INT) AS m_score FROM metrics""",
    "rfm": """SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'VIP'
  WHEN f_score <= 2 AND r_score >= 4 THEN 'New Customer' WHEN r_score <= 2 AND f_score <= 2 THEN 'Churn Risk'
  ELSE 'Regular' END AS rfm_segment FROM scores""",
    "rfm_loyalty": f"""SELECT r.*, c.is_loyalty, {_label('c.is_loyalty')} AS loyalty_status
  FROM rfm r LEFT JOIN dim_customer c ON r.user_id = c.user_id""",
    "labels_": """SELECT restaurant_id, app_name, app_name || ' (#' || right(restaurant_id, 6) || ')' AS location_label
  FROM dim_restaurant""",
    "sales": """SELECT f.*, location_label, is_holiday, holiday_name, month_name, month_number, year,
  CASE WHEN month_number IN (12, 1, 2) THEN 'Winter' WHEN month_number IN (3, 4, 5) THEN 'Spring'
    WHEN month_number IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
  FROM fds f LEFT JOIN labels_ l ON f.restaurant_id = l.restaurant_id LEFT JOIN dim_date d ON f.date_key = d.date_key""",
    "top_categories": f"""SELECT item_category, {_money('net_revenue')} AS net_revenue FROM sales
  GROUP BY item_category ORDER BY net_revenue DESC, item_category LIMIT 8""",
    "top_locations": f"""SELECT location_label, {_money('net_revenue')} AS net_revenue FROM sales
  GROUP BY location_label ORDER BY net_revenue DESC, location_label LIMIT 5""",
    "buyers": f"""SELECT t.*, c.is_loyalty, {_label('c.is_loyalty')} AS loyalty_status, total_orders > 1 AS is_repeat
  FROM (SELECT user_id, COUNT(order_id) AS total_orders, {_money('net_revenue')} AS total_revenue,
    {_mean('net_revenue')} AS avg_order_value FROM fos GROUP BY user_id) t
  LEFT JOIN dim_customer c ON t.user_id = c.user_id""",
    "located": """SELECT f.*, location_label FROM fos f LEFT JOIN labels_ l ON f.restaurant_id = l.restaurant_id""",
    "loc_totals": f"""SELECT location_label, {_money('net_revenue')} AS total_revenue, COUNT(order_id) AS total_orders,
  COUNT(DISTINCT user_id) AS unique_customers, {_mean('net_revenue')} AS avg_order_value
  FROM located GROUP BY location_label""",
    "loc_retention": f"""SELECT location_label, COUNT(*) AS total_customers,
  {_count_if('n > 1')} AS repeat_customers, {_pct1(_count_if('n > 1'), 'COUNT(*)')} AS retention_rate
  FROM (SELECT location_label, user_id, COUNT(*) AS n FROM located GROUP BY location_label, user_id)
  GROUP BY location_label""",
    "ranking": """SELECT t.*, retention_rate FROM loc_totals t
  LEFT JOIN loc_retention r ON t.location_label = r.location_label""",
    "typed_orders": """SELECT *, CASE WHEN option_revenue > 0 THEN 'With Paid Add-ons' ELSE 'Base Order Only' END
  AS order_type FROM fos""",
}

_WORD = re.compile(r"[a-z_]+")


def statement(final: str) -> str:
    """``final`` with the building blocks it needs, in order."""
    needed, todo = set(), [final]
    while todo:
        for word in set(_WORD.findall(todo.pop())):
            if word in BLOCKS and word not in needed:
                needed.add(word)
                todo.append(BLOCKS[word])
    ctes = ",\n".join(f"{name} AS ({BLOCKS[name]})" for name in BLOCKS if name in needed)
    return f"WITH {ctes}\n{final}" if ctes else final


def _seasonal(keys: str, source: str) -> str:
    return f"""SELECT {keys}, {_money('net_revenue')} AS total_revenue, COUNT(DISTINCT date_key) AS days,
  CAST(SUM(net_revenue) AS DOUBLE) / CAST(COUNT(DISTINCT date_key) AS DOUBLE) AS avg_daily_revenue
  FROM {source} GROUP BY {keys}"""


def _percentile(value: str, of: str, num: int, den: int, by: str) -> str:
    """Exact linear percentile of positive ``value`` per ``by`` as DECIMAL(18,4)."""
    ranked = f"""SELECT {by} AS k, {value} AS v, row_number() OVER (PARTITION BY {by} ORDER BY {value}) - 1 AS i,
      COUNT(*) OVER (PARTITION BY {by}) - 1 AS m FROM {of}"""
    lo = f"MAX(CASE WHEN i = ({num} * m) // {den} THEN CAST(v * 100 AS BIGINT) END)"
    hi = f"MAX(CASE WHEN i = LEAST(({num} * m) // {den} + 1, m) THEN CAST(v * 100 AS BIGINT) END)"
    return f"""SELECT k, CAST(CAST(({lo}) * 100 + (({hi}) - ({lo})) * ANY_VALUE(({num} * m) % {den}) * {100 // den}
      AS DECIMAL(18,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(18,4)) AS p FROM ({ranked}) GROUP BY k"""


def _check(name: str, table: str, measured: str, expected: str, source: str, passed: str | None = None) -> str:
    """One check row; ``source`` computes one row that the expressions read."""
    passed = passed or f"CAST({measured} AS BIGINT) = CAST({expected} AS BIGINT)"
    return (
        f"SELECT '{name}' AS check_name, '{table}' AS table_name, {passed} AS passed, "
        f"CAST({measured} AS BIGINT) AS measured, CAST({expected} AS BIGINT) AS expected FROM {source}"
    )


def _checks(*rows: str) -> str:
    return "\nUNION ALL ".join(rows)


_BOX = "(SELECT * FROM buyers WHERE total_revenue > 0 AND loyalty_status IS NOT NULL)"
_OPTION_SUMS = "order_id, option_revenue, discount_amount, discounted"
_TIME = "epoch_ms(order_timestamp) AS order_timestamp_ms"
_NOT_TIME = "* EXCLUDE (order_timestamp)"

FINAL = {
    "b6_incremental_landing": "SELECT *, '2024-03-01T00:00:00+00:00' AS ingestion_timestamp FROM landing_options",
    "v10_account_activity": "SELECT * FROM account_activity WHERE user_id NOT IN ('u7', 'u257')",
    "v10_rapid_lines": """SELECT restaurant_id, COUNT(*) AS lines FROM kept_lines WHERE user_id NOT IN (SELECT user_id FROM
  account_activity WHERE orders >= 2 AND (quick_share >= 0.5 OR most_a_day >= 2) AND locations >= 2 AND user_id <> 'GUEST')
  GROUP BY restaurant_id""",
    "s1_quoted_csv": f"SELECT * EXCLUDE (PRINTED_CARD_NUMBER) REPLACE ({X.QUOTED_NAME} AS ITEM_NAME) FROM landing_items",
    "s1_csv_scan": "SELECT * EXCLUDE (PRINTED_CARD_NUMBER) FROM landing_items",
    "s2_parquet_scan": "SELECT * FROM landing_options",
    "s4_layer_scan": "SELECT * FROM so",
    "s5_sink_roundtrip": "SELECT * FROM fos",
    "s8_latest_date": "SELECT MAX(date_key) AS date_key FROM snap",
    "s9_latest_snapshot": "SELECT * FROM latest",
    "b1_ingest_stamp": "SELECT ORDER_ID, LINEITEM_ID, OPTION_NAME, OPTION_PRICE,"
    " '2024-03-01T00:00:00+00:00' AS ingestion_timestamp FROM landing_options",
    "b2_partition_key": "SELECT ORDER_ID, LINEITEM_ID, CREATION_TIME_UTC,"
    " substr(CREATION_TIME_UTC, 1, 10) AS order_date_partition FROM landing_items",
    "b3_bronze_items": "SELECT * EXCLUDE (PRINTED_CARD_NUMBER), '2024-03-01T00:00:00+00:00' AS ingestion_timestamp,"
    " substr(CREATION_TIME_UTC, 1, 10) AS order_date_partition FROM landing_items",
    "b4_bronze_options": "SELECT *, '2024-03-01T00:00:00+00:00' AS ingestion_timestamp FROM landing_options",
    "b5_bronze_dates": "SELECT * EXCLUDE (year), CAST(year AS INT) AS year,"
    " '2024-03-01T00:00:00+00:00' AS ingestion_timestamp FROM landing_dates",
    "v1_rename": "SELECT "
    + ", ".join(f"{n} AS {n.lower()}" for n in X.ITEM_COLUMNS if n != "PRINTED_CARD_NUMBER")
    + " FROM landing_items",
    "v2_order_ts": f"SELECT order_id, lineitem_id, {_TIME} FROM typed_items",
    "v3_order_date": "SELECT order_id, lineitem_id, order_date FROM typed_items",
    "v4_guest_backfill": "SELECT order_id, lineitem_id, user_id FROM typed_items",
    "v5_typed_items": "SELECT order_id, lineitem_id, item_price, item_quantity, is_loyalty FROM typed_items",
    "v6_line_revenue": "SELECT order_id, lineitem_id, line_item_revenue FROM typed_items",
    "v7_category_repair": "SELECT raw_category, item_category, COUNT(*) AS lines FROM typed_items GROUP BY ALL",
    "v8_test_item_filter": "SELECT order_id, lineitem_id, item_category FROM typed_items"
    " WHERE item_category <> 'Test Items'",
    "v9_outlier_filter": "SELECT order_id, lineitem_id, item_price, item_quantity, line_item_revenue FROM typed_items"
    " WHERE item_price < 1000 AND item_quantity < 100 AND line_item_revenue < 2000",
    "v10_denylist": "SELECT order_id, lineitem_id, user_id FROM typed_items WHERE user_id NOT IN ('u7', 'u257')",
    "v11_silver_partition": "SELECT order_id, lineitem_id, CAST(order_date AS STRING) AS order_date_partition"
    " FROM typed_items",
    "v12_typed_options": "SELECT order_id, lineitem_id, option_name, option_price, option_quantity FROM so",
    "v13_option_revenue": "SELECT order_id, lineitem_id, option_name, option_revenue FROM so",
    "v14_is_discount": "SELECT order_id, lineitem_id, option_name, is_discount FROM so",
    "v15_date_typing": "SELECT * FROM sd",
    "v17_silver_items": f"SELECT {_NOT_TIME}, {_TIME}, CAST(order_date AS STRING) AS order_date_partition FROM si",
    "v17_silver_options": "SELECT * FROM so",
    "d1_date_bounds": "SELECT MIN(order_date) AS first_date, MAX(order_date) AS last_date FROM si",
    "d2_date_spine": "SELECT * FROM spine_days",
    "d3_calendar": "SELECT * FROM calendar",
    "d4_holidays": "SELECT * FROM holidays",
    "d5_dim_date": "SELECT * FROM dim_date",
    "d6_dim_restaurant": "SELECT * FROM dim_restaurant",
    "d7_customer_span": "SELECT * FROM spans",
    "d8_latest_loyalty": "SELECT * FROM loyal",
    "d9_primary_restaurant": "SELECT * FROM favourite",
    "d10_dim_customer": "SELECT * FROM dim_customer",
    "d11_merged_customers": "SELECT * FROM dim_customer",
    "o1_items_per_order": "SELECT * FROM order_lines",
    "o2_options_per_order": f"SELECT {_OPTION_SUMS} FROM order_options",
    "o3_order_join": f"SELECT {_OPTION_SUMS}, gross_revenue FROM order_joined",
    "o4_order_summary": "SELECT * FROM fos",
    "a1_options_per_line": f"SELECT lineitem_id, {_OPTION_SUMS} FROM line_options",
    "a2_line_join": f"SELECT lineitem_id, line_item_revenue, {_OPTION_SUMS} FROM lines",
    "a3_line_net": "SELECT order_id, lineitem_id, line_net_revenue FROM lines",
    "a4_order_discount": "SELECT DISTINCT l.order_id, order_date AS date_key, restaurant_id, item_category,"
    " CAST(order_discounted AS INT) AS order_discounted FROM lines l JOIN order_flags f ON l.order_id = f.order_id",
    "a5_daily_sales": "SELECT * FROM sales_sums",
    "a6_daily_sales_fact": "SELECT * FROM fds",
    "c1_global_max": "SELECT MAX(date_key) AS last_day FROM dim_date",
    "c2_customer_spine": "SELECT user_id, COUNT(*) AS days, MIN(date_key) AS first_day, MAX(date_key) AS last_day"
    " FROM spine GROUP BY user_id",
    "c3_daily_activity": "SELECT * FROM activity",
    "c4_spine_activity": "SELECT date_key, COUNT(*) AS customers, CAST(SUM(daily_order_count) AS BIGINT) AS orders,"
    f" {_money('daily_gross_revenue')} AS gross, {_money('daily_net_revenue')} AS net,"
    f" {_money('daily_discount_amount')} AS discount FROM spine_activity GROUP BY date_key",
    "c5_cumulative_ltv": "SELECT user_id, CAST(SUM(cumulative_order_count) AS BIGINT) AS sum_orders,"
    f" MAX(cumulative_order_count) AS max_orders, {_money('cumulative_ltv')} AS sum_ltv,"
    " MIN(cumulative_ltv) AS min_ltv, MAX(cumulative_ltv) AS max_ltv FROM running GROUP BY user_id",
    "c6_last_order_so_far": "SELECT user_id, COUNT(*) AS days, COUNT(DISTINCT last_order_so_far) AS order_days,"
    " MIN(last_order_so_far) AS first_seen, MAX(last_order_so_far) AS last_seen FROM running GROUP BY user_id",
    "c7_days_since": "SELECT user_id, CAST(SUM(days_since_last_order) AS BIGINT) AS sum_days,"
    " MAX(days_since_last_order) AS max_days FROM states GROUP BY user_id",
    "c8_avg_gap": f"SELECT user_id, COUNT(avg_order_gap_days) AS days_with_gap, {_money('avg_order_gap_days')} AS sum_gap"
    " FROM states GROUP BY user_id",
    "c9_clv_segment": "SELECT date_key, clv_segment, COUNT(*) AS customers, MIN(cumulative_ltv) AS min_ltv,"
    f" MAX(cumulative_ltv) AS max_ltv, {_money('cumulative_ltv')} AS sum_ltv FROM snap GROUP BY date_key, clv_segment",
    "c10_churn_flag": "SELECT date_key, churn_risk_flag, COUNT(*) AS customers,"
    " MIN(days_since_last_order) AS min_days, MAX(days_since_last_order) AS max_days"
    " FROM snap GROUP BY date_key, churn_risk_flag",
    "c12_snapshot_digest": "SELECT user_id, COUNT(*) AS days, CAST(SUM(CAST('0x' || substr(md5(concat_ws('|', "
    + ", ".join(f"COALESCE(CAST({c} AS VARCHAR), '')" for c in X.SNAPSHOT_TEXT)
    + ")), 1, 8) AS BIGINT)) AS BIGINT) AS digest FROM snap GROUP BY user_id",
    "c11_snapshot": "SELECT user_id, last_day(date_key) AS month_end, COUNT(*) AS days,"
    f" {_count_if('is_loyalty')} AS loyal_days, CAST(SUM(daily_order_count) AS BIGINT) AS orders,"
    f" {_money('daily_gross_revenue')} AS gross, {_money('daily_net_revenue')} AS net,"
    f" {_money('daily_discount_amount')} AS discount, MAX(cumulative_order_count) AS lifetime_orders,"
    " MAX(cumulative_ltv) AS lifetime_value, CAST(SUM(days_since_last_order) AS BIGINT) AS sum_days_since,"
    f" {_money('avg_order_gap_days')} AS sum_gap, "
    + ", ".join(
        f"{_count_if(f'{column} = {chr(39)}{value}{chr(39)}')} AS days_{value.lower().replace(' ', '_')}"
        for column, values in {
            "clv_segment": ("High", "Medium", "Low"), "churn_risk_flag": ("Active", "At Risk", "Churned")
        }.items()
        for value in values
    )
    + " FROM snap GROUP BY user_id, month_end",
    "r1_reference_date": "SELECT MAX(date_key) AS date_key FROM fos",
    "r2_rfm_metrics": "SELECT * FROM metrics",
    "r3_r_score": "SELECT user_id, r_score FROM scores",
    "r4_f_score": "SELECT user_id, f_score FROM scores",
    "r5_m_score": "SELECT user_id, m_score FROM scores",
    "r6_rfm": "SELECT * FROM rfm",
    "l1_location_label": "SELECT * FROM labels_",
    "l2_normalize": f"SELECT user_id, daily_net_revenue, cumulative_ltv,"
    " CAST(COALESCE(avg_order_gap_days, 0) AS DECIMAL(10,2)) AS avg_order_gap_days FROM latest",
    "g1_rfm_loyalty": "SELECT * FROM rfm_loyalty",
    "g3_rfm_sample": "SELECT *, CAST(1 AS DOUBLE) / (recency_days + 1) AS bubble_size FROM rfm_loyalty"
    " ORDER BY md5(user_id || '-42'), user_id LIMIT 500",
    "g2_segment_kpis": f"SELECT COUNT(*) AS total_customers,"
    f" {_share(_count_if('rfm_segment = ' + chr(39) + 'VIP' + chr(39)), 'COUNT(*)')} AS vip_pct,"
    f" {_share(_count_if('is_loyalty'), 'COUNT(*)')} AS loyalty_pct,"
    f" {_share(_count_if('rfm_segment = ' + chr(39) + 'Churn Risk' + chr(39)), 'COUNT(*)')} AS churn_risk_pct"
    " FROM rfm_loyalty",
    "g4_segment_counts": "SELECT rfm_segment, COUNT(*) AS customers FROM rfm_loyalty GROUP BY rfm_segment",
    "g5_segment_loyalty": "SELECT rfm_segment, loyalty_status, COUNT(*) AS customers FROM rfm_loyalty"
    " WHERE loyalty_status IS NOT NULL GROUP BY rfm_segment, loyalty_status",
    "g6_segment_profile": f"SELECT rfm_segment, COUNT(user_id) AS customers, {_mean('recency_days')} AS avg_recency_days,"
    f" {_mean('frequency')} AS avg_frequency, {_mean('monetary')} AS avg_monetary,"
    f" {_share(_count_if('is_loyalty'), 'COUNT(is_loyalty)')} AS loyalty_rate_pct FROM rfm_loyalty GROUP BY rfm_segment",
    "h1_latest_snapshot": "SELECT * FROM latest",
    "h2_churn_kpis": "SELECT COUNT(*) AS total_customers, "
    + ", ".join(
        f"{_count_if(f'churn_risk_flag = {chr(39)}{flag}{chr(39)}')} AS {name},"
        f" {_share(_count_if(f'churn_risk_flag = {chr(39)}{flag}{chr(39)}'), 'COUNT(*)')} AS {name}_pct"
        for flag, name in {"Active": "active", "At Risk": "at_risk", "Churned": "churned"}.items()
    )
    + " FROM latest",
    "h3_churn_counts": "SELECT churn_risk_flag, COUNT(*) AS customers FROM latest GROUP BY churn_risk_flag",
    "h4_inactivity_hist": "SELECT churn_risk_flag, CAST(FLOOR(CAST(days_since_last_order AS DOUBLE) / 30.0) AS BIGINT)"
    " AS bin, COUNT(*) AS rows_in_bin FROM latest WHERE days_since_last_order IS NOT NULL GROUP BY ALL",
    "h5_gap_by_status": f"SELECT churn_risk_flag, {_mean('COALESCE(avg_order_gap_days, 0)')} AS avg_order_gap_days,"
    f" {_mean('avg_order_gap_days')} AS avg_gap_known FROM latest GROUP BY churn_risk_flag",
    "h6_ltv_by_status": f"SELECT churn_risk_flag, {_mean('cumulative_ltv')} AS avg_ltv FROM latest"
    " GROUP BY churn_risk_flag",
    "h7_at_risk_top50": "SELECT user_id, days_since_last_order, cumulative_order_count, cumulative_ltv,"
    " CAST(COALESCE(avg_order_gap_days, 0) AS DECIMAL(10,2)) AS avg_order_gap_days, is_loyalty, clv_segment FROM latest"
    " WHERE churn_risk_flag = 'At Risk' ORDER BY cumulative_ltv DESC, user_id LIMIT 50",
    "t1_enriched_sales": "SELECT * EXCLUDE (season) FROM sales",
    "t2_season": "SELECT month_number, season, COUNT(*) AS sales_rows FROM sales GROUP BY month_number, season",
    "t3_date_range": "SELECT date_key, restaurant_id, item_category, net_revenue FROM sales"
    " WHERE date_key BETWEEN DATE '1996-01-01' AND DATE '2000-06-30'",
    "t4_top_categories": "SELECT * FROM top_categories",
    "t5_top_locations": "SELECT * FROM top_locations",
    "t6_sales_kpis": f"SELECT {_money('net_revenue')} AS total_revenue, CAST(SUM(total_orders) AS BIGINT) AS total_orders,"
    " CAST(SUM(net_revenue) AS DOUBLE) / CAST(SUM(total_orders) AS DOUBLE) AS avg_order_value FROM sales",
    "t7_monthly_category": f"SELECT last_day(date_key) AS month_end, item_category, {_money('net_revenue')} AS net_revenue"
    " FROM sales WHERE item_category IN (SELECT item_category FROM top_categories) GROUP BY ALL",
    "t8_monthly_location": f"SELECT last_day(date_key) AS month_end, location_label, {_money('net_revenue')}"
    " AS net_revenue FROM sales WHERE location_label IN (SELECT location_label FROM top_locations) GROUP BY ALL",
    "t9_season_category": _seasonal(
        "season, item_category", "(SELECT * FROM sales WHERE item_category IN (SELECT item_category FROM top_categories))"
    ),
    "t10_season_location": _seasonal(
        "season, location_label",
        "(SELECT * FROM sales WHERE location_label IN (SELECT location_label FROM sales GROUP BY location_label"
        " ORDER BY SUM(net_revenue) DESC, location_label LIMIT 10))",
    ),
    "t11_holiday_effect": f"SELECT is_holiday, CASE WHEN is_holiday THEN 'Holiday' ELSE 'Non-Holiday' END AS label,"
    f" {_mean('revenue')} AS avg_daily_revenue FROM (SELECT date_key, is_holiday, SUM(net_revenue) AS revenue FROM sales"
    " GROUP BY date_key, is_holiday) GROUP BY is_holiday",
    "t12_season_total": _seasonal("season", "sales"),
    "y1_customer_orders": "SELECT * FROM buyers",
    "y2_loyalty_kpis": f"SELECT loyalty_status, {_mean('total_revenue')} AS avg_clv,"
    " CAST(CAST(SUM(CAST(avg_order_value AS DECIMAL(28,8))) AS DOUBLE) / COUNT(avg_order_value) AS DECIMAL(18,4)) AS avg_order_value,"
    f" {_share(_count_if('is_repeat'), 'COUNT(*)')} AS repeat_rate_pct FROM buyers WHERE loyalty_status IS NOT NULL"
    " GROUP BY loyalty_status",
    "y3_clv_hist": "SELECT loyalty_status, LEAST((CAST(total_revenue * 100 AS BIGINT) * 5000)"
    " // CAST(p * 10000 AS BIGINT), 49) AS bin, p AS cap, COUNT(*) AS customers FROM buyers, ("
    + _percentile("total_revenue", "buyers WHERE total_revenue > 0", 95, 100, "1")
    + ") WHERE total_revenue > 0 AND total_revenue <= p AND loyalty_status IS NOT NULL GROUP BY ALL",
    "y4_repeat_rate": f"SELECT loyalty_status, COUNT(user_id) AS total_customers,"
    f" {_count_if('is_repeat')} AS repeat_customers, {_share(_count_if('is_repeat'), 'COUNT(user_id)')} AS repeat_rate_pct"
    " FROM buyers WHERE loyalty_status IS NOT NULL GROUP BY loyalty_status",
    "y5_box_stats": "SELECT loyalty_status, customers, q1, median, q3,"
    " MIN(CASE WHEN inside THEN total_revenue END) AS whisker_low,"
    " MAX(CASE WHEN inside THEN total_revenue END) AS whisker_high,"
    f" {_count_if('NOT inside')} AS outliers FROM (SELECT b.*, a.p AS q1, m.p AS median, c.p AS q3,"
    " COUNT(*) OVER (PARTITION BY loyalty_status) AS customers,"
    " total_revenue BETWEEN a.p - (c.p - a.p) * 1.5 AND c.p + (c.p - a.p) * 1.5 AS inside"
    f" FROM {_BOX} b JOIN ({_percentile('total_revenue', _BOX, 1, 4, 'loyalty_status')}) a ON loyalty_status = a.k"
    f" JOIN ({_percentile('total_revenue', _BOX, 2, 4, 'loyalty_status')}) m ON loyalty_status = m.k"
    f" JOIN ({_percentile('total_revenue', _BOX, 3, 4, 'loyalty_status')}) c ON loyalty_status = c.k) GROUP BY ALL",
    "y6_monthly_loyalty": f"SELECT last_day(date_key) AS month_end, {_label('is_loyalty')} AS loyalty_status,"
    f" {_money('net_revenue')} AS net_revenue FROM fos WHERE is_loyalty IS NOT NULL GROUP BY ALL",
    "n1_orders_location": "SELECT order_id, restaurant_id, location_label FROM located",
    "n2_location_totals": "SELECT * FROM loc_totals",
    "n3_retention": "SELECT * FROM loc_retention",
    "n4_location_ranking": "SELECT * FROM ranking",
    "n7_ranking_table": "SELECT * REPLACE (CAST(avg_order_value AS DECIMAL(18,2)) AS avg_order_value),"
    " CAST(row_number() OVER (ORDER BY total_revenue DESC, location_label) AS INTEGER) AS rank FROM ranking",
    "n5_location_kpis": "SELECT COUNT(*) AS locations, MAX(total_revenue) AS highest_revenue,"
    " CAST(AVG(CAST(retention_rate AS DOUBLE)) AS DECIMAL(18,4)) AS avg_retention_rate FROM ranking",
    "n6_location_trend": f"SELECT last_day(date_key) AS month_end, location_label, {_money('net_revenue')} AS net_revenue"
    " FROM sales WHERE location_label IN (SELECT location_label FROM ranking ORDER BY total_revenue DESC, location_label"
    " LIMIT 3) GROUP BY ALL",
    "x1_order_type": "SELECT order_id, option_revenue, order_type FROM typed_orders",
    "x2_type_agg": "SELECT order_type, COUNT(order_id) AS order_count, "
    + ", ".join(
        f"{_money(column)} AS total_{name}, {_mean(column)} AS avg_{name}"
        for name, column in {"gross": "gross_revenue", "net": "net_revenue", "option_rev": "option_revenue"}.items()
    )
    + " FROM typed_orders GROUP BY order_type",
    "x3_composition": f"SELECT CAST(SUM(gross_revenue) - SUM(option_revenue) AS {M}) AS base_item_revenue,"
    f" {_money('option_revenue')} AS add_on_revenue, {_money('gross_revenue')} AS total_gross FROM fos",
    "x4_addon_rate": f"SELECT m.month_end, COALESCE(n, 0) AS total_orders, COALESCE(a, 0) AS addon_orders,"
    f" {_pct1('COALESCE(a, 0)', 'COALESCE(n, 0)')} AS addon_rate FROM (SELECT last_day(CAST(unnest(generate_series("
    "date_trunc('month', lo), date_trunc('month', hi), INTERVAL 1 MONTH)) AS DATE)) AS month_end"
    " FROM (SELECT MIN(date_key) AS lo, MAX(date_key) AS hi FROM fos)) m LEFT JOIN (SELECT last_day(date_key) AS month_end,"
    f" COUNT(order_id) AS n, {_count_if('option_revenue > 0')} AS a FROM fos GROUP BY 1) c ON m.month_end = c.month_end",
    "x5_volume_split": "SELECT order_type, COUNT(*) AS orders FROM typed_orders GROUP BY order_type",
    "x6_addon_insights": f"SELECT {_mean('paid')} AS avg_addon_revenue, {_money('paid')} AS total_addon_revenue,"
    f" {_share('SUM(paid)', 'SUM(gross_revenue)')} AS addon_pct_of_gross"
    " FROM (SELECT gross_revenue, CASE WHEN option_revenue > 0 THEN option_revenue END AS paid FROM fos)",
    "q1_row_count": _checks(
        _check("row_count", "gold.dim_restaurant", "COUNT(*)", "28", "dim_restaurant"),
        _check("same_count", "bronze.order_items", "a", "b",
               "(SELECT (SELECT COUNT(*) FROM landing_items) AS a, (SELECT COUNT(*) FROM lineitem) AS b)"),
    ),
    "q2_layer_counts": _checks(
        _check("same_count", "silver.order_items", "a", "b",
               "(SELECT (SELECT COUNT(*) FROM si) AS a, (SELECT COUNT(*) FROM landing_items) AS b)"),
        _check("same_count", "silver.order_item_options", "a", "b",
               "(SELECT (SELECT COUNT(*) FROM so) AS a, (SELECT COUNT(*) FROM landing_options) AS b)"),
    ),
    "q3_not_null": _checks(
        *[
            _check(f"not_null:{c}", t, f"COUNT(*) - COUNT({c})", "0", source)
            for t, source, columns in [
                ("silver.order_items", "si", ("user_id", "line_item_revenue", "item_price", "item_quantity")),
                ("silver.order_item_options", "so", ("option_price", "option_quantity")),
                ("gold.fct_order_summary", "fos",
                 ("gross_revenue", "net_revenue", "option_revenue", "discount_amount")),
                ("gold.dim_customer", "dim_customer", ("first_order_date", "last_order_date")),
            ]
            for c in columns
        ]
    ),
    "q4_null_bound": _check("null_bound:LINEITEM_ID", "bronze.order_items", "COUNT(*) - COUNT(LINEITEM_ID)", "100",
                            "landing_items", "COUNT(*) - COUNT(LINEITEM_ID) < 100"),
    "q5_value_count": _check("value_count:user_id", "silver.order_items", _count_if("user_id = 'GUEST'"), _count_if("user_id = 'GUEST'"), "si"),
    "q6_types": _checks(
        *[
            _check(f"has_type:{c}", t, "0", "0", f"(SELECT COUNT(*) FROM {source})")
            for t, source, columns in [
                ("silver.order_items", "si", ("is_loyalty", "item_price", "order_date")),
                ("silver.date_dim", "sd", ("is_weekend", "is_holiday")),
            ]
            for c in columns
        ]
    ),
    "q7_formula": _checks(
        _check("formula:line_item_revenue", "silver.order_items",
               _count_if("ABS(line_item_revenue - item_price * item_quantity) > 0.01"), "0", "si"),
        _check("formula:option_revenue", "silver.order_item_options",
               _count_if("ABS(option_revenue - option_price * option_quantity) > 0.01"), "0", "so"),
        _check("formula:net_revenue", "gold.fct_order_summary",
               _count_if("ABS(net_revenue - (gross_revenue + option_revenue - discount_amount)) > 0.01"), "0", "fos"),
    ),
    "q8_flag": _check("flag_matches:is_discount", "silver.order_item_options",
                      _count_if("is_discount IS DISTINCT FROM (option_price < 0)"), "0", "so"),
    "q9_unique": _checks(
        *[
            _check(f"unique:{key}", t, "COUNT(*)", "0",
                   f"(SELECT 1 FROM {source} GROUP BY {key.replace('+', ', ')} HAVING COUNT(*) > 1)")
            for t, source, key in [
                ("gold.dim_customer", "dim_customer", "user_id"),
                ("gold.dim_restaurant", "dim_restaurant", "restaurant_id"),
                ("gold.dim_date", "dim_date", "date_key"),
                ("gold.fct_order_summary", "fos", "order_id"),
                ("gold.fct_customer_rfm", "rfm", "user_id"),
                ("silver.order_items", "si", "order_id+lineitem_id"),
            ]
        ]
    ),
    "q10_coverage": _check(
        "covers", "gold.dim_date", "CAST(c0 > f0 AS INT) + CAST(c1 < f1 AS INT)", "0",
        "(SELECT MIN(date_key) AS c0, MAX(date_key) AS c1 FROM dim_date),"
        " (SELECT MIN(order_date) AS f0, MAX(order_date) AS f1 FROM si)",
    ),
    "q11_orphans": _checks(
        *[
            _check(f"no_orphans:{key}", "gold.fct_order_summary", "COUNT(*)", "0",
                   f"(SELECT DISTINCT {key} FROM fos WHERE {key} NOT IN (SELECT {key} FROM {dim}))")
            for key, dim in [("user_id", "dim_customer"), ("restaurant_id", "dim_restaurant")]
        ]
    ),
    "q12_grain": _checks(
        _check("same_distinct:order_id", "gold.fct_order_summary", "a", "b",
               "(SELECT (SELECT COUNT(*) FROM fos) AS a, (SELECT COUNT(DISTINCT order_id) FROM si) AS b)"),
        _check("same_distinct:user_id", "gold.fct_customer_rfm", "a", "b",
               "(SELECT (SELECT COUNT(*) FROM rfm) AS a, (SELECT COUNT(DISTINCT user_id) FROM dim_customer) AS b)"),
    ),
    "q13_domain": _checks(
        _check("in_domain:clv_segment", "gold.fct_customer_daily_snapshot",
               _count_if("clv_segment NOT IN ('High', 'Medium', 'Low')"), "0", "snap"),
        _check("in_domain:churn_risk_flag", "gold.fct_customer_daily_snapshot",
               _count_if("churn_risk_flag NOT IN ('Active', 'At Risk', 'Churned')"), "0", "snap"),
        _check("in_domain:rfm_segment", "gold.fct_customer_rfm",
               _count_if("rfm_segment NOT IN ('VIP', 'New Customer', 'Churn Risk', 'Regular')"), "0", "rfm"),
    ),
    "q14_range": _checks(
        *[
            _check(f"in_range:{c}", "gold.fct_customer_rfm", _count_if(f"{c} < 1 OR {c} > 5"), "0", "rfm")
            for c in ("r_score", "f_score", "m_score")
        ]
    ),
    "q15_monotonic": _check(
        "non_decreasing:cumulative_ltv", "gold.fct_customer_daily_snapshot", _count_if("step < -0.01"), "0",
        "(SELECT cumulative_ltv - LAG(cumulative_ltv) OVER (PARTITION BY user_id ORDER BY date_key) AS step FROM snap)",
    ),
}

FINAL["c13_rolled_forward"] = FINAL["c12_snapshot_digest"]

STATEMENTS = {key: statement(final) for key, final in FINAL.items()}
