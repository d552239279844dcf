"""The registered queries as DuckDB SQL over the same tables.

Written apart from the Spark code: repeated rows by UNION ALL, the surviving copy by row_number, the
funnel stage by a window, money by DECIMAL. Each text is the shared WITH list plus one SELECT; DuckDB
runs only the parts a SELECT refers to.
"""

from __future__ import annotations

_WITH = """
WITH products AS (
  SELECT p_partkey,
         CASE p_size % 4
           WHEN 0 THEN NULL
           WHEN 1 THEN lower(p_type)
           WHEN 2 THEN lower(p_type) || '.' || split_part(p_name, ' ', 2)
           ELSE lower(p_type) || '.' || split_part(p_name, ' ', 2) || '.' || split_part(p_name, ' ', 1)
         END AS category_code,
         CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_brand END AS brand
  FROM part
),
arrived AS (
  SELECT e.ts AS event_time,
         CASE e.event_type WHEN 'purchase' THEN 'purchase' WHEN 'click' THEN 'cart' ELSE 'view' END
           AS event_type,
         e.k AS product_id,
         e.k % 13 AS category_id,
         p.category_code,
         p.brand,
         CASE WHEN e.event_id % 97 = 0 THEN 0.0::DOUBLE
              WHEN e.event_id % 101 = 0 THEN NULL
              ELSE e.value END AS price,
         e.user_id,
         e.user_id::VARCHAR || '-' || e.ts::DATE::VARCHAR || '-'
           || (hour(e.ts) // 6)::INTEGER::VARCHAR AS user_session,
         e.event_id
  FROM (SELECT *, json_extract_string(props, '$.k')::BIGINT AS k FROM events) e
  JOIN products p ON p.p_partkey = e.k
),
raw AS (
  SELECT * EXCLUDE (event_id) FROM arrived
  UNION ALL
  SELECT * EXCLUDE (event_id) FROM arrived WHERE event_id % 50 = 0
),
valid AS (SELECT * FROM raw WHERE price > 0),
filled AS (
  SELECT * REPLACE (coalesce(brand, 'Unknown') AS brand,
                    coalesce(category_code, 'Unknown') AS category_code)
  FROM valid
),
clean AS (
  SELECT * FROM filled
  QUALIFY row_number() OVER (
    PARTITION BY user_id, product_id, event_type, event_time
    ORDER BY user_session NULLS LAST, price NULLS LAST, category_code NULLS LAST,
             brand NULLS LAST, category_id NULLS LAST) = 1
),
timed AS (
  SELECT *,
         hour(event_time)::INTEGER AS hour,
         (dayofweek(event_time) + 1)::INTEGER AS day_of_week,
         dayofweek(event_time) IN (0, 6) AS is_weekend,
         CASE WHEN hour(event_time) >= 6 AND hour(event_time) < 12 THEN 'morning'
              WHEN hour(event_time) >= 12 AND hour(event_time) < 18 THEN 'afternoon'
              WHEN hour(event_time) >= 18 AND hour(event_time) < 22 THEN 'evening'
              ELSE 'night' END AS time_of_day
  FROM clean
),
leveled AS (
  SELECT *,
         string_split(category_code, '.')[1] AS category_l1,
         string_split(category_code, '.')[2] AS category_l2,
         string_split(category_code, '.')[3] AS category_l3
  FROM timed
),
staged AS (
  SELECT *,
         CASE max(CASE event_type WHEN 'purchase' THEN 2 WHEN 'cart' THEN 1 ELSE 0 END)
                OVER (PARTITION BY user_id, product_id)
           WHEN 2 THEN 'purchased' WHEN 1 THEN 'added_to_cart' ELSE 'viewed_only' END
           AS conversion_stage
  FROM leveled
),
silver AS (
  SELECT *,
         year(event_time)::INTEGER AS year,
         month(event_time)::INTEGER AS month,
         day(event_time)::INTEGER AS day
  FROM staged
),
daily_base AS (
  SELECT event_time::DATE AS date, {measures}
  FROM silver GROUP BY 1
),
daily AS (
  SELECT date,
         year(date)::INTEGER AS year, month(date)::INTEGER AS month, day(date)::INTEGER AS day,
         (dayofweek(date) + 1)::INTEGER AS day_of_week,
         dayofweek(date) IN (0, 6) AS is_weekend,
         total_events, unique_users, unique_sessions, unique_products,
         total_views, total_carts, total_purchases, total_revenue, avg_price,
         {ratios}, {purchases_per_user} AS purchases_per_user,
         {cart_to_purchase} AS cart_to_purchase_rate
  FROM daily_base
),
hourly_base AS (
  SELECT event_time::DATE AS date, hour(event_time)::INTEGER AS hour, {measures}
  FROM silver GROUP BY 1, 2
),
hourly AS (
  SELECT date,
         year(date)::INTEGER AS year, month(date)::INTEGER AS month, day(date)::INTEGER AS day,
         hour,
         CASE WHEN hour < 6 THEN 'madrugada' WHEN hour < 12 THEN 'mañana'
              WHEN hour < 18 THEN 'tarde' ELSE 'noche' END AS time_of_day,
         (dayofweek(date) + 1)::INTEGER AS day_of_week,
         dayofweek(date) IN (0, 6) AS is_weekend,
         total_events, unique_users, unique_sessions,
         total_views, total_carts, total_purchases, total_revenue, avg_price,
         {ratios}
  FROM hourly_base
),
category_base AS (
  SELECT category_l1, {measures}
  FROM silver WHERE category_l1 IS NOT NULL AND category_l1 <> 'unknown' GROUP BY 1
),
category_sums AS (
  SELECT sum(total_revenue::DECIMAL(28, 2))::DOUBLE AS revenue, sum(total_purchases)::BIGINT AS purchases
  FROM category_base
),
category AS (
  SELECT category_l1, total_events, unique_users, unique_products,
         total_views, total_carts, total_purchases, total_revenue, avg_price,
         CASE WHEN total_purchases > 0 THEN total_revenue / total_purchases ELSE 0::DOUBLE END
           AS avg_order_value,
         CASE WHEN unique_users > 0 THEN total_revenue / unique_users ELSE 0::DOUBLE END
           AS revenue_per_user,
         {conversion} AS conversion_rate,
         CASE WHEN total_views > 0 THEN total_carts::DOUBLE / total_views * 100 ELSE 0::DOUBLE END
           AS add_to_cart_rate,
         {cart_to_purchase} AS cart_to_purchase_rate,
         {abandonment} AS cart_abandonment_rate,
         CASE WHEN revenue <> 0 THEN total_revenue / revenue * 100 ELSE 0::DOUBLE END AS pct_revenue,
         CASE WHEN purchases <> 0 THEN total_purchases::DOUBLE / purchases * 100 ELSE 0::DOUBLE END
           AS pct_purchases
  FROM category_base, category_sums
)
"""

_MEASURES = """
         count(*) AS total_events,
         count(DISTINCT user_id) AS unique_users,
         count(DISTINCT user_session) AS unique_sessions,
         count(DISTINCT product_id) AS unique_products,
         count(*) FILTER (WHERE event_type = 'view') AS total_views,
         count(*) FILTER (WHERE event_type = 'cart') AS total_carts,
         count(*) FILTER (WHERE event_type = 'purchase') AS total_purchases,
         coalesce(sum(price::DECIMAL(18, 2)) FILTER (WHERE event_type = 'purchase'), 0)::DOUBLE
           AS total_revenue,
         sum(price::DECIMAL(18, 2))::DOUBLE / count(price) AS avg_price"""

_CONVERSION = "CASE WHEN total_views > 0 THEN total_purchases::DOUBLE / total_views * 100 ELSE 0::DOUBLE END"
_ABANDONMENT = (
    "CASE WHEN total_carts > 0 THEN (total_carts - total_purchases)::DOUBLE / total_carts * 100 "
    "ELSE 0::DOUBLE END"
)
_CART_TO_PURCHASE = (
    "CASE WHEN total_carts > 0 THEN total_purchases::DOUBLE / total_carts * 100 ELSE 0::DOUBLE END"
)
_PURCHASES_PER_USER = (
    "CASE WHEN unique_users > 0 THEN total_purchases::DOUBLE / unique_users ELSE 0::DOUBLE END"
)
_RATIOS = f"""
         CASE WHEN total_purchases > 0 THEN total_revenue / total_purchases ELSE 0::DOUBLE END
           AS avg_order_value,
         {_CONVERSION} AS conversion_rate,
         {_ABANDONMENT} AS cart_abandonment_rate,
         CASE WHEN unique_users > 0 THEN total_events::DOUBLE / unique_users ELSE 0::DOUBLE END
           AS events_per_user"""

_SHARED = _WITH.format(
    measures=_MEASURES,
    ratios=_RATIOS,
    conversion=_CONVERSION,
    abandonment=_ABANDONMENT,
    cart_to_purchase=_CART_TO_PURCHASE,
    purchases_per_user=_PURCHASES_PER_USER,
)

_RAW = "event_time, event_type, product_id, category_id, category_code, brand, price, user_id, user_session"
_TIME = "hour, day_of_week, is_weekend, time_of_day"
_LEVELS = "category_l1, category_l2, category_l3"
_PARTS = "year, month, day"
_FIRST = "DATE '2024-01-01' AND DATE '2024-01-15'"
_SECOND = "DATE '2024-01-16' AND DATE '2024-01-30'"
_MONTH = "DATE '2024-01-01' AND DATE '2024-01-30'"


def _money(column: str, where: str = "TRUE") -> str:
    return f"CAST(sum({column}::DECIMAL(28, 2)) FILTER (WHERE {where}) AS DOUBLE)"


def _big(column: str, where: str = "TRUE") -> str:
    return f"CAST(sum({column}) FILTER (WHERE {where}) AS BIGINT)"


def _mean(column: str, where: str = "TRUE") -> str:
    return f"round(avg({column}) FILTER (WHERE {where}), 6)"


def _shares(source: str, column: str, tail: str = "") -> str:
    return (
        f"SELECT {column}, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM {source}) * 100 AS pct "
        f"FROM {source} GROUP BY 1 {tail}"
    )


def _side(side: str, days: str) -> str:
    inside = f"date BETWEEN {days}"
    return f"""
      {_big('total_events', inside)} AS {side}_total_events,
      {_big('total_views', inside)} AS {side}_total_views,
      {_big('total_purchases', inside)} AS {side}_total_purchases,
      {_money('total_revenue', inside)} AS {side}_total_revenue,
      avg(conversion_rate) FILTER (WHERE {inside}) AS {side}_avg_conversion_rate,
      {_big('unique_users', inside)} AS {side}_sum_daily_unique_users,
      avg(events_per_user) FILTER (WHERE {inside}) AS {side}_avg_events_per_user"""


def _pattern(key: str) -> str:
    return f"""SELECT {key}, sum(total_events)::BIGINT AS total_events,
      sum(total_views)::BIGINT AS total_views, sum(total_purchases)::BIGINT AS total_purchases,
      {_money('total_revenue')} AS total_revenue, avg(conversion_rate) AS avg_conversion_rate
      FROM hourly GROUP BY 1"""


_BANDS = f"""SELECT time_of_day,
    list_position(['madrugada', 'mañana', 'tarde', 'noche'], time_of_day)::INTEGER AS band_rank,
    total_events, total_events::DOUBLE / (SELECT sum(total_events) FROM hourly)::BIGINT * 100 AS pct_events,
    total_purchases,
    total_purchases::DOUBLE / (SELECT sum(total_purchases) FROM hourly)::BIGINT * 100 AS pct_purchases,
    avg_conversion_rate, total_revenue
    FROM ({_pattern('time_of_day')})"""

_HOURS = """SELECT hour, sum(total_events)::BIGINT AS total_events,
    sum(total_purchases)::BIGINT AS total_purchases, avg(conversion_rate) AS avg_conversion_rate,
    sum(total_purchases)::DOUBLE / (SELECT sum(total_purchases) FROM hourly)::BIGINT * 100 AS pct_purchases,
    hour IN (2, 3, 4) AS is_golden
    FROM hourly GROUP BY 1"""

_ROOTS = "SELECT coalesce(string_split(category_code, '.')[1], 'Unknown') AS category_l1 FROM raw"


def _best_hours(weekend: str) -> str:
    return f"""SELECT hour, round(rate, 6) AS avg_conversion_rate, total_purchases FROM (
      SELECT hour, avg(conversion_rate) AS rate, sum(total_purchases)::BIGINT AS total_purchases
      FROM hourly WHERE is_weekend = {weekend} GROUP BY 1)
      ORDER BY rate DESC, hour LIMIT 5"""


def _top(columns: str, order: str, source: str = "category", k: int = 10) -> str:
    return f"SELECT {columns} FROM {source} ORDER BY {order} LIMIT {k}"


def _price_stats(source: str) -> str:
    return f"""SELECT count(price) AS prices, min(price) AS min_price, max(price) AS max_price,
      round(avg(price), 6) AS avg_price, round(stddev_samp(price), 6) AS std_price,
      round(quantile_cont(price, 0.5), 6) AS median_price FROM {source}"""


def _describe(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(v) AS n, round(avg(v), 6) AS mean,
      round(stddev_samp(v), 6) AS std, min(v) AS min, round(quantile_cont(v, 0.25), 6) AS p25,
      round(quantile_cont(v, 0.5), 6) AS p50, round(quantile_cont(v, 0.75), 6) AS p75, max(v) AS max
      FROM (SELECT {column}::DOUBLE AS v FROM raw)"""


def _nulls(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count(*) FILTER (WHERE {column} IS NULL) AS null_rows,
      count(*) FILTER (WHERE {column} IS NULL)::DOUBLE / count(*) * 100 AS pct_null FROM raw"""


_NULL_PROFILE = " UNION ALL ".join(_nulls(c) for c in _RAW.split(", "))

_CRITICAL = {
    "silver": ("event_time", "event_type", "product_id", "price", "user_id"),
    "silver_short": (
        "event_time", "event_type", "product_id", "user_id", "price", "conversion_stage", "category_l1",
    ),
    "pipeline": (
        "event_type", "product_id", "user_id", "price", "brand", "category_code", "conversion_stage",
    ),
}

_DUPLICATES = """SELECT sum(n) FILTER (WHERE n > 1)::BIGINT AS duplicate_rows,
    count(*) FILTER (WHERE n > 1) AS duplicate_groups, sum(n)::BIGINT AS all_rows,
    sum(n) FILTER (WHERE n > 1)::DOUBLE / sum(n)::BIGINT * 100 AS pct_duplicates
    FROM (SELECT count(*) AS n FROM raw
          GROUP BY user_id, product_id, event_type, date_trunc('second', event_time))"""

_PRICES = """SELECT count(*) AS all_rows, count(*) FILTER (WHERE price = 0) AS zero_rows,
    count(*) FILTER (WHERE price < 0) AS negative_rows, count(*) FILTER (WHERE price > 0) AS valid_rows,
    count(*) FILTER (WHERE price = 0)::DOUBLE / count(*) * 100 AS pct_zero,
    count(*) FILTER (WHERE price < 0)::DOUBLE / count(*) * 100 AS pct_negative,
    count(*) FILTER (WHERE price > 0)::DOUBLE / count(*) * 100 AS pct_valid FROM raw"""

_AUDIT = """SELECT initial_rows, initial_rows - valid_rows AS removed_by_price,
    valid_rows - final_rows AS removed_as_duplicates, final_rows,
    initial_rows - final_rows AS removed_rows,
    (initial_rows - final_rows)::DOUBLE / initial_rows * 100 AS pct_removed
    FROM (SELECT (SELECT count(*) FROM raw) AS initial_rows, (SELECT count(*) FROM valid) AS valid_rows,
                 (SELECT count(*) FROM clean) AS final_rows)"""


def _period_fact(unit: str) -> str:
    return f"""SELECT start AS {unit}_start, total_events, unique_users, unique_sessions,
      unique_products, total_views, total_carts, total_purchases, total_revenue, avg_price, {_RATIOS},
      {_PURCHASES_PER_USER} AS purchases_per_user, {_CART_TO_PURCHASE} AS cart_to_purchase_rate
      FROM (SELECT date_trunc('{unit}', event_time)::DATE AS start, {_MEASURES} FROM silver GROUP BY 1)"""


def _windows(source: str, starts: str, band: str = "") -> str:
    return f"""SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, {band}
      total_events, total_views, total_carts, total_purchases, total_revenue, avg_price,
      CASE WHEN total_purchases > 0 THEN total_revenue / total_purchases ELSE 0::DOUBLE END
        AS avg_order_value,
      {_CONVERSION} AS conversion_rate, {_ABANDONMENT} AS cart_abandonment_rate
      FROM (SELECT window_start, {_MEASURES} FROM (SELECT *, {starts} AS window_start FROM {source})
            GROUP BY 1)"""


_QUARTERS = """unnest([time_bucket(INTERVAL 15 MINUTE, event_time),
  time_bucket(INTERVAL 15 MINUTE, event_time) - INTERVAL 15 MINUTE,
  time_bucket(INTERVAL 15 MINUTE, event_time) - INTERVAL 30 MINUTE,
  time_bucket(INTERVAL 15 MINUTE, event_time) - INTERVAL 45 MINUTE])"""


# Types of the Silver columns by their Spark names, as the schema reports give them.
_SILVER_TYPES = {
    "event_time": "timestamp", "event_type": "string", "product_id": "bigint",
    "category_id": "bigint", "category_code": "string", "brand": "string", "price": "double",
    "user_id": "bigint", "user_session": "string", "hour": "int", "day_of_week": "int",
    "is_weekend": "boolean", "time_of_day": "string", "category_l1": "string",
    "category_l2": "string", "category_l3": "string", "conversion_stage": "string", "year": "int",
    "month": "int", "day": "int",
}


def _closed(source: str, end: str, body: str) -> str:
    """What a stream has handed out: windows and visits that the watermark has passed."""
    return f"""SELECT * FROM ({body})
        WHERE {end} <= (SELECT max(event_time) FROM {source}) - INTERVAL 10 MINUTE"""


# Versions of products: attributes of the last event of each day, where they differ from the day before.
_HISTORY = """SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY valid_from)::INTEGER AS version,
      lead(valid_from) OVER (PARTITION BY product_id ORDER BY valid_from) AS valid_to
    FROM (SELECT *,
            lag(valid_from) OVER w IS NULL
              OR lag(category_code) OVER w IS DISTINCT FROM category_code
              OR lag(brand) OVER w IS DISTINCT FROM brand
              OR lag(price_level) OVER w IS DISTINCT FROM price_level AS changed
          FROM (SELECT product_id, event_time::DATE AS valid_from, category_code, brand,
                  floor(price / 100)::BIGINT AS price_level
                FROM silver
                QUALIFY row_number() OVER (PARTITION BY product_id, event_time::DATE
                  ORDER BY event_time DESC, category_code DESC, brand DESC, floor(price / 100) DESC) = 1)
          WINDOW w AS (PARTITION BY product_id ORDER BY valid_from))
    WHERE changed"""

_OUTCOMES = """SELECT c.user_id, c.product_id, c.event_time,
      CASE WHEN EXISTS (SELECT 1 FROM silver p WHERE p.event_type = 'purchase' AND p.user_id = c.user_id
                          AND p.product_id = c.product_id AND p.event_time >= c.event_time
                          AND p.event_time <= c.event_time + INTERVAL 72 HOUR) THEN 'converted'
           WHEN c.event_time + INTERVAL 72 HOUR > (SELECT max(event_time) FROM silver) THEN 'open'
           ELSE 'abandoned' END AS outcome
    FROM silver c WHERE c.event_type = 'cart'"""

_NEIGHBOURS = """WITH firsts AS (
      SELECT user_session, product_id, min(event_time) AS first_seen FROM silver
      WHERE user_session IS NOT NULL GROUP BY 1, 2
    ), placed AS (
      SELECT *, row_number() OVER (PARTITION BY user_session ORDER BY first_seen, product_id) AS place,
        1000000 // count(*) OVER (PARTITION BY user_session) AS weight
      FROM firsts
    ), norms AS (SELECT product_id, sum(weight)::BIGINT AS norm FROM placed GROUP BY 1
    ), pairs AS (
      SELECT x.product_id, y.product_id AS neighbour_id, sum(x.weight)::BIGINT AS weight, count(*) AS sessions
      FROM placed x JOIN placed y ON x.user_session = y.user_session
        AND x.place <> y.place AND abs(x.place - y.place) <= 10
      GROUP BY 1, 2
    )
    SELECT product_id, neighbour_id, sessions, cosine,
      row_number() OVER (PARTITION BY product_id ORDER BY cosine DESC, neighbour_id)::INTEGER AS rank
    FROM (SELECT p.product_id, p.neighbour_id, p.sessions,
            p.weight / sqrt(a.norm::DOUBLE * b.norm) AS cosine
          FROM pairs p JOIN norms a ON a.product_id = p.product_id JOIN norms b ON b.product_id = p.neighbour_id)
    QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY cosine DESC, neighbour_id) <= 10"""

_SESSION_GROUPS = """SELECT user_session, count(*) AS total_events,
      hour(min(event_time))::INTEGER AS start_hour,
      CASE max(CASE event_type WHEN 'purchase' THEN 2 WHEN 'cart' THEN 1 ELSE 0 END)
        WHEN 2 THEN 'purchased' WHEN 1 THEN 'added_to_cart' ELSE 'viewed_only' END AS stage
    FROM silver WHERE user_session IS NOT NULL GROUP BY 1"""

_GROUP_ANOMALIES = f"""WITH s AS ({_SESSION_GROUPS}), m AS (
      SELECT start_hour, stage, median(total_events)::DOUBLE AS median FROM s GROUP BY 1, 2
    ), d AS (
      SELECT s.*, m.median, abs(s.total_events - m.median) AS distance
      FROM s JOIN m ON s.start_hour = m.start_hour AND s.stage = m.stage
    ), g AS (
      SELECT start_hour, stage, median(distance)::DOUBLE AS mad, avg(distance) AS mean_distance
      FROM d GROUP BY 1, 2
    ), z AS (
      SELECT d.*, g.mad, CASE WHEN g.mad > 0 THEN g.mad / 0.6745
                              WHEN g.mean_distance > 0 THEN g.mean_distance * 1.2533 END AS scale
      FROM d JOIN g ON d.start_hour = g.start_hour AND d.stage = g.stage
    )
    SELECT user_session, start_hour, stage, total_events, median, mad,
      round((total_events - median) / scale, 6) AS z_score
    FROM z WHERE (total_events - median) / scale > 3.5"""


def _grains() -> str:
    parts = []
    for grain in ("day", "week", "month"):
        body = _period_fact(grain).replace(f"start AS {grain}_start", f"'{grain}' AS grain, start AS period_start")
        parts.append(body)
    whole = _period_fact("day").replace("start AS day_start", "'all' AS grain, start AS period_start")
    parts.append(whole.replace("date_trunc('day', event_time)::DATE", "NULL::DATE"))
    return " UNION ALL ".join(parts)


def _bodies() -> dict[str, str]:
    sides = f"SELECT {_side('before', _FIRST)}, {_side('after', _SECOND)} FROM daily"
    totals = f"""SELECT {_big('total_events')} AS total_events, {_big('total_purchases')} AS total_purchases,
      {_money('total_revenue')} AS total_revenue, {_mean('conversion_rate')} AS avg_conversion_rate"""
    daily_columns = """date, year, month, day, day_of_week, is_weekend, total_events, unique_users,
      unique_sessions, unique_products, total_views, total_carts, total_purchases, total_revenue,
      avg_price, avg_order_value, conversion_rate, cart_abandonment_rate, cart_to_purchase_rate,
      events_per_user, purchases_per_user"""
    latest = """SELECT product_id, category_id, category_code,
      string_split(category_code, '.')[1] AS category_l1, brand,
      count(*) OVER (PARTITION BY product_id) AS total_events
      FROM silver
      QUALIFY row_number() OVER (PARTITION BY product_id
        ORDER BY event_time DESC, category_code DESC, brand DESC, category_id DESC) = 1"""
    sessions = "SELECT user_session, count(*) AS total_events FROM silver GROUP BY 1"
    return {
        "bronze_partitions": f"""SELECT {_RAW}, year(event_time)::INTEGER AS year,
          month(event_time)::INTEGER AS month, day(event_time)::INTEGER AS day FROM raw""",
        "scan_partition_range": f"""SELECT {_RAW}, year(event_time)::INTEGER AS year,
          month(event_time)::INTEGER AS month, day(event_time)::INTEGER AS day FROM raw
          WHERE event_time >= TIMESTAMP '2024-01-01' AND event_time < TIMESTAMP '2024-01-08'""",
        "scan_projected": """SELECT event_time, event_type, product_id, user_id, category_code, brand,
          price FROM raw""",
        "head_sample": f"""SELECT {_RAW} FROM raw ORDER BY user_id, product_id, event_type, event_time,
          user_session, price, category_code, brand, category_id LIMIT 1000""",
        "rows_per_source_file": """SELECT 'events.parquet' AS file_name, count(*) AS total_rows FROM events
          UNION ALL SELECT 'part.parquet', count(*) FROM part""",
        "row_estimate": """SELECT 1::BIGINT AS files, 1::BIGINT AS sampled_files,
          count(*)::DOUBLE AS avg_rows_per_file, count(*) AS estimated_rows FROM events""",
        "clean_price_filter": f"SELECT {_RAW} FROM valid",
        "clean_fill_nulls": """SELECT * REPLACE (coalesce(brand, 'Unknown') AS brand,
          coalesce(category_code, 'Unknown') AS category_code) FROM raw""",
        "clean_dedup": f"""SELECT {_RAW} FROM raw QUALIFY row_number() OVER (
          PARTITION BY user_id, product_id, event_type, event_time
          ORDER BY user_session NULLS LAST, price NULLS LAST, category_code NULLS LAST,
                   brand NULLS LAST, category_id NULLS LAST) = 1""",
        "clean_data": f"SELECT {_RAW} FROM clean",
        "enrich_temporal": f"SELECT {_RAW}, {_TIME} FROM timed",
        "parse_categories": f"SELECT {_RAW}, {_LEVELS} FROM leveled",
        "conversion_stage": f"SELECT {_RAW}, conversion_stage FROM staged",
        "silver_events": f"SELECT {_RAW}, {_TIME}, {_LEVELS}, conversion_stage, {_PARTS} FROM silver",
        "gold_daily": f"SELECT {daily_columns} FROM daily ORDER BY date",
        "gold_hourly": "SELECT * FROM hourly ORDER BY date, hour",
        "gold_category": "SELECT * FROM category ORDER BY total_revenue DESC, category_l1",
        "gold_weekly": _period_fact("week"),
        "gold_monthly": _period_fact("month"),
        "clean_audit": _AUDIT,
        "null_profile": _NULL_PROFILE,
        "nulls_found": f"""SELECT column_name, null_rows, round(pct_null, 2) AS pct_null
          FROM ({_NULL_PROFILE}) WHERE null_rows > 0""",
        "duplicate_profile": _DUPLICATES,
        "describe_numeric": " UNION ALL ".join(
            _describe(c) for c in ("product_id", "category_id", "price", "user_id")
        ),
        "price_stats": _price_stats("silver"),
        "bronze_price_stats": _price_stats("raw"),
        "period_compare": f"""SELECT * REPLACE (
          round(before_avg_conversion_rate, 6) AS before_avg_conversion_rate,
          round(after_avg_conversion_rate, 6) AS after_avg_conversion_rate,
          round(before_avg_events_per_user, 6) AS before_avg_events_per_user,
          round(after_avg_events_per_user, 6) AS after_avg_events_per_user),
          (after_total_events - before_total_events)::DOUBLE / before_total_events * 100
            AS traffic_change_pct,
          round(after_avg_conversion_rate - before_avg_conversion_rate, 6) AS conversion_change_points
          FROM ({sides})""",
        "traffic_quality_flag": f"""SELECT
          after_avg_events_per_user > before_avg_events_per_user AS events_per_user_rose,
          after_avg_conversion_rate < before_avg_conversion_rate AS conversion_fell,
          after_avg_events_per_user > before_avg_events_per_user
            AND after_avg_conversion_rate < before_avg_conversion_rate AS low_quality_traffic
          FROM ({sides})""",
        "spike_days": f"""SELECT date, total_events, unique_users, total_purchases, conversion_rate,
          total_revenue, events_per_user FROM daily
          WHERE date BETWEEN {_MONTH} AND day IN (15, 16, 17) ORDER BY date""",
        "spike_impact": f"""SELECT spike_events, spike_purchases, spike_revenue, period_events,
          spike_events::DOUBLE / period_events * 100 AS pct_of_period,
          period_events::DOUBLE / period_days AS period_daily_events,
          spike_events::DOUBLE / 3 AS spike_daily_events,
          ((spike_events::DOUBLE / 3) / (period_events::DOUBLE / period_days) - 1) * 100 AS uplift_pct
          FROM (SELECT {_big('total_events', 'day IN (15, 16, 17)')} AS spike_events,
                       {_big('total_purchases', 'day IN (15, 16, 17)')} AS spike_purchases,
                       {_money('total_revenue', 'day IN (15, 16, 17)')} AS spike_revenue,
                       {_big('total_events')} AS period_events, count(*) AS period_days
                FROM daily WHERE date BETWEEN {_MONTH})""",
        "event_day": f"""SELECT date, total_events, total_purchases, total_revenue, conversion_rate
          FROM daily WHERE date BETWEEN {_MONTH} AND day = 29""",
        "top_days_traffic": _top(
            "date, total_events, total_purchases, conversion_rate, total_revenue",
            "total_events DESC, date", "daily",
        ),
        "top_days_revenue": _top(
            "date, total_revenue, total_purchases, conversion_rate, total_events",
            "total_revenue DESC, date", "daily",
        ),
        "daily_overall": f"""SELECT count(*) AS total_days, min(date) AS min_date, max(date) AS max_date,
          {_mean('conversion_rate')} AS avg_conversion_rate, {_mean('events_per_user')} AS avg_events_per_user,
          {_mean('purchases_per_user')} AS avg_purchases_per_user,
          {_mean('avg_order_value')} AS avg_order_value, {_money('total_revenue')} AS total_revenue
          FROM daily""",
        "weekend_vs_weekday": f"""SELECT is_weekend, {_mean('conversion_rate')} AS avg_conversion_rate,
          {_mean('events_per_user')} AS avg_events_per_user FROM daily GROUP BY 1""",
        "gold_daily_totals": f"{totals} FROM daily",
        "gold_hourly_totals": f"{totals} FROM hourly",
        "monthly_rollup": f"""SELECT period, total_events, total_purchases, total_revenue,
          round(rate, 6) AS avg_conversion_rate,
          (total_events::DOUBLE / first_events - 1) * 100 AS traffic_change_pct,
          round((rate / first_rate - 1) * 100, 6) AS conversion_change_pct
          FROM (SELECT *, max(total_events) FILTER (WHERE period = 'first_half') OVER () AS first_events,
                       max(rate) FILTER (WHERE period = 'first_half') OVER () AS first_rate
                FROM (SELECT CASE WHEN date BETWEEN {_FIRST} THEN 'first_half' ELSE 'second_half' END AS period,
                             sum(total_events)::BIGINT AS total_events,
                             sum(total_purchases)::BIGINT AS total_purchases,
                             {_money('total_revenue')} AS total_revenue, avg(conversion_rate) AS rate
                      FROM daily WHERE date BETWEEN {_MONTH} GROUP BY 1))""",
        "revenue_series": f"""SELECT date, day, total_revenue, day IN (15, 16, 17) AS is_spike_day,
          day = 29 AS is_event_day,
          row_number() OVER (ORDER BY total_revenue DESC, date) = 1 AS is_best_day
          FROM daily WHERE date BETWEEN {_MONTH}""",
        "revenue_peaks": f"""SELECT *, spike_revenue / period_revenue * 100 AS spike_pct_of_period FROM (
          SELECT (SELECT date FROM daily WHERE date BETWEEN {_MONTH}
                  ORDER BY total_revenue DESC, date LIMIT 1) AS best_date,
                 max(total_revenue) AS best_revenue,
                 {_money('total_revenue', 'day IN (15, 16, 17)')} AS spike_revenue,
                 {_money('total_revenue', 'day = 29')} AS event_day_revenue,
                 {_money('total_revenue')} AS period_revenue
          FROM daily WHERE date BETWEEN {_MONTH})""",
        "hourly_pattern": f"""SELECT * REPLACE (round(avg_conversion_rate, 6) AS avg_conversion_rate)
          FROM ({_pattern('hour')}) ORDER BY hour""",
        "peak_hours": f"""SELECT
          (SELECT hour FROM p ORDER BY total_events DESC, hour LIMIT 1) AS traffic_hour,
          (SELECT max(total_events) FROM p) AS traffic_events,
          (SELECT hour FROM p ORDER BY avg_conversion_rate DESC, hour LIMIT 1) AS conversion_hour,
          (SELECT round(max(avg_conversion_rate), 6) FROM p) AS conversion_rate,
          (SELECT hour FROM p ORDER BY total_revenue DESC, hour LIMIT 1) AS revenue_hour,
          (SELECT max(total_revenue) FROM p) AS revenue""",
        "time_of_day_share": f"""SELECT * REPLACE (round(avg_conversion_rate, 6) AS avg_conversion_rate)
          FROM ({_BANDS}) ORDER BY band_rank""",
        "time_of_day_winners": """SELECT *, traffic_band <> purchase_band AS browse_and_buy_differ FROM (SELECT
          (SELECT time_of_day FROM b ORDER BY pct_events DESC, band_rank LIMIT 1) AS traffic_band,
          (SELECT max(pct_events) FROM b) AS traffic_pct,
          (SELECT time_of_day FROM b ORDER BY pct_purchases DESC, band_rank LIMIT 1) AS purchase_band,
          (SELECT max(pct_purchases) FROM b) AS purchase_pct,
          (SELECT time_of_day FROM b ORDER BY avg_conversion_rate DESC, band_rank LIMIT 1) AS conversion_band,
          (SELECT round(max(avg_conversion_rate), 6) FROM b) AS conversion_rate)""",
        "weekend_hours_top5": _best_hours("TRUE"),
        "weekday_hours_top5": _best_hours("FALSE"),
        "hourly_overall": f"""SELECT count(*) AS total_hours, min(hour) AS min_hour, max(hour) AS max_hour,
          {_mean('conversion_rate')} AS avg_conversion_rate, {_big('total_events')} AS total_events,
          {_big('total_purchases')} AS total_purchases, {_money('total_revenue')} AS total_revenue
          FROM hourly""",
        "hourly_purchase_share": f"""SELECT * REPLACE (round(avg_conversion_rate, 6) AS avg_conversion_rate)
          FROM ({_HOURS})""",
        "golden_hours": f"""SELECT
          round(sum(pct_purchases) FILTER (WHERE is_golden), 6) AS golden_pct_purchases,
          {_mean('avg_conversion_rate', 'is_golden')} AS golden_avg_conversion_rate,
          {_mean('pct_purchases')} AS mean_pct_purchases,
          {_mean('avg_conversion_rate')} AS mean_conversion_rate FROM ({_HOURS})""",
        "category_overview": """SELECT category_l1, total_purchases, total_revenue, conversion_rate,
          avg_order_value, cart_abandonment_rate FROM category""",
        "category_top_conversion": _top(
            "category_l1, conversion_rate, total_views, total_purchases, total_revenue, avg_order_value",
            "conversion_rate DESC, category_l1",
        ),
        "category_top_revenue": _top(
            "category_l1, total_revenue, pct_revenue, total_purchases, avg_order_value, conversion_rate",
            "total_revenue DESC, category_l1",
        ),
        "category_top_abandonment": _top(
            "category_l1, cart_abandonment_rate, total_carts, total_purchases, conversion_rate",
            "cart_abandonment_rate DESC, category_l1",
        ),
        "category_low_abandonment": _top(
            "category_l1, cart_abandonment_rate, total_carts, total_purchases, conversion_rate",
            "cart_abandonment_rate, category_l1",
        ),
        "category_top_aov": _top(
            "category_l1, avg_order_value, total_purchases, total_revenue, conversion_rate",
            "avg_order_value DESC, category_l1",
        ),
        "category_top3": " UNION ALL ".join(
            f"""SELECT * FROM (SELECT category_l1, conversion_rate, total_views, total_purchases,
            total_revenue, pct_revenue, avg_order_value, '{label}' AS ranking,
            (row_number() OVER (ORDER BY {measure} DESC, category_l1))::INTEGER AS place FROM category)
            WHERE place <= 3"""
            for label, measure in (("conversion", "conversion_rate"), ("revenue", "total_revenue"))
        ),
        "category_best_overall": _top(
            "category_l1, conversion_rate, total_revenue, avg_order_value, cart_abandonment_rate",
            "conversion_rate * total_revenue DESC, category_l1", k=1,
        ),
        "category_overall": f"""SELECT count(*) AS total_categories,
          {_mean('conversion_rate')} AS avg_conversion_rate,
          {_mean('cart_abandonment_rate')} AS avg_cart_abandonment_rate,
          {_mean('avg_order_value')} AS avg_order_value, {_money('total_revenue')} AS total_revenue,
          {_big('total_purchases')} AS total_purchases FROM category""",
        "category_winners": """SELECT
          (SELECT category_l1 FROM category ORDER BY conversion_rate DESC, category_l1 LIMIT 1)
            AS conversion_category,
          (SELECT max(conversion_rate) FROM category) AS conversion_rate,
          (SELECT category_l1 FROM category ORDER BY total_revenue DESC, category_l1 LIMIT 1)
            AS revenue_category,
          (SELECT max(total_revenue) FROM category) AS total_revenue,
          (SELECT category_l1 FROM category ORDER BY avg_order_value DESC, category_l1 LIMIT 1)
            AS order_value_category,
          (SELECT max(avg_order_value) FROM category) AS avg_order_value""",
        "gold_category_totals": f"""SELECT {_big('total_purchases')} AS total_purchases,
          {_money('total_revenue')} AS total_revenue, {_mean('conversion_rate')} AS avg_conversion_rate
          FROM category""",
        "top5_category_share": f"""SELECT category_l1,
          upper(category_l1[1]) || lower(category_l1[2:]) AS label, total_revenue, conversion_rate,
          total_revenue / (SELECT {_money('total_revenue')} FROM five) * 100 AS pct_of_top, pct_revenue
          FROM five ORDER BY total_revenue DESC, category_l1""",
        "records_by_month": """SELECT year, month, count(*) AS records FROM silver GROUP BY 1, 2""",
        "records_by_day": """SELECT year, month, day, count(*) AS records FROM silver GROUP BY 1, 2, 3""",
        "busiest_days": """SELECT strftime(event_time, '%Y-%m-%d') AS date, count(*) AS records FROM silver
          GROUP BY 1 ORDER BY records DESC, date LIMIT 10""",
        "event_type_dist": _shares("silver", "event_type"),
        "stage_dist": _shares("silver", "conversion_stage"),
        "time_of_day_dist": _shares("silver", "time_of_day"),
        "weekend_share": _shares("silver", "is_weekend"),
        "temporal_ranges": """SELECT min(hour) AS min_hour, max(hour) AS max_hour,
          min(day_of_week) AS min_day_of_week, max(day_of_week) AS max_day_of_week FROM silver""",
        "top_categories": _shares("silver", "category_l1", "ORDER BY n DESC, category_l1 LIMIT 10"),
        "valid_category_share": """SELECT count(*) AS all_rows,
          count(*) FILTER (WHERE category_l1 <> 'unknown') AS valid_rows,
          count(*) FILTER (WHERE category_l1 <> 'unknown')::DOUBLE / count(*) * 100 AS pct_valid
          FROM silver""",
        "category_depth": """SELECT count(*) FILTER (WHERE category_l1 = 'Unknown') AS unknown_rows,
          count(*) FILTER (WHERE category_l2 IS NULL AND category_l1 <> 'Unknown') AS one_level_rows,
          count(*) FILTER (WHERE category_l2 IS NOT NULL AND category_l3 IS NULL) AS two_level_rows,
          count(*) FILTER (WHERE category_l3 IS NOT NULL) AS three_level_rows,
          (SELECT count(*) FROM (SELECT DISTINCT category_l1 FROM silver)) AS distinct_l1,
          (SELECT count(*) FROM (SELECT DISTINCT category_l2 FROM silver)) AS distinct_l2,
          (SELECT count(*) FROM (SELECT DISTINCT category_l3 FROM silver)) AS distinct_l3,
          count(*) FILTER (WHERE category_l2 IS NULL) AS null_l2_rows,
          count(*) FILTER (WHERE category_l3 IS NULL) AS null_l3_rows FROM silver""",
        "category_paths": f"SELECT DISTINCT category_code, {_LEVELS} FROM silver",
        "distinct_entities": """SELECT (SELECT count(*) FROM (SELECT DISTINCT user_id FROM silver)) AS unique_users,
          (SELECT count(*) FROM (SELECT DISTINCT product_id FROM silver)) AS unique_products,
          (SELECT count(*) FROM (SELECT DISTINCT brand FROM silver)) AS unique_brands""",
        "critical_nulls": " UNION ALL ".join(
            f"""SELECT '{label}' AS list_name, '{c}' AS column_name,
            count(*) FILTER (WHERE {c} IS NULL) AS null_rows,
            count(*) FILTER (WHERE {c} IS NULL) = 0 AS is_clean FROM silver"""
            for label, columns in _CRITICAL.items()
            for c in columns
        ),
        "month_traffic_change": f"""SELECT before_rows, after_rows,
          CASE WHEN after_rows > before_rows THEN 'more' ELSE 'less' END AS direction,
          abs((after_rows - before_rows)::DOUBLE / before_rows * 100) AS change_pct
          FROM (SELECT count(*) FILTER (WHERE event_time::DATE BETWEEN {_FIRST}) AS before_rows,
                       count(*) FILTER (WHERE event_time::DATE BETWEEN {_SECOND}) AS after_rows FROM silver)""",
        "month_purchase_share": f"""SELECT CASE WHEN event_time::DATE BETWEEN {_FIRST} THEN 'first_half'
            ELSE 'second_half' END AS period,
          count(*) FILTER (WHERE event_type = 'purchase') AS purchases, count(*) AS all_rows,
          count(*) FILTER (WHERE event_type = 'purchase')::DOUBLE / count(*) * 100 AS purchase_share
          FROM silver WHERE event_time::DATE BETWEEN {_MONTH} GROUP BY 1""",
        "partition_coverage": """SELECT days_present, 31::BIGINT AS days_expected,
          31 - days_present AS days_missing, days_present = 31 AS is_complete
          FROM (SELECT count(DISTINCT event_time::DATE) AS days_present FROM silver)""",
        "missing_days": """SELECT d::DATE AS date FROM range(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 1 DAY) t(d)
          WHERE d::DATE NOT IN (SELECT event_time::DATE FROM silver)""",
        "event_by_stage": """SELECT event_type, conversion_stage, count(*) AS n FROM silver GROUP BY 1, 2""",
        "users_by_stage": """SELECT conversion_stage, count(DISTINCT user_id) AS unique_users FROM silver GROUP BY 1""",
        "stage_consistency": """SELECT count(*) AS buying_pairs,
          count(*) FILTER (WHERE others > 0) AS violating_pairs,
          coalesce(sum(others), 0)::BIGINT AS violating_rows
          FROM (SELECT count(*) FILTER (WHERE conversion_stage <> 'purchased') AS others FROM silver
                GROUP BY user_id, product_id HAVING bool_or(event_type = 'purchase'))""",
        "stage_examples": """SELECT *, (row_number() OVER (PARTITION BY conversion_stage
            ORDER BY user_id, product_id, event_type))::INTEGER AS place
          FROM (SELECT DISTINCT user_id, product_id, event_type, conversion_stage FROM silver)
          QUALIFY place <= 5""",
        "buyer_trail": """SELECT user_id, product_id, event_time, event_type, conversion_stage FROM silver
          WHERE (user_id, product_id) = (SELECT (user_id, product_id) FROM silver
            WHERE event_type = 'purchase' ORDER BY user_id, product_id LIMIT 1)""",
        "column_growth": f"""SELECT initial_rows AS rows_in, final_rows AS rows_out,
          removed_rows AS rows_removed, pct_removed, 7::INTEGER AS columns_in, 15::INTEGER AS columns_out,
          8::INTEGER AS columns_added FROM ({_AUDIT})""",
        "layer_summary": " UNION ALL ".join(
            f"SELECT '{layer}' AS layer, count(*) AS total_rows FROM {source}"
            for layer, source in (
                ("bronze", "raw"), ("silver", "silver"), ("gold_daily", "daily"),
                ("gold_hourly", "hourly"), ("gold_category", "category"),
            )
        ),
        "bronze_event_dist": _shares("raw", "event_type"),
        "bronze_time_range": """SELECT min(event_time) AS min_time, max(event_time) AS max_time FROM raw""",
        "bronze_top_categories": """SELECT category_code, count(*) AS n FROM raw
          WHERE category_code IS NOT NULL GROUP BY 1 ORDER BY n DESC, category_code LIMIT 5""",
        "bronze_top_categories_10": """SELECT category_code, count(*) AS n FROM raw
          WHERE category_code IS NOT NULL GROUP BY 1 ORDER BY n DESC, category_code LIMIT 10""",
        "bronze_top_brands": """SELECT brand, count(*) AS n FROM raw
          WHERE brand IS NOT NULL GROUP BY 1 ORDER BY n DESC, brand LIMIT 5""",
        "bronze_category_examples": """SELECT DISTINCT category_code FROM raw
          WHERE category_code IS NOT NULL ORDER BY category_code LIMIT 10""",
        "invalid_prices": _PRICES,
        "zero_price_examples": """SELECT event_time, event_type, product_id, brand, price FROM raw
          WHERE price = 0 ORDER BY user_id, product_id, event_type, event_time, brand NULLS FIRST LIMIT 5""",
        "duplicate_examples": """SELECT event_time, event_type, product_id, user_id, price FROM raw
          QUALIFY count(*) OVER (PARTITION BY user_id, product_id, event_type,
                                 date_trunc('second', event_time)) > 1
          ORDER BY user_id, product_id, event_type, event_time, price NULLS FIRST LIMIT 10""",
        "bronze_category_l1_dist": f"""SELECT category_l1, count(*) AS n,
          count(*)::DOUBLE / (SELECT count(*) FROM raw) * 100 AS pct
          FROM ({_ROOTS}) GROUP BY 1 ORDER BY n DESC, category_l1 LIMIT 15""",
        "bronze_category_l1_rarest": f"""SELECT category_l1, count(*) AS n FROM ({_ROOTS}) GROUP BY 1
          ORDER BY n, category_l1 LIMIT 10""",
        "quality_verdicts": f"""SELECT 'duplicates_pct' AS check_name, pct_duplicates AS value,
            CASE WHEN pct_duplicates < 0.1 THEN 'few' WHEN pct_duplicates < 2 THEN 'moderate'
                 ELSE 'significant' END AS verdict FROM ({_DUPLICATES})
          UNION ALL
          SELECT 'bad_prices_pct', pct_zero + pct_negative,
            CASE WHEN pct_zero + pct_negative < 0.1 THEN 'few' ELSE 'filter' END FROM ({_PRICES})
          UNION ALL
          SELECT 'category_roots', count(DISTINCT category_l1)::DOUBLE,
            CASE WHEN count(DISTINCT category_l1) < 20 THEN 'clean' ELSE 'review' END FROM ({_ROOTS})""",
        "session_duration": """SELECT user_session, min(event_time) AS started_at, max(event_time) AS ended_at,
          count(*) AS total_events,
          ((epoch_us(max(event_time)) - epoch_us(min(event_time))) // 1000000)::BIGINT AS duration_seconds
          FROM silver GROUP BY 1""",
        "conversion_paths": """SELECT path, count(*) AS sessions FROM (
            SELECT user_session, string_agg(event_type, '>' ORDER BY first_at,
              list_position(['view', 'cart', 'purchase'], event_type)) AS path
            FROM (SELECT user_session, event_type, min(event_time) AS first_at FROM silver GROUP BY 1, 2)
            GROUP BY 1) GROUP BY 1""",
        "session_paths": """SELECT path, count(*) AS sessions FROM (
            SELECT user_session, string_agg(coalesce(event_type, 'Unknown'), '>' ORDER BY event_time,
              CASE event_type WHEN 'view' THEN 1 WHEN 'cart' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END,
              coalesce(event_type, 'Unknown')) AS path
            FROM silver WHERE user_session IS NOT NULL GROUP BY 1) GROUP BY 1""",
        "anomaly_sessions": f"""SELECT user_session, total_events, round(z, 6) AS z_score FROM (
            SELECT *, (total_events - (SELECT avg(total_events) FROM ({sessions})))
                      / (SELECT stddev_samp(total_events) FROM ({sessions})) AS z FROM ({sessions}))
          WHERE z > 3""",
        "negative_prices": """SELECT event_type, count(*) FILTER (WHERE price < 0) AS negative_rows
          FROM raw GROUP BY 1""",
        "normalized_brands": """SELECT lower(trim(brand)) AS brand_key, count(*) AS n,
          count(DISTINCT brand) AS spellings FROM silver GROUP BY 1""",
        "dim_product": latest,
        "dim_user": """SELECT user_id, min(event_time) AS first_seen, max(event_time) AS last_seen,
          count(*) AS total_events, count(*) FILTER (WHERE event_type = 'purchase') AS total_purchases,
          coalesce(sum(price::DECIMAL(18, 2)) FILTER (WHERE event_type = 'purchase'), 0)::DOUBLE
            AS total_revenue FROM silver GROUP BY 1""",
        "dim_category": f"SELECT category_code, {_LEVELS}, count(*) AS total_events FROM silver GROUP BY ALL",
        "star_revenue": f"""SELECT d.category_l1, d.brand, count(*) AS total_purchases,
          sum(s.price::DECIMAL(18, 2))::DOUBLE AS total_revenue
          FROM silver s JOIN ({latest}) d ON d.product_id = s.product_id
          WHERE s.event_type = 'purchase' GROUP BY 1, 2""",
        "weekly_retention": """SELECT cohort_week, ((week - cohort_week) // 7)::INTEGER AS weeks_later,
          count(*) AS active_users
          FROM (SELECT *, min(week) OVER (PARTITION BY user_id) AS cohort_week
                FROM (SELECT DISTINCT user_id, date_trunc('week', event_time)::DATE AS week FROM silver))
          GROUP BY 1, 2""",
        "schema_check": " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, '{t}' AS expected_type, '{t}' AS actual_type,
            'ok' AS status, count({c}) AS filled_rows FROM silver"""
            for c, t in _SILVER_TYPES.items()
        ),
        # The test tables hold times without a zone.
        "schema_report": " UNION ALL ".join(
            f"""SELECT {i}::INTEGER AS position, '{c}' AS column_name,
            '{t.replace('timestamp', 'timestamp_ntz')}' AS data_type, count({c}) AS filled_rows FROM silver"""
            for i, (c, t) in enumerate(_SILVER_TYPES.items(), 1)
        ),
        "stream_silver_rows": f"""SELECT {_RAW},
          hour(event_time)::INTEGER AS hour, (dayofweek(event_time) + 1)::INTEGER AS day_of_week,
          dayofweek(event_time) IN (0, 6) AS is_weekend,
          CASE WHEN hour(event_time) BETWEEN 6 AND 11 THEN 'morning'
               WHEN hour(event_time) BETWEEN 12 AND 17 THEN 'afternoon'
               WHEN hour(event_time) BETWEEN 18 AND 21 THEN 'evening' ELSE 'night' END AS time_of_day,
          string_split(category_code, '.')[1] AS category_l1,
          string_split(category_code, '.')[2] AS category_l2,
          string_split(category_code, '.')[3] AS category_l3,
          year(event_time)::INTEGER AS year, month(event_time)::INTEGER AS month,
          day(event_time)::INTEGER AS day FROM filled""",
        "stream_dedup": f"SELECT DISTINCT {_RAW} FROM raw",
        "stream_hourly_windows": _closed("valid", "window_end", _windows(
            "valid", "date_trunc('hour', event_time)::TIMESTAMP",
            """CASE WHEN hour(window_start) < 6 THEN 'madrugada' WHEN hour(window_start) < 12 THEN 'mañana'
               WHEN hour(window_start) < 18 THEN 'tarde' ELSE 'noche' END AS time_of_day,""",
        )),
        "stream_daily_upsert": f"SELECT {daily_columns} FROM daily",
        "stream_sliding_traffic": _closed("raw", "window_end", _windows("raw", _QUARTERS)),
        "stream_user_sessions": _closed("raw", "visit_end", """SELECT user_id, min(event_time) AS visit_start,
            max(event_time) + INTERVAL 30 MINUTE AS visit_end, count(*) AS total_events,
            count(*) FILTER (WHERE event_type = 'purchase') AS total_purchases
          FROM (SELECT *, sum(CASE WHEN event_time < last_time + INTERVAL 30 MINUTE THEN 0 ELSE 1 END)
                  OVER (PARTITION BY user_id ORDER BY event_time ROWS UNBOUNDED PRECEDING) AS visit
                FROM (SELECT *, lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time)
                        AS last_time FROM raw))
          GROUP BY user_id, visit"""),
        "stream_category_upsert": """SELECT * EXCLUDE (unique_users, unique_products, revenue_per_user),
          true AS unique_users_close, true AS unique_products_close FROM category""",
        "stream_hourly_distincts": "SELECT count(*) AS windows, true AS unique_users_close, "
        "true AS unique_sessions_close FROM (" + _closed("valid", "window_start + INTERVAL 1 HOUR", """
          SELECT DISTINCT date_trunc('hour', event_time)::TIMESTAMP AS window_start FROM valid""") + ")",
        # The watermark is that of the slower of both streams; a cart's time must lie before it.
        "stream_abandoned_carts": """SELECT user_id, product_id, event_time AS cart_time
          FROM (SELECT DISTINCT user_id, product_id, event_time FROM valid WHERE event_type = 'cart') c
          WHERE NOT EXISTS (SELECT 1 FROM valid p WHERE p.event_type = 'purchase'
              AND p.user_id = c.user_id AND p.product_id = c.product_id AND p.event_time >= c.event_time
              AND p.event_time <= c.event_time + INTERVAL 72 HOUR)
            AND c.event_time + INTERVAL 72 HOUR + INTERVAL 10 MINUTE <= least(
              (SELECT max(event_time) FROM valid WHERE event_type = 'cart'),
              (SELECT max(event_time) FROM valid WHERE event_type = 'purchase'))""",
        "cart_outcomes": _OUTCOMES,
        "abandoned_carts": f"""SELECT date, total_carts, converted_carts, abandoned_carts, open_carts,
            CASE WHEN converted_carts + abandoned_carts > 0
                 THEN abandoned_carts * 100 / (converted_carts + abandoned_carts)::DOUBLE END AS abandonment_pct
          FROM (SELECT event_time::DATE AS date, count(*) AS total_carts,
                  count(*) FILTER (WHERE outcome = 'converted') AS converted_carts,
                  count(*) FILTER (WHERE outcome = 'abandoned') AS abandoned_carts,
                  count(*) FILTER (WHERE outcome = 'open') AS open_carts
                FROM ({_OUTCOMES}) GROUP BY 1)""",
        "product_neighbours": f"SELECT * FROM ({_NEIGHBOURS})",
        "group_anomaly_sessions": f"SELECT * FROM ({_GROUP_ANOMALIES})",
        "dim_product_history": f"""SELECT product_id, version, valid_from, valid_to,
          valid_to IS NULL AS is_current, category_code, brand, price_level FROM ({_HISTORY})""",
        "star_revenue_as_of": f"""SELECT string_split(v.category_code, '.')[1] AS category_l1, v.brand,
            v.price_level, count(*) AS total_purchases, sum(s.price::DECIMAL(18, 2))::DOUBLE AS total_revenue
          FROM silver s JOIN ({_HISTORY}) v ON v.product_id = s.product_id
            AND s.event_time::DATE >= v.valid_from AND (v.valid_to IS NULL OR s.event_time::DATE < v.valid_to)
          WHERE s.event_type = 'purchase' GROUP BY 1, 2, 3""",
        "gold_grains": _grains(),
        "gold_weekly_sketched": f"""SELECT * EXCLUDE (unique_users, unique_sessions, unique_products,
            events_per_user, purchases_per_user),
          true AS unique_users_close, true AS unique_sessions_close, true AS unique_products_close
          FROM ({_period_fact("week")})""",
        "stream_running_stage": """SELECT user_id, product_id,
          CASE max(CASE event_type WHEN 'purchase' THEN 2 WHEN 'cart' THEN 1 ELSE 0 END)
            WHEN 2 THEN 'purchased' WHEN 1 THEN 'added_to_cart' ELSE 'viewed_only' END AS conversion_stage
          FROM raw GROUP BY 1, 2""",
    }


# Further named parts some texts need after the shared ones.
_EXTRA = {
    "peak_hours": f"p AS ({_pattern('hour')})",
    "time_of_day_winners": f"b AS ({_BANDS})",
    "top5_category_share": "five AS (SELECT * FROM category ORDER BY total_revenue DESC, category_l1 LIMIT 5)",
}


#: What is read back from a written layer is what its query computes.
_READ_BACK = {
    "stream_expiring_stage": "stream_running_stage",
    "csv_round_trip": "bronze_partitions",
    "bronze_written": "bronze_partitions",
    "silver_written": "silver_events",
    "silver_by_week": "silver_events",
    "gold_daily_written": "gold_daily",
    "gold_hourly_written": "gold_hourly",
    "gold_category_written": "gold_category",
}


def oracle_sql() -> dict[str, str]:
    texts = {}
    for name, body in _bodies().items():
        extra = f", {_EXTRA[name]}\n" if name in _EXTRA else ""
        texts[name] = f"{_SHARED.rstrip()}{extra}\n{body}"
    return texts | {name: texts[same] for name, same in _READ_BACK.items()}
