"""Plain SQL for every registered query, for an independent engine over the same Parquet
tables. The statements take the direct route (distinct counts, joins, NTILE) where the
Spark operators take rollups, so that agreement checks the rewriting too.
"""

from __future__ import annotations

from shopflow import fixed_values as fv
from shopflow.operators import deep_dive as dd
from shopflow.plans import registry as q


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def rounded(value: str, digits: int) -> str:
    """Half-up rounding on decimals: rounding doubles differs between engines at ties."""
    return f"CAST(ROUND(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str, digits: int = 2) -> str:
    return rounded(f"CAST({part} AS DOUBLE) * 100.0 / NULLIF({whole}, 0)", digits)


def whole(value: str) -> str:
    return f"CAST({value} AS BIGINT)"


def dec(column: str = "price") -> str:
    return f"CAST({column} AS DECIMAL(18,2))"


def dbl(value: str) -> str:
    return f"CAST({value} AS DOUBLE)"


def labelled(column: str, steps, last: str) -> str:
    arms = " ".join(f"WHEN {column} < {bound} THEN {text(str(name))}" for bound, name in steps)
    return f"CASE {arms} ELSE {text(last)} END"


def ordered(column: str, steps) -> str:
    arms = " ".join(f"WHEN {column} < {bound} THEN {i}" for i, (bound, _) in enumerate(steps, 1))
    return f"CASE {arms} ELSE {len(steps) + 1} END"


def half_month(day: str) -> str:
    first = f"CAST(date_trunc('month', {day}) AS DATE)"
    return f"CASE WHEN day({day}) <= 15 THEN {first} ELSE {first} + 15 END"


BUYS = "FILTER (WHERE event_type = 'purchase')"
VIEWS = "FILTER (WHERE event_type = 'view')"
CARTS = "FILTER (WHERE event_type = 'cart')"
SALES = f"COALESCE(SUM({dec()}) {BUYS}, 0)"
BLANK = "(category_code IS NULL OR category_code = '')"
PAIR = "user_session || '-' || CAST(product_id AS VARCHAR)"

CTES: dict[str, str] = {}

CTES["delivered"] = """
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
  UNION ALL
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
  WHERE event_id % 50 = 0"""

CTES["bronze"] = """
  SELECT CAST(d.ts AS VARCHAR) AS event_time,
         CASE d.event_type WHEN 'click' THEN 'cart' ELSE d.event_type END AS event_type,
         CAST(p.p_partkey AS VARCHAR) AS product_id,
         CAST(p.p_size AS VARCHAR) AS category_id,
         CASE p.p_type WHEN 'PROMO' THEN ''
              ELSE lower(p.p_type) || '.' || split_part(p.p_name, ' ', 2) END AS category_code,
         CASE p.p_size % 7 WHEN 0 THEN '' ELSE p.p_brand END AS brand,
         CAST(CAST(CASE d.event_id % 97 WHEN 0 THEN 0.0 ELSE d.value * 4 END AS DECIMAL(18,2))
              AS VARCHAR) AS price,
         CAST(d.user_id AS VARCHAR) AS user_id,
         CAST(d.user_id AS VARCHAR) || '-' || CAST(CAST(floor(
           date_diff('day', DATE '2024-01-01', CAST(d.ts AS DATE)) / 3) AS BIGINT) AS VARCHAR)
           AS user_session
  FROM delivered d JOIN part p ON p.p_partkey = d.k"""

CTES["fact"] = """
  SELECT DISTINCT TRY_CAST(event_time AS TIMESTAMP) AS event_time,
         CAST(TRY_CAST(event_time AS TIMESTAMP) AS DATE) AS event_date,
         event_type, TRY_CAST(product_id AS BIGINT) AS product_id,
         TRY_CAST(category_id AS BIGINT) AS category_id, category_code,
         CASE WHEN brand IS NULL OR brand = '' THEN 'unknown' ELSE brand END AS brand,
         TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(user_id AS BIGINT) AS user_id, user_session
  FROM bronze
  WHERE event_time IS NOT NULL AND user_session IS NOT NULL
    AND event_type IN ('view', 'cart', 'purchase', 'remove_from_cart')"""

CTES["sess"] = f"""
  SELECT user_session, min(user_id) AS user_id, min(event_time) AS session_start,
         max(event_time) AS session_end, count(*) AS event_count,
         count(DISTINCT product_id) AS distinct_products,
         bool_or(event_type = 'view') AS has_view, bool_or(event_type = 'cart') AS has_cart,
         bool_or(event_type = 'purchase') AS has_purchase, {dbl(SALES)} AS session_revenue
  FROM fact GROUP BY user_session"""

CTES["product"] = """
  SELECT TRY_CAST(product_id AS BIGINT) AS product_id,
         TRY_CAST(category_id AS BIGINT) AS category_id, category_code,
         CASE WHEN category_code IS NULL OR category_code = '' THEN 'unknown'
              ELSE category_code END AS category_code_clean,
         string_split(category_code, '.')[1] AS category_l1,
         string_split(category_code, '.')[2] AS category_l2, brand,
         CASE WHEN brand IS NULL OR brand = '' THEN 'unknown' ELSE brand END AS brand_clean,
         TRY_CAST(price AS DOUBLE) AS price
  FROM bronze
  WHERE TRY_CAST(product_id AS BIGINT) IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY TRY_CAST(product_id AS BIGINT)
    ORDER BY bronze.event_time DESC NULLS LAST, bronze.category_id DESC NULLS LAST,
    bronze.category_code DESC NULLS LAST, bronze.brand DESC NULLS LAST,
    bronze.price DESC NULLS LAST) = 1"""

CTES["daily"] = f"""
  SELECT event_date, count(DISTINCT user_id) AS unique_users,
         count(DISTINCT user_session) AS sessions,
         count(DISTINCT {PAIR}) {VIEWS} AS product_views,
         count(DISTINCT user_session) {CARTS} AS sessions_with_cart,
         count(DISTINCT user_session) {BUYS} AS sessions_with_purchase,
         {dbl(SALES)} AS revenue, count(*) {BUYS} AS purchase_events,
         {pct(f"count(DISTINCT user_session) {BUYS}", "count(DISTINCT user_session)")}
           AS conversion_rate_pct
  FROM fact GROUP BY event_date"""

CTES["stages"] = """
  SELECT count(*) AS total_sessions,
         count(*) FILTER (WHERE has_view OR has_cart OR has_purchase) AS sessions_with_view,
         count(*) FILTER (WHERE has_cart OR has_purchase) AS sessions_with_cart,
         count(*) FILTER (WHERE has_purchase) AS sessions_with_purchase,
         count(*) FILTER (WHERE has_cart) AS sessions_cart_logged,
         count(*) FILTER (WHERE has_purchase AND NOT has_cart) AS purchases_missing_cart_event
  FROM sess"""

CTES["funnel"] = f"""
  SELECT *, {pct("sessions_with_cart", "sessions_with_view")} AS view_to_cart_pct,
         {pct("sessions_with_purchase", "sessions_with_cart")} AS cart_to_purchase_pct,
         {pct("sessions_with_purchase", "sessions_with_view")} AS view_to_purchase_pct
  FROM stages"""

CTES["abandoned"] = f"""
  SELECT event_date, count(DISTINCT user_session) AS abandoned_sessions,
         count(DISTINCT user_id) AS affected_users,
         {dbl(f"SUM({dec()})")} AS abandoned_cart_value
  FROM (SELECT DISTINCT f.event_date, f.user_session, f.user_id, f.product_id, f.price
        FROM fact f JOIN sess s USING (user_session)
        WHERE f.event_type = 'cart' AND NOT s.has_purchase)
  GROUP BY event_date"""

CTES["categories"] = f"""
  SELECT CASE WHEN {BLANK} THEN 'unknown' ELSE category_code END AS category_code,
         count(DISTINCT {PAIR}) {VIEWS} AS views, count(DISTINCT {PAIR}) {CARTS} AS carts,
         count(*) {BUYS} AS purchases, {dbl(SALES)} AS revenue,
         {pct(f"count(*) {BUYS}", f"count(DISTINCT {PAIR}) {VIEWS}")} AS view_to_purchase_pct
  FROM fact GROUP BY 1"""

CTES["brands"] = f"""
  SELECT brand, count(DISTINCT {PAIR}) {VIEWS} AS views, count(*) {BUYS} AS purchases,
         {dbl(SALES)} AS revenue,
         {rounded(f"{dbl(SALES)} / NULLIF(count(price) {BUYS}, 0)", 2)} AS avg_order_value
  FROM fact WHERE brand <> 'unknown' GROUP BY brand"""

CTES["top100"] = f"""
  SELECT product_id, min(category_code) AS category_code, min(brand) AS brand,
         count(*) {VIEWS} AS views, count(*) {BUYS} AS purchases, {dbl(SALES)} AS revenue
  FROM fact GROUP BY product_id ORDER BY {SALES} DESC, product_id LIMIT 100"""

CTES["users"] = f"""
  SELECT user_id, count(DISTINCT user_session) AS total_sessions,
         max(event_date) AS last_active_date,
         CAST(max(event_date) - min(event_date) AS INTEGER) AS active_span_days,
         count(*) {BUYS} AS purchase_count, {dbl(SALES)} AS total_spend
  FROM fact GROUP BY user_id"""

CTES["hours"] = f"""
  SELECT CAST(hour(event_time) AS INTEGER) AS hour_of_day,
         count(DISTINCT user_session) AS sessions, count(*) {BUYS} AS purchases,
         {dbl(SALES)} AS revenue
  FROM fact GROUP BY 1"""

CTES["interest"] = f"""
  SELECT user_id, product_id, count(*) {VIEWS} AS views,
         bool_or(event_type = 'purchase') AS bought, max(price) AS price
  FROM fact WHERE event_type IN ('view', 'purchase') GROUP BY user_id, product_id"""


def _intent(steps, last: str) -> str:
    return f"""
  SELECT {labelled("views", steps, last)} AS view_band,
         CAST({ordered("views", steps)} AS INTEGER) AS band_order,
         count(*) AS user_product_pairs, count(*) FILTER (WHERE bought) AS converted,
         {pct("count(*) FILTER (WHERE bought)", "count(*)")} AS conversion_pct,
         count(*) FILTER (WHERE NOT bought) AS unconverted_pairs,
         {dbl(f"ROUND(COALESCE(SUM({dec()}) FILTER (WHERE NOT bought), 0), 0)")}
           AS unconverted_value
  FROM interest WHERE views > 0 GROUP BY 1, 2"""


CTES["intent"] = _intent(fv.INTENT_STEPS, fv.INTENT_LAST)
CTES["intent_custom"] = _intent(q.INTENT, q.INTENT_TOP)

CTES["price_bands"] = f"""
  SELECT {labelled("price", fv.PRICE_STEPS, fv.PRICE_LAST)} AS price_band,
         count(*) AS carted_items, count(*) FILTER (WHERE bought) AS purchased,
         {pct("count(*) FILTER (WHERE bought)", "count(*)", 1)} AS cart_conversion_pct,
         {dbl(f"ROUND(COALESCE(SUM({dec()}) FILTER (WHERE NOT bought), 0), 0)")}
           AS abandoned_value
  FROM (SELECT user_session, product_id, max(price) AS price,
               bool_or(event_type = 'purchase') AS bought
        FROM fact WHERE event_type IN ('cart', 'purchase')
        GROUP BY user_session, product_id HAVING bool_or(event_type = 'cart'))
  GROUP BY 1"""

CTES["anchors"] = f"""
  SELECT DISTINCT user_session FROM fact
  WHERE event_type = 'purchase' AND category_code = '{q.ANCHOR}'"""

CTES["extras"] = f"""
  SELECT * FROM fact
  WHERE event_type = 'purchase' AND NOT {BLANK} AND category_code <> '{q.ANCHOR}'
    AND user_session IN (SELECT user_session FROM anchors)"""

CTES["attach"] = f"""
  SELECT category_code AS attached_category, count(DISTINCT user_session) AS sessions,
         {pct("count(DISTINCT user_session)", "(SELECT count(*) FROM anchors)", 3)}
           AS pct_of_phone_buyers,
         {rounded(f"{dbl(f'SUM({dec()})')} / NULLIF(count(price), 0)", 2)} AS avg_price,
         {dbl(f"ROUND(SUM({dec()}), 0)")} AS revenue
  FROM extras GROUP BY category_code"""

CTES["attach_rate"] = f"""
  SELECT count(DISTINCT a.user_session) AS anchor_sessions,
         count(DISTINCT e.user_session) AS attached_sessions,
         {pct("count(DISTINCT e.user_session)", "count(DISTINCT a.user_session)")} AS attach_pct
  FROM anchors a LEFT JOIN extras e USING (user_session)"""

CTES["product_day"] = f"""
  SELECT product_id, event_date,
         {rounded(f"{dbl(f'SUM({dec()})')} / NULLIF(count(price), 0)", 2)} AS avg_price,
         count(*) {BUYS} AS purchases, count(*) {VIEWS} AS views
  FROM fact GROUP BY product_id, event_date"""

CTES["moves"] = """
  SELECT *, CASE WHEN avg_price < prev_price * CAST(0.95 AS DOUBLE) THEN 'price cut >5%'
                 WHEN avg_price > prev_price * CAST(1.05 AS DOUBLE) THEN 'price rise >5%'
                 ELSE 'stable' END AS price_move
  FROM (SELECT *, lag(avg_price) OVER (PARTITION BY product_id ORDER BY event_date) AS prev_price
        FROM product_day)
  WHERE prev_price > 0"""

CTES["cuts"] = "SELECT * FROM moves WHERE price_move = 'price cut >5%'"

CTES["ranges"] = "SELECT l_partkey, min(l_orderkey) AS lo, max(l_orderkey) AS hi FROM lineitem GROUP BY l_partkey"

CTES["cut_counts"] = """
  SELECT event_date, count(DISTINCT product_id) AS products_cut FROM cuts GROUP BY event_date"""

CTES["tiered"] = f"""
  SELECT c.*, CASE WHEN n.products_cut >= {q.MEGA} THEN {text(fv.TIER_MEGA)}
                   WHEN n.products_cut >= {q.ELEVATED} THEN {text(fv.TIER_ELEVATED)}
                   ELSE {text(fv.TIER_BACKGROUND)} END AS sale_day_tier
  FROM cuts c JOIN cut_counts n USING (event_date)"""

_MOVE_SUMS = f"""count(*) AS product_days, {whole("SUM(views)")} AS views,
         {whole("SUM(purchases)")} AS purchases, {pct("SUM(purchases)", "SUM(views)")}
           AS conversion_pct"""
_TIER_SUMS = f"""count(DISTINCT event_date) AS days, {whole("SUM(purchases)")} AS purchases,
         {whole("SUM(views)")} AS views, {pct("SUM(purchases)", "SUM(views)")} AS conversion_pct"""

CTES["buyers"] = f"""
  SELECT user_id, CAST(DATE '{q.RECENCY}' - max(event_date) AS INTEGER) AS recency_days,
         count(DISTINCT user_session) AS frequency, {SALES} AS monetary
  FROM fact WHERE user_id IS NOT NULL GROUP BY user_id HAVING {SALES} > 0"""

CTES["scored"] = """
  SELECT *, ntile(4) OVER (ORDER BY recency_days DESC NULLS LAST,
    substr(md5(CAST(user_id AS VARCHAR)), 1, 3), user_id) AS recency_score
  FROM buyers"""


def _check(name: str, table: str, hit: str, base: str = "true") -> str:
    description, impact = fv.QUALITY_TEXTS[name]
    hits, of = f"count(*) FILTER (WHERE {hit})", f"count(*) FILTER (WHERE {base})"
    return f"""
  SELECT '{name}' AS check_name, {text(description)} AS description, {hits} AS affected_rows,
         {pct(hits, of)} AS pct_affected, {text(impact)} AS business_impact FROM {table}"""


CTES["checks"] = "\n  UNION ALL".join(
    (
        _check("missing_category_code", "bronze", BLANK),
        _check("missing_brand", "bronze", "brand IS NULL OR brand = ''"),
        _check("purchase_without_cart", "sess", "has_purchase AND NOT has_cart", "has_purchase"),
        _check("purchase_without_view", "sess", "has_purchase AND NOT has_view", "has_purchase"),
        _check("zero_or_negative_price", "fact", "price <= 0"),
        _check(
            "multiday_sessions", "sess", "session_end > session_start + INTERVAL 24 HOURS"
        ),
    )
)

_HISTORY = ("unique_users", "sessions", "revenue", "purchase_events", "conversion_rate_pct")
CTES["history"] = "\n  UNION ALL".join(
    f"""
  SELECT '{m}' AS metric_name, {dbl(m)} AS value, event_date AS snapshot_day,
         CAST(event_date AS VARCHAR) AS run_id FROM daily"""
    for m in _HISTORY
)

CTES["previous"] = f"""
  SELECT metric_name, value FROM history WHERE run_id <> '{q.LAST_RUN}'
  QUALIFY row_number() OVER (PARTITION BY metric_name ORDER BY snapshot_day DESC) = 1"""

_REASONS = {
    "cart_gap": "most of the funnel''s cart stage would be inferred, not measured",
    "stale_gold": "more than one scheduled refresh was missed",
    "unlabeled_category": "category rankings would leave out too much of the catalogue",
}


def _alert(name: str, value: str, threshold: float) -> str:
    return f"""
  SELECT '{name}' AS alert_name, {dbl(value)} AS value, {dbl(threshold)} AS threshold,
         COALESCE({value} > {threshold}, false) AS breached, '{_REASONS[name]}' AS reason"""


CTES["cart_gap"] = (
    _alert("cart_gap", "pct_affected", fv.CART_GAP_LIMIT)
    + " FROM checks WHERE check_name = 'purchase_without_cart'"
)
CTES["stale_gold"] = (
    _alert(
        "stale_gold",
        f"date_diff('hour', CAST(max(event_date) AS TIMESTAMP), TIMESTAMP '{q.AS_OF}')",
        fv.STALE_HOURS_LIMIT,
    )
    + " FROM daily"
)
CTES["unlabeled"] = (
    _alert("unlabeled_category", "pct_affected", fv.UNLABELED_LIMIT)
    + " FROM checks WHERE check_name = 'missing_category_code'"
)


def _metric(name: str, value: str, source: str) -> str:
    return f"SELECT '{name}' AS metric_name, {dbl(value)} AS value FROM {source}"


_METRICS = "\nUNION ALL ".join(
    (
        _metric("bronze_row_count", "count(*)", "bronze"),
        _metric("view_to_cart_pct", "view_to_cart_pct", "funnel"),
        _metric("cart_to_purchase_pct", "cart_to_purchase_pct", "funnel"),
        _metric("view_to_purchase_pct", "view_to_purchase_pct", "funnel"),
        _metric(
            "dq_purchase_without_cart_pct",
            "pct_affected",
            "checks WHERE check_name = 'purchase_without_cart'",
        ),
        _metric(
            "dq_missing_category_pct",
            "pct_affected",
            "checks WHERE check_name = 'missing_category_code'",
        ),
        _metric("dq_missing_brand_pct", "pct_affected", "checks WHERE check_name = 'missing_brand'"),
        _metric("total_revenue", f"ROUND(SUM({dec('revenue')}), 0)", "daily"),
        _metric("total_sessions", "SUM(sessions)", "daily"),
        _metric(
            "abandoned_cart_value", f"ROUND(SUM({dec('abandoned_cart_value')}), 0)", "abandoned"
        ),
    )
)


def _primary_key(name: str, table: str, *keys: str) -> str:
    null = " OR ".join(f"{k} IS NULL" for k in keys)
    key = ", ".join(keys)
    return f"""
SELECT '{name}' AS check_name, {whole("COALESCE(SUM(n), 0)")} AS row_count,
       {whole(f"COALESCE(SUM(n) FILTER (WHERE {null}), 0)")} AS null_key_rows,
       count(*) FILTER (WHERE NOT ({null}) AND n > 1) AS duplicated_keys,
       {whole(f"COALESCE(SUM(n - 1) FILTER (WHERE NOT ({null})), 0)")} AS surplus_rows
FROM (SELECT {key}, count(*) AS n FROM {table} GROUP BY {key})"""


def _foreign_key(name: str, child: str, key: str, parent: str, parent_key: str) -> str:
    return f"""
SELECT '{name}' AS check_name, count(DISTINCT {key}) AS orphan_keys, count(*) AS orphan_rows
FROM {child} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {parent_key} FROM {parent})"""


def _domain(name: str, table: str) -> str:
    allowed = "('view', 'cart', 'purchase', 'remove_from_cart')"
    return f"""
SELECT '{name}' AS check_name, count(*) AS row_count,
       count(*) FILTER (WHERE event_type NOT IN {allowed}) AS violations FROM {table}"""


def _monthly_sessions(columns: str, where: str = "true") -> str:
    day = "CAST(session_start AS DATE)"
    return f"""
SELECT {half_month(day)} AS period, {columns} FROM sess WHERE {where} GROUP BY 1"""


def top(source: str, n: int, by: str, tie: str, columns: str = "*") -> str:
    return f"SELECT {columns} FROM {source} ORDER BY {by} DESC, {tie} LIMIT {n}"


BODIES: dict[str, str] = {
    "bronze_events": "SELECT * FROM bronze",
    "bronze_ingest": """SELECT * REPLACE (NULLIF(category_code, '') AS category_code,
      NULLIF(brand, '') AS brand) FROM bronze""",
    "bronze_evolving": f"""SELECT * EXCLUDE late REPLACE (NULLIF(category_code, '') AS category_code,
      NULLIF(brand, '') AS brand), CASE WHEN late THEN 'spring' END AS campaign,
      CASE WHEN late THEN '2024-02' ELSE '2024-01' END AS month
      FROM (SELECT *, event_time >= '{q.LATE_FROM}'
            OR CAST(product_id AS BIGINT) % {q.LATE_PRODUCTS} = 1 AS late FROM bronze)""",
    "incremental_fact_events":
        "SELECT * REPLACE (NULLIF(category_code, '') AS category_code) FROM fact",
    "incremental_dim_product": """SELECT * REPLACE (NULLIF(category_code, '') AS category_code,
      NULLIF(category_l1, '') AS category_l1, NULLIF(brand, '') AS brand) FROM product""",
    "incremental_dim_session": "SELECT * FROM sess",
    "incremental_daily_metrics": "SELECT * FROM daily",
    "incremental_cart_abandonment": "SELECT * FROM abandoned",
    "fact_events": "SELECT * FROM fact",
    "clustered_fact": "SELECT * FROM fact",
    "compacted_fact": "SELECT * FROM fact",
    "dim_product": "SELECT * FROM product",
    "dim_session": "SELECT * FROM sess",
    "daily_metrics": "SELECT * FROM daily",
    "funnel": "SELECT * FROM funnel",
    "cart_abandonment": "SELECT * FROM abandoned",
    "category_performance": "SELECT * FROM categories",
    "brand_performance": "SELECT * FROM brands",
    "top_products": "SELECT * FROM top100",
    "user_summary": "SELECT * FROM users",
    "hourly_pattern": "SELECT * FROM hours",
    "intent_by_view_depth": "SELECT * FROM intent",
    "intent_custom_bands": "SELECT * FROM intent_custom",
    "cart_conversion_by_price": "SELECT * FROM price_bands",
    "attach_opportunity": "SELECT * FROM attach",
    "price_change_effect": f"SELECT price_move, {_MOVE_SUMS} FROM moves GROUP BY price_move",
    "category_recovery_check": f"""
SELECT *, CASE recoverable_ids WHEN 0 THEN {text(fv.RECOVERY_NONE)}
               ELSE {text(fv.RECOVERY_PARTIAL)} END AS verdict
FROM (SELECT
  (SELECT count(*) FROM (SELECT DISTINCT category_id FROM fact WHERE {BLANK}))
    AS category_ids_with_blank_code,
  (SELECT count(*) FROM (SELECT DISTINCT category_id FROM fact WHERE NOT {BLANK}))
    AS category_ids_with_known_code,
  (SELECT count(*) FROM (SELECT category_id FROM fact WHERE {BLANK}
                         INTERSECT SELECT category_id FROM fact WHERE NOT {BLANK}))
    AS recoverable_ids)""",
    "discount_tier_analysis": f"""
SELECT {half_month("event_date")} AS month, sale_day_tier, {_TIER_SUMS} FROM tiered GROUP BY 1, 2""",
    "tier_limits": f"""SELECT count(*) AS days, quantile_disc(products_cut, {dd.MEGA_SHARE}) AS mega_cuts,
       quantile_disc(products_cut, {dd.ELEVATED_SHARE}) AS elevated_cuts FROM cut_counts""",
    "quantile_tier_analysis": f"""
SELECT {half_month("event_date")} AS month, sale_day_tier, {_TIER_SUMS}
FROM (SELECT c.*, CASE WHEN products_cut >= (SELECT quantile_disc(products_cut, {dd.MEGA_SHARE}) FROM cut_counts)
                       THEN {text(fv.TIER_MEGA)}
                       WHEN products_cut >= (SELECT quantile_disc(products_cut, {dd.ELEVATED_SHARE}) FROM cut_counts)
                       THEN {text(fv.TIER_ELEVATED)} ELSE {text(fv.TIER_BACKGROUND)} END AS sale_day_tier
      FROM cuts c JOIN cut_counts USING (event_date)) GROUP BY 1, 2""",
    "cohort_triangle": f"""
SELECT cohort, period_offset, cohort_users, users, purchases, revenue,
       {pct("users", "cohort_users")} AS retained_pct
FROM (SELECT *, max(users) FILTER (WHERE period_offset = 0) OVER (PARTITION BY cohort) AS cohort_users
      FROM (SELECT cohort, CAST(date_diff('day', cohort, week) // 7 AS INTEGER) AS period_offset,
                   count(DISTINCT user_id) AS users, count(*) AS purchases,
                   {dbl(f"SUM({dec()})")} AS revenue
            FROM (SELECT user_id, price, CAST(date_trunc('week', event_date) AS DATE) AS week
                  FROM fact WHERE event_type = 'purchase')
            JOIN (SELECT user_id, CAST(date_trunc('week', min(event_date)) AS DATE) AS cohort
                  FROM fact WHERE event_type = 'purchase' GROUP BY user_id) USING (user_id)
            GROUP BY 1, 2))""",
    "merged_small_files": "SELECT * FROM fact",
    "interleaved_fact": "SELECT * FROM fact",
    "interleaved_skipping": "SELECT count(DISTINCT product_id) AS products, true AS at_most_half FROM fact",
    "file_overlap": f"""
SELECT count(*) AS ranges, max(depth) AS max_depth, {rounded("avg(depth)", 4)} AS mean_depth,
       {rounded("1 - (avg(depth) - 1) / (count(*) - 1)", 4)} AS quality
FROM (SELECT a.l_partkey, count(*) AS depth FROM ranges a JOIN ranges b ON a.lo BETWEEN b.lo AND b.hi
      GROUP BY a.l_partkey)""",
    "sale_tier_totals": f"SELECT sale_day_tier, {_TIER_SUMS} FROM tiered GROUP BY 1",
    "top_cut_days": top("cut_counts", 10, "products_cut", "event_date"),
    "cohort_behavior": f"""
SELECT CASE WHEN u.first_date < DATE '{q.COHORT_SPLIT}' THEN {text(fv.COHORT_RETURNING)}
            ELSE {text(fv.COHORT_NEW)} END AS user_cohort,
       count(DISTINCT f.user_id) AS users, count(*) {VIEWS} AS views, count(*) {BUYS} AS purchases,
       {pct(f"count(*) {BUYS}", f"count(*) {VIEWS}")} AS conversion_pct
FROM fact f JOIN (SELECT user_id, min(event_date) AS first_date FROM fact GROUP BY user_id) u
  USING (user_id)
WHERE f.event_date >= DATE '{q.COHORT_SPLIT}' GROUP BY 1""",
    "rfm_scores": """
SELECT user_id, recency_days, frequency, monetary, CAST(recency_score AS INTEGER) AS recency_score,
       CAST(ntile(4) OVER (ORDER BY frequency, substr(md5(CAST(user_id AS VARCHAR)), 1, 3), user_id)
         AS INTEGER) AS frequency_score,
       CAST(ntile(4) OVER (ORDER BY monetary, substr(md5(CAST(user_id AS VARCHAR)), 1, 3), user_id)
         AS INTEGER) AS monetary_score
FROM (SELECT * REPLACE (CAST(monetary AS DOUBLE) AS monetary) FROM scored)""",
    "rfm_segmentation": f"""
SELECT CAST(recency_score AS INTEGER) AS recency_score, count(*) AS buyers,
       {rounded("avg(recency_days)", 1)} AS avg_recency_days,
       {rounded("avg(frequency)", 1)} AS avg_sessions,
       {rounded(f"{dbl('SUM(monetary)')} / count(*)", 0)} AS avg_spend
FROM scored GROUP BY recency_score""",
    "buyer_retention": f"""
SELECT *, {pct("returned", "period_1_buyers")} AS pct_returned
FROM (SELECT count(DISTINCT user_id) AS period_1_buyers,
             count(DISTINCT user_id) FILTER (WHERE user_id IN
               (SELECT user_id FROM fact WHERE event_type = 'purchase'
                  AND event_date >= DATE '{q.RETENTION_SPLIT}')) AS returned
      FROM fact
      WHERE event_type = 'purchase' AND event_date < DATE '{q.RETENTION_SPLIT}')""",
    "data_quality": "SELECT * FROM checks",
    "layer_reconciliation": """
SELECT *, accepted_rows - fact_rows AS duplicate_rows
FROM (SELECT (SELECT count(*) FROM bronze) AS bronze_rows,
  (SELECT count(*) FROM bronze WHERE event_time IS NULL OR user_session IS NULL)
    AS rows_without_key,
  (SELECT count(*) FROM bronze WHERE event_type IN ('signup', 'error')) AS rows_other_event_type,
  (SELECT count(*) FROM bronze WHERE event_type IN ('view', 'cart', 'purchase')) AS accepted_rows,
  (SELECT count(*) FROM bronze WHERE TRY_CAST(event_time AS TIMESTAMP) IS NULL
     OR TRY_CAST(price AS DOUBLE) IS NULL) AS rows_with_malformed_text,
  (SELECT count(*) FROM fact) AS fact_rows, (SELECT count(*) FROM sess) AS session_rows,
  (SELECT count(*) FROM product) AS product_rows)""",
    "metrics_snapshot": _METRICS,
    "previous_metrics": "SELECT * FROM previous",
    "metric_drift": f"""
SELECT metric_name, p.value AS previous_value, c.value AS current_value,
       CASE WHEN p.value = 0 AND c.value = 0 THEN 0.0 WHEN p.value = 0 THEN 'Infinity'::DOUBLE
            ELSE (c.value - p.value) / p.value * 100 END AS pct_change,
       CASE WHEN c.value IS NULL THEN 'error' WHEN p.value IS NULL THEN 'baseline'
            WHEN abs((c.value - p.value) / p.value * 100) >= {fv.DRIFT_THRESHOLD_PCT} THEN 'drift'
            ELSE 'ok' END AS status
FROM (SELECT metric_name, value FROM history WHERE run_id = '{q.LAST_RUN}') c
LEFT JOIN previous p USING (metric_name)""",
    "alert_cart_gap": "SELECT * FROM cart_gap",
    "alert_stale_gold": "SELECT * FROM stale_gold",
    "alert_unlabeled_category": "SELECT * FROM unlabeled",
    "evaluate_alerts": """SELECT * FROM cart_gap UNION ALL SELECT * FROM stale_gold
UNION ALL SELECT * FROM unlabeled""",
    "primary_key_check": _primary_key("dim_product", "product", "product_id")
    + "\nUNION ALL"
    + _primary_key("dim_session", "sess", "user_session")
    + "\nUNION ALL"
    + _primary_key("lineitem", "lineitem", "l_orderkey", "l_linenumber"),
    "foreign_key_check": "\nUNION ALL".join(
        (
            _foreign_key("fact_product", "fact", "product_id", "product", "product_id"),
            _foreign_key("fact_session", "fact", "user_session", "sess", "user_session"),
            _foreign_key("lineitem_part", "lineitem", "l_partkey", "part", "p_partkey"),
            _foreign_key("part_seen", "part", "p_partkey", "product", "product_id"),
        )
    ),
    "domain_check": _domain("bronze_events", "bronze")
    + "\nUNION ALL"
    + _domain("fact_events", "fact"),
    "mask_user_id": """
SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT user_id) AS masked_users,
       count(user_id) AS unmasked_rows FROM fact GROUP BY event_type""",
    "pii_inventory": """
SELECT * FROM (SELECT 'ecommerce' AS catalog_name, lower(p_type) AS schema_name,
         p_name AS table_name, p_brand AS column_name,
         max(CAST(p_size AS VARCHAR)) FILTER (WHERE p_size < 15) AS pii_class,
         max(CAST(p_size AS VARCHAR)) FILTER (WHERE p_size >= 15 AND p_size < 35) AS sensitivity
  FROM part GROUP BY ALL)
WHERE pii_class IS NOT NULL""",
    "daily_dbu_cost": f"""
SELECT CAST(l_shipdate AS DATE) AS usage_date, l_returnflag AS sku_name,
       l_linestatus AS usage_unit,
       {dbl("ROUND(SUM(CAST(l_quantity * l_discount AS DECIMAL(28,6))), 2)")} AS dbus,
       count(DISTINCT l_suppkey) AS warehouses
FROM lineitem WHERE CAST(l_shipdate AS DATE) >= DATE '2001-11-05' - 3000 GROUP BY 1, 2, 3""",
    "expensive_queries": f"""
SELECT left(regexp_replace(text, '\\s+', ' ', 'g'), 160) AS statement_preview,
       count(*) AS executions, {rounded("SUM(n_chars) / 1000.0", 1)} AS total_seconds,
       {rounded("SUM(n_chars) / count(*) / 1000.0", 2)} AS avg_seconds,
       {rounded("SUM(n_chars) / 1000.0", 2)} AS total_gb_read,
       {rounded("SUM(doc_id) / count(*)", 0)} AS avg_rows_read
FROM documents WHERE lang = 'en' GROUP BY 1 HAVING SUM(n_chars) > 5000
ORDER BY SUM(n_chars) DESC, statement_preview LIMIT 50""",
    "job_runs": f"""
SELECT run_id, started_at, ended_at,
       {rounded("(epoch(ended_at) - epoch(started_at)) / 60.0", 1)} AS duration_min,
       result_state, termination_code
FROM (SELECT o_orderkey AS run_id, o_custkey, o_orderdate AS started_at,
             o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT)) AS ended_at,
             o_orderstatus AS result_state, o_orderpriority AS termination_code FROM orders)
JOIN customer ON c_custkey = o_custkey AND c_custkey // 100 = o_custkey // 100
WHERE c_mktsegment = 'BUILDING' ORDER BY started_at DESC, run_id LIMIT 50""",
    "table_usage": """
SELECT 'ecommerce.' || CASE WHEN event_type IN ('view', 'purchase') THEN 'gold' ELSE 'silver' END
         || '.' || event_type AS table_name,
       count(*) AS read_events, count(DISTINCT user_id) AS distinct_users, max(ts) AS last_read
FROM events WHERE event_type <> 'error' AND ts >= TIMESTAMP '2024-01-01' GROUP BY 1""",
    "dash_funnel": "SELECT * FROM funnel",
    "dash_daily": "SELECT * FROM daily",
    "dash_funnel_stages": "\nUNION ALL ".join(
        f"SELECT '{label}' AS stage, {column} AS sessions FROM funnel"
        for label, column in fv.FUNNEL_STAGES
    ),
    "dash_data_quality": "SELECT * FROM checks",
    "dash_intent": """SELECT band_order || '. ' || view_band AS view_band, conversion_pct,
  unconverted_value, unconverted_pairs FROM intent""",
    "dash_price_bands": """SELECT price_band, cart_conversion_pct, carted_items, abandoned_value
FROM price_bands""",
    "dash_attach": top(
        "attach",
        8,
        "sessions",
        "attached_category",
        "attached_category, sessions, pct_of_phone_buyers, revenue",
    ),
    "dash_repeat_buyers": f"""
SELECT {labelled("purchase_count", fv.BUYER_STEPS, fv.BUYER_LAST)} AS buyer_segment,
       count(*) AS users, {dbl(f"ROUND(SUM({dec('total_spend')}), 0)")} AS total_spend
FROM users GROUP BY 1""",
    "dash_abandonment": "SELECT * FROM abandoned",
    "dash_categories": top(
        "categories WHERE category_code <> 'unknown'", 15, "revenue", "category_code"
    ),
    "dash_brands": top("brands", 15, "revenue", "brand"),
    "dash_hourly": "SELECT * FROM hours",
    "dash_top_products": top("top100", 25, "revenue", "product_id"),
    "dash_totals": f"""
SELECT {dbl(f"SUM({dec('revenue')})")} AS total_revenue, {whole("SUM(sessions)")} AS total_sessions,
       {whole("SUM(unique_users)")} AS total_users,
       {rounded(f"{dbl('SUM(CAST(conversion_rate_pct AS DECIMAL(12,2)))')} / count(*)", 2)}
         AS avg_conversion_pct
FROM daily""",
    "dash_totals_exact": f"""
SELECT {dbl(SALES)} AS total_revenue, count(DISTINCT user_session) AS total_sessions,
       count(DISTINCT user_id) AS total_users,
       {pct(f"count(DISTINCT user_session) {BUYS}", "count(DISTINCT user_session)")}
         AS conversion_pct
FROM fact""",
    "dash_abandoned_total": f"""
SELECT {dbl(f"SUM({dec('abandoned_cart_value')})")} AS abandoned_value FROM abandoned""",
    "booth_headline": f"""
SELECT (SELECT {rounded(f"{dbl(f'SUM({dec("revenue")})')} / 1e6", 1)} FROM daily) AS revenue_m,
  (SELECT {rounded(f"{dbl(f'SUM({dec("abandoned_cart_value")})')} / 1e6", 1)} FROM abandoned)
    AS abandoned_m,
  (SELECT {rounded("SUM(unconverted_value) / 1e6", 1)} FROM intent_custom
   WHERE view_band = {text(q.INTENT_TOP)}) AS intent_pool_m,
  (SELECT attach_pct FROM attach_rate) AS attach_pct""",
    "booth_price_bands": "SELECT price_band, cart_conversion_pct FROM price_bands",
    "booth_attach": top("attach", 6, "sessions", "attached_category", "attached_category, sessions"),
    "booth_intent": "SELECT view_band, conversion_pct FROM intent",
    "ask_funnel": """SELECT sessions_with_view, sessions_with_cart, sessions_with_purchase,
  view_to_cart_pct, cart_to_purchase_pct, view_to_purchase_pct FROM funnel""",
    "ask_browsed_not_bought": f"""
SELECT category_code, views, purchases, revenue, view_to_purchase_pct FROM categories
WHERE category_code <> 'unknown' AND views > {q.MANY_VIEWS}""",
    "ask_abandonment": f"""
SELECT {whole("SUM(abandoned_sessions)")} AS abandoned_sessions,
       {dbl(f"SUM({dec('abandoned_cart_value')})")} AS abandoned_cart_value FROM abandoned""",
    "ask_repeat_buyers": """
SELECT count(*) AS users, count(*) FILTER (WHERE purchase_count > 0) AS buyers,
       count(*) FILTER (WHERE purchase_count > 1) AS repeat_buyers FROM users""",
    "monthly_cart_gap": _monthly_sessions(
        f"""count(*) AS purchase_sessions,
       count(*) FILTER (WHERE NOT has_cart) AS missing_cart_event,
       {pct("count(*) FILTER (WHERE NOT has_cart)", "count(*)")} AS missing_cart_pct""",
        "has_purchase",
    ),
    "monthly_cart_logging_rate": _monthly_sessions(
        f"""count(*) AS sessions, count(*) FILTER (WHERE has_cart) AS sessions_with_cart,
       {pct("count(*) FILTER (WHERE has_cart)", "count(*)")} AS cart_logging_pct"""
    ),
    "monthly_session_depth": _monthly_sessions(
        f"""count(*) AS sessions, {whole("SUM(event_count)")} AS events,
       {rounded("SUM(event_count) / count(*)", 2)} AS events_per_session"""
    ),
    "month_over_month": f"""
SELECT period, sessions, purchase_sessions,
       {pct("(sessions - lag(sessions) OVER w)", "lag(sessions) OVER w")} AS sessions_growth_pct,
       {pct("(purchase_sessions - lag(purchase_sessions) OVER w)",
            "lag(purchase_sessions) OVER w")} AS purchase_sessions_growth_pct
FROM ({_monthly_sessions('''count(*) AS sessions,
       count(*) FILTER (WHERE has_purchase) AS purchase_sessions''')})
WINDOW w AS (ORDER BY period)""",
    "monthly_abandonment_ratio": f"""
SELECT *, {pct("abandoned_value", "revenue", 1)} AS abandoned_to_revenue_pct
FROM (SELECT {half_month("d.event_date")} AS period,
             {whole("COALESCE(SUM(a.abandoned_sessions), 0)")} AS abandoned_sessions,
             {dbl(f"COALESCE(SUM({dec('a.abandoned_cart_value')}), 0)")} AS abandoned_value,
             {dbl(f"COALESCE(SUM({dec('d.revenue')}), 0)")} AS revenue
      FROM daily d LEFT JOIN abandoned a USING (event_date) GROUP BY 1)""",
    "category_revenue_share": f"""
SELECT category_code, revenue,
       {pct("revenue", f"(SELECT {dbl(f'SUM({dec("revenue")})')} FROM categories)")}
         AS revenue_share_pct
FROM categories""",
    "price_change_by_month": f"""
SELECT {half_month("event_date")} AS period, price_move, {_MOVE_SUMS} FROM moves GROUP BY 1, 2""",
    "buyer_rates": f"""
SELECT *, {pct("buyers", "users")} AS buyer_pct, {pct("repeat_buyers", "buyers")} AS repeat_pct
FROM (SELECT count(*) AS users, count(*) FILTER (WHERE purchase_count > 0) AS buyers,
             count(*) FILTER (WHERE purchase_count > 1) AS repeat_buyers FROM users)""",
    "attach_rate_overall": "SELECT * FROM attach_rate",
    "retargeting_segment": f"""SELECT user_id, product_id, views, price FROM interest
WHERE views >= {q.DEEP_VIEWS} AND NOT bought""",
    "recovery_sizing": f"""
SELECT total AS abandoned_value, {rounded("total * CAST(0.05 AS DOUBLE)", 2)} AS recoverable_low,
       {rounded("total * CAST(0.15 AS DOUBLE)", 2)} AS recoverable_high
FROM (SELECT {dbl(f"SUM({dec('abandoned_cart_value')})")} AS total FROM abandoned)""",
    "attach_uplift": f"""
SELECT anchor_sessions, attached_sessions, attached_category, avg_price, extra_sessions,
       {rounded("extra_sessions * avg_price", 2)} AS uplift_value
FROM (SELECT *, {rounded(f'''greatest(anchor_sessions * CAST({q.ATTACH_TARGET / 100} AS DOUBLE)
               - attached_sessions, 0)''', 0)} AS extra_sessions
      FROM attach_rate LEFT JOIN (SELECT attached_category, avg_price FROM attach
                             ORDER BY sessions DESC, attached_category LIMIT 1) ON true)""",
    "peak_hours": f"""
SELECT hour_of_day, CAST((hour_of_day + 3) % 24 AS INTEGER) AS local_hour, revenue
FROM hours ORDER BY revenue DESC, hour_of_day LIMIT 6""",
    "brand_mix": top(
        "brands", 10, "revenue", "brand", "brand, purchases, revenue, avg_order_value"
    ),
}


# the stored views give the reports' own results
for _report in q.VIEW_NAMES:
    BODIES[f"view_{_report}"] = BODIES["job_runs" if _report == "pipeline_runs" else _report]


def _needed(sql: str, known: list[str]) -> list[str]:
    """The named steps a statement reads, directly or through others, in order."""
    import re

    words = set(re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql))
    names = [n for n in known if n in words]
    needed: list[str] = []
    for name in names:
        for step in (*_needed(CTES[name], known[: known.index(name)]), name):
            if step not in needed:
                needed.append(step)
    return sorted(needed, key=known.index)


def statement(name: str) -> str:
    body = BODIES[name]
    steps = _needed(body, list(CTES))
    if not steps:
        return body
    return "WITH " + ",\n".join(f"{s} AS ({CTES[s]})" for s in steps) + "\n" + body


def all_statements() -> dict[str, str]:
    return {name: statement(name) for name in BODIES}
