"""DuckDB SQL that recomputes each registered query independently.

The driver's tables are pre-registered as views.  ``BASE`` rebuilds the Bronze
projection and Silver directly in long form (no wide step), following the
reference's rules; each oracle is ``BASE`` plus its own CTEs and SELECT.
Numbers follow the same order-independent rules as the Spark side: money
summed in decimals, averages rounded on the scaled double.
"""
from __future__ import annotations

from shelfcast.registry import CONTENT
from shelfcast.sources.fixtures import CATEGORIES, EVENT_DAY, EVENT_NAME, EVENT_TYPE, FIRST_WEEK, STATES, STORES


def r6(x: str) -> str:
    return f"(round(({x}) * 1000000.0) / 1000000.0)"


def reven(x: str, d: int) -> str:
    s = float(10 ** d)
    return f"(round_even(({x}) * {s}, 0) / {s})"


_cats = ", ".join(f"'{c}'" for c in CATEGORIES)
_stores = ", ".join(f"({i}, '{s}', '{st}')" for i, (s, st) in enumerate(zip(STORES, STATES)))

BASE = f"""
WITH span AS (SELECT MIN(CAST(l_shipdate AS DATE)) AS a, MAX(CAST(l_shipdate AS DATE)) AS b FROM lineitem),
cal AS (
  SELECT CAST(a + CAST(i AS INTEGER) AS DATE) AS date,
         'd_' || CAST(i + 1 AS VARCHAR) AS d,
         CAST({FIRST_WEEK} + (i + (dayofweek(a) + 1) % 7) // 7 AS INTEGER) AS wm_yr_wk,
         CAST(i AS INTEGER) AS i
  FROM (SELECT a, unnest(range(date_diff('day', a, b) + 1)) AS i FROM span)
),
calendar AS (
  SELECT date, d, wm_yr_wk,
         CAST((dayofweek(date) + 1) % 7 + 1 AS INTEGER) AS wday,
         CAST(month(date) AS INTEGER) AS month,
         CAST(year(date) AS INTEGER) AS year,
         CASE WHEN day(date) = {EVENT_DAY} THEN '{EVENT_NAME}' END AS event_name_1,
         CASE WHEN day(date) = {EVENT_DAY} THEN '{EVENT_TYPE}' END AS event_type_1,
         CAST(day(date) <= 10 AS INTEGER) AS snap_CA,
         CAST(day(date) BETWEEN 5 AND 15 AS INTEGER) AS snap_TX,
         CAST(day(date) % 3 = 0 AS INTEGER) AS snap_WI
  FROM cal
),
stores AS (SELECT * FROM (VALUES {_stores}) s(region, store_id, state_id)),
parts AS (
  SELECT p_partkey, p_brand AS item_id,
         [{_cats}][CAST(regexp_extract(p_brand, '#([0-9]+)', 1) AS INTEGER) % 3 + 1] AS cat_id,
         CAST(regexp_extract(p_brand, '#([0-9]+)', 1) AS INTEGER) % 2 + 1 AS dept_no,
         CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS price
  FROM part
),
items AS (SELECT DISTINCT item_id, cat_id || '_' || CAST(dept_no AS VARCHAR) AS dept_id, cat_id FROM parts),
series AS (
  SELECT s.region, i.item_id || '_' || s.store_id AS id, i.item_id, i.dept_id, i.cat_id, s.store_id, s.state_id
  FROM items i CROSS JOIN stores s
),
sales AS (
  SELECT p.item_id, n.n_regionkey AS region, CAST(l.l_shipdate AS DATE) AS date,
         SUM(l.l_quantity) AS qty, MAX(p.price) AS price
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
       JOIN nation n ON s.s_nationkey = n.n_nationkey
       JOIN parts p ON p.p_partkey = l.l_partkey
  GROUP BY 1, 2, 3
),
prices AS (
  SELECT st.store_id, sa.item_id, c.wm_yr_wk, MAX(sa.price) AS sell_price
  FROM sales sa JOIN stores st ON st.region = sa.region JOIN calendar c ON sa.date = c.date
  GROUP BY 1, 2, 3
),
long AS (
  SELECT se.id, se.item_id, se.dept_id, se.cat_id, se.store_id, se.state_id, c.d,
         CAST(COALESCE(sa.qty, 0) AS INTEGER) AS units
  FROM series se CROSS JOIN calendar c
       LEFT JOIN sales sa ON sa.item_id = se.item_id AND sa.region = se.region AND sa.date = c.date
),
silver AS (
  SELECT l.id, l.item_id, l.dept_id, l.cat_id, l.store_id, l.state_id,
         c.date, l.d, c.wm_yr_wk, c.wday, c.month, c.year,
         l.units, p.sell_price,
         l.units * COALESCE(p.sell_price, 0.0) AS revenue,
         c.event_name_1, c.event_type_1,
         CAST(CASE l.state_id WHEN 'CA' THEN c.snap_CA WHEN 'TX' THEN c.snap_TX
                              WHEN 'WI' THEN c.snap_WI ELSE 0 END AS TINYINT) AS snap_flag,
         CAST(CASE WHEN c.wday IN (1, 2) THEN 1 ELSE 0 END AS TINYINT) AS is_weekend,
         CAST(CASE WHEN p.sell_price IS NOT NULL THEN 1 ELSE 0 END AS TINYINT) AS is_active,
         c.snap_CA, c.snap_TX, c.snap_WI
  FROM long l JOIN calendar c ON l.d = c.d
       LEFT JOIN prices p ON p.store_id = l.store_id AND p.item_id = l.item_id AND p.wm_yr_wk = c.wm_yr_wk
)"""

SILVER_COLS_SQL = ("id, item_id, dept_id, cat_id, store_id, state_id, date, d, wm_yr_wk, wday, month, year, "
                   "units, sell_price, revenue, event_name_1, event_type_1, snap_flag, is_weekend, is_active")


def q(body: str, ctes: str = "") -> str:
    """BASE + optional extra CTEs (each starting with a comma) + final SELECT."""
    return f"{BASE}{ctes}\n{body}"


ORACLES: dict[str, str] = {}


def oracle(name: str, body: str, ctes: str = "") -> None:
    ORACLES[name] = q(body, ctes)


# ---------------------------------------------------------------- Silver ---
oracle("silver_sales_daily", f"SELECT {SILVER_COLS_SQL} FROM silver")

oracle("weekly_category_sales", f"""
SELECT cat_id, store_id, wm_yr_wk,
       CAST(SUM(units) AS BIGINT) AS total_units,
       CAST(SUM(CAST(revenue AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue,
       {r6('AVG(units)')} AS avg_daily_units,
       COUNT(DISTINCT item_id) AS active_items
FROM silver GROUP BY cat_id, store_id, wm_yr_wk""")

# ------------------------------------------------------------ shared CTEs ---
WIDE = """
, wide AS (SELECT id, item_id, dept_id, cat_id, store_id, state_id, COUNT(*) AS n_days,
                  string_agg(CAST(units AS VARCHAR), ',' ORDER BY date) AS units
           FROM silver GROUP BY ALL)"""
ID6 = "id, item_id, dept_id, cat_id, store_id, state_id"
CAL_ATTRS = ("date, wm_yr_wk, wday, month, year, event_name_1, event_type_1, snap_CA, snap_TX, snap_WI")

# rows in date order per series (dense rank of the distinct dates), n_train
IX = f"""
, ix AS (SELECT id, item_id, store_id, date, units, revenue,
                CAST(DENSE_RANK() OVER (ORDER BY date) - 1 AS INTEGER) AS day_index FROM silver)
, nd AS (SELECT COUNT(DISTINCT date) AS n_dates, COUNT(DISTINCT date) - 28 AS n_train, MAX(date) AS max_date FROM silver)"""

PART_REV = """
, prev AS (SELECT CAST(l_partkey AS VARCHAR) AS item_id, CAST(SUM(l_quantity) AS BIGINT) AS total_units,
                  SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS rev
           FROM lineitem GROUP BY 1)"""

ABC = """
, rev AS (SELECT item_id, SUM(CAST(revenue AS DECIMAL(38,2))) AS rev, CAST(SUM(units) AS BIGINT) AS total_units
          FROM silver GROUP BY item_id)
, runs AS (SELECT *, SUM(rev) OVER (ORDER BY rev DESC, item_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
                  SUM(rev) OVER () AS tot FROM rev)
, abc AS (SELECT item_id, CAST(rev AS DOUBLE) AS total_revenue, total_units,
                 CAST(rev AS DOUBLE) / NULLIF(CAST(tot AS DOUBLE), 0) AS revenue_share,
                 CAST(cum AS DOUBLE) / NULLIF(CAST(tot AS DOUBLE), 0) AS cumulative_share,
                 CASE WHEN tot > 0 AND cum * 100 <= tot * 80 THEN 'A'
                      WHEN tot > 0 AND cum * 100 <= tot * 95 THEN 'B' ELSE 'C' END AS abc_class
          FROM runs)"""

PART_ABC = PART_REV + ABC[ABC.index("\n, runs AS"):].replace("FROM rev)", "FROM prev)")

FORECASTS = IX + """
, d2 AS (SELECT ix.*, CASE WHEN day_index >= 1 THEN
           CAST(units - LAG(units) OVER (PARTITION BY id ORDER BY day_index) AS BIGINT)
         * CAST(units - LAG(units) OVER (PARTITION BY id ORDER BY day_index) AS BIGINT) END AS d2 FROM ix)
, st AS (SELECT d2.id,
           CAST(MAX(CASE WHEN day_index = nd.n_train - 1 THEN units END) AS DOUBLE) AS last,
           AVG(CASE WHEN day_index < nd.n_train AND day_index >= nd.n_train - 7 THEN units END) AS ma_7,
           AVG(CASE WHEN day_index < nd.n_train AND day_index >= nd.n_train - 28 THEN units END) AS ma_28,
           AVG(CASE WHEN day_index < nd.n_train THEN d2 END) AS sc
         FROM d2, nd GROUP BY d2.id)
, fb AS (SELECT te.id, CAST(te.day_index - nd.n_train + 1 AS INTEGER) AS step, te.date, te.units AS y,
                st.last, st.ma_7, st.ma_28, CAST(sv.units AS DOUBLE) AS seas,
                CASE WHEN st.sc <> 0 THEN st.sc END AS scale
         FROM ix te JOIN nd ON te.day_index >= nd.n_train JOIN st ON st.id = te.id
              LEFT JOIN ix sv ON sv.id = te.id AND sv.day_index = nd.n_train - 7 + ((te.day_index - nd.n_train) % 7))
, fcast AS (
  SELECT 'zero' AS model, id, step, date, y, 0.0 AS yhat, scale FROM fb
  UNION ALL SELECT 'naive', id, step, date, y, last, scale FROM fb
  UNION ALL SELECT 'seasonal_naive_7', id, step, date, y, seas, scale FROM fb
  UNION ALL SELECT 'moving_average_7', id, step, date, y, ma_7, scale FROM fb
  UNION ALL SELECT 'moving_average_28', id, step, date, y, ma_28, scale FROM fb)
, wrev AS (SELECT s.id, COALESCE(SUM(CASE WHEN s.date > nd.max_date - 56 AND s.date <= nd.max_date - 28
                                      THEN CAST(s.revenue AS DECIMAL(38,2)) END), 0) AS rev
           FROM silver s, nd GROUP BY s.id)
, weights AS (SELECT id, CAST(rev AS DOUBLE) AS revenue,
                CASE WHEN (SELECT SUM(rev) FROM wrev) > 0
                     THEN CAST(rev AS DOUBLE) / CAST((SELECT SUM(rev) FROM wrev) AS DOUBLE)
                     ELSE 1.0 / (SELECT COUNT(*) FROM wrev) END AS weight FROM wrev)
, pooled AS (SELECT model, AVG(ABS(y - yhat)) AS MAE, SQRT(AVG((y - yhat) * (y - yhat))) AS RMSE,
                AVG(CASE WHEN y <> 0 THEN ABS((y - yhat) / y) END) * 100 AS MAPE,
                COALESCE(AVG(CASE WHEN (ABS(y) + ABS(yhat)) / 2 <> 0
                                  THEN ABS(y - yhat) / ((ABS(y) + ABS(yhat)) / 2) END) * 100, 0.0) AS sMAPE
             FROM fcast GROUP BY model)
, per AS (SELECT model, id, SQRT(AVG((y - yhat) * (y - yhat)) / ANY_VALUE(scale)) AS rmsse FROM fcast GROUP BY model, id)
, scored AS (SELECT p.model, AVG(p.rmsse) AS RMSSE,
                SUM(CASE WHEN p.rmsse IS NOT NULL THEN w.weight * p.rmsse END)
                / NULLIF(SUM(CASE WHEN p.rmsse IS NOT NULL THEN w.weight END), 0) AS WRMSSE
             FROM per p LEFT JOIN weights w ON w.id = p.id GROUP BY p.model)
, evaluated AS (SELECT p.model, """ + ", ".join(f"{r6('p.' + c if c in ('MAE','RMSE','MAPE','sMAPE') else 's.' + c)} AS {c}"
                                           for c in ["MAE", "RMSE", "MAPE", "sMAPE", "RMSSE", "WRMSSE"]) + """
                FROM pooled p JOIN scored s ON p.model = s.model)
, comparison AS (SELECT model, """ + ", ".join(f"{reven(c, 4)} AS {c}" for c in
                                              ["MAE", "RMSE", "MAPE", "sMAPE", "RMSSE", "WRMSSE"]) + """,
                   ROW_NUMBER() OVER (ORDER BY RMSSE ASC NULLS LAST, model) AS rank FROM evaluated)"""

STATS = IX + """
, st AS (SELECT ix.id,
           COALESCE(MIN(CASE WHEN units > 0 THEN day_index END), -1) AS first_sale_index,
           SUM(CASE WHEN day_index >= nd.n_dates - 90 THEN units END) AS recent_units,
           COUNT(*) AS n_days,
           SUM(CASE WHEN units > 0 THEN 1 ELSE 0 END) AS sale_days,
           SUM(CASE WHEN units > 0 THEN CAST(units AS BIGINT) END) AS s1,
           SUM(CASE WHEN units > 0 THEN CAST(units AS BIGINT) * CAST(units AS BIGINT) END) AS s2,
           ANY_VALUE(nd.n_dates) - 1 AS last_index
         FROM ix, nd GROUP BY ix.id)
, dem AS (SELECT id, first_sale_index,
            CASE WHEN first_sale_index >= 0 THEN CAST(last_index - first_sale_index + 1 AS DOUBLE) / CAST(sale_days AS DOUBLE) END AS adi,
            CASE WHEN first_sale_index >= 0 THEN CAST(sale_days * s2 - s1 * s1 AS DOUBLE) / CAST(s1 * s1 AS DOUBLE) END AS cv2,
            CASE WHEN first_sale_index < 0 THEN 'sin_demanda'
                 WHEN (last_index - first_sale_index + 1) * 100 < sale_days * 132
                      AND (sale_days * s2 - s1 * s1) * 100 < s1 * s1 * 49 THEN 'smooth'
                 WHEN (last_index - first_sale_index + 1) * 100 < sale_days * 132 THEN 'erratic'
                 WHEN (sale_days * s2 - s1 * s1) * 100 < s1 * s1 * 49 THEN 'intermittent'
                 ELSE 'lumpy' END AS demand_class
          FROM st)"""

WEEKDAY = """
, daily AS (SELECT date, SUM(units) AS daily_units FROM silver GROUP BY date)
, wmeans AS (SELECT CAST(isodow(date) - 1 AS INTEGER) AS weekday, AVG(daily_units) AS mean_units FROM daily GROUP BY 1)"""


def _dq(name: str, violations: str, source: str) -> str:
    return (f"SELECT '{name}' AS \"check\", CAST({violations} AS BIGINT) AS n_violations, "
            f"CAST({violations} AS BIGINT) = 0 AS passed FROM {source}")


KEYS = ["id", "item_id", "store_id", "date"]
DQ_KEYS = " UNION ALL ".join(_dq(f"keys_not_null:{k}", f"COUNT(*) FILTER (WHERE {k} IS NULL)", "silver") for k in KEYS)
DQ_VALUES = " UNION ALL ".join([
    DQ_KEYS,
    _dq("units_non_negative", "COUNT(*) FILTER (WHERE NOT COALESCE(units >= 0, false))", "silver"),
    _dq("price_positive", "COUNT(*) FILTER (WHERE sell_price <= 0)", "silver"),
    _dq("revenue_consistent", "COUNT(*) FILTER (WHERE sell_price IS NOT NULL AND NOT COALESCE(ABS(revenue - units * sell_price) < 1e-6, false))", "silver"),
    _dq("binary_flags", "COUNT(*) FILTER (WHERE NOT COALESCE(snap_flag IN (0, 1), false) OR NOT COALESCE(is_weekend IN (0, 1), false) OR NOT COALESCE(is_active IN (0, 1), false))", "silver"),
])
DQ_NO_FANOUT = _dq("no_fanout", "ABS(COUNT(*) - COUNT(DISTINCT id) * COUNT(DISTINCT date))", "silver")
DQ_UNIQUE = _dq("unique_grain", "COALESCE(SUM(n - 1), 0)", "(SELECT id, date, COUNT(*) AS n FROM silver GROUP BY id, date)")
DQ_COMPLETE = _dq("complete_series", "GREATEST(COUNT(DISTINCT n) - 1, 0)", "(SELECT id, COUNT(*) AS n FROM silver GROUP BY id)")
DQ_FACT = _dq("fact_matches_silver", "ABS((SELECT COUNT(*) FROM silver) - COUNT(*))", "silver")
DIMP = "(SELECT DISTINCT item_id, dept_id, cat_id FROM silver)"
DQ_DIM = _dq("dim_product_unique", "COALESCE(SUM(n - 1), 0)", f"(SELECT item_id, COUNT(*) AS n FROM {DIMP} GROUP BY item_id)")
DQ_WEEKLY = _dq("weekly_reconciles",
                "(CASE WHEN ABS(SUM(u) - (SELECT SUM(units) FROM silver)) >= 1 THEN 1 ELSE 0 END) + "
                "(CASE WHEN ABS(SUM(r) - (SELECT SUM(CAST(revenue AS DECIMAL(38,2))) FROM silver)) >= 0.01 THEN 1 ELSE 0 END)",
                "(SELECT SUM(units) AS u, SUM(CAST(revenue AS DECIMAL(38,2))) AS r FROM silver GROUP BY cat_id, store_id, wm_yr_wk)")
DQ_ABC_COVER = _dq("abc_covers_products",
                   f"ABS(COUNT(*) - (SELECT COUNT(*) FROM {DIMP})) + COUNT(*) FILTER (WHERE NOT COALESCE(abc_class IN ('A','B','C'), false))",
                   "abc")
DQ_ABC_SUM = _dq("abc_shares_sum_one", "CASE WHEN ABS(SUM(revenue_share) - 1) < 1e-6 THEN 0 ELSE 1 END", "abc")
DQ_ABC_SORTED = _dq("abc_sorted", "COUNT(*) FILTER (WHERE total_revenue > mb)",
                    "(SELECT total_revenue, MIN(total_revenue) OVER (ORDER BY cumulative_share, total_revenue DESC, item_id "
                    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mb FROM abc)")
_CONTRACT = [("id", True, False), ("item_id", True, False), ("store_id", True, False), ("date", True, False),
             ("units", True, True), ("sell_price", False, True)]
_contract_parts = []
for _c, _notnull, _min in _CONTRACT:
    _contract_parts.append(_dq(f"schema:{_c}:type", "0", "(SELECT 1)"))
for _c, _notnull, _min in _CONTRACT:
    if _notnull:
        _contract_parts.append(_dq(f"schema:{_c}:not_null", f"COUNT(*) FILTER (WHERE {_c} IS NULL)", "silver"))
    if _min:
        _contract_parts.append(_dq(f"schema:{_c}:min", f"COUNT(*) FILTER (WHERE {_c} < 0)", "silver"))
DQ_CONTRACT = " UNION ALL ".join(_contract_parts)
DQ_ROWS = _dq("row_count_positive", "CASE WHEN COUNT(*) > 0 THEN 0 ELSE 1 END", "silver")


# -------------------------------------------------------------- 2.1 sources ---
oracle("read_raw_csv", "SELECT * FROM wide", WIDE)
oracle("load_csv_autodetect", "SELECT * FROM wide", WIDE)


def contents(*tables: tuple[str, str]) -> str:
    """One row per (table, SQL source): its rows and its content."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"table\", CAST(COUNT(*) AS BIGINT) AS n_rows, "
        f"{CONTENT.get(name, 'CAST(SUM(total) AS BIGINT)')} AS content FROM {source}" for name, source in tables)


def sales_rows(where: str = "true") -> tuple[str, str]:
    return "bronze_sales", f"(SELECT id, SUM(units) AS total FROM long WHERE {where} GROUP BY id)"


oracle("bronze_tables", contents(("bronze_calendar", "calendar"), ("bronze_prices", "prices"), sales_rows()))
oracle("missing_source_policy", """
SELECT 'bronze_calendar' AS "table", 'loaded' AS status, CAST(COUNT(*) AS BIGINT) AS n_rows FROM calendar
UNION ALL SELECT 'bronze_prices', 'loaded', COUNT(*) FROM prices
UNION ALL SELECT 'bronze_sales', 'skipped', CAST(NULL AS BIGINT)""")
oracle("subset_filter", "SELECT * FROM wide WHERE cat_id = 'FOODS' AND store_id = 'CA_1'", WIDE)
oracle("nonempty_guard", contents(
    ("bronze_calendar", "calendar"), ("bronze_prices", "(SELECT * FROM prices WHERE store_id = 'CA_1')"),
    sales_rows("cat_id = 'FOODS' AND store_id = 'CA_1'")))
oracle("write_parquet", f"SELECT {SILVER_COLS_SQL} FROM silver")
oracle("read_parquet", "SELECT store_id, item_id, wm_yr_wk, sell_price FROM prices")
oracle("read_parquet_pruned", "SELECT id, date, units FROM silver")
FACT_SQL = ("SELECT id, item_id, store_id, date, units, sell_price, units * COALESCE(sell_price, 0.0) AS revenue "
            "FROM silver")
oracle("publish_table", FACT_SQL)
WEEKLY_SQL = f"""
SELECT cat_id, store_id, CAST(date - CAST(dayofweek(date) AS INTEGER) AS DATE) AS week,
       CAST(SUM(units) AS BIGINT) AS total_units,
       CAST(SUM(CAST(units * COALESCE(sell_price, 0.0) AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue,
       {r6('AVG(units)')} AS avg_daily_units
FROM silver GROUP BY 1, 2, 3"""
oracle("publish_view", WEEKLY_SQL)

# -------------------------------------------------------------- 2.2 reshape ---
oracle("unpivot_sales", f"SELECT {ID6}, d, units FROM long")
oracle("unpivot_sales_sql", "SELECT id, item_id, cat_id, store_id, state_id, d, units FROM long WHERE units IS NOT NULL")
oracle("series_matrix", "SELECT id, n_days, units FROM wide", WIDE)

# ---------------------------------------------------------------- 2.3 joins ---
JOINED = f"SELECT l.d, l.id, l.item_id, l.dept_id, l.cat_id, l.store_id, l.state_id, l.units, c.{CAL_ATTRS.replace(', ', ', c.')}"
oracle("join_calendar", JOINED + " FROM long l LEFT JOIN calendar c ON l.d = c.d")
oracle("calendar_match_guard", _dq("calendar_match", "COUNT(*)", "long WHERE d NOT IN (SELECT d FROM calendar)"))
oracle("join_prices", f"SELECT d, {ID6}, units, {CAL_ATTRS}, sell_price FROM silver")
oracle("weights_reindex", """
SELECT i.id, COALESCE(r.revenue, 0.0) AS revenue
FROM (SELECT DISTINCT id FROM silver) i
LEFT JOIN (SELECT id, CAST(SUM(CAST(revenue AS DECIMAL(38,2))) AS DOUBLE) AS revenue FROM silver
           WHERE revenue > 0 GROUP BY id) r ON r.id = i.id""")

# ----------------------------------------------------- 2.4 projections ---
SNAP_LOCAL = ("CASE state_id WHEN 'CA' THEN snap_CA WHEN 'TX' THEN snap_TX WHEN 'WI' THEN snap_WI ELSE 0 END")
SNAP_SQL = ("CASE state_id WHEN 'CA' THEN snap_CA WHEN 'TX' THEN snap_TX WHEN 'WI' THEN snap_WI END")
oracle("snap_flag", f"SELECT id, date, state_id, {SNAP_LOCAL} AS snap_flag FROM silver")
oracle("snap_flag_sql", f"SELECT id, date, state_id, {SNAP_SQL} AS snap_flag FROM silver")
oracle("is_weekend", "SELECT id, date, wday, CASE WHEN wday IN (1, 2) THEN 1 ELSE 0 END AS is_weekend FROM silver")
oracle("is_active", "SELECT id, date, sell_price, CASE WHEN sell_price IS NOT NULL THEN 1 ELSE 0 END AS is_active FROM silver")
oracle("revenue", "SELECT id, date, units, sell_price, revenue FROM silver")
oracle("clean_types", f"SELECT d, {ID6}, units, {CAL_ATTRS}, sell_price, snap_flag, is_weekend, is_active, revenue FROM silver")
oracle("silver_sales_daily_sql", f"""
SELECT id, item_id, cat_id, store_id, state_id, date, units, wday, month, year, event_name_1, event_type_1,
       {SNAP_SQL} AS snap_flag, sell_price,
       CASE WHEN wday IN (1, 2) THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN sell_price IS NOT NULL THEN 1 ELSE 0 END AS is_active
FROM silver""")
oracle("silver_profile", f"""
SELECT CAST(COUNT(*) AS BIGINT) AS n_rows, 20 AS n_columns, MIN(date) AS min_date, MAX(date) AS max_date,
       {r6('AVG(is_active)')} AS active_share FROM silver""")
oracle("fact_sales", "SELECT item_id, store_id, date, units, sell_price, revenue, snap_flag, is_active FROM silver")
oracle("fact_sales_sql", FACT_SQL)

# --------------------------------------------------------- 2.5 aggregation ---
oracle("dim_product", "SELECT DISTINCT item_id, dept_id, cat_id FROM silver")
oracle("dim_product_sql", "SELECT DISTINCT item_id, cat_id FROM silver")
oracle("dim_store", "SELECT DISTINCT store_id, state_id FROM silver")
oracle("dim_calendar", """
SELECT DISTINCT date, d, wm_yr_wk, wday, month, year, event_name_1, event_type_1, is_weekend,
       CAST(event_name_1 IS NOT NULL AS TINYINT) AS is_event FROM silver""")
oracle("weekly_category_sales_sql", WEEKLY_SQL)
oracle("abc_summary", f"""
SELECT abc_class, CAST(COUNT(*) AS BIGINT) AS n_items,
       {reven('COUNT(*) / SUM(COUNT(*)) OVER () * 100', 1)} AS pct_items,
       {reven('CAST(SUM(CAST(total_revenue AS DECIMAL(38,4))) AS DOUBLE) / NULLIF(CAST(SUM(SUM(CAST(total_revenue AS DECIMAL(38,4)))) OVER () AS DOUBLE), 0) * 100', 1)} AS pct_revenue
FROM abc GROUP BY abc_class""", PART_ABC)
oracle("revenue_weights", "SELECT id, revenue, weight FROM weights", FORECASTS)

# ------------------------------------------------------- 2.6 windows ---
oracle("abc_classification", "SELECT * FROM abc", PART_ABC)
oracle("abc_percent_rank", """
SELECT item_id, CAST(rev AS DOUBLE) AS total_revenue,
       CASE WHEN p <= 0.2 THEN 'A' WHEN p <= 0.5 THEN 'B' ELSE 'C' END AS abc_class
FROM (SELECT item_id, rev, PERCENT_RANK() OVER (ORDER BY rev DESC) AS p FROM prev)""", PART_REV)
W_ID = "OVER (PARTITION BY id ORDER BY date)"
oracle("lag_features", f"""
SELECT id, date, units, LAG(units, 7) {W_ID} AS lag_7, LAG(units, 14) {W_ID} AS lag_14,
       LAG(units, 28) {W_ID} AS lag_28 FROM silver""")
oracle("rolling_mean_features", "SELECT id, date, units, " + ", ".join(
    f"CASE WHEN COUNT(units) OVER (PARTITION BY id ORDER BY date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING) = {w} "
    f"THEN {r6(f'AVG(units) OVER (PARTITION BY id ORDER BY date ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)')} END "
    f"AS rolling_mean_{w}" for w in (7, 28)) + " FROM silver")
oracle("diff_sq", f"""
SELECT id, date, units, CAST(units - LAG(units) {W_ID} AS BIGINT) * CAST(units - LAG(units) {W_ID} AS BIGINT) AS diff_sq
FROM silver""")
oracle("series_first_sale", "SELECT id, CAST(COALESCE(MIN(CASE WHEN units > 0 THEN day_index END), -1) AS INTEGER) "
                            "AS first_sale_index FROM ix GROUP BY id", IX)
oracle("last_n_days", "SELECT id, date, units FROM ix, nd WHERE day_index >= nd.n_dates - 90", IX)
oracle("tail_mean", f"""
SELECT id, {r6('AVG(units)')} AS tail_mean
FROM (SELECT id, units, ROW_NUMBER() OVER (PARTITION BY id ORDER BY date DESC) AS rn FROM silver)
WHERE rn <= 28 GROUP BY id""")
oracle("order_outputs", ORACLES["weekly_category_sales"].split(BASE, 1)[1])
oracle("best_model", "SELECT model, MAE, RMSE, MAPE, sMAPE, RMSSE, WRMSSE, rank FROM comparison WHERE rank = 1", FORECASTS)

# ------------------------------------------------------ 2.7 forecasting ---
oracle("temporal_split", "SELECT id, date, units, CASE WHEN day_index < nd.n_train THEN 'train' ELSE 'test' END AS split "
                         "FROM ix, nd", IX)
oracle("cutoff_split", "SELECT id, date, units, CASE WHEN date < (SELECT b - 27 FROM span) THEN 'train' ELSE 'test' END AS split "
                       "FROM silver WHERE date IS NOT NULL")
# The first three need a few days of each series only, so they read the sales of those days.
AHEAD = """
, ahead AS (SELECT id, item_id, region, CAST(step AS INTEGER) AS step, CAST(b - 28 + CAST(step AS INTEGER) AS DATE) AS date, b
            FROM series, span, (SELECT unnest(range(1, 29)) AS step))"""


def _held(model: str, day: str) -> str:
    """Each step takes the units of one training day."""
    return (f"SELECT '{model}' AS model, h.id, h.step, h.date, CAST(CAST(COALESCE(sa.qty, 0) AS INTEGER) AS DOUBLE) AS yhat "
            f"FROM ahead h LEFT JOIN sales sa ON sa.item_id = h.item_id AND sa.region = h.region AND sa.date = {day}")


oracle("forecast_zero", "SELECT 'zero' AS model, id, step, date, CAST(0 AS DOUBLE) AS yhat FROM ahead", AHEAD)
oracle("forecast_naive", _held("naive", "h.b - 28"), AHEAD)
oracle("forecast_seasonal_naive", _held("seasonal_naive_7", "h.b - 34 + (h.step - 1) % 7"), AHEAD)
oracle("forecast_moving_average", "SELECT model, id, step, date, yhat FROM fcast "
                                  "WHERE model IN ('moving_average_7', 'moving_average_28')", FORECASTS)
for _name, _col in [("metric_mae", "MAE"), ("metric_rmse", "RMSE"), ("metric_mape", "MAPE"),
                    ("metric_smape", "sMAPE"), ("metric_rmsse", "RMSSE"), ("metric_wrmsse", "WRMSSE")]:
    oracle(_name, f"SELECT model, {_col} FROM evaluated", FORECASTS)
oracle("evaluate_model", "SELECT * FROM evaluated", FORECASTS)
oracle("comparison_table", "SELECT * FROM comparison", FORECASTS)

# ------------------------------------------------------ 2.8 diagnostics ---
oracle("intermittency_profile", f"""
SELECT COUNT(DISTINCT id) AS n_series, COUNT(DISTINCT date) AS n_days, COUNT(*) AS n_cells,
       {r6('AVG(CASE WHEN units = 0 THEN 1.0 ELSE 0.0 END)')} AS zero_share,
       {r6('AVG(units)')} AS mean_units, quantile_cont(units, 0.5) AS median_units FROM silver""")
oracle("series_lifecycle", """
SELECT COUNT(*) AS n_series, COUNT(*) FILTER (WHERE first_sale_index = -1) AS never_sold,
       COUNT(*) FILTER (WHERE first_sale_index > 0) AS born_late,
       COUNT(*) FILTER (WHERE COALESCE(recent_units, 0) = 0) AS dead_90 FROM st""", STATS)
oracle("launch_delay", """
SELECT quantile_cont(first_sale_index, 0.5) AS median_delay, CAST(MAX(first_sale_index) AS INTEGER) AS max_delay
FROM st WHERE first_sale_index > 0""", STATS)
oracle("pre_launch_zeros", f"""
SELECT CAST(COALESCE(SUM(CASE WHEN first_sale_index > 0 THEN first_sale_index END), 0) AS BIGINT) AS pre_launch_zeros,
       {r6('COALESCE(SUM(CASE WHEN first_sale_index > 0 THEN first_sale_index END), 0) / SUM(n_days)')} AS pre_launch_share
FROM st""", STATS)
oracle("demand_stats", "SELECT id, CAST(first_sale_index AS INTEGER) AS first_sale_index, adi, cv2, demand_class FROM dem", STATS)
oracle("classify_syntetos_boylan", "SELECT id, adi, cv2, demand_class FROM dem", STATS)
oracle("demand_class_summary", f"""
SELECT demand_class, COUNT(*) AS n_series,
       {reven('COUNT(*) / SUM(COUNT(*)) OVER () * 100', 1)} AS pct_series,
       {r6('quantile_cont(adi, 0.5)')} AS median_adi, {r6('quantile_cont(cv2, 0.5)')} AS median_cv2,
       {r6('(SELECT quantile_cont(adi, 0.5) FROM dem)')} AS overall_median_adi,
       {r6('(SELECT quantile_cont(cv2, 0.5) FROM dem)')} AS overall_median_cv2
FROM dem GROUP BY demand_class""", STATS)
oracle("weekday_seasonality", f"""
SELECT weekday, {r6('mean_units')} AS mean_units,
       {r6('mean_units / NULLIF(AVG(mean_units) OVER (), 0) * 100')} AS seasonal_index FROM wmeans""", WEEKDAY)
oracle("weekday_spread", f"""
SELECT {r6('MAX(mean_units) / NULLIF(MIN(mean_units), 0)')} AS spread,
       COALESCE(MAX(mean_units) / NULLIF(MIN(mean_units), 0) > 1.15, false) AS weekly_seasonality FROM wmeans""", WEEKDAY)
oracle("snap_lift", f"""
SELECT {r6('AVG(CASE WHEN snap_flag = 0 THEN units END)')} AS mean_no_snap,
       {r6('AVG(CASE WHEN snap_flag = 1 THEN units END)')} AS mean_snap,
       {r6('(AVG(CASE WHEN snap_flag = 1 THEN units END) / NULLIF(AVG(CASE WHEN snap_flag = 0 THEN units END), 0) - 1) * 100')} AS lift_pct
FROM silver""")
oracle("modelling_hints", f"""
SELECT {r6('(SELECT AVG(CASE WHEN units = 0 THEN 1.0 ELSE 0.0 END) FROM silver)')} AS zero_share,
       {r6("(SELECT COUNT(*) FILTER (WHERE demand_class IN ('intermittent', 'lumpy')) / COUNT(*) FROM dem)")} AS intermittent_lumpy_share,
       (SELECT COUNT(*) FILTER (WHERE first_sale_index > 0) > 0 FROM st) AS has_pre_launch_zeros,
       (SELECT COUNT(*) FILTER (WHERE COALESCE(recent_units, 0) = 0) FROM st) AS dead_series,
       (SELECT COALESCE(MAX(mean_units) / NULLIF(MIN(mean_units), 0) > 1.15, false) FROM wmeans) AS weekly_seasonality""",
       STATS + WEEKDAY)

# ------------------------------------------------------ 2.9 data quality ---
PLANTED = """
, damaged AS (SELECT * REPLACE (
    CASE WHEN day(date) = 1 AND store_id = 'TX_1' THEN -1 ELSE units END AS units,
    CASE WHEN day(date) = 2 THEN -sell_price ELSE sell_price END AS sell_price,
    CASE WHEN day(date) = 3 THEN 2 ELSE is_active END AS is_active,
    CASE WHEN NOT (day(date) = 4 AND store_id = 'WI_1') THEN item_id END AS item_id)
  FROM silver WHERE NOT (day(date) = 6 AND store_id = 'NY_1'))
, planted AS (SELECT * FROM damaged UNION ALL SELECT * FROM damaged WHERE day(date) = 5 AND store_id = 'CA_2')"""


def dq_oracle(name: str, clean: str, defects: str, ctes: str = "") -> None:
    """A check's rows on the clean frame and on the one with planted defects."""
    oracle(name, f"SELECT 'clean' AS frame, * FROM ({clean}) UNION ALL SELECT 'planted' AS frame, * FROM ({defects})", PLANTED + ctes)


def on_planted(sql: str) -> str:
    return sql.replace("FROM silver", "FROM planted")


for _name, _sql in [
    ("dq_no_fanout", DQ_NO_FANOUT), ("dq_unique_grain", DQ_UNIQUE), ("dq_keys_not_null", DQ_KEYS), ("dq_complete_series", DQ_COMPLETE),
    ("dq_units_non_negative", _dq("units_non_negative", "COUNT(*) FILTER (WHERE NOT COALESCE(units >= 0, false))", "silver")),
    ("dq_price_positive", _dq("price_positive", "COUNT(*) FILTER (WHERE sell_price <= 0)", "silver")),
    ("dq_revenue_consistent", _dq("revenue_consistent", "COUNT(*) FILTER (WHERE sell_price IS NOT NULL AND NOT COALESCE(ABS(revenue - units * sell_price) < 1e-6, false))", "silver")),
    ("dq_binary_flags", _dq("binary_flags", "COUNT(*) FILTER (WHERE NOT COALESCE(snap_flag IN (0, 1), false) OR NOT COALESCE(is_weekend IN (0, 1), false) OR NOT COALESCE(is_active IN (0, 1), false))", "silver")),
    ("dq_dim_product_unique", DQ_DIM),
]:
    dq_oracle(_name, _sql, on_planted(_sql))
# the planted contract also has units of a wrong type
dq_oracle("dq_schema_contract", DQ_CONTRACT, on_planted(DQ_CONTRACT).replace(
    _dq("schema:units:type", "0", "(SELECT 1)"), _dq("schema:units:type", "1", "(SELECT 1)")))
dq_oracle("dq_row_count_positive", DQ_ROWS, DQ_ROWS.replace("FROM silver", "FROM (SELECT * FROM silver WHERE units < 0)"))
dq_oracle("dq_fact_matches_silver", DQ_FACT, DQ_FACT.replace(") - COUNT(*))", ") - (SELECT COUNT(*) FROM planted))").replace("FROM silver", "FROM silver", 1)
          .replace("= 0 AS passed FROM silver", "= 0 AS passed FROM (SELECT 1)"))
dq_oracle("dq_weekly_reconciles", DQ_WEEKLY, DQ_WEEKLY.replace("FROM silver GROUP BY cat_id", "FROM planted GROUP BY cat_id"))
dq_oracle("dq_abc_covers_products", DQ_ABC_COVER, DQ_ABC_COVER.replace(
    "FROM abc", "FROM (SELECT CASE abc_class WHEN 'A' THEN 'D' ELSE abc_class END AS abc_class FROM abc WHERE item_id <> 'Brand#11')"), ABC)
dq_oracle("dq_abc_shares_sum_one", DQ_ABC_SUM, DQ_ABC_SUM.replace("SUM(revenue_share)", "SUM(revenue_share / 2)"), PART_ABC)
dq_oracle("dq_abc_sorted", DQ_ABC_SORTED, DQ_ABC_SORTED.replace("ORDER BY cumulative_share,", "ORDER BY -cumulative_share,"), PART_ABC)
oracle("dq_report", " UNION ALL ".join([
    DQ_VALUES, DQ_NO_FANOUT, DQ_UNIQUE, DQ_COMPLETE, DQ_FACT, DQ_DIM, DQ_WEEKLY, DQ_ABC_COVER, DQ_ABC_SUM,
    DQ_ABC_SORTED, DQ_CONTRACT, DQ_ROWS.replace("'row_count_positive'", "'row_count_positive:silver'")]), ABC)

# --------------------------------------------------- 2.10 serving, jobs ---
SERVED = IX + """
, last AS (SELECT id, item_id, store_id, units, day_index - nd.n_dates AS back, nd.max_date FROM ix, nd
           WHERE day_index >= nd.n_dates - 28)
, means AS (SELECT id, item_id, store_id, ANY_VALUE(max_date) AS max_date, AVG(units) AS ma_28,
                   AVG(CASE WHEN back >= -7 THEN units END) AS ma_7,
                   CAST(MAX(CASE WHEN back = -1 THEN units END) AS DOUBLE) AS last FROM last GROUP BY ALL)
, served AS (
  SELECT m.item_id, m.store_id, v.model, CAST(s.step AS INTEGER) AS step,
         CAST(m.max_date + CAST(s.step AS INTEGER) AS DATE) AS date,
         CASE v.model WHEN 'zero' THEN 0.0 WHEN 'naive' THEN m.last WHEN 'moving_average_7' THEN m.ma_7
                      WHEN 'moving_average_28' THEN m.ma_28 ELSE CAST(l.units AS DOUBLE) END AS predicted_units
  FROM means m CROSS JOIN range(1, 91) s(step)
       CROSS JOIN (VALUES ('zero'), ('naive'), ('seasonal_naive_7'), ('moving_average_7'), ('moving_average_28')) v(model)
       LEFT JOIN last l ON l.id = m.id AND l.back = (s.step - 1) % 7 - 7)"""
oracle("forecasts_table", "SELECT * FROM served", SERVED)
oracle("forecast_lookup", """
SELECT item_id, store_id, 28 AS horizon_days, date, predicted_units FROM served
WHERE model = 'moving_average_28' AND step <= 28""", SERVED)
# the calendar is dense, so a series has a row for every day
oracle("train_demand_model", """
SELECT CAST((SELECT COUNT(*) FROM series) * (date_diff('day', a, b) + 1 - 28) AS BIGINT) AS n_train, true AS leaves_kept,
       (SELECT COUNT(*) FROM series) * 28 AS n_test, (SELECT COUNT(*) FROM series) * 28 AS n_predicted, true AS beats_zero FROM span""")
oracle("forecast_recursive", """
SELECT store_id, COUNT(*) AS n_rows, COUNT(DISTINCT item_id) AS n_items, CAST(SUM(step) AS BIGINT) AS sum_steps,
       CAST(MIN(b + CAST(step AS INTEGER)) AS DATE) AS first_date, CAST(MAX(b + CAST(step AS INTEGER)) AS DATE) AS last_date,
       CAST(0 AS BIGINT) AS n_wrong
FROM series, span, (SELECT unnest(range(1, 91)) AS step) GROUP BY store_id""")
ORACLES["weekly_from_states"] = ORACLES["weekly_category_sales"]
oracle("abc_from_states", "SELECT * FROM abc", ABC)
oracle("distinct_items_from_states", """
SELECT cat_id, store_id, COUNT(DISTINCT item_id) FILTER (WHERE units > 0) AS n_items FROM silver GROUP BY cat_id, store_id""")
oracle("csv_quarantine", """
SELECT CASE WHEN wm_yr_wk % 40 = 3 AND store_id = 'TX_1' THEN '3 fields, not 4' WHEN wm_yr_wk % 50 = 7 THEN 'no value of its type: sell_price'
            ELSE 'good' END AS reason, COUNT(*) AS n_lines,
       CAST(SUM(CASE WHEN NOT (wm_yr_wk % 40 = 3 AND store_id = 'TX_1') AND wm_yr_wk % 50 <> 7 THEN wm_yr_wk END) AS BIGINT) AS weeks
FROM prices GROUP BY 1""")
oracle("table_versions", """
SELECT store_id, COUNT(*) AS n_rows, CAST(SUM(units) AS BIGINT) AS units, read FROM silver, (VALUES ('first'), ('after the broken write')) r(read)
GROUP BY store_id, read
UNION ALL SELECT store_id, COUNT(*), CAST(SUM(units) AS BIGINT), 'second' FROM silver WHERE units > 0 GROUP BY store_id""")
oracle("upsert_years", """
SELECT year, COUNT(*) AS n_rows, CAST(SUM(units + CASE WHEN year = 1998 AND units > 0 OR year = 2000 AND month(date) = 2 THEN 100 ELSE 0 END)
       AS BIGINT) AS units, year NOT IN (1998, 2000) AS files_stayed FROM silver GROUP BY year""")
oracle("store_kpis", f"""
SELECT t.store_id, t.total_revenue, t.avg_daily_units, COALESCE(a.n, 0) AS abc_a_products
FROM (SELECT store_id, CAST(SUM(CAST(revenue AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue,
             {r6('AVG(units)')} AS avg_daily_units FROM silver GROUP BY store_id) t
LEFT JOIN (SELECT s.store_id, COUNT(*) AS n
           FROM (SELECT DISTINCT store_id, item_id FROM silver WHERE units > 0) s
           JOIN abc ON abc.item_id = s.item_id AND abc.abc_class = 'A' GROUP BY s.store_id) a
  ON a.store_id = t.store_id""", ABC)
ORACLES["store_kpis_from_states"] = ORACLES["store_kpis"]
GOLD = [
    ("abc_classification", "abc"),
    ("dim_calendar", "(SELECT DISTINCT date, wm_yr_wk, CAST(event_name_1 IS NOT NULL AS INTEGER) AS is_event FROM silver)"),
    ("dim_product", DIMP), ("dim_store", "(SELECT DISTINCT store_id, state_id FROM silver)"), ("fact_sales", "silver"),
    ("weekly_category_sales", """(SELECT SUM(units) AS total_units, CAST(SUM(CAST(revenue AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue,
        COUNT(DISTINCT item_id) AS active_items FROM silver GROUP BY cat_id, store_id, wm_yr_wk)"""),
]
oracle("gold_tables", contents(*GOLD), ABC)
oracle("run_pipeline", contents(*GOLD, ("bronze_calendar", "calendar"), ("bronze_prices", "prices"), sales_rows(),
                                ("silver_sales_daily", "silver")), ABC)
