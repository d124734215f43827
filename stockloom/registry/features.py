"""Queries for panel preparation and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.operators import features as B
from stockloom.operators import panel as P
from stockloom.registry.base import query, rounded
from stockloom.registry.tables import wide_sales

KEYS = ["store_id", "item_id", "date"]
ORDER = "PARTITION BY store_id, item_id ORDER BY day_no"
LAGGED = f"""
lagged AS (SELECT *, lag(sales, 1, 0.0) OVER ({ORDER}) AS l1 FROM panel)"""


def _frame(rows: int) -> str:
    return f"OVER ({ORDER} ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"


def _columns(df, *names, places=6):
    return rounded(df.select(*KEYS, *names), places)


@query("b01_unpivot_days", """
SELECT item_id || '_' || store_id || '_validation' AS id, item_id, item_id AS dept_id, item_id AS cat_id,
  store_id, state_id, d, CAST(sales AS INTEGER) AS sales FROM panel
""")
def unpivot_days(retail):
    return P.unpivot_days(wide_sales(retail))


@query("b02_calendar_join", """
SELECT store_id, item_id, date, d, wm_yr_wk, weekday, event_name_1, sales FROM panel
""")
def calendar_join(retail):
    return P.join_calendar(retail.dense.drop("date"), retail.calendar).select(
        *KEYS, "d", "wm_yr_wk", "weekday", "event_name_1", "sales")


@query("b03_ordered_series", f"""
SELECT store_id, item_id, date, sales, row_number() OVER ({ORDER}) AS position FROM panel
""")
def ordered_series(retail):
    text_dates = retail.calendar.withColumn("date", F.date_format("date", "yyyy-MM-dd"))
    panel = P.join_calendar(retail.dense.drop("date"), text_dates)
    return panel.select(*KEYS, "sales", F.row_number().over(P.in_order(panel)).alias("position"))


@query("b04_price_join", """
SELECT store_id, item_id, date, wm_yr_wk, round(known_price, 9) AS sell_price FROM weekly
""")
def price_join(retail):
    return _columns(P.join_prices(retail.panel, retail.prices), "wm_yr_wk", "sell_price", places=9)


@query("b05_price_fill", "SELECT store_id, item_id, date, round(sell_price, 9) AS sell_price FROM priced")
def price_fill(retail):
    return _columns(retail.priced, "sell_price", places=9)


@query("b06_fill_days", "SELECT store_id, state_id, item_id, date, d, sales FROM panel")
def fill_days(retail):
    return retail.dense.select("store_id", "state_id", "item_id", "date", "d", "sales")


@query("b07_date_parts", """
SELECT store_id, item_id, date, CAST(isodow(date) - 1 AS INTEGER) AS dayofweek, CAST(weekofyear(date) AS INTEGER)
  AS weekofyear, CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(year(date) AS INTEGER) AS year, CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend FROM panel
""")
def date_parts(retail):
    return _columns(B.temporal(retail.panel), "dayofweek", "weekofyear", "month", "quarter", "year", "is_weekend")


@query("b08_holiday_flag", """
SELECT store_id, item_id, date, CAST(event_name_1 IS NOT NULL AS INTEGER) AS is_holiday FROM panel
""")
def holiday_flag(retail):
    return _columns(B.temporal(retail.panel), "is_holiday")


@query("b09_promo_flag", """
SELECT store_id, item_id, date, CASE state_id WHEN 'AFRICA' THEN "snap_AFRICA" WHEN 'AMERICA' THEN "snap_AMERICA"
  WHEN 'ASIA' THEN "snap_ASIA" ELSE 0 END AS is_promo FROM panel
""")
def promo_flag(retail):
    return _columns(B.temporal(retail.panel), "is_promo")


@query("b11_default_price", """
SELECT store_id, item_id, date, CAST(1.99 AS DOUBLE) AS sell_price, CAST(0 AS DOUBLE) AS price_diff_1 FROM panel
""")
def default_price(retail):
    return _columns(B.prices(retail.panel), "sell_price", "price_diff_1")


@query("b12_price_changes", f"""
SELECT store_id, item_id, date, round(lagged, 9) AS price_lag_1, round(sell_price - lagged, 9) AS price_diff_1,
  round(coalesce((sell_price - lagged) / lagged, 0), 9) AS price_pct_change
FROM (SELECT *, coalesce(lag(sell_price) OVER ({ORDER}), sell_price) AS lagged FROM priced)
""")
def price_changes(retail):
    return _columns(B.prices(retail.priced), "price_lag_1", "price_diff_1", "price_pct_change", places=9)


@query("b13_price_std", f"""
SELECT store_id, item_id, date, round(coalesce(stddev_samp(sell_price) {_frame(7)}, 0), 7) AS price_roll_std_7 FROM priced
""")
def price_std(retail):
    return B.prices(retail.priced).select(*KEYS, F.round("price_roll_std_7", 7).alias("price_roll_std_7"))


@query("b14_sales_lags", "SELECT store_id, item_id, date, " + ", ".join(
    f"lag(sales, {n}, 0.0) OVER ({ORDER}) AS sales_lag_{n}" for n in V.SALES_LAGS) + " FROM panel")
def sales_lags(retail):
    return _columns(B.sales_lags(retail.series), *(f"sales_lag_{n}" for n in V.SALES_LAGS))


def _rolling_query(slug: str, statistic: str, sql: str):
    @query(slug, "SELECT store_id, item_id, date, " + ", ".join(
        f"round(coalesce({sql} {_frame(w)}, 0), 6) AS sales_roll_{statistic}_{w}" for w in V.ROLLING_WINDOWS)
        + " FROM lagged", LAGGED)
    def run(retail):
        return _columns(B.rolling(retail.series), *(f"sales_roll_{statistic}_{w}" for w in V.ROLLING_WINDOWS))
    return run


rolling_mean = _rolling_query("b15_rolling_mean", "mean", "avg(l1)")
rolling_median = _rolling_query("b16_rolling_median", "median", "median(l1)")
rolling_std = _rolling_query("b17_rolling_std", "std", "stddev_samp(l1)")


@query("b18_expanding", f"""
SELECT store_id, item_id, date,
  round(avg(l1) OVER ({ORDER} ROWS UNBOUNDED PRECEDING), 9) AS sales_expanding_mean,
  round(coalesce(stddev_samp(l1) OVER ({ORDER} ROWS UNBOUNDED PRECEDING), 0), 9) AS sales_expanding_std FROM lagged
""", LAGGED)
def expanding(retail):
    return _columns(B.expanding(retail.series), "sales_expanding_mean", "sales_expanding_std", places=9)


@query("b19_fourier", """
SELECT store_id, item_id, date, round(sin(2 * pi() * (isodow(date) - 1) / 7.0), 6) AS sin_weekly,
  round(cos(2 * pi() * (isodow(date) - 1) / 7.0), 6) AS cos_weekly,
  round(sin(2 * pi() * dayofyear(date) / 365.25), 6) AS sin_annual,
  round(cos(2 * pi() * dayofyear(date) / 365.25), 6) AS cos_annual FROM panel
""")
def fourier(retail):
    return _columns(B.fourier(retail.series), "sin_weekly", "cos_weekly", "sin_annual", "cos_annual")


@query("b20_trend", "SELECT store_id, item_id, date, CAST(day_no AS DOUBLE) AS trend_idx FROM panel")
def trend(retail):
    return _columns(B.trend(retail.series), "trend_idx")


@query("b21_plain_rolling", "SELECT store_id, item_id, date, " + ", ".join(
    f"round(avg(sales) {_frame(w)}, 6) AS sales_roll_mean_{w}, "
    f"round(coalesce(stddev_samp(sales) {_frame(w)}, 0), 6) AS sales_roll_std_{w}"
    for w in V.PLAIN_ROLLING_WINDOWS) + " FROM panel")
def plain_rolling(retail):
    return _columns(B.plain_rolling(retail.series), *(
        f"sales_roll_{s}_{w}" for w in V.PLAIN_ROLLING_WINDOWS for s in ("mean", "std")))


FEATURE_SQL = """
features AS (SELECT store_id, state_id, item_id, date, day_no, sales, wm_yr_wk, wday,
  "snap_AFRICA", "snap_AMERICA", "snap_ASIA",
  CAST(isodow(date) - 1 AS INTEGER) AS dayofweek, CAST(weekofyear(date) AS INTEGER) AS weekofyear,
  CAST(month(date) AS INTEGER) AS month, CAST(quarter(date) AS INTEGER) AS quarter,
  CAST(year(date) AS INTEGER) AS year, CAST(isodow(date) >= 6 AS INTEGER) AS is_weekend,
  CAST(event_name_1 IS NOT NULL AS INTEGER) AS is_holiday,
  CASE state_id WHEN 'AFRICA' THEN "snap_AFRICA" WHEN 'AMERICA' THEN "snap_AMERICA"
    WHEN 'ASIA' THEN "snap_ASIA" ELSE 0 END AS is_promo,
  """ + ", ".join(f"lag(sales, {n}, 0.0) OVER ({ORDER}) AS sales_lag_{n}" for n in V.SALES_LAGS) + ", " + ", ".join(
    f"round(coalesce({sql} {_frame(w)}, 0), 9) AS sales_roll_{name}_{w}" for w in V.ROLLING_WINDOWS
    for name, sql in (("mean", "avg(l1)"), ("median", "median(l1)"), ("std", "stddev_samp(l1)"))) + f""",
  round(avg(l1) OVER ({ORDER} ROWS UNBOUNDED PRECEDING), 9) AS sales_expanding_mean,
  round(coalesce(stddev_samp(l1) OVER ({ORDER} ROWS UNBOUNDED PRECEDING), 0), 9) AS sales_expanding_std,
  round(sin(2 * pi() * (isodow(date) - 1) / 7.0), 9) AS sin_weekly,
  round(cos(2 * pi() * (isodow(date) - 1) / 7.0), 9) AS cos_weekly,
  round(sin(2 * pi() * dayofyear(date) / 365.25), 9) AS sin_annual,
  round(cos(2 * pi() * dayofyear(date) / 365.25), 9) AS cos_annual,
  CAST(day_no AS DOUBLE) AS trend_idx FROM lagged)"""

PRICE_SQL = f"""
price_features AS (SELECT store_id, item_id, date, sell_price, lagged AS price_lag_1,
  sell_price - lagged AS price_diff_1, coalesce((sell_price - lagged) / lagged, 0) AS price_pct_change,
  coalesce(stddev_samp(sell_price) {_frame(7)}, 0) AS price_roll_std_7
  FROM (SELECT *, coalesce(lag(sell_price) OVER ({ORDER}), sell_price) AS lagged FROM priced))"""


@query("b22_all_features", """
SELECT f.* EXCLUDE (state_id, day_no), round(p.sell_price, 9) AS sell_price, round(p.price_lag_1, 9) AS price_lag_1,
  round(p.price_diff_1, 9) AS price_diff_1, round(p.price_pct_change, 9) AS price_pct_change,
  round(p.price_roll_std_7, 7) AS price_roll_std_7
FROM features f JOIN price_features p USING (store_id, item_id, date)
""", LAGGED, FEATURE_SQL, PRICE_SQL)
def all_features(retail):
    built = B.all_features(retail.priced)
    wanted = [*KEYS, "sales", *B.feature_columns(built)]
    return rounded(built.select(*wanted).withColumn("price_roll_std_7", F.round("price_roll_std_7", 7)), 9)


MATRIX_COLUMNS = [
    "wm_yr_wk", "wday", "snap_AFRICA", "snap_AMERICA", "snap_ASIA", "dayofweek", "weekofyear", "month", "quarter", "year",
    "is_weekend", "is_holiday", "is_promo", *(f"sales_lag_{n}" for n in V.SALES_LAGS),
    *(f"sales_roll_{s}_{w}" for w in V.ROLLING_WINDOWS for s in ("mean", "median", "std")),
    "sales_expanding_mean", "sales_expanding_std", "sin_weekly", "cos_weekly", "sin_annual", "cos_annual", "trend_idx",
]
MATRIX_PRICES = ["sell_price", "price_lag_1", "price_diff_1", "price_pct_change"]


@query("b23_model_matrix", "SELECT f.store_id, f.item_id, f.date, f.sales, " + ", ".join(
    [f'CAST("{c}" AS DOUBLE) AS "{c}"' for c in MATRIX_COLUMNS] + [f'round(p."{c}", 9) AS "{c}"' for c in MATRIX_PRICES])
    + ", round(p.price_roll_std_7, 7) AS price_roll_std_7 FROM features f JOIN price_features p USING (store_id, item_id, date)",
    LAGGED, FEATURE_SQL, PRICE_SQL)
def model_matrix(retail):
    made = B.model_matrix(B.all_features(retail.priced), [*MATRIX_COLUMNS, *MATRIX_PRICES, "price_roll_std_7"])
    return rounded(made.withColumn("price_roll_std_7", F.round("price_roll_std_7", 7)), 9)


_WINDOWS = f"""
windows AS (SELECT * FROM (
  SELECT store_id, item_id, date,
    list(sales) OVER ({ORDER} ROWS BETWEEN 13 PRECEDING AND CURRENT ROW) AS x,
    list(sales) OVER ({ORDER} ROWS BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS y FROM panel)
  WHERE len(x) = 14 AND len(y) = 7)"""


@query("b24_supervised_windows", """
SELECT store_id, item_id, date, array_to_string([CAST(v AS INTEGER) FOR v IN x], ',') AS x,
  array_to_string([CAST(v AS INTEGER) FOR v IN y], ',') AS y FROM windows
""", _WINDOWS)
def supervised_windows(retail):
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("int").cast("string")), ",").alias(c)
    return B.supervised_windows(retail.series, 14, 7).select(*KEYS, text("x"), text("y"))


@query("b24_too_short", """
SELECT store_id, item_id, count(*) AS days FROM sales_daily GROUP BY ALL HAVING count(*) < 330
""")
def too_short(retail):
    return B.too_short(retail.daily, 330)


@query("b25_patches", """
SELECT store_id, item_id, date, len(x) AS n, 2 AS patch_count,
  array_to_string([CAST(v AS INTEGER) FOR v IN x[1:8]], ',') AS first_patch,
  array_to_string([CAST(v AS INTEGER) FOR v IN x[5:12]], ',') AS last_patch FROM windows
""", _WINDOWS)
def patches(retail):
    made = B.patches(B.supervised_windows(retail.series, 14, 7))
    text = lambda c: F.array_join(F.transform(c, lambda v: v.cast("int").cast("string")), ",")
    return made.select(*KEYS, F.size("x").cast("bigint").alias("n"), F.size("patches").alias("patch_count"),
                       text(F.element_at("patches", 1)).alias("first_patch"),
                       text(F.element_at("patches", -1)).alias("last_patch"))
