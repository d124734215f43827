"""Registration of queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom import fixed_values as V
from stockloom.operators import forecast as C
from stockloom.sources.star import StarRetail

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The star tables seen as M5 tables, restated for DuckDB.
STAR_SQL = """
sales_daily AS (
  SELECT n_name AS store_id, r_name AS state_id, p_type AS item_id,
         CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS sales,
         sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue
  FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
  GROUP BY ALL),
bounds AS (
  SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem),
days AS (
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date, lo FROM bounds),
calendar AS (
  SELECT date, date_diff('day', lo, date) + 1 AS day_no,
         CAST(11101 + (date_diff('day', lo, date) // 7) AS INTEGER) AS wm_yr_wk,
         dayname(date) AS weekday,
         CAST((isodow(date) + 1) % 7 + 1 AS INTEGER) AS wday,
         CAST(month(date) AS INTEGER) AS month, CAST(year(date) AS INTEGER) AS year,
         'd_' || (date_diff('day', lo, date) + 1) AS d,
         CASE WHEN month(date) = 2 AND day(date) = 6 THEN 'SuperBowl' END AS event_name_1,
         CASE WHEN month(date) = 2 AND day(date) = 6 THEN 'Sporting' END AS event_type_1,
         CAST(NULL AS VARCHAR) AS event_name_2, CAST(NULL AS VARCHAR) AS event_type_2,
         CAST(day(date) <= 10 AS INTEGER) AS "snap_AFRICA",
         CAST(day(date) IN (1,3,5,6,7,9,11,12,13,15) AS INTEGER) AS "snap_AMERICA",
         CAST(day(date) IN (2,3,5,8,9,10,11,14,15,18) AS INTEGER) AS "snap_ASIA"
  FROM days),
series AS (SELECT DISTINCT store_id, state_id, item_id FROM sales_daily),
panel AS (
  SELECT s.store_id, s.state_id, s.item_id, c.*, coalesce(x.sales, 0.0) AS sales
  FROM series s CROSS JOIN calendar c
  LEFT JOIN sales_daily x ON x.store_id = s.store_id AND x.item_id = s.item_id AND x.date = c.date),
prices AS (
  SELECT store_id, item_id, c.wm_yr_wk, CAST(sum(revenue) AS DOUBLE) / sum(sales) AS sell_price
  FROM sales_daily JOIN calendar c USING (date) GROUP BY ALL),
weekly AS (
  SELECT p.*, q.sell_price AS known_price FROM panel p LEFT JOIN prices q USING (store_id, item_id, wm_yr_wk)),
priced AS (
  SELECT * EXCLUDE (known_price), coalesce(
    last_value(known_price IGNORE NULLS) OVER (PARTITION BY store_id, item_id ORDER BY day_no
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(known_price IGNORE NULLS) OVER (PARTITION BY store_id, item_id ORDER BY day_no
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS sell_price
  FROM weekly)
"""


def oracle(body: str, *ctes: str) -> str:
    """A DuckDB query over the M5 view of the star tables."""
    return "WITH " + ",\n".join([STAR_SQL.strip(), *(c.strip() for c in ctes)]) + "\n" + body.strip()


def query(name: str, body: str | None = None, *ctes: str):
    """Register ``f(retail) -> DataFrame`` under ``name``, with its SQL when there is one."""
    def register(make: Callable[[StarRetail], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: make(StarRetail(spark, sf_dir))
        if body is not None:
            ORACLES[name] = oracle(body, *ctes)
        return make
    return register


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded for comparison (sums differ in their last bits by order)."""
    return df.select(*(
        F.round(F.col(f"`{f.name}`"), places).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ))


def stock_on_hand(df: DataFrame, days: int = 3) -> DataFrame:
    """The star tables have no stock; for the checks, the last days' sales are on hand,
    the very last day's sales on order."""
    return C.tails(df, days).select(
        *V.SERIES,
        F.aggregate("tail", F.lit(0.0), lambda total, value: total + value).alias("on_hand"),
        C.last_value(F.col("tail")).alias("on_order"))
