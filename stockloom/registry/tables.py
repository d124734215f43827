"""Queries for reading, validating and exporting tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from stockloom.operators import validation as A
from stockloom.registry.base import StarRetail, query, rounded
from stockloom.session import scratch_path
from stockloom.sources import quarantine as Q
from stockloom.sources import retail as R


def _csv_copy(retail: StarRetail, name: str, df):
    """Write a table derived from the star schema as CSV in the shared scratch folder."""
    path = f"{scratch_path(retail.spark, 'csv')}/{name}"
    R.write_csv(df, path)
    return path


@query("a01_read_csv", "SELECT store_id, item_id, wm_yr_wk, round(sell_price, 9) AS sell_price FROM prices")
def read_csv(retail):
    path = _csv_copy(retail, "sell_prices.csv", retail.prices)
    return rounded(R.read_table(retail.spark, path), 9)


# Every week of a series is written once; by its number a cell is spoiled, left out, made negative or repeated.
_PLANTED = """
planted AS (SELECT store_id, item_id, wm_yr_wk, CASE wm_yr_wk % 10 WHEN 1 THEN 'x' || sell_price WHEN 2 THEN '' WHEN 3 THEN '-1.0'
    ELSE '9.5' END AS cell, wm_yr_wk % 10 AS kind FROM prices)"""


@query("a14_quarantine", """
SELECT 'clean' AS what, item_id, CAST(count(*) AS BIGINT) AS "rows", CAST(sum(wm_yr_wk) AS BIGINT) AS weeks FROM planted
  WHERE kind NOT IN (1, 2, 3) GROUP BY ALL
UNION ALL SELECT CASE kind WHEN 1 THEN 'unreadable line' WHEN 2 THEN 'no sell_price' WHEN 3 THEN 'price not above 0' ELSE 'repeated key' END,
  item_id, count(*), sum(wm_yr_wk) FROM planted WHERE kind IN (1, 2, 3, 4) GROUP BY ALL
""", _PLANTED)
def quarantine(retail):
    """Good rows and rejects by reason, from one reading of a price file with planted faults."""
    kind = F.col("wm_yr_wk") % 10
    cell = F.when(kind == 1, F.concat(F.lit("x"), F.col("sell_price").cast("string"))).when(kind == 2, F.lit(None)).when(
        kind == 3, F.lit("-1.0")).otherwise(F.lit("9.5"))
    rows = retail.prices.withColumn("sell_price", cell).withColumn("copies", F.explode(F.when(kind == 4, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    path = _csv_copy(retail, "sell_prices.csv", rows.select("store_id", "item_id", "wm_yr_wk", "sell_price"))
    clean, rejects = Q.read_judged(retail.spark, path, Q.PRICE_RULES)
    named = clean.withColumn("what", F.lit("clean")).unionByName(
        rejects.withColumn("what", F.explode("reasons")).drop("file", "line", "reasons"))
    return named.groupBy("what", "item_id").agg(F.count(F.lit(1)).alias("rows"), F.sum("wm_yr_wk").cast("bigint").alias("weeks"))


@query("a02_load_tables", """
SELECT 'calendar' AS dataset, count(*) AS "rows", sum(wday) AS checksum FROM calendar
UNION ALL SELECT 'sell_prices', count(*), sum(wm_yr_wk) FROM prices
UNION ALL SELECT 'sales', count(*), CAST(sum(sales) AS BIGINT)
  FROM (SELECT store_id, item_id, sum(sales) AS sales FROM panel GROUP BY ALL)
""")
def load_tables(retail):
    base = scratch_path(retail.spark, "m5")
    R.write_csv(retail.calendar, f"{base}/calendar.csv")
    R.write_csv(retail.prices, f"{base}/sell_prices.csv")
    R.write_csv(wide_sales(retail), f"{base}/sales_train_validation.csv")
    tables = R.read_retail_tables(retail.spark, base)
    days = F.aggregate(
        F.array(*(F.col(c) for c in A.day_columns(tables.sales))), F.lit(0).cast("bigint"),
        lambda total, day: total + day)
    parts = [(tables.calendar, "calendar", F.col("wday")), (tables.prices, "sell_prices", F.col("wm_yr_wk")),
             (tables.sales, "sales", days)]
    summed = [df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("rows"), F.sum(value).alias("checksum"))
              for df, name, value in parts]
    return summed[0].unionByName(summed[1]).unionByName(summed[2])


def wide_sales(retail: StarRetail):
    """The panel in M5's wide layout, one column per day (a bounded list of names)."""
    days = retail.calendar.count()
    return (
        retail.dense.select(
            F.concat_ws("_", "item_id", "store_id", F.lit("validation")).alias("id"), "item_id",
            F.col("item_id").alias("dept_id"), F.col("item_id").alias("cat_id"), "store_id", "state_id",
            "d", F.col("sales").cast("int").alias("sales"))
        .groupBy("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")
        .pivot("d", [f"d_{n}" for n in range(1, days + 1)]).agg(F.first("sales"))
    )


@query("a04_null_counts", """
SELECT 'calendar' AS dataset, * FROM (UNPIVOT (
  SELECT count(*) - count(date) AS date, count(*) - count(wm_yr_wk) AS wm_yr_wk,
    count(*) - count(weekday) AS weekday, count(*) - count(wday) AS wday, count(*) - count(month) AS month,
    count(*) - count(year) AS year, count(*) - count(d) AS d, count(*) - count(event_name_1) AS event_name_1,
    count(*) - count(event_type_1) AS event_type_1, count(*) - count(event_name_2) AS event_name_2,
    count(*) - count(event_type_2) AS event_type_2, count(*) - count("snap_AFRICA") AS "snap_AFRICA",
    count(*) - count("snap_AMERICA") AS "snap_AMERICA", count(*) - count("snap_ASIA") AS "snap_ASIA"
  FROM calendar) ON COLUMNS(*) INTO NAME "column" VALUE null_count)
UNION ALL
SELECT 'weekly_panel', 'sell_price', count(*) - count(known_price) FROM weekly
UNION ALL
SELECT 'weekly_panel', 'sales', count(*) - count(sales) FROM weekly
""")
def null_counts(retail):
    from stockloom.operators.panel import join_prices
    calendar = A.null_counts(retail.calendar).select(F.lit("calendar").alias("dataset"), "*")
    weekly = join_prices(retail.panel, retail.prices).select("sell_price", "sales")
    return calendar.unionByName(
        A.null_counts(weekly).select(F.lit("weekly_panel").alias("dataset"), "*"))


@query("a05_duplicates", """
SELECT (SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM lineitem GROUP BY
          l_partkey, l_suppkey, l_shipdate))::BIGINT AS shipment_duplicates,
       (SELECT count(*) - count(DISTINCT (event_type, value)) FROM events) AS event_duplicates
""")
def duplicates(retail):
    shipments = A.duplicate_count(retail.table("lineitem").select("l_partkey", "l_suppkey", "l_shipdate"))
    events = A.duplicate_count(retail.table("events").select("event_type", "value"))
    return retail.spark.range(1).select(
        shipments.scalar().alias("shipment_duplicates"), events.scalar().alias("event_duplicates"))


@query("a06_non_positive_prices", """
SELECT 'sell_prices' AS dataset, count(*) FILTER (sell_price <= 0) AS invalid_prices_count FROM prices
UNION ALL SELECT 'supplier', count(*) FILTER (s_acctbal <= 0) FROM supplier
""")
def non_positive_prices(retail):
    prices = A.non_positive_prices(retail.prices).select(F.lit("sell_prices").alias("dataset"), "*")
    balances = retail.table("supplier").select(F.col("s_acctbal").alias("sell_price"))
    return prices.unionByName(A.non_positive_prices(balances).select(F.lit("supplier").alias("dataset"), "*"))


@query("a07_negative_sales", """
SELECT 'panel' AS dataset, count(*) FILTER (sales < 0) AS negative_sales_count FROM panel
UNION ALL SELECT 'shifted', count(*) FILTER (sales - 20 < 0) FROM panel
""")
def negative_sales(retail):
    shifted = retail.dense.select((F.col("sales") - 20).alias("sales"))
    return A.negative_sales(retail.dense).select(F.lit("panel").alias("dataset"), "*").unionByName(
        A.negative_sales(shifted).select(F.lit("shifted").alias("dataset"), "*"))


def _number_summary(column: str, table: str, source: str) -> str:
    return f"""SELECT '{column}' AS "column", count({source}) AS count, round(avg({source}), 6) AS mean,
      round(stddev_samp({source}), 4) AS std, round(CAST(min({source}) AS DOUBLE), 6) AS min,
      round(quantile_cont(CAST({source} AS DOUBLE), 0.25), 6) AS p25,
      round(quantile_cont(CAST({source} AS DOUBLE), 0.5), 6) AS p50,
      round(quantile_cont(CAST({source} AS DOUBLE), 0.75), 6) AS p75,
      round(CAST(max({source}) AS DOUBLE), 6) AS max FROM {table}"""


@query("a08_describe_numbers", " UNION ALL ".join([
    _number_summary("sell_price", "prices", "sell_price"),
    _number_summary("wm_yr_wk", "prices", "wm_yr_wk"),
    _number_summary("l_extendedprice", "lineitem", "l_extendedprice"),
    _number_summary("l_quantity", "lineitem", "l_quantity"),
]))
def describe_numbers(retail):
    both = A.describe_numbers(retail.prices, ["sell_price", "wm_yr_wk"]).unionByName(
        A.describe_numbers(retail.table("lineitem"), ["l_extendedprice", "l_quantity"]))
    return rounded(both.withColumn("std", F.round("std", 4)))


@query("a08_describe_texts", " UNION ALL ".join(f"""
(SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
  arg_min({c}, (-n, {c})) AS top, max(n) AS freq
  FROM (SELECT {c}, count(*) AS n FROM panel WHERE {c} IS NOT NULL GROUP BY 1))""" for c in (
      "store_id", "item_id", "weekday", "event_name_1")))
def describe_texts(retail):
    return A.describe_texts(retail.panel, ["store_id", "item_id", "weekday", "event_name_1"])


@query("a09_head_sample", """
SELECT store_id, state_id, item_id, date, d FROM panel ORDER BY store_id, item_id, date LIMIT 3
""")
def head_sample(retail):
    columns = retail.dense.select("store_id", "state_id", "item_id", "date", "d", "sales")
    return A.head_sample(columns, ["store_id", "item_id", "date"], rows=3, columns=5)


@query("a10_point_query", """
SELECT store_id, item_id, date, sales FROM panel WHERE store_id = 'NATION_3' AND item_id = 'PROMO'
""")
def point_query(retail):
    return A.point_query(retail.dense, "NATION_3", "PROMO").select("store_id", "item_id", "date", "sales")


@query("a11_narrowing_advice", """
SELECT * FROM (
  SELECT 'store_id' AS "column", 'string' AS current_type, CAST(NULL AS DOUBLE) AS min_value,
    CAST(NULL AS DOUBLE) AS max_value, count(DISTINCT store_id) AS n_distinct,
    CASE WHEN count(DISTINCT store_id) <= 20 THEN 'category' ELSE 'string' END AS suggested_type FROM weekly
  UNION ALL SELECT 'item_id', 'string', NULL, NULL, count(DISTINCT item_id),
    CASE WHEN count(DISTINCT item_id) <= 20 THEN 'category' ELSE 'string' END FROM weekly
  UNION ALL SELECT 'wday', 'int', min(wday), max(wday), NULL, 'tinyint' FROM weekly
  UNION ALL SELECT 'wm_yr_wk', 'int', min(wm_yr_wk), max(wm_yr_wk), NULL, 'smallint' FROM weekly
  UNION ALL SELECT 'sales', 'double', min(sales), max(sales), NULL, 'float' FROM weekly
  UNION ALL SELECT 'sell_price', 'double', round(min(known_price), 6), round(max(known_price), 6), NULL,
    CASE WHEN count(known_price) = count(*) THEN 'float' ELSE 'double' END FROM weekly
  UNION ALL SELECT 'date', 'date', NULL, NULL, NULL, 'date')
""")
def narrowing_advice(retail):
    from stockloom.operators.panel import join_prices
    weekly = join_prices(retail.panel, retail.prices).select(
        "store_id", "item_id", "wday", "wm_yr_wk", "sales", "sell_price", "date")
    return rounded(A.narrowing_advice(weekly))


def _m5_tables(retail):
    calendar = retail.calendar.withColumnsRenamed(
        {"snap_AFRICA": "snap_CA", "snap_AMERICA": "snap_TX", "snap_ASIA": "snap_WI"})
    sales = retail.dense.select(
        F.concat_ws("_", "item_id", "store_id", F.lit("validation")).alias("id"), "item_id",
        F.col("item_id").alias("dept_id"), F.col("item_id").alias("cat_id"), "store_id", "state_id",
        "d", "sales")
    return R.RetailTables(calendar, retail.prices, sales)


_FINDINGS = """
SELECT 'calendar' AS dataset, 'missing_columns' AS "check", CAST(0 AS BIGINT) AS value, true AS passed
UNION ALL SELECT 'calendar', 'rows', count(*), NULL FROM calendar
UNION ALL SELECT 'calendar', 'null_cells', 4 * count(*) - count(event_name_1) - count(event_type_1), NULL FROM calendar
UNION ALL SELECT 'calendar', 'duplicates', count(*) - count(DISTINCT date), NULL FROM calendar
UNION ALL SELECT 'sell_prices', 'missing_columns', 0, true
UNION ALL SELECT 'sell_prices', 'rows', count(*), NULL FROM prices
UNION ALL SELECT 'sell_prices', 'null_cells', count(*) - count(sell_price), NULL FROM prices
UNION ALL SELECT 'sell_prices', 'duplicates', count(*) - count(DISTINCT (store_id, item_id, wm_yr_wk)), NULL FROM prices
UNION ALL SELECT 'sell_prices', 'invalid_prices', count(*) FILTER (sell_price <= 0),
  count(*) FILTER (sell_price <= 0) = 0 FROM prices
UNION ALL SELECT 'sales', 'missing_columns', 0, true
UNION ALL SELECT 'sales', 'rows', count(*), NULL FROM panel
UNION ALL SELECT 'sales', 'null_cells', count(*) - count(sales), NULL FROM panel
UNION ALL SELECT 'sales', 'duplicates', count(*) - count(DISTINCT (store_id, item_id, d)), NULL FROM panel
UNION ALL SELECT 'sales', 'negative_sales', count(*) FILTER (sales < 0), count(*) FILTER (sales < 0) = 0 FROM panel
"""


@query("a12_findings", _FINDINGS)
def findings(retail):
    return A.validate(_m5_tables(retail))


@query("a12_overall_status", f"""
SELECT bool_and(passed) AS all_passed, count(*) FILTER (NOT passed) AS failed_checks FROM ({_FINDINGS})
""")
def overall_status(retail):
    return A.overall_status(A.validate(_m5_tables(retail)))


_REPORT = f"""
SELECT CAST(line_no AS INTEGER) AS line_no, line FROM (
  SELECT 5 + row_number() OVER (ORDER BY dataset, "check") AS line_no, '| ' || dataset || ' | ' || "check" || ' | ' || value
    || ' | ' || CASE WHEN passed IS NULL THEN 'info' WHEN passed THEN 'ok' ELSE 'FAILED' END || ' |' AS line FROM ({_FINDINGS})
  UNION ALL SELECT unnest(range(0, 6)), unnest(['# Table checks', '',
    CASE WHEN bool_and(passed) THEN 'Status: all checks passed' ELSE 'Status: ' || count(*) FILTER (NOT passed) || ' checks failed' END,
    '', '| dataset | check | value | result |', '| --- | --- | --- | --- |']) FROM ({_FINDINGS}))
"""


@query("a12_report", _REPORT)
def report(retail):
    return A.report_lines(A.validate(_m5_tables(retail)))


def _sample_sql(dataset: str, table: str, count: int, columns: list[str], order: str, first: int) -> str:
    shown = " || ' | ' || ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    names, marks = " | ".join(columns), " | ".join("---" for _ in columns)
    return f"""
SELECT CAST({first} + unnest(range(0, 5)) AS INTEGER) AS line_no, unnest(['', '## {dataset}: ' || count(*) || ' rows, {count} columns', '',
    '| {names} |', '| {marks} |']) AS line FROM {table}
UNION ALL SELECT CAST({first} + 4 + row_number() OVER (ORDER BY {order}) AS INTEGER), '| ' || {shown} || ' |' FROM (SELECT * FROM {table} ORDER BY {order} LIMIT 3)"""


@query("a12_full_report", " UNION ALL ".join([
    f"SELECT * FROM ({_REPORT})", _sample_sql("calendar", "calendar", 14, ["date", "wm_yr_wk", "weekday"], "date", 100),
    _sample_sql("sell_prices", "prices", 4, ["store_id", "item_id", "wm_yr_wk"], "store_id, item_id, wm_yr_wk", 200),
    _sample_sql("sales", "(SELECT item_id || '_' || store_id || '_validation' AS id, item_id, item_id AS dept_id, day_no FROM panel)", 8,
                ["id", "item_id", "dept_id"], "id, day_no", 300)]))
def full_report(retail):
    """The validation job in one frame: status, checks, shapes and the first rows of each table."""
    return A.full_report(_m5_tables(retail), {
        "calendar": ["date"], "sell_prices": ["store_id", "item_id", "wm_yr_wk"], "sales": ["id", "d"]}, columns=3)


@query("a13_shape", """
SELECT 'calendar' AS dataset, count(*) AS "rows", 14 AS columns, 0 AS day_columns FROM calendar
UNION ALL SELECT 'sales_wide', count(*), CAST(6 + (SELECT count(*) FROM calendar) AS INTEGER),
  CAST((SELECT count(*) FROM calendar) AS INTEGER) FROM series
""")
def shape(retail):
    return A.table_shape(retail.calendar).select(F.lit("calendar").alias("dataset"), "*").unionByName(
        A.table_shape(wide_sales(retail)).select(F.lit("sales_wide").alias("dataset"), "*"))


@query("a14_reject_requests", """
SELECT r.store_id, r.item_id, CASE
    WHEN r.store_id NOT IN (SELECT store_id FROM sales_daily) THEN 'unknown store'
    WHEN r.item_id NOT IN (SELECT item_id FROM sales_daily) THEN 'unknown product'
    ELSE 'no rows for this store and product' END AS reason
FROM (SELECT DISTINCT CASE WHEN n_nationkey % 5 = 4 THEN 'NATION_X' ELSE n_name END AS store_id,
             CASE WHEN p_size > 45 THEN 'LUXURY' ELSE p_type END AS item_id
      FROM part JOIN nation ON p_partkey % 25 = n_nationkey) r
WHERE NOT EXISTS (SELECT 1 FROM sales_daily s WHERE s.store_id = r.store_id AND s.item_id = r.item_id)
""")
def reject_requests(retail):
    nation = retail.table("nation").select(
        "n_nationkey", F.when(F.col("n_nationkey") % 5 == 4, F.lit("NATION_X")).otherwise(F.col("n_name"))
        .alias("store_id"))
    requests = (
        retail.table("part")
        .select((F.col("p_partkey") % 25).alias("n_nationkey"),
                F.when(F.col("p_size") > 45, F.lit("LUXURY")).otherwise(F.col("p_type")).alias("item_id"))
        .join(nation, "n_nationkey").select("store_id", "item_id").distinct()
    )
    return A.reject_requests(requests, retail.daily)


@query("a15_stores", "SELECT DISTINCT store_id FROM sales_daily")
def stores(retail):
    return A.store_list(retail.daily)


@query("a15_items_of_store", "SELECT DISTINCT item_id FROM sales_daily WHERE store_id = 'NATION_7'")
def items_of_store(retail):
    return A.items_of_store(retail.daily, "NATION_7")


@query("a18_calendar", """
SELECT date, wm_yr_wk, weekday, wday, month, year, d, event_name_1, event_type_1, event_name_2, event_type_2,
  "snap_AFRICA", "snap_AMERICA", "snap_ASIA" FROM calendar
""")
def calendar(retail):
    return retail.calendar
