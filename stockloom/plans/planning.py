"""Planning outputs that combine panel, forecast, interval and policy."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.functions import normal
from stockloom.operators import forecast as C
from stockloom.operators import inventory as G
from stockloom.operators.panel import in_order


def series_summary(
    df: DataFrame, rows: int = V.SEASON, period: int = V.SEASON, warmup: int = V.RESIDUAL_WARMUP,
) -> DataFrame:
    """Demand moments, residual deviation and newest sales of each series in one pass.

    What :func:`inventory.demand_stats`, :func:`intervals.residual_spread` and
    :func:`forecast.tails` give one by one; here the panel is sorted once and reduced on
    the spot, so only one row per series leaves a task.
    """
    order, sales = in_order(df), F.col("sales").cast("double")
    walked = df.select(
        *V.SERIES, "date", sales.alias("y"), F.row_number().over(order).alias("at"),
        F.lag(sales, period).over(order).alias("season_ago"),
        F.count(F.lit(1)).over(Window.partitionBy(*V.SERIES)).alias("days"))
    residual = F.when(F.col("at") > warmup, F.col("y") - F.col("season_ago"))
    newest = F.when(F.col("at") > F.col("days") - rows, F.struct("at", "y"))
    return walked.groupBy(*V.SERIES).agg(
        F.greatest(F.lit(V.DEMAND_FLOOR), F.avg("y")).alias("demand_mean"),
        F.greatest(F.lit(V.DEMAND_FLOOR), F.stddev_pop("y")).alias("demand_std"),
        F.stddev_pop(residual).alias("spread"), F.count(residual).alias("residuals"),
        F.max("date").alias("last_date"),
        F.transform(F.sort_array(F.collect_list(newest)), lambda r: r["y"]).alias("tail"))


def planning_table(
    df: DataFrame, stock: DataFrame, horizon: int = 14, confidence: float = V.INTERVAL_CONFIDENCE, **policy,
) -> DataFrame:
    """One row per series: seasonal forecast and interval sums over the horizon, and the policy."""
    summary = series_summary(df)
    z = normal.quantile_of((1 + confidence) / 2)
    path = F.transform(
        F.sequence(F.lit(1), F.lit(C.check_horizon(horizon))), lambda step: C.seasonal_value(F.col("tail"), step))
    total = lambda part: F.aggregate("path", F.lit(0.0), lambda acc, value: acc + part(value))
    fallback = F.greatest(
        F.lit(V.FALLBACK_SIGMA_FLOOR), F.col("forecast_sum") / horizon * V.FALLBACK_SIGMA_SHARE)
    half = z * F.col("sigma")
    bands = (
        summary.withColumn("path", path).withColumn("forecast_sum", total(lambda v: v))
        .withColumn("sigma", F.when(F.col("residuals") > 1, F.col("spread")).otherwise(fallback))
        .withColumns({
            "p10_sum": total(lambda v: F.greatest(F.lit(0.0), v - half)),
            "p90_sum": total(lambda v: F.greatest(F.lit(0.0), v + half)),
            "horizon_end": F.date_add("last_date", horizon),
        }).drop("path", "tail", "spread", "residuals", "last_date")
    )
    return G.policies(bands.join(stock, V.SERIES), **policy)


def chart_rows(df: DataFrame, bands: DataFrame, policy: DataFrame, history: int = V.CHART_HISTORY_DAYS) -> DataFrame:
    """The last days of each series and its forecast, with the reorder point on every row."""
    past = C.recent(df.select(*V.SERIES, "date", "sales"), history).select(
        *V.SERIES, "date", F.col("sales").alias("actual"))
    rows = past.unionByName(bands.select(*V.SERIES, "date", "p10", "p50", "p90"), allowMissingColumns=True)
    return rows.join(policy.select(*V.SERIES, "reorder_point"), V.SERIES)
