"""Replenishment policies as column expressions, one row per series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.functions import normal


def _column(value: float | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(float(value))


def demand_stats(df: DataFrame) -> DataFrame:
    """Mean and population deviation of daily demand, each at least 0.1."""
    sales = F.col("sales").cast("double")
    return df.groupBy(*V.SERIES).agg(
        F.greatest(F.lit(V.DEMAND_FLOOR), F.avg(sales)).alias("demand_mean"),
        F.greatest(F.lit(V.DEMAND_FLOOR), F.stddev_pop(sales)).alias("demand_std"))


def sparse_demand_stats(daily: DataFrame, days: Column, keys: list[str]) -> DataFrame:
    """:func:`demand_stats` from the days with sales only; the other days are zeros.

    Two sums give both moments, so no dense panel is built.
    """
    sales = F.col("sales").cast("double")
    mean = F.sum(sales) / days
    variance = F.sum(sales * sales) / days - mean * mean
    return daily.groupBy(*keys).agg(
        F.greatest(F.lit(V.DEMAND_FLOOR), mean).alias("demand_mean"),
        F.greatest(F.lit(V.DEMAND_FLOOR), F.sqrt(F.greatest(F.lit(0.0), variance))).alias("demand_std"))


def policies(
    stock: DataFrame,
    lead_time: float | Column = V.LEAD_TIME_DAYS,
    review: float | Column = V.REVIEW_DAYS,
    service_level: float | Column = V.SERVICE_LEVEL,
    holding_cost: float | Column = V.HOLDING_COST,
    stockout_cost: float | Column = V.STOCKOUT_COST,
) -> DataFrame:
    """All policy figures from ``demand_mean, demand_std, on_hand`` and optional ``on_order``.

    Every parameter may be one number or a column, so each series can have its own lead
    time, costs and service level.
    """
    if "on_order" not in stock.columns:
        stock = stock.withColumn("on_order", F.lit(0.0))
    lead, cycle = _column(lead_time), _column(review)
    hold, lose = _column(holding_cost), _column(stockout_cost)
    mean, std = F.col("demand_mean"), F.col("demand_std")
    floored = lambda days: F.greatest(F.lit(V.POLICY_STD_FLOOR), std * F.sqrt(days))
    z = normal.quantile_of(service_level)
    ratio = lose / (lose + hold * lead)
    fixed = not any(isinstance(p, Column) for p in (lead_time, holding_cost, stockout_cost))
    z_ratio = (
        normal.quantile_of(stockout_cost / (stockout_cost + holding_cost * lead_time)) if fixed
        else normal.quantile(ratio))

    levels = stock.withColumns({
        "ltd_mean": mean * lead,
        "ltd_std": floored(lead),
        "inventory_position": F.col("on_hand") + F.col("on_order"),
    }).withColumn("safety_stock", z * F.col("ltd_std")).withColumns({
        "reorder_point": F.col("ltd_mean") + F.col("safety_stock"),
        "order_up_to_level": mean * (cycle + lead) + z * floored(cycle + lead),
        "newsvendor_level": F.col("ltd_mean") + z_ratio * F.col("ltd_std"),
        "critical_ratio": ratio,
    })
    position, target = F.col("inventory_position"), F.col("order_up_to_level")
    zero = F.lit(0.0)
    short = F.col("ltd_std") * normal.loss((F.col("on_hand") - F.col("ltd_mean")) / F.col("ltd_std"))
    return levels.withColumns({
        "order_out": F.greatest(zero, target - position),
        "order_s_s": F.when(position <= F.col("reorder_point"), target - position).otherwise(zero),
        "order_newsvendor": F.greatest(zero, F.col("newsvendor_level") - position),
        "expected_shortage": short,
        "holding_cost": F.col("on_hand") * hold * lead,
        "stockout_cost": short * lose,
        "inventory_health": (
            F.when(F.col("on_hand") < F.col("safety_stock"), V.UNDERSTOCK)
            .when(F.col("on_hand") > target, V.OVERSTOCK).otherwise(V.HEALTHY)),
        "under_stock_alert": F.col("on_hand") < F.col("safety_stock"),
    })


def simple_order(stock: DataFrame, demand: str = "demand_sum", on_hand: str = "on_hand", buffer: str = "buffer") -> DataFrame:
    """Forecast demand minus stock plus buffer, never negative; alert below the buffer."""
    return stock.withColumns({
        "recommended_order": F.greatest(F.lit(0.0), F.col(demand) - F.col(on_hand) + F.col(buffer)),
        "under_stock_alert": F.col(on_hand) < F.col(buffer),
    })


def health_matrix(rows: DataFrame, key: str, category: str, status: str = V.UNDERSTOCK) -> DataFrame:
    """Series with ``status`` in each cell (key, category), in long form so that no category is left out."""
    return rows.groupBy(key, category).agg(F.count_if(F.col("inventory_health") == status).alias("series"))


def worst_status_matrix(rows: DataFrame, key: str, category: str) -> DataFrame:
    """The most urgent status of each cell (key, category): understock, then overstock, then healthy."""
    urgency = F.array_position(F.array(F.lit(V.UNDERSTOCK), F.lit(V.OVERSTOCK), F.lit(V.HEALTHY)), F.col("inventory_health"))
    return rows.groupBy(key, category).agg(F.min_by("inventory_health", urgency).alias("status"))
