"""Prediction intervals from past one-step errors, and their scores."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.functions import normal
from stockloom.operators.panel import in_order


def seasonal_residuals(df: DataFrame, period: int = V.SEASON, warmup: int = V.RESIDUAL_WARMUP) -> DataFrame:
    """Errors of the one-step seasonal naive forecast after the first ``warmup`` days."""
    order, sales = in_order(df), F.col("sales").cast("double")
    return df.select(
        *V.SERIES, "date", (sales - F.lag(sales, period).over(order)).alias("residual"),
        F.row_number().over(order).alias("position"),
    ).where(F.col("position") > warmup).drop("position")


def residual_spread(residuals: DataFrame) -> DataFrame:
    """Population deviation and number of residuals per series."""
    return residuals.groupBy(*V.SERIES).agg(
        F.stddev_pop("residual").alias("spread"), F.count("residual").alias("residuals"))


def prediction_intervals(
    forecast: DataFrame, spread: DataFrame, confidence: float | Column = V.INTERVAL_CONFIDENCE,
) -> DataFrame:
    """P10, P50 and P90 around the point forecast; the bounds are cut at 0.

    The names hold for 80 % confidence; another level moves the bounds and is kept in
    ``confidence``. Without two residuals the deviation is a share of the mean forecast.
    """
    level = confidence if isinstance(confidence, Column) else F.lit(confidence)
    z = normal.quantile((1 + level) / 2) if isinstance(confidence, Column) else normal.quantile_of((1 + confidence) / 2)
    mean = F.avg("yhat").over(Window.partitionBy(*V.SERIES))
    fallback = F.greatest(F.lit(V.FALLBACK_SIGMA_FLOOR), mean * V.FALLBACK_SIGMA_SHARE)
    sigma = F.when(F.coalesce("residuals", F.lit(0)) > 1, F.col("spread")).otherwise(fallback)
    joined = forecast.join(spread, V.SERIES, "left").withColumn("sigma", sigma)
    half = z * F.col("sigma")
    return joined.withColumns({
        "p10": F.greatest(F.lit(0.0), F.col("yhat") - half),
        "p50": F.col("yhat"),
        "p90": F.greatest(F.lit(0.0), F.col("yhat") + half),
        "confidence": level,
    }).drop("spread", "residuals", "yhat")


def crps(y: Column, mu: Column, sigma: Column) -> Column:
    """Continuous ranked probability score of a normal forecast."""
    spread = F.greatest(F.lit(V.CRPS_SIGMA_FLOOR), sigma)
    z = (y - mu) / spread
    return spread * (z * (2 * normal.distribution(z) - 1) + 2 * normal.density(z) - 1 / math.sqrt(math.pi))


def interval_scores(scored: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """CRPS, coverage and mean width per series for rows with ``actual`` and an interval.

    Without a ``sigma`` column the deviation of the errors around p50 is used.
    """
    keys = V.SERIES if keys is None else keys
    if "sigma" not in scored.columns:
        own = scored.groupBy(*keys).agg(F.stddev_pop(F.col("actual") - F.col("p50")).alias("sigma"))
        scored = scored.join(own, keys)
    inside = F.col("actual").between(F.col("p10"), F.col("p90"))
    return scored.groupBy(*keys).agg(
        F.avg(crps(F.col("actual"), F.col("p50"), F.col("sigma"))).alias("CRPS"),
        F.avg(inside.cast("double")).alias("Coverage"),
        F.avg(F.col("p90") - F.col("p10")).alias("IntervalWidth"))
