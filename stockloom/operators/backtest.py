"""Walk-forward backtest of all series at once, and the choice of a model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.functions.metrics import all_metrics
from stockloom.operators.panel import in_order

BASELINES = ["naive", "seasonal_naive", "moving_average"]


def origins(
    df: DataFrame, initial: int = V.BACKTEST_INITIAL, step: int = V.BACKTEST_STEP,
    horizon: int = V.BACKTEST_HORIZON,
) -> DataFrame:
    """Rolling origins per series; training uses the first ``origin`` days."""
    counts = df.groupBy(*V.SERIES).agg(F.count(F.lit(1)).cast("int").alias("days"))
    return counts.where(F.col("days") >= initial + horizon).select(
        *V.SERIES, F.explode(F.sequence(F.lit(initial), F.col("days") - horizon, F.lit(step))).alias("origin"))


def too_short_for_backtest(df: DataFrame, initial: int, horizon: int) -> DataFrame:
    return df.groupBy(*V.SERIES).agg(F.count(F.lit(1)).alias("days")).where(F.col("days") < initial + horizon)


def walk_forward(
    df: DataFrame, initial: int = V.BACKTEST_INITIAL, step: int = V.BACKTEST_STEP,
    horizon: int = V.BACKTEST_HORIZON, period: int = V.SEASON, window: int = V.SEASON,
) -> DataFrame:
    """Baseline forecasts at every origin next to the actual values.

    Each origin is the row it trains up to, so last value, season and trailing mean are
    windows ending there and the actuals one starting after it: one shuffle by series for
    all origins and models, and no join.
    """
    order, sales = in_order(df), F.col("sales").cast("double")
    trailing = lambda rows: order.rowsBetween(-(rows - 1), Window.currentRow)
    at_origin = df.select(
        *V.SERIES,
        F.row_number().over(order).alias("origin"),
        sales.alias("last"),
        F.collect_list(sales).over(trailing(period)).alias("season"),
        F.avg(sales).over(trailing(window)).alias("average"),
        F.collect_list(sales).over(order.rowsBetween(1, horizon)).alias("actuals"),
    ).where((F.col("origin") >= initial) & (F.size("actuals") == horizon)
            & (F.pmod(F.col("origin") - initial, F.lit(step)) == 0))
    days = at_origin.select("*", F.posexplode("actuals").alias("at", "actual"))
    in_season = F.try_element_at("season", (F.pmod(F.col("at"), F.lit(period)) + 1).cast("int"))
    values = [F.col("last"), F.when(F.size("season") < period, F.col("last")).otherwise(in_season), F.col("average")]
    forecasts = F.array(*(
        F.struct(F.lit(name).alias("model"), value.alias("yhat")) for name, value in zip(BASELINES, values)))
    return days.select(*V.SERIES, "origin", (F.col("at") + 1).alias("step"), "actual", F.inline(forecasts))


def attach_actuals(forecasts: DataFrame, df: DataFrame) -> DataFrame:
    """Actual values for forecasts given as ``(series, origin, step, model, yhat)``."""
    numbered = df.select(*V.SERIES, F.row_number().over(in_order(df)).alias("position"),
                         F.col("sales").cast("double").alias("actual"))
    return forecasts.withColumn("position", F.col("origin") + F.col("step")).join(
        numbered, [*V.SERIES, "position"]).drop("position")


def compare(pooled: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Accuracy measures per ``keys`` (default: series and model), all origins pooled."""
    keys = [*V.SERIES, "model"] if keys is None else keys
    return pooled.groupBy(*keys).agg(*all_metrics(F.col("actual"), F.col("yhat")))


def comparison_table(pooled: DataFrame) -> DataFrame:
    """Accuracy measures per series and model, in the reporting order."""
    return compare(pooled).select(*V.SERIES, "model", *V.METRIC_ORDER)


def best_model(comparison: DataFrame, model_order: list[str]) -> DataFrame:
    """Lowest WAPE per series; the earlier model in ``model_order`` wins a tie."""
    rank = F.array_position(F.array(*(F.lit(m) for m in model_order)), F.col("model"))
    return comparison.groupBy(*V.SERIES).agg(
        F.min_by("model", F.struct("WAPE", rank)).alias("best_model"), F.min("WAPE").alias("best_wape"))
