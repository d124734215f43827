"""Any forecaster by name, with one output shape and the shared fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.operators import additive, arima, forecast as C, piecewise, resumable, smoothing, trees
from stockloom.operators import backtest as D
from stockloom.operators import intervals as I
from stockloom.operators import inventory as G
from stockloom.operators.series_fit import as_forecast


def _recursive(panel: DataFrame, horizon: int, calendar: DataFrame | None = None, **fit) -> DataFrame:
    return trees.predict_recursive(trees.fit_recursive(panel, **fit), panel, horizon, calendar)


def _direct(panel: DataFrame, horizon: int, **fit) -> DataFrame:
    return trees.predict_direct(trees.fit_direct(panel, horizon, **fit), panel, horizon)


MODELS = {
    "naive": C.naive,
    "seasonal_naive": C.seasonal_naive,
    "moving_average": C.moving_average,
    "arima": lambda df, h, **p: as_forecast(arima.arima(df, h, **p)),
    "ets": lambda df, h, **p: as_forecast(smoothing.ets(df, h, **p)),
    "additive": lambda df, h, **p: as_forecast(additive.additive_regression(df, h, **p)),
    "piecewise": lambda df, h, **p: as_forecast(piecewise.piecewise_regression(df, h, **p)),
    "trees_recursive": _recursive,
    "trees_direct": _direct,
}


def forecast(panel: DataFrame, model: str, horizon: int, **parameters) -> DataFrame:
    """``(store_id, item_id, step, date, yhat, fallback_reason)`` for every series.

    Where the model has no number for a series the naive forecast stands in, and the
    reason says so.
    """
    if model not in MODELS:
        raise ValueError(f"unknown model {model!r}; known: {', '.join(MODELS)}")
    made = MODELS[model](panel, horizon, **parameters)
    return C.with_fallback(made, C.naive(panel, horizon))


WALKED = {"arima": arima.arima, "ets": smoothing.ets, "additive": additive.additive_regression,
          "piecewise": piecewise.piecewise_regression}


def backtest(
    df: DataFrame, models: list[str], initial: int = V.BACKTEST_INITIAL, step: int = V.BACKTEST_STEP,
    horizon: int = V.BACKTEST_HORIZON, trees_parameters: dict | None = None,
) -> DataFrame:
    """``(series, origin, step, model, yhat, actual, fallback)`` of any models on the same origins.

    A model's forecast that is missing or not a number at an origin is replaced by the naive one,
    and ``fallback`` tells so. Trees are refitted at every origin, all of them over one binned table.
    """
    if unknown := [m for m in models if m not in MODELS]:
        raise ValueError(f"no backtest of {', '.join(unknown)}")
    base = D.walk_forward(df, initial, step, horizon)
    naive = base.where(F.col("model") == "naive").select(*V.SERIES, "origin", "step", "actual", F.col("yhat").alias("_naive"))
    made = base.where(F.col("model").isin(models)).select(*V.SERIES, "origin", "step", "model", "yhat")
    for name in models:
        if name in WALKED:
            made = made.unionByName(as_forecast(WALKED[name](df, horizon, backtest=(initial, step))).select(
                *V.SERIES, "origin", "step", F.lit(name).alias("model"), "yhat"))
        elif name in ("trees_recursive", "trees_direct"):
            made = made.unionByName(trees.tree_backtest(
                df, trees.origins(df, initial, step, horizon), horizon, direct=name == "trees_direct",
                **(trees_parameters or {})).withColumn("model", F.lit(name)))
    wanted = naive.select("*", F.explode(F.array(*(F.lit(m) for m in models))).alias("model"))
    joined = wanted.join(made, [*V.SERIES, "origin", "step", "model"], "left")
    usable = F.col("yhat").isNotNull() & ~F.isnan("yhat")
    return joined.select(*V.SERIES, "origin", "step", "model", F.when(usable, F.col("yhat")).otherwise(F.col("_naive")).alias("yhat"),
                         "actual", (~usable).alias("fallback"))


def plan_from_forecast(
    point: DataFrame, df: DataFrame, stock: DataFrame, confidence: float = V.INTERVAL_CONFIDENCE, **policy,
) -> DataFrame:
    """The planning table for any model's forecast rows."""
    return _plan(point, I.residual_spread(I.seasonal_residuals(df)), G.demand_stats(df), stock, confidence, policy)


def plan_from_states(
    states: DataFrame, stock: DataFrame, horizon: int, confidence: float = V.INTERVAL_CONFIDENCE, **policy,
) -> DataFrame:
    """The planning table by smoothing, from stored states alone: no sales row is read."""
    return _plan(resumable.forecast(states, horizon), resumable.spread(states), resumable.demand(states), stock, confidence, policy)


def _plan(point: DataFrame, spread: DataFrame, demand: DataFrame, stock: DataFrame, confidence: float, policy: dict) -> DataFrame:
    bands = I.prediction_intervals(point, spread, confidence).groupBy(*V.SERIES).agg(
        F.sum("p50").alias("forecast_sum"), F.sum("p10").alias("p10_sum"), F.sum("p90").alias("p90_sum"),
        F.first("sigma").alias("sigma"), F.max("date").alias("horizon_end"))
    return G.policies(demand.join(stock, V.SERIES), **policy).join(bands, V.SERIES)
