"""Walks that go on from a stored state: a new day costs one day, not the whole history.

A series' state is what smoothing and planning need of its past: level, trend and squared errors of every smoothing
candidate, the newest sales, and the moments of the sales and of their seasonal errors. ``advance`` takes states and
new days; the state after yesterday and today equals the state of the whole walk, bit for bit, because both do the same
steps in the same order. States are bounded by the candidates and the season, whatever the length of the history.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.errors import DataValidationError
from stockloom.operators.forecast import check_horizon, steps
from stockloom.operators.smoothing import LEVEL_GRID, TREND_GRID
from stockloom.session import scratch_path

MOMENTS = ("total", "squares", "residuals", "residual_total", "residual_squares")
STATE = ("store_id string, item_id string, last_date date, days int, level array<double>, trend array<double>, errors array<double>, "
         "newest array<double>, " + ", ".join(f"{m} double" for m in MOMENTS))


def candidates(levels: list[float] = LEVEL_GRID, trends: list[float] = TREND_GRID) -> np.ndarray:
    """alpha and beta of every smoothing candidate, in the order of the state's arrays."""
    return np.array(list(itertools.product(levels, trends)))


def _day(state: dict, value: np.ndarray, alpha: np.ndarray, beta: np.ndarray, period: int, warmup: int) -> None:
    """Take one day's sales of several series into their state (arrays by series)."""
    first = state["days"] == 0
    error = np.where(first[:, None], 0.0, value[:, None] - state["level"] - state["trend"])
    state["errors"] += error * error
    moved = state["level"] + state["trend"] + alpha * error
    state["level"] = np.where(first[:, None], value[:, None], moved)
    state["trend"] = state["trend"] + alpha * beta * error
    state["total"] += value
    state["squares"] += value * value
    late = state["days"] >= max(warmup, period)
    residual = np.where(late, value - state["newest"][:, 0], 0.0)
    state["residuals"] += late
    state["residual_total"] += residual
    state["residual_squares"] += residual * residual
    state["newest"] = np.column_stack([state["newest"][:, 1:], value])
    state["days"] = state["days"] + 1


def advance(
    states: DataFrame | None, days: DataFrame, levels: list[float] = LEVEL_GRID, trends: list[float] = TREND_GRID,
    period: int = V.SEASON, warmup: int = V.RESIDUAL_WARMUP,
) -> DataFrame:
    """States after ``days`` (series, date, sales); without ``states`` the walk begins.

    A series' days up to its state's last date were taken before and are passed over, so a day that is given twice
    counts once; days after it must follow without a gap, else the job fails. Series without new days keep their
    state, new series begin one. Only ``days`` and the states are read.
    """
    grid = candidates(levels, trends)
    alpha, beta = grid.T
    known = days.select(*V.SERIES, "date", F.col("sales").cast("double").alias("sales"))
    pair = F.sort_array(F.collect_list(F.struct("date", "sales")))
    if states is None:
        states = days.sparkSession.createDataFrame([], STATE)
    new = known.join(states.select(*V.SERIES, "last_date"), V.SERIES, "left").where(
        F.col("last_date").isNull() | (F.col("date") > F.col("last_date"))).groupBy(*V.SERIES).agg(pair.alias("new"))
    held = states.join(new, V.SERIES, "full")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            counts = frame["new"].map(lambda x: 0 if x is None else len(x))
            for (count, _), same in frame.groupby([counts, frame["days"].isna()]):
                n, begun = len(same), same["days"].notna().iloc[0]
                dates = [] if not count else [[pd.Timestamp(r["date"]) for r in row] for row in same["new"]]
                for last, row in zip(same["last_date"], dates):
                    expected = ([pd.Timestamp(last)] if begun else []) + row
                    if any((b - a).days != 1 for a, b in itertools.pairwise(expected)):
                        raise DataValidationError("new days", "Days do not follow each other in")
                state = {"days": same["days"].to_numpy(np.int64) if begun else np.zeros(n, np.int64)}
                for name, width in (("level", len(grid)), ("trend", len(grid)), ("errors", len(grid)), ("newest", period)):
                    state[name] = np.stack(same[name].to_numpy()).astype(float) if begun else np.zeros((n, width))
                for name in MOMENTS:
                    state[name] = same[name].to_numpy(float).copy() if begun else np.zeros(n)
                for day in range(count):
                    _day(state, np.array([row[day]["sales"] for row in same["new"]], float), alpha, beta, period, warmup)
                out = same[V.SERIES].assign(last_date=[row[-1].date() for row in dates] if count else list(same["last_date"]), days=state["days"])
                for name in ("level", "trend", "errors", "newest"):
                    out[name] = list(state[name])
                yield out.assign(**{name: state[name] for name in MOMENTS})

    return held.select(*states.columns, "new").mapInPandas(run, STATE)


def store(states: DataFrame, path: str | None = None) -> DataFrame:
    """Write the states (default: a fresh path of the shared folder) and read them again."""
    path = path or scratch_path(states.sparkSession, "series-states")
    states.write.mode("overwrite").parquet(path)
    return states.sparkSession.read.schema(states.schema).parquet(path)


def forecast(states: DataFrame, horizon: int, levels: list[float] = LEVEL_GRID, trends: list[float] = TREND_GRID) -> DataFrame:
    """(series, alpha, beta, sse, step, date, yhat): the smoothing forecast of the candidate with the least errors."""
    grid = candidates(levels, trends).tolist()
    best = F.array_position("errors", F.array_min("errors")).cast("int")
    at = lambda values: F.element_at(F.array(*(F.lit(v) for v in values)), F.col("_best"))
    return states.withColumn("_best", best).select(
        *V.SERIES, at([a for a, _ in grid]).alias("alpha"), at([b for _, b in grid]).alias("beta"), F.element_at("errors", F.col("_best")).alias("sse"),
        "last_date", F.element_at("level", F.col("_best")).alias("_level"), F.element_at("trend", F.col("_best")).alias("_trend"),
        steps(check_horizon(horizon)).alias("step")).select(
        *V.SERIES, "alpha", "beta", "sse", "step", F.date_add("last_date", F.col("step")).alias("date"),
        (F.col("_level") + F.col("_trend") * F.col("step")).alias("yhat"))


def spread(states: DataFrame) -> DataFrame:
    """Population deviation and number of the seasonal errors so far, as prediction intervals want them."""
    n = F.col("residuals")
    mean = F.col("residual_total") / n
    return states.select(*V.SERIES, F.when(n > 0, F.sqrt(F.greatest(F.lit(0.0), F.col("residual_squares") / n - mean * mean))).alias("spread"),
                         n.cast("bigint").alias("residuals"))


def demand(states: DataFrame) -> DataFrame:
    """Mean and population deviation of daily demand, each at least the floor."""
    mean = F.col("total") / F.col("days")
    variance = F.greatest(F.lit(0.0), F.col("squares") / F.col("days") - mean * mean)
    return states.select(*V.SERIES, F.greatest(F.lit(V.DEMAND_FLOOR), mean).alias("demand_mean"),
                         F.greatest(F.lit(V.DEMAND_FLOOR), F.sqrt(variance)).alias("demand_std"))
