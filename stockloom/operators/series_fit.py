"""Per-series model fits over ordered arrays: Arrow batches in, forecast paths out.

Recursive models (smoothing, ARMA residuals) have to walk a series in order. Spark places
one bounded array per series; inside a task NumPy walks many series and all parameter
candidates together, one day at a time. Because candidates are scored by the errors up to
a day, a single walk also yields the forecasts of every backtest origin.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.operators.forecast import check_horizon, series_arrays

SERIES_PER_WALK = 256  # bounds a task's working memory: series x candidates

# Walk(values[series, days], origins, first_date) -> per origin (parameters[series, k], paths[series, horizon])
Walk = Callable[[np.ndarray, list[int], pd.Timestamp], list[tuple[np.ndarray, np.ndarray]]]


def backtest_origins(days: int, initial: int, step: int, horizon: int) -> list[int]:
    return list(range(initial, days - horizon + 1, step))


def fit_paths(
    df: DataFrame, walk: Walk, parameters: list[str], horizon: int,
    backtest: tuple[int, int] | None = None,
) -> DataFrame:
    """Rows ``(series, first_date, origin, <parameters>, path)``; without ``backtest`` the origin is the end.

    ``backtest`` is ``(initial, step)``; series too short for one origin give no row.
    """
    check_horizon(horizon)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch["y"].map(len)
            for (days, first), same in batch.groupby([lengths, "first_date"]):
                origins = [days] if backtest is None else backtest_origins(days, *backtest, horizon)
                for start in range(0, len(same) if origins else 0, SERIES_PER_WALK):
                    part = same.iloc[start:start + SERIES_PER_WALK]
                    values = np.stack(part["y"].to_numpy())
                    for origin, (chosen, paths) in zip(origins, walk(values, origins, pd.Timestamp(first))):
                        out = part[[*V.SERIES, "first_date"]].assign(origin=origin)
                        for at, name in enumerate(parameters):
                            out[name] = chosen[:, at]
                        yield out.assign(path=list(paths))

    columns = [f"{k} string" for k in V.SERIES] + ["first_date date", "origin int"] + [f"{p} double" for p in parameters]
    schema = ", ".join([*columns, "path array<double>"])
    return series_arrays(df).select(*V.SERIES, "first_date", "y").mapInPandas(run, schema)


def as_forecast(paths: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per series, origin and step, with its date and the ``keep`` columns."""
    return paths.select("*", F.posexplode("path").alias("at", "yhat")).select(
        *V.SERIES, "origin", *keep, (F.col("at") + 1).alias("step"),
        F.date_add("first_date", F.col("origin") + F.col("at")).alias("date"), "yhat")


def least(errors: np.ndarray) -> np.ndarray:
    """Index of the candidate with the least squared error; the first one on ties."""
    return np.argmin(errors, axis=1)


def take(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return values[np.arange(len(at)), at]
