"""Additive regression per series: linear trend plus weekly and yearly Fourier terms."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from stockloom import fixed_values as V
from stockloom.operators.series_fit import fit_paths

WEEKLY_TERMS, YEARLY_TERMS, RIDGE = 3, 10, 1e-3


def design(first: pd.Timestamp, days: np.ndarray, scale: float, weekly: int, yearly: int) -> np.ndarray:
    """Columns 1, t, and sine/cosine pairs, for day offsets from the first day."""
    absolute = (first - pd.Timestamp("1970-01-01")).days + days
    columns = [np.ones(len(days)), days / scale]
    for period, terms in ((V.DAYS_PER_WEEK, weekly), (V.DAYS_PER_YEAR, yearly)):
        for k in range(1, terms + 1):
            angle = 2 * np.pi * k * absolute / period
            columns += [np.sin(angle), np.cos(angle)]
    return np.column_stack(columns)


def additive_regression(
    df: DataFrame, horizon: int, weekly: int = WEEKLY_TERMS, yearly: int = YEARLY_TERMS,
    ridge: float = RIDGE, backtest: tuple[int, int] | None = None,
) -> DataFrame:
    """Forecast paths with the fitted intercept and daily slope.

    Series that share their days share the design, so one small system is solved for many
    right-hand sides. The ridge keeps short series solvable and leaves the intercept free.
    """
    def walk(values, origins, first):
        results = []
        for origin in origins:
            scale = float(max(origin - 1, 1))
            known = design(first, np.arange(origin), scale, weekly, yearly)
            penalty = np.eye(known.shape[1]) * ridge
            penalty[0, 0] = 0.0
            weights = np.linalg.lstsq(known.T @ known + penalty, known.T @ values[:, :origin].T, rcond=None)[0]
            coming = design(first, np.arange(origin, origin + horizon), scale, weekly, yearly)
            results.append((np.column_stack([weights[0], weights[1] / scale]), (coming @ weights).T))
        return results

    return fit_paths(df, walk, ["intercept", "slope"], horizon, backtest)
