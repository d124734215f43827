"""Additive regression with a trend that may bend: weekly and yearly waves and a piecewise linear trend.

The least-squares system of any origin is a difference of running sums. Spark keeps, per series, the sums of y,
t y, y y and of y times every wave up to the origins and up to the possible bends; no raw day reaches Python.
The waves, level and slope have a light ridge and are eliminated from the system; the bends that are left have
an L1 penalty and are found by coordinate descent for all series of a batch together, so most stay at zero.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.operators.additive import RIDGE, WEEKLY_TERMS, YEARLY_TERMS, design
from stockloom.operators.forecast import check_horizon
from stockloom.operators.panel import in_order

SPACING = 91          # days between possible bends
SHARE = 0.8           # of the history, from its start, that bends may lie in
SHRINK = 0.01         # L1 weight of a bend, times days times the deviation of the sales
SWEEPS, SETTLED = 500, 1e-9


def waves(weekly: int, yearly: int) -> list:
    """Sine and cosine columns of the date, in the order of :func:`additive.design`."""
    day, out = F.datediff("date", F.lit("1970-01-01").cast("date")), []
    for period, terms in ((V.DAYS_PER_WEEK, weekly), (V.DAYS_PER_YEAR, yearly)):
        for k in range(1, terms + 1):
            angle = F.lit(2 * np.pi * k / period) * day
            out += [F.sin(angle), F.cos(angle)]
    return out


def running_moments(
    df: DataFrame, horizon: int, weekly: int = WEEKLY_TERMS, yearly: int = YEARLY_TERMS,
    backtest: tuple[int, int] | None = None, spacing: int = SPACING,
) -> DataFrame:
    """Sums over a series' first ``day`` days at its origins and possible bends.

    Columns: series, first_date, days, day, is_origin, total (of y), moment (of t y, t from 0), squares (of y y)
    and waves (of y times each wave). One window by series serves all sums.
    """
    order = in_order(df)
    past = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*V.SERIES)
    y, t = F.col("sales").cast("double"), F.row_number().over(order) - 1
    named = {f"_w{i}": wave for i, wave in enumerate(waves(weekly, yearly))}
    placed = df.select(*V.SERIES, "date", y.alias("y"), t.alias("t"), F.min("date").over(whole).alias("first_date"),
                       F.count(F.lit(1)).over(whole).alias("days"), *(w.alias(c) for c, w in named.items()),
                       *(c for c in ("day_no",) if c in df.columns))
    sums = placed.select(
        *V.SERIES, "first_date", F.col("days").cast("int").alias("days"), (F.col("t") + 1).alias("day"),
        F.sum("y").over(past).alias("total"), F.sum(F.col("t") * F.col("y")).over(past).alias("moment"),
        F.sum(F.col("y") * F.col("y")).over(past).alias("squares"),
        (F.array(*(F.sum(F.col(c) * F.col("y")).over(past) for c in named)) if named else F.array().cast("array<double>")).alias("waves"))
    if backtest is None:
        origin = F.col("day") == F.col("days")
    else:
        initial, step = backtest
        origin = (F.col("day") >= initial) & (F.col("day") <= F.col("days") - horizon) & (F.pmod(F.col("day") - initial, F.lit(step)) == 0)
    return sums.withColumn("is_origin", origin).where(F.col("is_origin") | (F.pmod("day", F.lit(spacing)) == 0))


def shrunken_bends(gram: np.ndarray, moments: np.ndarray, penalty: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Bends x series that minimise 1/2 b'Gb - b'm + penalty |b| of every series, by coordinate descent."""
    found = np.zeros(moments.shape) if start is None else start.copy()
    if not len(gram):
        return found
    left = moments - gram @ found
    size = np.maximum(np.diag(gram), 1e-12)
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(gram)):
            pull = left[j] + size[j] * found[j]
            new = np.sign(pull) * np.maximum(np.abs(pull) - penalty, 0.0) / size[j]
            change = new - found[j]
            if np.any(change):
                left -= gram[:, j:j + 1] * change
                found[j] = new
                moved = max(moved, float(np.max(np.abs(change) * np.sqrt(size[j]) / np.sqrt(1e-12 + np.max(np.abs(moments))))))
        if moved < SETTLED:
            break
    return found


def _solve(days: np.ndarray, sums: dict[str, np.ndarray], origins: list[int], first: pd.Timestamp, horizon: int,
           weekly: int, yearly: int, ridge: float, shrink: float, spacing: int, share: float):
    """Per origin (intercept, slope, number of bends) and paths of the series of one batch, which share their days."""
    at = {int(d): i for i, d in enumerate(days)}
    fixed_all = design(first, np.arange(max(origins) + horizon), 1.0, weekly, yearly)
    t = np.arange(max(origins) + horizon)
    before: np.ndarray | None = None
    for origin in origins:
        scale = float(max(origin - 1, 1))
        bends = np.array([c for c in range(spacing, int(share * origin) + 1, spacing)], int)
        fixed, bent = fixed_all.copy(), np.maximum(0.0, t[:, None] - bends[None, :]) / scale
        fixed[:, 1] /= scale
        o = at[origin]
        total, moment = sums["total"][:, o], sums["moment"][:, o]
        known = np.vstack([total, moment / scale, sums["waves"][:, o].T]) if fixed.shape[1] > 2 else np.vstack([total, moment / scale])
        hinge = np.array([((moment - sums["moment"][:, at[c]]) - c * (total - sums["total"][:, at[c]])) / scale for c in bends]).reshape(len(bends), len(total))
        past, gone = fixed[:origin], bent[:origin]
        penalty = np.eye(past.shape[1]) * ridge
        penalty[0, 0] = 0.0
        inner = np.linalg.pinv(past.T @ past + penalty)
        cross = past.T @ gone
        gram, pull = gone.T @ gone - cross.T @ inner @ cross, hinge - cross.T @ inner @ known
        deviation = np.sqrt(np.maximum(0.0, sums["squares"][:, o] / origin - (total / origin) ** 2))
        start = None
        if before is not None and len(bends):
            start = np.zeros((len(bends), len(total)))
            start[:len(before)] = before[:len(bends)]
        found = shrunken_bends(gram, pull, shrink * origin * deviation, start)
        before = found
        weights = inner @ (known - cross @ found)
        ahead = slice(origin, origin + horizon)
        path = (fixed[ahead] @ weights + bent[ahead] @ found).T
        yield origin, np.column_stack([weights[0], (weights[1] + found.sum(axis=0)) / scale, (np.abs(found) > 0).sum(axis=0)]), path


def piecewise_regression(
    df: DataFrame, horizon: int, weekly: int = WEEKLY_TERMS, yearly: int = YEARLY_TERMS, ridge: float = RIDGE,
    shrink: float = SHRINK, spacing: int = SPACING, share: float = SHARE, backtest: tuple[int, int] | None = None,
) -> DataFrame:
    """Rows ``(series, first_date, origin, intercept, slope, bends, path)``; ``slope`` is the daily one at the origin.

    Bends may lie every ``spacing`` days in the first ``share`` of the history; with an infinite ``shrink`` there are
    none and the result is the plain additive regression's. Nothing is fitted again from raw days at an origin.
    """
    check_horizon(horizon)
    fields = ["day", "is_origin", "total", "moment", "squares", "waves"]
    held = running_moments(df, horizon, weekly, yearly, backtest, spacing).groupBy(*V.SERIES, "first_date", "days").agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("rows"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for (first, _), same in frame.groupby(["first_date", "days"]):
                rows = same["rows"].tolist()
                days = np.array([r["day"] for r in rows[0]])
                origins = [int(r["day"]) for r in rows[0] if r["is_origin"]]
                if not origins:
                    continue
                sums = {c: np.array([[r[c] for r in one] for one in rows], float) for c in ("total", "moment", "squares")}
                sums["waves"] = np.array([[np.asarray(r["waves"], float) for r in one] for one in rows])
                for origin, chosen, path in _solve(days, sums, origins, pd.Timestamp(first), horizon, weekly, yearly, ridge, shrink, spacing, share):
                    yield same[[*V.SERIES, "first_date"]].assign(
                        origin=origin, intercept=chosen[:, 0], slope=chosen[:, 1], bends=chosen[:, 2].astype(int), path=list(path))

    return held.mapInPandas(run, "store_id string, item_id string, first_date date, origin int, intercept double, slope double, "
                                 "bends int, path array<double>")
