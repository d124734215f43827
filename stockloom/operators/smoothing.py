"""Exponential smoothing with additive trend and optional additive season."""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame

from stockloom.operators.series_fit import fit_paths, least, take

LEVEL_GRID = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
TREND_GRID = [0.0, 0.05, 0.1, 0.2, 0.4]
SEASON_GRID = [0.05, 0.15, 0.3]


def ets(
    df: DataFrame, horizon: int, period: int | None = None,
    backtest: tuple[int, int] | None = None,
    levels: list[float] = LEVEL_GRID, trends: list[float] = TREND_GRID, seasons: list[float] = SEASON_GRID,
    estimate: bool = False,
) -> DataFrame:
    """Best of a small parameter grid by squared one-step error, per series; with ``estimate`` improved from there by
    :func:`improved` (at the end of the series only).

    In error form, with ``e`` the one-step error: level += trend + alpha e,
    trend += alpha beta e, season += gamma (1 - alpha) e. Without a season the level
    starts at the first value, with one at the mean of the first season; the trend starts
    at 0. A series without one whole season gets an empty (NaN) path.
    """
    candidates = np.array(list(itertools.product(levels, trends, seasons if period else [0.0])))
    alpha, beta, gamma = candidates.T
    if estimate and backtest is not None:
        raise ValueError("estimated smoothing has no backtest; the grid has one")

    def walk(values, origins, _first):
        count, days = values.shape
        warmup = period or 1
        wanted, results = set(origins), []
        shape = (count, len(candidates))
        start = values[:, :warmup].mean(axis=1, keepdims=True)
        level, trend, errors = np.broadcast_to(start, shape).copy(), np.zeros(shape), np.zeros(shape)
        season = [np.broadcast_to(values[:, i:i + 1] - start, shape).copy() if period and i < days
                  else np.zeros(shape) for i in range(warmup)]
        ahead = np.arange(1, horizon + 1)
        for day in range(1, days + 1):
            if day > warmup:
                place = (day - 1) % warmup
                error = values[:, day - 1:day] - level - trend - season[place]
                errors += error * error
                level = level + trend + alpha * error
                trend = trend + alpha * beta * error
                if period:
                    season[place] = season[place] + gamma * (1 - alpha) * error
            if day in wanted:
                best = least(errors)
                path = take(level, best)[:, None] + take(trend, best)[:, None] * ahead
                if period:
                    coming = np.stack([take(s, best) for s in season], axis=1)
                    path = path + coming[:, (day + ahead - 1) % warmup]
                if day < warmup:
                    path = np.full_like(path, np.nan)
                chosen = np.column_stack([candidates[best], take(errors, best)])
                if estimate and day > warmup + 1:
                    chosen, path = _estimated(values[:, :day], candidates[best], start[:, 0], period, ahead)
                results.append((chosen, path))
        return results

    return fit_paths(df, walk, ["alpha", "beta", "gamma", "sse"], horizon, backtest)


NEWTON_STEPS = 40
LEAST_LEVEL, MOST_LEVEL = 1e-4, 0.9999


def _estimated(values: np.ndarray, chosen: np.ndarray, start: np.ndarray, period: int | None, ahead: np.ndarray):
    """Parameters (alpha, beta, gamma, sse) and paths of the fit that begins at the grid's choice."""
    alpha, beta, gamma = chosen.T
    found, sse, (level, trend, season, _, _) = improved(
        values, np.column_stack([alpha, alpha * beta, gamma * (1 - alpha), start, np.zeros(len(start))]), period)
    path = level[:, None] + trend[:, None] * ahead
    if period:
        path = path + season[:, (values.shape[1] + ahead - 1) % period]
    a, g, d = found[:, :3].T
    return np.column_stack([a, g / a, d / np.maximum(1 - a, 1e-12), sse]), path


def smoothed(values: np.ndarray, gains: np.ndarray, period: int | None):
    """Sum of squared one-step errors and the end state (level, trend, season), with the sums of products of the errors'
    derivatives and of derivatives and errors. ``gains``: of level, trend and season, then the first level and trend."""
    count, days = values.shape
    warmup = period or 1
    a, g, d, level, trend = (gains[:, k].copy() for k in range(5))
    first = values[:, :warmup].mean(axis=1)
    season = values[:, :warmup] - first[:, None] if period else np.zeros((count, 1))
    slopes = np.zeros((2 + warmup, count, 5))     # of level, trend and each seasonal term
    slopes[0, :, 3] = slopes[1, :, 4] = 1.0
    sse, moments, pull = np.zeros(count), np.zeros((count, 5, 5)), np.zeros((count, 5))
    for day in range(warmup, days):
        place = day % warmup
        error = values[:, day] - level - trend - season[:, place]
        slope = -(slopes[0] + slopes[1] + slopes[2 + place])
        sse += error * error
        moments += slope[:, :, None] * slope[:, None, :]
        pull -= slope * error[:, None]
        slopes[0] = slopes[0] + slopes[1] + a[:, None] * slope
        slopes[0, :, 0] += error
        slopes[1] = slopes[1] + g[:, None] * slope
        slopes[1, :, 1] += error
        level, trend = level + trend + a * error, trend + g * error
        if period:
            slopes[2 + place] = slopes[2 + place] + d[:, None] * slope
            slopes[2 + place, :, 2] += error
            season[:, place] += d * error
    return sse, (level, trend, season, moments, pull)


def _at_bounds(gains: np.ndarray, pull: np.ndarray) -> np.ndarray:
    """Gains that lie on a border of their region and are pulled outwards."""
    low = np.column_stack([np.full(len(gains), LEAST_LEVEL), np.zeros((len(gains), 2))])
    high = np.column_stack([np.full(len(gains), MOST_LEVEL), gains[:, 0], 1.0 - gains[:, 0]])
    out = np.zeros(gains.shape, bool)
    out[:, :3] = ((gains[:, :3] <= low + 1e-12) & (pull[:, :3] < 0)) | ((gains[:, :3] >= high - 1e-12) & (pull[:, :3] > 0))
    return out


def improved(values: np.ndarray, gains: np.ndarray, period: int | None, steps: int = NEWTON_STEPS):
    """Gauss-Newton steps on gains and first states for all series together: (gains, sum of squares, end state).

    A step is taken only where it lowers the sum, so no series ends above its start. The gain of the level stays
    between 0 and 1, that of the trend at most the level's and that of the season at most what the level's leaves.
    """
    free = np.array([True, True, bool(period), True, True])
    sse, state = smoothed(values, gains, period)
    damping = np.full(len(values), 1e-3)
    for _ in range(steps):
        moments, pull = state[3][:, free][:, :, free], state[4][:, free]
        held = _at_bounds(gains, state[4])[:, free]     # what would leave the region stays where it is
        moments = np.where(held[:, :, None] | held[:, None, :], 0.0, moments) + held[:, :, None] * np.eye(free.sum())
        pull = np.where(held, 0.0, pull)
        scale = np.maximum(np.einsum("sii->si", moments), 1e-9)
        system = moments + damping[:, None, None] * scale[:, :, None] * np.eye(free.sum())
        tried = gains.copy()
        tried[:, free] += np.linalg.solve(system, pull[:, :, None])[:, :, 0]
        tried[:, 0] = np.clip(tried[:, 0], LEAST_LEVEL, MOST_LEVEL)
        tried[:, 1] = np.clip(tried[:, 1], 0.0, tried[:, 0])
        tried[:, 2] = np.clip(tried[:, 2], 0.0, 1.0 - tried[:, 0])
        total, made = smoothed(values, tried, period)
        better = total < sse
        settled = np.where(better, sse - total <= 1e-12 * sse, damping > 1e4)
        gains, sse = np.where(better[:, None], tried, gains), np.where(better, total, sse)
        for old, new in zip(state, made):
            old[better] = new[better]
        damping = np.where(better, damping / 5, damping * 5)
        if np.all(settled):
            break
    return gains, sse, state
