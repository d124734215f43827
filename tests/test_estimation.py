"""Estimated ARIMA against plain loops and the grid; the piecewise trend against its optimality conditions."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockloom.operators import additive, arima, piecewise, smoothing

ONE = ("S", "I")


def loop_errors(w, weights, p, q):
    errors = [0.0] * len(w)
    for t in range(max(p, 1), len(w)):
        value = sum(weights[i] * w[t - 1 - i] for i in range(p))
        value += sum(weights[p + j] * errors[t - 1 - j] for j in range(q) if t - 1 - j >= 0)
        errors[t] = w[t] - value
    return np.array(errors)


def noise(seed, n=120):
    rng = np.random.default_rng(seed)
    shocks, w = rng.normal(size=n), [0.0, 0.0]
    for t in range(2, n):
        w.append(0.6 * w[-1] - 0.2 * w[-2] + shocks[t] + 0.4 * shocks[t - 1])
    return np.array(w)


@pytest.mark.parametrize("p, q", [(1, 1), (0, 1), (1, 0), (2, 0), (2, 2), (3, 1), (0, 2), (1, 3)])
def test_gauss_newton_ends_at_a_least_sum_of_squares(p, q):
    w = np.stack([noise(k) for k in range(5)])
    weights, sse, errors = arima.gauss_newton(w, p, q, False)
    for series, found, total, made in zip(w, weights, sse, errors):
        np.testing.assert_allclose(made, loop_errors(series, found, p, q), atol=1e-9)
        assert total == pytest.approx(float(made @ made))
        assert total <= float((loop_errors(series, np.zeros(p + q), p, q) ** 2).sum()) + 1e-9
        for k in range(p + q if np.abs(found[p:]).sum() < 0.97 else 0):   # inside the region: no small step is better
            for change in (1e-3, -1e-3):
                near = found.copy()
                near[k] += change
                assert (loop_errors(series, near, p, q) ** 2).sum() >= total * (1 - 1e-4)


def test_estimates_are_never_worse_than_the_grid(make_panel):
    panel = make_panel({("S", str(k)): np.cumsum(noise(k)).tolist() for k in range(6)})
    grid = {r["item_id"]: r["sse"] for r in arima.arima(panel, 3).collect()}
    made = arima.arima(panel, 3, estimate=True).collect()
    assert all(r["sse"] <= grid[r["item_id"]] + 1e-9 for r in made) and any(r["sse"] < 0.99 * grid[r["item_id"]] for r in made)


def test_recursive_estimates_are_least_squares_at_every_origin(make_panel):
    """Without moving-average terms one walk gives what a regression on each prefix gives, constant included."""
    y = np.cumsum(noise(3, 60))
    for order in ((2, 1, 0), (3, 0, 0)):
        p, d, _ = order
        rows = {r["origin"]: r for r in arima.arima(make_panel({ONE: y.tolist()}), 2, order, (20, 7)).collect()}
        assert sorted(rows) == list(range(20, 59, 7))
        for origin, row in rows.items():
            w = np.diff(y[:origin], n=d)
            columns = [w[p - 1 - i:len(w) - 1 - i] for i in range(p)]
            design = np.column_stack(([np.ones(len(w) - p)] if d == 0 else []) + columns)
            wanted = np.linalg.solve(design.T @ design + np.eye(design.shape[1]) / arima.PRIOR, design.T @ w[p:])
            found = [row[c] for c in (["constant"] if d == 0 else []) + [f"phi_{i + 1}" for i in range(p)]]
            np.testing.assert_allclose(found, wanted, atol=1e-6)
            path, last = [], list(w)
            for _ in range(2):
                last.append(float(np.dot(([1.0] if d == 0 else []) + last[:-p - 1:-1], wanted)))
                path.append(last[-1])
            np.testing.assert_allclose(row["path"], y[origin - 1] + np.cumsum(path) if d else path, atol=1e-5)


def test_recursive_estimates_with_moving_averages_come_near_the_batch_ones():
    w = np.stack([noise(k, 1500) for k in range(4)])
    walked = arima.recursive_estimates(w, 2, 1, False, [1500], 3)[1500]
    batch, sse, _ = arima.gauss_newton(w, 2, 1, False)
    made = np.array([(loop_errors(s, r, 2, 1) ** 2).sum() for s, r in zip(w, walked[0][:, :-1])])
    assert np.all(made <= sse * 1.02) and walked[1].shape == (4, 3)


def bent_panel(make_panel, days=420):
    t, rng = np.arange(days), np.random.default_rng(1)
    bent = 20 + 0.05 * t + np.maximum(0, t - 182) * 0.2 + 3 * np.sin(2 * np.pi * t / 7) + rng.normal(size=days)
    plain = 30 - 0.02 * t + rng.normal(size=days)
    return make_panel({("S", "bent"): bent.tolist(), ("S", "plain"): plain.tolist(), ("S", "zero"): [0.0] * days})


def test_piecewise_fit_meets_its_optimality_conditions(make_panel):
    """The raw days' gradient: zero for free weights, at most the penalty for bends, and the penalty where one is used."""
    panel, days = bent_panel(make_panel), 420
    rows = {r["item_id"]: r for r in piecewise.piecewise_regression(panel, 5, weekly=1, yearly=0).collect()}
    frame = panel.toPandas().sort_values(["item_id", "date"])
    t, scale = np.arange(days), days - 1.0
    bends = np.arange(91, int(0.8 * days) + 1, 91)
    fixed = additive.design(pd.Timestamp("2024-01-01"), t, scale, 1, 0)
    hinges = np.maximum(0.0, t[:, None] - bends) / scale
    for item, row in rows.items():
        y = frame[frame.item_id == item].sales.to_numpy(float)
        limit = piecewise.SHRINK * days * y.std()
        # Solve once more by plain subgradient-free search: coordinate descent over raw columns.
        beta, gamma = np.zeros(fixed.shape[1]), np.zeros(len(bends))
        ridge = np.r_[0.0, np.full(fixed.shape[1] - 1, additive.RIDGE)]
        for _ in range(20_000):
            beta = np.linalg.solve(fixed.T @ fixed + np.diag(ridge), fixed.T @ (y - hinges @ gamma))
            rest = y - fixed @ beta - hinges @ gamma
            old = gamma.copy()
            for j in range(len(bends)):
                pull = hinges[:, j] @ rest + (hinges[:, j] @ hinges[:, j]) * gamma[j]
                new = np.sign(pull) * max(abs(pull) - limit, 0) / (hinges[:, j] @ hinges[:, j])
                rest -= hinges[:, j] * (new - gamma[j])
                gamma[j] = new
            if np.abs(gamma - old).max() < 1e-11:
                break
        coming = np.arange(days, days + 5)
        path = additive.design(pd.Timestamp("2024-01-01"), coming, scale, 1, 0) @ beta + np.maximum(0.0, coming[:, None] - bends) / scale @ gamma
        np.testing.assert_allclose(row["path"], path, atol=1e-4)
    assert rows["bent"]["bends"] >= 1 and rows["zero"]["bends"] == 0 and rows["zero"]["path"] == pytest.approx([0.0] * 5)
    assert rows["bent"]["slope"] > 0.15 and abs(rows["plain"]["slope"] + 0.02) < 0.02


def test_piecewise_without_bends_is_the_additive_fit_and_origins_equal_prefixes(make_panel):
    panel = bent_panel(make_panel)
    plain = {r["item_id"]: r["path"] for r in additive.additive_regression(panel, 5).collect()}
    stiff = {r["item_id"]: r["path"] for r in piecewise.piecewise_regression(panel, 5, shrink=float("1e18")).collect()}
    for item, path in plain.items():
        np.testing.assert_allclose(stiff[item], path, atol=1e-5)
    walked = {(r["item_id"], r["origin"]): r["path"] for r in piecewise.piecewise_regression(panel, 5, backtest=(100, 150)).collect()}
    assert sorted({o for _, o in walked}) == [100, 250, 400]
    for origin in (250, 400):
        for r in piecewise.piecewise_regression(panel.where(F.col("day_no") <= origin), 5).collect():
            np.testing.assert_allclose(walked[r["item_id"], origin], r["path"], atol=1e-4)


def test_piecewise_of_short_series(make_panel):
    made = piecewise.piecewise_regression(make_panel({ONE: [4.0, 6.0]}), 2).first()
    assert np.isfinite(made["path"]).all() and made["bends"] == 0
    assert piecewise.piecewise_regression(make_panel({ONE: [4.0] * 5}), 7, backtest=(3, 1)).count() == 0


def loop_smoothing(y, a, g, d, level, trend, period):
    """Sum of squares and forecasts of one series in plain Python."""
    warmup = period or 1
    mean = sum(y[:warmup]) / warmup
    season = [v - mean for v in y[:warmup]] if period else [0.0]
    total = 0.0
    for day in range(warmup, len(y)):
        error = y[day] - level - trend - season[day % warmup]
        total += error * error
        level, trend = level + trend + a * error, trend + g * error
        season[day % warmup] += d * error if period else 0.0
    return total, [level + trend * h + season[(len(y) + h - 1) % warmup] for h in (1, 2, 3)]


@pytest.mark.parametrize("period", [None, 7])
def test_estimated_smoothing_is_a_least_sum_never_above_the_grids(make_panel, period):
    rng, t = np.random.default_rng(8), np.arange(90)
    series = {("S", str(k)): (20 + 0.1 * k * t + 4 * np.sin(2 * np.pi * t / 7) + np.cumsum(rng.normal(size=90))).tolist() for k in range(4)}
    panel = make_panel(series | {("S", "zero"): [0.0] * 90, ("S", "two"): [1.0, 4.0]})
    grid = {r["item_id"]: r for r in smoothing.ets(panel, 3, period).collect()}
    made = {r["item_id"]: r for r in smoothing.ets(panel, 3, period, estimate=True).collect()}
    assert all(made[i]["sse"] <= grid[i]["sse"] + 1e-9 for i in map(str, range(4))) and made["0"]["sse"] < grid["0"]["sse"]
    assert made["zero"]["path"] == pytest.approx([0.0] * 3)
    if period is None:
        assert made["two"]["path"] == pytest.approx(grid["two"]["path"])
    values = np.array([series["S", str(k)] for k in range(4)])
    warmup = period or 1
    start = np.column_stack([np.full(4, 0.3), np.full(4, 0.03), np.full(4, 0.1 if period else 0.0), values[:, :warmup].mean(axis=1), np.zeros(4)])
    gains, sse, state = smoothing.improved(values, start, period)
    for y, found, total, level in zip(values, gains, sse, state[0]):
        assert loop_smoothing(y.tolist(), *found, period)[0] == pytest.approx(total)
        for k in (0, 1, 3, 4):   # no small step inside the region is better
            for change in (1e-3, -1e-3):
                near = found.copy()
                near[k] += change
                if 1e-4 <= near[0] <= 0.9999 and 0 <= near[1] <= near[0] and near[2] <= 1 - near[0]:
                    assert loop_smoothing(y.tolist(), *near, period)[0] >= total * (1 - 1e-3)
    with pytest.raises(ValueError):
        smoothing.ets(panel, 3, backtest=(20, 5), estimate=True)
