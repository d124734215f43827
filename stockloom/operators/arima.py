"""ARIMA by conditional least squares, for all series at once.

``arima`` searches orders (0 or 1, d, 0 or 1) on a small grid of coefficients. Higher orders, and any order on
request, are estimated: by Gauss-Newton steps on the conditional errors at the end of the series, and for the origins
of a backtest by the recursive form of the same steps, which carries the coefficients and the inverse of their
moments along, so that one walk over the days gives every origin. Without moving-average terms the recursive form
is exact least squares.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.operators.panel import in_order
from stockloom.operators.series_fit import fit_paths, least, take

GRID_COEFFICIENTS = 2
PRIOR = 1e6           # variance of the coefficients before the first day
LARGEST_MA = 0.98     # greatest absolute sum of the moving-average coefficients
NEWTON_STEPS = 40
COEFFICIENTS = [-0.9, -0.7, -0.5, -0.3, -0.1, 0.1, 0.3, 0.5, 0.7, 0.9]


def arima(
    df: DataFrame, horizon: int, order: tuple[int, int, int] = (1, 1, 1),
    backtest: tuple[int, int] | None = None, coefficients: list[float] = COEFFICIENTS, estimate: bool | None = None,
) -> DataFrame:
    """Forecast paths; an undifferenced series (d = 0) is centred on its training mean, or on a fitted constant.

    ``estimate`` (default: for orders above one) estimates the coefficients instead of searching a grid.
    """
    p, d, q = order
    if min(order) < 0:
        raise ValueError("orders cannot be negative")
    if estimate if estimate is not None else max(p, q) > 1:
        return _estimated(df, horizon, order, backtest)
    if max(p, q) > 1:
        raise ValueError("the grid has orders up to one")
    grid = np.array(list(itertools.product(coefficients if p else [0.0], coefficients if q else [0.0])))
    names, step = ["phi", "theta", "sse"], _grid_step(grid)

    def walk(values, origins, _first):
        if d > 0:
            return _finish(values, origins, d, horizon, step(_difference(values, d), [o - d for o in origins], horizon), names)
        results = []
        for origin in origins:  # the centring changes with every origin
            part = values[:, :origin]
            mean = part.mean(axis=1, keepdims=True)
            fitted = step(part - mean, [origin], horizon)
            (chosen, path), = _finish(part, [origin], d, horizon, fitted, names)
            results.append((chosen, path + mean))
        return results

    return fit_paths(df, walk, names, horizon, backtest)


def _difference(values: np.ndarray, d: int) -> np.ndarray:
    return np.diff(values, n=d, axis=1) if d else values


def _finish(values, origins, d, horizon, fitted, names):
    """Sum differenced paths back up; without a fit the path is NaN, so that a fallback takes over."""
    results = []
    for origin in origins:
        found = fitted.get(origin - d)
        if found is None:
            chosen = np.full((len(values), len(names)), np.nan)
            results.append((chosen, np.full((len(values), horizon), np.nan)))
            continue
        chosen, path = found
        for k in range(d - 1, -1, -1):
            last = _difference(values[:, :origin], k)[:, -1:]
            path = last + np.cumsum(path, axis=1)
        results.append((chosen, path))
    return results


def _grid_step(grid: np.ndarray):
    phi, theta = grid.T

    def step(w: np.ndarray, origins: list[int], horizon: int) -> dict:
        wanted, found = set(origins), {}
        shape = (len(w), len(grid))
        error, errors = np.zeros(shape), np.zeros(shape)
        for day in range(1, w.shape[1] + 1):
            if day > 1:
                error = w[:, day - 1:day] - phi * w[:, day - 2:day - 1] - theta * error
                errors += error * error
            # As many measured errors as coefficients and one more, else any candidate would do.
            if day in wanted and day - 1 > GRID_COEFFICIENTS:
                best = least(errors)
                first = phi[best] * w[:, day - 1] + theta[best] * take(error, best)
                path = first[:, None] * phi[best][:, None] ** np.arange(horizon)
                found[day] = (np.column_stack([grid[best], take(errors, best)]), path)
        return found

    return step


def _estimated(df: DataFrame, horizon: int, order: tuple[int, int, int], backtest: tuple[int, int] | None) -> DataFrame:
    p, d, q = order
    names = [*(["constant"] if d == 0 else []), *(f"phi_{i + 1}" for i in range(p)), *(f"theta_{i + 1}" for i in range(q)), "sse"]

    def walk(values, origins, _first):
        w = _difference(values, d)
        known = recursive_estimates(w, p, q, d == 0, [o - d for o in origins], horizon)
        if backtest is None and (fit := known.get(w.shape[1])) is not None:
            weights, sse, errors = gauss_newton(w, p, q, d == 0, fit[0][:, :-1])
            known = {w.shape[1]: (np.column_stack([weights, sse]), _paths(weights, w, errors, p, q, d == 0, horizon))}
        return _finish(values, origins, d, horizon, known, names)

    return fit_paths(df, walk, names, horizon, backtest)


def _lagged(w: np.ndarray, errors: np.ndarray, day: int, p: int, q: int, constant: bool) -> np.ndarray:
    """What the coefficients weigh on a day: 1 (if wanted), the last p values and the last q errors; zero before the first."""
    columns = [np.ones(len(w))] if constant else []
    columns += [w[:, day - i] for i in range(1, p + 1)]
    columns += [errors[:, day - j] if day >= j else np.zeros(len(w)) for j in range(1, q + 1)]
    return np.column_stack(columns) if columns else np.empty((len(w), 0))


def _held(weights: np.ndarray, q: int) -> np.ndarray:
    """Moving-average coefficients inside a region where errors cannot grow: their absolute sum is below one."""
    if not q:
        return weights
    total = np.abs(weights[:, -q:]).sum(axis=1, keepdims=True)
    held = weights.copy()
    held[:, -q:] *= np.minimum(1.0, LARGEST_MA / np.maximum(total, 1e-12))
    return held


def _paths(weights: np.ndarray, w: np.ndarray, errors: np.ndarray, p: int, q: int, constant: bool, horizon: int) -> np.ndarray:
    """Forecasts after the last day of ``w``, errors to come being zero."""
    days = w.shape[1]
    longer = np.concatenate([w, np.zeros((len(w), horizon))], axis=1)
    shocks = np.concatenate([errors, np.zeros((len(w), horizon))], axis=1)
    for day in range(days, days + horizon):
        longer[:, day] = (_lagged(longer, shocks, day, p, q, constant) * weights).sum(axis=1)
    return longer[:, days:]


def recursive_estimates(w: np.ndarray, p: int, q: int, constant: bool, origins: list[int], horizon: int) -> dict:
    """{origin: (coefficients and sum of squared one-step errors so far, paths)} from one walk over the days.

    Every day moves the coefficients by the day's error along the derivative of that error, weighed by the inverse of
    the derivatives' moments, which is carried along. Origins with no more errors than coefficients are left out.
    """
    size, (series, days) = p + q + constant, w.shape
    if not q:
        return _prefix_regressions(w, p, constant, origins, horizon)
    weights, errors = np.zeros((series, size)), np.zeros((series, days))
    inverse = np.broadcast_to(np.eye(size) * PRIOR, (series, size, size)).copy()
    slopes = np.zeros((series, days, size))
    sse, wanted, found, first = np.zeros(series), set(origins), {}, max(p, 1)
    for day in range(first, days + 1):
        if day in wanted and day - first > size:
            newest = slice(max(0, day - max(p, q, 1)), day)
            found[day] = (np.column_stack([weights, sse]), _paths(weights, w[:, newest], errors[:, newest], p, q, constant, horizon))
        if day == days:
            break
        lagged = _lagged(w, errors, day, p, q, constant)
        error = w[:, day] - (lagged * weights).sum(axis=1)
        slope = lagged.copy()
        for j in range(1, q + 1):
            if day >= j:
                slope -= weights[:, size - q + j - 1, None] * slopes[:, day - j]
        along = np.einsum("sij,sj->si", inverse, slope)
        gain = along / (1.0 + (slope * along).sum(axis=1))[:, None]
        weights = _held(weights + gain * error[:, None], q)
        inverse -= gain[:, :, None] * along[:, None, :]
        slopes[:, day] = slope
        errors[:, day] = w[:, day] - (lagged * weights).sum(axis=1)
        sse += error * error
    return found


def _prefix_regressions(w: np.ndarray, p: int, constant: bool, origins: list[int], horizon: int) -> dict:
    """:func:`recursive_estimates` without moving averages: the moments of the lagged values are added up from origin
    to origin and solved there."""
    size, series = p + constant, len(w)
    moments, pull, squares = np.broadcast_to(np.eye(size) / PRIOR, (series, size, size)).copy(), np.zeros((series, size)), np.zeros(series)
    found, done, none = {}, max(p, 1), np.zeros(w.shape)
    for origin in sorted(origins):
        if origin - done > 0:
            lagged = np.stack([_lagged(w, none, day, p, 0, constant) for day in range(done, origin)], axis=1)
            moments += np.einsum("sdi,sdj->sij", lagged, lagged)
            pull += np.einsum("sdi,sd->si", lagged, w[:, done:origin])
            squares += (w[:, done:origin] ** 2).sum(axis=1)
            done = origin
        if origin - max(p, 1) > size:
            weights = np.linalg.solve(moments, pull[:, :, None])[:, :, 0]
            newest = slice(max(0, origin - max(p, 1)), origin)
            found[origin] = (np.column_stack([weights, squares - (weights * pull).sum(axis=1)]),
                             _paths(weights, w[:, newest], none[:, newest], p, 0, constant, horizon))
    return found


def conditional_errors(w: np.ndarray, weights: np.ndarray, p: int, q: int, constant: bool):
    """Errors of every day, given zero errors before, the sums of products of their derivatives, and with the errors."""
    size, (series, days) = weights.shape[1], w.shape
    errors, slopes = np.zeros((series, days)), np.zeros((series, days, size))
    for day in range(max(p, 1), days):
        lagged = _lagged(w, errors, day, p, q, constant)
        errors[:, day] = w[:, day] - (lagged * weights).sum(axis=1)
        slope = lagged
        for j in range(1, q + 1):
            if day >= j:
                slope = slope - weights[:, size - q + j - 1, None] * slopes[:, day - j]
        slopes[:, day] = slope
    return errors, np.einsum("sdi,sdj->sij", slopes, slopes), np.einsum("sdi,sd->si", slopes, errors)


def gauss_newton(w: np.ndarray, p: int, q: int, constant: bool, start: np.ndarray | None = None, steps: int = NEWTON_STEPS):
    """(coefficients, sum of squares, errors) of every series; the sum is never above that of the start, of zero
    coefficients or, for orders up to one, of the grid's best."""
    size = p + q + constant
    starts = [np.zeros((len(w), size))] + ([_held(start, q)] if start is not None else [])
    if not constant and p <= 1 and q <= 1 and size:
        grid = np.array(list(itertools.product(COEFFICIENTS if p else [0.0], COEFFICIENTS if q else [0.0])))
        best = _grid_step(grid)(w, [w.shape[1]], 1).get(w.shape[1])
        if best is not None:
            starts.append(best[0][:, [k for k, used in enumerate((p, q)) if used]])
    weights = errors = moments = pull = sse = None
    for made in starts:
        tried = conditional_errors(w, made, p, q, constant)
        total = (tried[0] ** 2).sum(axis=1)
        if sse is None:
            weights, sse, (errors, moments, pull) = made.copy(), total, tried
        else:
            better = total < sse
            weights[better], sse[better] = made[better], total[better]
            for old, new in zip((errors, moments, pull), tried):
                old[better] = new[better]
    damping = np.full(len(w), 1e-3)
    for _ in range(steps if size else 0):
        scale = np.maximum(np.einsum("sii->si", moments), 1e-9)
        system = moments + damping[:, None, None] * scale[:, :, None] * np.eye(size)
        made = _held(weights + np.linalg.solve(system, pull[:, :, None])[:, :, 0], q)
        tried = conditional_errors(w, made, p, q, constant)
        total = (tried[0] ** 2).sum(axis=1)
        better = total < sse
        settled = np.where(better, sse - total <= 1e-12 * sse, damping > 1e4)
        weights[better], sse[better] = made[better], total[better]
        for old, new in zip((errors, moments, pull), tried):
            old[better] = new[better]
        damping = np.where(better, damping / 5, damping * 5)
        if np.all(settled):
            break
    return weights, sse, errors


def autoregression(df: DataFrame, horizon: int, d: int = 1) -> DataFrame:
    """AR(1) in closed form, as plain aggregates: no recursion and no arrays.

    On first differences (d = 1) there is no constant; on levels (d = 0) there is one.
    """
    order = in_order(df)
    sales = F.col("sales").cast("double")
    value = sales - F.lag(sales).over(order) if d else sales
    pairs = df.select(*V.SERIES, "date", sales.alias("y"), value.alias("w")).withColumn(
        "before", F.lag("w").over(Window.partitionBy(*V.SERIES).orderBy("date")))
    both = F.col("w").isNotNull() & F.col("before").isNotNull()
    if d:
        slope = F.try_divide(F.sum(F.when(both, F.col("w") * F.col("before"))),
                             F.sum(F.when(both, F.col("before") * F.col("before"))))
        constant = F.lit(0.0)
    else:
        slope, constant = F.regr_slope("w", "before"), F.regr_intercept("w", "before")
    fitted = pairs.groupBy(*V.SERIES).agg(
        F.coalesce(slope, F.lit(0.0)).alias("phi"), F.coalesce(constant, F.lit(0.0)).alias("constant"),
        F.max_by("y", "date").alias("last_y"), F.coalesce(F.max_by("w", "date"), F.lit(0.0)).alias("last_w"),
        F.max("date").alias("last_date"))
    ahead = F.sequence(F.lit(1), F.lit(horizon))
    state = F.struct(F.col("last_w").alias("w"), F.array().cast("array<double>").alias("path"))

    def advance(acc, _step):
        coming = F.col("constant") + F.col("phi") * acc["w"]
        base = F.coalesce(F.try_element_at(acc["path"], F.lit(-1)), F.col("last_y")) if d else F.lit(0.0)
        return F.struct(coming.alias("w"), F.concat(acc["path"], F.array(base + coming)).alias("path"))

    path = F.aggregate(ahead, state, advance, lambda acc: acc["path"])
    return fitted.select(*V.SERIES, "phi", "last_date", F.posexplode(path).alias("at", "yhat")).select(
        *V.SERIES, "phi", (F.col("at") + 1).alias("step"),
        F.date_add("last_date", F.col("at") + 1).alias("date"), "yhat")
