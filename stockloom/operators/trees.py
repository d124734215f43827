"""Gradient-boosted trees: one model for all series, recursive or one per step."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.operators import boosting
from stockloom.operators import features as B
from stockloom.operators.boosting import Ensemble, Model
from stockloom.operators.forecast import check_horizon, future_rows, naive
from stockloom.operators.panel import in_order

LONGEST = max(*V.SALES_LAGS, *V.ROLLING_WINDOWS)
STEP_SIZE = 0.05
CALENDAR_INPUTS = ("wm_yr_wk", "wday")
ORIGINS_AT_ONCE = 512   # backtest origins whose models are fitted and sent to the tasks together


def training_columns(panel: DataFrame) -> list[str]:
    """Feature names, in one fixed order for training and prediction."""
    given = [c for c in panel.columns if c in CALENDAR_INPUTS or c.startswith("snap_") or c == "sell_price"]
    made = ["dayofweek", "weekofyear", "month", "quarter", "year", "is_weekend", "is_holiday", "is_promo"]
    lags = [f"sales_lag_{n}" for n in V.SALES_LAGS]
    rolls = [f"sales_roll_{s}_{w}" for w in V.ROLLING_WINDOWS for s in ("mean", "median", "std")]
    rest = ["sales_expanding_mean", "sales_expanding_std", "sin_weekly", "cos_weekly", "sin_annual",
            "cos_annual", "trend_idx"]
    return [*given, *made, *lags, *rolls, *rest]


def sales_columns() -> list[str]:
    """The features that depend on the sales before a day; all others are known ahead."""
    rolls = [f"sales_roll_{s}_{w}" for w in V.ROLLING_WINDOWS for s in ("mean", "median", "std")]
    return [*(f"sales_lag_{n}" for n in V.SALES_LAGS), *rolls, "sales_expanding_mean", "sales_expanding_std", "trend_idx"]


def known_columns(columns: list[str]) -> list[str]:
    made = sales_columns()
    return [c for c in columns if c not in made]


def _matrix(panel: DataFrame, horizon: int = 0) -> DataFrame:
    """Features of every row, its position in the series, and the sales of the row and of the ``horizon`` days after it."""
    order = in_order(panel)
    sales = F.col("sales").cast("double")
    built = B.demand_features(panel).withColumns({
        "_position": F.row_number().over(order), "y_0": sales,
        **{f"y_{h}": F.lead(sales, h).over(order) for h in range(1, horizon + 1)}})
    return built.withColumns({c: B.finite(c) for c in training_columns(panel)})


def fit_recursive(panel: DataFrame, rounds: int = 100, depth: int = 5, step_size: float = STEP_SIZE) -> Ensemble | None:
    """One model of all series' sales; None without rows."""
    return boosting.fit(_matrix(panel), training_columns(panel), ["y_0"], [Model(0)], None, rounds, depth, step_size).get(0)


def _sorted(column: str):
    """Values of a column by step."""
    return F.transform(F.sort_array(F.collect_list(F.struct("step", F.col(column).alias("v")))), lambda r: r["v"])


def series_state(panel: DataFrame, horizon: int, calendar: DataFrame | None = None) -> DataFrame:
    """What the next days' features need, one row per series.

    ``tail`` holds the newest values of the sequence ``0, y1, y2, ...`` that the rolling features read;
    ``dates`` and ``known`` the next days and their features that do not depend on sales. All are bounded by the
    longest window and the horizon.
    """
    day = F.struct(*(["date"] + (["day_no"] if "day_no" in panel.columns else [])), F.col("sales").cast("double").alias("y"))
    newest = F.transform(F.sort_array(F.collect_list(day)), lambda r: r["y"])
    kept = [c for c in ("state_id", "sell_price") if c in panel.columns]
    history = panel.groupBy(*V.SERIES).agg(
        newest.alias("y"), F.sum(F.col("sales").cast("double")).alias("total"),
        F.sum(F.col("sales").cast("double") * F.col("sales")).alias("squares"),
        F.count(F.lit(1)).alias("days"), *(F.max_by(c, "date").alias(c) for c in kept),
    ).withColumn("tail", F.concat(F.array(F.lit(0.0)), F.col("y"))).drop("y")
    tail = F.slice("tail", F.greatest(F.size("tail") - (LONGEST - 1), F.lit(1)), LONGEST)
    future = future_rows(panel, horizon, calendar).withColumn(
        "wday", (F.pmod(F.weekday("date") + 2, F.lit(7)) + 1).cast("int"))
    kept = [c for c in kept if c not in future.columns]
    ahead = future.join(history.select(*V.SERIES, *kept), V.SERIES) if kept else future
    columns = known_columns(training_columns(panel))
    ahead = B.fourier(B.temporal(ahead)).withColumn("_known", F.array(*(B.finite(c) for c in columns)))
    coming = ahead.groupBy(*V.SERIES).agg(_sorted("date").alias("dates"), _sorted("_known").alias("known"))
    return history.withColumn("tail", tail).join(coming, V.SERIES).select(
        *V.SERIES, "tail", "total", "squares", "days", "dates", "known")


def origin_states(panel: DataFrame, origins: list[int], horizon: int) -> DataFrame:
    """:func:`series_state` at every origin: what was known after a series' first ``origin`` days, and the
    calendar of the days after it, which is known ahead. The price stays the origin's."""
    order, sales = in_order(panel), F.col("sales").cast("double")
    past, ahead = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), order.rowsBetween(1, horizon)
    newest = F.collect_list(sales).over(order.rowsBetween(-(LONGEST - 1), Window.currentRow))
    columns = known_columns(training_columns(panel))
    price = columns.index("sell_price") if "sell_price" in columns else None
    built = B.fourier(B.temporal(panel)).withColumn("_known", F.array(*(B.finite(c) for c in columns)))
    states = built.select(
        *V.SERIES, F.row_number().over(order).alias("origin"), newest.alias("_newest"), "_known",
        F.sum(sales).over(past).alias("total"), F.sum(sales * sales).over(past).alias("squares"), F.count(F.lit(1)).over(past).alias("days"),
        F.collect_list("date").over(ahead).alias("dates"), F.collect_list("_known").over(ahead).alias("known"),
    ).where(F.col("origin").isin(origins) & (F.size("dates") == horizon))
    if price is not None:
        states = states.withColumn("known", F.expr(
            f"transform(known, day -> transform(day, (v, i) -> if(i = {price}, _known[{price}], v)))"))
    whole = F.when(F.size("_newest") < LONGEST, F.concat(F.array(F.lit(0.0)), F.col("_newest"))).otherwise(F.col("_newest"))
    return states.select(*V.SERIES, "origin", whole.alias("tail"), "total", "squares", "days", "dates", "known")


def day_features(tail: np.ndarray, held: np.ndarray, total: np.ndarray, squares: np.ndarray, days: np.ndarray) -> dict[str, np.ndarray]:
    """The sales features of the next day; row i's newest ``held[i]`` values stand at the right of ``tail``."""
    out, width = {}, tail.shape[1]
    for n in V.SALES_LAGS:
        out[f"sales_lag_{n}"] = np.where(held >= n, tail[:, width - n], 0.0)
    for rows in V.ROLLING_WINDOWS:
        size = np.minimum(held, rows)
        values, inside = tail[:, width - rows:], np.arange(rows) >= rows - size[:, None]
        mean = np.where(inside, values, 0.0).sum(axis=1) / size
        spread = np.where(inside, (values - mean[:, None]) ** 2, 0.0).sum(axis=1)
        ordered = np.sort(np.where(inside, values, np.inf), axis=1)
        at = np.arange(len(tail))
        out[f"sales_roll_mean_{rows}"] = mean
        out[f"sales_roll_median_{rows}"] = (ordered[at, (size - 1) // 2] + ordered[at, size // 2]) / 2
        out[f"sales_roll_std_{rows}"] = np.where(size > 1, np.sqrt(spread / np.maximum(size - 1, 1)), 0.0)
    count = days + 1
    out["sales_expanding_mean"] = total / count
    out["sales_expanding_std"] = np.sqrt(np.maximum(0.0, (squares - total * total / count) / days))
    out["trend_idx"] = count.astype(float)
    return out


def _walk(state: DataFrame, models, columns: list[str], horizon: int) -> DataFrame:
    """``state`` with ``path``: forecasts step by step, each fed into the next day's features.

    One pass over the states in Arrow batches; ``models`` is a broadcast of the models by ``origin`` (or by 0).
    """
    known = known_columns(columns)
    keys = [*V.SERIES, *(["origin"] if "origin" in state.columns else [])]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            n = len(frame)
            held = frame["tail"].map(len).to_numpy()
            tail = np.zeros((n, LONGEST))
            for i, values in enumerate(frame["tail"]):
                tail[i, LONGEST - len(values):] = values
            total, squares, days = (frame[c].to_numpy(float) for c in ("total", "squares", "days"))
            ahead = np.array([[np.asarray(day, float) for day in row] for row in frame["known"]])
            groups = list(frame.groupby("origin").indices.items()) if "origin" in frame else [(0, np.arange(n))]
            path = np.empty((n, horizon))
            for step in range(horizon):
                made = day_features(tail, held, total, squares, days)
                rows = np.column_stack([ahead[:, step, known.index(c)] if c in known else made[c] for c in columns])
                rows[~np.isfinite(rows)] = 0.0
                for key, at in groups:
                    path[at, step] = np.maximum(0.0, models.value[key].predict(rows[at]))
                value = path[:, step]
                tail = np.column_stack([tail[:, 1:], value])
                held = np.minimum(held + 1, LONGEST)
                total, squares, days = total + value, squares + value * value, days + 1
            yield frame[[*keys, "dates"]].assign(path=list(path))

    kinds = dict(state.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in [*keys, "dates"]) + ", path array<double>"
    return state.mapInPandas(run, schema)


def _steps(walked: DataFrame, *keys: str) -> DataFrame:
    return walked.select(*keys, "dates", F.posexplode("path").alias("at", "yhat")).select(
        *keys, (F.col("at") + 1).alias("step"), F.element_at("dates", F.col("at") + 1).alias("date"), "yhat")


def predict_recursive(model: Ensemble | None, panel: DataFrame, horizon: int, calendar: DataFrame | None = None) -> DataFrame:
    """Forecast step by step, feeding each forecast into the next day's features; without a model, the naive forecast."""
    if model is None:
        return naive(panel, horizon)
    state = series_state(panel, check_horizon(horizon), calendar)
    sent = panel.sparkSession.sparkContext.broadcast({0: model})   # one model: rounds x nodes
    return _steps(_walk(state, sent, training_columns(panel), horizon), *V.SERIES)


def fit_direct(
    panel: DataFrame, horizon: int, rounds: int = 100, depth: int = 5, step_size: float = STEP_SIZE,
) -> dict[int, Ensemble]:
    """One model per step, trained on the sales that many days later; a step without data uses model 1.

    All models are fitted together over one binned table.
    """
    steps = range(1, check_horizon(horizon) + 1)
    made = boosting.fit(_matrix(panel, horizon), training_columns(panel), [f"y_{h}" for h in steps],
                        [Model(h, h - 1) for h in steps], None, rounds, depth, step_size)
    return {h: made.get(h, made[1]) for h in steps} if 1 in made else {}


def _direct(rows: DataFrame, models, columns: list[str], horizon: int, keys: list[str]) -> DataFrame:
    """Keys, step and yhat from the features of one row per key; ``models`` by (origin, step), origin 0 without that key."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            values = frame[columns].to_numpy(float)
            groups = list(frame.groupby("origin").indices.items()) if "origin" in frame else [(0, np.arange(len(frame)))]
            for origin, at in groups:
                for step in range(1, horizon + 1):
                    yield frame.iloc[at][keys].assign(step=step, yhat=np.maximum(0.0, models.value[origin, step].predict(values[at])))

    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{k} {kinds[k]}" for k in keys) + ", step int, yhat double"
    return rows.select(*keys, *columns).mapInPandas(run, schema)


def predict_direct(models: dict[int, Ensemble], panel: DataFrame, horizon: int) -> DataFrame:
    """All steps from the features of each series' last day; without models, the naive forecast."""
    if not models:
        return naive(panel, horizon)
    built = _matrix(panel, 1).withColumn("_next", F.lead("date").over(in_order(panel))).where(F.col("_next").isNull())
    sent = panel.sparkSession.sparkContext.broadcast(
        {(0, h): models.get(h, models[1]) for h in range(1, check_horizon(horizon) + 1)})
    made = _direct(built, sent, training_columns(panel), horizon, [*V.SERIES, "date"])
    return made.select(*V.SERIES, "step", F.date_add("date", F.col("step")).alias("date"), "yhat")


def origins(df: DataFrame, initial: int, step: int, horizon: int) -> list[int]:
    """All rolling origins that leave ``horizon`` days in the longest series."""
    days = df.groupBy(*V.SERIES).count().agg(F.max("count")).first()[0] or 0
    return list(range(initial, days - horizon + 1, step))


def tree_backtest(
    panel: DataFrame, origins: list[int], horizon: int, rounds: int = 100, depth: int = 5, step_size: float = STEP_SIZE,
    direct: bool = False,
) -> DataFrame:
    """Tree forecasts at the given origins, the models refitted at each one on what was known then.

    An origin is a mask over one table that is binned once (cuts between bins come from the whole table, labels
    never do): all its models are fitted over the same blocks. Models are fitted and sent to the tasks for
    ORIGINS_AT_ONCE origins at a time; a model's size is rounds x nodes.
    """
    columns, kind = training_columns(panel), "trees_direct" if direct else "boosted_trees"
    context, parts = panel.sparkSession.sparkContext, None
    if not origins:
        return panel.sparkSession.createDataFrame(
            [], "store_id string, item_id string, origin int, step int, model string, yhat double")
    matrix = _matrix(panel, horizon if direct else 0)
    for start in range(0, len(origins), ORIGINS_AT_ONCE):
        some = origins[start:start + ORIGINS_AT_ONCE]
        if direct:
            names = {o * (horizon + 1) + h: (o, h) for o in some for h in range(1, horizon + 1)}
            models = boosting.fit(matrix, columns, [f"y_{h}" for h in range(1, horizon + 1)],
                                  [Model(k, h - 1, o - h) for k, (o, h) in names.items() if o > h], "_position", rounds, depth, step_size)
            by_key = {names[k]: m for k, m in models.items()}
            sent = context.broadcast({(o, h): by_key.get((o, h), by_key.get((o, 1))) for o, h in names.values()
                                      if (o, h) in by_key or (o, 1) in by_key})
            known = [o for o in some if (o, 1) in by_key]
            rows = matrix.where(F.col("_position").isin(known)).withColumn("origin", F.col("_position"))
            made = _direct(rows.repartition("origin"), sent, columns, horizon, [*V.SERIES, "origin"])
        else:
            models = boosting.fit(matrix, columns, ["y_0"], [Model(o, 0, o) for o in some], "_position", rounds, depth, step_size)
            state = origin_states(panel, list(models), horizon).repartition("origin")
            made = _steps(_walk(state, context.broadcast(models), columns, horizon), *V.SERIES, "origin")
        made = made.select(*V.SERIES, "origin", "step", F.lit(kind).alias("model"), "yhat")
        parts = made if parts is None else parts.unionByName(made)
    return parts


def importances(model: Ensemble | None, panel: DataFrame) -> DataFrame:
    """Features by importance, descending; empty without a fitted model."""
    rows = [] if model is None else [(n, float(v)) for n, v in model.importances().items()]
    return panel.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")
