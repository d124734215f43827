"""Baseline forecasts for all series and the steps every forecaster shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom import fixed_values as V

CARRIED = ["id", "dept_id", "cat_id", "state_id", "wm_yr_wk"]
EVENTS = ["event_name_1", "event_type_1", "event_name_2", "event_type_2"]


def check_horizon(horizon: int) -> int:
    if horizon <= 0:
        raise ValueError("horizon has to be at least 1")
    return horizon


def steps(horizon: int) -> Column:
    """One row per forecast step 1..horizon."""
    return F.explode(F.sequence(F.lit(1), F.lit(check_horizon(horizon))))


def recent(df: DataFrame, rows: int) -> DataFrame:
    """The last ``rows`` rows of each series, with ``age`` 1 for the newest.

    The rank filter runs before the shuffle too (group limit), so only the newest rows
    of a series travel.
    """
    newest = [F.desc("date")] + ([F.desc("day_no")] if "day_no" in df.columns else [])
    age = F.row_number().over(Window.partitionBy(*V.SERIES).orderBy(*newest))
    return df.withColumn("age", age).where(F.col("age") <= rows)


def tails(df: DataFrame, rows: int) -> DataFrame:
    """One row per series: its last day and its last ``rows`` sales, oldest first."""
    pairs = F.sort_array(F.collect_list(F.struct((-F.col("age")).alias("at"), F.col("sales").cast("double").alias("y"))))
    return recent(df.select(*V.SERIES, *_order_columns(df), "sales"), rows).groupBy(*V.SERIES).agg(
        F.max("date").alias("last_date"), F.transform(pairs, lambda p: p["y"]).alias("tail"))


def _order_columns(df: DataFrame) -> list[str]:
    return ["date"] + (["day_no"] if "day_no" in df.columns else [])


def last_value(tail: Column) -> Column:
    return F.element_at(tail, -1)


def seasonal_value(tail: Column, step: Column, period: int = V.SEASON) -> Column:
    """The value one season back; the last value when there is no whole season."""
    place = (F.size(tail) - period + F.pmod(step - 1, F.lit(period)) + 1).cast("int")
    return F.when(F.size(tail) < period, last_value(tail)).otherwise(F.try_element_at(tail, place))


def mean_of_last(tail: Column, window: int = V.SEASON) -> Column:
    count = F.least(F.lit(window), F.size(tail))
    used = F.slice(tail, F.size(tail) - count + 1, count)
    return F.aggregate(used, F.lit(0.0), lambda total, value: total + value) / count


def naive(df: DataFrame, horizon: int) -> DataFrame:
    return _forecast(df, horizon, 1, lambda tail, step: last_value(tail))


def seasonal_naive(df: DataFrame, horizon: int, period: int = V.SEASON) -> DataFrame:
    return _forecast(df, horizon, period, lambda tail, step: seasonal_value(tail, step, period))


def moving_average(df: DataFrame, horizon: int, window: int = V.SEASON) -> DataFrame:
    return _forecast(df, horizon, window, lambda tail, step: mean_of_last(tail, window))


def _forecast(df: DataFrame, horizon: int, rows: int, value) -> DataFrame:
    return from_tails(tails(df, rows), horizon, value)


def from_tails(ends: DataFrame, horizon: int, value) -> DataFrame:
    """Forecast rows from :func:`tails`; ``value(tail, step)`` gives each step's forecast."""
    return ends.select("*", steps(horizon).alias("step")).select(
        *V.SERIES, "step", F.date_add("last_date", F.col("step")).alias("date"),
        value(F.col("tail"), F.col("step")).alias("yhat"))


def series_arrays(df: DataFrame) -> DataFrame:
    """One row per series: first and last day and the ordered sales.

    For recursions that need a whole series. A series holds one value per calendar day,
    so the array is bounded by the calendar, however many raw rows it was summed from.
    """
    rows = F.sort_array(F.collect_list(F.struct(*_order_columns(df), F.col("sales").cast("double").alias("y"))))
    return df.groupBy(*V.SERIES).agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.transform(rows, lambda r: r["y"]).alias("y"))


def with_fallback(fitted: DataFrame, fallback: DataFrame) -> DataFrame:
    """Every fallback row, replaced by the fitted value where that exists and is a number.

    ``fallback_reason`` is null where the fitted value was used.
    """
    keys = [*V.SERIES, "step"]
    found = fitted.select(*keys, F.col("yhat").alias("fitted"), F.lit(True).alias("present"))
    usable = F.col("fitted").isNotNull() & ~F.isnan("fitted")
    reason = (
        F.when(F.col("present").isNull(), "no forecast").when(~usable, "forecast is not a number"))
    return fallback.join(found, keys, "left").select(
        *keys, "date", F.when(usable, F.col("fitted")).otherwise(F.col("yhat")).alias("yhat"),
        reason.alias("fallback_reason"))


def floor_at_zero(forecast: DataFrame) -> DataFrame:
    return forecast.withColumn("yhat", F.greatest(F.lit(0.0), F.col("yhat")))


def fit_length(forecast: DataFrame, horizon: int) -> DataFrame:
    """Cut a forecast to the horizon, or repeat its last value up to it."""
    rows = F.sort_array(F.collect_list(F.struct("step", "yhat")))
    return (
        forecast.groupBy(*V.SERIES).agg(rows.alias("path"))
        .select(*V.SERIES, "path", steps(horizon).alias("step"))
        .select(*V.SERIES, "step", F.element_at("path", F.least("step", F.size("path")))["yhat"].alias("yhat"))
    )


def future_rows(panel: DataFrame, horizon: int, calendar: DataFrame | None = None) -> DataFrame:
    """The next ``horizon`` days of each series.

    With a calendar, its known values of those days are used; days it does not cover
    (and all days without one) repeat the last week id and SNAP flags, without events.
    """
    snaps = [c for c in panel.columns if c.startswith("snap_")]
    carried = [c for c in [*CARRIED, *snaps] if c in panel.columns]
    last = panel.groupBy(*V.SERIES).agg(
        F.max("date").alias("last_date"), *(F.max_by(c, "date").alias(c) for c in carried))
    future = last.select(*V.SERIES, *carried, steps(horizon).alias("step"), "last_date").withColumn(
        "date", F.date_add("last_date", F.col("step"))).drop("last_date")
    if calendar is None:
        return future.withColumns({e: F.lit(None).cast("string") for e in EVENTS})
    known = ["wm_yr_wk", *snaps]
    table = calendar.select("date", *EVENTS, *(F.col(c).alias(f"_{c}") for c in known))
    joined = future.join(table, "date", "left")
    return joined.withColumns({c: F.coalesce(f"_{c}", c) for c in known if c in carried}).drop(
        *(f"_{c}" for c in known))
