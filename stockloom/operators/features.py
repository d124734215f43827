"""Model features over the dense panel; every window reads the past of its own series."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom import fixed_values as V
from stockloom.operators.panel import in_order

# Columns that identify a row or are the target; everything else numeric is a feature.
NOT_FEATURES = {
    *V.SALES_IDS, "date", "d", "day_no", "sales",
    "event_name_1", "event_type_1", "event_name_2", "event_type_2",
}


def _trailing(order, rows: int):
    return order.rowsBetween(-(rows - 1), Window.currentRow)


def _std(values: Column, frame) -> Column:
    """Sample standard deviation; one row gives 0."""
    return F.coalesce(F.stddev_samp(values).over(frame), F.lit(0.0))


def temporal(df: DataFrame) -> DataFrame:
    """Calendar parts of the date, weekend and holiday flags, the state's SNAP flag."""
    weekday = F.weekday("date")
    holiday = F.col("event_name_1").isNotNull().cast("int") if "event_name_1" in df.columns else F.lit(0)
    return df.withColumns({
        "dayofweek": weekday,
        "weekofyear": F.weekofyear("date"),
        "month": F.month("date"),
        "quarter": F.quarter("date"),
        "year": F.year("date"),
        "is_weekend": weekday.isin(5, 6).cast("int"),
        "is_holiday": holiday,
        "is_promo": promo_flag(df),
    })


def promo_flag(df: DataFrame) -> Column:
    """SNAP flag of the row's state; 0 for a state without a SNAP column."""
    flags = {c.removeprefix("snap_"): F.col(c).cast("int") for c in df.columns if c.startswith("snap_")}
    if "state_id" not in df.columns:
        return flags.get(V.DEFAULT_STATE, F.lit(0))
    return F.coalesce(*(F.when(F.col("state_id") == s, flag) for s, flag in flags.items()), F.lit(0))


def prices(df: DataFrame) -> DataFrame:
    """Price of the day before, its change, and the price's 7-row deviation."""
    if "sell_price" not in df.columns:
        df = df.withColumn("sell_price", F.lit(V.DEFAULT_PRICE))
    order = in_order(df)
    price = F.col("sell_price")
    lagged = df.withColumns({
        "price_lag_1": F.coalesce(F.lag(price).over(order), price),
        "price_roll_std_7": _std(price, _trailing(order, V.PRICE_STD_WINDOW)),
    })
    change = price - F.col("price_lag_1")
    return lagged.withColumns({
        "price_diff_1": change,
        "price_pct_change": F.coalesce(F.try_divide(change, F.col("price_lag_1")), F.lit(0.0)),
    })


def sales_lags(df: DataFrame, lags: list[int] = V.SALES_LAGS) -> DataFrame:
    order = in_order(df)
    sales = F.col("sales").cast("double")
    return df.withColumns({f"sales_lag_{n}": F.lag(sales, n, 0.0).over(order) for n in lags})


def _yesterday(df: DataFrame) -> tuple[DataFrame, str]:
    """Sales of the day before; the first row of a series counts as 0 and is averaged too.

    That is the first sales lag, which is used where the frame has it already.
    """
    if "sales_lag_1" in df.columns:
        return df, "sales_lag_1"
    before = F.lag(F.col("sales").cast("double"), 1, 0.0).over(in_order(df))
    return df.withColumn("_before", before), "_before"


def rolling(df: DataFrame, windows: list[int] = V.ROLLING_WINDOWS) -> DataFrame:
    """Trailing mean, median and deviation of the sales up to the day before.

    The newest values are collected once, for the widest window; each median sorts a slice of them.
    """
    order = in_order(df)
    df, name = _yesterday(df)
    before, columns = F.col(name), {}
    df = df.withColumn("_newest", F.collect_list(before).over(_trailing(order, max(windows))))
    for rows in windows:
        frame = _trailing(order, rows)
        columns[f"sales_roll_mean_{rows}"] = F.avg(before).over(frame)
        columns[f"sales_roll_median_{rows}"] = _median(F.col("_newest"), rows)
        columns[f"sales_roll_std_{rows}"] = _std(before, frame)
    return df.withColumns(columns).drop("_before", "_newest")


def _median(values: Column, rows: int) -> Column:
    """Median of the last ``rows`` values of an array, or of all if it has fewer."""
    size = F.least(F.size(values), F.lit(rows))
    ordered = F.sort_array(F.slice(values, F.size(values) - size + 1, size))
    at = lambda place: F.element_at(ordered, F.floor(place / 2).cast("int"))
    return (at(size + 1) + at(size + 2)) / 2


def expanding(df: DataFrame) -> DataFrame:
    """Mean and deviation of all sales up to the day before."""
    frame = in_order(df).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df, name = _yesterday(df)
    return df.withColumns({
        "sales_expanding_mean": F.avg(name).over(frame),
        "sales_expanding_std": _std(F.col(name), frame),
    }).drop("_before")


def fourier(df: DataFrame) -> DataFrame:
    """Weekly and yearly sine and cosine."""
    week = F.weekday("date") * (2 * math.pi) / V.DAYS_PER_WEEK
    year = F.dayofyear("date") * (2 * math.pi) / V.DAYS_PER_YEAR
    return df.withColumns({
        "sin_weekly": F.sin(week), "cos_weekly": F.cos(week),
        "sin_annual": F.sin(year), "cos_annual": F.cos(year),
    })


def trend(df: DataFrame) -> DataFrame:
    return df.withColumn("trend_idx", F.row_number().over(in_order(df)).cast("double"))


def plain_rolling(df: DataFrame, windows: list[int] = V.PLAIN_ROLLING_WINDOWS) -> DataFrame:
    """Trailing mean and deviation that include the row itself."""
    order, sales = in_order(df), F.col("sales").cast("double")
    columns = {}
    for rows in windows:
        frame = _trailing(order, rows)
        columns[f"sales_roll_mean_{rows}"] = F.avg(sales).over(frame)
        columns[f"sales_roll_std_{rows}"] = _std(sales, frame)
    return df.withColumns(columns)


def demand_features(
    df: DataFrame, lags: list[int] = V.SALES_LAGS, windows: list[int] = V.ROLLING_WINDOWS,
) -> DataFrame:
    """What the tree models use: calendar, lags, rolling, expanding, Fourier, trend."""
    return trend(fourier(expanding(rolling(sales_lags(temporal(df), lags), windows))))


def all_features(df: DataFrame) -> DataFrame:
    """Every feature of the pipeline over a priced panel."""
    return demand_features(prices(df))


def feature_columns(df: DataFrame) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if f.name not in NOT_FEATURES and isinstance(f.dataType, T.NumericType)
    ]


def finite(name: str) -> Column:
    """The column as a double; null, NaN and infinity count as 0."""
    value = F.col(name).cast("double")
    usable = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    return F.when(usable, value).otherwise(F.lit(0.0))


def model_matrix(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Series keys, date, target and the numeric features as finite doubles."""
    columns = columns or feature_columns(df)
    return df.select(*V.SERIES, "date", F.col("sales").cast("double").alias("sales"),
                     *(finite(c).alias(c) for c in columns))


def supervised_windows(df: DataFrame, inputs: int, horizon: int) -> DataFrame:
    """All ``(x, y)`` slices of a series: ``inputs`` values and the ``horizon`` after them.

    Series shorter than ``inputs + horizon`` yield no row; see :func:`too_short`.
    """
    order, sales = in_order(df), F.col("sales").cast("double")
    return (
        df.select(*V.SERIES, "date",
                  F.collect_list(sales).over(_trailing(order, inputs)).alias("x"),
                  F.collect_list(sales).over(order.rowsBetween(1, horizon)).alias("y"))
        .where((F.size("x") == inputs) & (F.size("y") == horizon))
    )


def too_short(df: DataFrame, rows: int) -> DataFrame:
    """Series with fewer than ``rows`` days, with their length."""
    return df.groupBy(*V.SERIES).agg(F.count(F.lit(1)).alias("days")).where(F.col("days") < rows)


def patches(
    windows: DataFrame, column: str = "x", length: int = V.PATCH_LENGTH, stride: int = V.PATCH_STRIDE,
) -> DataFrame:
    """Overlapping pieces of an input window, zero-padded where one runs over its end."""
    values = F.col(column)
    count = F.greatest(F.lit(1), F.floor((F.size(values) - length) / stride).cast("int") + 1)

    def piece(at: Column) -> Column:
        part = F.slice(values, at * stride + 1, length)
        return F.concat(part, F.array_repeat(F.lit(0.0), length - F.size(part)))

    return windows.withColumn("patches", F.transform(F.sequence(F.lit(0), count - 1), piece))
