"""From sales, calendar and price tables to one dense daily panel of all series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.errors import EmptyDataFrameError

DAY_NAMES = "EEEE"


def in_order(df: DataFrame) -> WindowSpec:
    """Rows of one series by date; equal dates by day number where the frame has one.

    Every windowed operator uses this one window, so they share one shuffle and sort.
    A series has one row per calendar day, so a window partition stays small.
    """
    order = ["date"] + (["day_no"] if "day_no" in df.columns else [])
    return Window.partitionBy(*V.SERIES).orderBy(*order)


def day_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c.startswith("d_")]


def unpivot_days(sales: DataFrame) -> DataFrame:
    """Wide ``d_1..d_n`` to one row per day.

    One generator over an array of the day columns: ``DataFrame.unpivot`` would plan one
    projection per day column, which is slow to plan at M5 width.
    """
    days = day_columns(sales)
    if not days:
        raise EmptyDataFrameError("sales", "No day columns (d_...)")
    ids = [c for c in V.SALES_IDS if c in sales.columns]
    names = F.array(*(F.lit(c) for c in days))
    return (
        sales.select(*ids, F.posexplode(F.array(*(F.col(c) for c in days))).alias("at", "sales"))
        .select(*ids, F.element_at(names, F.col("at") + 1).alias("d"), "sales")
    )


def week_id(day_no: Column) -> Column:
    """Week number of a day counted from 1."""
    return (F.lit(V.FIRST_WEEK_ID) + F.floor((day_no - 1) / 7)).cast("int")


def calendar(span: DataFrame, snap_days: dict[str, list[int]] | None = None) -> DataFrame:
    """Calendar dimension for a one-row frame ``(first, last)`` of dates."""
    snap_days = V.SNAP_DAYS if snap_days is None else snap_days
    days = span.select(
        "first", F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date"))
    day_no = F.datediff("date", "first") + 1
    month_day = [(F.month("date") == m) & (F.dayofmonth("date") == d) for m, d, _, _ in V.FIXED_EVENTS]
    pick = lambda at: F.coalesce(*(
        F.when(hit, F.lit(event[at])) for hit, event in zip(month_day, V.FIXED_EVENTS)))
    return days.select(
        "date",
        week_id(day_no).alias("wm_yr_wk"),
        F.date_format("date", DAY_NAMES).alias("weekday"),
        (F.pmod(F.weekday("date") + 2, F.lit(7)) + 1).cast("int").alias("wday"),
        F.month("date").alias("month"),
        F.year("date").alias("year"),
        F.concat(F.lit("d_"), day_no).alias("d"),
        pick(2).alias("event_name_1"),
        pick(3).alias("event_type_1"),
        F.lit(None).cast("string").alias("event_name_2"),
        F.lit(None).cast("string").alias("event_type_2"),
        *(F.dayofmonth("date").isin(numbers).cast("int").alias(f"snap_{state}")
          for state, numbers in snap_days.items()),
    )


def join_calendar(long_sales: DataFrame, calendar_table: DataFrame) -> DataFrame:
    """Inner join on ``d``; days the calendar does not know are dropped."""
    if "d" not in calendar_table.columns:
        raise EmptyDataFrameError("calendar", "No column 'd'")
    joined = long_sales.join(calendar_table, "d").withColumn("date", F.to_date("date"))
    if "day_no" not in joined.columns:
        joined = joined.withColumn("day_no", F.substring_index("d", "_", -1).cast("int"))
    return joined


def join_prices(panel: DataFrame, prices: DataFrame) -> DataFrame:
    """Left join of weekly prices."""
    return panel.join(prices.select(*V.PRICES_REQUIRED), V.SERIES + ["wm_yr_wk"], "left")


def fill_prices(panel: DataFrame, price: str = "sell_price") -> DataFrame:
    """Last known price; before the first known one, the next.

    A row without an earlier price lies before every known one, so its next price is the
    first of the whole series: one constant frame instead of one scan ahead per row.
    """
    order = in_order(panel)
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return panel.withColumn(price, F.coalesce(
        F.last(price, ignorenulls=True).over(before), F.first(price, ignorenulls=True).over(whole)))


def fill_days(
    daily: DataFrame, first_day: Column, last_day: Column, measures: tuple[str, ...] = ("sales",),
) -> DataFrame:
    """Add the missing days of every series, with its measures at zero.

    Each row is repeated up to the day before the series' next row (its first row also
    reaches back to ``first_day``), so no date table is joined and the only shuffle is
    the one by series that the later windows need anyway.

    The result spans ``first_day`` to ``last_day``: rows outside are left out, and so are series
    without a row inside. Several rows of a series and date are an error, raised as the job runs;
    add them up first.
    """
    order = Window.partitionBy(*V.SERIES).orderBy("date")
    daily = daily.where(F.col("date").between(first_day, last_day))
    kept = [c for c in daily.columns if c not in ("date", *measures)]
    twice = F.raise_error(F.concat_ws(" ", F.lit("several rows of one series on"), F.col("date").cast("string"))).cast("date")
    start = F.when(F.col("before").isNull(), first_day).when(F.col("before") == F.col("date"), twice).otherwise(F.col("date"))
    end = F.when(F.col("after").isNull(), last_day).otherwise(F.date_sub("after", 1))
    present = F.col("day") == F.col("date")
    return (
        daily.withColumns({"before": F.lag("date").over(order), "after": F.lead("date").over(order)})
        .select(*kept, "date", *measures, F.explode(F.sequence(start, end)).alias("day"))
        .select(*kept, F.col("day").alias("date"), *(
            F.when(present, F.col(m)).otherwise(F.lit(0).cast(daily.schema[m].dataType)).alias(m)
            for m in measures))
    )


def weekly_price(panel: DataFrame, revenue: str = "revenue") -> DataFrame:
    """Price of a series' week, revenue over quantity, where no price table exists.

    The panel is already placed by series, so this adds a sort and no shuffle; a separate
    price table would scan and join the sales once more. Weeks without sales stay null.
    """
    week = Window.partitionBy(*V.SERIES, "wm_yr_wk")
    sold = F.sum("sales").over(week)
    paid = F.sum(revenue).over(week).cast("double")
    return panel.withColumn("sell_price", F.when(sold > 0, paid / sold)).drop(revenue)


def prepare_panel(sales: DataFrame, calendar_table: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """Wide M5 sales to the priced long panel, for every series."""
    panel = join_calendar(unpivot_days(sales), calendar_table)
    return panel if prices is None else fill_prices(join_prices(panel, prices))
