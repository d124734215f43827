"""The star-schema tables seen as M5 tables.

store = supplier nation, state = its region, product = part type; demand is the shipped
quantity per day, the price is weekly revenue over weekly quantity. The three shared SNAP
rules belong to three of the regions; the others have no SNAP column.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.operators import panel as P

STAR_SNAP_DAYS = {
    "AFRICA": V.SNAP_DAYS["CA"], "AMERICA": V.SNAP_DAYS["TX"], "ASIA": V.SNAP_DAYS["WI"],
}


class StarRetail:
    """Lazy views over one folder of star-schema Parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def stores(self) -> DataFrame:
        """Supplier key to store and state."""
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("s_suppkey", F.col("n_name").alias("store_id"), F.col("r_name").alias("state_id"))
        )

    @cached_property
    def lines(self) -> DataFrame:
        """Line items with their store, state, product and brand.

        No broadcast hints: supplier and part grow with the data, so Spark chooses by
        measured size and AQE splits hot suppliers or parts.
        """
        parts = self.table("part").select(
            "p_partkey", F.col("p_type").alias("item_id"), F.col("p_brand").alias("dept_id"))
        return (
            self.table("lineitem")
            .join(self.stores, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .select("store_id", "state_id", "item_id", "dept_id",
                    F.to_date("l_shipdate").alias("date"),
                    F.col("l_quantity").alias("quantity"),
                    F.col("l_extendedprice").cast("decimal(18,2)").alias("revenue"))
        )

    def _day(self, pick) -> "F.Column":
        return self.table("lineitem").agg(F.to_date(pick("l_shipdate"))).scalar()

    @property
    def first_day(self):
        return self._day(F.min)

    @property
    def last_day(self):
        return self._day(F.max)

    @cached_property
    def daily(self) -> DataFrame:
        """Days with sales only; partial sums run before the shuffle."""
        return self.lines.groupBy("store_id", "state_id", "item_id", "date").agg(
            F.sum("quantity").alias("sales"), F.sum("revenue").alias("revenue"))

    @cached_property
    def calendar(self) -> DataFrame:
        days = self.spark.range(1).select(self.first_day.alias("first"), self.last_day.alias("last"))
        return P.calendar(days, snap_days=STAR_SNAP_DAYS)

    def calendar_until(self, horizon: int) -> DataFrame:
        """The calendar with the ``horizon`` days after the last sale, whose events and SNAP days are known."""
        days = self.spark.range(1).select(self.first_day.alias("first"), F.date_add(self.last_day, horizon).alias("last"))
        return P.calendar(days, snap_days=STAR_SNAP_DAYS)

    @cached_property
    def prices(self) -> DataFrame:
        week = P.week_id(F.datediff("date", self.first_day) + 1)
        return (
            self.daily.groupBy("store_id", "item_id", week.alias("wm_yr_wk"))
            .agg(F.try_divide(F.sum("revenue").cast("double"), F.sum("sales")).alias("sell_price"))
        )

    def _dense(self, *measures: str) -> DataFrame:
        filled = P.fill_days(
            self.daily.select("store_id", "state_id", "item_id", "date", *measures),
            self.first_day, self.last_day, measures)
        day_no = F.datediff("date", self.first_day) + 1
        return filled.withColumn("d", F.concat(F.lit("d_"), day_no)).withColumn("day_no", day_no)

    @cached_property
    def dense(self) -> DataFrame:
        """Every series on every day, zero where nothing was sold."""
        return self._dense("sales")

    @cached_property
    def panel(self) -> DataFrame:
        return P.join_calendar(self.dense.drop("date"), self.calendar)

    @cached_property
    def priced(self) -> DataFrame:
        """The panel with filled prices, from one scan of the line items."""
        panel = P.join_calendar(self._dense("sales", "revenue").drop("date"), self.calendar)
        return P.fill_prices(P.weekly_price(panel))

    @cached_property
    def series(self) -> DataFrame:
        """The columns forecasters need, without the calendar join."""
        return self.dense.select("store_id", "state_id", "item_id", "date", "day_no", "sales")
