"""Forecasts that add up over store, state and total.

Base forecasts are rows ``(level, node, step, yhat)``; the tree is a mapping table
``(store_id, state_id)``. No summing matrix is built: least squares on this tree has a
closed form in sums per state and per step, so each method is a few aggregations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOTAL, STATE, STORE = "total", "state", "store"
TOTAL_NODE = "Total"


def tree_nodes(mapping: DataFrame) -> DataFrame:
    """All nodes as ``(level, node, parent)``: total, states, stores."""
    pairs = mapping.select("store_id", "state_id").distinct()
    total = mapping.sparkSession.range(1).select(
        F.lit(TOTAL).alias("level"), F.lit(TOTAL_NODE).alias("node"), F.lit(None).cast("string").alias("parent"))
    states = pairs.select("state_id").distinct().select(
        F.lit(STATE).alias("level"), F.col("state_id").alias("node"), F.lit(TOTAL_NODE).alias("parent"))
    stores = pairs.select(F.lit(STORE).alias("level"), F.col("store_id").alias("node"), F.col("state_id").alias("parent"))
    return total.unionByName(states).unionByName(stores)


def sum_up(bottom: DataFrame) -> DataFrame:
    """Store rows ``(state_id, store_id, step, yhat)`` summed to all three levels."""
    sets = [["step", "state_id", "store_id"], ["step", "state_id"], ["step"]]
    summed = bottom.groupingSets(sets, "step", "state_id", "store_id").agg(
        F.sum("yhat").alias("yhat"), F.grouping_id().alias("gid"))
    level = F.when(F.col("gid") == 0, STORE).when(F.col("gid") == 1, STATE).otherwise(TOTAL)
    node = F.when(F.col("gid") == 0, F.col("store_id")).when(F.col("gid") == 1, F.col("state_id")).otherwise(TOTAL_NODE)
    return summed.select(level.alias("level"), node.alias("node"), "step", "yhat")


def _at(base: DataFrame, level: str, key: str, name: str) -> DataFrame:
    return base.where(F.col("level") == level).select(F.col("node").alias(key), "step", F.col("yhat").alias(name))


def _every_step(stores: DataFrame, base: DataFrame, horizon: int | None) -> DataFrame:
    """Each store at each step. A stated horizon saves a pass over the base forecasts."""
    last = F.lit(horizon) if horizon else base.agg(F.max("step")).scalar()
    return stores.select("*", F.explode(F.sequence(F.lit(1), last)).alias("step"))


def _stores_by_step(base: DataFrame, mapping: DataFrame, horizon: int | None) -> DataFrame:
    """Every mapped store at every step; a missing store forecast counts as 0."""
    grid = _every_step(mapping.select("store_id", "state_id").distinct(), base, horizon)
    return grid.join(_at(base, STORE, "store_id", "own"), ["store_id", "step"], "left").withColumn(
        "own", F.coalesce("own", F.lit(0.0)))


def bottom_up(base: DataFrame, mapping: DataFrame, horizon: int | None = None) -> DataFrame:
    """Stores as forecast; states and total are their sums."""
    return sum_up(_stores_by_step(base, mapping, horizon).withColumnRenamed("own", "yhat"))


def top_down(base: DataFrame, mapping: DataFrame, shares: DataFrame, horizon: int | None = None) -> DataFrame:
    """The total split by ``(store_id, share)``; a store without a share gets 1/stores.

    Shares are used as given, also where they do not add up to 1.
    """
    stores = mapping.select("store_id", "state_id").distinct()
    even = stores.agg(1 / F.count(F.lit(1))).scalar()
    total = base.where(F.col("level") == TOTAL).select("step", F.col("yhat").alias("total"))
    grid = _every_step(stores, base, horizon).join(
        shares.select("store_id", "share"), "store_id", "left").join(total, "step", "left")
    return sum_up(grid.select(
        "state_id", "store_id", "step",
        (F.coalesce("total", F.lit(0.0)) * F.coalesce("share", even)).alias("yhat")))


def least_squares(base: DataFrame, mapping: DataFrame, horizon: int | None = None) -> DataFrame:
    """The coherent forecasts nearest to the base forecasts, then cut at 0.

    With b the sum of a store's own, its state's and the total forecast, and n the stores
    of the state, the normal equations are (I + block ones + all ones) beta = b. Removing
    first the block and then the rank-one part leaves sums per state and step only. A node
    without a forecast counts as 0; cutting at 0 comes last and may break the sums.
    """
    grid = _every_step(mapping.select("store_id", "state_id").distinct(), base, horizon)
    nodes = F.array(*(F.struct(F.lit(level).alias("level"), node.alias("node")) for level, node in (
        (STORE, F.col("store_id")), (STATE, F.col("state_id")), (TOTAL, F.lit(TOTAL_NODE)))))
    # A store meets its own, its state's and the total forecast in one join.
    sums = grid.select("store_id", "state_id", "step", F.inline(nodes)).join(
        base.select("level", "node", "step", "yhat"), ["level", "node", "step"], "left"
    ).groupBy("step", "state_id", "store_id").agg(F.coalesce(F.sum("yhat"), F.lit(0.0)).alias("b"))
    in_state, in_step = Window.partitionBy("step", "state_id"), Window.partitionBy("step")
    shared = sums.repartition("step").withColumns({
        "n": F.count(F.lit(1)).over(in_state), "x_state": F.sum("b").over(in_state)}).withColumn(
        "x_state", F.col("x_state") / (1 + F.col("n")))
    # x = b - x_state; summed over a state that is x_state, counted here once for each of its stores.
    x_total = F.sum(F.col("x_state") / F.col("n")).over(in_step)
    c = F.sum(1 / (1 + F.col("n"))).over(in_step)
    solved = shared.select("state_id", "store_id", "step", (
        F.col("b") - F.col("x_state") - x_total / (1 + c) / (1 + F.col("n"))).alias("yhat"))
    return sum_up(solved).withColumn("yhat", F.greatest(F.lit(0.0), F.col("yhat")))


def historical_shares(sales: DataFrame) -> DataFrame:
    """Each store's part of all sales."""
    total = sales.agg(F.sum("sales")).scalar()
    return sales.groupBy("store_id").agg(F.try_divide(F.sum("sales"), total).alias("share"))


def node_sales(sales: DataFrame) -> DataFrame:
    """Daily sales of every node of the tree, as series ``(store_id=level, item_id=node)``.

    Named like any other series so that every forecaster runs on nodes too.
    """
    daily = sum_up(sales.groupBy("state_id", "store_id", F.col("date").alias("step")).agg(
        F.sum("sales").alias("yhat")))
    return daily.select(F.col("level").alias("store_id"), F.col("node").alias("item_id"),
                        F.col("step").alias("date"), F.col("yhat").alias("sales"))


def as_base(forecast: DataFrame) -> DataFrame:
    """Forecasts of :func:`node_sales` series back to ``(level, node, step, yhat)``."""
    return forecast.select(F.col("store_id").alias("level"), F.col("item_id").alias("node"), "step", "yhat")
