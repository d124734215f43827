"""Coherent forecasts on a tree of any depth, given as a parent table.

The forecasts nearest to the base forecasts come from two sweeps over the levels. Upwards, a node's subtree is summed
up in two numbers: the total that its own forecast and its children's subtrees speak for, and the variance of that
total if every forecast has variance one. Downwards, a node hands the difference between its total and its children's
to the children, in proportion to their variances. Each sweep is one aggregation and one join per level, keyed by
node and step; no summing matrix is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.errors import DataValidationError
from stockloom.session import cut_lineage

MOST_LEVELS = 64


def node_levels(parents: DataFrame) -> list[DataFrame]:
    """(node, parent) per level from the roots (null parent) down; every level is written once.

    A node below itself, below an unknown node or named twice is an error.
    """
    nodes = parents.select(F.col("node").cast("string").alias("node"), F.col("parent").cast("string").alias("parent"))
    nodes = cut_lineage(nodes)
    total = nodes.count()
    if nodes.select("node").distinct().count() < total:
        raise DataValidationError("parent table", "A node has two rows in")
    levels, found = [cut_lineage(nodes.where("parent is null"))], 0
    while (held := levels[-1].count()):
        found += held
        if len(levels) > MOST_LEVELS:
            raise DataValidationError("parent table", f"More than {MOST_LEVELS} levels in")
        above = levels[-1].select(F.col("node").alias("parent"))
        levels.append(cut_lineage(nodes.join(above, "parent", "left_semi").select("node", "parent")))
    if found < total:
        raise DataValidationError("parent table", "Nodes without a way to a root in")
    return levels[:-1]


def reconcile(base: DataFrame, parents: DataFrame, floor: float | None = 0.0) -> DataFrame:
    """``(node, level, step, yhat)``: the coherent forecasts nearest to ``base`` (node, step, yhat) in least squares.

    Levels count from 0 at the roots; trees may be uneven, and a forest is a set of trees. A node without a forecast
    at a step counts as 0; forecasts of unknown nodes are left out. Values under ``floor`` are raised to it last, which
    may break the sums; None leaves them.
    """
    levels = node_levels(parents)
    steps = cut_lineage(base.select("step").distinct())
    own = base.groupBy(F.col("node").cast("string").alias("node"), "step").agg(F.sum(F.col("yhat").cast("double")).alias("own"))
    up: list[DataFrame] = []
    for nodes in reversed(levels):
        # Steps are few; every node has every step.
        rows = nodes.crossJoin(F.broadcast(steps)).join(own, ["node", "step"], "left").withColumn("own", F.coalesce("own", F.lit(0.0)))
        if up:
            below = up[-1].groupBy(F.col("parent").alias("node"), "step").agg(
                F.sum("total").alias("held"), F.sum("variance").alias("spread"))
            rows = rows.join(below, ["node", "step"], "left")
        else:
            rows = rows.withColumns({"held": F.lit(None).cast("double"), "spread": F.lit(None).cast("double")})
        leaf = F.col("spread").isNull()
        up.append(cut_lineage(rows.withColumns({
            "total": F.when(leaf, F.col("own")).otherwise((F.col("held") + F.col("spread") * F.col("own")) / (1 + F.col("spread"))),
            "variance": F.when(leaf, 1.0).otherwise(F.col("spread") / (1 + F.col("spread"))),
        }).select("node", "parent", "step", "held", "spread", "total", "variance")))
    up.reverse()
    out, above = None, None
    for level, rows in enumerate(up):
        if above is None:
            settled = rows.withColumn("yhat", F.col("total"))
        else:
            settled = rows.join(above, ["parent", "step"]).withColumn(
                "yhat", F.col("total") + F.col("variance") * F.col("missing"))
        # What a node's total has more than its children's, per unit of their variance.
        settled = cut_lineage(settled.select("node", "step", "yhat", ((F.col("yhat") - F.col("held")) / F.col("spread")).alias("missing")))
        above = settled.where("missing is not null").select(F.col("node").alias("parent"), "step", "missing")
        part = settled.select("node", F.lit(level).alias("level"), "step", "yhat")
        out = part if out is None else out.unionByName(part)
    if out is None:
        return base.sparkSession.createDataFrame([], "node string, level int, step int, yhat double")
    return out if floor is None else out.withColumn("yhat", F.greatest(F.lit(floor), F.col("yhat")))


def path_parents(rows: DataFrame, columns: list[str], root: str = "Total", mark: str = "/") -> DataFrame:
    """The parent table of nested columns, for example state, store, product: a node is named by its path."""
    paths = [F.concat_ws(mark, F.lit(root), *columns[:k]) for k in range(len(columns) + 1)]
    pairs = F.array(*(F.struct(path.alias("node"), (paths[k - 1] if k else F.lit(None).cast("string")).alias("parent"))
                      for k, path in enumerate(paths)))
    return rows.select(*columns).distinct().select(F.inline(pairs)).distinct()
