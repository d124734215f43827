"""Running totals and exact quantiles that never gather one group in one task.

Values are first reduced to ``(keys, value, counts)``, so a value that fills a third of a
table becomes one row. Running totals over those rows are built in two levels: rows are
cut into value ranges, each range is summed on its own, and the few range totals are
carried over. Ranges come from Spark's bounded quantile sketch; they only steer where work
happens and never change a result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_RANGES = 4096


def split_points(df: DataFrame, value: str, ranges: int | None = None) -> list[float]:
    """Ascending cut points of a numeric column (one pass), one range per shuffle partition."""
    return column_splits(df, [value], ranges)[value]


def column_splits(df: DataFrame, columns: list[str], ranges: int | None = None) -> dict[str, list[float]]:
    """:func:`split_points` of several columns in one pass; at most 4,095 numbers each."""
    if ranges is None:
        ranges = min(MAX_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    probabilities = [i / ranges for i in range(1, ranges)]
    found = df.stat.approxQuantile(columns, probabilities, 0.5 / ranges)
    return {c: sorted(set(points)) for c, points in zip(columns, found)}


def _with_range(df: DataFrame, value: str, splits: list[float]) -> DataFrame:
    if not splits:
        return df.withColumn("_range", F.lit(0))
    edges = [float("-inf"), *splits, float("inf")]
    return Bucketizer(splits=edges, inputCol=value, outputCol="_range").transform(df)


def running_totals(
    counts: DataFrame, keys: list[str], value: str, sums: list[str], splits: list[float] = (),
) -> DataFrame:
    """Add ``<sum>_before``: the total over smaller values of the same key.

    ``counts`` has one row per ``keys + [value]``. Without ``splits`` each key is one
    window group, which suits keys with a known small number of values (one series).
    """
    ranged = _with_range(counts, value, splits)
    below = Window.partitionBy(*keys, "_range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.withColumns({
        f"{s}_before": F.coalesce(F.sum(s).over(below), F.lit(0)) for s in sums})
    if not splits:
        return inside.drop("_range")
    earlier = (
        Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        if keys else
        Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        ranged.groupBy(*keys, "_range").agg(*(F.sum(s).alias(f"_{s}") for s in sums))
        .select(*keys, "_range",
                *(F.coalesce(F.sum(f"_{s}").over(earlier), F.lit(0)).alias(f"_{s}") for s in sums))
    )
    joined = inside.join(carried, keys + ["_range"])
    return joined.select(*counts.columns, *(
        (F.col(f"{s}_before") + F.col(f"_{s}")).alias(f"{s}_before") for s in sums))


def quantile_at(value: Column, before: Column, count: Column, total: Column, probability: float) -> Column:
    """Aggregate expression: the linearly interpolated quantile from running counts."""
    place = (total - 1) * F.lit(float(probability))
    low, high = F.floor(place), F.ceil(place)
    holds = lambda rank: (before <= rank) & (rank < before + count)
    low_value = F.max(F.when(holds(low), value))
    high_value = F.max(F.when(holds(high), value))
    share = F.max(place - low)
    return low_value + (high_value - low_value) * share


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """One row ``(column, q0, q1, ...)`` per numeric column, exact, over the whole frame; NaN counts as missing."""
    parts, splits = [], column_splits(df, columns)
    for name in columns:
        kept = df.select(F.col(name).cast("double").alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value"))
        counts = kept.groupBy("value").agg(F.count(F.lit(1)).alias("n"))
        ranked = running_totals(counts, [], "value", ["n"], splits[name])
        total = kept.agg(F.count(F.lit(1))).scalar()
        parts.append(ranked.withColumn("_total", total).agg(*(
            quantile_at(F.col("value"), F.col("n_before"), F.col("n"), F.col("_total"), p).alias(f"q{i}")
            for i, p in enumerate(probabilities)
        )).select(F.lit(name).alias("column"), "*"))
    return reduce(DataFrame.unionByName, parts)


def count_quantiles(counts: DataFrame, probabilities: list[float]) -> DataFrame:
    """One row ``(column, q0, q1, ...)`` from value counts ``(column, value, n)``, exact; NaN counts as missing.

    All columns share one running total; its ranges are cut by values of all of them.
    """
    kept = counts.where(~F.isnan("value"))
    ranked = running_totals(kept, ["column"], "value", ["n"], split_points(kept, "value"))
    totals = kept.groupBy("column").agg(F.sum("n").alias("_total"))
    return ranked.join(F.broadcast(totals), "column").groupBy("column").agg(*(
        quantile_at(F.col("value"), F.col("n_before"), F.col("n"), F.col("_total"), p).alias(f"q{i}") for i, p in enumerate(probabilities)))
