"""Has the distribution of a value changed? PSI and the two-sample Kolmogorov-Smirnov test.

Both statistics come from one table of value counts per key with running totals (see
``plans.ordered``). Rows of equal value are added up before any shuffle, so neither a hot
key nor a hot value gathers raw rows in one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.plans.ordered import quantile_at, running_totals, split_points

KOLMOGOROV_TERMS = 100


def split_newest(df: DataFrame, keys: list[str], value: str, order: str = "date", incoming: int = V.INCOMING_ROWS) -> DataFrame:
    """``(keys, value, is_new)``: the newest rows of a key against all earlier ones.

    The baseline keeps at least the first ten rows. For keys that are series, with one row
    per day; keys of unknown size are better cut at a time, as a plain column.
    """
    by_key = Window.partitionBy(*keys)
    position = F.row_number().over(by_key.orderBy(order))
    total = F.count(F.lit(1)).over(by_key)
    kept = F.greatest(F.lit(V.MIN_BASELINE_ROWS), total - incoming)
    return df.select(*keys, F.col(value).cast("double").alias("value"), (position > kept).alias("is_new"))


def value_counts(sides: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per key and value on both sides."""
    return sides.groupBy(*keys, "value").agg(
        F.count_if(~F.col("is_new")).alias("old"), F.count_if("is_new").alias("new"))


def compared(sides: DataFrame, keys: list[str], small_keys: bool = True) -> DataFrame:
    """Value counts with running totals (``*_before``) and key totals (``*_total``).

    ``small_keys``: every key holds one bounded series. Otherwise a key may hold any
    number of distinct values, and the running totals are built range by range.
    """
    counts = value_counts(sides, keys)
    splits = [] if small_keys else split_points(sides, "value")
    running = running_totals(counts, keys, "value", ["old", "new"], splits)
    if small_keys:  # already placed by key: totals need no join
        whole = Window.partitionBy(*keys)
        return running.withColumns({f"{s}_total": F.sum(s).over(whole) for s in ("old", "new")})
    totals = counts.groupBy(*keys).agg(F.sum("old").alias("old_total"), F.sum("new").alias("new_total"))
    return running.join(totals, keys)


def _distance() -> Column:
    """Largest distance of the two cumulative shares; null when one side has no rows."""
    share = lambda side: F.try_divide(F.col(f"{side}_before") + F.col(side), F.col(f"{side}_total"))
    return F.max(F.abs(share("old") - share("new")))


def _edges(bins: int) -> Column:
    """Distinct quantile edges of the baseline."""
    return F.array_distinct(F.array(*(
        quantile_at(F.col("value"), F.col("old_before"), F.col("old"), F.col("old_total"), i / bins)
        for i in range(bins + 1))))


def key_summary(table: DataFrame, keys: list[str], bins: int = V.PSI_BINS) -> DataFrame:
    """One row per key: KS distance, PSI edges and both sample sizes, in one aggregation."""
    return table.groupBy(*keys).agg(
        _distance().alias("ks_statistic"), _edges(bins).alias("edges"),
        F.first("old_total").alias("old_rows"), F.first("new_total").alias("new_rows"))


def ks_statistic(table: DataFrame, keys: list[str]) -> DataFrame:
    """KS distance per key, with both sample sizes."""
    return key_summary(table, keys).drop("edges")


def kolmogorov_p(statistic: Column, old_rows: Column, new_rows: Column, terms: int = KOLMOGOROV_TERMS) -> Column:
    """Two-sided p-value from Kolmogorov's limiting series."""
    size = F.try_divide(old_rows * new_rows, old_rows + new_rows)
    squared = size * statistic * statistic
    tail = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda total, k: total + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2 * k * k * squared))
    # The series alternates without settling near 0, where the p-value is 1.
    return F.when(squared < 0.04, 1.0).when(squared >= 0.04, F.least(F.lit(1.0), F.greatest(F.lit(0.0), tail)))


def path_probability(old: int, new: int, statistics: np.ndarray) -> np.ndarray:
    """P(D >= statistic) for samples of these sizes without ties, by counting lattice paths.

    A random order of both samples is a path over the grid of their counts. The chance to
    have touched a point as far out as the statistic is averaged forward over the grid,
    which needs no large numbers. All statistics are advanced together.
    """
    if old < new:
        old, new = new, old
    bound = np.round(np.asarray(statistics, dtype=float)[:, None] * old * new) - 0.5
    j = np.arange(new + 1)
    touched = np.where(bound <= 0, 1.0, 0.0).repeat(new + 1, axis=1)
    for k in range(1, old + new + 1):   # all points of a diagonal, i + j = k, at once
        i = k - j
        before = np.concatenate([touched[:, :1], touched[:, :-1]], axis=1)
        value = np.where(i > 0, (i * touched + j * before) / k, before)
        value[:, i < 0] = 0.0
        touched = np.where((i >= 0) & (np.abs(i * new - j * old) >= bound), 1.0, value)
    return touched[:, new]


def with_p_value(statistics: DataFrame, keys: list[str], method: str = "exact") -> DataFrame:
    """Add ``ks_p_value``, null for a side without rows; the caller chooses how it is found.

    ``exact`` counts lattice paths, in steps that grow with the product of both sample sizes: for
    series, whose newest rows are few. ``asymptotic`` is Kolmogorov's limiting series, for large
    samples. Both work on one row per key (two sizes and a statistic), never on data.
    """
    if method == "asymptotic":
        return statistics.withColumn("ks_p_value", kolmogorov_p(F.col("ks_statistic"), F.col("old_rows"), F.col("new_rows")))
    if method != "exact":
        raise ValueError(f"unknown method {method!r}; known: exact, asymptotic")

    @F.pandas_udf("double")
    def exact(stat: pd.Series, old: pd.Series, new: pd.Series) -> pd.Series:
        result = pd.Series(np.nan, index=stat.index)
        for (m, n), rows in stat.groupby([old, new]):
            if m > 0 and n > 0:
                result[rows.index] = path_probability(int(m), int(n), rows.to_numpy())
        return result

    counted = exact(F.coalesce("ks_statistic", F.lit(0.0)), F.coalesce("old_rows", F.lit(0)), F.coalesce("new_rows", F.lit(0)))
    return statistics.withColumn("ks_p_value", counted).withColumn("ks_p_value", F.nanvl("ks_p_value", F.lit(None).cast("double")))


def psi(
    table: DataFrame, keys: list[str], bins: int = V.PSI_BINS, summary: DataFrame | None = None,
) -> DataFrame:
    """Population stability index per key.

    Values outside the baseline's range fall in no bin but still count in the totals; a
    baseline with one distinct value has no bin and scores 0.
    """
    edges = (key_summary(table, keys, bins) if summary is None else summary).drop("ks_statistic")
    place = F.size(F.filter("edges", lambda edge: edge <= F.col("value")))
    count = F.size("edges") - 1
    at_top = F.col("value") == F.element_at("edges", -1)
    bin_of = F.when(at_top, count).when((place >= 1) & (place <= count), place)
    binned = table.select(*keys, "value", "old", "new").join(edges, keys).withColumn("bin", bin_of)
    sums = binned.groupBy(*keys).agg(
        F.first(count).alias("bins"), F.first("old_rows").alias("old_rows"), F.first("new_rows").alias("new_rows"),
        *(F.coalesce(F.sum(F.when(F.col("bin") == b, F.col(side))), F.lit(0)).alias(f"{side}_{b}")
          for b in range(1, bins + 1) for side in ("old", "new")))
    share = lambda side, b: (F.col(f"{side}_{b}") + V.PSI_EPS) / (
        F.col(f"{side}_rows") + V.PSI_EPS * F.col("bins"))
    total = F.lit(0.0)
    for b in range(1, bins + 1):
        part = (share("new", b) - share("old", b)) * F.ln(share("new", b) / share("old", b))
        total = total + F.when(F.col("bins") >= b, part).otherwise(0.0)
    return sums.select(*keys, total.alias("psi"))


def drift_report(sides: DataFrame, keys: list[str], small_keys: bool = True, method: str = "exact") -> DataFrame:
    """KS and PSI verdicts per key; either one raises the alarm."""
    table = compared(sides, keys, small_keys)
    summary = key_summary(table, keys)
    joined = with_p_value(summary.drop("edges"), keys, method).join(psi(table, keys, summary=summary), keys)
    alarms = joined.withColumns({
        "ks_drift": F.col("ks_p_value") < V.KS_ALPHA, "psi_drift": F.col("psi") >= V.PSI_ALARM})
    # Without incoming rows there is no test, and a comparison with nothing is no alarm.
    drift = (F.col("new_rows") > 0) & (F.coalesce("ks_drift", F.lit(False)) | F.col("psi_drift"))
    return alarms.withColumns({
        "drift_detected": drift,
        "status_message": F.when(drift, V.DRIFT_MESSAGE).otherwise(V.STABLE_MESSAGE)})
