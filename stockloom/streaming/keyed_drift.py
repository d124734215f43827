"""Drift of an event stream with keyed state: every key carries its own counts from batch to batch.

The baseline's bins are computed once and stored; an arriving row falls into a bin of its key in the JVM. What a key
keeps is the number of rows per bin, a sketch that merges by addition and is exact for the stability index, so a
micro-batch reads its own rows alone. Rows behind the watermark are dropped by Spark, and a key without rows for a while
reports a last time and gives its state back. State lives in the query's checkpoint and survives a restart.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockloom import fixed_values as V
from stockloom.operators.drift import compared, key_summary

UPDATE = "rows long, outside long, psi double, drift_detected boolean, last_time timestamp, expired boolean"
STATE = "counts array<long>, outside long, old array<long>, old_rows long, last long"


def baseline_bins(baseline: DataFrame, keys: list[str], value: str, bins: int = V.PSI_BINS, small_keys: bool = False) -> DataFrame:
    """(keys, edges, old, old_rows): distinct quantile edges of each key's baseline and its rows per bin."""
    table = compared(baseline.select(*keys, F.col(value).cast("double").alias("value"), F.lit(False).alias("is_new")), keys, small_keys)
    edges = key_summary(table, keys, bins).select(*keys, "edges", "old_rows")
    placed = table.select(*keys, "value", "old").join(edges, keys).withColumn("bin", bin_of(F.col("value"), F.col("edges")))
    counts = placed.groupBy(*keys).agg(
        F.first("edges").alias("edges"), F.first("old_rows").alias("old_rows"),
        *(F.coalesce(F.sum(F.when(F.col("bin") == b, F.col("old"))), F.lit(0)).alias(f"_{b}") for b in range(bins)))
    old = F.slice(F.array(*(F.col(f"_{b}").cast("long") for b in range(bins))), F.lit(1), F.greatest(F.size("edges") - 1, F.lit(0)))
    return counts.select(*keys, "edges", old.alias("old"), "old_rows")


def bin_of(value, edges):
    """Number of the bin from 0; null outside the baseline's range. The last bin holds its upper edge."""
    place = F.size(F.filter(edges, lambda edge: edge <= value))
    count = F.size(edges) - 1
    return F.when((count > 0) & (value == F.element_at(edges, -1)), count - 1).when((place >= 1) & (place <= count), place - 1)


def stability(new: np.ndarray, new_rows: int, old: np.ndarray, old_rows: int) -> float:
    """Stability index of rows per bin; the totals also count values outside all bins."""
    share = lambda held, rows: (held + V.PSI_EPS) / (rows + V.PSI_EPS * len(old))
    a, b = share(new, new_rows), share(old, old_rows)
    return float(((a - b) * np.log(a / b)).sum()) if len(old) else 0.0


def keyed_drift(
    arriving: DataFrame, bins: DataFrame, keys: list[str], value: str, time: str, late: str = "1 hour", idle: str = "1 day",
) -> DataFrame:
    """A streaming frame of ``keys`` with rows so far, stability index, verdict and time, one row per key and batch.

    ``bins`` is a stored :func:`baseline_bins`. Rows later than ``late`` behind the newest event are dropped; after
    ``idle`` of event time without rows a key reports once more with ``expired`` and starts anew. Keys without a
    baseline and null values are outside all bins.
    """
    wait = int(pd.Timedelta(idle).total_seconds() * 1000)
    rows = arriving.select(*keys, F.col(time).alias("_time"), F.col(value).cast("double").alias("_value")).withWatermark("_time", late)
    binned = rows.join(bins, keys, "left").select(
        *keys, "_time", bin_of(F.col("_value"), F.col("edges")).alias("_bin"), F.coalesce("old", F.array().cast("array<bigint>")).alias("_old"),
        F.coalesce("old_rows", F.lit(0)).cast("long").alias("_old_rows"))

    def report(key: tuple, held: tuple, expired: bool) -> pd.DataFrame:
        counts, outside, old, old_rows, last = held
        n = int(sum(counts) + outside)
        psi = stability(np.array(counts, float), n, np.array(old, float), old_rows)
        return pd.DataFrame({**{k: [v] for k, v in zip(keys, key)}, "rows": [n], "outside": [int(outside)], "psi": [psi],
                             "drift_detected": [psi >= V.PSI_ALARM], "last_time": [pd.Timestamp(last, unit="ms")], "expired": [expired]})

    def take(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            held = state.get
            state.remove()
            yield report(key, held, True)
            return
        held = state.get if state.exists else None
        for frame in frames:
            if held is None:
                old = [int(x) for x in frame["_old"].iat[0]]
                held = ([0] * len(old), 0, old, int(frame["_old_rows"].iat[0]), 0)
            counts, outside, old, old_rows, last = held
            inside = frame["_bin"].dropna().astype(int)
            counts = (np.array(counts, np.int64) + np.bincount(inside, minlength=len(old))).tolist() if len(old) else []
            outside += len(frame) - len(inside)
            newest = int(frame["_time"].max().value // 1_000_000)
            held = (counts, int(outside), list(old), old_rows, max(last, newest))
        if held is None:
            return
        state.update(held)
        state.setTimeoutTimestamp(max(held[4], state.getCurrentWatermarkMs()) + wait)
        yield report(key, held, False)

    kinds = dict(arriving.dtypes)
    return binned.groupBy(*keys).applyInPandasWithState(
        take, ", ".join(f"{k} {kinds[k]}" for k in keys) + ", " + UPDATE, STATE, "update", "EventTimeTimeout")


def start_keyed_drift(arriving: DataFrame, bins: DataFrame, keys: list[str], value: str, time: str, reports: str, checkpoint: str,
                      once: bool = False, **settings) -> StreamingQuery:
    """Write the verdicts of every micro-batch to ``reports/batch=<id>``; a batch that is run again replaces its own."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{reports}/batch={batch_id}")

    writer = keyed_drift(arriving, bins, keys, value, time, **settings).writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
