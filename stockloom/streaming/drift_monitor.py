"""Drift checks of arriving rows against a stored baseline, one report per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockloom.operators.drift import drift_report


def start_drift_monitor(
    arriving: DataFrame, baseline: DataFrame, keys: list[str], value: str,
    reports: str, checkpoint: str, small_keys: bool = False, once: bool = False,
) -> StreamingQuery:
    """Write a drift report of every micro-batch to ``reports/batch=<id>``.

    A batch that is run again after a failure overwrites its own folder, so each batch is
    reported once.
    """
    old = baseline.select(*keys, F.col(value).cast("double").alias("value"), F.lit(False).alias("is_new"))

    def report(batch: DataFrame, batch_id: int) -> None:
        new = batch.select(*keys, F.col(value).cast("double").alias("value"), F.lit(True).alias("is_new"))
        seen = new.select(*keys).distinct()
        both = old.join(seen, keys, "left_semi").unionByName(new)
        drift_report(both, keys, small_keys).write.mode("overwrite").parquet(f"{reports}/batch={batch_id}")

    writer = arriving.writeStream.foreachBatch(report).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
