"""Readers and writers for the M5 files and the planning outputs."""

from __future__ import annotations

from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom import fixed_values as V
from stockloom.errors import DataValidationError, EmptyDataFrameError, MissingDatasetError
from stockloom.sources.schemas import schema_for


class RetailTables(NamedTuple):
    calendar: DataFrame
    prices: DataFrame
    sales: DataFrame


def read_table(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read one table with fixed types and typed errors.

    A CSV is read twice: the header alone gives the column order (an M5 sales file
    has as many day columns as it has days), then the rows are read with the schema,
    failing on rows that do not fit it. Rows are checked when they are used; only the
    first one is looked at here.
    """
    try:
        if fmt == "csv":
            header = spark.read.option("header", True).csv(path).columns
            rows = (
                spark.read.option("header", True).option("mode", "FAILFAST")
                .option("enforceSchema", False)  # a part with another column order is an error
                .schema(schema_for(header)).csv(path)
            )
        else:
            rows = spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise MissingDatasetError(path) from error
        if "UNABLE_TO_INFER_SCHEMA" in str(error):
            raise EmptyDataFrameError(path) from error
        raise DataValidationError(path) from error
    if not rows.columns:
        raise EmptyDataFrameError(path)
    try:
        first = rows.head(1)  # all columns of one row; a count would parse none
    except (PySparkException, Py4JJavaError) as error:
        raise DataValidationError(path, "Rows cannot be read") from error
    if not first:
        raise EmptyDataFrameError(path)
    return rows


def read_retail_tables(spark: SparkSession, folder: str) -> RetailTables:
    """The three M5 tables of one folder."""
    base = folder.rstrip("/")
    return RetailTables(*(
        read_table(spark, f"{base}/{name}")
        for name in (V.CALENDAR_FILE, V.PRICES_FILE, V.SALES_FILE)
    ))


def write_csv(df: DataFrame, path: str) -> None:
    """One folder of CSV parts with headers; nothing is funnelled through one task."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_report(lines: DataFrame, path: str) -> None:
    """Numbered report lines as one text file; a report has a few lines per table."""
    lines.coalesce(1).sortWithinPartitions("line_no").select("line").write.mode("overwrite").text(path)


def action_log(policies: DataFrame) -> DataFrame:
    """The ten-column replenishment log, numbers rounded to two places."""
    two = lambda name: F.round(F.col(name), 2)
    values = [
        F.col("store_id"), F.col("item_id"), two("on_hand"), two("on_order"),
        two("safety_stock"), two("reorder_point"), two("order_up_to_level"),
        two("order_out"), two("order_newsvendor"), F.col("inventory_health"),
    ]
    return policies.select(*(v.alias(n) for v, n in zip(values, V.ACTION_LOG_COLUMNS)))


def submission(forecasts: DataFrame, steps: int = V.SUBMISSION_STEPS) -> DataFrame:
    """Long ``(id, step, yhat)`` rows to ``id, F1..Fn`` for both id endings, gaps as 0."""
    names = [f"F{s}" for s in range(1, steps + 1)]
    # Conditional sums give every step column in one aggregation, without pivot's
    # second pass.
    wide = forecasts.groupBy("id").agg(*(
        F.coalesce(F.sum(F.when(F.col("step") == s, F.col("yhat"))), F.lit(0.0)).alias(n)
        for s, n in enumerate(names, start=1)
    ))
    endings = F.explode(F.array(F.lit("_validation"), F.lit("_evaluation")))
    return wide.withColumn("ending", endings).select(
        F.concat(F.regexp_replace("id", "_validation$", ""), "ending").alias("id"), *names)


def write_records(records: DataFrame, path: str) -> None:
    """Write run records ``(run, model, step, metric, value)`` to a Parquet table; a repeated run replaces its own rows."""
    records.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)
