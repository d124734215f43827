"""Permissive reading: rows that do not fit go to a reject table with typed reasons, the others go on.

One bad cell does not stop a load. A line that cannot be split or typed keeps its text; a row that can be read is judged
by rules. Good rows and rejects come from one reading of the files, and every reject names its file.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom import fixed_values as V
from stockloom.session import scratch_path
from stockloom.sources.schemas import schema_for

UNREADABLE, REPEATED = "unreadable line", "repeated key"


class Judged(NamedTuple):
    """``clean`` has the table's columns; ``rejects`` has file, line (its text), reasons and the readable columns."""

    clean: DataFrame
    rejects: DataFrame


class Rules(NamedTuple):
    """What a row has to meet: columns that must be given, a key, and named SQL conditions (true where a row is bad)."""

    given: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    bad: dict[str, str] = {}


PRICE_RULES = Rules(tuple(V.PRICES_REQUIRED), ("store_id", "item_id", "wm_yr_wk"), {"price not above 0": "sell_price <= 0"})
CALENDAR_RULES = Rules(("date", "wm_yr_wk", "d"), ("d",), {})


def judged(rows: DataFrame, rules: Rules, line: Column, file: Column, unreadable: Column) -> DataFrame:
    """``rows`` with ``_file``, ``_line`` and ``_reasons`` (empty for good rows).

    Of rows that share a key the first by their text stays, the others are rejected; bad rows take no part in that.
    """
    missing = [F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in rules.given]
    broken = [F.when(F.expr(condition), F.lit(reason)) for reason, condition in rules.bad.items()]
    own = F.when(unreadable, F.array(F.lit(UNREADABLE))).otherwise(F.array_compact(F.array(*missing, *broken, F.lit(None).cast("string"))))
    marked = rows.withColumns({"_file": file, "_line": line, "_reasons": own})
    if not rules.key:
        return marked
    # Only rows whose key occurs again are ordered; hot keys are rare rows by definition of a key.
    good = F.size("_reasons") == 0
    order = Window.partitionBy(*rules.key, good).orderBy("_line", "_file")
    repeated = good & (F.row_number().over(order) > 1)
    return marked.withColumn("_reasons", F.when(repeated, F.array(F.lit(REPEATED))).otherwise(F.col("_reasons")))


def read_judged(spark: SparkSession, path: str, rules: Rules, name: str = "judged") -> Judged:
    """Read a CSV folder or file with a header into clean rows and rejects.

    The judged rows are written once to the shared folder, so both tables come from one reading. A line with too
    many, too few or untyped cells is unreadable; its cells that could be typed are kept beside its text.
    """
    header = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([*schema_for(header).fields, T.StructField("_line", T.StringType())])
    rows = spark.read.option("header", True).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", "_line").schema(schema).csv(path)
    # The whole line of good rows is written again, for the order of equal keys.
    text = F.coalesce(F.col("_line"), F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in header)))
    marked = judged(rows.withColumn("_bad", F.col("_line").isNotNull()), rules, text, F.input_file_name(), F.col("_bad")).drop("_bad")
    stored = scratch_path(spark, name)
    marked.write.parquet(stored)
    kept = spark.read.parquet(stored)
    good = F.size("_reasons") == 0
    return Judged(kept.where(good).select(*header),
                  kept.where(~good).select(F.col("_file").alias("file"), F.col("_line").alias("line"), F.col("_reasons").alias("reasons"), *header))


def reject_counts(rejects: DataFrame) -> DataFrame:
    """(reason, rows) over all rejects; a row with several reasons counts for each."""
    return rejects.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))
