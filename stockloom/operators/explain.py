"""Which features drive a linear model, and records of model runs."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def linear_weights(matrix: DataFrame, columns: list[str], label: str = "sales", ridge: float = 0.0) -> dict[str, float]:
    """Least-squares weight of each feature (one distributed pass over the moments)."""
    rows = VectorAssembler(inputCols=columns, outputCol="features").transform(matrix)
    model = LinearRegression(featuresCol="features", labelCol=label, regParam=ridge, solver="normal").fit(rows)
    return dict(zip(columns, (float(w) for w in model.coefficients)))


def mean_contributions(matrix: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Mean absolute contribution ``|w (x - mean x)|`` per feature, largest first.

    For a linear model these are the exact additive contributions.
    """
    means = matrix.agg(F.struct(*(F.avg(c).alias(c) for c in weights)).alias("means")).scalar()
    centred = matrix.withColumn("_means", means)   # one subquery of one row
    parts = centred.agg(*(
        F.avg(F.abs(F.lit(w) * (F.col(c) - F.col(f"_means.{c}")))).alias(c) for c, w in weights.items()))
    rows = F.array(*(F.struct(F.lit(c).alias("feature"), F.col(c).alias("mean_contribution")) for c in weights))
    return parts.select(F.inline(rows)).orderBy(F.desc("mean_contribution"), "feature")


def top_features(ranking: DataFrame, score: str, count: int = 10) -> DataFrame:
    """The first rows of a ranking, as the report shows them."""
    return ranking.orderBy(F.desc(score), "feature").limit(count)


def run_records(run: str, comparison: DataFrame, metrics: list[str], step: int | None = None) -> DataFrame:
    """Metrics of a comparison as rows ``(run, series, model, step, metric, value)``."""
    pairs = F.array(*(
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics))
    keys = [c for c in ("store_id", "item_id", "model") if c in comparison.columns]
    return comparison.select(F.lit(run).alias("run"), *keys, F.lit(step).cast("int").alias("step"), F.inline(pairs))
