"""Forecast accuracy measures as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockloom import fixed_values as V


def mae(y: Column, f: Column) -> Column:
    return F.avg(F.abs(y - f))


def rmse(y: Column, f: Column) -> Column:
    return F.sqrt(F.avg((y - f) * (y - f)))


def wape(y: Column, f: Column) -> Column:
    """Absolute error per unit of demand; 0 where there was no demand."""
    return F.when(F.sum(y) > 0, F.sum(F.abs(y - f)) / F.sum(y)).otherwise(F.lit(0.0))


def mape(y: Column, f: Column) -> Column:
    """A fraction, not a percentage; days without demand make it very large."""
    return F.avg(F.abs(y - f) / F.greatest(y, F.lit(V.METRIC_EPS)))


def smape(y: Column, f: Column) -> Column:
    """A percentage."""
    middle = (F.abs(y) + F.abs(f)) / 2
    return F.avg(F.abs(y - f) / F.greatest(middle, F.lit(V.METRIC_EPS))) * 100


def bias(y: Column, f: Column) -> Column:
    return F.avg(f - y)


def accuracy(y: Column, f: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - wape(y, f))


ALL = {"Accuracy": accuracy, "WAPE": wape, "MAE": mae, "RMSE": rmse, "SMAPE": smape, "MAPE": mape, "Bias": bias}


def all_metrics(y: Column, f: Column) -> list[Column]:
    return [measure(y, f).alias(name) for name, measure in ALL.items()]
