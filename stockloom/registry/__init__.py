"""All registered queries, one module per group of operators."""

from stockloom.registry import decisions, features, forecasts, tables  # noqa: F401
from stockloom.registry.base import ORACLES, QUERIES  # noqa: F401
