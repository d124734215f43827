"""Demand forecasting and replenishment for every store and product at once, on PySpark."""
