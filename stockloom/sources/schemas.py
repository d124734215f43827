"""Column types of the M5 tables; the sales table gets one integer column per day."""

from __future__ import annotations

from pyspark.sql import types as T

_TEXT, _INT = T.StringType(), T.IntegerType()

CALENDAR_TYPES = {
    "date": T.DateType(), "wm_yr_wk": _INT, "weekday": _TEXT, "wday": _INT, "month": _INT,
    "year": _INT, "d": _TEXT, "event_name_1": _TEXT, "event_type_1": _TEXT,
    "event_name_2": _TEXT, "event_type_2": _TEXT,
}
PRICE_TYPES = {
    "store_id": _TEXT, "item_id": _TEXT, "wm_yr_wk": _INT, "sell_price": T.DoubleType(),
}


def column_type(name: str) -> T.DataType:
    """Type of one M5 column, by its name; unknown columns stay text."""
    if name.startswith(("d_", "snap_")):
        return _INT
    if name.startswith("F") and name[1:].isdigit():
        return T.DoubleType()
    return CALENDAR_TYPES.get(name) or PRICE_TYPES.get(name) or _TEXT


def schema_for(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, column_type(name)) for name in columns])
