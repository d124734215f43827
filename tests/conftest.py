import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stockloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__ui__enabled="false", spark__driver__memory="4g",
        spark__sql__shuffle__partitions="4", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="stockloom-tests-"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_panel(spark):
    """``make_panel({("S", "I"): [1, 2, 3]})`` -> long panel starting on a Monday."""
    import datetime

    def build(series, first=datetime.date(2024, 1, 1), state="CA", partitions=None):
        rows = [
            (store, item, state, first + datetime.timedelta(days=i), i + 1, float(v))
            for (store, item), values in series.items() for i, v in enumerate(values)]
        df = spark.createDataFrame(
            rows, "store_id string, item_id string, state_id string, date date, day_no int, sales double")
        return df.repartition(partitions) if partitions else df

    return build


@pytest.fixture(scope="session")
def values():
    """Column of a small result as a list, in the given order."""
    def get(df, column, *order):
        return [r[column] for r in df.orderBy(*order).select(column).collect()]
    return get
