"""Yesterday's state and one day more against the whole walk."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.operators import intervals, resumable, smoothing
from stockloom.operators.series_fit import as_forecast


@pytest.fixture(scope="module")
def panel(make_panel):
    rng = np.random.default_rng(4)
    series = {("S", str(k)): rng.poisson(4, 40).astype(float).tolist() for k in range(5)}
    return make_panel(series | {("S", "short"): [3.0], ("S", "zero"): [0.0] * 40}, partitions=3)


def rows(states):
    return {r["item_id"]: r.asDict() for r in states.collect()}


def test_state_and_one_day_equal_the_whole_walk(panel):
    whole = rows(resumable.advance(None, panel))
    states = resumable.store(resumable.advance(None, panel.where("day_no <= 25")))
    for day in (26, 27):
        states = resumable.store(resumable.advance(states, panel.where(F.col("day_no") == day)))
    states = resumable.advance(states, panel.where("day_no > 27"))
    assert rows(states) == whole and whole["0"]["days"] == 40 and whole["short"]["days"] == 1


def test_forecast_and_spread_are_the_operators(panel):
    states = resumable.store(resumable.advance(None, panel))
    made = {(r["item_id"], r["step"]): r for r in resumable.forecast(states, 5).collect()}
    for r in as_forecast(smoothing.ets(panel, 5), ("alpha", "beta", "sse")).collect():
        found = made[r["item_id"], r["step"]]
        assert [found[c] for c in ("alpha", "beta", "date")] == [r[c] for c in ("alpha", "beta", "date")]
        assert found["yhat"] == pytest.approx(r["yhat"], abs=1e-9) and found["sse"] == pytest.approx(r["sse"], abs=1e-9)
    spreads = {r["item_id"]: r for r in resumable.spread(states).collect()}
    for r in intervals.residual_spread(intervals.seasonal_residuals(panel)).collect():
        assert spreads[r["item_id"]]["residuals"] == r["residuals"]
        assert spreads[r["item_id"]]["spread"] == pytest.approx(r["spread"], abs=1e-9)


def test_days_count_once_new_series_begin_and_gaps_fail(spark, panel):
    states = resumable.store(resumable.advance(None, panel.where("day_no <= 20")))
    again = resumable.advance(states, panel.where("day_no in (19, 20, 21)"))
    assert rows(again) == rows(resumable.advance(states, panel.where("day_no = 21")))
    late = spark.createDataFrame([("T", "new", datetime.date(2024, 5, 1), 2.0)], "store_id string, item_id string, date date, sales double")
    more = rows(resumable.advance(states, late))
    assert more["new"]["days"] == 1 and more["0"]["days"] == 20
    with pytest.raises(Exception, match="Days do not follow"):
        resumable.advance(states, panel.where("day_no = 23")).collect()
    assert resumable.advance(None, panel.limit(0)).count() == 0
