import datetime
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockloom.errors import EmptyDataFrameError
from stockloom.operators import features as B
from stockloom.operators import panel as P

ONE = ("CA_1", "HOBBIES_1_001")


@pytest.fixture(scope="module")
def wide(spark):
    return spark.createDataFrame(
        [("a_CA_1_validation", "a", "D", "C", "CA_1", "CA", 1, 0, 3),
         ("b_CA_1_validation", "b", "D", "C", "CA_1", "CA", 2, 4, 1)],
        "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string, "
        "d_1 int, d_2 int, d_3 int")


def test_unpivot_gives_one_row_per_day(wide, values):
    rows = P.unpivot_days(wide)
    assert values(rows.where("item_id = 'a'"), "sales", "d") == [1, 0, 3]
    assert rows.count() == 6


def test_unpivot_without_day_columns(wide):
    with pytest.raises(EmptyDataFrameError):
        P.unpivot_days(wide.drop("d_1", "d_2", "d_3"))


def test_equal_dates_are_ordered_by_day_number(spark, wide, values):
    calendar = spark.createDataFrame(
        [("2011-01-29", "d_1"), ("2011-01-29", "d_2"), ("2011-01-30", "d_3")], "date string, d string")
    panel = P.prepare_panel(wide, calendar).where("item_id = 'a'")
    numbered = panel.withColumn("n", F.row_number().over(P.in_order(panel)))
    assert values(numbered, "sales", "n") == [1, 0, 3]


def test_calendar_without_day_key(spark, wide):
    with pytest.raises(EmptyDataFrameError):
        P.join_calendar(P.unpivot_days(wide), spark.createDataFrame([("x",)], "date string"))


def test_calendar_weekday_rule(spark):
    span = spark.createDataFrame([(datetime.date(2011, 1, 29), datetime.date(2011, 2, 11))], "first date, last date")
    rows = {r["d"]: r for r in P.calendar(span).collect()}
    assert (rows["d_1"]["wday"], rows["d_1"]["weekday"], rows["d_1"]["wm_yr_wk"]) == (1, "Saturday", 11101)
    assert rows["d_7"]["wday"] == 7 and rows["d_8"]["wm_yr_wk"] == 11102
    assert rows["d_9"]["event_name_1"] == "SuperBowl" and rows["d_1"]["event_name_1"] is None


def test_fill_days_covers_the_whole_span(spark, values):
    day = datetime.date
    sparse = spark.createDataFrame(
        [("S", "I", day(2024, 1, 3), 5.0), ("S", "I", day(2024, 1, 6), 2.0), ("S", "J", day(2024, 1, 1), 1.0)],
        "store_id string, item_id string, date date, sales double")
    full = P.fill_days(sparse, F.lit(day(2024, 1, 1)), F.lit(day(2024, 1, 7)))
    assert values(full.where("item_id = 'I'"), "sales", "date") == [0, 0, 5, 0, 0, 2, 0]
    assert values(full.where("item_id = 'J'"), "sales", "date") == [1, 0, 0, 0, 0, 0, 0]


def test_prices_fill_forward_then_backward(make_panel, values):
    panel = make_panel({ONE: [1] * 6}).withColumn(
        "sell_price", F.when(F.col("day_no") == 3, 2.0).when(F.col("day_no") == 5, 3.0))
    assert values(P.fill_prices(panel), "sell_price", "date") == [2, 2, 2, 2, 3, 3]


def test_plain_rolling_matches_hand_values(make_panel, values):
    rolled = B.plain_rolling(make_panel({ONE: [1, 2, 3, 4, 5]}), [2, 3])
    assert values(rolled, "sales_roll_mean_2", "date")[:3] == [1.0, 1.5, 2.5]
    assert values(rolled, "sales_roll_std_2", "date")[1] == pytest.approx(0.7071, abs=1e-4)


def test_demand_features_match_pandas(make_panel):
    rng = np.random.default_rng(1)
    series = {("S", str(k)): rng.poisson(1.5, 60).tolist() for k in range(3)}
    got = B.demand_features(make_panel(series, partitions=3)).toPandas()
    for (_, item), sales in series.items():
        mine = got[got.item_id == item].sort_values("date").reset_index(drop=True)
        y = pd.Series(sales, dtype=float)
        before = y.shift(1).fillna(0.0)
        for lag in (1, 7, 28):
            np.testing.assert_allclose(mine[f"sales_lag_{lag}"], y.shift(lag).fillna(0))
        for w in (7, 14, 28):
            window = before.rolling(w, min_periods=1)
            np.testing.assert_allclose(mine[f"sales_roll_mean_{w}"], window.mean())
            np.testing.assert_allclose(mine[f"sales_roll_median_{w}"], window.median())
            np.testing.assert_allclose(mine[f"sales_roll_std_{w}"], window.std().fillna(0), atol=1e-9)
        np.testing.assert_allclose(mine["sales_expanding_std"], before.expanding().std().fillna(0), atol=1e-9)
        np.testing.assert_allclose(mine["trend_idx"], np.arange(1, 61))


def test_features_do_not_look_ahead(make_panel):
    base = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3]
    changed = base[:6] + [99] + base[7:]
    features = lambda y: B.demand_features(make_panel({ONE: y})).drop("sales").where("day_no <= 7").toPandas()
    pd.testing.assert_frame_equal(features(base).sort_values("date"), features(changed).sort_values("date"))


def test_price_features_of_first_row(make_panel, values):
    panel = make_panel({ONE: [1, 1, 1]}).withColumn("sell_price", F.col("day_no") * 2.0)
    made = B.prices(panel)
    assert values(made, "price_lag_1", "date") == [2, 2, 4]
    assert values(made, "price_pct_change", "date") == [0, 1, 0.5]
    assert values(B.prices(make_panel({ONE: [1]})), "sell_price", "date") == [1.99]


def test_promo_flag_follows_the_state(make_panel, values):
    panel = make_panel({ONE: [1, 1]}).withColumns({"snap_CA": F.lit(1), "snap_TX": F.lit(0)})
    assert values(B.temporal(panel), "is_promo", "date") == [1, 1]
    assert values(B.temporal(panel.withColumn("state_id", F.lit("NY"))), "is_promo", "date") == [0, 0]
    assert values(B.temporal(panel), "is_holiday", "date") == [0, 0]


def test_model_matrix_replaces_what_is_not_finite(make_panel):
    panel = make_panel({ONE: [1, 2, 3]}).withColumn(
        "x", F.when(F.col("day_no") == 1, float("inf")).when(F.col("day_no") == 2, float("nan")).otherwise(7.0))
    rows = B.model_matrix(panel).orderBy("date").collect()
    assert [r["x"] for r in rows] == [0.0, 0.0, 7.0]
    assert rows[0].asDict().keys() == {"store_id", "item_id", "date", "sales", "x"}


def test_supervised_windows_and_patches(make_panel, values):
    panel = make_panel({ONE: list(range(20)), ("S", "short"): [1, 2]})
    windows = B.supervised_windows(panel, 14, 3)
    assert windows.count() == 20 - 14 - 3 + 1
    first = B.patches(windows).orderBy("date").first()
    assert first["x"] == [float(v) for v in range(14)] and first["y"] == [14.0, 15.0, 16.0]
    assert first["patches"] == [[float(v) for v in range(8)], [float(v) for v in range(4, 12)]]
    short = B.patches(B.supervised_windows(panel, 5, 1)).first()["patches"]
    assert len(short) == 1 and short[0][5:] == [0.0, 0.0, 0.0]
    assert values(B.too_short(panel, 17), "item_id", "item_id") == ["short"]


def test_fourier(make_panel):
    row = B.fourier(make_panel({ONE: [1]}, first=datetime.date(2024, 7, 3))).first()
    assert row["sin_weekly"] == pytest.approx(math.sin(2 * math.pi * 2 / 7))
    assert row["cos_annual"] == pytest.approx(math.cos(2 * math.pi * 185 / 365.25))


def test_fill_days_keeps_to_its_span(spark):
    day = lambda n: datetime.date(2024, 1, n)
    rows = [("S", "I", day(1), 5.0), ("S", "I", day(3), 2.0), ("S", "I", day(6), 4.0), ("S", "late", day(9), 1.0)]
    daily = spark.createDataFrame(rows, "store_id string, item_id string, date date, sales double")
    at = lambda n: F.lit(day(n))
    got = sorted((r["item_id"], r["date"].day, r["sales"]) for r in P.fill_days(daily, at(2), at(4)).collect())
    assert got == [("I", 2, 0.0), ("I", 3, 2.0), ("I", 4, 0.0)]
    whole = P.fill_days(daily, at(1), at(7)).where("item_id = 'I'").collect()
    assert sorted((r["date"].day, r["sales"]) for r in whole) == [(1, 5.0), (2, 0.0), (3, 2.0), (4, 0.0), (5, 0.0), (6, 4.0), (7, 0.0)]
    assert P.fill_days(daily, at(7), at(2)).count() == 0
    with pytest.raises(Exception, match="several rows of one series"):
        P.fill_days(daily.union(daily), at(1), at(9)).collect()


def test_matrix_turns_null_nan_and_infinity_into_zero(spark):
    rows = [("S", "I", datetime.date(2024, 1, 1), 1, None), ("S", "I", datetime.date(2024, 1, 2), 1, float("nan")),
            ("S", "I", datetime.date(2024, 1, 3), 1, float("-inf")), ("S", "I", datetime.date(2024, 1, 4), 1, 2.5)]
    frame = spark.createDataFrame(rows, "store_id string, item_id string, date date, sales int, x double")
    assert [r["x"] for r in B.model_matrix(frame, ["x"]).orderBy("date").collect()] == [0.0, 0.0, 0.0, 2.5]
