import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockloom.operators import additive, arima, backtest as D, features as B, forecast as C, smoothing, trees
from stockloom.operators.series_fit import as_forecast
from stockloom.plans.forecasting import backtest, forecast

ONE = ("S", "I")


def path(df):
    return [r["yhat"] for r in df.orderBy("step").collect()]


def test_baselines_match_hand_values(make_panel):
    assert path(C.naive(make_panel({ONE: [1, 2, 3, 5]}), 3)) == [5, 5, 5]
    assert path(C.seasonal_naive(make_panel({ONE: range(1, 10)}), 5)) == [3, 4, 5, 6, 7]
    assert path(C.seasonal_naive(make_panel({ONE: range(1, 10)}), 9))[7:] == [3, 4]
    assert path(C.seasonal_naive(make_panel({ONE: [4, 6]}), 2)) == [6, 6]
    assert path(C.moving_average(make_panel({ONE: [1, 2, 3, 4, 5]}), 4, 3)) == [4, 4, 4, 4]
    assert path(C.moving_average(make_panel({ONE: [2, 4]}), 1)) == [3]


def test_horizon_is_checked(make_panel):
    with pytest.raises(ValueError):
        C.naive(make_panel({ONE: [1]}), 0)


def test_fit_length_cuts_and_repeats(make_panel):
    made = C.seasonal_naive(make_panel({ONE: range(1, 10)}), 5)
    assert path(C.fit_length(made, 3)) == [3, 4, 5]
    assert path(C.fit_length(made, 7)) == [3, 4, 5, 6, 7, 7, 7]


def test_fallback_fills_missing_and_nan(make_panel):
    panel = make_panel({ONE: [1, 2, 9], ("S", "J"): [5, 5, 5]})
    fitted = C.naive(panel, 2).where("item_id = 'I'").withColumn(
        "yhat", F.when(F.col("step") == 1, float("nan")).otherwise(4.0))
    rows = {(r["item_id"], r["step"]): (r["yhat"], r["fallback_reason"]) for r in
            C.with_fallback(fitted, C.naive(panel, 2)).collect()}
    assert rows[("I", 1)] == (9.0, "forecast is not a number")
    assert rows[("I", 2)] == (4.0, None)
    assert rows[("J", 1)] == (5.0, "no forecast")


def test_future_rows_prefer_the_calendar(spark, make_panel):
    import datetime
    panel = make_panel({ONE: [1, 2]}).withColumns({"wm_yr_wk": F.lit(7), "snap_CA": F.lit(1)})
    plain = C.future_rows(panel, 2).orderBy("step").collect()
    assert [r["date"].day for r in plain] == [3, 4] and plain[0]["wm_yr_wk"] == 7
    calendar = spark.createDataFrame(
        [(datetime.date(2024, 1, 3), 8, 0, "Feast", None, None, None)],
        "date date, wm_yr_wk int, snap_CA int, event_name_1 string, event_type_1 string, event_name_2 string, event_type_2 string")
    known = C.future_rows(panel, 2, calendar).orderBy("step").collect()
    assert (known[0]["wm_yr_wk"], known[0]["snap_CA"], known[0]["event_name_1"]) == (8, 0, "Feast")
    assert (known[1]["wm_yr_wk"], known[1]["snap_CA"]) == (7, 1)


def brute_ets(y, period, grid):
    best = None
    for a, b, g in grid:
        warm = period or 1
        level, trend, sse = float(np.mean(y[:warm])), 0.0, 0.0
        season = {i: y[i] - level for i in range(warm)} if period else {0: 0.0}
        for t in range(warm, len(y)):
            e = y[t] - level - trend - season[t % warm]
            level, trend, sse = level + trend + a * e, trend + a * b * e, sse + e * e
            if period:
                season[t % warm] += g * (1 - a) * e
        if best is None or sse < best[0]:
            best = (sse, [level + (h + 1) * trend + season[(len(y) + h) % warm] for h in range(5)])
    return best


@pytest.mark.parametrize("period", [None, 7])
def test_ets_matches_a_plain_loop(make_panel, period):
    rng = np.random.default_rng(3)
    series = {("S", str(k)): (rng.poisson(4, 40 + k) + 3.0 * (np.arange(40 + k) % 7 == 5)).tolist() for k in range(3)}
    got = {r["item_id"]: r for r in smoothing.ets(make_panel(series), 5, period).collect()}
    grid = list(itertools.product(smoothing.LEVEL_GRID, smoothing.TREND_GRID, smoothing.SEASON_GRID if period else [0.0]))
    for (_, item), y in series.items():
        sse, forecast = brute_ets(y, period, grid)
        assert got[item]["sse"] == pytest.approx(sse)
        np.testing.assert_allclose(got[item]["path"], forecast)


def test_arima_matches_a_plain_loop(make_panel):
    y = np.array([3, 5, 4, 8, 6, 9, 7, 12, 10, 11, 15, 13], dtype=float)
    w = np.diff(y)
    best = None
    for phi, theta in itertools.product(arima.COEFFICIENTS, repeat=2):
        e, sse = 0.0, 0.0
        for t in range(1, len(w)):
            e = w[t] - phi * w[t - 1] - theta * e
            sse += e * e
        if best is None or sse < best[0]:
            first = phi * w[-1] + theta * e
            best = (sse, y[-1] + np.cumsum([first * phi**k for k in range(4)]))
    row = arima.arima(make_panel({ONE: y.tolist()}), 4).first()
    assert row["sse"] == pytest.approx(best[0])
    np.testing.assert_allclose(row["path"], best[1])


def test_arima_of_one_day_has_no_number(make_panel):
    assert all(v is None or np.isnan(v) for v in arima.arima(make_panel({ONE: [4.0]}), 3).first()["path"])


@pytest.mark.parametrize("order", [(2, 1, 0), (2, 0, 1), (3, 1, 2), (1, 0, 1), (0, 2, 1)])
def test_arima_other_orders_are_finite(make_panel, order):
    y = 20 + 5 * np.sin(np.arange(80)) + np.arange(80) * 0.1
    made = arima.arima(make_panel({ONE: y.tolist()}), 6, order).first()["path"]
    assert len(made) == 6 and np.isfinite(made).all()
    if order[1] < 2:
        assert abs(np.mean(made) - 28) < 15
    else:  # two differences and no autoregression continue a straight line
        np.testing.assert_allclose(np.diff(made, 2), 0, atol=1e-9)


def test_higher_order_recovers_an_autoregression_of_changes(make_panel):
    changes = [10.0, 4.0]
    for _ in range(40):
        changes.append(0.5 * changes[-1] - 0.3 * changes[-2])
    got = arima.arima(make_panel({ONE: np.cumsum(changes).tolist()}), 2, (2, 1, 0)).first()
    assert got["phi_1"] == pytest.approx(0.5, abs=1e-6) and got["phi_2"] == pytest.approx(-0.3, abs=1e-6)


def test_prefix_walk_equals_separate_fits(make_panel):
    rng = np.random.default_rng(5)
    y = rng.poisson(5, 50).astype(float).tolist()
    for fit in (smoothing.ets, arima.arima, additive.additive_regression):
        rows = {r["origin"]: r["path"] for r in fit(make_panel({ONE: y}), 5, backtest=(20, 12)).collect()}
        assert sorted(rows) == [20, 32, 44]
        for origin, made in rows.items():
            np.testing.assert_allclose(made, fit(make_panel({ONE: y[:origin]}), 5).first()["path"], rtol=1e-9)


def test_additive_regression_finds_trend_and_week(make_panel):
    days = np.arange(140)
    y = 5 + 0.2 * days + 3.0 * (days % 7 == 2)
    made = additive.additive_regression(make_panel({ONE: y.tolist()}), 14, yearly=0, ridge=1e-9).first()["path"]
    coming = np.arange(140, 154)
    np.testing.assert_allclose(made, 5 + 0.2 * coming + 3.0 * (coming % 7 == 2), atol=1e-3)


def test_short_histories_give_full_finite_forecasts(make_panel):
    panel = make_panel({ONE: [10, 12, 11, 15, 14, 16, 18, 20, 19, 22]})
    for made in (arima.arima(panel, 7), smoothing.ets(panel, 7), additive.additive_regression(panel, 7)):
        values = path(as_forecast(made))
        assert len(values) == 7 and np.isfinite(values).all()


# ---- trees ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def tree_panel(make_panel):
    rng = np.random.default_rng(7)
    series = {("S", str(k)): (rng.poisson(3, 70) + 4 * (np.arange(70) % 7 == 6)).tolist() for k in range(4)}
    series[("S", "young")] = [2.0] * 10
    return make_panel(series).withColumns({
        "wm_yr_wk": F.lit(3), "snap_CA": F.lit(1),
        "wday": (F.pmod(F.weekday("date") + 2, F.lit(7)) + 1).cast("int")})


def test_state_features_equal_panel_features(tree_panel):
    """The next-day features of a state are what the feature operators give for that day, also at a past origin."""
    columns = trees.training_columns(tree_panel)
    known = trees.known_columns(columns)

    def features(states):
        rows = states.sort_values(["item_id"]).reset_index(drop=True)
        tail = np.array([np.pad(np.asarray(t, float), (trees.LONGEST - len(t), 0)) for t in rows["tail"]])
        made = trees.day_features(tail, rows["tail"].map(len).to_numpy(), *(rows[c].to_numpy(float) for c in ("total", "squares", "days")))
        for i, c in enumerate(known):
            made[c] = np.array([row[0][i] for row in rows["known"]])
        return pd.DataFrame(made, index=rows["item_id"])[columns].astype(float)

    built = B.demand_features(tree_panel)
    last_day = F.when(F.col("item_id") == "young", 10).otherwise(70)
    state = features(trees.series_state(tree_panel.where(F.col("day_no") < last_day), 3).toPandas())
    expected = built.where(F.col("day_no") == last_day).select("item_id", *columns).toPandas().set_index("item_id").sort_index()
    np.testing.assert_allclose(state.to_numpy(), expected.astype(float).to_numpy(), atol=1e-9)
    for origin in (5, 28, 40):
        state = features(trees.origin_states(tree_panel, [origin], 3).toPandas())
        expected = built.where(F.col("day_no") == origin + 1).select("item_id", *columns).toPandas().set_index("item_id").loc[state.index]
        np.testing.assert_allclose(state.to_numpy(), expected.astype(float).to_numpy(), atol=1e-9)


def test_recursive_and_direct_forecasts(tree_panel):
    model = trees.fit_recursive(tree_panel, 3, 3)
    made = trees.predict_recursive(model, tree_panel, 9)
    assert made.count() == 5 * 9 and made.where("yhat < 0 or yhat is null").count() == 0
    again = trees.predict_recursive(trees.fit_recursive(tree_panel, 3, 3), tree_panel, 9)
    assert made.orderBy("item_id", "step").collect() == again.orderBy("item_id", "step").collect()
    direct = trees.predict_direct(trees.fit_direct(tree_panel, 3, 3, 3), tree_panel, 3)
    assert direct.count() == 5 * 3 and direct.where("yhat < 0 or yhat is null").count() == 0
    ranking = trees.importances(model, tree_panel).collect()
    assert ranking[0]["importance"] >= ranking[-1]["importance"]
    assert trees.importances(None, tree_panel).isEmpty()


def test_direct_without_models_is_naive(make_panel):
    assert path(trees.predict_direct({}, make_panel({ONE: [1, 7]}), 2)) == [7, 7]


@pytest.mark.parametrize("direct", [False, True])
def test_tree_backtest_refits_per_origin(tree_panel, direct):
    known = tree_panel.where("item_id <> 'young'")
    made = trees.tree_backtest(known, [2, 40, 60], 3, 2, 2, direct=direct)
    scored = D.compare(D.attach_actuals(made, tree_panel), ["model"]).first()
    assert made.count() == 4 * 3 * 3 and scored["WAPE"] > 0
    if not direct:   # as a model of its own on the days up to the origin, with cuts of the whole table
        assert made.where("origin = 60 and step = 1").count() == 4
    rows = backtest(known, ["trees_direct" if direct else "trees_recursive"], 40, 20, 3, trees_parameters={"rounds": 2, "depth": 2})
    assert rows.count() == 4 * 2 * 3 and rows.where("fallback").count() == 0


def test_registered_tree_queries_do_the_operators_whole_job(spark, monkeypatch):
    """Default rounds and step; the walk-forward covers every origin of the other fitted models."""
    from stockloom.registry import decisions, forecasts  # noqa: F401
    from stockloom.registry.base import QUERIES

    class Asked(Exception):
        pass

    def ask(*given, **named):
        raise Asked(given, named)

    data = "/root/testdata/sf0.001"
    with monkeypatch.context() as m:
        m.setattr(trees, "tree_backtest", ask)
        with pytest.raises(Asked) as asked:
            QUERIES["d10_walk_forward_trees"](spark, data)
    (panel, origins, horizon), named = asked.value.args
    days = panel.groupBy("store_id", "item_id").count().agg(F.max("count")).first()[0]
    assert origins == list(range(15, days - 14 + 1, 5)) and len(origins) > 100 and horizon == 14 and not named
    monkeypatch.setattr(trees.boosting, "fit", ask)
    for name in ("c07_trees_recursive", "c08_trees_direct", "i01_feature_importance", "i02_tree_contributions"):
        with pytest.raises(Asked) as asked:
            QUERIES[name](spark, data)
        (_, _, _, _, position, rounds, depth, step_size), _ = asked.value.args
        assert (position, rounds, depth, step_size) == (None, 100, 5, 0.05)


def test_tree_walk_forward_stores_its_series(spark, monkeypatch):
    """Origins and actuals come from the stored series, not from the line items again."""
    from stockloom.registry import forecasts
    from stockloom.registry.base import QUERIES

    seen = []
    monkeypatch.setattr(trees, "origins", lambda df, *_: [20] if not seen.append(df) else [])
    monkeypatch.setattr(trees, "tree_backtest", lambda panel, *_: seen.append(panel) or panel.limit(0).selectExpr(
        "store_id", "item_id", "20 as origin", "1 as step", "'m' as model", "0d as yhat"))
    monkeypatch.setattr(forecasts.D, "attach_actuals", lambda made, df: seen.append(df) or made.withColumn("actual", F.lit(0.0)))
    QUERIES["d10_walk_forward_trees"](spark, "/root/testdata/sf0.001")
    assert len(seen) == 3 and not any("lineitem" in path for df in (seen[0], seen[2]) for path in df.inputFiles())



# ---- backtest ---------------------------------------------------------------------

def loop_backtest(y, initial, step, horizon):
    pooled = {m: ([], []) for m in D.BASELINES}
    for o in range(initial, len(y) - horizon + 1, step):
        train = y[:o]
        made = {"naive": [train[-1]] * horizon,
                "seasonal_naive": [train[o - 7 + h % 7] if o >= 7 else train[-1] for h in range(horizon)],
                "moving_average": [float(np.mean(train[-7:]))] * horizon}
        for m in D.BASELINES:
            pooled[m][0].extend(y[o:o + horizon])
            pooled[m][1].extend(made[m])
    return {m: (np.array(a, float), np.array(f, float)) for m, (a, f) in pooled.items()}


@pytest.mark.parametrize("initial,step,horizon", [(15, 5, 14), (5, 3, 2)])
def test_walk_forward_matches_a_plain_loop(make_panel, initial, step, horizon):
    rng = np.random.default_rng(11)
    series = {("S", str(k)): rng.poisson(6 + 4 * k, 45).tolist() for k in range(3)}
    table = D.comparison_table(D.walk_forward(make_panel(series, partitions=3), initial, step, horizon)).collect()
    assert len(table) == 9
    for row in table:
        y, f = loop_backtest(series[("S", row["item_id"])], initial, step, horizon)[row["model"]]
        assert row["MAE"] == pytest.approx(np.abs(y - f).mean())
        assert row["RMSE"] == pytest.approx(np.sqrt(((y - f) ** 2).mean()))
        assert row["WAPE"] == pytest.approx(np.abs(y - f).sum() / y.sum())
        assert row["MAPE"] == pytest.approx((np.abs(y - f) / np.clip(y, 1e-5, None)).mean())
        assert row["SMAPE"] == pytest.approx((np.abs(y - f) / np.clip((abs(y) + abs(f)) / 2, 1e-5, None)).mean() * 100)
        assert row["Bias"] == pytest.approx((f - y).mean())
        assert 0 <= row["Accuracy"] <= 1


def test_no_demand_scores_zero_wape(make_panel):
    row = D.compare(D.walk_forward(make_panel({ONE: [0] * 30}))).where("model = 'naive'").first()
    assert (row["WAPE"], row["Accuracy"], row["MAPE"]) == (0.0, 1.0, 0.0)


def test_origins_and_short_series(make_panel, values):
    panel = make_panel({ONE: [1] * 30, ("S", "short"): [1] * 20})
    assert values(D.origins(panel), "origin", "origin") == [14, 21]
    assert values(D.too_short_for_backtest(panel, 14, 7), "item_id", "item_id") == ["short"]


def test_first_model_wins_a_tie(spark):
    table = spark.createDataFrame(
        [("S", "I", "b", 0.2), ("S", "I", "a", 0.2), ("S", "I", "c", 0.3)],
        "store_id string, item_id string, model string, WAPE double")
    assert D.best_model(table, ["b", "a", "c"]).first()["best_model"] == "b"
    assert D.best_model(table, ["c", "a", "b"]).first()["best_model"] == "a"


def test_models_by_name_share_one_shape(make_panel):
    from stockloom.plans.forecasting import MODELS, backtest, forecast
    panel = make_panel({ONE: [float(5 + d % 7) for d in range(40)], ("S", "new"): [3.0]})
    for model in [m for m in MODELS if not m.startswith("trees")]:
        rows = forecast(panel, model, 4).collect()
        assert len(rows) == 8 and all(np.isfinite(r["yhat"]) for r in rows), model
    seasonal = forecast(panel, "ets", 4, period=7).where("item_id = 'new'").first()
    assert seasonal["yhat"] == 3.0 and seasonal["fallback_reason"] == "forecast is not a number"
    with pytest.raises(ValueError):
        forecast(panel, "oracle", 4)


def test_arima_of_very_short_series_falls_back(make_panel):
    panel = make_panel({("S", "one"): [4], ("S", "two"): [1, 9], ("S", "three"): [1, 9, 2], ("S", "long"): [3, 4, 5, 4, 3, 5, 4, 3]})
    made = {(r["item_id"], r["step"]): r for r in forecast(panel, "arima", 2).collect()}
    for item, last in (("one", 4), ("two", 9), ("three", 2)):
        assert [made[item, k]["yhat"] for k in (1, 2)] == [last, last]
        assert made[item, 1]["fallback_reason"] == "forecast is not a number"
    assert made["long", 1]["fallback_reason"] is None


def test_backtest_of_named_models_replaces_what_fails_by_naive(make_panel):
    rng = np.random.default_rng(2)
    panel = make_panel({("S", "a"): rng.poisson(5, 40).tolist(), ("S", "b"): rng.poisson(9, 26).tolist()})
    models = ["seasonal_naive", "arima", "ets", "additive"]
    rows = backtest(panel, models, 3, 5, 4).collect()
    origins = {"a": range(3, 37, 5), "b": range(3, 23, 5)}
    assert {(r["item_id"], r["origin"], r["step"], r["model"]) for r in rows} == {
        (i, o, k, m) for i, at in origins.items() for o in at for k in range(1, 5) for m in models}
    assert len(rows) == len({(r["item_id"], r["origin"], r["step"], r["model"]) for r in rows})
    early = [r for r in rows if r["model"] == "arima" and r["origin"] == 3]
    assert all(r["fallback"] for r in early) and not any(r["fallback"] for r in rows if r["model"] == "seasonal_naive")
    with pytest.raises(ValueError):
        backtest(panel, ["nonsense"])
