import math
from statistics import NormalDist

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from stockloom.functions import normal
from stockloom.operators import drift as H, explain as X, hierarchy as E, intervals as I, inventory as G
from stockloom.operators.forecast import seasonal_naive
from stockloom.plans import planning
from stockloom.registry.base import stock_on_hand
from stockloom.plans.ordered import exact_quantiles, running_totals, split_points

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
ONE = ("S", "I")

BASE = {
    "Total": [45, 50], "CA": [25, 28], "TX": [12, 14], "WI": [11, 10],
    "CA_1": [13, 15], "CA_2": [11, 12], "TX_1": [13, 13], "WI_1": [10, 9],
}
TREE = {"CA_1": "CA", "CA_2": "CA", "TX_1": "TX", "WI_1": "WI"}


def level_of(node):
    return E.TOTAL if node == "Total" else E.STORE if "_" in node else E.STATE


@pytest.fixture(scope="module")
def mapping(spark):
    return spark.createDataFrame(list(TREE.items()), "store_id string, state_id string")


def base_frame(spark, forecasts):
    return spark.createDataFrame(
        [(level_of(n), n, s, float(v)) for n, path in forecasts.items() for s, v in enumerate(path, 1)],
        "level string, node string, step int, yhat double")


def table(df):
    return {(r["node"], r["step"]): r["yhat"] for r in df.collect()}


def dense_least_squares(forecasts, tree, steps):
    states = sorted(set(tree.values()))
    names = ["Total", *states, *tree]
    S = np.array([[1.0 if n == "Total" or n == tree[b] or n == b else 0.0 for b in tree] for n in names])
    y = np.array([forecasts.get(n, [0.0] * steps) for n in names], dtype=float)
    return names, np.clip(S @ np.linalg.solve(S.T @ S, S.T @ y), 0, None)


# ---- hierarchy --------------------------------------------------------------------

def test_bottom_up_and_top_down(spark, mapping):
    base = base_frame(spark, BASE)
    up = table(E.bottom_up(base, mapping))
    assert (up["CA", 1], up["Total", 1], up["CA_1", 2]) == (24, 47, 15)
    shares = spark.createDataFrame([("CA_1", .3), ("CA_2", .3), ("TX_1", .2), ("WI_1", .2)], "store_id string, share double")
    down = table(E.top_down(base, mapping, shares))
    assert down["Total", 1] == pytest.approx(45) and down["CA_1", 1] == pytest.approx(13.5) and down["CA", 1] == pytest.approx(27)
    even = table(E.top_down(base, mapping, shares.where("store_id = 'CA_1'")))
    assert even["TX", 1] == pytest.approx(45 / 4) and even["Total", 1] == pytest.approx(45 * 1.05)


def test_least_squares_golden_values(spark, mapping):
    got = table(E.least_squares(base_frame(spark, BASE), mapping))
    expected = {"Total": 46, "CA": 24, "TX": 12, "WI": 10, "CA_1": 13, "CA_2": 11, "TX_1": 12, "WI_1": 10}
    for node, value in expected.items():
        assert got[node, 1] == pytest.approx(value)


def test_missing_nodes_and_clipping(spark, mapping):
    partial = {"Total": [5.0], "CA_1": [60.0], "WI": [-20.0]}
    got = table(E.least_squares(base_frame(spark, partial), mapping))
    names, expected = dense_least_squares(partial, TREE, 1)
    for name, row in zip(names, expected):
        assert got[name, 1] == pytest.approx(row[0], abs=1e-9)
    assert table(E.bottom_up(base_frame(spark, partial), mapping))["TX_1", 1] == 0


@FEW
@given(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.data())
def test_least_squares_equals_the_dense_form(spark, states, data):
    tree = {f"s_{i}": f"T{s}" for i, s in enumerate(states)}
    nodes = ["Total", *sorted(set(tree.values())), *tree]
    forecasts = {n: [data.draw(st.floats(0, 100))] for n in nodes}
    mapping = spark.createDataFrame(list(tree.items()), "store_id string, state_id string")
    got = table(E.least_squares(base_frame(spark, forecasts), mapping))
    names, expected = dense_least_squares(forecasts, tree, 1)
    for name, row in zip(names, expected):
        assert got[name, 1] == pytest.approx(row[0], abs=1e-6)


def test_nodes_and_shares(make_panel, mapping):
    assert E.tree_nodes(mapping).count() == 8
    panel = make_panel({("CA_1", "a"): [1, 2], ("CA_1", "b"): [1, 0], ("TX_1", "a"): [4, 0]})
    shares = {r["store_id"]: r["share"] for r in E.historical_shares(panel).collect()}
    assert shares == {"CA_1": 0.5, "TX_1": 0.5}


# ---- normal, intervals -------------------------------------------------------------

def test_normal_functions(spark):
    z = spark.range(-900, 901).select((F.col("id") / 100).alias("z"))
    for r in z.select("z", normal.distribution(F.col("z")).alias("c"), normal.loss(F.col("z")).alias("l")).collect():
        exact = 0.5 * math.erfc(-r["z"] / math.sqrt(2))
        assert r["c"] == pytest.approx(exact, rel=1e-12)
    p = spark.range(1, 2000).select((F.col("id") / 2000).alias("p"))
    for r in p.select("p", normal.quantile(F.col("p")).alias("q")).collect():
        assert r["q"] == pytest.approx(NormalDist().inv_cdf(r["p"]), abs=1e-12)
    assert spark.range(1).select(normal.loss(F.lit(0.0))).first()[0] == pytest.approx(0.3989, abs=1e-4)


def test_intervals_and_fallback_sigma(make_panel):
    y = [1, 2, 3, 4, 5, 6, 7] * 3
    y[20] = 14
    panel = make_panel({ONE: y, ("S", "short"): [40, 60]})
    spread = I.residual_spread(I.seasonal_residuals(panel))
    rows = {(r["item_id"], r["step"]): r for r in I.prediction_intervals(seasonal_naive(panel, 7), spread).collect()}
    sigma = np.std([0] * 6 + [7])
    assert rows["I", 1]["sigma"] == pytest.approx(sigma)
    assert rows["I", 7]["p90"] == pytest.approx(14 + NormalDist().inv_cdf(0.9) * sigma)
    assert rows["short", 1]["sigma"] == pytest.approx(0.15 * 60)
    assert all(r["p10"] <= r["p50"] <= r["p90"] and r["p10"] >= 0 for r in rows.values())


def test_interval_scores(spark):
    rows = spark.createDataFrame(
        [("S", "I", 5.0, 2.0, 5.0, 8.0, 2.0), ("S", "I", 9.0, 2.0, 5.0, 8.0, 2.0)],
        "store_id string, item_id string, actual double, p10 double, p50 double, p90 double, sigma double")
    nd = NormalDist()
    exact = [2 * (z * (2 * nd.cdf(z) - 1) + 2 * nd.pdf(z) - 1 / math.sqrt(math.pi)) for z in (0, 2)]
    got = I.interval_scores(rows).first()
    assert (got["Coverage"], got["IntervalWidth"]) == (0.5, 6) and got["CRPS"] == pytest.approx(np.mean(exact))
    own = I.interval_scores(rows.drop("sigma")).first()  # deviation of (0, 4) is 2
    assert own["CRPS"] == pytest.approx(np.mean(exact))


# ---- inventory ---------------------------------------------------------------------

def policy(spark, mean=10.0, std=2.0, on_hand=2.0, **parameters):
    stock = spark.createDataFrame([("S", "I", mean, std, on_hand)],
                                  "store_id string, item_id string, demand_mean double, demand_std double, on_hand double")
    return G.policies(stock, **parameters).first()


def test_policy_anchor_values(spark):
    low, high = policy(spark), policy(spark, on_hand=35.0)
    assert low["safety_stock"] == pytest.approx(5.697940, abs=1e-6)
    assert low["reorder_point"] == pytest.approx(35.697940, abs=1e-6)
    assert low["order_up_to_level"] == pytest.approx(110.402968, abs=1e-6)
    assert low["newsvendor_level"] == pytest.approx(33.351247, abs=1e-6)
    assert low["expected_shortage"] == pytest.approx(28.0, abs=1e-6)
    assert high["expected_shortage"] == pytest.approx(0.115366, abs=1e-6)
    assert (low["inventory_health"], low["under_stock_alert"]) == ("Understock Alert", True)
    assert high["inventory_health"] == "Healthy" and high["stockout_cost"] < low["stockout_cost"]
    assert policy(spark, on_hand=500.0)["inventory_health"] == "Overstock Alert"
    assert policy(spark, on_hand=500.0)["order_out"] == 0 == policy(spark, on_hand=500.0)["order_s_s"]


def test_column_parameters_equal_literals(spark):
    plain = policy(spark, lead_time=4, service_level=0.9, holding_cost=0.2, stockout_cost=2.0)
    by_column = policy(spark, lead_time=F.lit(4.0), service_level=F.lit(0.9), holding_cost=F.lit(0.2), stockout_cost=F.lit(2.0))
    for name in ("safety_stock", "order_up_to_level", "newsvendor_level", "order_newsvendor", "holding_cost"):
        assert by_column[name] == pytest.approx(plain[name])


@FEW
@given(st.floats(0.1, 50), st.floats(0.1, 20), st.floats(0, 300))
def test_orders_are_never_negative(spark, mean, std, on_hand):
    row = policy(spark, mean, std, on_hand)
    assert min(row["order_out"], row["order_s_s"], row["order_newsvendor"], row["expected_shortage"]) >= -1e-9


def test_simple_order(spark):
    rows = spark.createDataFrame([(15.0, 5.0, 10.0), (5.0, 15.0, 5.0)], "demand_sum double, on_hand double, buffer double")
    got = [(r["recommended_order"], r["under_stock_alert"]) for r in G.simple_order(rows).orderBy("on_hand").collect()]
    assert got == [(20.0, True), (0.0, False)]


def test_sparse_moments_equal_dense(make_panel):
    panel = make_panel({ONE: [0, 3, 0, 0, 5, 1, 0]})
    dense = G.demand_stats(panel).first()
    sparse = G.sparse_demand_stats(panel.where("sales > 0"), F.lit(7), ["store_id", "item_id"]).first()
    assert sparse["demand_mean"] == pytest.approx(dense["demand_mean"])
    assert sparse["demand_std"] == pytest.approx(dense["demand_std"])
    idle = G.demand_stats(make_panel({ONE: [0, 0]})).first()
    assert (idle["demand_mean"], idle["demand_std"]) == (0.1, 0.1)


def test_health_matrices(spark):
    rows = spark.createDataFrame(
        [("A", "x", "Healthy"), ("A", "x", "Understock Alert"), ("A", "y", "Overstock Alert"), ("B", "y", "Healthy")],
        "store_id string, kind string, inventory_health string")
    counts = {(r["store_id"], r["kind"]): r["series"] for r in G.health_matrix(rows, "store_id", "kind").collect()}
    assert counts == {("A", "x"): 1, ("A", "y"): 0, ("B", "y"): 0}
    worst = {(r["store_id"], r["kind"]): r["status"] for r in G.worst_status_matrix(rows, "store_id", "kind").collect()}
    assert worst == {("A", "x"): "Understock Alert", ("A", "y"): "Overstock Alert", ("B", "y"): "Healthy"}


def test_planning_flow(make_panel):
    """Panel, seasonal forecast over 14 days, stock 10 and buffer 15."""
    rng = np.random.default_rng(2)
    series = {(s, str(i)): rng.poisson(1.5, 30).tolist() for s in ("CA_1", "TX_1") for i in range(3)}
    panel = make_panel(series)
    demand = seasonal_naive(panel, 14).groupBy("store_id", "item_id").agg(F.sum("yhat").alias("demand_sum"))
    rows = G.simple_order(demand.withColumns({"on_hand": F.lit(10.0), "buffer": F.lit(15.0)})).collect()
    for r in rows:
        last = series[r["store_id"], r["item_id"]][-7:]
        assert r["recommended_order"] == max(0, 2 * sum(last) - 10 + 15) and r["under_stock_alert"]
    plan = planning.planning_table(panel, stock_on_hand(panel)).collect()
    assert len(plan) == 6 and all(r["p10_sum"] <= r["forecast_sum"] <= r["p90_sum"] for r in plan)


# ---- drift -------------------------------------------------------------------------

def sides(spark, pairs):
    rows = [(k, float(v), new) for k, (old, fresh) in pairs.items() for vs, new in ((old, False), (fresh, True)) for v in vs]
    return spark.createDataFrame(rows, "key string, value double, is_new boolean")


def brute_psi(old, new, bins=10):
    """Counts of sorted values between neighbouring quantiles; the last bin holds its upper edge."""
    ranked, cuts = sorted(old), []
    for i in range(bins + 1):
        at = (len(ranked) - 1) * i / bins
        low = ranked[int(at)]
        cut = low + (ranked[min(int(at) + 1, len(ranked) - 1)] - low) * (at - int(at))
        if not cuts or cut > cuts[-1]:
            cuts.append(cut)
    total, pairs = 0.0, list(zip(cuts, cuts[1:]))
    for low, high in pairs:
        inside = lambda v: low <= v < high or (v == high == cuts[-1])
        a, b = ((sum(map(inside, x)) + 1e-4) / (len(x) + 1e-4 * len(pairs)) for x in (old, new))
        total += (b - a) * math.log(b / a)
    return total


def brute_ks(old, new):
    at = np.unique([*old, *new])
    return max(abs((np.asarray(old) <= v).mean() - (np.asarray(new) <= v).mean()) for v in at)


@FEW
@given(st.lists(st.integers(0, 12), min_size=1, max_size=60), st.lists(st.integers(-3, 20), min_size=1, max_size=30))
def test_drift_matches_brute_force(spark, old, new):
    frame = sides(spark, {"a": (old, new), "flat": ([3] * 5, new)})
    for small in (True, False):
        compared = H.compared(frame, ["key"], small_keys=small)
        psi = {r["key"]: r["psi"] for r in H.psi(compared, ["key"]).collect()}
        ks = {r["key"]: r["ks_statistic"] for r in H.ks_statistic(compared, ["key"]).collect()}
        assert psi["a"] == pytest.approx(brute_psi(old, new), abs=1e-9) and psi["flat"] == 0
        assert ks["a"] == pytest.approx(brute_ks(old, new)) and 0 <= ks["a"] <= 1


def test_exact_p_value_by_enumeration():
    from itertools import combinations
    for m, n in ((3, 4), (5, 2), (4, 4), (1, 6)):
        observed = sorted({brute_ks(c, [v for v in range(m + n) if v not in c]) for c in combinations(range(m + n), m)})
        every = [brute_ks(c, [v for v in range(m + n) if v not in c]) for c in combinations(range(m + n), m)]
        expected = [np.mean([e >= d - 1e-12 for e in every]) for d in observed]
        np.testing.assert_allclose(H.path_probability(m, n, np.array(observed)), expected, atol=1e-12)


def test_drift_verdict(spark):
    report = {r["key"]: r for r in H.drift_report(sides(spark, {
        "same": (list(range(100)), list(range(0, 100, 5))), "moved": (list(range(100)), [200] * 20)}), ["key"]).collect()}
    assert not report["same"]["drift_detected"] and report["same"]["status_message"] == "Data stable"
    assert report["moved"]["ks_drift"] and report["moved"]["drift_detected"]


def test_drift_without_incoming_rows(make_panel):
    frame = H.split_newest(make_panel({ONE: range(30), ("S", "tiny"): range(6)}), ["store_id", "item_id"], "sales")
    for method in ("exact", "asymptotic"):
        tiny = H.drift_report(frame, ["store_id", "item_id"], method=method).where("item_id = 'tiny'").first()
        assert tiny["ks_statistic"] is None and tiny["ks_p_value"] is None and not tiny["drift_detected"]


def test_split_keeps_ten_rows_for_the_baseline(make_panel):
    counts = {r["item_id"]: (r["o"], r["n"]) for r in H.split_newest(
        make_panel({ONE: range(30), ("S", "mid"): range(14), ("S", "tiny"): range(6)}), ["store_id", "item_id"], "sales",
    ).groupBy("item_id").agg(F.count_if(~F.col("is_new")).alias("o"), F.count_if("is_new").alias("n")).collect()}
    assert counts == {"I": (20, 10), "mid": (10, 4), "tiny": (6, 0)}


def test_running_totals_with_a_hot_key_and_a_hot_value(spark):
    """One key holds most rows and one value a third of them; ranges change nothing."""
    rng = np.random.default_rng(9)
    hot = np.concatenate([rng.normal(0, 1, 400).round(2), np.full(200, 0.5)])
    rows = [("hot", float(v)) for v in hot] + [("cold", 1.0), ("cold", 2.0)]
    df = spark.createDataFrame(rows, "key string, value double")
    counts = df.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    plain = running_totals(counts, ["key"], "value", ["n"])
    ranged = running_totals(counts, ["key"], "value", ["n"], split_points(df, "value", 16))
    assert sorted(map(tuple, plain.select("key", "value", "n", "n_before").collect())) == \
        sorted(map(tuple, ranged.select("key", "value", "n", "n_before").collect()))
    got = exact_quantiles(df, ["value"], [0.0, 0.1, 0.5, 0.9, 1.0]).first()
    np.testing.assert_allclose([got[f"q{i}"] for i in range(5)],
                               np.quantile([v for _, v in rows], [0, 0.1, 0.5, 0.9, 1]))


# ---- explain -----------------------------------------------------------------------

def test_linear_contributions(spark):
    x = np.random.default_rng(4).normal(size=(50, 2))
    rows = [(float(a), float(b), float(3 * a - b + 2)) for a, b in x]
    matrix = spark.createDataFrame(rows, "a double, b double, sales double")
    weights = X.linear_weights(matrix, ["a", "b"])
    assert weights == pytest.approx({"a": 3.0, "b": -1.0}, abs=1e-6)
    got = {r["feature"]: r["mean_contribution"] for r in X.mean_contributions(matrix, weights).collect()}
    assert got["a"] == pytest.approx(np.abs(3 * (x[:, 0] - x[:, 0].mean())).mean())
    assert [r["feature"] for r in X.top_features(X.mean_contributions(matrix, weights), "mean_contribution", 1).collect()] == ["a"]


def test_one_pass_summary_equals_the_single_operators(make_panel):
    rng = np.random.default_rng(6)
    panel = make_panel({("S", str(k)): rng.poisson(3, 9 + 13 * k).tolist() for k in range(3)})
    plan = {r["item_id"]: r for r in planning.planning_table(panel, stock_on_hand(panel)).collect()}
    spread = I.residual_spread(I.seasonal_residuals(panel))
    bands = I.prediction_intervals(seasonal_naive(panel, 14), spread).groupBy("item_id").agg(
        F.sum("p10"), F.sum("p50"), F.sum("p90"), F.first("sigma"))
    stats = {r["item_id"]: r for r in G.demand_stats(panel).collect()}
    for item, p10, p50, p90, sigma in bands.collect():
        row = plan[item]
        assert [row["p10_sum"], row["forecast_sum"], row["p90_sum"], row["sigma"]] == pytest.approx([p10, p50, p90, sigma])
        assert row["demand_mean"] == pytest.approx(stats[item]["demand_mean"])
        assert row["demand_std"] == pytest.approx(stats[item]["demand_std"])


def test_quantiles_take_nan_as_missing(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, float("nan"), 3.0, None, 2.0)], "value double")
    got = exact_quantiles(df, ["value"], [0.0, 0.5, 1.0]).first()
    assert [got["q0"], got["q1"], got["q2"]] == [1.0, 2.0, 3.0]


def test_exact_p_value_of_larger_samples_is_near_the_limit(spark):
    stats = spark.createDataFrame([(0.1, 400, 300), (0.2, 400, 300), (0.02, 400, 300), (None, 10, 0)],
                                  "ks_statistic double, old_rows long, new_rows long")
    exact, limit = ([r[0] for r in H.with_p_value(stats, [], m).select("ks_p_value").collect()] for m in ("exact", "asymptotic"))
    np.testing.assert_allclose(exact[:3], limit[:3], atol=0.03)
    assert exact[3] is None and limit[3] is None
    with pytest.raises(ValueError):
        H.with_p_value(stats, [], "auto")
