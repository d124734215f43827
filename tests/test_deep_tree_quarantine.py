"""Trees of any depth against dense least squares, quarantined rows, and checks from one pass."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.errors import DataValidationError
from stockloom.operators import deep_tree, hierarchy, validation
from stockloom.sources import quarantine
from stockloom.sources.retail import RetailTables


def random_tree(rng, depth):
    """Uneven tree: node -> parent, leaves at different depths, the deepest at ``depth``."""
    parents, level = {"r": None}, ["r"]
    for d in range(1, depth + 1):
        below = []
        for i, node in enumerate(level):
            for k in range(int(rng.integers(1, 4)) if i == 0 or rng.random() < 0.7 else 0):
                parents[f"{node}.{k}"] = node
                below.append(f"{node}.{k}")
        level = below
    return parents


@pytest.mark.parametrize("depth", [1, 2, 3, 5])
def test_two_sweeps_are_dense_least_squares(spark, depth):
    rng = np.random.default_rng(depth)
    parents = random_tree(rng, depth)
    nodes, inner = list(parents), set(parents.values())
    leaves = [n for n in nodes if n not in inner]
    summing = np.array([[float(leaf == n or leaf.startswith(n + ".")) for leaf in leaves] for n in nodes])
    values = {(n, s): float(rng.normal(10, 5)) for n in nodes for s in (1, 2) if rng.random() < 0.9}
    base = spark.createDataFrame([(n, s, v) for (n, s), v in values.items()] + [("elsewhere", 1, 5.0)], "node string, step int, yhat double")
    made = deep_tree.reconcile(base, spark.createDataFrame(list(parents.items()), "node string, parent string"), floor=None)
    found = {(r["node"], r["step"]): r["yhat"] for r in made.collect()}
    for step in (1, 2):
        given = np.array([values.get((n, step), 0.0) for n in nodes])
        wanted = summing @ np.linalg.lstsq(summing, given, rcond=None)[0]
        np.testing.assert_allclose([found[n, step] for n in nodes], wanted, atol=1e-8)
    assert len(found) == 2 * len(nodes)


def test_three_levels_equal_the_closed_form_and_forests_are_trees_apart(spark):
    mapping = spark.createDataFrame([("A1", "A"), ("A2", "A"), ("B1", "B")], "store_id string, state_id string")
    rows = [("total", "Total", 30.0), ("state", "A", 18.0), ("state", "B", 9.0), ("store", "A1", 11.0), ("store", "A2", 6.0), ("store", "B1", 8.0)]
    base = spark.createDataFrame([(level, n, 1, v) for level, n, v in rows], "level string, node string, step int, yhat double")
    closed = {r["node"]: r["yhat"] for r in hierarchy.least_squares(base, mapping).collect()}
    parents = hierarchy.tree_nodes(mapping).select("node", "parent")
    swept = {r["node"]: r["yhat"] for r in deep_tree.reconcile(base.drop("level"), parents).collect()}
    assert swept == pytest.approx(closed)
    forest = spark.createDataFrame([("a", None), ("b", None), ("b1", "b")], "node string, parent string")
    alone = deep_tree.reconcile(spark.createDataFrame([("a", 1, -3.0), ("b", 1, 4.0), ("b1", 1, 6.0)], "node string, step int, yhat double"), forest)
    assert {r["node"]: r["yhat"] for r in alone.collect()} == {"a": 0.0, "b": 5.0, "b1": 5.0}


def test_broken_parent_tables_are_errors(spark):
    base = spark.createDataFrame([("a", 1, 1.0)], "node string, step int, yhat double")
    for rows in ([("a", "b"), ("b", "a")], [("a", None), ("a", "b"), ("b", None)], [("a", None), ("c", "unknown")]):
        with pytest.raises(DataValidationError):
            deep_tree.reconcile(base, spark.createDataFrame(rows, "node string, parent string"))
    assert deep_tree.reconcile(base, spark.createDataFrame([], "node string, parent string")).count() == 0


def test_path_parents_nest_columns(spark):
    rows = spark.createDataFrame([("CA", "CA_1", "x"), ("CA", "CA_1", "y"), ("TX", "TX_1", "x")], "state string, store string, item string")
    found = {r["node"]: r["parent"] for r in deep_tree.path_parents(rows, ["state", "store", "item"]).collect()}
    assert found["Total"] is None and found["Total/CA/CA_1/y"] == "Total/CA/CA_1" and len(found) == 8


def test_bad_rows_are_set_apart_with_reasons(spark, tmp_path):
    path = tmp_path / "sell_prices.csv"
    path.write_text("store_id,item_id,wm_yr_wk,sell_price\n" + "\n".join([
        "S,I,1,2.5", "S,I,2,abc", "S,I,3", "S,I,4,-1", "S,,5,3.0", "S,I,1,2.5", "S,I,1,9.9", "S,I,x,1,extra", "S,I,7,0", "S,I,8,4.0"]) + "\n")
    clean, rejects = quarantine.read_judged(spark, str(path), quarantine.PRICE_RULES)
    assert sorted((r["wm_yr_wk"], r["sell_price"]) for r in clean.collect()) == [(1, 2.5), (8, 4.0)]
    assert clean.columns == ["store_id", "item_id", "wm_yr_wk", "sell_price"]
    reasons = sorted((r["line"], tuple(r["reasons"])) for r in rejects.collect())
    assert len(reasons) == 8
    by_line = dict(reasons)
    assert by_line["S,I,2,abc"] == ("unreadable line",) and by_line["S,I,3"] == ("unreadable line",) and by_line["S,I,x,1,extra"] == ("unreadable line",)
    assert all(r["file"].endswith("sell_prices.csv") for r in rejects.collect())
    counts = {r["reason"]: r["rows"] for r in quarantine.reject_counts(rejects).collect()}
    assert counts == {"unreadable line": 3, "price not above 0": 2, "no item_id": 1, "repeated key": 2}


def test_checks_of_a_table_come_from_one_scan(spark, tmp_path):
    spark.createDataFrame([("S", "I", 1, 2.0), ("S", "I", 1, 2.0), ("S", None, 2, -1.0), ("S", "J", None, None)],
                          "store_id string, item_id string, wm_yr_wk int, sell_price double").write.parquet(str(tmp_path / "p"))
    prices = spark.read.parquet(str(tmp_path / "p"))
    calendar = spark.createDataFrame([(1,)], "d int")
    sales = spark.createDataFrame([("S", 1, -2), ("S", 3, 4)], "store_id string, d_1 int, d_2 int")
    checks = validation.findings(RetailTables(calendar, prices, sales))
    found = {(r["dataset"], r["check"]): (r["value"], r["passed"]) for r in checks.collect()}
    assert found["sell_prices", "rows"] == (4, None) and found["sell_prices", "null_cells"] == (3, None)
    assert found["sell_prices", "duplicates"] == (1, None) and found["sell_prices", "invalid_prices"] == (1, False)
    assert found["sales", "negative_sales"] == (1, False) and found["calendar", "missing_columns"][1] is False
    assert found["sales", "rows"] == (2, None) and len(found) == 14
    plan = checks.where("dataset = 'sell_prices'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    empty = {(r["dataset"], r["check"]): r["value"] for r in validation.findings(RetailTables(calendar, prices.limit(0), sales)).collect()}
    assert empty["sell_prices", "rows"] == 0 and empty["sell_prices", "duplicates"] == 0


def test_numbers_are_described_from_one_scan(spark, tmp_path):
    rng = np.random.default_rng(1)
    values = [(None if k % 7 == 0 else float(np.round(rng.normal(), 1)), int(k % 5)) for k in range(400)]
    spark.createDataFrame(values, "a double, b int").write.parquet(str(tmp_path / "t"))
    made = {r["column"]: r for r in validation.describe_numbers(spark.read.parquet(str(tmp_path / "t")), ["a", "b"]).collect()}
    for column, numbers in (("a", [v for v, _ in values if v is not None]), ("b", [v for _, v in values])):
        row = made[column]
        assert row["count"] == len(numbers) and row["mean"] == pytest.approx(np.mean(numbers)) and row["std"] == pytest.approx(np.std(numbers, ddof=1))
        assert [row["p25"], row["p50"], row["p75"]] == pytest.approx(list(np.quantile(numbers, [0.25, 0.5, 0.75])))
        assert (row["min"], row["max"]) == (min(numbers), max(numbers))
    alone = validation.describe_numbers(spark.createDataFrame([(1.0, None)], "a double, b double"), ["a", "b"])
    rows = {r["column"]: r for r in alone.collect()}
    assert rows["a"]["std"] is None and rows["a"]["p50"] == 1.0 and rows["b"]["count"] == 0 and rows["b"]["mean"] is None


def test_sample_lines_show_shape_and_first_rows(spark):
    df = spark.createDataFrame([("b", 2, None), ("a", 3, 1.5), ("c", 1, 2.5)], "k string, n int, x double")
    lines = [r["line"] for r in validation.sample_lines("t", df, ["k"], 100, rows=2, columns=2).orderBy("line_no").collect()]
    assert lines == ["", "## t: 3 rows, 3 columns", "", "| k | n |", "| --- | --- |", "| a | 3 |", "| b | 2 |"]
    empty = validation.sample_lines("t", df.limit(0), ["k"], 0).orderBy("line_no").collect()
    assert [r["line_no"] for r in empty] == [0, 1, 2, 3, 4] and "0 rows" in empty[1]["line"]
