"""Histogram boosting against a plain loop, blocks against one block, masks against separate tables, contributions
against all subsets."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stockloom.operators import boosting

COLUMNS = ["a", "b", "c", "d"]


def plain_boosting(rows, target, edges, rounds, depth, step_size):
    """Every cut of every column tried at every node; predictions and the first tree's splits."""
    made, first = np.full(len(target), target.mean()), []
    for _ in range(rounds):
        residual, node = target - made, np.zeros(len(target), int)
        for level in range(depth):
            below = 2 * node
            for j in range(1 << level):
                here = node == j
                best = (1e-9, None, None)
                for column, cuts in enumerate(edges):
                    for cut in cuts:
                        right = here & (rows[:, column] > cut)
                        left = here & ~right
                        if left.any() and right.any():
                            gain = sum(residual[s].sum() ** 2 / s.sum() for s in (left, right)) - residual[here].sum() ** 2 / here.sum()
                            if gain > best[0] * (1 + 1e-7):
                                best = (gain, column, cut)
                if len(first) < (1 << depth) - 1:
                    first.append(best[1:])
                if best[1] is not None:
                    below = np.where(here, 2 * node + (rows[:, best[1]] > best[2]), below)
            node = below
        values = np.array([residual[node == k].mean() if (node == k).any() else 0.0 for k in range(1 << depth)])
        made = made + step_size * values[node]
    return made, first


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    frame = pd.DataFrame(np.round(rng.normal(size=(900, 4)), 1), columns=COLUMNS)
    frame["d"] = rng.integers(0, 2, 900).astype(float)
    frame["y"] = np.round(4 * frame.a + 2 * frame.b**2 + 3 * frame.d + rng.normal(size=900), 2) + 10
    frame["z"] = np.where(rng.random(900) < 0.2, None, frame.y + frame.c)
    frame["position"] = rng.permutation(900) + 1
    frame["z"] = frame["z"].astype(float)
    df = spark.createDataFrame(frame).withColumn("z", F.when(~F.isnan("z"), F.col("z")))
    return frame, df.repartition(3)


def test_boosting_is_the_plain_loop(table):
    frame, df = table
    edges = boosting.bin_edges(df, COLUMNS, 16)
    model = boosting.fit(df, COLUMNS, ["y"], [boosting.Model(0)], rounds=4, depth=3, step_size=0.3, bins=16)[0]
    rows = frame[COLUMNS].to_numpy()
    made, first = plain_boosting(rows, frame.y.to_numpy(), edges, 4, 3, 0.3)
    np.testing.assert_allclose(model.predict(rows), made, atol=1e-9)
    assert [(int(f), t) for f, t in zip(model.feature[0], model.threshold[0])] == first
    assert model.cover[0, 0] == 900 and model.cover[0, 1:3].sum() == 900
    shares = model.importances()
    assert math.isclose(sum(shares.values()), 1) and shares["a"] > shares["c"]


def test_blocks_labels_and_masks(table):
    """Several blocks give one block's models; a mask gives the model of a table cut to it."""
    frame, df = table
    models = [boosting.Model(0), boosting.Model(1, 1), boosting.Model(2, 0, 400), boosting.Model(3, 0, 0)]
    settings = dict(position="position", rounds=3, depth=3, step_size=0.3, bins=16)
    one = boosting.fit(df, COLUMNS, ["y", "z"], models, **settings)
    several = boosting.fit(df.repartition(7), COLUMNS, ["y", "z"], models, **settings, block_rows=200)
    rows = frame[COLUMNS].to_numpy()
    assert set(one) == set(several) == {0, 1, 2}
    for name in one:
        np.testing.assert_allclose(one[name].predict(rows), several[name].predict(rows), atol=1e-6)
        np.testing.assert_array_equal(one[name].feature[0], several[name].feature[0])
    edges = boosting.bin_edges(df, COLUMNS, 16)
    known = (frame.position <= 400).to_numpy()
    cut = plain_boosting(rows[known], frame.y.to_numpy()[known], edges, 3, 3, 0.3)[0]
    np.testing.assert_allclose(one[2].predict(rows[known]), cut, atol=1e-9)
    labelled = frame.z.notna().to_numpy()
    np.testing.assert_allclose(one[1].predict(rows[labelled]), plain_boosting(
        rows[labelled], frame.z.to_numpy()[labelled], edges, 3, 3, 0.3)[0], atol=1e-9)


def test_constant_columns_one_row_and_no_rows(spark):
    df = spark.createDataFrame([(1.0, 5.0), (1.0, 7.0)], "a double, y double")
    model = boosting.fit(df, ["a"], ["y"], [boosting.Model(0)], rounds=2, depth=2)[0]
    assert model.predict(np.array([[1.0], [9.0]])).tolist() == [6.0, 6.0] and model.importances() == {"a": 0.0}
    assert boosting.fit(df.limit(1), ["a"], ["y"], [boosting.Model(0)], rounds=1, depth=1)[0].base == 5.0
    assert boosting.fit(df.where("a > 1"), ["a"], ["y"], [boosting.Model(0)]) == {}
    with pytest.raises(ValueError):
        boosting.fit(df, ["a"], ["y"], [boosting.Model(0)], depth=9)


def known_value(ensemble, tree, row, columns):
    """Value of a tree when only ``columns`` are known: other splits are taken by their share of training rows."""
    inner = len(ensemble.feature[tree])

    def at(node):
        if node >= inner:
            return ensemble.value[tree, node - inner]
        split, cover = ensemble.feature[tree, node], ensemble.cover[tree]
        if split < 0:
            return at(2 * node + 1)
        if split in columns:
            return at(2 * node + 1 + int(row[split] > ensemble.threshold[tree, node]))
        return sum(cover[c] / cover[node] * at(c) for c in (2 * node + 1, 2 * node + 2) if cover[c])
    return at(0)


def test_contributions_are_shapley_values(table):
    frame, df = table
    model = boosting.fit(df, COLUMNS, ["y"], [boosting.Model(0)], rounds=3, depth=3, step_size=0.3, bins=8)[0]
    rows = frame[COLUMNS].to_numpy()[:40]
    found = boosting.shapley(model, rows)
    players = range(len(COLUMNS))
    for row, parts in zip(rows, found):
        for i in players:
            others, wanted = [j for j in players if j != i], 0.0
            for size in range(len(others) + 1):
                weight = math.factorial(size) * math.factorial(len(others) - size) / math.factorial(len(COLUMNS))
                for subset in itertools.combinations(others, size):
                    wanted += weight * sum(
                        known_value(model, t, row, {*subset, i}) - known_value(model, t, row, set(subset)) for t in range(3))
            assert math.isclose(parts[i], wanted, abs_tol=1e-9)
    np.testing.assert_allclose(boosting.expected(model) + found.sum(axis=1), model.predict(rows), atol=1e-9)
    told = boosting.contributions(df, model).select(
        F.max(F.abs(F.col("mean_prediction") + F.aggregate("parts", F.lit(0.0), lambda t, v: t + v) - F.col("yhat")))).first()[0]
    assert told < 1e-9
    ranking = boosting.mean_contributions(df, model).collect()
    assert [r["feature"] for r in ranking][0] == "a" and len(ranking) == 4


def test_columns_that_follow_from_each_other_are_counted_together():
    """A calendar's columns share one count, and counts per node are the plain sums of every bin."""
    rng = np.random.default_rng(3)
    day = rng.integers(0, 896, 5000)
    week, free = day // 28, rng.integers(0, 32, (2, 5000))
    bins = np.stack([week, 31 - week, (week * 7) % 32, week // 4, *free]).astype(np.uint8)
    sizes = [32, 32, 32, 8, 32, 32]
    block = boosting.Block(bins, rng.normal(size=(1, 5000)), day.astype(np.int32), sizes)
    assert sorted(sorted(p.columns) for p in block.packs) == [[0, 1, 2, 3, 4], [5]]
    nodes = [np.flatnonzero(week % 3 == k) for k in range(3)] + [np.array([], np.int64)]
    sums, counts = boosting.counted(block, block.joint, nodes, block.labels[0])
    for node, rows in enumerate(nodes):
        for column, size in enumerate(sizes):
            at = slice(block.starts[column], block.starts[column + 1])
            np.testing.assert_array_equal(counts[node, at], np.bincount(bins[column, rows], None, size))
            np.testing.assert_allclose(sums[node, at], np.bincount(bins[column, rows], block.labels[0][rows], size), atol=1e-6)   # residuals are rounded
