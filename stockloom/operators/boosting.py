"""Histogram gradient boosting of many models at once over one binned table.

Features are cut into small integers once and stored in blocks of rows. A model is a label column and a
last position: one model per forecast step, or one per backtest origin, reads the same blocks under its
own mask. Each tree level needs, per model and node, the sums of the residuals and the row counts of every
bin. Where a table has several blocks these histograms are added up over the blocks by Spark, keyed by
model, and only the chosen splits come to the driver; where it has one block nothing needs adding, and
the models are dealt over tasks that grow their trees to the end.

Squared loss, complete trees of a given depth, the mean as the start, least-squares leaf values times the
step size. Equal gains go to the earlier feature and the lower bin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.session import shared_dir, stored

BINS = 32
BLOCK_ROWS = 1 << 19      # rows of a block; what a task holds is this times features and models of its group
ROWS_AT_ONCE = 2048       # rows predicted at once
PACKED = 1 << 11          # cells of features that are counted together
FIRST_LOOK = 1 << 14      # rows that tell most features apart which do not fit together
COUNTED_AT_ONCE = 1 << 17 # rows
TIE = 1e-9                # relative difference below which gains are equal
FITTED_AT_ONCE = 64       # most tasks that models are dealt over; each holds the block
TASKS_A_CORE = 3
LEVELS_PER_CHECKPOINT = 60


@dataclass
class Ensemble:
    """Complete trees: inner nodes in heap order, leaves from left to right.

    ``feature`` is -1 where a node is not split (all rows go left); rows go right where the value is above
    ``threshold``. ``cover`` counts training rows of all nodes and leaves in heap order; ``value`` holds the
    leaves, the step size included.
    """

    columns: list[str]
    base: float
    feature: np.ndarray     # trees x inner
    threshold: np.ndarray   # trees x inner
    gain: np.ndarray        # trees x inner
    cover: np.ndarray       # trees x (inner + leaves)
    value: np.ndarray       # trees x leaves

    @property
    def depth(self) -> int:
        return int(self.value.shape[1]).bit_length() - 1

    def predict(self, rows: np.ndarray) -> np.ndarray:
        """Predictions for rows x columns; all trees take a level together, for some rows at a time."""
        total = np.empty(len(rows))
        inner, tree = self.feature.shape[1], np.arange(len(self.feature))
        for start in range(0, len(rows), ROWS_AT_ONCE):
            some = rows[start:start + ROWS_AT_ONCE]
            at = np.arange(len(some))[:, None]
            node = np.zeros((len(some), len(tree)), np.int64)
            for _ in range(self.depth):
                split = self.feature[tree, node]
                node = 2 * node + 1 + ((some[at, split] > self.threshold[tree, node]) & (split >= 0))
            total[start:start + ROWS_AT_ONCE] = self.base + self.value[tree, node - inner].sum(axis=1)
        return total

    def importances(self) -> dict[str, float]:
        """Share of the squared error that a column's splits removed."""
        sums = np.zeros(len(self.columns))
        used = self.feature >= 0
        np.add.at(sums, self.feature[used], self.gain[used])
        total = sums.sum()
        return dict(zip(self.columns, (sums / total if total > 0 else sums).tolist()))


def bin_edges(matrix: DataFrame, columns: list[str], bins: int = BINS) -> list[np.ndarray]:
    """At most ``bins - 1`` ascending cuts per column: quantiles of its values; a value is in bin k if k cuts lie below it.

    One pass with Spark's quantile sketch. Only the cuts come to the driver.
    """
    shares = F.array(*(F.lit(k / bins) for k in range(1, bins)))
    row = matrix.agg(*(F.approx_percentile(c, shares, 10_000).alias(f"_{i}") for i, c in enumerate(columns)),
                     *(F.max(c).alias(f"_top{i}") for i, c in enumerate(columns))).first()
    cuts = (np.unique(np.array(row[f"_{i}"] or [], float)) for i in range(len(columns)))
    return [c[c < row[f"_top{i}"]] if row[f"_top{i}"] is not None else c for i, c in enumerate(cuts)]


def binned_blocks(matrix: DataFrame, columns: list[str], labels: list[str], edges: list[np.ndarray], position: str | None = None) -> DataFrame:
    """The stored binned table, one row per piece of a block: rows, bins (columns x rows), labels and positions as bytes.

    A label that is null is NaN. Pieces are what a task reads at once; :func:`fit` joins them to blocks.
    """
    fields = [F.col(c).cast("double").alias(c) for c in columns]
    fields += [F.col(c).cast("double").alias(c) for c in labels]
    place = F.lit(0) if position is None else F.col(position)
    chosen = matrix.select(*fields, place.cast("int").alias("_position"))

    def run(batches: Iterator) -> Iterator[pd.DataFrame]:
        import pyarrow as pa

        def values(batch, name):
            return batch.column(name).to_numpy(zero_copy_only=False)

        for batch in batches:
            if not batch.num_rows:
                continue
            bins = np.stack([np.searchsorted(cut, values(batch, c)).astype(np.uint8) for c, cut in zip(columns, edges)])
            held = np.stack([values(batch, c) for c in labels]).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.num_rows], pa.int64()), pa.array([bins.tobytes()], pa.binary()),
                 pa.array([held.tobytes()], pa.binary()), pa.array([values(batch, "_position").astype(np.int32).tobytes()], pa.binary())],
                ["rows", "bins", "labels", "positions"])

    return stored(chosen.mapInArrow(run, "rows long, bins binary, labels binary, positions binary"), "binned")


# --- kernels over one block ----------------------------------------------------------------------------

class Pack:
    """Columns counted together: one cell per combination of bins that occurs, so columns that follow from
    each other, as a calendar's do, share few cells."""

    def __init__(self, column: int, size: int, bins: np.ndarray):
        self.columns, self.bins = [column], [np.arange(size)]   # per column the bin of each cell
        self.index, self.cells = bins.astype(np.int32), size

    def take_in(self, column: int, size: int, bins: np.ndarray) -> bool:
        """Whether the column's bins and the cells so far occur in at most PACKED combinations; if so it joins."""
        if self.cells * size > PACKED and len(bins) > FIRST_LOOK:
            first = self.index[:FIRST_LOOK] * size + bins[:FIRST_LOOK]
            if np.count_nonzero(np.bincount(first, None, self.cells * size)) > PACKED:
                return False
        joint = self.index * size + bins
        held = np.flatnonzero(np.bincount(joint, None, self.cells * size))
        if len(held) > PACKED:
            return False
        cell = np.zeros(self.cells * size, np.int32)
        cell[held] = np.arange(len(held))
        self.index, self.cells = cell[joint], len(held)
        self.bins = [b[held // size] for b in self.bins] + [held % size]
        self.columns.append(column)
        return True

    def close(self, starts: np.ndarray) -> np.ndarray:
        """The cells of the rows. Keeps how cells add up to the columns' bins, which begin at ``starts``: the cells
        in order of bins, where a bin's cells begin, and its place."""
        order = [np.argsort(b, kind="stable") for b in self.bins]
        place = np.concatenate([starts[c] + b[o] for c, b, o in zip(self.columns, self.bins, order)])
        self.begin = np.flatnonzero(np.diff(place, prepend=-1))
        self.order, self.place = np.concatenate(order), place[self.begin]
        index, self.index = self.index.astype(np.uint16), None
        return index


def packs(sizes: list[int], bins: np.ndarray) -> list[Pack]:
    """All columns in packs, each in the first that it fits in."""
    out: list[Pack] = []
    for column in sorted(range(len(sizes)), key=lambda c: -sizes[c]):
        if not any(p.take_in(column, sizes[column], bins[column]) for p in out):
            out.append(Pack(column, sizes[column], bins[column]))
    return out


class Block:
    """Rows of the binned table, ready for counting."""

    def __init__(self, bins: np.ndarray, labels: np.ndarray, positions: np.ndarray, sizes: list[int]):
        self.bins, self.sizes, self.labels, self.positions = bins, sizes, labels, positions
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.packs = packs(sizes, bins)
        self.joint = np.column_stack([p.close(self.starts) for p in self.packs])   # rows x packs

    def chosen(self, label: int, last: int | None) -> np.ndarray:
        """Rows of a model: its label is known and lies up to ``last``."""
        known = ~np.isnan(self.labels[label])
        return np.flatnonzero(known if last is None else known & (self.positions <= last))


def counted(block: Block, joint: np.ndarray, nodes: list[np.ndarray | slice], residual: np.ndarray) -> np.ndarray:
    """(2, nodes, cells): sums of the residuals and numbers of rows in every bin of every column.

    Both come from one sum: a row weighs its residual, rounded to a step that lets all sums be exact, plus a power
    of two above any sum of residuals. So sums do not depend on the order of the rows either. ``nodes`` picks each
    node's rows from ``joint`` and ``residual``.
    """
    values = [residual[rows] for rows in nodes]
    rows_all = sum(len(v) for v in values)
    high = 2.0 ** math.ceil(math.log2(2 * sum(np.abs(v).sum() for v in values) + 2))
    step = 2.0 ** (math.ceil(math.log2(high * (rows_all + 1))) - 52)
    sums = np.zeros((len(block.packs), len(nodes), PACKED))
    for node, (rows, value) in enumerate(zip(nodes, values)):
        weights = np.round(value / step) * step + high
        for start in range(0, len(value), COUNTED_AT_ONCE):   # few enough rows for the weights to stay in the cache
            weight = weights[start:start + COUNTED_AT_ONCE]
            some = joint[start:start + COUNTED_AT_ONCE] if isinstance(rows, slice) else joint.take(
                rows[start:start + COUNTED_AT_ONCE], axis=0)
            for k, pack in enumerate(block.packs):
                sums[k, node, :pack.cells] += np.bincount(some[:, k], weight, pack.cells)
    out = np.zeros((2, len(nodes), block.starts[-1]))
    for pack, total in zip(block.packs, sums):
        out[0][:, pack.place] = np.add.reduceat(total.take(pack.order, axis=1), pack.begin, axis=1)
    out[1] = np.round(out[0] / high)
    out[0] -= out[1] * high
    return out


def best_splits(sums: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, ...]:
    """Per node of (2, nodes, cells): column (-1: none), last bin of the left side (255), gain, number of rows, those going left."""
    starts = np.concatenate([[0], np.cumsum(sizes)])
    total, count = sums[0, :, :sizes[0]].sum(axis=1), sums[1, :, :sizes[0]].sum(axis=1)
    running = np.cumsum(sums, axis=2)
    before = np.concatenate([np.zeros((*sums.shape[:2], 1)), running], axis=2)[:, :, starts[:-1]]
    column = np.repeat(np.arange(len(sizes)), sizes)
    left, held = running - before[:, :, column]
    right, rest = total[:, None] - left, count[:, None] - held
    held, rest = np.round(held), np.round(rest)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left**2 / held + right**2 / rest - (total**2 / count)[:, None]
    gain[(held < 1) | (rest < 1)] = -1.0
    gain[:, starts[1:] - 1] = -1.0
    top = gain.max(axis=1)
    first = np.argmax(gain >= (top * (1 - TIE))[:, None], axis=1)
    splits = top > TIE * np.maximum(1.0, np.abs(total))
    return (np.where(splits, column[first], -1), np.where(splits, first - starts[column[first]], 255),
            np.where(splits, top, 0.0), count, np.where(splits, held[np.arange(len(first)), first], count))


class Grower:
    """One model over one block: predictions so far and the nodes of the tree that grows."""

    def __init__(self, block: Block, label: int, last: int | None, base: float):
        rows = block.chosen(label, last)
        self.bins, self.joint = block.bins.take(rows, axis=1), block.joint.take(rows, axis=0)
        self.whole = np.asfortranarray(self.joint)   # the same, pack by pack, for counting all rows
        self.target = block.labels[label][rows]
        self.made = np.full(len(self.target), base)
        self.start()

    def start(self) -> None:
        self.node, self.residual = np.zeros(len(self.target), np.uint8), self.target - self.made

    def histograms(self, block: Block, level: int) -> np.ndarray:
        return self.of_nodes(block, range(1 << level)) if level else counted(block, self.whole, [slice(None)], self.residual)

    def of_nodes(self, block: Block, wanted) -> np.ndarray:
        """Histograms of the wanted nodes."""
        return counted(block, self.joint, [np.flatnonzero(self.node == node) for node in wanted], self.residual)

    def split(self, feature: np.ndarray, cut: np.ndarray) -> None:
        """Rows above their node's cut go right; a node without a split keeps all rows left."""
        right = np.zeros(len(self.node), bool)
        for node in np.flatnonzero(feature >= 0).tolist():   # plain numbers, so that bytes are compared as bytes
            right |= (self.node == node) & (self.bins[feature[node]] > int(cut[node]))
        self.node = 2 * self.node + right.view(np.uint8)

    def leaves(self, depth: int) -> np.ndarray:
        """(2, leaves): sums of the residuals and numbers of rows."""
        return np.stack([np.bincount(self.node, self.residual, 1 << depth), np.bincount(self.node, None, 1 << depth)])

    def finish(self, value: np.ndarray) -> None:
        self.made += value[self.node]
        self.start()


def leaf_values(sums: np.ndarray, step_size: float) -> np.ndarray:
    return step_size * sums[0] / np.maximum(sums[1], 1)


class Trees:
    """What is known of one model's trees, level by level."""

    def __init__(self, base: float, depth: int):
        self.base, self.depth, self.trees = base, depth, []

    def level(self, level: int, found: tuple) -> None:
        if level == 0:
            inner = (1 << self.depth) - 1
            self.trees.append([np.full(inner, -1, np.int16), np.full(inner, 255, np.int16), np.zeros(inner),
                               np.zeros(2 * inner + 1), np.zeros(inner + 1)])
        at = slice((1 << level) - 1, (2 << level) - 1)
        tree = self.trees[-1]
        for k in range(4):
            tree[k][at] = found[k]

    def leaves(self, sums: np.ndarray, step_size: float) -> np.ndarray:
        tree = self.trees[-1]
        tree[3][(1 << self.depth) - 1:] = sums[1]
        tree[4][:] = leaf_values(sums, step_size)
        return tree[4]

    def ensemble(self, columns: list[str], edges: list[np.ndarray]) -> Ensemble:
        feature, cut, gain, cover, value = (np.stack([t[k] for t in self.trees]) for k in range(5))
        threshold = np.zeros(cut.shape)
        for column, cuts in enumerate(edges):
            at = feature == column
            threshold[at] = cuts[cut[at]]
        return Ensemble(columns, self.base, feature.astype(np.int64), threshold, gain, cover, value)


@dataclass
class Model:
    """What to fit: a label's number, and the last position whose rows are known (None: all)."""

    name: int
    label: int = 0
    last: int | None = None


def _joined(pieces: list, columns: int, labels: int, sizes: list[int]) -> Block:
    """One block from its pieces, in a fixed order so that sums do not depend on how they arrived.

    Neighbours share days, and adding to one cell row after row waits for each addition: the order is a mixed one.
    """
    pieces = sorted(pieces, key=lambda p: (p[0], p[1], p[2]))
    positions = np.concatenate([np.frombuffer(p[3], np.int32) for p in pieces])
    order = np.random.default_rng(0).permutation(len(positions))
    return Block(np.concatenate([np.frombuffer(p[1], np.uint8).reshape(columns, p[0]) for p in pieces], axis=1).take(order, axis=1),
                 np.concatenate([np.frombuffer(p[2], np.float64).reshape(labels, p[0]) for p in pieces], axis=1).take(order, axis=1),
                 positions[order], sizes)


def _grown(block: Block, model: Model, base: float, rounds: int, depth: int, step_size: float) -> Trees:
    """All trees of a model whose rows lie in one block.

    Below the root the histograms of the smaller child of each pair are counted, the other's is the rest.
    """
    grower, trees = Grower(block, model.label, model.last, base), Trees(base, depth)
    for _ in range(rounds):
        sums = grower.histograms(block, 0)
        for level in range(depth):
            found = best_splits(sums, block.sizes)
            trees.level(level, found)
            grower.split(*found[:2])
            if level + 1 == depth:
                break
            small = 2 * np.arange(1 << level) + (found[3] - found[4] < found[4])
            half = grower.of_nodes(block, small.tolist())
            below = np.empty((2, 2 << level, half.shape[2]))
            below[:, small] = half
            below[:, small ^ 1] = sums - half
            sums = below
        grower.finish(trees.leaves(grower.leaves(depth), step_size))
    return trees


def starts(blocks: DataFrame, models: list[Model], labels: int) -> dict[int, tuple[float, int]]:
    """(mean of the label, rows) of each model; sums per position and label are added up by Spark."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for p in frame.itertuples(index=False):
                held = np.frombuffer(p.labels, np.float64).reshape(labels, p.rows)
                at = np.frombuffer(p.positions, np.int32)
                for label in range(labels):
                    known = ~np.isnan(held[label])
                    yield pd.DataFrame({"position": at[known], "total": held[label][known]}).groupby("position", as_index=False).agg(
                        total=("total", "sum"), held=("total", "count")).assign(label=label)

    sums = blocks.mapInPandas(run, "position int, total double, held long, label int").groupBy("label", "position").agg(
        F.sum("total").alias("total"), F.sum("held").alias("held"))
    wanted = blocks.sparkSession.createDataFrame(
        [(m.name, m.label, m.last) for m in models], "name int, label int, last int")
    # Few models, and one row per label and day: a join on the label.
    rows = sums.join(wanted, "label").where(F.col("last").isNull() | (F.col("position") <= F.col("last"))).groupBy("name").agg(
        F.sum("total").alias("total"), F.sum("held").alias("held")).collect()
    return {r["name"]: (r["total"] / r["held"], r["held"]) for r in rows}


def fit(
    matrix: DataFrame, columns: list[str], labels: list[str], models: list[Model], position: str | None = None,
    rounds: int = 100, depth: int = 5, step_size: float = 0.05, bins: int = BINS, block_rows: int = BLOCK_ROWS,
) -> dict[int, Ensemble]:
    """The fitted models by name; a model without rows is left out.

    ``matrix`` holds finite ``columns``, the ``labels`` (null: the row has none) and, for models with a
    ``last``, the rows' ``position`` in their series. What comes to the driver are the trees, whose size the
    parameters bound: models x rounds x nodes.
    """
    matrix = stored(matrix.select(*columns, *labels, *([position] if position else [])), "matrix")   # read for the cuts and again for the bins
    edges = bin_edges(matrix, columns, bins)
    sizes = [len(e) + 1 for e in edges]
    blocks = binned_blocks(matrix, columns, labels, edges, position)
    rows = blocks.agg(F.sum("rows")).first()[0] or 0
    if depth > 8:
        raise ValueError("trees have at most 8 levels")
    known = starts(blocks, models, len(labels)) if rows else {}
    models = [m for m in models if m.name in known]
    if not models:
        return {}
    shards = -(-rows // block_rows)
    grow = _in_one_block if shards == 1 else _over_blocks
    made = grow(blocks, shards, models, {k: v[0] for k, v in known.items()}, len(columns), len(labels), sizes, rounds, depth, step_size)
    return {name: trees.ensemble(columns, edges) for name, trees in made.items()}


def _in_one_block(blocks, shards, models, bases, columns, labels, sizes, rounds, depth, step_size) -> dict[int, Trees]:
    """The models dealt over tasks, each with the whole block: nothing has to be added up."""
    groups = min(len(models), FITTED_AT_ONCE, TASKS_A_CORE * blocks.sparkSession.sparkContext.defaultParallelism)
    dealt = {g: models[g::groups] for g in range(groups)}

    def run(pair):
        group, held = pair
        block = _joined(list(held), columns, labels, sizes)
        return [(m.name, _grown(block, m, bases[m.name], rounds, depth, step_size)) for m in dealt[group]]

    # The block is small; each group of models gets a copy of it.
    return dict(blocks.rdd.flatMap(lambda p: [(g, tuple(p)) for g in range(groups)]).groupByKey(groups).flatMap(run).collect())


class _Unit:
    """One block with the models that grow over it."""

    def __init__(self, block: Block, growers: dict[int, Grower]):
        self.block, self.growers = block, growers


def _over_blocks(blocks, shards, models, bases, columns, labels, sizes, rounds, depth, step_size) -> dict[int, Trees]:
    """Level by level over all blocks: histograms are added up by model, splits go back to every block."""
    context = blocks.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(blocks.sparkSession))
    trees = {m.name: Trees(bases[m.name], depth) for m in models}

    def unit(pair):
        block = _joined(list(pair[1]), columns, labels, sizes)
        return _Unit(block, {m.name: Grower(block, m.label, m.last, bases[m.name]) for m in models})

    units = blocks.select(F.pmod(F.xxhash64("bins", "labels"), F.lit(shards)).alias("shard"), "rows", "bins", "labels", "positions").rdd.map(
        lambda r: (r[0], tuple(r[1:]))).groupByKey(shards).map(unit).persist(StorageLevel.MEMORY_AND_DISK)

    def added(make):
        return units.flatMap(make).reduceByKey(np.add)

    def moved(change):
        """The blocks after a change that all of them take; the former ones are let go."""
        nonlocal units
        before = units
        units = before.map(change).persist(StorageLevel.MEMORY_AND_DISK)
        number[0] += 1
        if number[0] % LEVELS_PER_CHECKPOINT == 0:
            units.checkpoint()
        older.append(before)
        if len(older) > 2:
            older.pop(0).unpersist()

    number, older = [0], []
    for _ in range(rounds):
        for level in range(depth):
            found = added(lambda u, level=level: [(n, g.histograms(u.block, level)) for n, g in u.growers.items()]).mapValues(
                lambda sums: best_splits(sums, sizes)).collectAsMap()
            for name, splits in found.items():
                trees[name].level(level, splits)

            def split(u, found=found):
                for name, grower in u.growers.items():
                    grower.split(*found[name][:2])
                return u
            moved(split)
        sums = added(lambda u: [(n, g.leaves(depth)) for n, g in u.growers.items()]).collectAsMap()
        values = {name: trees[name].leaves(held, step_size) for name, held in sums.items()}

        def finish(u, values=values):
            for name, grower in u.growers.items():
                grower.finish(values[name])
            return u
        moved(finish)
    for held in [*older, units]:
        held.unpersist()
    return trees


def tree_table(spark: SparkSession, ensemble: Ensemble) -> DataFrame:
    """(tree, node, feature, threshold, gain, cover, value): nodes in heap order; feature and threshold are null on leaves."""
    rows, inner = [], ensemble.feature.shape[1]
    for t in range(len(ensemble.feature)):
        for node in range(2 * inner + 1):
            split = node < inner and ensemble.feature[t, node] >= 0
            rows.append((t, node, ensemble.columns[ensemble.feature[t, node]] if split else None,
                         float(ensemble.threshold[t, node]) if split else None,
                         float(ensemble.gain[t, node]) if split else None, int(ensemble.cover[t, node]),
                         float(ensemble.value[t, node - inner]) if node >= inner else None))
    return spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, gain double, cover long, value double")


# --- contributions -------------------------------------------------------------------------------------

def path_tables(ensemble: Ensemble) -> list[tuple[list, np.ndarray]]:
    """Per leaf its conditions and, for every pattern of conditions met, the Shapley values of the columns on the path.

    A path's columns (several conditions on one are one player) are met or not by a row; a column that is not
    known lets the row through with the share of training rows that took the path's side. With at most ``depth`` columns
    there are few patterns, so the polynomial over subset sizes is worked out once per leaf and pattern.
    """
    out = []
    inner = ensemble.feature.shape[1]
    for feature, threshold, cover, value in zip(ensemble.feature, ensemble.threshold, ensemble.cover, ensemble.value):
        for leaf in range(inner + 1):
            if not cover[inner + leaf] or not value[leaf]:
                continue
            conditions, share, node = {}, {}, inner + leaf
            while node:
                parent, right = (node - 1) // 2, node % 2 == 0
                if feature[parent] >= 0:
                    column = int(feature[parent])
                    conditions.setdefault(column, []).append((float(threshold[parent]), right))
                    share[column] = share.get(column, 1.0) * cover[node] / cover[parent]
                node = parent
            columns = sorted(conditions)
            m = len(columns)
            table = np.zeros((1 << m, m))
            weight = [math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m) for k in range(m)]
            for pattern in range(1 << m):
                met = [float(pattern >> j & 1) for j in range(m)]
                for j in range(m):
                    # Coefficient k: products over sets of k other columns known, the rest unknown.
                    polynomial = np.array([1.0])
                    for other in range(m):
                        if other != j:
                            polynomial = np.convolve(polynomial, [share[columns[other]], met[other]])
                    table[pattern, j] = value[leaf] * (met[j] - share[columns[j]]) * float(np.dot(polynomial, weight))
            out.append(([(c, conditions[c]) for c in columns], table))
    return out


def shapley(ensemble: Ensemble, rows: np.ndarray, tables: list | None = None) -> np.ndarray:
    """Path-dependent Shapley values, rows x columns; with :func:`expected` they add up to the prediction."""
    out = np.zeros((len(rows), len(ensemble.columns)))
    for conditions, table in path_tables(ensemble) if tables is None else tables:
        pattern = np.zeros(len(rows), np.int64)
        for j, (column, held) in enumerate(conditions):
            met = np.ones(len(rows), bool)
            for threshold, right in held:
                met &= (rows[:, column] > threshold) == right
            pattern |= met.astype(np.int64) << j
        for j, (column, _) in enumerate(conditions):
            out[:, column] += table[pattern, j]
    return out


def expected(ensemble: Ensemble) -> float:
    """The mean prediction over the training rows, by the leaves' covers."""
    inner = ensemble.feature.shape[1]
    return ensemble.base + float((ensemble.value * ensemble.cover[:, inner:]).sum() / max(1.0, ensemble.cover[0, 0]))


def contributions(matrix: DataFrame, ensemble: Ensemble) -> DataFrame:
    """``matrix`` with ``yhat``, ``mean_prediction`` and ``parts``, one Shapley value per column of the model."""
    columns, tables, middle = ensemble.columns, path_tables(ensemble), expected(ensemble)
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("array<double>")
    def parts(values: pd.Series) -> pd.Series:
        rows = np.stack(values.to_numpy()) if len(values) else np.empty((0, len(columns)))
        found = np.column_stack([ensemble.predict(rows), shapley(ensemble, rows, tables)])
        return pd.Series(list(found))

    made = matrix.withColumn("_parts", parts(F.array(*(F.col(c).cast("double") for c in columns))))
    return made.withColumns({"yhat": F.col("_parts")[0], "mean_prediction": F.lit(middle),
                             "parts": F.slice("_parts", 2, len(columns))}).drop("_parts")


def mean_contributions(matrix: DataFrame, ensemble: Ensemble) -> DataFrame:
    """(feature, mean_contribution): mean absolute Shapley value of each column, largest first."""
    names = F.array(*(F.lit(c) for c in ensemble.columns))
    each = contributions(matrix.select(*ensemble.columns), ensemble).select(
        F.explode(F.arrays_zip(names.alias("feature"), F.col("parts").alias("part"))).alias("x"))
    return each.groupBy(F.col("x.feature").alias("feature")).agg(
        F.avg(F.abs("x.part")).alias("mean_contribution")).orderBy(F.desc("mean_contribution"), "feature")
