"""Nearest neighbours by inner product with vantage-point trees per shard.

Vectors are dealt to shards of bounded size by a hash of their id and every shard becomes one tree. A
largest inner product is a smallest distance once each vector gets one more component that lifts all of
a shard's vectors to the same length, so the triangle inequality prunes subtrees. A subtree is left out
when its distance bound exceeds ``factor`` times the distance of the worst neighbour kept: factor 1 is
exact search, smaller factors look at fewer points. Queries go in blocks to every shard, a whole block
walks a tree at once, and the shards' neighbours are merged per query.
"""

from __future__ import annotations

import io

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stockloom.llm.common import staged

SHARD_ROWS = 16_384
BLOCK_QUERIES = 1_024
LEAF = 128
FACTOR = 0.7
NEIGHBOURS = 20


class Tree:
    """Points in leaf order with, for each inner node, its vantage point and both halves' distance ranges."""

    FIELDS = ("ids", "points", "lift", "vantage", "ranges", "bounds", "kids")

    def __init__(self, **fields: np.ndarray):
        self.__dict__.update(fields)

    @classmethod
    def build(cls, ids: np.ndarray, vectors: np.ndarray) -> Tree:
        order = np.argsort(ids, kind="stable")
        ids, points = ids[order], vectors[order].astype(np.float64)
        squares = (points * points).sum(axis=1)
        lift = np.sqrt(np.maximum(squares.max() - squares, 0.0))
        lifted = np.column_stack([points, lift])
        place = np.arange(len(ids))
        vantage, ranges, bounds, kids = [], [], [], []

        def node(begin: int, end: int) -> int:
            at = len(bounds)
            bounds.append((begin, end))
            kids.append((-1, -1))
            ranges.append((0.0, 0.0, 0.0, 0.0))
            vantage.append(0)
            if end - begin <= LEAF:
                return at
            held = place[begin:end]
            far = lifted[held] - lifted[held].mean(axis=0)
            chosen = held[np.argmax((far * far).sum(axis=1))]
            away = lifted[held] - lifted[chosen]
            distance = np.sqrt((away * away).sum(axis=1))
            sort = np.argsort(distance, kind="stable")   # halves by count, so equal points split evenly too
            place[begin:end], distance = held[sort], distance[sort]
            half = (end - begin) // 2
            vantage[at] = int(chosen)
            ranges[at] = (distance[0], distance[half - 1], distance[half], distance[-1])
            left = node(begin, begin + half)
            kids[at] = (left, node(begin + half, end))
            return at

        node(0, len(ids))
        inverse = np.empty(len(ids), np.int64)
        inverse[place] = np.arange(len(ids))
        return cls(ids=ids[place], points=points[place].astype(np.float32) if vectors.dtype == np.float32 else points[place],
                   lift=lift[place], vantage=inverse[np.array(vantage)], ranges=np.array(ranges),
                   bounds=np.array(bounds), kids=np.array(kids))

    def dumps(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def loads(cls, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as held:
            return cls(**{f: held[f] for f in cls.FIELDS})

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, ...]:
        """(query row, id, inner product) of the k best per query, the query's own id left out."""
        points = self.points.astype(np.float64)
        queries = np.ascontiguousarray(queries, np.float64)
        n = len(queries)
        radius = float(np.max((points * points).sum(axis=1) + self.lift**2))
        lengths = (queries * queries).sum(axis=1) + radius
        slack = 1e-9 * (1.0 + lengths)           # rounding of the products, so that ties are never lost
        best_row, best_id, best = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        worst = np.full(n, -np.inf)
        done: dict[int, np.ndarray] = {}

        def look(leaf: int, rows: np.ndarray) -> None:
            nonlocal best_row, best_id, best
            begin, end = self.bounds[leaf]
            held, ids = points[begin:end], self.ids[begin:end]
            product = queries[rows] @ held.T
            product[ids[None, :] == query_ids[rows][:, None]] = -np.inf
            limit = worst[rows] - slack[rows]
            if end - begin > k:
                limit = np.maximum(limit, np.partition(product, -k, axis=1)[:, -k] - slack[rows])
            r, c = np.nonzero((product >= limit[:, None]) & np.isfinite(product))
            exact = (queries[rows[r]] * held[c]).sum(axis=1)   # the same sum for equal vectors, wherever they lie
            best_row, best_id, best = (np.concatenate(x) for x in ((best_row, rows[r]), (best_id, ids[c]), (best, exact)))

        def settle() -> None:
            nonlocal best_row, best_id, best
            order = np.lexsort((best_id, -best, best_row))
            rows = best_row[order]
            begins = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if len(rows) else np.empty(0, np.int64)
            nth = np.arange(len(rows)) - np.repeat(begins, np.diff(np.append(begins, len(rows))))
            order = order[nth < k]
            best_row, best_id, best = best_row[order], best_id[order], best[order]
            last = nth == k - 1
            worst[rows[last]] = np.maximum(worst[rows[last]], best_of(rows, last))

        def best_of(rows: np.ndarray, last: np.ndarray) -> np.ndarray:
            """The k-th value of each query that has k."""
            counts = np.bincount(best_row, minlength=n)
            ends = np.cumsum(counts)
            full = rows[last]
            return best[ends[full] - 1]

        def distances(node: int, rows: np.ndarray) -> np.ndarray:
            v = self.vantage[node]
            return np.sqrt(np.maximum(lengths[rows] - 2 * (queries[rows] @ points[v]), 0.0))

        def bound(node: int, side: int, d: np.ndarray) -> np.ndarray:
            low, high = self.ranges[node][2 * side:2 * side + 2]
            return np.maximum(np.maximum(low - d, d - high), 0.0)

        def descend(node: int, rows: np.ndarray) -> None:
            """Each query to the leaf on its nearer sides, for a first worst neighbour."""
            if not len(rows):
                return
            if self.kids[node][0] < 0:
                look(node, rows)
                done[node] = rows
                return
            d = distances(node, rows)
            left = bound(node, 0, d) <= bound(node, 1, d)
            descend(self.kids[node][0], rows[left])
            descend(self.kids[node][1], rows[~left])

        def walk(node: int, rows: np.ndarray) -> None:
            if not len(rows):
                return
            if self.kids[node][0] < 0:
                seen = done.get(node)
                rows = rows if seen is None else np.setdiff1d(rows, seen, assume_unique=True)
                if len(rows):
                    look(node, rows)
                    settle()
                return
            d = distances(node, rows)
            for side in (0, 1):
                reach = np.sqrt(np.maximum(lengths[rows] - 2 * worst[rows], 0.0))
                walk(self.kids[node][side], rows[bound(node, side, d) <= factor * reach * (1 + 1e-9) + 1e-9])

        everyone = np.arange(n)
        descend(0, everyone)
        settle()
        walk(0, everyone)
        return best_row, best_id, best


def usable(vectors: DataFrame, key: str, column: str) -> DataFrame:
    """(id, vector, dim) of the rows that take part: id and vector given, finite and not all zero."""
    value = F.col(f"`{column}`")
    fine = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col(f"`{key}`").isNotNull() & value.isNotNull() & fine & F.exists(value, lambda x: x != 0)).select(
        F.col(f"`{key}`").cast("long").alias("id"), value.alias("vector"), F.size(value).alias("dim"))


def build_index(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(dim, shard, tree): every usable row in one tree; vectors of different lengths are kept apart.

    Null, zero and non-finite vectors and rows without an id take no part. Repeated rows are points of
    their own. No rows: no trees.
    """
    rows = usable(vectors, key, column)
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    dealt = rows.join(F.broadcast(sizes), "dim") if sizes.limit(10_001).count() <= 10_000 else rows.join(sizes, "dim")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("id"), F.col("shards")).cast("int"))

    def plant(frame: pd.DataFrame) -> pd.DataFrame:
        tree = Tree.build(frame["id"].to_numpy(np.int64), np.stack(frame["vector"].to_numpy()))
        return pd.DataFrame({"dim": [frame["dim"].iat[0]], "shard": [frame["shard"].iat[0]], "tree": [tree.dumps()]})

    return staged(dealt.select("dim", "shard", "id", "vector").groupBy("dim", "shard").applyInPandas(
        plant, "dim int, shard int, tree binary"), "vantage-trees")


def search(index: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, factor: float = FACTOR, key: str = "vec_id",
           column: str = "embedding", block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found, ties to the smaller id.

    Scores are inner products of the given vectors in double precision. Unusable queries have no rows,
    queries with fewer candidates have fewer. A query never finds its own id.
    """
    asked = usable(queries, key, column)
    sizes = asked.groupBy("dim").agg(F.ceil(F.count("*") / block_queries).cast("int").alias("blocks"))
    shards = index.groupBy("dim").agg((F.max("shard") + 1).alias("shards"))
    grid = sizes.join(shards, "dim")
    placed = asked.join(F.broadcast(grid) if grid.limit(10_001).count() <= 10_000 else grid, "dim").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    packed = placed.groupBy("dim", "block", "shards").agg(F.collect_list(F.struct("id", "vector")).alias("asked"))
    blocks = packed.select("dim", "block", "asked", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    trees = index.join(grid.select("dim", "blocks"), "dim").select(
        "dim", "shard", "tree", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def find(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        for tree, rows in zip(left["tree"], right["asked"]):
            ids = np.array([r["id"] for r in rows], np.int64)
            at, got, score = Tree.loads(tree).search(ids, np.stack([r["vector"] for r in rows]), k, factor)
            found.append(pd.DataFrame({"query_id": ids[at], "vec_id": got, "score": score}))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    cell = ["dim", "shard", "block"]
    found = trees.groupBy(*cell).cogroup(blocks.groupBy(*cell)).applyInPandas(find, "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).alias("rank")
    return found.select("query_id", rank, "vec_id", "score").where(F.col("rank") <= k)
