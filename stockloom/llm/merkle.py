"""Merkle manifest of a dataset, and Octopus multiproofs of its rows.

Rows are leaves; the leaves of a group (a language) ascend by id and form a binary tree, the groups'
roots form a tree of their own, and its root stands for the dataset. A last node without a partner is
hashed alone. Positions come from a range partitioning with counts per range, so a group that holds
most rows is ranked by many tasks. Trees are built ``BITS`` levels at a time: 4,096 consecutive nodes
are climbed by one task, their tops are the next round's nodes.

A multiproof works on leaf partitions, blocks of 4,096 positions. Each one computes the union of the
coordinates that its leaves need and cannot derive from each other, all partitions fetch theirs in one
join, and a partition then derives the shared inner nodes and writes out each leaf's own path locally.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockloom.llm.common import staged

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BITS = 12            # levels climbed by one task
RANGE_ROWS = 50_000  # rows ranked by one task, about
TOP = "t"            # key of the tree over the groups; groups have the keys "" (null) and "s..."


@dataclass
class Manifest:
    """The stored trees of a dataset.

    ``leaves``: key, id, position, leaf, shown (null where it is the leaf), and of the row's group its
    number of leaves ``n`` and its place ``nth``. ``nodes``: key, level, at, hash of all trees from the
    leaves up. ``groups``: number of groups. ``root``: the dataset's root, None without rows.
    ``bits``: levels of a block.
    """

    leaves: DataFrame
    nodes: DataFrame
    groups: int
    root: str | None
    bits: int = BITS


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def height(width: int) -> int:
    """Levels above ``width`` leaves."""
    return max(0, (width - 1).bit_length())


def leaf_hash(values: list[Column]) -> Column:
    """sha256 of the values: ``-`` for null, else byte count, colon and the value as text."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*(
        F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
        for t in texts)), 256)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their task and their place among the task's rows of the same key."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        at = np.empty(len(batch), np.int64)
        runs = pc.run_end_encode(batch.column("key"))
        start = 0
        for key, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            if key != last:
                last, seen = key, 0
            at[start:end] = np.arange(seen, seen + end - start)
            seen, start = seen + end - start, end
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.full(len(batch), part, np.int32)), pa.array(at)],
            [*batch.schema.names, "part", "place"])


def ranked(rows: DataFrame, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """Rows dealt by ranges of (key, *order) with ``part`` and ``place``, and the parts' (key, part, before, n).

    A row's position in its key is ``before + place``; n is the key's number of rows. Rows that are equal
    in every column are parted by a number of their own, so many of them do not meet in one task.
    """
    known = staged(rows.withColumn("salt", F.monotonically_increasing_id()), f"{name}-rows")
    parts = max(1, math.ceil(known.count() / RANGE_ROWS))
    by = ["key", *order, "salt"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in known.schema.fields)
    dealt = staged(known.repartitionByRange(parts, *by).sortWithinPartitions(*by).mapInArrow(
        _numbered, f"{fields}, part int, place long").drop("salt"), f"{name}-ranges")
    earlier = W.partitionBy("key").orderBy("part")
    counts = dealt.groupBy("key", "part").agg(F.count("*").alias("held")).select(
        "key", "part",
        F.coalesce(F.sum("held").over(earlier.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("held").over(W.partitionBy("key")).alias("n"))
    return dealt, counts


def _climb(bits: int):
    """All nodes above one block of consecutive nodes, at most ``bits`` levels up."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("at", kind="stable")
        key, level, width = frame["key"].iat[0], int(frame["level"].iat[0]), int(frame["width"].iat[0])
        first, held, out = int(frame["at"].iat[0]), frame["hash"].tolist(), []
        for _ in range(bits):
            if width == 1:
                break
            held = [digest("".join(held[i:i + 2])) for i in range(0, len(held), 2)]
            level, width, first = level + 1, (width + 1) // 2, first // 2
            out.extend((key, level, first + i, width, h) for i, h in enumerate(held))
        return pd.DataFrame(out, columns=["key", "level", "at", "width", "hash"])
    return run


NODE = "key string, level int, at long, width long, hash string"


def trees(bottom: DataFrame, highest: int, name: str, bits: int = BITS) -> DataFrame:
    """Every node of the trees over ``bottom`` (key, level 0, at, width, hash), its own rows included.

    ``width`` is the number of the tree's nodes on that level; ``highest`` the highest tree's height.
    """
    found, current = bottom, bottom
    for base in range(0, highest, bits):
        made = staged(current.where("width > 1").groupBy("key", F.shiftright("at", bits).alias("block")).applyInPandas(
            _climb(bits), NODE), name)
        found, current = found.union(made), made.where(F.col("level") == base + bits)
    return found


def build(docs: DataFrame, shown: dict[str, Column] | None = None, group: str = "lang", order: str = "doc_id",
          fields: tuple[str, ...] = FIELDS, bits: int = BITS) -> Manifest:
    """The manifest of all rows of ``docs``; each row is a leaf, also one that repeats another.

    A leaf covers ``fields``; other columns are not read. Groups ascend by ``group`` (null first, then by
    UTF-8 bytes), leaves by ``order`` (null first), ties by their leaf hash; equal rows are equal leaves, so
    their order is immaterial. Null values are ``-`` and differ from empty texts. No rows: no leaves, no nodes
    and root None. ``shown`` maps fields to what a verifier is shown in their place, for :func:`verify`.
    """
    plain = {f: F.col(f"`{f}`") for f in fields}
    leaf, other = leaf_hash(list(plain.values())), leaf_hash(list((plain | (shown or {})).values()))
    key = F.when(plain[group].isNull(), "").otherwise(F.concat(F.lit("s"), plain[group].cast("string")))
    rows = docs.select(key.alias("key"), F.col(f"`{order}`").alias("id"), leaf.alias("leaf"), other.alias("shown"))
    if shown is None:
        rows = rows.withColumn("shown", F.lit(None).cast("string"))
    else:
        rows = rows.withColumn("shown", F.when(F.col("shown") != F.col("leaf"), F.col("shown")))
    dealt, counts = ranked(rows, ["id", "leaf"], "leaves")

    # The groups' own places, by the same ranking.
    named, before = ranked(counts.groupBy(F.lit(TOP).alias("key"), F.col("key").alias("id")).agg(
        F.max("n").alias("leaves")), ["id"], "groups")
    places = staged(named.join(before, ["key", "part"]).select(
        F.col("id").alias("key"), "leaves", (F.col("before") + F.col("place")).alias("nth"), F.col("n").alias("groups")), "places")
    known = places.agg(F.max("leaves"), F.max("groups")).first()
    most, groups = known[0] or 0, known[1] or 0

    counts = counts.join(places.select("key", "nth"), "key")
    leaves = staged(dealt.join(counts, ["key", "part"]).select(
        "key", "id", (F.col("before") + F.col("place")).alias("position"), "leaf", "shown", "n", "nth"), "positions")
    lower = trees(leaves.select("key", F.lit(0).alias("level"), F.col("position").alias("at"),
                                F.col("n").alias("width"), F.col("leaf").alias("hash")), height(most), "nodes", bits)
    subroots = staged(lower.where("width = 1").join(places, "key").select(
        F.lit(TOP).alias("key"), F.lit(0).alias("level"), F.col("nth").alias("at"),
        F.col("groups").alias("width"), "hash"), "subroots")
    upper = trees(subroots, height(groups), "top-nodes", bits)
    root = upper.where("width = 1").select("hash").first()
    return Manifest(leaves, lower.union(upper).select("key", "level", "at", "hash"), groups, root[0] if root else None, bits)


def missing(positions: np.ndarray, width: int) -> list[tuple[int, int]]:
    """(level, at) of the nodes that the paths of ``positions`` need and cannot derive from each other."""
    level, known, out = 0, np.unique(positions), []
    while width > 1:
        beside = known ^ 1
        beside = beside[(beside < width) & ~np.isin(beside, known)]
        out.extend((level, int(at)) for at in beside)
        level, width, known = level + 1, (width + 1) // 2, np.unique(known >> 1)
    return out


def _requests(groups: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        key, block = frame["key"].iat[0], int(frame["block"].iat[0])
        own = missing(frame["position"].to_numpy(np.int64), int(frame["n"].iat[0]))
        top = missing(frame["nth"].to_numpy(np.int64)[:1], groups)
        out = [(key, block, key, level, at) for level, at in own] + [(key, block, TOP, level, at) for level, at in top]
        return pd.DataFrame(out, columns=["owner", "block", "key", "level", "at"])
    return run


class Paths:
    """The paths of some leaves of one tree: siblings level by level, inner nodes derived once for all."""

    def __init__(self, positions: np.ndarray, hashes: list[str], width: int, fetched: dict[tuple[int, int], str]):
        at, first = np.unique(positions, return_index=True)
        held = [hashes[i] for i in first]
        mine = np.searchsorted(at, positions)      # leaf -> node on this level
        self.steps: list[tuple[np.ndarray, list, np.ndarray]] = []   # node of each leaf, siblings, nodes
        level = 0
        while width > 1:
            known = dict(zip(at.tolist(), held))
            beside = [None if (s := a ^ 1) >= width else known[s] if s in known else fetched[level, s] for a in at.tolist()]
            self.steps.append((mine, beside, at))
            up = [digest((h if s is None else h + s) if a % 2 == 0 else s + h) for a, h, s in zip(at.tolist(), held, beside)]
            at, first, back = np.unique(at >> 1, return_index=True, return_inverse=True)
            held, mine = [up[i] for i in first], back[mine]
            level, width = level + 1, (width + 1) // 2
        self.root = held[0]

    def siblings(self, leaf: int) -> list[tuple[str | None, bool]]:
        """(sibling or None, whether it lies left) on every level."""
        return [(beside[mine[leaf]], bool(at[mine[leaf]] & 1)) for mine, beside, at in self.steps]


def fold(leaf: str, path: list[tuple[str | None, bool]]) -> str:
    for sibling, left in path:
        leaf = digest(leaf if sibling is None else sibling + leaf if left else leaf + sibling)
    return leaf


def _expand(groups: int):
    def run(leaves: pd.DataFrame, nodes: pd.DataFrame) -> pd.DataFrame:
        columns = ["id", "leaf", "subroot", "proof_sha256", "folded_root"]
        if leaves.empty:
            return pd.DataFrame(columns=columns)
        own, top = ({(level, at): h for key, level, at, h in zip(nodes["node"], nodes["level"], nodes["at"], nodes["hash"])
                     if (key == TOP) == wanted} for wanted in (False, True))
        hashes = leaves["leaf"].tolist()
        tree = Paths(leaves["position"].to_numpy(np.int64), hashes, int(leaves["n"].iat[0]), own)
        over = Paths(leaves["nth"].to_numpy(np.int64)[:1], [tree.root], groups, top)
        above = over.siblings(0)
        out = []
        for i, (leaf, shown) in enumerate(zip(hashes, leaves["shown"])):
            path = tree.siblings(i) + above
            proof = digest("".join(s for s, _ in path if s is not None))
            # What is shown unchanged folds into the nodes that all leaves of the block share.
            out.append((leaf, tree.root, proof, over.root if pd.isna(shown) else fold(shown, path)))
        return pd.DataFrame(out, columns=columns[1:]).assign(id=leaves["id"].to_numpy())[columns]
    return run


def verify(manifest: Manifest, chosen: DataFrame | None = None) -> DataFrame:
    """id, leaf, subroot, root, proof_sha256, folded_root and verified of the chosen leaves (default: all).

    ``chosen`` holds rows of ``manifest.leaves``. ``proof_sha256`` hashes the leaf's siblings from the bottom
    of its group's tree to the dataset's root; ``folded_root`` is what the shown leaf and these siblings give,
    and ``verified`` whether that is the root. Fetched are the nodes that a block of leaves cannot derive.
    """
    block = F.shiftright("position", manifest.bits).alias("block")
    leaves = (manifest.leaves if chosen is None else chosen).withColumn("block", block)
    kind = dict(leaves.dtypes)["id"]
    # As text: pandas would turn whole numbers beside a null into doubles.
    leaves = leaves.withColumn("id", F.col("id").cast("string"))
    wanted = staged(leaves.select("key", "block", "position", "n", "nth").groupBy("key", "block").applyInPandas(
        _requests(manifest.groups), "owner string, block long, key string, level int, at long"), "requests")
    lowest = wanted.where(F.col("key") != TOP).agg(F.min("level")).first()[0]
    # Nodes below the lowest one asked for need not be read.
    nodes = manifest.nodes.where((F.col("key") == TOP) | (F.col("level") >= (0 if lowest is None else lowest)))
    fetched = wanted.join(nodes, ["key", "level", "at"]).select(
        F.col("owner").alias("key"), "block", F.col("key").alias("node"), "level", "at", "hash")
    proofs = leaves.groupBy("key", "block").cogroup(fetched.groupBy("key", "block")).applyInPandas(
        _expand(manifest.groups), "id string, leaf string, subroot string, proof_sha256 string, folded_root string")
    root = F.lit(manifest.root).cast("string")
    return proofs.select(F.col("id").cast(kind).alias("id"), "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
                         (F.col("folded_root") == root).alias("verified"))
