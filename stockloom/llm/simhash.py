"""SimHash near-duplicates, found through deletion-variant signatures.

A 64-bit fingerprint takes the majority of the hash bits of a text's word shingles. Two fingerprints
that differ in at most three bits agree, in one of their two 32-bit segments, up to a single bit.
Each segment is therefore indexed under its 32 one-wildcard variants (one bit deleted): 64 index
entries for a fingerprint, and every linked pair meets in at least one of them. Candidates are
verified on all 64 bits, and classes are the connected components of the links.

Only distinct fingerprints are indexed, so thousands of copies are one entry. A bucket yields at most
one link fewer than it has fingerprints (a spanning forest of its verified links), never all pairs;
buckets over ``BLOCK`` fingerprints are verified block against block in tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stockloom.llm.common import blocks, staged
from stockloom.llm.components import components

WORDS = 3
BITS = 3      # largest number of differing bits of a link
SEGMENTS = 2  # 2 segments hold 3 differing bits with at most one in one of them
HASH_SEED = 42
BLOCK = 2048


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """Majority bits of the shingles' XXH64 over lower-cased (A-Z) words; 0 without words."""
    tokens = text.lower().split()  # on bytes: A-Z only, and the six ASCII separators
    if not tokens:
        return 0
    width = min(words, len(tokens))
    totals, n = np.zeros(64, np.int64), len(tokens) - width + 1
    step = 1 << 18
    for start in range(0, n, step):
        part = tokens[start:start + step + width - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(width))))
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, HASH_SEED) for s in shingles), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        totals += bits.sum(axis=0, dtype=np.int64)
    majority = np.packbits(totals * 2 > n, bitorder="little")
    return int(majority.view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row as a signed 64-bit number; null texts give 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            values = [fingerprint((t or "").encode(), words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.int64())], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, fp long")


def spanning_links(left: np.ndarray, right: np.ndarray | None = None, bits: int = BITS) -> list[tuple[int, int]]:
    """A spanning forest of the pairs that differ in at most ``bits`` bits, within one array or between two."""
    values = left if right is None else np.concatenate([left, right])
    unsigned = values.view(np.uint64)
    split, root, links = len(left), np.arange(len(values)), []

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(split):
        start = i + 1 if right is None else split
        near = np.flatnonzero(np.bitwise_count(unsigned[start:] ^ unsigned[i]) <= bits) + start
        for j in near.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[b] = a
                links.append((int(values[i]), int(values[j])))
    return links


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: links of small buckets, and the rows of large ones for a second step.

    Output: (u, v, bucket); bucket is null for a link, else u is a fingerprint of that large bucket.
    """
    def emit(links, large):
        if not links and not large:
            return None
        rows = links + large
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["u", "v", "bucket"])

    held: list[np.ndarray] = []
    held_rows, current, overfull = 0, None, False
    links: list = []
    large: list = []

    def close():
        nonlocal held, held_rows, overfull
        if overfull:
            large.extend((int(x), None, current) for part in held for x in part)
        elif held_rows > 1:
            links.extend((u, v, None) for u, v in spanning_links(np.concatenate(held)))
        held, held_rows, overfull = [], 0, False

    for batch in batches:
        keys = batch.column("bucket").to_numpy(zero_copy_only=False)
        values = batch.column("fp").to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(np.diff(keys)) + 1
        starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(keys)]])
        # Inside the batch, buckets of one row need no look and those of two are compared at once.
        border = (starts == 0) | (ends == len(keys))
        u, v = (values[starts[(ends - starts == 2) & ~border] + k] for k in (0, 1))
        near = np.bitwise_count(u.view(np.uint64) ^ v.view(np.uint64)) <= BITS
        links.extend((a, b, None) for a, b in zip(u[near].tolist(), v[near].tolist()))
        worth = (ends - starts > 2) | border
        for s, e in zip(starts[worth].tolist(), ends[worth].tolist()):
            key = int(keys[s])
            if key != current:
                close()
                current = key
            held.append(values[s:e])
            held_rows += e - s
            if held_rows > BLOCK:  # pass a large bucket on bit by bit
                overfull = True
                large.extend((int(x), None, current) for part in held for x in part)
                held, held_rows = [], 0
        if (out := emit(links, large)) is not None:
            yield out
        links, large = [], []
    close()
    if (out := emit(links, large)) is not None:
        yield out


def links(distinct: DataFrame) -> DataFrame:
    """(u, v): links between distinct fingerprints ``fp`` that keep every class connected."""
    segment = F.when(F.col("_k") < 32, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND(0xFFFFFFFF))
    wildcard = F.expr("shiftleft(1L, int(_k % 32))")
    variant = F.shiftleft(F.col("_k").cast("long"), 32).bitwiseOR(
        segment.bitwiseAND(F.bitwise_not(wildcard)))
    index = distinct.select("fp", F.explode(F.sequence(F.lit(0), F.lit(32 * SEGMENTS - 1))).alias("_k")).select(
        variant.alias("bucket"), "fp")
    found = staged(index.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _bucket_links, "u long, v long, bucket long"), "links")

    # Large buckets: their fingerprints fall into chunks, and each pair of chunks is one group.
    large = found.where("bucket is not null").select("bucket", F.col("u").alias("fp"))
    chunks = large.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    dealt = large.join(chunks, "bucket").withColumn("_c", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    cells = dealt.select("bucket", "fp", "_c", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("_d")).select(
        "bucket", "fp", "_c", F.least("_c", "_d").alias("a"), F.greatest("_c", "_d").alias("b"))

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        values, mine = group["fp"].to_numpy(np.int64), group["_c"].to_numpy()
        if group["a"].iat[0] == group["b"].iat[0]:
            pairs = spanning_links(values)
        else:
            first = mine == group["a"].iat[0]
            pairs = spanning_links(values[first], values[~first])
        return pd.DataFrame(pairs, columns=["u", "v"], dtype="int64")

    return found.where("bucket is null").select("u", "v").union(
        cells.groupBy("bucket", "a", "b").applyInPandas(verify, "u long, v long"))


def _classes(known: DataFrame) -> DataFrame:
    """(fp, root): the class of every fingerprint of ``known``, named by one of its fingerprints."""
    distinct = known.select("fp").distinct()
    roots = components(links(distinct))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (smallest doc_id of the class) of every row.

    Null and empty texts have fingerprint zero and are linked like others. Rows with the same doc_id are
    separate rows of one id; null ids never name a class unless all its ids are null. Input columns
    other than doc_id and text are dropped. No rows: no rows.
    """
    known = staged(fingerprints(docs, words), "fingerprints")
    distinct = known.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = distinct.join(_classes(known), "fp")
    classes = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.join(classes, "root").select("fp", "component_id")
    return known.join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """One row of each class, the one with the smallest doc_id, then the smallest text hash; all input columns stay.

    Rows are judged by their own text: a repeated doc_id loses only the rows whose class has an earlier one.
    Rows without an id come last in their class, so one stays only if no row of the class has an id. Null and empty
    texts are one class. Of rows equal in id and text one stays. No rows: no rows.
    """
    mark = F.xxhash64("text")
    known = staged(fingerprints(docs.withColumns({"doc_id": F.struct(
        F.col("doc_id").isNull().alias("without"), F.col("doc_id").alias("id"), mark.alias("mark"))}), words), "fingerprints")
    first = known.groupBy("fp").agg(F.min("doc_id").alias("first"))
    kept = staged(first.join(_classes(known), "fp").groupBy("root").agg(F.min("first").alias("first")).select(
        F.col("first.id").alias("keep_id"), F.col("first.mark").alias("keep_mark")), "kept")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("id"), mark.alias("mark"))
    rows = rows.join(kept, F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("mark") == F.col("keep_mark")), "left_semi")
    if known.groupBy("doc_id").count().where("count > 1").limit(1).count():   # equal in id and text: a window over few rows
        rows = rows.withColumn("nth", F.row_number().over(W.partitionBy("id", "mark").orderBy("mark"))).where("nth = 1")
    return rows.select("row.*")
