"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within their stratum and get the fractional rank
(rank - 1/2) / rows of the stratum. Sorted by that rank the strata are interleaved in proportion,
so equal cuts of the order give shards that all match the mixture and differ by one row at most.

Both ranks are found without a global sort: rows fall into hash (or rank) buckets, the buckets are
counted, running totals of the counts give each bucket's offset, and rows are numbered inside their
bucket only. A stratum with a third of all rows is spread over all hash buckets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stockloom.llm.common import seeded_hash, staged, text_of, unit_interval

BUCKETS = 4096  # of hash and of rank; a task sorts about rows / BUCKETS rows at once
SEED = 20


def interleave(rows: DataFrame, stratum: str, tie: list[str], shards: int = 8, buckets: int = BUCKETS,
               seed: int = SEED) -> DataFrame:
    """``rows`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    ``tie`` names the columns that tell rows apart: their values seed the shuffle and break ties, so
    rows equal in all of them are interchangeable. Null strata are one stratum of their own, null tie
    values are values like others; input columns named ``shard`` or ``slot`` are replaced. No rows: no
    rows. The input is read several times, hence pass a stored or narrow table.
    """
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    key = F.when(F.col(f"`{stratum}`").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(f"`{stratum}`").cast("string")))
    marks = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in tie]
    base = rows.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"), key.alias("_stratum"),
        seeded_hash(seed, *marks).alias("_hash"), F.struct(*(F.col(f"`{c}`") for c in tie)).alias("_tie"),
    ).withColumn("_bucket", F.floor(unit_interval(F.col("_hash")) * buckets))

    counts = base.groupBy("_stratum", "_bucket").agg(F.count("*").alias("_n"))
    in_stratum = W.partitionBy("_stratum")
    offsets = counts.select(
        "_stratum", "_bucket", F.sum("_n").over(in_stratum).alias("_of"),
        F.coalesce(F.sum("_n").over(in_stratum.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = W.partitionBy("_stratum", "_bucket").orderBy("_hash", "_tie")
    ranked = base.join(offsets, ["_stratum", "_bucket"]).withColumn(
        "_rank", F.col("_before") + F.row_number().over(within)
    ).withColumn("_part", (2 * F.col("_rank") - 1) / (2 * F.col("_of")))
    ranked = staged(ranked.select("_row", "_stratum", "_hash", "_tie", "_part",
                                  F.floor(F.col("_part") * buckets).alias("_cell")), "interleave")

    # At most ``buckets`` rows: the running total over them is one small task.
    cells = ranked.groupBy("_cell").agg(F.count("*").alias("_n"))
    starts = cells.select(
        "_cell", F.coalesce(F.sum("_n").over(W.orderBy("_cell").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
        F.sum("_n").over(W.partitionBy(F.lit(0))).alias("_all"))
    place = F.col("_start") + F.row_number().over(W.partitionBy("_cell").orderBy("_part", "_hash", "_stratum", "_tie")) - 1
    placed = ranked.join(F.broadcast(starts), "_cell").withColumn("_place", place)
    return placed.withColumn("shard", F.expr(f"int(_place * {shards} div _all)")).select(
        "_row.*", "shard", (F.col("_place") - F.expr(f"(shard * _all + {shards - 1}) div {shards}")).alias("slot"))


def shard_documents(docs: DataFrame, shards: int = 8, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size (bytes of the text plus 1), text_crc32, shard, slot.

    Strata are the sources. Null texts count as empty; repeated rows get different slots. The text
    itself is not moved; columns other than doc_id, text and source are not read.
    """
    light = docs.select(
        "doc_id", "source", (F.octet_length(text_of()).cast("long") + 1).alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"))
    placed = interleave(staged(light, "shard-sizes"), "source", ["doc_id", "text_crc32", "size"], shards, seed=seed)
    return placed.select("doc_id", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, folder: str, shards: int = 8, seed: int = SEED) -> None:
    """Write whole documents below ``folder``, one sub-folder per shard, files sorted by slot."""
    tie = [c for c in docs.columns if c in ("doc_id", "text")]
    placed = interleave(docs, "source", tie, shards, seed=seed)
    placed.repartition("shard", F.floor(F.col("slot") / 100_000)).sortWithinPartitions("shard", "slot") \
        .write.partitionBy("shard").parquet(folder)
