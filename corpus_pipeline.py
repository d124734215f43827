"""Corpus pipeline: language ID, near-dedup, substring dedup, mixing and packing, each over what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm import langid, mixing, packing, simhash, substring
from stockloom.llm.common import id_remainder, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart clearly; null, empty, letterless and ambiguous texts go.

    Rows are judged one by one, so repeated rows and ids stay as often as they come; without rows there are none.
    Every stage reads the columns of documents, whatever others stand beside them, and returns just these.
    """
    learned = docs.where(id_remainder(5) != 0).select("doc_id", "text", "lang")
    return langid.identify(docs, langid.fit_dictionaries(learned)).where("accepted").select(COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: the least id, then the least text hash.

    A repeated id loses only rows whose group has an earlier one; rows without an id come last in their group; null
    and empty texts are one group; without rows there are none.
    """
    return simhash.drop_near_duplicates(docs).select(COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of repeated passages go; documents of which nothing is left go, too.

    Rows without a repeated passage stay as they are, null texts included; equal rows repeat each other; n_chars is
    counted anew where a text was cut; without rows there are none.
    """
    kept = substring.remove_repeats(docs).where("n_removed = 0 or length(kept_text) > 0")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return kept.withColumn("text", text).withColumn(
        "n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])).select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in mixed order.

    The null source is a source of its own; equal rows get the same number of copies; null texts count as empty;
    without rows there are none.
    """
    return mixing.mix_sources(docs).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 ids; a null or empty text is its end mark alone, without rows there are none."""
    return packing.pack_documents(docs, with_ids=False)


STAGES = [
    ("language ID", keep_identified),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("mixing", mix),
    ("packing", pack),
]

# Compression, SimHash and byte-pair encoding have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, name.replace(" ", "-"))
    return docs
