"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.session import scratch_path

# A side is broadcast only after its rows were counted and are at most this many.
BROADCAST_ROWS = 200_000


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it again: the plan is cut and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most`` rows, else as it is (Spark shuffles it)."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def id_remainder(divisor: int, column: str = "doc_id") -> Column:
    """crc32 of the id's decimal text, modulo ``divisor`` (null ids count as empty text)."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % divisor


def seeded_hash(seed: int, *parts: Column) -> Column:
    """32 hexadecimal digits that depend on the seed and the parts alone."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def unit_interval(hexadecimal: Column) -> Column:
    """The first 13 hexadecimal digits as a number in [0, 1)."""
    return F.conv(F.substring(hexadecimal, 1, 13), 16, 10).cast("double") / float(16**13)


def give_back() -> None:
    """Return freed memory to the system: a Python worker is kept for later stages, which need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # where the C library has it
    if trim:
        trim(0)


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", most_bytes: int = 4 << 20
           ) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about ``most_bytes`` (one row at least)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = used = 0
        for i, n in enumerate(lengths):
            if i > start and used + n > most_bytes:
                yield batch.slice(start, i - start)
                start, used = i, 0
            used += int(n)
        if len(lengths) > start:
            yield batch.slice(start)
    give_back()
