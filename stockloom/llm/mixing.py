"""Mixing sources to target weights by Poisson replication.

A source's target repetition rate is its share of the mixture times the wished size over its own
size. Each document draws its number of copies from a Poisson distribution with that mean, by
inverting the distribution at a number in [0, 1) hashed from the seed and the document, so the draw
needs no state, is the same in every run, and no source is sorted or counted document by document.
Copies are then dealt out and ordered by a second hash: one shuffle mixes everything globally.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stockloom.llm.common import seeded_hash, small, staged, text_of, unit_interval

SEED = 11
SMOOTHING = 0.5     # weight of a source without given weights: its size to this power
MOST_REPEATS = 1000.0  # a higher mean repetition rate is an error of the mixture, not cut


def source_key() -> Column:
    return F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))


def repetition_rates(docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0,
                     smoothing: float = SMOOTHING) -> DataFrame:
    """(_source, rate): mean copies of a document, so that the mixture has ``epochs`` times the input's size.

    ``weights`` has (source, weight), one row per source, any positive scale; a source it does not
    name gets rate 0. Without it a source weighs its size to the power ``smoothing``. Sizes are bytes
    of the texts plus one per document, so sources of empty texts have a size too.
    """
    sizes = docs.groupBy(source_key().alias("_source")).agg(
        F.sum(F.octet_length(text_of()).cast("long") + 1).alias("size"))
    if weights is None:
        weighed = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(smoothing)))
    else:
        given = weights.groupBy(source_key().alias("_source")).agg(F.sum("weight").cast("double").alias("weight"))
        weighed = sizes.join(given, "_source", "left").fillna(0.0, ["weight"])
    # One row per source.
    everything = W.partitionBy(F.lit(0))
    rate = F.col("weight") / F.sum("weight").over(everything) * epochs * F.sum("size").over(everything) / F.col("size")
    return weighed.select("_source", F.coalesce(rate, F.lit(0.0)).alias("rate"))


def poisson_steps(rates: DataFrame) -> DataFrame:
    """(_source, steps): the Poisson distribution function at 0, 1, 2, ... as far as doubles tell it from 1.

    Terms are exponentials of logarithms, so large means do not underflow.
    """
    reach = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    checked = F.when(F.col("rate") > MOST_REPEATS, F.raise_error(F.concat(
        F.lit("repetition rate over the allowed "), F.lit(str(MOST_REPEATS)), F.lit(" for source "), F.col("_source"))).cast("int")
    ).otherwise(reach)
    terms = rates.where("rate > 0").select("_source", "rate", F.explode(F.sequence(F.lit(0), checked)).alias("k"))
    upto = W.partitionBy("_source").orderBy("k")
    log_factorial = F.sum(F.log(F.greatest("k", F.lit(1)).cast("double"))).over(upto)
    terms = terms.withColumn("p", F.exp(F.col("k") * F.log("rate") - F.col("rate") - log_factorial))
    return terms.withColumn("below", F.sum("p").over(upto)).groupBy("_source").agg(
        F.array_sort(F.collect_list("below")).alias("steps"))


def mix_sources(docs: DataFrame, weights: DataFrame | None = None, epochs: float = 1.0,
                smoothing: float = SMOOTHING, seed: int = SEED) -> DataFrame:
    """Documents repeated to the target weights and globally shuffled.

    Returns the columns of ``docs`` plus ``copy`` (1, 2, ... of one row) and ``shuffle_key``, whose
    order is the mixed order; input columns of these names are replaced. Rows of each output partition
    are sorted by the key and partitions are random samples of the mixture. Null sources are a source
    of their own. A document draws by its id, one without an id by its text; rows that agree in this
    draw alike. No rows: no rows.
    """
    rates = staged(poisson_steps(repetition_rates(docs, weights, epochs, smoothing)), "mixture")
    kept = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    mark = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text "), text_of()))
    row = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"), source_key().alias("_source"), mark.alias("_mark"))
    drawn = row.join(small(rates, 10_000), "_source").withColumn("_u", unit_interval(seeded_hash(seed, F.lit("draw"), F.col("_mark"))))
    times = F.size(F.filter("steps", lambda below: below <= F.col("_u")))
    copies = drawn.withColumn("_times", times).where("_times > 0").select(
        "_row", "_mark", F.explode(F.sequence(F.lit(1), F.col("_times"))).alias("copy"))
    keyed = copies.select("_row.*", "copy", seeded_hash(seed, F.lit("place"), F.col("copy"), F.col("_mark")).alias("shuffle_key"))
    return keyed.repartition("shuffle_key").sortWithinPartitions("shuffle_key")
