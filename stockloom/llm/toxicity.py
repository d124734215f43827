"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

A document is the set of hashed character n-grams of its lower-cased text. From labelled documents the
log ratio of an n-gram's smoothed frequency among toxic and other documents is taken; features are
presence times that ratio, and a logistic regression on them (MLlib) gives the weights. At scoring
time ratio and weight are one number per n-gram, looked up by hash for whole batches of texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.llm.common import seeded_hash, small, staged, unit_interval

SEED = 47
GRAMS = (4, 5, 6)
BITS = 20                # n-grams hash to 2**BITS numbers
SAMPLE = 3000            # labelled documents of each class that the fit reads at most, about
FEATURES = 4096          # n-grams kept: those whose ratio tells most over the sample
MIN_DOCUMENTS = 5        # an n-gram in fewer sampled documents is not kept
REGULARISATION = 0.002
THRESHOLD = 0.3
PART = 1 << 21           # characters hashed at once; long texts take several parts


def gram_hashes(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n characters that start at each position (the last n - 1 positions have none)."""
    mixed = codes.astype(np.uint64)
    held = np.full(len(mixed) - n + 1, np.uint64(n))
    for i in range(n):
        held = held * np.uint64(0x9E3779B97F4A7C15) + mixed[i:len(mixed) - n + 1 + i] + np.uint64(1)
    held ^= held >> np.uint64(31)
    held *= np.uint64(0xBF58476D1CE4E5B9)
    return (held >> np.uint64(64 - BITS)).astype(np.int32)


def present(texts: list[str | None], wanted: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct hashes in it) of whole texts; ``wanted``: table of the hashes to keep.

    Texts are laid end to end with a separator, so one vectorised pass serves many short texts, and
    long ones are cut into overlapping parts whose sets are united.
    """
    def parts():
        row_ids, codes, used = [], [], 0
        for row, text in enumerate(texts):
            text = f" {(text or '').lower()} "
            for start in range(0, max(1, len(text) - max(GRAMS) + 1), PART):
                piece = np.frombuffer(text[start:start + PART + max(GRAMS) - 1].encode("utf-32-le", "replace"), np.uint32)
                row_ids.append(row)
                codes.append(piece)
                used += len(piece)
                if used >= PART:
                    yield row_ids, codes
                    row_ids, codes, used = [], [], 0
        if codes:
            yield row_ids, codes

    for row_ids, codes in parts():
        lengths = np.array([len(c) for c in codes])
        rows = np.repeat(np.array(row_ids, np.int64), lengths)
        flat, pairs = np.concatenate(codes), []
        for n in GRAMS:
            if len(flat) < n:
                continue
            hashes, owner = gram_hashes(flat, n), rows[:len(flat) - n + 1]
            keep = owner == rows[n - 1:]
            if wanted is not None:
                keep &= wanted[hashes]
            pairs.append((owner[keep] << BITS) | hashes[keep])
        distinct = np.unique(np.concatenate(pairs)) if pairs else np.empty(0, np.int64)
        owners = distinct >> BITS
        cuts = np.flatnonzero(np.diff(owners)) + 1
        for group in np.split(distinct, cuts):
            if len(group):
                yield int(group[0] >> BITS), (group & ((1 << BITS) - 1)).astype(np.int32)


@dataclass
class Model:
    """Weights of the kept n-gram hashes; scores are logistic. ``constant``: score of everything, if not fitted."""
    hashes: np.ndarray
    weights: np.ndarray
    intercept: float
    constant: float | None = None


def united(texts: list[str | None], wanted: np.ndarray | None) -> list[np.ndarray]:
    sets: list[np.ndarray] = [np.empty(0, np.int32)] * len(texts)
    for row, hashes in present(texts, wanted):
        sets[row] = hashes if not len(sets[row]) else np.union1d(sets[row], hashes)
    return sets


def _hash_sets(wanted: np.ndarray | None):
    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = None
        if wanted is not None:
            table = np.zeros(1 << BITS, bool)
            table[wanted] = True
        for texts in parts:
            yield pd.Series(united(list(texts), table))
    return run


def fit(labelled: DataFrame, labels: DataFrame, sample: int = SAMPLE, seed: int = SEED) -> Model:
    """Fit on about ``sample`` labelled documents of each class, drawn by the hash of their id.

    ``labelled``: (doc_id, text); ``labels``: (doc_id, toxic), null labels left out, of repeated labels
    of an id the largest counts. The sample is bounded, hence its ids may be broadcast and the texts
    need no shuffle. Class weights restore the classes' shares among all labels. Without both classes
    the model is the constant share of toxic labels (0 without labels).
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model(np.empty(0, np.int32), np.empty(0), 0.0, float(bool(sizes.get(1))))
    share = F.when(F.col("toxic") == 1, sample / sizes[1]).otherwise(sample / sizes[0])
    drawn = known.where(unit_interval(seeded_hash(seed, F.col("doc_id").cast("string"))) < share).limit(4 * sample)
    texts = staged(labelled.join(small(drawn), "doc_id").select("text", "toxic"), "toxic-sample")
    rows = staged(texts.repartition(12).select("toxic", _hash_sets(None)("text").alias("grams")), "toxic-grams")
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not totals.get(0) or not totals.get(1):
        return Model(np.empty(0, np.int32), np.empty(0), 0.0, sizes[1] / (sizes[0] + sizes[1]))
    counts = rows.select("toxic", F.explode("grams").alias("gram")).groupBy("gram").agg(
        F.sum("toxic").alias("bad"), F.count("*").alias("all"))
    bad, good = (F.col("bad") + 1) / (totals[1] + 2), (F.col("all") - F.col("bad") + 1) / (totals[0] + 2)
    # How much the n-gram shifts the log odds over the sample.
    tells = F.abs(F.log(bad / good)) * F.abs(bad - good)
    top = counts.where(F.col("all") >= MIN_DOCUMENTS).orderBy(tells.desc(), "gram").limit(FEATURES).select(
        "gram", F.log(bad / good).alias("ratio")).collect()
    if not top:
        return Model(np.empty(0, np.int32), np.empty(0), 0.0, sizes[1] / (sizes[0] + sizes[1]))
    hashes, ratios = np.array([r["gram"] for r in top], np.int32), np.array([r["ratio"] for r in top])
    order = np.argsort(hashes)
    hashes, ratios = hashes[order], ratios[order]

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def scaled(grams: pd.Series) -> pd.Series:
        out = []
        for held in grams:
            row = np.zeros(len(hashes), np.float32)
            at = np.searchsorted(hashes, held)
            at = at[(at < len(hashes)) & (hashes[np.minimum(at, len(hashes) - 1)] == held)]
            row[at] = ratios[at]
            out.append(row)
        return pd.Series(out)

    weight = F.when(F.col("toxic") == 1, sizes[1] / totals[1]).otherwise(sizes[0] / totals[0])
    training = staged(rows.select(F.col("toxic").cast("double").alias("label"), weight.alias("weight"),
                                  scaled("grams").alias("features")), "toxic-features")
    vectors = training.select("label", "weight", array_to_vector("features").alias("features"))
    fitted = LogisticRegression(weightCol="weight", regParam=REGULARISATION, standardization=False, maxIter=40).fit(vectors)
    return Model(hashes, fitted.coefficients.toArray() * ratios, float(fitted.intercept))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score (0 to 1, higher: likelier toxic) and predicted (1 from ``threshold`` on).

    Whole texts are scored; null and empty texts get the score of a text without features. Input
    columns of these names are replaced, all others stay; no rows: no rows.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]

    @F.pandas_udf(T.DoubleType())
    def odds(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        wanted, weights = np.zeros(1 << BITS, bool), np.zeros(1 << BITS, np.float64)
        wanted[model.hashes] = True
        weights[model.hashes] = model.weights
        for texts in parts:
            if model.constant is not None:
                yield pd.Series([model.constant] * len(texts), dtype=float)
                continue
            sums = np.array([weights[s].sum() for s in united(list(texts), wanted)]) + model.intercept
            yield pd.Series(1 / (1 + np.exp(-np.clip(sums, -500, 500))))

    scored = docs.select(*(F.col(f"`{c}`") for c in kept), odds("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
