"""Language identification by compression.

Each language has a zstandard raw-content dictionary cut from its own texts. A text is compressed once
with every dictionary; the one that leaves the fewest bytes names the language. Texts are compressed in
chunks, so that the dictionary helps with every part of a long text and no part is skipped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from stockloom.llm.common import give_back, seeded_hash, unit_interval

SEED = 31
DICTIONARY_BYTES = 112_640  # of one language
SLICE = 500                 # characters taken from one training text
SAMPLE = 2 * DICTIONARY_BYTES // SLICE  # training texts of one language; the fit reads no more
MOST_LANGUAGES = 256
LEVEL = 9
CHUNK = 8192                # bytes compressed at once
SHORT = 200                 # texts of so many bytes are compressed with each slice of the dictionaries
SLICES = 8
MIN_MARGIN = 0.002          # smaller relative margins are rejected
UNKNOWN = "und"


def fit_dictionaries(labelled: DataFrame, sample: int = SAMPLE, seed: int = SEED) -> dict[str, bytes]:
    """Dictionary bytes by language from (doc_id, text, lang), without rows of null text or language.

    A bounded sample: of every language about ``sample`` rows with the smallest hash of their id, and
    ``SLICE`` characters of each. The driver holds at most MOST_LANGUAGES * sample * SLICE characters;
    more languages than that are an error.
    """
    rows = labelled.where("text is not null and lang is not null and length(trim(text)) > 0")
    sizes = rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    if not sizes:
        return {}
    share = F.lit(1.0)
    for size in sizes:
        share = F.when(F.col("lang") == size["lang"], F.lit(2.0 * sample / size["count"])).otherwise(share)
    mark = F.coalesce(F.col("doc_id").cast("string"), F.col("text"))
    drawn = rows.select("lang", F.substring("text", 1, SLICE).alias("text"), seeded_hash(seed, mark).alias("h")
                        ).where(unit_interval(F.col("h")) < share)
    first = W.partitionBy("lang").orderBy("h", "text")
    texts = drawn.withColumn("n", F.row_number().over(first)).where(F.col("n") <= sample).orderBy("lang", "n").collect()
    found: dict[str, bytes] = {}
    for row in texts:
        found[row["lang"]] = found.get(row["lang"], b"") + row["text"].lower().encode() + b"\n"
    # The end of a dictionary is the nearest and cheapest to refer to; any even cut will do here.
    return {lang: content[:DICTIONARY_BYTES] for lang, content in found.items()}


class Identifier:
    """The compressors of a process; made once per task.

    Sizes are whole bytes, so short texts often tie. Their sizes are added up over SLICES parts of each
    dictionary, which are that many independent looks at the language.
    """

    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL):
        def compressor(content: bytes) -> zstandard.ZstdCompressor:
            held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(level=level)
            return zstandard.ZstdCompressor(
                dict_data=held, level=level, write_checksum=False, write_content_size=False, write_dict_id=False)

        def slices(content: bytes) -> list[bytes]:
            step = -(-len(content) // SLICES)
            return [content[i:i + step] for i in range(0, len(content), step) if content[i:i + step].strip()]

        self.whole = [(lang, [compressor(content)]) for lang, content in sorted(dictionaries.items())]
        # A language of little text has few slices; all languages use as many.
        parts = {lang: slices(content) for lang, content in sorted(dictionaries.items())}
        count = min(map(len, parts.values()), default=0)
        self.sliced = [(lang, [compressor(x) for x in held[:count]]) for lang, held in parts.items()]

    def __call__(self, text: str | None) -> tuple[str, float]:
        """(language, relative margin of the best dictionary over the second best)."""
        if not text or not self.whole or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        data = text.lower().encode("utf-8", "replace")
        chunks = [data[i:i + CHUNK] for i in range(0, len(data), CHUNK)]
        chosen = self.sliced if len(data) <= SHORT else self.whole
        sizes = sorted((sum(len(c.compress(chunk)) for chunk in chunks for c in held), lang) for lang, held in chosen)
        if len(sizes) == 1:
            return sizes[0][1], 1.0
        return sizes[0][1], (sizes[1][0] - sizes[0][0]) / sizes[1][0]


def identify(docs: DataFrame, dictionaries: dict[str, bytes], min_margin: float = MIN_MARGIN) -> DataFrame:
    """``docs`` with lang_pred, score (relative margin, 0 to 1) and accepted; such input columns are replaced.

    Null texts, texts without a letter and everything when no language was learned are ``und`` with
    score 0. Equal sizes go to the first language by name. ``accepted`` is false for ``und`` and for
    margins under ``min_margin``; lang_pred is given all the same. Whole texts are compressed.
    """
    added = ("lang_pred", "score", "accepted")
    kept = [c for c in docs.columns if c not in added]
    schema = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(schema)
    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        name = Identifier(dictionaries)
        for texts in parts:
            yield pd.DataFrame([name(t) for t in texts], columns=["lang_pred", "score"])
        del name
        give_back()

    # The row goes along as one struct, so that no name of its columns meets ours.
    named = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), predict("text").alias("named"))
    accepted = (F.col("named.lang_pred") != UNKNOWN) & (F.col("named.score") >= min_margin)
    return named.select("row.*", "named.lang_pred", "named.score", accepted.alias("accepted"))
