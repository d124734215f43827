"""I-Match document fingerprints, in DataFrame functions only.

The lexicon holds the terms of a band of inverse document frequency: not so common that most texts have
them, not so rare that a single edit decides. Both ends are shares of the documents, so the band is the same at
every size. A text keeps its distinct lexicon terms, sorted; for each of several randomised lexicon subsets the kept
terms of that subset are hashed. Equal texts agree in every subset, edited ones in those that the edit did not touch.

Texts' terms are exploded where the text lies and joined with the lexicon, which is broadcast only after its rows were
counted: it has at most the mean number of distinct terms of a text, divided by ``RARE``.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stockloom.llm.common import BROADCAST_ROWS, small, staged, text_of

COMMON = 0.05      # terms in a larger share of the documents are too common
RARE = 0.0005      # terms in a smaller share are too rare, and so are terms of a single document
SUBSETS = 32       # every term lies in one of them, by the hash of the term
DIGITS = 8         # hexadecimal digits of one subset's hash
EMPTY = "-" * DIGITS
PER_STRETCH = 1024   # documents of a stretch of ids, on average
MOST_RANGES = 1024   # ranges of ids, cut at quantiles, and stretches of one range, at most


def terms_of(text: Column) -> Column:
    """Distinct lower-cased runs of letters and digits."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != ""))


def subset_of(term: Column) -> Column:
    return (F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long") % SUBSETS).cast("int")


def lexicon(docs: DataFrame, common: float = COMMON, rare: float = RARE) -> DataFrame:
    """(term, subset) of the terms that more than one document and a share from ``rare`` to ``common`` of all have.

    In small tables terms of two documents are never too common. Counts are over all rows; the table is stored.
    """
    counted = docs.select(F.explode(terms_of(text_of())).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    n = docs.count()
    band = counted.where((F.col("df") > 1) & (F.col("df") <= max(n * common, 2.0)) & (F.col("df") >= n * rare))
    return staged(band.select("term", subset_of(F.col("term")).alias("subset")), "lexicon")


def with_slots(rows: DataFrame, keys: list[str], texts: list[str], words: DataFrame) -> DataFrame:
    """``keys``, the other columns as a struct ``rest``, and for each column of ``texts`` its slots as ``<name>_slots``.

    A slot is the hash of a lexicon subset's terms of the text; EMPTY where it has none of them. A text without any
    lexicon term has the hash of the text as its only slot. ``keys`` tell rows apart; the texts themselves are dropped.
    Where rows lie by the first key already, nothing is shuffled but what a lexicon too large to broadcast needs.
    """
    rest = [c for c in rows.columns if c not in (*keys, *texts)]
    whole = [F.substring(F.md5(t), 1, 2 * DIGITS).alias(f"{t}_whole") for t in texts]
    kept = F.struct(F.struct(*(F.col(f"`{c}`") for c in rest)).alias("rest"), *whole)
    # Every row brings one mark that carries what it keeps; its terms carry only themselves.
    mark = F.array(F.struct(F.lit("").alias("term"), F.lit(-1).alias("text"), kept.alias("kept")))
    kind = rows.select(kept.alias("kept")).schema["kept"].dataType

    def marks(place: int, text: str) -> Column:
        return F.transform(terms_of(F.col(text)), lambda x: F.struct(
            x.alias("term"), F.lit(place).alias("text"), F.lit(None).cast(kind).alias("kept")))

    exploded = rows.select(*keys, F.explode(F.concat(mark, *(marks(i, t) for i, t in enumerate(texts)))).alias("x")).select(*keys, "x.term", "x.text", "x.kept")
    known = words.unionByName(words.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(-1).alias("subset")))
    met = exploded.join(small(known), "term")
    hashed = met.groupBy(*keys, "text", "subset").agg(
        F.substring(F.md5(F.array_join(F.array_sort(F.collect_list("term")), " ")), 1, DIGITS).alias("hash"), F.first("kept", True).alias("kept"))
    gathered = hashed.groupBy(*keys).agg(
        F.collect_list(F.when(F.col("subset") >= 0, F.struct((F.col("text") * SUBSETS + F.col("subset")).alias("at"), "hash"))).alias("found"),
        F.first("kept", True).alias("kept"))
    made = gathered.select(*keys, F.col("kept.rest").alias("rest"), "kept", "found", F.map_from_entries("found").alias("at"))

    def slots(place: int, text: str) -> Column:
        each = F.transform(F.sequence(F.lit(place * SUBSETS), F.lit((place + 1) * SUBSETS - 1)),
                           lambda at: F.coalesce(F.try_element_at("at", at), F.lit(EMPTY)))
        some = F.exists("found", lambda f: F.floor(f["at"] / SUBSETS) == place)
        return F.when(some, each).otherwise(F.array(F.col(f"kept.{text}_whole"))).alias(f"{text}_slots")

    return made.select(*keys, "rest", *(slots(i, t) for i, t in enumerate(texts)))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that at least one of the texts has terms of (0 to 1)."""
    both = F.size(F.filter(F.zip_with(a, b, lambda x, y: (x == y) & (x != EMPTY)), lambda same: same))
    either = F.size(F.filter(F.zip_with(a, b, lambda x, y: (F.coalesce(x, F.lit(EMPTY)) != EMPTY) | (
        F.coalesce(y, F.lit(EMPTY)) != EMPTY)), lambda some: some))
    return F.when(either > 0, both / either).otherwise(1.0)


def fingerprint(docs: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """``docs`` with ``slots`` and ``fingerprint`` (their concatenation); such input columns are replaced.

    Null texts count as empty. Equal texts have equal fingerprints, whatever the lexicon (term, subset). Repeated rows
    stay; no rows: no rows.
    """
    words = lexicon(docs) if words is None else words
    kept = [c for c in docs.columns if c not in ("slots", "fingerprint")]
    # The row goes along as one struct, so that no name of its columns meets ours.
    rows = docs.select(F.monotonically_increasing_id().alias("nth"), F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"), text_of().alias("text"))
    held = with_slots(rows, ["nth"], ["text"], words)
    return held.select("rest.row.*", F.col("text_slots").alias("slots"), F.array_join("text_slots", "").alias("fingerprint"))


def _stretches(rows: DataFrame) -> DataFrame:
    """``rows`` with ``bucket``, ascending with doc_id: ranges cut at quantiles of the ids, and equal widths inside them.

    Ids that cluster or lie far off make some ranges short, none long: a range has about the same number of rows. Rows
    without an id come first. To the driver come at most MOST_RANGES numbers.
    """
    number = F.col("doc_id").cast("double")
    n = rows.count()
    ranges = max(1, min(MOST_RANGES, n // PER_STRETCH))
    cuts = rows.agg(F.approx_percentile(number, F.array(*(F.lit(k / ranges) for k in range(1, ranges))), 10_000)).first()[0] if ranges > 1 else []
    edges = [float("-inf"), *sorted(set(cuts or [])), float("inf")]
    placed = rows.withColumn("number", number)
    if len(edges) > 2:
        placed = Bucketizer(splits=edges, inputCol="number", outputCol="range", handleInvalid="keep").transform(placed)
    else:
        placed = placed.withColumn("range", F.lit(0.0))
    placed = placed.withColumn("range", F.when(F.col("number").isNull(), -1).otherwise(F.col("range").cast("int")))
    # One row per range.
    spans = staged(placed.groupBy("range").agg(
        F.min("number").alias("low"), F.max("number").alias("high"), F.count("*").alias("held")), "ranges").withColumn(
        "pieces", F.least(F.lit(MOST_RANGES), F.ceil(F.col("held") / PER_STRETCH)))
    share = (F.col("number") - F.col("low")) / (F.col("high") - F.col("low") + 1)
    piece = F.coalesce(F.floor(share * F.col("pieces")), F.lit(0)).cast("long")
    return placed.join(F.broadcast(spans), "range").withColumn(
        "bucket", F.col("range").cast("long") * MOST_RANGES + piece).select(*rows.columns, "bucket")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next_text, bucket, spare, nth): each row with the next row's text by ascending doc_id.

    Ids are numbers. After the last comes the first; rows of one id are ordered by their texts' hash, rows without an id
    come first. Every stretch of ids is a task's group; the first row of a stretch is sent to the stretch before
    it as well, as a ``spare`` row, so that no row waits for another task. ``nth`` counts the rows of a stretch.
    """
    rows = _stretches(docs.select("doc_id", text_of().alias("text")))
    # At most MOST_RANGES x MOST_RANGES rows, of one number each.
    firsts = staged(rows.groupBy("bucket").agg(F.min("doc_id").alias("first_id")), "stretches")
    order = W.partitionBy(F.lit(0)).orderBy("bucket")
    before = F.coalesce(F.lag("bucket").over(order), F.last("bucket").over(order.rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing)))
    firsts = small(firsts.select(F.col("bucket").alias("b"), "first_id", before.alias("before")), BROADCAST_ROWS)
    joined = rows.join(firsts, (F.col("bucket") == F.col("b")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left")
    places = F.when(F.col("before").isNull(), F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("spare")))).otherwise(
        F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("spare")),
                F.struct(F.col("before").alias("bucket"), F.lit(1).alias("spare"))))
    dealt = joined.select("doc_id", "text", F.explode(places).alias("p")).select("doc_id", "text", "p.bucket", "p.spare")
    ascending = W.partitionBy("bucket").orderBy("spare", "doc_id", F.xxhash64("text"))
    return dealt.withColumns({"next_text": F.lead("text").over(ascending), "nth": F.row_number().over(ascending)})


def edited_fingerprints(docs: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness.

    The edited text has its last floor(n_chars / 2) characters replaced by as many first characters of
    the next text. Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next. Null texts are empty; texts without a lexicon term are alike only if equal. Rows that share
    an id follow each other by the hash of their texts, rows without an id come first and equal rows stay
    separate rows; a single row is its own next one. Ids are numbers; other columns are dropped; no rows: no rows.
    """
    words = lexicon(docs) if words is None else words
    rows = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half))
    both = rows.withColumn("edited", F.coalesce(edited, F.lit(""))).withColumn("edited_sha256", F.sha2("edited", 256)).select(
        "bucket", "nth", "spare", "doc_id", "n_chars", "edited_sha256", "text", "edited")
    held = with_slots(both, ["bucket", "nth"], ["text", "edited"], words).select("bucket", "nth", "rest.*", "text_slots", "edited_slots")
    following = F.lead("text_slots").over(W.partitionBy("bucket").orderBy("nth"))
    return held.withColumn("following", following).where("spare = 0").select(
        "doc_id", "n_chars", "edited_sha256", F.array_join("text_slots", "").alias("fingerprint"),
        F.array_join("edited_slots", "").alias("edited_fingerprint"), likeness(F.col("text_slots"), F.col("edited_slots")).alias("near_edited"),
        likeness(F.col("text_slots"), F.col("following")).alias("near_next"))
