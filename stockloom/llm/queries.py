"""One query per operator over its whole table, and the SQL that checks those which SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockloom.llm import (
    alignment, html_extract, imatch, langid, merkle, mixing, packing, pii, sharding, simhash, substring, toxicity,
    vptree)
from stockloom.llm.common import id_remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(make: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = make
        if sql is not None:
            ORACLES[name] = sql
        return make
    return register


MIX_SQL = """
WITH d AS (
  SELECT *, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS k,
         coalesce(CAST(doc_id AS VARCHAR), 'text ' || coalesce(text, '')) AS mark
  FROM documents),
sizes AS (SELECT k, sum(octet_length(encode(coalesce(text, ''))) + 1) AS size FROM d GROUP BY k),
rates AS (
  SELECT k, pow(size, 0.5) / sum(pow(size, 0.5)) OVER () * sum(size) OVER () / size AS rate FROM sizes),
terms AS (
  SELECT k, rate, unnest(generate_series(0, CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT))) AS j FROM rates),
p AS (
  SELECT k, j, exp(j * ln(rate) - rate - sum(ln(greatest(j, 1))) OVER (PARTITION BY k ORDER BY j)) AS p FROM terms),
steps AS (SELECT k, sum(p) OVER (PARTITION BY k ORDER BY j) AS below FROM p),
lists AS (SELECT k, list(below) AS steps FROM steps GROUP BY k),
drawn AS (
  SELECT d.*, steps, CAST('0x' || substr(md5('11:draw:' || mark), 1, 13) AS BIGINT) / pow(16, 13) AS u
  FROM d JOIN lists USING (k)),
counted AS (SELECT *, len(list_filter(steps, lambda b: b <= u)) AS n FROM drawn),
copies AS (SELECT *, unnest(generate_series(1, n)) AS c FROM counted WHERE n > 0)
SELECT doc_id, text, lang, source, n_chars, CAST(c AS INTEGER) AS copy, md5('11:place:' || c || ':' || mark) AS shuffle_key
FROM copies
"""


@query("op1_mix_sources", MIX_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


@query("op2_simhash_classes")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


SUBSTRING_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
starts AS (SELECT r, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35),
windows AS (SELECT s.r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM starts s JOIN d USING (r)),
repeated AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (
  SELECT r, list_distinct(flatten(list(range(i, i + 35)))) AS places FROM windows JOIN repeated USING (h) GROUP BY r),
cut AS (
  SELECT doc_id, len(w) AS n_words, len(coalesce(places, [])) AS n_removed,
         CASE WHEN places IS NULL THEN w ELSE list_transform(
           list_filter(list_zip(w, list_transform(range(1, len(w) + 1), lambda i: list_contains(places, i))), lambda x: NOT x[2]), lambda x: x[1])
         END AS kept
  FROM d LEFT JOIN gone USING (r))
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(n_removed AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM cut
"""


@query("op3_substring_dedup", SUBSTRING_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op4_pack_windows")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), with_ids=False)


IMATCH_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (
  SELECT *, length(text) AS n_chars, length(text) // 2 AS half,
         coalesce(lead(text) OVER (ORDER BY doc_id), first(text) OVER (ORDER BY doc_id)) AS next_text
  FROM d),
e AS (SELECT doc_id, n_chars, text, left(text, n_chars - half) || left(next_text, half) AS edited FROM n),
v AS (SELECT doc_id, 0 AS k, text AS t FROM e UNION ALL SELECT doc_id, 1, edited FROM e),
terms AS (
  SELECT doc_id, k, t, list_distinct(list_filter(string_split_regex(lower(t), '[^\p{L}\p{N}]+'), lambda x: x <> '')) AS terms FROM v),
lexicon AS (
  SELECT term FROM (SELECT unnest(terms) AS term FROM terms WHERE k = 0) GROUP BY term
  HAVING count(*) > 1 AND count(*) <= greatest((SELECT count(*) FROM d) * 0.05, 2.0) AND count(*) >= (SELECT count(*) FROM d) * 0.0005),
kept AS (
  SELECT doc_id, k, term, CAST('0x' || substr(md5(term), 1, 8) AS BIGINT) % 32 AS s
  FROM (SELECT doc_id, k, unnest(terms) AS term FROM terms) JOIN lexicon USING (term)),
hashed AS (SELECT doc_id, k, s, substr(md5(string_agg(term, ' ' ORDER BY term)), 1, 8) AS h FROM kept GROUP BY ALL),
maps AS (SELECT doc_id, k, map(list(s), list(h)) AS m FROM hashed GROUP BY ALL),
slots AS (
  SELECT t.doc_id, t.k, CASE WHEN m IS NULL THEN [substr(md5(t.t), 1, 16)]
         ELSE list_transform(range(32), lambda i: coalesce(m[i], '--------')) END AS slots
  FROM terms t LEFT JOIN maps USING (doc_id, k)),
own AS (
  SELECT doc_id, slots AS a, coalesce(lead(slots) OVER (ORDER BY doc_id), first(slots) OVER (ORDER BY doc_id)) AS c
  FROM slots WHERE k = 0),
pairs AS (
  SELECT own.doc_id, a, b.slots AS b, c,
         len(list_filter(list_zip(a, b.slots), lambda x: x[1] = x[2] AND x[1] <> '--------')) AS ab,
         len(list_filter(list_zip(a, b.slots), lambda x: coalesce(x[1], '--------') <> '--------' OR coalesce(x[2], '--------') <> '--------')) AS ab_any,
         len(list_filter(list_zip(a, c), lambda x: x[1] = x[2] AND x[1] <> '--------')) AS ac,
         len(list_filter(list_zip(a, c), lambda x: coalesce(x[1], '--------') <> '--------' OR coalesce(x[2], '--------') <> '--------')) AS ac_any
  FROM own JOIN slots b ON b.doc_id = own.doc_id AND b.k = 1)
SELECT doc_id, CAST(n_chars AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, array_to_string(a, '') AS fingerprint,
       array_to_string(b, '') AS edited_fingerprint, CAST(ab AS DOUBLE) / ab_any AS near_edited, CAST(ac AS DOUBLE) / ac_any AS near_next
FROM pairs JOIN e USING (doc_id)
"""


@query("op5_imatch_fingerprints", IMATCH_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.edited_fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_vantage_neighbours")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vptree.search(vptree.build_index(vectors), vectors.where("vec_id % 20 = 0"))


@query("op7_page_text")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = html_extract.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return text.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


SHARD_SQL = """
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, list_transform(range(8), lambda j: CAST(0 AS BIGINT))),
    lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS k,
         octet_length(encode(coalesce(text, ''))) + 1 AS size, hex(encode(coalesce(text, ''))) AS x
  FROM documents),
summed AS (
  SELECT doc_id, k, size, xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(size - 1), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
    lambda c, byte: xor(c >> 8, t[(xor(c, byte) & 255) + 1]))) AS text_crc32
  FROM d, crc),
ranked AS (SELECT *, md5('20:' || doc_id || ':' || text_crc32 || ':' || size) AS h FROM summed),
parts AS (
  SELECT *, CAST(2 * row_number() OVER (PARTITION BY k ORDER BY h) - 1 AS DOUBLE) / CAST(2 * count(*) OVER (PARTITION BY k) AS DOUBLE) AS part
  FROM ranked),
placed AS (SELECT *, row_number() OVER (ORDER BY part, h, k) - 1 AS place, count(*) OVER () AS n FROM parts)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'rows' AS law,
       CAST(place * 8 // n AS INTEGER) AS shard, CAST(place - ((place * 8 // n) * n + 7) // 8 AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""


@query("op8_interleave_shards", SHARD_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query("op9_toxicity")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs.select("doc_id", "text"), labels.where(id_remainder(4) != 2).select("doc_id", "toxic"))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", (id_remainder(4) == 2).alias("held_out"), "score", "predicted")


@query("op10_language")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dictionaries = langid.fit_dictionaries(docs.where(id_remainder(5) != 0).select("doc_id", "text", "lang"))
    named = langid.identify(docs.select("doc_id", "text"), dictionaries)
    return named.select("doc_id", (id_remainder(5) == 0).alias("held_out"), "lang_pred", "score", "accepted")


MERKLE_SQL = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, list_transform(range(8), lambda j: CAST(0 AS BIGINT))),
    lambda c, j: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
d AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE 's' || lang END AS k, coalesce(CAST(doc_id AS VARCHAR), '') AS digits,
         concat(coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-'),
                coalesce(octet_length(encode(source)) || ':' || source, '-'),
                coalesce(octet_length(encode(lang)) || ':' || lang, '-')) AS head,
         coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS count,
         coalesce(length(CAST(n_chars + 1 AS VARCHAR)) || ':' || (n_chars + 1), '-') AS more,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS body
  FROM documents),
hashed AS (
  SELECT doc_id, k, sha256(head || count || body) AS leaf,
         CASE WHEN xor(4294967295, list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(length(digits)), lambda i: CAST(ascii(substr(digits, i + 1, 1)) AS BIGINT))),
           lambda c, byte: xor(c >> 8, t[(xor(c, byte) & 255) + 1]))) % 7 = 0
         THEN sha256(head || more || body) ELSE sha256(head || count || body) END AS shown
  FROM d, crc),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY k) AS n FROM hashed),
nodes AS (
  SELECT k, 0 AS level, pos, n AS width, leaf AS h FROM leaves
  UNION ALL
  SELECT k, level + 1, pos // 2, (width + 1) // 2, sha256(h || coalesce(other, ''))
  FROM (SELECT *, lead(h) OVER (PARTITION BY k ORDER BY pos) AS other FROM nodes WHERE width > 1) WHERE pos % 2 = 0),
subroots AS (
  SELECT k, h, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE width = 1),
tops AS (
  SELECT 0 AS level, pos, n AS width, h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (width + 1) // 2, sha256(h || coalesce(other, ''))
  FROM (SELECT *, lead(h) OVER (ORDER BY pos) AS other FROM tops WHERE width > 1) WHERE pos % 2 = 0),
own AS (
  SELECT l.k, l.pos, x.level, CASE WHEN s.h IS NULL THEN 'O' WHEN s.pos < x.pos THEN 'L' || s.h ELSE 'R' || s.h END AS step
  FROM leaves l JOIN nodes x ON x.k = l.k AND x.pos = l.pos >> x.level AND x.width > 1
  LEFT JOIN nodes s ON s.k = l.k AND s.level = x.level AND s.pos = xor(x.pos, 1)),
above AS (
  SELECT r.k, 1000 + x.level AS level, CASE WHEN s.h IS NULL THEN 'O' WHEN s.pos < x.pos THEN 'L' || s.h ELSE 'R' || s.h END AS step
  FROM subroots r JOIN tops x ON x.pos = r.pos >> x.level AND x.width > 1
  LEFT JOIN tops s ON s.level = x.level AND s.pos = xor(x.pos, 1)),
paths AS (
  SELECT k, pos, list(step ORDER BY level) AS steps
  FROM (SELECT * FROM own UNION ALL SELECT l.k, l.pos, a.level, a.step FROM leaves l JOIN above a USING (k)) GROUP BY k, pos),
folded AS (
  SELECT l.doc_id, l.k, leaf, list_transform(coalesce(steps, []), lambda s: substr(s, 2)) AS beside,
         list_reduce(list_prepend(shown, coalesce(steps, [])), lambda a, s: sha256(
           CASE s[1] WHEN 'L' THEN substr(s, 2) || a WHEN 'R' THEN a || substr(s, 2) ELSE a END)) AS folded_root
  FROM leaves l LEFT JOIN paths p ON p.k = l.k AND p.pos = l.pos)
SELECT doc_id, leaf, r.h AS subroot, t.h AS root, sha256(array_to_string(beside, '')) AS proof_sha256, folded_root,
       folded_root = t.h AS verified
FROM folded JOIN subroots r USING (k), (SELECT h FROM tops WHERE width = 1) t
"""


@query("op11_merkle_manifest", MERKLE_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.col("n_chars") + F.when(id_remainder(7) == 0, 1).otherwise(0)
    return merkle.verify(merkle.build(docs, {"n_chars": tampered})).withColumnRenamed("id", "doc_id")


@query("op13_tokenizer_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


@query("op12_personal_data")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))
