"""Language identification and toxicity: held-out accuracy, plain recomputation and the awkward rows."""

import math

import numpy as np
import pytest
import zstandard

from stockloom.llm import langid, queries, toxicity
from stockloom.llm.common import id_remainder

DATA = "/root/testdata/sf0.01"


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = queries.QUERIES["op10_language"](spark, DATA).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(found) > 100 and np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)
    assert np.mean([r["accepted"] for r in found]) > 0.97


def test_language_of_awkward_texts(spark):
    train = spark.createDataFrame(
        [(i, t * 9, n) for i, (t, n) in enumerate([("the cat and the dog ", "en"), ("der hund und die katze ", "de")] * 20)]
        + [(90, None, "en"), (91, "text", None), (92, "", "fr")], "doc_id long, text string, lang string")
    held = langid.fit_dictionaries(train)
    assert sorted(held) == ["de", "en"] and all(len(v) <= langid.DICTIONARY_BYTES for v in held.values())
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the dog and the cat"), (4, "der hund " * 50_000), (None, "die katze und")]
    docs = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, score int, accepted string")
    found = {(r["doc_id"], (r["text"] or "")[:3]): r for r in langid.identify(docs, held).collect()}
    assert [found[k]["lang_pred"] for k in ((1, ""), (2, ""), (3, "123"), (4, "the"), (4, "der"), (None, "die"))] == [
        "und", "und", "und", "en", "de", "de"]
    assert not found[3, "123"]["accepted"] and found[3, "123"]["score"] == 0 and found[4, "der"]["accepted"]
    assert {r["lang_pred"] for r in langid.identify(docs, {}).collect()} == {"und"}
    assert langid.fit_dictionaries(train.limit(0)) == {} and langid.identify(docs.limit(0), held).count() == 0


def test_language_keeps_columns_with_any_names(spark):
    docs = spark.createDataFrame([(1, "the text", 2, 3, 4)], "doc_id long, text string, _named int, `a.b` int, row int")
    assert langid.identify(docs, {"en": b"the text of a language"}).columns == [*docs.columns, "lang_pred", "score", "accepted"]


def test_toxicity_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    found = queries.QUERIES["op9_toxicity"](spark, DATA).join(labels, "doc_id").where("held_out").collect()
    score, toxic = np.array([r["score"] for r in found]), np.array([r["toxic"] for r in found])
    pairs = score[toxic == 1][:, None] - score[toxic == 0][None, :]
    assert (pairs > 0).mean() + (pairs == 0).mean() / 2 > 0.85
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in found)


@pytest.fixture(scope="module")
def small_model(spark):
    rows = [(i, f"number {i} is {'an awful idiot' if i % 4 == 0 else 'a fine person'} today") for i in range(200)]
    docs = spark.createDataFrame([*rows, (999, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(999, 0), (5, None), (None, 1)],
                                   "doc_id long, toxic int")
    return docs, labels, toxicity.fit(docs, labels)


def test_toxicity_of_awkward_texts(spark, small_model):
    _, _, model = small_model
    rows = [(1, None), (2, ""), (3, "he is an awful idiot"), (3, "he is an awful idiot"), (4, "none " * 500_000 + "an awful idiot"), (5, "é"), (None, "ok")]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, score string")
    found = toxicity.score(docs, model)
    assert found.columns == ["doc_id", "text", "score", "predicted"]
    by = {}
    for r in found.collect():
        by.setdefault(r["doc_id"], set()).add(r["score"])
    assert all(len(v) == 1 for v in by.values()) and by[1] == by[2] == by[5]
    assert min(by[3]) > 0.3 and min(by[4]) > max(by[1]) and all(0 <= x <= 1 for v in by.values() for x in v)
    assert toxicity.score(docs.limit(0), model).count() == 0


def plain_grams(text):
    """Hashes of the distinct n-grams of a text, character by character, in whole numbers modulo 2^64."""
    codes, found, whole = [ord(c) for c in f" {(text or '').lower()} "], set(), 1 << 64
    for n in toxicity.GRAMS:
        for start in range(len(codes) - n + 1):
            held = n
            for c in codes[start:start + n]:
                held = (held * 0x9E3779B97F4A7C15 + c + 1) % whole
            held ^= held >> 31
            found.add((held * 0xBF58476D1CE4E5B9 % whole) >> (64 - toxicity.BITS))
    return found


def test_toxicity_scores_are_those_of_a_plain_loop(spark):
    """On 200 documents: n-grams, naive Bayes ratios and the logistic of the weights, without any table or batch."""
    given = spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").limit(200).select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in given.collect()]
    labels = spark.createDataFrame([(i, int("th" in (t or "")[:200])) for i, t in rows], "doc_id long, toxic int")
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    model = toxicity.fit(given, labels)
    grams = {i: plain_grams(t) for i, t in rows}
    totals, counts = [0, 0], {}
    for i, held in grams.items():
        totals[truth[i]] += 1
        for g in held:
            counts.setdefault(g, [0, 0])[truth[i]] += 1
    share = lambda n, k: (n + 1) / (totals[k] + 2)
    shifts = {g: (abs(math.log(share(b, 1) / share(a, 0))) * abs(share(b, 1) - share(a, 0))) for g, (a, b) in counts.items()
              if a + b >= toxicity.MIN_DOCUMENTS}
    least = sorted(shifts.values(), reverse=True)[min(len(shifts), toxicity.FEATURES) - 1]
    kept = set(model.hashes.tolist())
    assert len(kept) == min(len(shifts), toxicity.FEATURES) and all(shifts[g] >= least * (1 - 1e-9) for g in kept)
    weight = dict(zip(model.hashes.tolist(), model.weights.tolist()))
    # A weight is the log-count ratio times a coefficient of one sign-free regression: zero exactly where the ratio is.
    for g in kept:
        ratio = math.log(share(counts[g][1], 1) / share(counts[g][0], 0))
        assert ratio != 0 or weight[g] == 0
    for r in toxicity.score(given, model).collect():
        total = model.intercept + sum(weight.get(g, 0.0) for g in grams[r["doc_id"]])
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)
        assert r["predicted"] == int(r["score"] >= toxicity.THRESHOLD)


def test_languages_are_those_of_the_smallest_compressed_size(spark):
    """Sizes with each dictionary by the plain library, chunk by chunk, on 150 documents of all lengths."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    held = langid.fit_dictionaries(docs.where(id_remainder(5) != 0).select("doc_id", "text", "lang"))
    some = docs.orderBy("doc_id").limit(150).select("doc_id", "text")
    count = min(len([1 for i in range(0, len(d), -(-len(d) // langid.SLICES))]) for d in held.values())

    def size(data, content):
        plain = zstandard.ZstdCompressor(
            level=langid.LEVEL, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            write_checksum=False, write_content_size=False, write_dict_id=False)
        return sum(len(plain.compress(data[i:i + langid.CHUNK])) for i in range(0, len(data), langid.CHUNK))

    for r in langid.identify(some, held).collect():
        if not r["text"] or not any(c.isalpha() for c in r["text"]):
            assert r["lang_pred"] == "und"
            continue
        data, sizes = r["text"].lower().encode(), {}
        for lang, content in held.items():
            step = -(-len(content) // langid.SLICES)
            parts = [content[i:i + step] for i in range(0, len(content), step)][:count] if len(data) <= langid.SHORT else [content]
            sizes[lang] = sum(size(data, p) for p in parts)
        best = min(sizes, key=lambda x: (sizes[x], x))
        second = sorted(sizes.values())[1]
        # The compressors of the operator are prepared ones; a prepared dictionary may cost a few bytes more or less.
        assert r["lang_pred"] == best or sizes[r["lang_pred"]] <= sizes[best] * 1.01 + 3
        assert r["score"] == pytest.approx((second - sizes[best]) / second, abs=0.02)


def test_toxicity_without_both_classes(spark, small_model):
    docs, labels, _ = small_model
    assert toxicity.fit(docs, labels.where("toxic = 1")).constant == 1.0
    model = toxicity.fit(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.0}


def test_gram_sets_do_not_depend_on_how_texts_are_cut(monkeypatch):
    texts = ["abcdefgh ijk " * 300, "", None, "xyz", "abcd"]
    whole = toxicity.united(texts, None)
    monkeypatch.setattr(toxicity, "PART", 64)
    assert all((a == b).all() for a, b in zip(whole, toxicity.united(texts, None)))
    assert len(whole[4]) == 6   # " abcd " has three 4-grams, two 5-grams and one 6-gram


def test_remainder_is_of_the_crc_of_the_decimal_text(spark):
    import zlib
    got = [r[0] for r in spark.range(50).select(id_remainder(5, "id")).collect()]
    assert got == [zlib.crc32(str(i).encode()) % 5 for i in range(50)]
