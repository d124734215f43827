"""The corpus pipeline: stages keep the documents' columns, their decisions take effect and match brute force."""

from collections import Counter

import corpus_pipeline
from stockloom.llm import langid
from stockloom.llm.common import id_remainder

from test_dedup import brute_classes, brute_cut, brute_fingerprint

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def stored(spark, docs, tmp_path, name):
    docs.write.parquet(str(tmp_path / name))
    return spark.read.parquet(str(tmp_path / name))


def test_stages_one_after_the_other(spark, tmp_path):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "SimHash near-dedup", "substring dedup", "mixing", "packing"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    extra = spark.createDataFrame([(900_001, None, "en", "src0", 0), (900_002, "12345 !!", "en", None, 8), (900_003, "", None, "x", 0)], docs.schema)
    state = [stored(spark, docs.union(extra), tmp_path, "0")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        state.append(stored(spark, stage(spark, state[-1], DATA), tmp_path, str(i + 1)))
    assert all(s.columns == COLUMNS for s in state[:5])
    rows = [{r["doc_id"]: r for r in s.collect()} for s in state[:4]]

    # 1. What the identifier accepts stays unchanged.
    held = langid.fit_dictionaries(state[0].where(id_remainder(5) != 0).select("doc_id", "text", "lang"))
    accepted = {r["doc_id"] for r in langid.identify(state[0], held).where("accepted").collect()}
    assert set(rows[1]) == accepted and not {900_001, 900_002, 900_003} & accepted
    assert len(accepted) > 0.97 * docs.count() and all(rows[0][i] == r for i, r in rows[1].items())

    # 2. One document of each class stays: the smallest id.
    ids = sorted(rows[1])
    labels = brute_classes([brute_fingerprint(rows[1][i]["text"]) for i in ids])
    assert sorted(rows[2]) == sorted({ids[k] for k in labels}) and len(rows[2]) < len(rows[1])
    assert all(rows[1][i] == r for i, r in rows[2].items())

    # 3. Repeated passages are cut; documents without any are as they were.
    ids = sorted(rows[2])
    for i, (_, removed, kept) in zip(ids, brute_cut([rows[2][i]["text"] for i in ids], 35)):
        if not removed:
            assert rows[3][i] == rows[2][i]
        elif kept:
            assert rows[3][i]["text"] == kept and rows[3][i]["n_chars"] == len(kept)
        else:
            assert i not in rows[3]

    # 4. Copies of kept documents only. 5. Every copy is packed once.
    mixed = Counter(r["doc_id"] for r in state[4].collect())
    assert set(mixed) <= set(rows[3]) and len(mixed) > 0.5 * len(rows[3])
    packed = state[5].collect()
    assert Counter(r["doc_id"] for r in packed if r["start"] == 0) == mixed
    for i, times in mixed.items():
        pieces = [r for r in packed if r["doc_id"] == i]
        assert sum(r["length"] for r in pieces) == times * pieces[0]["doc_tokens"]


def test_run_gives_the_last_stage(spark):
    first, second = (corpus_pipeline.run(spark, DATA).select("doc_id", "start", "length", "ids_crc32").collect() for _ in range(2))
    assert Counter(r["doc_id"] for r in first if r["start"] == 0) == Counter(r["doc_id"] for r in second if r["start"] == 0)


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).count() == 0
