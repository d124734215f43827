"""Mixing, sharding and packing: brute force, round trips and the awkward rows."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from stockloom.llm import mixing, packing, sharding

DOCS = "doc_id long, text string, source string, copy string, shard string, _row int"


def make(spark, rows):
    """(doc_id, text, source) with further columns named like the operators' own."""
    return spark.createDataFrame([(*r, "c", "s", 3) for r in rows], DOCS).repartition(3)


def sample(n=300):
    rng = random.Random(2)
    rows = [(i, "word " * rng.randrange(0, 30), rng.choice(["a", "a", "a", "b", None, "d"])) for i in range(n)]
    return rows + [(n, None, "e"), (n + 1, "", "e"), (n + 2, "long " * 40_000, "b"), rows[0], rows[0], (None, "x y", "b")]


def brute_copies(rows, epochs=1.0, weights=None):
    size = Counter()
    for _, text, source in rows:
        size[source] += len((text or "").encode()) + 1
    weights = {s: n**0.5 for s, n in size.items()} if weights is None else weights
    total = sum(weights.get(s, 0) for s in size)
    copies = []
    for i, text, source in rows:
        rate = weights.get(source, 0) / total * epochs * sum(size.values()) / size[source]
        mark = str(i) if i is not None else "text " + (text or "")
        u = int(hashlib.md5(f"11:draw:{mark}".encode()).hexdigest()[:13], 16) / 16**13
        k, below = 0, math.exp(-rate) if rate else 2.0
        term = below
        while below <= u:
            k += 1
            term *= rate / k
            below += term
        copies += [(i, text, source, c) for c in range(1, k + 1)]
    return Counter(copies)


def test_mixture_matches_brute_force(spark):
    rows = sample()
    mixed = mixing.mix_sources(make(spark, rows))
    assert mixed.columns == ["doc_id", "text", "source", "shard", "_row", "copy", "shuffle_key"]
    found = Counter((r["doc_id"], r["text"], r["source"], r["copy"]) for r in mixed.collect())
    assert found == brute_copies(rows)


def test_mixture_with_given_weights(spark):
    rows = [(i, "abc", "ab"[i % 2]) for i in range(2000)]
    weights = spark.createDataFrame([("a", 3.0), ("zzz", 9.0)], "source string, weight double")
    found = mixing.mix_sources(make(spark, rows), weights, epochs=1.5).groupBy("source").count().collect()
    assert {r["source"] for r in found} == {"a"} and abs(found[0]["count"] - 3000) < 250
    both = mixing.mix_sources(make(spark, rows), spark.createDataFrame([("a", 3.0), ("b", 1.0)], "source string, weight double"))
    share = Counter(r["source"] for r in both.collect())
    assert abs(share["a"] / share.total() - 0.75) < 0.03
    assert mixing.mix_sources(make(spark, rows).limit(0)).count() == 0


def test_too_high_rates_are_an_error(spark):
    rows = [(i, "abc " * 500, "a") for i in range(50)] + [(99, "", "b")]
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "source string, weight double")
    with pytest.raises(Exception, match="repetition rate"):
        mixing.mix_sources(make(spark, rows), weights).count()


def brute_shards(rows, shards=8):
    by = defaultdict(list)
    for r in rows:
        i, text, source = r
        data = (text or "").encode()
        mark = ":".join(["20", "" if i is None else str(i), str(zlib.crc32(data)), str(len(data) + 1)])
        by[source].append((hashlib.md5(mark.encode()).hexdigest(), "n" if source is None else "s" + source, i, len(data) + 1))
    ranked = sorted(((2 * k - 1) / (2 * len(held)), *row) for held in by.values() for k, row in enumerate(sorted(held, key=lambda x: x[0]), 1))
    n, out = len(ranked), Counter()
    for place, (_, _, _, i, size) in enumerate(ranked):
        shard = place * shards // n
        out[i, size, shard, place - (shard * n + shards - 1) // shards] += 1
    return out


@pytest.mark.parametrize("n", [1, 5, 300])
def test_shards_match_brute_force(spark, n):
    rows = sample(n)
    placed = sharding.shard_documents(make(spark, rows)).collect()
    assert Counter((r["doc_id"], r["size"], r["shard"], r["slot"]) for r in placed) == brute_shards(rows)
    sizes = Counter(r["shard"] for r in placed)
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(8)) <= 1
    for s, count in sizes.items():
        assert sorted(r["slot"] for r in placed if r["shard"] == s) == list(range(count))


def test_every_shard_has_the_mixture_and_files_are_written(spark, tmp_path):
    docs = make(spark, sample(800))
    sharding.write_shards(docs, str(tmp_path / "shards"), shards=4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 806
    for source in ("a", "b", "d"):
        counts = [r["count"] for r in back.where(f"source = '{source}'").groupBy("shard").count().collect()]
        assert len(counts) == 4 and max(counts) - min(counts) <= 2
    assert sharding.shard_documents(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))


def test_packing_round_trip(spark, tokenizer):
    rng = random.Random(4)
    odd = ["Don't STOP, the 12,345.67 É’s ıİ ﬁ Σας!!! ... ,. a.b. x\x01y \x01 z", "tab\tnew\nline\r\x0b   　 end.", "<|endoftext|> it's",
           "é ́x e,́ café. É, é. ß.", None, "", "same", "... ŞEHRİ. İ! İ, aİ; Iİ.) BİR"]
    rows = [(i, t, None) for i, t in enumerate(odd)]
    rows += [(100 + i, " ".join(rng.choices(["alpha", "Beta,", "gamma.", "δέλτα", "12"], k=rng.choice([1, 30, 500, 9000]))), "s") for i in range(60)]
    rows += [(6, "same", "again"), (None, "no id", None)]
    docs = make(spark, rows)
    packed = packing.pack_documents(docs, window=512, most_open=4)
    assert packed.columns == ["doc_id", *packing.COLUMNS, "ids"]
    pieces, ids = packed.collect(), {}
    for i, t, _ in rows:
        ids[i] = b"".join(x.to_bytes(4, "little") for x in [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])
    by, windows = defaultdict(list), defaultdict(list)
    for p in pieces:
        part = ids[p["doc_id"]][4 * p["start"]:4 * (p["start"] + p["length"])]
        assert bytes(p["ids"]) == part and p["ids_crc32"] == zlib.crc32(part) and p["doc_tokens"] == len(ids[p["doc_id"]]) // 4
        by[p["doc_id"]].append((p["start"], p["length"]))
        windows[p["sequence_id"]].append((p["offset"], p["length"]))
    for i, data in ids.items():
        covered = Counter(k for s, n in by[i] for k in range(s, s + n))
        times = sum(1 for r in rows if r[0] == i)
        assert covered == {k: times for k in range(len(data) // 4)}
    short = 0
    for held in windows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 512
        short += at <= 512 - packing.MIN_CUT
    assert short <= 1
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_a_part_is_looked_up_once_in_a_block_of_texts(tokenizer):
    class Counting(dict):
        asked = 0

        def __getitem__(self, key):
            Counting.asked += 1
            return super().__getitem__(key)

    encode = packing.WordEncoder()
    encode.memo = Counting()
    texts = ["word and word,\nword  " * 500, "", "And\tword, " * 300, " ", "İ. é! <|x|> \x01 word"]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for _ in range(2):
        assert list(encode(texts)) == want
    assert Counting.asked < 60
    assert list(encode([])) == []


def test_open_windows_are_bounded_and_best_fit():
    windows = packing.Windows(100, 2, 5)
    windows.add("a", 60)
    windows.add("b", 70)
    windows.add("c", 30)    # fits b exactly
    assert [(p[0], w, o) for p, w, o in windows.closed] == [("b", 1, 0), ("c", 1, 70)]
    windows.add("d", 97)
    windows.add("e", 50)    # fits nowhere: the fullest (3 ids missing) is emitted, then a window opens
    assert len(windows.free) == 2 and len(windows.closed) == 3
    windows.add("f", 240)   # two whole windows, 40 left fit a
    assert len(windows.closed) == 3 + 2 + 2
