"""SimHash classes and substring dedup against brute force, with the awkward rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from stockloom.llm import components, simhash, substring


def rows_with_extras(spark, rows):
    """(doc_id, text) rows with other columns whose names clash with the operators' own."""
    return spark.createDataFrame(
        [(i, t, "x", 1, 2) for i, t in rows], "doc_id long, text string, ck string, n_words int, fp int").repartition(3)


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    width = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + width]), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(values, bits=3):
    label = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i in range(len(values)):
            for j in range(len(values)):
                if (values[i] ^ values[j]).bit_count() <= bits and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def sample_texts():
    rng = random.Random(5)
    words = [f"W{i}" for i in range(400)]
    base = [" ".join(rng.choices(words, k=rng.choice([1, 2, 40, 300]))) for _ in range(25)]
    near = []
    for text in base[:12]:
        parts = text.split()
        parts[rng.randrange(len(parts))] = "changed"
        near.append(" ".join(parts))
    return base + near + base[:5] + [None, "", " \t\n", "w1 w2", "W1\x0bW2", "long " * 30_000]


def test_simhash_matches_brute_force(spark):
    texts = sample_texts()
    found = {r["doc_id"]: r for r in simhash.near_duplicates(rows_with_extras(spark, list(enumerate(texts)))).collect()}
    values = [brute_fingerprint(t) for t in texts]
    labels = brute_classes(values)
    assert len(found) == len(texts)
    assert [found[i]["fingerprint"] for i in range(len(texts))] == [f"{v:016x}" for v in values]
    assert [found[i]["component_id"] for i in range(len(texts))] == labels
    assert len(set(labels)) < len(labels) - 8


def test_simhash_repeated_and_null_ids_and_no_rows(spark):
    rows = [(7, "one two three four"), (7, "one two three four"), (None, "one two three four"), (9, None), (None, "")]
    found = simhash.near_duplicates(rows_with_extras(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in found) == [(-1, 7), (-1, 9), (7, 7), (7, 7), (9, 9)]
    kept = simhash.drop_near_duplicates(rows_with_extras(spark, rows))
    assert kept.columns == ["doc_id", "text", "ck", "n_words", "fp"]
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [7, 9]
    assert simhash.near_duplicates(rows_with_extras(spark, rows).limit(0)).count() == 0


def test_near_duplicates_are_dropped_row_by_row(spark):
    """A repeated id loses only the rows whose class has an earlier one; any column names stay."""
    text, other = "one two three four five", "quite another text stands here alone"
    rows = [(1, text), (5, text), (5, other), (None, other), (None, "only a row without an id has this"), (6, None), (8, "")]
    docs = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in rows], "doc_id long, text string, _nth int, `a.b` int, fp int, mark int")
    kept = simhash.drop_near_duplicates(docs.repartition(3))
    assert kept.columns == docs.columns
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=repr) == sorted(
        [(1, text), (5, other), (None, "only a row without an id has this"), (6, None)], key=repr)
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_large_buckets_lose_no_link(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 3)
    batch = pa.RecordBatch.from_pydict({"bucket": pa.array([1] + [5] * 9 + [6, 6, 8], pa.int64()),
                                        "fp": pa.array(range(13), pa.int64())})
    out = pa.Table.from_batches(simhash._bucket_links(iter([batch.slice(0, 4), batch.slice(4)]))).to_pylist()
    assert sorted(r["u"] for r in out if r["bucket"] == 5) == list(range(1, 10))
    assert [(r["u"], r["v"]) for r in out if r["bucket"] is None] == [(10, 11)]


def test_spanning_links_keep_classes_connected():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 2**10, 120).astype(np.int64)
    values = np.unique(values)
    links = simhash.spanning_links(values, bits=1)
    assert len(links) < len(values)
    label = {int(v): int(v) for v in values}
    for _ in values:
        for u, v in links:
            label[u] = label[v] = min(label[u], label[v])
    brute = brute_classes([int(v) for v in values], bits=1)
    assert [label[int(v)] for v in values] == [int(values[b]) for b in brute]


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)] + [(500, 500)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(found[i] == 0 for i in range(61)) and all(found[100 + i] == 100 for i in range(40)) and 500 not in found


def brute_cut(texts, window):
    words = [(t or "").encode().split() for t in texts]
    count = {}
    for w in words:
        for i in range(len(w) - window + 1):
            count[tuple(w[i:i + window])] = count.get(tuple(w[i:i + window]), 0) + 1
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


@pytest.mark.parametrize("window,prefix", [(6, 2), (7, 7), (35, 12)])
def test_substring_matches_brute_force(spark, window, prefix):
    rng = random.Random(window)
    passage = [" ".join(rng.choices("abcdefgh", k=window + 3)) for _ in range(4)]
    texts = []
    for i in range(60):
        own = " ".join(str(rng.random()) for _ in range(rng.choice([0, 3, 50])))
        texts.append(f"{own} {rng.choice(passage)}  {own if i % 7 == 0 else i}\t{rng.choice(passage)[:rng.randrange(90)]}")
    texts += texts[:6] + [None, "", "x", "same " * 90, "é ü " * 40, " ".join(map(str, range(20_000))) + " " + passage[0]]
    docs = rows_with_extras(spark, list(enumerate(texts)))
    cut = substring.remove_repeats(docs, window, prefix)
    assert cut.columns == ["doc_id", "text", "ck", "fp", "n_words", "n_removed", "kept_text"]
    found = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in cut.collect()}
    assert [found[i] for i in range(len(texts))] == brute_cut(texts, window)


def test_substring_repeated_rows_and_no_rows(spark):
    text = " ".join(map(str, range(50)))
    docs = rows_with_extras(spark, [(1, text), (1, text), (None, "a b"), (2, None)])
    found = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in substring.remove_repeats(docs).collect())
    assert found == [(0, 2, 0), (1, 50, 50), (1, 50, 50), (2, 0, 0)]
    assert substring.remove_repeats(docs.limit(0)).count() == 0


def test_large_prefix_groups_are_split_by_the_window(monkeypatch):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        h = int(rng.integers(0, 4))
        rows.append((h, i, int(rng.integers(0, 9)), rng.integers(0, 12, 5).astype(np.int64)))
    rows.sort(key=lambda r: r[0])
    batch = pa.RecordBatch.from_pydict({
        "h": pa.array([r[0] for r in rows], pa.int64()), "ck": pa.array([bytes([r[1]]) for r in rows], pa.binary()),
        "a": pa.array([r[2] for r in rows], pa.int32()), "b": pa.array([0] * 40, pa.int32()),
        "ws": pa.array([r[3].tobytes() for r in rows], pa.binary())})

    def words(limit, step):
        monkeypatch.setattr(substring, "GROUP_ROWS", limit)
        parts = [batch.slice(i, step) for i in range(0, 40, step)]
        out = pa.Table.from_batches(substring._deep_nodes(4)(iter(parts))).sort_by([("h", "ascending"), ("w", "ascending")])
        done = pa.Table.from_batches(substring._repeated_runs(["h", "w"])(iter(out.combine_chunks().to_batches()))).to_pylist()
        return {(r["ck"], i) for r in done for i in range(r["a"], r["b"])}

    whole = words(1000, 40)
    count = {}
    for h, _, _, ws in rows:
        for w in ws.tolist():
            count[h, w] = count.get((h, w), 0) + 1
    assert whole == {(bytes([i]), a + k + j) for h, i, a, ws in rows for k, w in enumerate(ws.tolist()) if count[h, w] > 1
                     for j in range(4)}
    assert whole == words(1000, 3) == words(3, 7) == words(2, 1) == words(5, 40)
