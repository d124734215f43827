"""Manifest roots, multiproofs and tamper checks against a plain tree."""

import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.llm import merkle
from stockloom.llm.common import id_remainder

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, key string, part int, leaf string, level int"
EXTRA = ("clash", 7, "clash", 9)


def h(text):
    return sha256(text.encode()).hexdigest()


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def path(tree, at):
    """Siblings from the bottom: (hash, lies left), or None for a lone node."""
    steps = []
    for level in tree[:-1]:
        beside = at ^ 1
        steps.append((level[beside], beside < at) if beside < len(level) else None)
        at //= 2
    return steps


def brute(rows):
    def leaf(row, more=0):
        values = [row[0], row[1], row[2], None if row[3] is None else row[3] + more, row[4]]
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([leaf(r) for r in sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))]) for g in order}
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for at_top, g in enumerate(order):
        held = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        for at, row in enumerate(held):
            steps = path(trees[g], at) + path(top, at_top)
            tampered = zlib.crc32(("" if row[0] is None else str(row[0])).encode()) % 7 == 0
            folded = leaf(row, int(tampered))
            for step in steps:
                folded = h(folded if step is None else step[0] + folded if step[1] else folded + step[0])
            out.append((row[0], leaf(row), trees[g][-1][0], top[-1][0], h("".join(s[0] for s in steps if s)), folded, folded == top[-1][0]))
    return out


def sample_rows():
    langs = ["en"] * 23 + ["de"] * 6 + [None] * 3 + ["", "é", "Z", "fr"]
    rows = [(i * 3 % 101, f"s{i % 4}" if i % 5 else None, lang, i if i % 6 else None, f"text ünï {i}") for i, lang in enumerate(langs)]
    rows += [(2**60 + i, "s", "en", 3, "large ids") for i in range(3)]
    rows += [(None, None, "en", 4, "x"), (None, "s", None, None, None), (7, "s", "en", 1, ""), (7, "s", "en", 1, None)]
    return rows + [(7, "s", "en", 1, "same row")] * 3 + [(90, "s", "long", 1, "word " * 60_000)]


def check(spark, rows, bits=12):
    docs = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)
    shown = {"n_chars": F.col("n_chars") + F.when(id_remainder(7) == 0, 1).otherwise(0)}
    manifest = merkle.build(docs, shown, bits=bits)
    found = [tuple(r) for r in merkle.verify(manifest).collect()]
    assert sorted(found, key=repr) == sorted(brute(rows), key=repr)
    return manifest


@pytest.mark.parametrize("bits, held", [(12, 50_000), (2, 5)])
def test_manifest_and_proofs_match_a_plain_tree(spark, monkeypatch, bits, held):
    """Once in a single block, once with blocks of four leaves, ranges of five rows and several rounds."""
    monkeypatch.setattr(merkle, "RANGE_ROWS", held)
    manifest = check(spark, sample_rows(), bits)
    some = merkle.verify(manifest, manifest.leaves.where("position % 3 = 1 and key = 'sen'")).collect()
    every = {tuple(r) for r in merkle.verify(manifest).collect()}
    assert some and {tuple(r) for r in some} <= every


def test_one_row_equal_rows_and_no_rows(spark):
    check(spark, [(1, "s", "en", 2, "alone")])
    check(spark, [(1, "s", None, None, None)] * 9)
    manifest = merkle.build(spark.createDataFrame([], SCHEMA))
    assert manifest.root is None and manifest.groups == 0
    assert merkle.verify(manifest).count() == 0


def test_missing_nodes_are_the_least_that_prove_all():
    """Nothing asked for can be derived, and what is asked for suffices."""
    rng = np.random.default_rng(3)
    for width in (1, 2, 5, 16, 37):
        tree = levels([h(str(i)) for i in range(width)])
        for _ in range(6):
            chosen = np.sort(rng.choice(width, rng.integers(1, width + 1), replace=False))
            asked = merkle.missing(chosen, width)
            derived = {(level, int(a) >> level) for a in chosen for level in range(len(tree))}
            assert not set(asked) & derived and len(set(asked)) == len(asked)
            paths = merkle.Paths(chosen, [tree[0][i] for i in chosen], width, {c: tree[c[0]][c[1]] for c in asked})
            assert paths.root == tree[-1][0]
            for i, at in enumerate(chosen):
                assert merkle.fold(tree[0][at], paths.siblings(i)) == tree[-1][0]
