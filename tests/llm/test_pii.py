"""Personal data: patterns against plain expressions, messages against enumeration, planted other forms."""

import itertools
import random
import re
from hashlib import sha256

import numpy as np
import pytest

from stockloom.llm import pii

SCHEMA = "doc_id long, text string, n_email int, spans string, base_sha256 double"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute_spans(text):
    found = []
    for place, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            if kind == "card":
                doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))]
                if not 12 <= len(digits) <= 19 or sum(doubled) % 10:
                    continue
            found.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return [s for _, _, s in sorted(found)]


def test_base_spans_match_plain_expressions():
    rng = random.Random(4)
    pool = ["a.b@c.d", "@", "..", "1.2.3.4", "255.256.1.1", "00000000255.1.1.1", "4532015112830366", "4532 0151-1283 0366",
            "+1 (555) 123-4567", "+49 30 1234567", "x@y", "x@y.z.", "é@ü.de", "a@b.c@d.e", "+", "1.2.3", ".5.6.7.8", "- -", " ", "\n"]
    for _ in range(3_000):
        text = "".join(rng.choice(pool) if rng.random() < 0.4 else rng.choice("0123456789.@+- ()aZ%_é") for _ in range(rng.randrange(30)))
        assert [pii.written([s]) for s in pii.base_spans(text)] == brute_spans(text), text


@pytest.mark.parametrize("long_text", ["a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + " " * 300_000, "@" * 100_000, "a@b" * 100_000])
def test_very_long_runs_take_no_square_time(long_text):
    assert pii.graph(long_text, pii.base_spans(long_text)) is not None


def enumerated(scores, ties, pair):
    chances = np.zeros(scores.shape)
    for labels in itertools.product(range(pii.LABELS), repeat=len(scores)):
        weight = sum(scores[i, y] for i, y in enumerate(labels)) + sum(pair[k, labels[i], labels[j]] for i, j, k in ties)
        for i, y in enumerate(labels):
            chances[i, y] += np.exp(weight)
    return chances / chances.sum(axis=1, keepdims=True)


def test_messages_match_enumeration():
    rng = np.random.default_rng(2)
    pair = rng.normal(size=(4, 5, 5))
    for ties in ([], [(0, 1, 0)], [(0, 1, 0), (1, 2, 1), (3, 1, 2)], [(0, 1, 0), (1, 2, 0), (2, 3, 3), (4, 2, 1)]):
        scores = rng.normal(size=(5, 5))
        ties = np.array(ties, np.int64).reshape(-1, 3)
        assert np.allclose(pii.marginals(scores, ties, pair), enumerated(scores, ties, pair))
    # Loops: close to the truth at moderate strength, and not changed by what is computed beside.
    scores, loop = rng.normal(size=(4, 5)), np.array([(0, 1, 0), (1, 2, 0), (2, 3, 0), (0, 3, 1)])
    found = pii.marginals(scores, loop, pair * 0.4)
    assert np.abs(found - enumerated(scores, loop, pair * 0.4)).max() < 0.05
    beside = pii.marginals(np.concatenate([scores, scores]), np.concatenate([loop, loop + [4, 4, 0]]), pair * 0.4)
    assert np.allclose(beside[:4], found) and np.allclose(beside[4:], found)


def test_pseudo_likelihood_slope():
    """One tie's potential and a feature's weight move as finite differences of the objective say."""
    text = "call +1 (743) 555-3824 or 743.555.3824 now, not 999.111.2222"
    made, labels = pii.graph(text, pii.base_spans(text)), None
    labels = [[4 if "743" in text[s:e] or "3824" in text[s:e] or e < 12 else 0 for s, e in made.spans]]
    field = pii.fit_field([made], labels)
    features, _, ties = pii.union([made])
    truth = np.array(labels[0])

    def loss(unary, pair):
        logits = unary[features].sum(axis=1)
        for i, j, k in ties:
            logits[i] += pair[k, :, truth[j]]
            logits[j] += pair[k, truth[i], :]
        chosen = logits[np.arange(len(truth)), truth] - np.log(np.exp(logits).sum(axis=1))
        return -chosen.mean() + pii.PENALTY / 2 * ((unary**2).sum() + (pair**2).sum())

    start = loss(np.zeros_like(field.unary), np.zeros_like(field.pair))
    assert loss(field.unary, field.pair) < start / 5
    assert np.all(field.unary[pii.BUCKETS] == 0)


def sentences(rng, n):
    return " ".join(rng.choice(["the", "report", "of", "river", "house", "and", "stone", "in", "2019", "3.0", "page", "12"]) for _ in range(n))


def planted(rng):
    number = f"{rng.randrange(200, 999)}", f"{rng.randrange(200, 999)}", f"{rng.randrange(1000, 9999)}"
    phone = "+1 ({}) {}-{}".format(*number)
    name = f"{rng.choice(['ann', 'bob', 'eve'])}.{rng.randrange(10, 99)}"
    return phone, ".".join(number), f"{name}@mail{rng.randrange(9)}.example.com", f"{name}[at]mail.example.com", name


def documents(rng, n):
    out = []
    for _ in range(n):
        phone, _, mail, _, _ = planted(rng)
        ip = ".".join(str(rng.randrange(1, 255)) for _ in range(4))
        out.append(f"{sentences(rng, 20)} {phone} {sentences(rng, 9)} {mail} {sentences(rng, 8)} {ip} {sentences(rng, 5)}")
    return out


def test_field_adds_other_forms_of_what_a_text_names(spark):
    rng = random.Random(6)
    texts = documents(rng, 150)
    docs = spark.createDataFrame([(i, t, 1, "x", 0.5) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    field = pii.fit(docs)
    cases, wanted, lone = [], [], []
    for _ in range(60):
        phone, other, mail, obscured, _ = planted(rng)
        text = f"{sentences(rng, 15)} {phone} and {mail} {sentences(rng, 40)}"
        wanted.append((f"phone:{len(text) + 1}:{len(text) + 1 + len(other)}",
                       f"email:{len(text) + len(other) + 6}:{len(text) + len(other) + 6 + len(obscured)}"))
        cases.append(f"{text} {other} and {obscured}")
        # The same forms in a text that names others: nothing to agree with.
        phone, _, mail, _, _ = planted(rng)
        lone.append(f"{sentences(rng, 15)} {phone} and {mail} {sentences(rng, 40)} {other}")
    frame = spark.createDataFrame([(i, t, 1, "x", 0.5) for i, t in enumerate(cases + lone)], SCHEMA).repartition(4)
    rows = {r["doc_id"]: r for r in pii.find(frame, field).collect()}
    for i, text in enumerate(cases + lone):
        base = brute_spans(text)
        assert rows[i]["base_sha256"] == sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(rows[i]["spans"].split(","))
        assert [rows[i][f"n_{k}"] for k in PATTERNS] == [sum(s.startswith(k) for s in base) for k in PATTERNS]
    hits = [sum(w in rows[i]["spans"] for w in wanted[i]) for i in range(60)]
    false = sum(rows[60 + i]["spans"] != ",".join(brute_spans(lone[i])) for i in range(60))
    assert sum(hits) >= 108 and false <= 3   # of 120 and of 60
    # Ten repeats of one number, far apart.
    text = f"{cases[0]} " + " ".join(f"{sentences(rng, 9)} {planted(rng)[1]}" for _ in range(3))
    assert pii.find(spark.createDataFrame([(0, text * 4, 1, "x", 0.5)], SCHEMA), field).first()["spans"].count("phone") >= 8


def test_nulls_ties_clashing_columns_and_no_rows(spark):
    rows = [(1, None), (2, ""), (None, "a@b.cd"), (3, "plain text"), (3, "plain text"), (4, "1.2.3.4 " * 20_000)]
    docs = spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], SCHEMA).repartition(2)
    field = pii.fit(docs)
    found = sorted((tuple(r) for r in pii.find(docs, field).collect()), key=repr)
    assert len(found) == 6
    by_id = {r[0]: r for r in found}
    nothing = sha256(b"").hexdigest()
    assert by_id[1] == (1, 0, 0, 0, 0, nothing, "") and by_id[2][1:] == by_id[1][1:] and by_id[3][1:] == by_id[1][1:]
    assert by_id[None][1:5] == (1, 0, 0, 0) and by_id[None][6] == "email:0:6"
    assert by_id[4][2] == 20_000
    empty = spark.createDataFrame([], SCHEMA)
    assert pii.fit(empty) is None and pii.find(empty, None).count() == 0
