"""Personal data: fixed patterns, and a skip-chain conditional random field that finds what they miss.

The patterns name e-mail addresses, IP addresses, card and phone numbers. A document's tokens with a digit,
an at sign or an address's name are the field's nodes; neighbours share a potential, and so do distant tokens
that repeat each other or are similar (the same last seven digits, the same mail name). Of m such tokens each is
tied to the one that the patterns know best, m - 1 ties, never all pairs. Loopy sum-product message passing
over a whole document makes the labels agree, so that "743.555.3824" is a phone number where "+1 (743) 555-3824"
stands elsewhere in the text, and a plain number where it does not.

No labelled text exists, so the field is fitted by pseudo-likelihood on a bounded sample of documents in which the
patterns find something: a third of the mentions are written again in another form with the same label, and numbers of
the same form that repeat nothing are written in with the label "none".
"""

from __future__ import annotations

import random
import re
import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import blocks, seeded_hash, text_of, unit_interval

# The kinds in the order of the report, and their patterns.
KINDS = ("email", "ip", "card", "phone")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match of the two number patterns can only begin where a run of digits does, and never gives digits back.
IP = re.compile(r"(?<![0-9])[0-9]++\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NAME_CHARACTERS = frozenset(string.ascii_letters + string.digits + "._%+-")

LABELS = 5            # none and the four kinds
SAMPLE = 1_000        # documents that the field is fitted on, about
SAMPLE_CHARACTERS = 20_000   # longest document of the sample
ROUNDS, STEP, PENALTY = 250, 0.05, 1e-4
PASSES = 12           # rounds of messages
CERTAIN = 0.8         # least probability of an added label
DIGITS = 7            # digits that make numbers similar
BUCKETS = 4096        # weights of token features
CHAIN, SAME, NUMBER, MAILBOX = range(4)   # kinds of ties

Span = tuple[int, int, int]   # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for place, d in enumerate(reversed(digits)):
        value = int(d) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """What the patterns find: leftmost, without overlap inside a kind, by start and then kind."""
    found: list[Span] = []
    at, free = text.find("@"), 0
    while at >= 0:
        match = DOMAIN.match(text, at)
        if match:
            start = at
            while start > free and text[start - 1] in NAME_CHARACTERS:
                start -= 1
            if start < at:
                free = match.end()
                found.append((0, start, free))
        at = text.find("@", max(at + 1, free))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            found.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        digits = digits_of(m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(digits_of(m.group())) <= 15:
                found.append((3, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], s[0], s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


# --- the field's graph ---------------------------------------------------------------------------------

CHUNK = re.compile(r"\S+")
DIGIT_OR_AT = re.compile(r"[0-9@]")
AT_FORMS = re.compile(r"@|[(\[]at[)\]]", re.IGNORECASE)
RUN = re.compile(r"[0-9]+|[^\W\d_]+")
BARE = string.punctuation.replace("+", "")


@dataclass
class Graph:
    """Nodes (start, end) with feature numbers and the patterns' label (0: none), and ties (i, j, kind)."""

    spans: list[tuple[int, int]]
    features: list[list[int]]
    base: list[int]
    ties: list[tuple[int, int, int]]


def _shape(token: str) -> str:
    """Runs of digits by length and runs of letters, cut to 24 signs."""
    return RUN.sub(lambda m: f"d{min(len(m.group()), 20)}" if m.group()[0].isdecimal() else "a", token)[:24]


def _feature(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


def graph(text: str, spans: list[Span]) -> Graph:
    """The nodes and ties of a text in which the patterns found ``spans``."""
    names = {text[s:e].split("@")[0].lower() for k, s, e in spans if k == 0}
    tokens, gaps, last = [], [], None
    for number, chunk in enumerate(CHUNK.finditer(text)):
        raw = chunk.group()
        core = raw.rstrip(string.punctuation)
        end = chunk.start() + len(core)
        core = core.lstrip(BARE)
        if core and (DIGIT_OR_AT.search(core) or AT_FORMS.search(core) or core.lower() in names):
            tokens.append((end - len(core), end, core))
            gaps.append(last is not None and number == last + 1)
            last = number
    base, at = [], 0
    ordered = sorted(spans, key=lambda s: s[1])
    for start, end, _ in tokens:
        while at < len(ordered) and ordered[at][2] <= start:
            at += 1
        inside = [k + 1 for k, s, e in ordered[at:at + 8] if s < end and e > start]
        base.append(inside[0] if inside else 0)
    shapes = [_shape(t) for _, _, t in tokens]
    features, ties, groups = [], [], {}
    for i, (_, _, token) in enumerate(tokens):
        digits, low = digits_of(token), token.lower()
        mailbox = AT_FORMS.split(low)[0] if AT_FORMS.search(low) else low if low in names else ""
        names_of = ["bias", f"shape {shapes[i]}", f"digits {min(len(digits), 20)}", f"base {base[i]}",
                    f"at {bool(AT_FORMS.search(low))}", f"plus {token.startswith('+')}", f"dots {min(token.count('.'), 5)}",
                    f"letters {any(c.isalpha() for c in token)}"]
        if gaps[i]:
            names_of.append(f"before {shapes[i - 1]}")
            ties.append((i - 1, i, CHAIN))
        if i + 1 < len(tokens) and gaps[i + 1]:
            names_of.append(f"after {shapes[i + 1]}")
        features.append([_feature(n) for n in names_of])
        keys = [(SAME, low)] if len(low) > 3 else []
        if len(digits) >= DIGITS:
            keys.append((NUMBER, digits[-DIGITS:]))
        if mailbox:
            keys.append((MAILBOX, mailbox))
        for key in keys:
            groups.setdefault(key, []).append(i)
    for (kind, _), held in groups.items():
        # The first token that the patterns know, else the first: a star has m - 1 ties and no long ways.
        centre = next((i for i in held if base[i]), held[0])
        ties.extend((centre, i, kind) for i in held if i != centre)
    return Graph([(s, e) for s, e, _ in tokens], features, base, ties)


SLOTS = 10   # features of a token, at most


def union(graphs: list[Graph]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers (padded), base labels and ties of several graphs side by side."""
    sizes = [len(g.spans) for g in graphs]
    features = np.full((sum(sizes), SLOTS), BUCKETS, np.int32)
    at = 0
    ties = [np.empty((0, 3), np.int64)]
    for g, size in zip(graphs, sizes):
        for i, held in enumerate(g.features):
            features[at + i, :len(held)] = held
        if g.ties:
            ties.append(np.array(g.ties, np.int64) + [at, at, 0])
        at += size
    return features, np.array([b for g in graphs for b in g.base], np.int64), np.concatenate(ties)


@dataclass
class Field:
    """Weights of token features (the last row pads with zeros) and potentials of the four kinds of ties."""

    unary: np.ndarray
    pair: np.ndarray


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def marginals(scores: np.ndarray, ties: np.ndarray, pair: np.ndarray, passes: int = PASSES) -> np.ndarray:
    """Label probabilities of every node by loopy sum-product; exact where the ties form trees.

    The number of passes is fixed, so a document's result does not depend on what is computed beside it.
    """
    n, edges = len(scores), len(ties)
    if not edges:
        return np.exp(scores - _log_sum(scores, 1)[:, None])
    source = np.concatenate([ties[:, 0], ties[:, 1]])
    target = np.concatenate([ties[:, 1], ties[:, 0]])
    potentials = np.concatenate([pair[ties[:, 2]], pair[ties[:, 2]].transpose(0, 2, 1)])
    back = np.concatenate([np.arange(edges, 2 * edges), np.arange(edges)])
    messages = np.zeros((2 * edges, LABELS))

    def beliefs() -> np.ndarray:
        return scores + np.stack([np.bincount(target, messages[:, k], n) for k in range(LABELS)], axis=1)

    for number in range(passes):
        sent = _log_sum((beliefs()[source] - messages[back])[:, :, None] + potentials, 1)
        sent -= _log_sum(sent, 1)[:, None]
        # Half steps settle loops; the first rounds go in full, which trees need only.
        messages = sent if number < passes // 2 else (messages + sent) / 2
    total = beliefs()
    return np.exp(total - _log_sum(total, 1)[:, None])


def fit_field(graphs: list[Graph], labels: list[list[int]]) -> Field:
    """Pseudo-likelihood by Adam steps over all nodes; every node is judged beside its neighbours' labels."""
    features, _, ties = union(graphs)
    truth = np.array([y for held in labels for y in held], np.int64)
    n = len(truth)
    weights, pair = np.zeros((BUCKETS + 1, LABELS)), np.zeros((4, LABELS, LABELS))
    wanted = np.eye(LABELS)[truth]
    state = [np.zeros_like(x) for x in (weights, weights, pair, pair)]
    i, j, kind = ties.T
    for step in range(1, ROUNDS + 1):
        logits = weights[features].sum(axis=1)
        np.add.at(logits, i, pair[kind, :, truth[j]])
        np.add.at(logits, j, pair[kind, truth[i]])
        error = np.exp(logits - _log_sum(logits, 1)[:, None]) - wanted
        slopes = [np.zeros_like(weights), np.zeros_like(pair)]
        np.add.at(slopes[0], features, error[:, None, :])
        slopes[0][BUCKETS] = 0.0
        np.add.at(slopes[1], (kind, slice(None), truth[j]), error[i])
        np.add.at(slopes[1], (kind, truth[i]), error[j])
        slopes[1][1:] += slopes[1][1:].transpose(0, 2, 1).copy()   # distant ties have no direction
        for k, x in enumerate((weights, pair)):
            slope = slopes[k] / n + PENALTY * x
            first, second = state[2 * k], state[2 * k + 1]
            first += 0.1 * (slope - first)
            second += 0.001 * (slope * slope - second)
            x -= STEP * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Field(weights, pair)


# --- training text -------------------------------------------------------------------------------------

def other_form(kind: int, mention: str, rng: random.Random) -> str:
    """The mention in a form that the patterns do not know."""
    digits = digits_of(mention)
    if kind == 0:
        name, host = mention.split("@", 1)
        return rng.choice([f"{name}(at){host}", f"{name}[at]{host}", f"{name}@{host.split('.')[0]}", name])
    if kind == 1:
        return rng.choice("-_:/").join(mention.split("."))
    if kind == 2:
        return rng.choice("./_").join(digits[i:i + 4] for i in range(0, len(digits), 4))
    local = digits[-10:]
    return rng.choice([f"({local[:3]}) {local[3:6]}-{local[6:]}", f"{local[:3]}-{local[3:6]}-{local[6:]}",
                       f"{local[:3]}.{local[3:6]}.{local[6:]}", local, f"00{digits}"])


def _other_digits(text: str, rng: random.Random) -> str:
    return "".join(rng.choice(string.digits) if "0" <= c <= "9" else c for c in text)


def training_graph(text: str) -> tuple[Graph, list[int]]:
    """The text's graph and labels, after some mentions were written again and look-alikes written in."""
    rng = random.Random(zlib.crc32(text.encode("utf-8", "surrogatepass")))
    pieces, planted = [text], []
    length = len(text)
    spans = base_spans(text)
    for kind, start, end in spans:
        mention = text[start:end]
        for label, part in ((kind + 1, other_form(kind, mention, rng)),
                            (0, _other_digits(other_form(kind, mention, rng) if kind else f"n{mention.split('@')[0]}", rng))):
            if rng.random() < 1 / 3:
                filler = " and so "
                pieces.append(filler + part)
                planted.append((length + len(filler), length + len(filler) + len(part), label))
                length += len(filler) + len(part)
    whole = "".join(pieces)
    made = graph(whole, base_spans(whole))
    labels = []
    for (start, end), base in zip(made.spans, made.base):
        label = next((y for s, e, y in planted if s < end and e > start), base)
        labels.append(label)
    return made, labels


def fit(docs: DataFrame, sample: int = SAMPLE, longest: int = SAMPLE_CHARACTERS) -> Field | None:
    """The field fitted on about ``sample`` documents, chosen by a hash of their text, that hold an at sign, a plus
    with a digit, a dotted number or a long number and have at most ``longest`` characters; None if the patterns find
    nothing in them. Every document is looked at for the choice; repeated texts count once."""
    likely = docs.select(text_of().alias("text")).where(
        (F.length("text") <= longest) & F.col("text").rlike(r"@[A-Za-z0-9]|\+[0-9]|[0-9]\.[0-9]+\.[0-9]|[0-9]{12}"))
    share = min(1.0, sample / max(1, likely.count()))
    texts = [r["text"] for r in likely.where(unit_interval(seeded_hash(31, F.col("text"))) < share).distinct().limit(2 * sample).collect()]
    made = [training_graph(t) for t in sorted(texts)]
    if not any(b for g, _ in made for b in g.base):
        return None
    return fit_field([g for g, _ in made], [y for _, y in made])


# --- over documents ------------------------------------------------------------------------------------

def added_spans(text: str, spans: list[Span], made: Graph, chances: np.ndarray) -> list[Span]:
    """Runs of neighbouring tokens of one label, outside what the patterns found."""
    out: list[Span] = []
    best = chances.argmax(axis=1)
    open_ = False
    for i, (start, end) in enumerate(made.spans):
        label = int(best[i])
        if made.base[i] or not label or chances[i, label] < CERTAIN:
            open_ = False
            continue
        if open_ and out[-1][0] == label - 1 and not text[out[-1][2]:start].strip(" ()"):
            out[-1] = (label - 1, out[-1][1], end)
        else:
            out.append((label - 1, start, end))
        open_ = True
    return out


def _finder(field: Field | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            base = [base_spans(t) if DIGIT_OR_AT.search(t) else [] for t in texts]
            chosen = [i for i, t in enumerate(texts) if DIGIT_OR_AT.search(t)] if field else []
            graphs = [graph(texts[i], base[i]) for i in chosen]
            extra: dict[int, list[Span]] = {}
            if graphs:
                features, _, ties = union(graphs)
                chances = marginals(field.unary[features].sum(axis=1), ties, field.pair)
                at = 0
                for i, made in zip(chosen, graphs):
                    extra[i] = added_spans(texts[i], base[i], made, chances[at:at + len(made.spans)])
                    at += len(made.spans)
            counts = [[sum(k == kind_ for k, _, _ in spans) for spans in base] for kind_ in range(len(KINDS))]
            every = [sorted([*spans, *extra.get(i, [])], key=lambda s: (s[1], s[0], s[2])) for i, spans in enumerate(base)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([sha256(written(s).encode()).hexdigest() for s in base]), pa.array([written(s) for s in every])],
                ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    return run


def find(docs: DataFrame, field: Field | None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row.

    The numbers and the digest are of what the patterns find, ``spans`` (kind:start:end in code points, by start,
    then kind) also holds what the field adds; nothing of the patterns' is dropped. A token is added where one
    label has a probability of ``CERTAIN`` and the patterns do not cover it. Null and empty texts have no spans; rows
    that share a doc_id are documents of their own; other columns are not read; no rows: no rows; without a
    field nothing is added.
    """
    names = "".join(f", n_{k} long" for k in KINDS)
    return docs.select("doc_id", "text").mapInArrow(
        _finder(field), f"doc_id {dict(docs.dtypes)['doc_id']}{names}, base_sha256 string, spans string")
