"""Alignment of two tokenizers' tokens over the same bytes, in Arrow.

Both tokenizers encode the same text, so their tokens end at byte offsets of the same string. Where a
token of either ends together with one of the other, a group ends; a group's tokens are linked. A block
of texts is handled as flat columns: token lists are flattened and keep their parent (document) indices,
token lengths become end offsets by cumulative sums that restart at each document, a hash join on
(document, end) finds the common ends, and ``Table.group_by`` counts a block's distinct id pairs. Spark
merges these partial counts over the corpus and sends each block the counts of the pairs it asked for;
the links themselves, about as many as tokens, are never shuffled.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockloom.llm.common import blocks, staged

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
BLOCK_BYTES = 1 << 20   # text whose pairs are counted together
ENCODED_AT_ONCE = 64    # texts
# Letters, digits and signs whose classes are the same in every Unicode version, and plain white space.
PLAIN = re.compile("[\\x20-\\x7e\\n\\r\\t\u00a1-\u024f]*+")
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
# Fixed value: how A's kind of vocabulary splits text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones stand for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """Both encoders, the bytes of their tokens, and the ids written with the signs that go before them."""

    def __init__(self, path_a: str | None = None, path_b: str | None = None):
        import sentencepiece
        from tokenizers import Tokenizer

        if path_a is None or path_b is None:
            import public_tokenizers
            path_a = path_a or public_tokenizers.path(VOCABULARY_A)
            path_b = path_b or public_tokenizers.path(VOCABULARY_B)
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True   # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size_a, size_b = self.a.get_vocab_size(), self.b.get_piece_size()
        alphabet = byte_alphabet()
        pieces = (self.a.id_to_token(i) or "" for i in range(size_a))
        self.bytes_a = pa.array([bytes(alphabet.get(c, 0) for c in p) for p in pieces], pa.large_binary())
        self.plain = self._by_ranks(path_a, alphabet)
        self.bytes_b = pa.array([self._piece(i) for i in range(size_b)], pa.large_binary())
        self.lengths_a, self.lengths_b = (pc.binary_length(b) for b in (self.bytes_a, self.bytes_b))
        # A: alone, after ";", after ","; B: after "|", after ",".
        self.size_a, self.size_b = size_a, size_b
        self.written = pa.array(
            [f"{sign}{i}".encode() for sign in ("", ";", ",") for i in range(size_a)]
            + [f"{sign}{i}".encode() for sign in ("|", ",") for i in range(size_b)], pa.large_binary())

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    @staticmethod
    def _by_ranks(path: str, alphabet: dict[str, int]):
        """A's ids of PLAIN text by tiktoken, from the same file: the quicker of two encoders of one vocabulary, which
        split such text alike. None if the file splits otherwise or its merges do not ascend with their ids."""
        import tiktoken

        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        if held["normalizer"] or held["pre_tokenizer"] != BYTE_LEVEL:
            return None
        model = held["model"]
        vocabulary, merges = model["vocab"], (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        made = np.array([vocabulary[left + right] for left, right in merges])
        if np.any(np.diff(made) <= 0) or any(c not in vocabulary for c in alphabet):
            return None
        merged = set(made.tolist())   # without added tokens, whose strings are plain text here
        ranks = {bytes(map(alphabet.__getitem__, t)): i for t, i in vocabulary.items() if i in merged or t in alphabet}
        return tiktoken.Encoding("plain", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def _ids_a(self, texts: list[str]) -> list[list[int]]:
        """Ids of space + text."""
        quick = [self.plain is not None and PLAIN.fullmatch(t) is not None for t in texts]
        rest = iter(self.a.encode_batch_fast([" " + t for t, q in zip(texts, quick) if not q], add_special_tokens=False))
        return [self.plain(" " + t) if q else next(rest).ids for t, q in zip(texts, quick)]

    def encode(self, texts: list[str]) -> tuple[pa.LargeListArray, pa.LargeListArray]:
        """Ids of space + text by A, and of the text by B, which adds the space itself."""
        def lists(encode: Callable[[list[str]], list[list[int]]]) -> pa.LargeListArray:
            parts, sizes = [np.empty(0, np.int32)], [0]
            for start in range(0, len(texts), ENCODED_AT_ONCE):
                held = encode(texts[start:start + ENCODED_AT_ONCE])
                sizes.extend(map(len, held))
                parts.append(np.fromiter(itertools.chain.from_iterable(held), np.int32))
            return pa.LargeListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int64)), pa.array(np.concatenate(parts)))

        return lists(self._ids_a), lists(lambda some: self.b.encode(some, num_threads=1))


def _ints(array: pa.Array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False)


def _joined(tokens: pa.Array, offsets: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """All bytes of binary values one after the other, and where the lists with these offsets begin and end."""
    ends = np.frombuffer(tokens.buffers()[1], np.int64)[tokens.offset:tokens.offset + len(tokens) + 1] if len(tokens) else np.zeros(1, np.int64)
    data = memoryview(tokens.buffers()[2] or b"").cast("B")
    return data, ends[offsets]


def same_bytes(texts: list[str], lists: pa.LargeListArray, token_bytes: pa.Array) -> np.ndarray:
    """Whether each list's tokens, joined, are space + text."""
    data, at = _joined(token_bytes.take(lists.flatten()), _ints(lists.offsets))
    return np.fromiter((data[s:e] == b" " + t.encode() for t, s, e in zip(texts, at[:-1].tolist(), at[1:].tolist())), bool, len(texts))


def segmented_ends(lengths: pa.Array, parents: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Cumulative sums of the lengths that start anew with each parent."""
    running = np.concatenate([[0], _ints(pc.cumulative_sum(lengths))])
    return running[1:] - running[offsets[:-1]][parents]


def document_ends(parents: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """(document, end) as one number; a block has fewer than 2^23 documents and each less than 2^40 bytes."""
    return (parents.astype(np.int64) << 40) | ends


class Aligned:
    """One block's groups, links and distinct pairs."""

    def __init__(self, texts: list[str], tools: Tokenizers):
        self.tools, self.documents = tools, len(texts)
        a, b = tools.encode(texts)
        usable = same_bytes(texts, a, tools.bytes_a) & same_bytes(texts, b, tools.bytes_b) & np.array([t != "" for t in texts], bool)
        if not usable.all():   # such documents have no tokens
            a, b = (self._emptied(x, usable) for x in (a, b))
        self.offsets_a, self.offsets_b = _ints(a.offsets).astype(np.int64), _ints(b.offsets).astype(np.int64)
        self.ids_a, self.ids_b = a.flatten(), b.flatten()
        self.parents_a, self.parents_b = _ints(pc.list_parent_indices(a)), _ints(pc.list_parent_indices(b))
        ends = [pa.table({"end": document_ends(parents, segmented_ends(lengths.take(ids), parents, offsets)),
                          name: np.arange(len(ids))})
                for ids, parents, offsets, lengths, name in (
                    (self.ids_a, self.parents_a, self.offsets_a, tools.lengths_a, "i"),
                    (self.ids_b, self.parents_b, self.offsets_b, tools.lengths_b, "j"))]
        common = ends[0].join(ends[1], "end", join_type="inner", use_threads=False)
        # Tokens that close a group; groups are numbered through the block, alike on both sides.
        self.closes_a, self.closes_b = np.zeros(len(self.ids_a), bool), np.zeros(len(self.ids_b), bool)
        self.closes_a[common["i"].to_numpy()] = True
        self.closes_b[common["j"].to_numpy()] = True
        self.group_a, self.group_b = (np.cumsum(c) - c for c in (self.closes_a, self.closes_b))
        self.group_document = self.parents_a[self.closes_a]
        groups = len(self.group_document)
        self.held_a, self.held_b = (np.bincount(g, minlength=groups) for g in (self.group_a, self.group_b))

    @staticmethod
    def _emptied(lists: pa.LargeListArray, usable: np.ndarray) -> pa.LargeListArray:
        return pc.fill_null(pc.if_else(pa.array(usable), lists, pa.scalar(None, lists.type)), pa.scalar([], lists.type))

    def per_document(self, weights: np.ndarray | None = None) -> np.ndarray:
        """Number of groups of each document, or the sum of the groups' weights."""
        return np.bincount(self.group_document, weights, self.documents).astype(np.int64)

    def links(self) -> pa.Table:
        """(document, a, b, times): how often a document holds each pair."""
        alone = (self.held_a == 1) & (self.held_b == 1)
        single = pa.table({
            "document": self.group_document[alone].astype(np.int64), "a": self.ids_a.filter(pa.array(alone[self.group_a])),
            "b": self.ids_b.filter(pa.array(alone[self.group_b])), "times": np.ones(int(alone.sum()), np.int64)})
        sides = []
        for ids, group, name in ((self.ids_a, self.group_a, "a"), (self.ids_b, self.group_b, "b")):
            several = ~alone[group]
            sides.append(pa.table({"group": group[several], name: ids.filter(pa.array(several))}).group_by(
                ["group", name], use_threads=False).aggregate([([], "count_all")]).rename_columns(["group", name, f"n_{name}"]))
        met = sides[0].join(sides[1], "group", join_type="inner", use_threads=False)
        groups = met["group"].to_numpy()
        crossed = pa.table({"document": self.group_document[groups].astype(np.int64), "a": met["a"], "b": met["b"],
                            "times": pc.multiply(met["n_a"], met["n_b"])})
        return pa.concat_tables([single, crossed]).group_by(["document", "a", "b"], use_threads=False).aggregate(
            [("times", "sum")]).rename_columns(["document", "a", "b", "times"])

    def digests(self) -> list[str]:
        """sha256 of each document's groups, written as a1,a2|b1;a3|b2,b3; empty without tokens."""
        first_a = np.concatenate([[True], self.closes_a[:-1]])[:len(self.ids_a)]
        first_b = np.concatenate([[True], self.closes_b[:-1]])[:len(self.ids_b)]
        sign_a = np.where(first_a, 1, 2)
        starts = self.offsets_a[:-1][np.diff(self.offsets_a) > 0]
        sign_a[starts] = 0
        size = self.tools.size_a
        # A's tokens of a group, then B's: where each stands among all.
        order = np.empty(len(self.ids_a) + len(self.ids_b), np.int64)
        before_b, upto_a = np.cumsum(self.held_b) - self.held_b, np.cumsum(self.held_a)
        order[np.arange(len(self.ids_a)) + before_b[self.group_a]] = sign_a * size + _ints(self.ids_a)
        order[np.arange(len(self.ids_b)) + upto_a[self.group_b]] = (
            3 * size + np.where(first_b, 0, self.tools.size_b) + _ints(self.ids_b))
        data, at = _joined(self.tools.written.take(pa.array(order)), self.offsets_a + self.offsets_b)
        return [sha256(data[s:e]).hexdigest() if e > s else "" for s, e in zip(at[:-1].tolist(), at[1:].tolist())]


COUNTS = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def _aligner(kind: pa.DataType, path_a: str | None, path_b: str | None, block_bytes: int):
    """Rows of a block's documents (with the numbers of their pairs), then of its distinct pairs."""
    schema = pa.schema([
        ("block", pa.int64()), ("doc_id", kind), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
        ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("slots", pa.list_(pa.int32())), ("times", pa.list_(pa.int64())),
        ("slot", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("documents", pa.int64())])

    def batch(rows: int, columns: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(rows, f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools, number = None, TaskContext.get().partitionId() << 32
        for part in blocks(batches, most_bytes=block_bytes):
            tools = tools or Tokenizers(path_a, path_b)
            found = Aligned([t or "" for t in part.column("text").to_pylist()], tools)
            links = found.links().sort_by("document")
            key = pc.add(pc.shift_left(links["a"].cast(pa.int64()), 32), links["b"].cast(pa.int64())).combine_chunks()
            named = pc.dictionary_encode(key)
            counted = pa.table({"slot": named.indices}).group_by("slot", use_threads=False).aggregate([([], "count_all")])
            of = np.searchsorted(links["document"].to_numpy(), np.arange(found.documents + 1)).astype(np.int32)
            nested = lambda values: pa.ListArray.from_arrays(pa.array(of), values)
            yield batch(found.documents, {
                "block": np.full(found.documents, number), "doc_id": part.column("doc_id"),
                "n_a": np.diff(found.offsets_a), "n_b": np.diff(found.offsets_b), "n_groups": found.per_document(),
                "n_links": found.per_document(found.held_a * found.held_b), "groups_sha256": found.digests(),
                "slots": nested(named.indices), "times": nested(links["times"].combine_chunks())})
            slots = counted["slot"].combine_chunks()
            keys = _ints(named.dictionary.take(slots))
            yield batch(len(slots), {"block": np.full(len(slots), number), "slot": slots, "a": keys >> 32,
                                     "b": keys & 0xFFFFFFFF, "documents": counted["count_all"].combine_chunks()})
            number += 1
    return run


def aligned_blocks(docs: DataFrame, path_a: str | None = None, path_b: str | None = None,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The stored rows of :func:`_aligner` for all documents; ``slot`` is null on rows of documents."""
    kind = dict(docs.dtypes)["doc_id"]
    arrow_kind = docs.select("doc_id").limit(0).toArrow().schema.field(0).type
    return staged(docs.select("doc_id", "text").mapInArrow(_aligner(arrow_kind, path_a, path_b, block_bytes), (
        f"block long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "slots array<int>, times array<long>, slot int, a int, b int, documents long")), "aligned")


def pair_counts(known: DataFrame) -> DataFrame:
    """(a, b, count, best): documents that hold a pair linked, and whether no pair of that A id has more.

    The window holds one row per B id at most.
    """
    merged = known.where("slot is not null").groupBy("a", "b").agg(F.sum("documents").alias("count"))
    return merged.select("a", "b", "count", (F.col("count") == F.max("count").over(W.partitionBy("a"))).alias("best"))


def _summed(kind: pa.DataType):
    schema = pa.schema([("doc_id", kind), *((c, pa.int64()) for c in COUNTS[:4]), ("groups_sha256", pa.string()),
                        ("n_best", pa.int64()), ("count_sum", pa.int64())])

    def run(documents: pa.Table, answers: pa.Table) -> pa.Table:
        counts, best = np.zeros((2, len(answers)), np.int64)
        slots = answers["slot"].to_numpy()
        counts[slots], best[slots] = answers["count"].to_numpy(), answers["best"].to_numpy()
        documents = documents.combine_chunks()
        lists, times = (documents[c].combine_chunks() for c in ("slots", "times"))
        at, weight = _ints(lists.flatten()), _ints(times.flatten())
        ends = np.concatenate([[0], np.cumsum(_ints(pc.list_value_length(lists)))])
        sums = []
        for value in (best, counts):
            running = np.concatenate([[0], np.cumsum(weight * value[at])])
            sums.append(pa.array(running[ends[1:]] - running[ends[:-1]]))
        return pa.table([*(documents[c] for c in ("doc_id", *COUNTS)), *sums], names=schema.names).cast(schema)
    return run


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    Texts that are null or empty, or whose tokens of either tokenizer do not join to space + text, have no
    tokens: zeros and an empty digest. Rows that share a doc_id are documents of their own; equal texts count
    as often as they occur; other columns are not read; no rows: no rows. A pair's count is the number of
    documents that hold it linked; ties for an A id's highest count are all best. ``path_a`` (a tokenizers
    file, byte-level) and ``path_b`` (a sentencepiece model) are paths on every executor.
    """
    known = aligned_blocks(docs, path_a, path_b, block_bytes)
    asked = known.where("slot is not null").select("block", "slot", "a", "b")
    answers = asked.join(pair_counts(known), ["a", "b"]).select(F.col("block").alias("owner"), "slot", "count", "best")
    documents = known.where("slot is null").select("block", "doc_id", *COUNTS, "slots", "times")
    kind = dict(docs.dtypes)["doc_id"]
    arrow_kind = docs.select("doc_id").limit(0).toArrow().schema.field(0).type
    return documents.groupBy("block").cogroup(answers.groupBy("owner")).applyInArrow(
        _summed(arrow_kind), f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
