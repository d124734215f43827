"""Substring dedup: repeated word windows found by prefix-partitioned suffixes.

All suffixes of all texts are too many to move, so suffixes are sampled and split by prefix first:

1. Every window of ``WINDOW`` words has an anchor, the ``PREFIX`` consecutive words in it with the
   smallest hash. Equal windows have equal anchors at equal places. Anchors are partitioned by their
   hash, the suffixes' short prefix; a prefix that occurs once has no repeat below it and is dropped.
2. Below each prefix that occurs again, the windows around it are the suffix tree cut at the depth
   that matters: a node at depth ``WINDOW`` with two leaves or more is a repeat. Windows are known by
   128 bits (anchor hash and window hash); groups are sorted in memory, and a group that exceeds
   ``GROUP_ROWS`` is split by the longer prefix, the whole window, into groups of its own.
3. Adjacent repeated windows unite to maximal repeats, whose words are removed.

Before anything is shuffled, equal anchors and windows of one block of texts are settled in place and
sent on once, so a passage or copy that a third of all documents share is a few rows per block.
Texts are shuffled once, by a hash of their content.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockloom.llm.common import blocks, give_back

WINDOW = 35
PREFIX = 12
GROUP_ROWS = 200_000
BLOCK_BYTES = 4 << 20
EVERYTHING = 2**31 - 1

_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _rolling(words: np.ndarray, n: int, factor: np.uint64) -> np.ndarray:
    """Hash of the n words from each position on."""
    out = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for i in range(n if len(out) else 0):
        out = out * factor + words[i:i + len(out)]
    return _mix(out)


class Block:
    """Texts laid end to end: the anchor of each window that lies in one text."""

    def __init__(self, texts: list[bytes], window: int, prefix: int):
        words = [t.split() for t in texts]
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for text in words for w in text), np.uint64, int(self.lengths.sum()))
        owner = np.repeat(np.arange(len(words)), self.lengths)
        self.prefix_hash = _rolling(hashes, prefix, _SPREAD)
        total = len(hashes) - window + 1
        if total <= 0:
            self.start = self.anchor = self.owner = np.empty(0, np.int64)
            self.window_hash = np.empty(0, np.uint64)
            return
        inside = np.flatnonzero(owner[:total] == owner[window - 1:])
        # Smallest hash in each run of candidates, the first of equals: two overlapping power-of-two runs.
        reach, least = window - prefix + 1, np.arange(len(self.prefix_hash))
        span = 1
        while 2 * span <= reach:
            least = self._smaller(least[:len(least) - span], least[span:])
            span *= 2
        shift = reach - span
        least = self._smaller(least[:len(least) - shift], least[shift:]) if shift else least
        self.start, self.anchor, self.owner = inside, least[:total][inside], owner[:total][inside]
        self.window_hash = _rolling(hashes, window, _OTHER)[inside]

    def _smaller(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(self.prefix_hash[b] < self.prefix_hash[a], b, a)


def _texts(column) -> list[bytes]:
    return [b"" if t is None else t.encode() for t in column.to_pylist()]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _anchors(window: int, prefix: int):
    """(h, ck, pos): one row with hash for each anchor new to the block; rows without hash are settled.

    pos -1 marks a text that the block holds twice.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, most_bytes=BLOCK_BYTES):
            keys, seen, fresh, copied = batch.column("ck").to_pylist(), set(), [], set()
            for i, key in enumerate(keys):
                if key in seen:
                    copied.add(key)
                else:
                    seen.add(key)
                    fresh.append(i)
            part = batch.take(pa.array(fresh, pa.int64()))
            block = Block(_texts(part.column("text")), window, prefix)
            new = np.concatenate([[True], np.diff(block.anchor) != 0]) if len(block.anchor) else np.empty(0, bool)
            anchor, owner = block.anchor[new], block.owner[new]
            h, pos = block.prefix_hash[anchor], anchor - block.first[owner]
            order = np.argsort(h, kind="stable")
            same = np.zeros(len(h), bool)
            same[1:] = h[order][1:] == h[order][:-1]
            again = np.zeros(len(h), bool)
            again[order] = same                      # a later occurrence in this block
            twice = np.zeros(len(h), bool)
            twice[order] = same | np.append(same[1:], False)
            ck = part.column("ck")
            send = np.concatenate([np.flatnonzero(~again), np.flatnonzero(twice)])
            hashed = np.concatenate([np.ones((~again).sum(), bool), np.zeros(twice.sum(), bool)])
            yield pa.RecordBatch.from_arrays([
                pa.array(h[send].view(np.int64), mask=~hashed),
                ck.take(pa.array(owner[send])),
                pa.array(pos[send].astype(np.int32))], ["h", "ck", "pos"])
            if copied:
                yield pa.RecordBatch.from_arrays([
                    pa.array([None] * len(copied), pa.int64()), pa.array(sorted(copied), pa.binary()),
                    pa.array([-1] * len(copied), pa.int32())], ["h", "ck", "pos"])
    return run


def _repeated_runs(keys: list[str]):
    """Of rows sorted by ``keys``: those whose keys another row shares, and all without keys; keys dropped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        matched = False   # the held row equals one before it

        def rest(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.select([n for n in batch.schema.names if n not in keys])

        for batch in batches:
            null = batch.column(keys[0]).is_null().to_numpy(zero_copy_only=False)
            if null.any():
                yield rest(batch.filter(pa.array(null)))
                batch = batch.filter(pa.array(~null))
            if not batch.num_rows:
                continue
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
            equal = np.logical_and.reduce([v[1:] == v[:-1] for v in values]) if batch.num_rows > 1 else np.empty(0, bool)
            keep = np.append(equal, False) | np.append(matched and held is not None, equal)
            last = batch.num_rows - 1
            yield rest(batch.slice(0, last).filter(pa.array(keep[:last])))
            held, matched = batch.slice(last), bool(keep[last])
        if held is not None and matched:
            yield rest(held)
    return run


def _ranges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of true flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _windows(window: int, prefix: int):
    """(h, ck, a, b, ws): windows around repeated anchors.

    With h: the hashes ws of the windows that start at a, a + 1, ..., each sent once for the block.
    Without h: words a to b of the text are covered by windows that the block itself holds twice.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, most_bytes=BLOCK_BYTES):
            first_of: dict[bytes, int] = {}
            copied = set()
            for i, key in enumerate(batch.column("ck").to_pylist()):
                if first_of.setdefault(key, i) != i:
                    copied.add(key)
            if copied:   # copies of one text meet here: all of its windows are repeated
                nothing = np.zeros(len(copied), np.int32)
                yield rows_of(None, pa.array(sorted(copied), pa.binary()), nothing, nothing + EVERYTHING, None)
            part = batch.take(pa.array(list(first_of.values()), pa.int64()))
            block = Block(_texts(part.column("text")), window, prefix)
            marks = part.column("anchors")
            counts = pc.list_value_length(marks).to_numpy(zero_copy_only=False)
            where = marks.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            doc = np.repeat(np.arange(len(counts)), counts)
            wanted = np.zeros(len(block.prefix_hash) + 1, bool)
            wanted[(where + block.first[doc])[where >= 0]] = True
            chosen = wanted[block.anchor]
            start, anchor, owner = block.start[chosen], block.anchor[chosen], block.owner[chosen]
            h, w = block.prefix_hash[anchor], block.window_hash[chosen]
            order = np.lexsort((w, h))
            same = np.zeros(len(w), bool)
            same[1:] = (h[order][1:] == h[order][:-1]) & (w[order][1:] == w[order][:-1])
            again, twice = np.zeros(len(w), bool), np.zeros(len(w), bool)
            again[order] = same
            twice[order] = same | np.append(same[1:], False)[:len(same)]
            ck, offset = part.column("ck"), start - block.first[owner]

            # Settled in the block: runs of adjacent windows.
            s, o, own = start[twice], offset[twice], owner[twice]
            cut = np.flatnonzero(np.concatenate([[True], (np.diff(s) != 1) | (np.diff(own) != 0)])) if len(s) else np.empty(0, int)
            ends = np.append(cut[1:], len(s)) - 1 if len(s) else cut
            yield rows_of(None, ck.take(pa.array(own[cut])), o[cut], o[ends] + window, None)

            # To be compared with other blocks: runs of adjacent windows with one anchor.
            s, a, o, own, hs, ws = (x[~again] for x in (start, anchor, offset, owner, h, w))
            cut = np.flatnonzero(np.concatenate([[True], (np.diff(s) != 1) | (np.diff(a) != 0)])) if len(s) else np.empty(0, int)
            data = ws.tobytes()
            lists = [data[8 * i:8 * j] for i, j in zip(cut.tolist(), np.append(cut[1:], len(s)).tolist())]
            yield rows_of(hs[cut], ck.take(pa.array(own[cut])), o[cut], o[cut], lists)

    def rows_of(h, ck, a, b, ws):
        n = len(a)
        return pa.RecordBatch.from_arrays([
            pa.nulls(n, pa.int64()) if h is None else _signed(h), ck, pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)),
            pa.nulls(n, pa.binary()) if ws is None else pa.array(ws, pa.binary())], ["h", "ck", "a", "b", "ws"])
    return run


def _deep_nodes(window: int):
    """Of window rows sorted by prefix hash: (h, w, ck, a, b), covered words (no h), or windows of large groups."""
    names = ["h", "w", "ck", "a", "b"]

    def settle(rows: pa.RecordBatch) -> pa.RecordBatch:
        ws = rows.column("ws").to_pylist()
        counts = np.array([len(x) // 8 for x in ws])
        w, h = np.frombuffer(b"".join(ws), np.int64), np.repeat(rows.column("h").to_numpy(), counts)
        order = np.lexsort((w, h))
        same = np.zeros(len(w), bool)
        same[1:] = (h[order][1:] == h[order][:-1]) & (w[order][1:] == w[order][:-1])
        flags = np.zeros(len(w), bool)
        flags[order] = same | np.append(same[1:], False)[:len(same)]
        # A gap after each row keeps the runs of different rows apart.
        begins = np.cumsum(counts) - counts + np.arange(len(counts))
        spaced = np.zeros(len(w) + len(counts), bool)
        at = np.arange(len(w)) + np.repeat(np.arange(len(counts)), counts)
        spaced[at] = flags
        lo, hi = _ranges(spaced)
        row = np.searchsorted(begins, lo, side="right") - 1
        a = rows.column("a").to_numpy()[row] + lo - begins[row]
        return out(rows.column("ck").take(pa.array(row)), a, a + (hi - lo) + window - 1)

    def out(ck, a, b, h=None, w=None):
        n = len(a)
        return pa.RecordBatch.from_arrays([
            pa.nulls(n, pa.int64()) if h is None else pa.array(h), pa.nulls(n, pa.int64()) if w is None else pa.array(w), ck,
            pa.array(np.asarray(a).astype(np.int32)), pa.array(np.asarray(b).astype(np.int32))], names)

    def spread(rows: pa.RecordBatch) -> pa.RecordBatch:
        """Each window of a large group by itself."""
        ws = rows.column("ws").to_pylist()
        counts = np.array([len(x) // 8 for x in ws])
        row = np.repeat(np.arange(len(counts)), counts)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        a = rows.column("a").to_numpy()[row] + nth
        return out(rows.column("ck").take(pa.array(row)), a, a + window, rows.column("h").to_numpy()[row],
                   np.frombuffer(b"".join(ws), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []   # rows of the one group that may go on
        held_rows, held_key, large = 0, None, False

        for batch in batches:
            null = batch.column("h").is_null().to_numpy(zero_copy_only=False)
            if null.any():
                known = batch.filter(pa.array(null))
                yield out(known.column("ck"), known.column("a").to_numpy(), known.column("b").to_numpy())
                batch = batch.filter(pa.array(~null))
            if not batch.num_rows:
                continue
            h = batch.column("h").to_numpy()
            tail = int(np.searchsorted(h, h[-1], side="left"))   # rows are sorted: the last group begins here
            head_end = int(np.searchsorted(h, held_key, side="right")) if held_key is not None else 0
            whole = tail > 0 or (held_key is not None and h[0] != held_key)
            if large:
                if head_end:
                    yield spread(batch.slice(0, head_end))
                batch, tail = batch.slice(head_end), tail - head_end
                if not batch.num_rows:
                    continue
                held, held_rows, large = [], 0, False
                tail = max(tail, 0)
                whole = tail > 0
            if whole:
                done = [*held, batch.slice(0, tail)]
                yield settle(pa.Table.from_batches(done).combine_chunks().to_batches()[0]) if sum(x.num_rows for x in done) else out(
                    pa.array([], pa.binary()), [], [])
                held, held_rows = [], 0
            held.append(batch.slice(tail))
            held_rows, held_key = held_rows + batch.num_rows - tail, int(h[-1])
            if held_rows > GROUP_ROWS:
                large = True
                for part in held:
                    yield spread(part)
                held, held_rows = [], 0
        if held_rows:
            yield settle(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
    return run


def _cut(window: int):
    schema = T.StructType([
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())])

    @F.pandas_udf(schema)
    def run(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, begins, ends in parts:
            rows = []
            for text, a, b in zip(texts, begins, ends):
                words = (text or "").encode().split()
                n = len(words)
                if a is not None and n >= window and len(a):
                    depth = np.zeros(n + 1, np.int64)
                    np.add.at(depth, np.clip(a, 0, n), 1)
                    np.add.at(depth, np.clip(b, 0, n), -1)
                    kept = np.cumsum(depth[:n]) == 0
                    words = [words[i] for i in np.flatnonzero(kept).tolist()]
                rows.append((n, n - len(words), b" ".join(words).decode()))
            yield pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_text"])
        give_back()
    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text, the words left joined by one space.

    A word goes if a window of ``window`` consecutive words that covers it also starts anywhere else, in
    the same or another document; all windows are judged on the input. Null texts have no words and an
    empty kept_text; texts shorter than a window keep every word; copies lose every word if they are
    long enough. Input columns of the added names are replaced, all others stay; no rows: no rows.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "n_removed", "kept_text")]
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"),
                       F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))).alias("ck"))
    texts = rows.select("ck", F.col("_row.text").alias("text"))

    # 1. Anchors by prefix; those that occur once are dropped.
    anchors = texts.mapInArrow(_anchors(window, prefix), "h long, ck binary, pos int")
    shared = anchors.repartition(F.coalesce("h", F.xxhash64("ck", "pos"))).sortWithinPartitions("h").mapInArrow(
        _repeated_runs(["h"]), "ck binary, pos int").groupBy("ck").agg(F.collect_set("pos").alias("anchors"))

    # 2. Windows below the repeated prefixes; nodes at full depth with two leaves.
    marked = rows.join(shared, "ck").select("ck", F.col("_row"), "anchors")
    windows = marked.select("ck", F.col("_row.text").alias("text"), "anchors").mapInArrow(
        _windows(window, prefix), "h long, ck binary, a int, b int, ws binary")
    nodes = windows.repartition(F.coalesce("h", F.xxhash64("ck", "a"))).sortWithinPartitions("h").mapInArrow(
        _deep_nodes(window), "h long, w long, ck binary, a int, b int")
    covered = nodes.repartition(F.when(F.col("h").isNull(), F.xxhash64("ck", "a")).otherwise(F.xxhash64("h", "w"))) \
        .sortWithinPartitions("h", "w").mapInArrow(_repeated_runs(["h", "w"]), "ck binary, a int, b int")

    # 3. Maximal repeats per text; a text that a block held twice is covered as a whole.
    copied = shared.where(F.array_contains("anchors", -1)).select("ck", F.lit(0).alias("a"), F.lit(EVERYTHING).alias("b"))
    spans = covered.union(copied).groupBy("ck").agg(F.collect_set(F.struct("a", "b")).alias("spans")).select(
        "ck", F.col("spans.a").alias("a"), F.col("spans.b").alias("b"))
    joined = rows.join(spans, "ck", "left").withColumn("_cut", _cut(window)(F.col("_row.text"), "a", "b"))
    return joined.select("_row.*", "_cut.*")
