"""Packing of documents into fixed token windows, online and with bounded space.

Each partition streams through its documents and keeps at most ``OPEN`` windows open. Full windows are
cut off long documents; what remains goes to the open window it fits best. When none fits and no window
may be opened, the fullest one is emitted, after the document's first ids filled it up if at least
``MIN_CUT`` ids are missing. Windows still open at a partition's end are merged, 64 partitions to a
group and groups to larger groups, until one is left. No document moves; only the leftovers do.
"""

from __future__ import annotations

import string
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import blocks, staged

WINDOW = 2048
OPEN = 64
MIN_CUT = 16
END = 1                # id after each document
VOCABULARY = "word_bpe_49k.json"
MOST_WORDS = 300_000   # newer encodings kept by a task; as many older ones at most
LEARNED_AT_ONCE = 10_000
TEXT_BYTES = 2 << 20   # texts encoded at once
MERGED = 64            # groups of leftovers merged into one
BATCH = 20_000         # rows emitted at once


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit bytes, by the tokenizers library.

    The vocabulary drops white space and never joins characters across it, so a text's ids are those of
    its space-separated parts in order. A part's encoding is kept while it is in use: when MOST_WORDS are
    held, they become the older half, of which only the parts met again move on.
    """

    MARK = "\x01"  # stands alone between parts that are encoded together
    # A letter and the ASCII punctuation after it are encoded apart ("<|" may begin a special token).
    PUNCTUATION = string.punctuation.replace("<", "").replace("|", "")

    def __init__(self, path: str | None = None):
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers
            path = public_tokenizers.path(VOCABULARY)
        self.tokenizer = Tokenizer.from_file(path)
        self.mark = self.tokenizer.encode(self.MARK, add_special_tokens=False).ids
        # Kept for one task only: workers go on to other stages, which need the memory.
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _new(self, parts: Iterable[str]) -> list[str]:
        """The parts of which no encoding is kept; those kept among the older ones move on."""
        memo, older, new = self.memo, self.older, []
        for part in parts:
            if part not in memo:
                if (ids := older.get(part)) is None:
                    new.append(part)
                else:
                    memo[part] = ids
        return new

    def _learn(self, parts: list[str]) -> None:
        """Encode new parts: plain lower-case ASCII words by the model itself, others together, parted by the mark."""
        tokenize, rest, plain, found, ends = self.tokenizer.model.tokenize, [], [], [], [0]
        for part in parts:
            # Normalising and splitting leave such a word as it is.
            if part.isascii() and part.isalpha() and part.islower():
                plain.append(part)
                found += [t.id for t in tokenize(part)]
                ends.append(4 * len(found))
            elif self.MARK in part or "<|" in part or len(self.mark) != 1:
                self.memo[part] = self._single(part)
            else:
                rest.append(part)
        data = np.array(found, "<u4").tobytes()
        self.memo.update((p, data[b:e]) for p, b, e in zip(plain, ends, ends[1:]))
        for start in range(0, len(rest), LEARNED_AT_ONCE):
            some = rest[start:start + LEARNED_AT_ONCE]
            joined = f" {self.MARK} ".join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            ends = np.append(np.flatnonzero(ids == self.mark[0]), len(ids))
            if len(ends) == len(some):
                begins, data = np.append(0, ends[:-1] + 1), ids.tobytes()
                self.memo.update((p, data[4 * b:4 * e]) for p, b, e in zip(some, begins.tolist(), ends.tolist()))
            else:
                self.memo.update((p, self._single(p)) for p in some)

    def _single(self, part: str) -> bytes:
        return np.array(self.tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, texts: list[str]) -> Iterator[bytes]:
        if len(self.memo) > MOST_WORDS:
            self.older, self.memo = self.memo, {}
        split = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.string()), "\n", " "), " ")
        coded = split.flatten().dictionary_encode()      # each part once, and where it stands
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        stems: dict[str, str] = {}
        tails: dict[str, str] = {}
        for part in self._new(parts):
            stem = part.rstrip(self.PUNCTUATION)
            # A letter whose lower case is several characters would be joined with what follows.
            if stem and len(stem) < len(part) and stem[-1] < "ɐ" and stem[-1].isalpha() and len(stem[-1].lower()) == 1:
                tails[part] = part[len(stem):]
            else:
                stem = part
            # The vocabulary lower-cases anyway.
            stems[part] = stem.lower() if stem.isascii() and "<|" not in stem else stem
        self._learn(self._new({*stems.values(), *tails.values()}))
        for part, stem in stems.items():
            self.memo[part] = self.memo[stem] + (self.memo[tails[part]] if part in tails else b"")
        held = [self.memo[part] for part in parts]
        data, sizes = np.frombuffer(b"".join(held), "<u4"), np.fromiter(map(len, held), np.int64, len(held)) // 4
        starts, at = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        each = sizes[at]
        ends = np.cumsum(each)
        ids = data[np.repeat(starts[at] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.append(0, ends)[split.offsets.to_numpy()].tolist()
        return (ids[b:e].tobytes() for b, e in zip(bounds, bounds[1:]))


class Windows:
    """The open windows of one partition; ``emit(piece, window, offset)`` is called for closed ones."""

    def __init__(self, size: int, most: int, min_cut: int):
        self.size, self.most, self.min_cut = size, most, min_cut
        self.free: list[tuple[int, int]] = []   # (ids missing, window), sorted
        self.pieces: dict[int, list[tuple[tuple, int]]] = {}
        self.count = 0
        self.closed: list[tuple[tuple, int, int]] = []

    def _open(self) -> int:
        self.count += 1
        self.pieces[self.count - 1] = []
        return self.count - 1

    def _close(self, window: int) -> None:
        self.closed.extend((piece, window, offset) for piece, offset in self.pieces.pop(window))

    def _put(self, piece: tuple, missing: int, window: int) -> None:
        """piece: (doc row, start, length)."""
        self.pieces[window].append((piece, self.size - missing))
        missing -= piece[2]
        if missing:
            insort(self.free, (missing, window))
        else:
            self._close(window)

    def add(self, doc, total: int) -> None:
        start = 0
        while total - start >= self.size:
            self._put((doc, start, self.size), self.size, self._open())
            start += self.size
        while start < total:
            length = total - start
            at = bisect_left(self.free, (length, -1))
            if at < len(self.free):
                missing, window = self.free.pop(at)
                self._put((doc, start, length), missing, window)
                return
            if len(self.free) < self.most:
                self._put((doc, start, length), self.size, self._open())
                return
            missing, window = self.free.pop(0)
            if missing >= self.min_cut:
                self._put((doc, start, missing), missing, window)
                start += missing
            else:
                self._close(window)

    def leftovers(self) -> Iterator[tuple[tuple, int, int]]:
        for window, held in self.pieces.items():
            for piece, offset in held:
                yield piece, window, offset


COLUMNS = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def _packer(encoder: Callable[[], Callable], size: int, most: int, min_cut: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        windows, encode = Windows(size, most, min_cut), encoder()

        def rows(placed, open_: bool):
            ids, flat = [], []
            for ((doc, data), start, length), window, offset in placed:
                part = data[4 * start:4 * (start + length)]
                flat.append((doc, start, length, zlib.crc32(part), len(data) // 4, (partition << 32) + window, offset))
                ids.append(part if with_ids or open_ else None)
            names = ["doc_id", *COLUMNS, "group", "ids"]
            columns = [list(c) for c in zip(*flat)] or [[] for _ in range(7)]
            groups = [partition if open_ else None] * len(flat)
            kinds = [kind] + [pa.int64()] * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)] + [pa.array(groups, pa.int64()), pa.array(ids, pa.binary())], names)

        kind = pa.int64()
        for batch in blocks(batches, most_bytes=TEXT_BYTES):
            kind = batch.column("doc_id").type
            data = encode([t or "" for t in batch.column("text").to_pylist()])
            for doc, ids in zip(batch.column("doc_id").to_pylist(), data):
                ids += END.to_bytes(4, "little")
                windows.add((doc, ids), len(ids) // 4)
                if len(windows.closed) >= BATCH:
                    yield rows(windows.closed, False)
                    windows.closed = []
            yield rows(windows.closed, False)
            windows.closed = []
        yield rows(windows.leftovers(), True)
    return run


def _merge(size: int, level: int, last: bool, with_ids: bool):
    """Lay a group's open windows end to end and cut full windows; the rest stays open unless ``last``."""
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        group = int(frame["group"].iat[0])
        held = frame.sort_values(["sequence_id", "offset"], kind="stable")
        total, out, at = int(held["length"].sum()), [], 0
        full = total // size * size
        for row in held.itertuples(index=False):
            start = 0
            while start < row.length:
                length = min(row.length - start, size - at % size)
                ids = row.ids[4 * start:4 * (start + length)]
                done = last or at < full
                window = (level << 56) + (group << 28) + at // size
                out.append((row.doc_id, row.start + start, length, zlib.crc32(ids), row.doc_tokens, window, at % size,
                            None if done else group, ids if with_ids or not done else None))
                start += length
                at += length
        return pd.DataFrame(out, columns=["doc_id", *COLUMNS, "group", "ids"]).astype({"group": "Int64"})
    return run


def pack_documents(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, most_open: int = OPEN,
                   min_cut: int = MIN_CUT, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents in windows of ``window`` ids: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, if ``with_ids``, ids (little-endian unsigned 32-bit binary).

    A document is its text's ids and END; null texts are empty and are the END alone. Every id lies in
    exactly one piece; pieces of a sequence fill it gaplessly from offset 0. Rows that share a doc_id are
    documents of their own; a null doc_id stays null; other columns are not read; no rows: no rows. All
    sequences but one lack fewer than ``min_cut`` ids. ``vocabulary`` is the path of a tokenizers file
    on every executor (default: the public word vocabulary).
    """
    kind = dict(docs.dtypes)["doc_id"]
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long, group long, ids binary")
    pieces = staged(docs.select("doc_id", "text").mapInArrow(
        _packer(lambda: WordEncoder(vocabulary), window, most_open, min_cut, with_ids), schema), "pieces")
    done, open_ = [pieces.where("group is null")], pieces.where("group is not null")
    highest = open_.agg(F.max("group")).first()[0]
    level, groups = 0, 0 if highest is None else highest + 1
    while groups:
        level, groups = level + 1, -(-groups // MERGED)
        merged = staged(open_.withColumn("group", F.floor(F.col("group") / MERGED)).groupBy("group").applyInPandas(
            _merge(window, level, groups == 1, with_ids), schema), "merged")
        done.append(merged.where("group is null"))
        open_ = merged.where("group is not null")
        if groups == 1:
            break
    packed = done[0]
    for part in done[1:]:
        packed = packed.union(part)
    return packed.select("doc_id", *COLUMNS, *(["ids"] if with_ids else []))
