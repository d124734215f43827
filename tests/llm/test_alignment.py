"""Cross-tokenizer alignment against a plain loop over both token lists."""

import random
from collections import Counter
from hashlib import sha256

import public_tokenizers
import pyarrow.parquet as pq
import sentencepiece
from tokenizers import Tokenizer

from stockloom.llm import alignment

SCHEMA = "doc_id long, text string, block int, slot string, a int, count double"


def brute(rows):
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = alignment.byte_alphabet()
    found, holders = [], Counter()
    for doc_id, text in rows:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
                   for i in ids_b]
        wanted = b" " + (text or "").encode()
        groups = []
        if text and b"".join(bytes_a) == wanted and b"".join(bytes_b) == wanted:
            i = j = 0
            while i < len(ids_a):
                left, right = [ids_a[i]], [ids_b[j]]
                at, other = len(bytes_a[i]), len(bytes_b[j])
                i, j = i + 1, j + 1
                while at != other:
                    if at < other:
                        left.append(ids_a[i])
                        at, i = at + len(bytes_a[i]), i + 1
                    else:
                        right.append(ids_b[j])
                        other, j = other + len(bytes_b[j]), j + 1
                groups.append((left, right))
        links = [(x, y) for left, right in groups for x in left for y in right]
        holders.update(set(links))
        found.append((doc_id, groups, links))
    highest = Counter()
    for (x, _), n in holders.items():
        highest[x] = max(highest[x], n)
    out = []
    for doc_id, groups, links in found:
        written = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        out.append((
            doc_id, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
            sha256(written.encode()).hexdigest() if groups else "", sum(holders[x] == highest[x[0]] for x in links),
            sum(holders[x] for x in links)))
    return out


def check(spark, rows, **settings):
    docs = spark.createDataFrame([(*r, 1, "x", 2, 0.5) for r in rows], SCHEMA).repartition(3)
    found = [tuple(r) for r in alignment.align(docs, **settings).collect()]
    assert sorted(found, key=repr) == sorted(brute(rows), key=repr)
    return found


def test_alignment_matches_a_plain_loop(spark):
    texts = [
        None, "", " ", "  two  spaces  ", "\n\n\ttabs\r\n", "plain words, and MORE words.", "plain words, and MORE words.",
        "naïve façade Ünï", "日本語のテキスト", "emoji 👩‍👩‍👧 family", "<|endoftext|> and <s> </s> <unk>", "piece ▁ mark", "▁",
        "x" * 5000, "1234567890" * 40, "a\x00b", "﻿bom", "é", "long word " * 20_000, "=" * 333 + "-" * 77, "ﬁ ligature ①"]
    found = check(spark, [*enumerate(texts), (None, "no id"), (3, "same id twice")])
    assert sum(r[1] > 0 for r in found) > 12 and sum(r[1] == 0 for r in found) >= 4


def test_alignment_of_given_documents_over_several_blocks(spark):
    given = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    check(spark, [(r["doc_id"], r["text"]) for r in given], block_bytes=20_000)


def test_both_encoders_of_a_give_the_same_ids():
    rng = random.Random(8)
    tools = alignment.Tokenizers()
    plain = [chr(c) for c in [*range(0x20, 0x7F), 10, 13, 9, *range(0xA1, 0x250)]]
    pool = ["word", "it's", "They'LL", "<s>", "<|endoftext|>", "naïve", "foo\n\nbar", "1,000.50", " ", "  ", "\n", "\r\n", "\t"]
    texts = ["".join(rng.choice(plain) if rng.random() < 0.5 else rng.choice(pool) for _ in range(rng.randrange(40))) for _ in range(6_000)]
    texts += ["\x85 a", "a\xa0b", "a\u3000b", "\x0b\x1c", "日本 語", "٣ ²"]
    found = tools._ids_a(texts)
    assert tools.plain is not None and sum(alignment.PLAIN.fullmatch(t) is not None for t in texts) == 6_000
    assert found == [e.ids for e in tools.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]


def test_no_documents(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA)).count() == 0
    check(spark, [(1, None), (2, "")])
