"""Neighbour search, page text and I-Match fingerprints."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockloom.llm import html_extract, imatch, queries, vptree

DATA = "/root/testdata/sf0.001"


def brute_neighbours(ids, vectors, asked, k):
    out = {}
    for q in asked:
        row = vectors[ids == q][0]
        score = (vectors * row).sum(axis=1)
        keep = ids != q
        order = np.lexsort((ids[keep], -score[keep]))[:k]
        out[q] = list(zip(ids[keep][order].tolist(), score[keep][order].tolist()))
    return out


def neighbours(df):
    found = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return found


@pytest.mark.parametrize("shard_rows", [5000, 130])
def test_factor_one_is_exact_with_ties_and_copies(spark, shard_rows):
    rng = np.random.default_rng(8)
    vectors = np.concatenate([rng.normal(size=(500, 6)), np.repeat(rng.normal(size=(2, 6)), 200, axis=0)]).astype(np.float32)
    ids = rng.permutation(len(vectors))
    df = spark.createDataFrame([(int(i), v.tolist(), 1) for i, v in zip(ids, vectors)], "vec_id long, embedding array<float>, rank int")
    found = neighbours(vptree.search(vptree.build_index(df, shard_rows=shard_rows), df.where("vec_id % 20 = 0"), factor=1.0, block_queries=16))
    assert found == brute_neighbours(ids, vectors.astype(np.float64), [i for i in ids.tolist() if i % 20 == 0], 20)


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, [2.0, 1.0]),
            (7, [1.0, 1.0, 1.0]), (None, [3.0, 3.0]), (20, [1.0, 0.0]), (40, None), (60, []), (8, [-1.0, 0.0]), (8, [-1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    index = vptree.build_index(df)
    found = neighbours(vptree.search(index, df.where("vec_id % 20 = 0")))
    assert found == {0: [(6, 2.0), (20, 1.0), (8, -1.0), (8, -1.0)], 20: [(6, 2.0), (0, 1.0), (8, -1.0), (8, -1.0)]}
    assert vptree.search(vptree.build_index(df.limit(0)), df).count() == 0


def test_recall_of_the_query(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet").select("vec_id", "embedding")
    rows = df.collect()
    ids, vectors = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float64)
    exact = brute_neighbours(ids, vectors, [i for i in ids.tolist() if i % 20 == 0], 20)
    found = neighbours(queries.QUERIES["op6_vantage_neighbours"](spark, DATA))
    assert found.keys() == exact.keys()
    recall = np.mean([len({i for i, _ in found[q]} & {i for i, _ in exact[q]}) / 20 for q in exact])
    assert recall >= 0.9


PAGE = """<!DOCTYPE html><html class="menu"><head><title>No &amp; title</title><style>p{}</style><script>var t="</p>";</script></head>
<body class="has-sidebar"><header><h2>Site</h2></header><nav><ul><li><a href="/a>b">Menu</a></ul></nav><!-- <p>hidden</p> -->
<div class="ad">Buy <div>now</div> more</div><div id="cookie-notice">We use cookies</div>
<article class="post"><header><h1>Caf&eacute; &lt;b&gt;</h1></header><p>One  two\n three<br>four<p><b>five<p>six &nbsp; &#65;</b>
<aside>side</aside><form><p>Mail</p></form><ul><li>x<li>y</ul><table><tr><td>1</td><td>2</td></tr></table>
<section class="comments"><p>First!</p></section></article><aside>Other</aside><footer>&copy; me</footer></body></html>"""


def test_page_with_an_article():
    blocks = html_extract.page_blocks(PAGE)
    assert [t for k, t in blocks if k in (html_extract.CONTENT, html_extract.TITLE)] == [
        "Café <b>", "One two three four", "five", "six A", "x", "y", "1 2"]


@pytest.mark.parametrize("opening,closing", [
    ('<div class="overflow-hidden"><article>', "</article></div>"), ('<main style="overflow:hidden">', "</main>"),
    ('<div class="wrap has-sidebar"><article>', "</article></div>"), ('<section class="no-sidebar"><p>', "</p></section>"),
    ('<div id="layout-sidebar-right"><article class="with-comments">', "</article></div>"), ('<article data-id="comments">', "</article>"),
    ('<svg class="logo" width="1"/><article>', "</article>"), ("<article><math/>", "</article>")])
def test_wrappers_of_an_article_are_no_furniture(opening, closing):
    assert [t for _, t in html_extract.page_blocks(f"<body>{opening}The story{closing}</body>")] == ["The story"]
    assert all(k != html_extract.FURNITURE for k, _ in html_extract.page_blocks(f"<body>{opening}The story{closing}</body>"))


@pytest.mark.parametrize("part", [
    '<div hidden>x</div>', '<div class="a" hidden="">x</div>', '<p style="color:red; display: none">x</p>', '<p aria-hidden="true">x</p>',
    '<div class="left-sidebar">x</div>', '<div class="post-comments"><article>x</article></div>', '<div class="sidebar">x</div>'])
def test_furniture_beside_an_article_goes(part):
    blocks = html_extract.page_blocks(f"<body><article>The story</article>{part}</body>")
    assert blocks == [(html_extract.CONTENT, "The story"), (html_extract.FURNITURE, "x")]


def main_text(page):
    blocks = html_extract.page_blocks(page)
    return html_extract.kept_blocks("".join(str(k) for k, _ in blocks), "\n".join(t for _, t in blocks), np.zeros(0, np.int64))


def test_parts_of_names_do_not_drop_paragraphs_of_an_article():
    page = ('<article><p class="sidebar-free">a</p><p id="notice-of-intent">b</p><span class="share-price">c</span>'
            '<p class="notice">gone</p><div class="share-buttons">gone</div><ul class="related-posts"><li>gone</ul><p>d</article>')
    assert main_text(page) == ["a", "b", "c", "d"]


def test_heading_beside_an_article():
    assert main_text("<header><h1>Site</h1></header><h1>The <b>story</b></h1><article><p>text</article>") == ["The story", "text"]
    assert main_text("<h1>Site</h1><article><h1>The story</h1><p>text</article>") == ["The story", "text"]
    assert main_text("<h1>Site</h1><h1>Story</h1><p>by me</p><main><p>text</main><h1>More</h1>") == ["Story", "text"]
    assert main_text("<h1>Story</h1><p>text</p>") == ["Story", "text"]


@pytest.mark.parametrize("open_", ["<nav>", "<aside>", '<div class="menu">', "<form>"])
def test_furniture_that_is_never_closed_ends_at_the_article(open_):
    assert main_text(f"<body>{open_}<a>Home</a><article><p>The story</article><footer>x</footer>") == ["The story"]
    assert main_text(f"<article><p>The story</p>{open_}<a>Home</a></article><main>More</main>") == ["The story", "More"]


def test_formulas_stay_and_drawings_go():
    page = ("<article>So <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='tex'>x^2</annotation></math> and <svg><text>no</text></svg>"
            "<svg/> more</article>")
    assert html_extract.page_blocks(page) == [(html_extract.CONTENT, "So x=2 and more")]


def test_pages(spark):
    shared = "All rights are reserved by the owners of this site and its friends"
    plain = [f"<body><div>{shared}</div><p>Story {i} about {'abcdefgh'[i]} only</p><div>{shared} {i}</div></body>" for i in range(6)]
    rows = [(i, "http://h.example/x", p) for i, p in enumerate(plain)]
    rows += [(10, "http://h.example/c", plain[0]), (11, "http://other.example/", plain[0]), (12, None, PAGE), (12, None, PAGE),
             (13, "http://h.example/", None), (14, "http://h.example/", ""), (15, "no url", "<p>a &amp b" + " w" * 100_000),
             (16, "http://a/", "<article><p>open"), (17, "http://a/", "<a title=\"x>y'\">t</a> < 3 <script>x"), (18, None, "<<<>>><p")]
    docs = spark.createDataFrame([(*r, "t") for r in rows], "page_id long, url string, html string, text string").repartition(3)
    extracted = html_extract.extract_text(docs)
    assert extracted.columns == ["page_id", "url", "text"]
    found = {r["page_id"]: r["text"] for r in extracted.collect()}
    assert extracted.count() == len(rows)
    assert [found[i] for i in range(6)] == [f"Story {i} about {'abcdefgh'[i]} only\n\n{i}" for i in range(6)]
    assert found[11] == f"{shared}\n\nStory 0 about a only\n\n{shared} 0"
    assert found[12].startswith("Café <b>\n\nOne two three four") and found[13] == found[14] == ""
    assert found[15].startswith("a & b w w") and found[16] == "open" and found[17] == "t < 3"
    assert html_extract.extract_text(docs.limit(0)).count() == 0


def test_repeats_of_a_large_host_are_found_across_its_parts(spark):
    rng = random.Random(4)
    line = "Only two pages of this host have this notice"
    pages = [[" ".join(f"w{rng.randrange(50)}" for _ in range(rng.choice([3, 20, 60]))) for _ in range(3)] for _ in range(60)]
    pages[7][1] += " " + line
    pages[41][2] = line + " " + pages[41][2]
    pages[50] = list(pages[51])      # a mirror is no evidence
    want = {}
    where = {}
    for p in pages:
        for text in p:
            w = text.split()
            for i in range(len(w) - 7):
                where.setdefault(tuple(w[i:i + 8]), set()).add(tuple(p))
    for n, p in enumerate(pages):
        kept = []
        for text in p:
            w, gone = text.split(), set()
            for i in range(len(w) - 7):
                if len(where[tuple(w[i:i + 8])]) > 1:
                    gone.update(range(i, i + 8))
            kept.append(" ".join(t for i, t in enumerate(w) if i not in gone))
        want[n] = "\n\n".join(t for t in kept if t)
    docs = spark.createDataFrame(
        [(n, "http://h/x", "".join(f"<p>{t}</p>" for t in p)) for n, p in enumerate(pages)], "page_id long, url string, html string").repartition(5)
    for group_pages in (1, 6, 256):
        assert {r[0]: r[2] for r in html_extract.extract_text(docs, group_pages=group_pages).collect()} == want
    assert "notice" not in want[7] + want[41] and want[50] == "\n\n".join(pages[50])


def test_a_hosts_own_notice_goes_from_inside_articles(spark):
    """Most articles have the notice; a sentence that few share, copies of one article and a small host's lines stay."""
    rng = random.Random(4)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    notice, shared = "Sign up to our letter and never miss a story", "The minister said that nothing at all had been decided yet"
    rows, want = [], {}
    for n in range(40):
        blocks = [words(30), words(12)]
        if n < 15:
            blocks[0] += " " + shared
        want[n] = "\n\n".join(["A title for all the pages of this site", *blocks])
        made = [*blocks, notice] if n % 4 else blocks
        if n % 8 == 1:      # inside a block too
            made = [blocks[0] + " " + notice, blocks[1]]
        rows.append((n, "http://big/x", "<article><h1>A title for all the pages of this site</h1>" + "".join(f"<p>{b}</p>" for b in made) + "</article>"))
    copied = words(60)
    for n in range(40, 46):     # one article with other endings
        want[n] = f"{copied}\n\n{words(5)}"
        rows.append((n, "http://copies/x", "<article>" + "".join(f"<p>{b}</p>" for b in want[n].split("\n\n")) + "</article>"))
    for n in range(46, 52):     # one article under other menus, and two that share its sentence
        want[n] = words(20) + " " + shared if n > 49 else f"{shared} {notice}"
        rows.append((n, "http://mirror/x", f"<nav>{n}</nav><article>{want[n]}</article>"))
    for n in range(52, 55):
        want[n] = f"{words(20)}\n\n{notice}"
        rows.append((n, "http://small/x", "<article>" + "".join(f"<p>{b}</p>" for b in want[n].split("\n\n")) + "</article>"))
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for group_pages in (3, 256):
        assert {r[0]: r[2] for r in html_extract.extract_text(docs, group_pages=group_pages).collect()} == want


def test_majority_runs_are_those_of_most_articles():
    a, b, c = list("abcdefgh"), list("xbcdefyz"), list("cdefcdef")
    assert set(html_extract.majority_runs([[a], [b], [c]], 4)) == {
        html_extract.run_hashes(list(t), 4)[0] for t in ("bcde", "cdef")}
    assert not len(html_extract.majority_runs([[a[:3]], [b[:2]]], 4)) and not len(html_extract.majority_runs([], 4))


def test_suffix_array_finds_the_runs_that_pages_share():
    rng = random.Random(1)
    stream, page = [], []
    for p in range(12):
        stream += [rng.randrange(3) for _ in range(40)] + [-1 - p]
        page += [p] * 41
    got = html_extract.repeated_positions(np.array(stream), np.array(page), 5)
    where = {}
    for i in range(len(stream) - 4):
        where.setdefault(tuple(stream[i:i + 5]), []).append(i)
    want = np.zeros(len(stream), bool)
    for starts in where.values():
        if len({page[i] for i in starts}) > 1:
            for i in starts:
                want[i:i + 5] = True
    assert (got == want).all() and want.any() and not want.all()


def test_edited_texts_and_fingerprints(spark, monkeypatch):
    monkeypatch.setattr(imatch, "PER_STRETCH", 7)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    texts = {3 * i: " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 60]))) for i in range(80)}
    texts |= {1000: None, 1001: "é𝄞" * 11, 5000: texts[3], 9000: "long " * 50_000}
    rows = [(i, t, "f", 1) for i, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string, bucket int").repartition(4)
    found = {r["doc_id"]: r for r in imatch.edited_fingerprints(docs).collect()}
    ids = sorted(texts)
    for here, after in zip(ids, ids[1:] + ids[:1]):
        own, following, r = texts[here] or "", texts[after] or "", found[here]
        half = len(own) // 2
        edited = own[:len(own) - half] + following[:half]
        assert r["n_chars"] == len(own) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if own == edited:
            assert r["near_edited"] == 1 and r["fingerprint"] == r["edited_fingerprint"]
    assert found[3]["fingerprint"] == found[5000]["fingerprint"] and len(found) == len(texts)
    assert np.mean([found[i]["near_edited"] for i in ids]) > np.mean([found[i]["near_next"] for i in ids])
    whole = imatch.fingerprint(docs)
    assert whole.columns == ["doc_id", "text", "bucket", "slots", "fingerprint"]
    assert {r["doc_id"]: r["fingerprint"] for r in whole.collect()} == {i: found[i]["fingerprint"] for i in ids}


def test_fingerprints_of_few_and_repeated_and_null_ids(spark):
    one = spark.createDataFrame([(5, "abcd")], "doc_id long, text string")
    r = imatch.edited_fingerprints(one).collect()[0]
    assert r["near_edited"] in (0.0, 1.0) and r["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()
    rows = spark.createDataFrame([(5, "abcd"), (5, "abcd"), (None, "xy"), (None, "zz"), (9, None)], "doc_id long, text string")
    assert sorted((x["doc_id"] or 0) for x in imatch.edited_fingerprints(rows).collect()) == [0, 0, 5, 5, 9]
    assert imatch.edited_fingerprints(rows.limit(0)).count() == 0
    assert imatch.edited_fingerprints(rows.where("doc_id is null")).count() == 2


def test_columns_with_any_names_stay(spark):
    docs = spark.createDataFrame([(1, "some words", 2, 3, 4)], "doc_id long, text string, _whole int, row int, `a.b` int")
    words = spark.createDataFrame([("words", 3)], "term string, subset int")
    assert imatch.fingerprint(docs, words).columns == [*docs.columns, "slots", "fingerprint"]


def test_lexicon_is_the_band_of_document_frequency(spark):
    texts = ["the A", "the a b", "the B c c", "the d", "the b", "the", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    count = {}
    for t in texts:
        for w in set(re.findall(r"\w+", (t or "").lower())):
            count[w] = count.get(w, 0) + 1
    for common, rare in ((0.45, 0.0), (0.9, 0.4), (0.9, 0.3), (0.01, 0.0)):
        band = {w for w, n in count.items() if 1 < n <= max(2, common * len(texts)) and n >= rare * len(texts)}
        assert {r["term"] for r in imatch.lexicon(docs, common, rare).collect()} == band


def test_one_far_id_leaves_stretches_even(spark):
    docs = spark.range(5_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).union(
        spark.createDataFrame([(10**15, "t"), (None, "t")], "doc_id long, text string"))
    held = imatch.with_next(docs).groupBy("bucket").count().collect()
    assert max(r["count"] for r in held) <= 2 * imatch.PER_STRETCH and len(held) >= 5
