"""Main text of web pages: page structure first, then suffix arrays over each host's repeated text.

A page is cut into blocks. Blocks in an article or main element are content; blocks in menus, footers,
forms and elements named after such parts are furniture. All other blocks are decided by their host: runs of
``RUN`` tokens and more in blocks outside articles that distinct pages share go. Only the unique runs stay.
On a page with an article these blocks are not part of it; of the article, those runs go that more than half
of the host's pages with an article have in theirs, four different articles at least: the site's own notices.

Repeats alone cannot give right results: articles are copied from page to page, quote each other and must stay,
and a host with a single page repeats nothing. Hence marked structure decides where there is any, two articles
that share a run prove nothing, and an article of which such runs are half or more is a copy and stays whole.

Large hosts are dealt to parts of about ``GROUP_PAGES`` rows by a hash of the row, so no part grows with
its host. A run that most pages of a host have is one that most pages of some part have: parts name such runs
by a suffix array over their articles, then every part counts what was named. Runs are first told apart inside the slices of pages that are read, by a suffix array; what each
slice has is combined over the whole host by the runs' 64-bit hashes, and the host's repeated runs are sent
to the parts that have them. How pages are dealt decides no result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stockloom.llm.common import blocks as sliced
from stockloom.llm.common import small

RUN = 8              # tokens
GROUP_PAGES = 256
COMMON_ARTICLES = 4  # different articles that a host's notice stands in
# Blocks: of an article, undecided, furniture, a first-level heading outside articles, one of an article.
CONTENT, OTHER, FURNITURE, HEADLINE, TITLE = range(5)

# Element names of the HTML standard.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody tfoot thead tr ul".split())
# Elements that hold running text: only a whole class or id, not a part of one, makes them furniture.
TEXT_LEVEL = frozenset(
    "a abbr b blockquote caption cite code dd dt em figcaption h1 h2 h3 h4 h5 h6 i li mark p pre q small span strong td th time".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SPACE = frozenset("br td th".split())
UNWANTED = frozenset("nav aside form footer dialog menu search button fieldset".split())
RAW = "script|style|noscript|template|textarea|select|iframe|svg|annotation-xml|annotation|canvas|audio|video|object|title"
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog menu menubar form".split())
# Words that name furniture in class and id attributes.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alert|popup|modal|"
    r"overlay|sidebar|side|menu\w*|nav\w*|breadcrumbs?|comments?|respond|reply|replies|disqus|share|sharing|social|related|"
    r"recommend\w*|newsletter|subscribe|signup|login|footer|masthead|disclaimer|copyright|pagination|pager|toolbar|widgets?)"
    r"(?:$|[\s_-])", re.I)
HEADER_NAME = re.compile(r"(?:^|[\s_-])(?:site|page|top|main|global)[\s_-]?header(?:$|[\s_-])|^header$", re.I)
# A modifier says what stands beside an element, not what it is.
BESIDE = re.compile(r"(?:has|no|not|with|without)[_-]", re.I)
# Self-closing elements of SVG and MathML are empty; other elements ignore the slash.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(svg|math)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?<=/)>"
    rf"|<({RAW})\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</\2\s*>|\Z)"
    r"|<(/?)([a-zA-Z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*>|<[a-zA-Z][^>]*>", re.S | re.I)
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
UNSEEN = re.compile(r"display\s*:\s*none", re.I)


def _unwanted(name: str, attributes: str, inside: bool, holds_article: Callable[[], bool]) -> bool:
    """Whether an element starts furniture. Parts of names do not count for one that holds the page's article, nor for
    running text inside it: a paragraph of the class share-price is no share button."""
    if name in UNWANTED or (name == "header" and not inside):
        return True
    if not attributes or name in ("html", "body"):
        return False
    for kind, *values in ATTRIBUTE.findall(attributes):
        kind, value = kind.lower(), next(filter(None, values), "")
        if kind == "hidden":
            if not value.lower().startswith("until"):
                return True
        elif kind == "aria-hidden":
            if value.lower().startswith("true"):
                return True
        elif kind == "style":
            if UNSEEN.search(value):
                return True
        elif kind == "role":
            if value.lower() in ROLES:
                return True
        elif kind in ("class", "id") and name != "main":
            if not inside and HEADER_NAME.search(value):
                return True
            named = [w for w in value.split() if NAMES.search(w) and not BESIDE.match(w)]
            if named and (any(NAMES.fullmatch(w) for w in named) or not (inside and name in TEXT_LEVEL or holds_article())):
                return True
    return False


def _ends(tokens: list[re.Match]) -> dict[int, int]:
    """The token that closes an element, by the token that opens it; those left open are missing."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {}
    for k, token in enumerate(tokens):
        name = (token[4] or "").lower()
        if not token[3]:
            opened.setdefault(name, []).append(k)
        elif opened.get(name):
            ends[opened[name].pop()] = k
    return ends


def page_blocks(page: str) -> list[tuple[int, str]]:
    """(kind, text) of a page's blocks in order, white space collapsed, references decoded, empty ones left out."""
    found: list[tuple[int, str]] = []
    parts: list[str] = []
    at = inside = depth = 0
    skipped = ""   # name of the element that furniture lasts until the end of
    endless = heading = False
    opened: list[str] = []
    tokens = list(TOKEN.finditer(page))
    first = next((k for k, t in enumerate(tokens) if not t[3] and (t[4] or "").lower() in ("article", "main")), -1)
    ends: dict[int, int] | None = None

    def holds_article(k: int) -> bool:
        nonlocal ends
        if k > first:
            return False
        if ends is None:
            ends = _ends(tokens)
        return ends.get(k, len(tokens)) > first

    def flush() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            kind = FURNITURE if skipped else (TITLE if heading else CONTENT) if inside else HEADLINE if heading else OTHER
            found.append((kind, text))

    for k, token in enumerate(tokens):
        if token.start() > at:
            parts.append(page[at:token.start()])
        at = token.end()
        closing, name = token[3], (token[4] or "").lower()
        if not name:
            if token[1] or token[2]:
                parts.append(" ")
            continue
        if name in SPACE:
            parts.append(" ")
        if name in BLOCK:
            flush()
        if name == "h1":
            heading = not closing
        if endless and name in ("article", "main"):   # furniture that nobody closed ends where an article begins or ends
            skipped, endless = "", False
        if closing:
            if skipped:
                if name == skipped:
                    depth -= 1
                    if not depth:
                        flush()
                        skipped = ""
            elif name in ("article", "main") and name in opened:
                opened.remove(name)
                inside = len(opened)
        elif skipped:
            depth += name == skipped and name not in VOID
        elif name not in VOID:
            if _unwanted(name, token[5], bool(inside), lambda k=k: holds_article(k)):
                flush()
                ends = _ends(tokens) if ends is None else ends
                skipped, depth, endless = name, 1, k not in ends
            elif name in ("article", "main"):
                opened.append(name)
                inside = len(opened)
    parts.append(page[at:])
    flush()
    return found


def _equal_runs(stream: np.ndarray, run: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of the stream to a depth of ``run`` tokens, and where its groups of equal runs begin.

    Suffixes are ranked by their first 1, 2, 4, ... tokens up to ``run``; suffixes of one rank at that
    depth share the run. The stream has ``run`` tokens at least.
    """
    rank, length = np.unique(stream, return_inverse=True)[1].astype(np.int64), 1
    while length < run:
        step = min(length, run - length)
        pair = rank[:len(rank) - step] * (rank.max() + 1) + rank[step:]
        rank, length = np.unique(pair, return_inverse=True)[1].astype(np.int64), length + step
    order = np.argsort(rank, kind="stable")
    ranks = rank[order]
    return order, np.flatnonzero(np.concatenate([[True], ranks[1:] != ranks[:-1]]))


def _covered(starts: np.ndarray, n: int, run: int) -> np.ndarray:
    """Flags of the n tokens that lie in a run which begins at one of the distinct ``starts``."""
    hits = np.zeros(n + 1, np.int64)
    hits[starts] += 1
    hits[starts + run] -= 1
    return np.cumsum(hits[:n]) > 0


def repeated_positions(stream: np.ndarray, page: np.ndarray, run: int) -> np.ndarray:
    """Flags of the stream's tokens that lie in a run of ``run`` tokens which two pages or more have.

    Tokens below 0 are separators of their own and match nothing.
    """
    if len(stream) < run:
        return np.zeros(len(stream), bool)
    order, begins = _equal_runs(stream, run)
    pages = page[order]
    several = np.minimum.reduceat(pages, begins) != np.maximum.reduceat(pages, begins)
    return _covered(order[np.repeat(several, np.diff(np.append(begins, len(order))))], len(stream), run)


def _weights(run: int) -> np.ndarray:
    """One odd factor for each token of a run."""
    return np.array([xxhash.xxh64_intdigest(str(j), 7) | 1 for j in range(run)], np.uint64)


def run_hashes(tokens: list[str], run: int) -> np.ndarray:
    """64-bit hashes of the runs that begin at each token, as signed numbers; none in shorter texts."""
    n = len(tokens) - run + 1
    if n < 1:
        return np.zeros(0, np.int64)
    codes = np.fromiter((xxhash.xxh64_intdigest(t.encode("utf-8", "replace")) for t in tokens), np.uint64, len(tokens))
    total = np.zeros(n, np.uint64)
    for j, weight in enumerate(_weights(run)):
        total += codes[j:j + n] * weight      # modulo 2^64
    return total.view(np.int64)


def _runs(pages: list[tuple[int, list[list[str]]]], run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The runs in the token lists of pages, from a suffix array: the page of each, equal runs side by side; then
    where each distinct run begins, whether it lies in one list, and its hash."""
    words: dict[str, int] = {}
    stream, owner, hashes = [], [], []
    for page, lists in pages:
        for tokens in lists:
            if len(tokens) < run:
                continue
            stream.append(np.fromiter((words.setdefault(t, len(words)) for t in tokens), np.int64, len(tokens)))
            stream.append(np.array([-1 - len(stream)]))
            owner.append(np.full(len(tokens) + 1, page, np.int64))
            hashes.append(np.append(run_hashes(tokens, run), np.zeros(run, np.int64)))
    if not stream:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)
    codes, owners, known = np.concatenate(stream), np.concatenate(owner), np.concatenate(hashes)
    order, begins = _equal_runs(codes, run)
    # A run over a separator belongs to no block: the separator follows within the run's tokens.
    ends = np.append(np.cumsum(codes < 0), 0)
    at = order[begins]
    whole = ends[at + run - 1] == np.where(at > 0, ends[at - 1], 0)
    return owners[order], begins, whole, known[at]


def _shared_runs(pages: list[tuple[int, list[list[str]]]], run: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, least page, greatest page) of each distinct run in the token lists of pages."""
    owners, begins, whole, hashes = _runs(pages, run)
    if not len(begins):
        return (np.zeros(0, np.int64),) * 3
    return hashes[whole], np.minimum.reduceat(owners, begins)[whole], np.maximum.reduceat(owners, begins)[whole]


def majority_runs(articles: list[list[list[str]]], run: int) -> np.ndarray:
    """Hashes of the runs that more than half of the articles, given as token lists, have."""
    owners, begins, whole, hashes = _runs(list(enumerate(articles)), run)
    if not len(begins):
        return hashes
    group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(owners))))
    held = np.bincount(np.unique(group * len(articles) + owners) // len(articles), None, len(begins))
    return np.unique(hashes[whole & (2 * held > len(articles))])


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """html becomes its blocks: kinds as digits, texts joined by line feeds (blocks have none)."""
    for batch in sliced(batches, "html"):
        pages = [page_blocks(t or "") for t in batch.column("html").to_pylist()]
        kinds = ["".join(str(k) for k, _ in p) for p in pages]
        texts = ["\n".join(t for _, t in p) for p in pages]
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), batch.column("_host"), batch.column("_part"), pa.array(kinds, pa.string()),
             pa.array(texts, pa.string())], ["_row", "_host", "_part", "kinds", "texts"])


def _evidence(run: int):
    """Pages of any order: the runs of their blocks outside articles, once for each host and part of a slice."""
    def act(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "html"):
            groups: dict[tuple[str, int], list] = {}
            for host, part, text in zip(*(batch.column(c).to_pylist() for c in ("_host", "_part", "html"))):
                blocks_ = page_blocks(text or "")
                # Pages with the same text are one page: a mirror is no evidence of furniture.
                like = xxhash.xxh64_intdigest("\n".join(t for _, t in blocks_).encode("utf-8", "replace")) - (1 << 63)
                groups.setdefault((host, part), []).append((like, [t.split(" ") for k, t in blocks_ if k not in (CONTENT, TITLE)]))
            for (host, part), pages in groups.items():
                found = _shared_runs(pages, run)
                n = len(found[0])
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([host] * n, pa.string()), pa.array(np.full(n, part), pa.int32()), *(pa.array(x, pa.int64()) for x in found)],
                        ["_host", "_part", "run", "least", "most"])
    return act


def _article(kinds: str, texts: str) -> list[list[str]]:
    """Token lists of the article's blocks; its headings are no evidence."""
    return [t.split(" ") for k, t in zip(kinds, texts.split("\n")) if k == str(CONTENT)]


def _without_common(blocks_: list[tuple[int, str]], common: np.ndarray, run: int) -> list[tuple[int, str]]:
    """The blocks without the article's runs that are the host's own; all of them if those are half the article."""
    out, gone_, total = [], 0, 0
    for kind, text in blocks_:
        if kind == CONTENT:
            tokens = text.split(" ")
            gone = _covered(np.flatnonzero(np.isin(run_hashes(tokens, run), common)), len(tokens), run)
            gone_, total = gone_ + int(gone.sum()), total + len(tokens)
            if gone.any():
                text = " ".join(t for t, g in zip(tokens, gone) if not g)
        if text:
            out.append((kind, text))
    return out if 2 * gone_ < total else blocks_


def kept_blocks(kinds: str, texts: str, repeated: np.ndarray, run: int = RUN, common: np.ndarray | None = None) -> list[str]:
    """The kept blocks' texts of a page; ``repeated`` holds the hashes of its host's repeated runs outside
    articles, ``common`` those of the runs that are the host's own inside them."""
    blocks_ = list(zip(map(int, kinds), texts.split("\n"))) if kinds else []
    if common is not None and len(common):
        blocks_ = _without_common(blocks_, common, run)
    content = [i for i, (kind, _) in enumerate(blocks_) if kind in (CONTENT, TITLE)]
    if content:
        # An article without a heading of its own takes the last one that stands before it.
        above = [i for i, (kind, _) in enumerate(blocks_[:content[0]]) if kind == HEADLINE][-1:]
        if any(blocks_[i][0] == TITLE for i in content):
            above = []
        return [blocks_[i][1] for i in above + content]
    kept = []
    for kind, text in blocks_:
        if kind in (OTHER, HEADLINE):
            tokens = text.split(" ")
            hit = np.flatnonzero(np.isin(run_hashes(tokens, run), repeated)) if len(repeated) else repeated
            if len(hit):
                text = " ".join(t for t, gone in zip(tokens, _covered(hit, len(tokens), run)) if not gone)
            if text:
                kept.append(text)
    return kept


def _named(run: int):
    """A part's pages: the runs that most of its articles have."""
    def act(key: tuple, pages: pa.Table) -> pa.Table:
        texts = ([_article(k, t) for k, t in zip(pages["kinds"].to_pylist(), pages["texts"].to_pylist()) if str(CONTENT) in k])
        found = majority_runs(texts, run)
        return pa.table({"_host": pa.array([key[0].as_py()] * len(found), pa.string()), "run": pa.array(found, pa.int64())})
    return act


def _counted(run: int):
    """A part's pages and the runs named in its host: how many articles have each, and some of these articles' hashes.
    The row without a run counts all articles."""
    def act(key: tuple, pages: pa.Table, named: pa.Table) -> pa.Table:
        wanted, texts = np.unique(named["run"].to_numpy()), []
        held = [[] for _ in wanted]
        if len(wanted):
            texts = [_article(k, t) for k, t in zip(pages["kinds"].to_pylist(), pages["texts"].to_pylist()) if str(CONTENT) in k]
        for article in texts:
            like = xxhash.xxh64_intdigest("\n".join(map(" ".join, article)).encode("utf-8", "replace")) - (1 << 63)
            found = np.concatenate([run_hashes(tokens, run) for tokens in article])
            for at in np.flatnonzero(np.isin(wanted, found)).tolist():
                held[at].append(like)
        n = len(wanted) + 1
        return pa.table({
            "_host": pa.array([key[0].as_py()] * n, pa.string()), "run": pa.array([*wanted.tolist(), None], pa.int64()),
            "held": pa.array([*map(len, held), len(texts)], pa.int64()),
            "likes": pa.array([*(sorted(set(h))[:COMMON_ARTICLES] for h in held), []], pa.list_(pa.int64()))})
    return act


def _decide(run: int):
    """A part's pages and the runs that go: those of its host outside articles, and the host's own inside them."""
    def act(pages: pa.Table, runs: pa.Table) -> pa.Table:
        gone, inside = runs["run"].to_numpy(), runs["inside"].to_numpy(zero_copy_only=False).astype(bool)
        repeated, common = np.sort(gone[~inside]), np.sort(gone[inside])
        kept = ["\n\n".join(kept_blocks(k, t, repeated, run, common)) for k, t in zip(pages["kinds"].to_pylist(), pages["texts"].to_pylist())]
        return pa.table({"_row": pages["_row"], "text": pa.array(kept, pa.string())})
    return act


def extract_text(pages: DataFrame, run: int = RUN, group_pages: int = GROUP_PAGES) -> DataFrame:
    """``pages`` without html and with ``text``: the kept blocks in page order, joined by two line feeds.

    Pages need url and html; null html is an empty page, null urls share a host of their own; the text is
    empty if nothing is kept. An input column ``text`` is replaced, other columns stay. Repeated rows are pages of their own but no evidence of
    each other's repeats: inside articles they count among the host's pages, not as different articles. No rows: no rows.
    """
    kept = [c for c in pages.columns if c != "text"]
    host = F.coalesce(F.regexp_extract("url", r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)", 1), F.lit(""))
    counts = pages.groupBy(F.lower(host).alias("_host")).agg(F.ceil(F.count("*") / group_pages).cast("int").alias("parts"))
    heavy = small(counts.where("parts > 1"))     # at most rows / group_pages hosts
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in kept if c != "html")).alias("_row"), "html", F.lower(host).alias("_host"))
    rows = rows.join(heavy, "_host", "left").withColumn(
        "_part", F.coalesce(F.pmod(F.xxhash64("_row", "html"), F.col("parts")), F.lit(0)).cast("int"))
    kinds = rows.select("_row").schema[0].dataType.simpleString()
    parsed = rows.select("_row", "html", "_host", "_part").mapInArrow(
        _parse, f"_row {kinds}, _host string, _part int, kinds string, texts string")
    # A run's rows are as many as its host has slices and parts, not pages.
    runs = rows.select("_host", "_part", "html").mapInArrow(
        _evidence(run), "_host string, _part int, run long, least long, most long").repartition("_host", "run").groupBy(
        "_host", "_part", "run").agg(F.min("least").alias("least"), F.max("most").alias("most"))
    whole = W.partitionBy("_host", "run")
    repeated = runs.withColumn("least", F.min("least").over(whole)).withColumn("most", F.max("most").over(whole)).where(
        "least <> most").select("_host", "_part", "run", F.lit(False).alias("inside"))
    # The parts' pages are shuffled once: the three steps over them ask for the same exchange.
    part = parsed.groupBy("_host", "_part")

    def in_parts(of_host: DataFrame) -> DataFrame:
        each = of_host.join(heavy, "_host", "left")
        return each.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")

    named = in_parts(part.applyInArrow(_named(run), "_host string, run long").distinct())
    counted = part.cogroup(named.groupBy("_host", "_part")).applyInArrow(
        _counted(run), "_host string, run long, held long, likes array<long>")
    sums = counted.groupBy("_host", "run").agg(F.sum("held").alias("held"), F.array_distinct(F.flatten(F.collect_list("likes"))).alias("likes"))
    total = F.sum(F.when(F.col("run").isNull(), F.col("held"))).over(W.partitionBy("_host"))
    common = sums.withColumn("total", total).where(
        F.col("run").isNotNull() & (2 * F.col("held") > F.col("total")) & (F.size("likes") >= COMMON_ARTICLES))
    going = repeated.unionByName(in_parts(common.select("_host", "run")).select("_host", "_part", "run", F.lit(True).alias("inside")))
    decided = part.cogroup(going.groupBy("_host", "_part")).applyInArrow(_decide(run), f"_row {kinds}, text string")
    return decided.select("_row.*", "text")
