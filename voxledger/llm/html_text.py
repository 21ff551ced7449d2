"""Main text of HTML pages: declared structure, and a host suffix array for the rest.

A page is parsed once into blocks. Blocks inside a declared article are its
text. All other blocks of a page form its token stream. The suffixes of all
streams of a host are dealt to buckets by their LONG leading tokens and sorted
by their tokens; the common prefix of neighbours from distinct pages is what
these pages share. A page that declares no article keeps the runs of its
blocks, menus and other marked parts aside, that no shared string covers.

Buckets that hold one page, or no page without article, decide nothing; they
are left out by a count of pages for each hash of leading tokens.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import BROADCAST_IDS, query, stored, table
from .shingles import mix
from .url_filter import canonical

LONG = 8  # tokens of a shared string that counts as boilerplate
DEPTH = 16  # tokens that suffixes are sorted by; longer shared strings are met again at their next suffixes
BUCKET_PAGES = 4096  # a bucket of more pages is dealt out by page

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
WORDS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")

# Element names of HTML and usual names of page parts.
RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "select", "button"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt",
         "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr",
         "html", "legend", "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td",
         "tfoot", "th", "thead", "tr", "ul"}
CHROME = {"nav", "aside", "footer", "form", "head", "menu", "dialog", "fieldset"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog"}
CHROME_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner", "breadcrumb", "breadcrumbs", "comment",
                "comments", "consent", "cookie", "cookies", "disqus", "footer", "login", "menu", "modal", "nav", "navbar", "navigation",
                "newsletter", "notice", "notices", "popup", "promo", "promotion", "related", "replies", "search", "share", "sharing",
                "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "widget"}
OUTSIDE_NAMES = {"header", "masthead", "top", "bottom", "topbar"}  # chrome unless inside an article
# these also name topics: they count only beside other such names and the words for page parts
DOUBTFUL_NAMES = {"comment", "comments", "consent", "menu", "notice", "notices", "promotion", "related", "replies", "search", "share", "sharing",
                  "social", "top", "bottom"}
PART_NAMES = {"area", "articles", "bar", "block", "box", "btn", "button", "buttons", "container", "count", "dropdown", "form", "icon", "icons",
              "inner", "item", "items", "left", "link", "links", "list", "main", "media", "mobile", "outer", "page", "pages", "panel", "post",
              "posts", "reader", "right", "section", "site", "stories", "thread", "toggle", "tools", "user", "wrap", "wrapper"}
IMPLIED_END = {"p", "li"}
OUTSIDE = ("", False, False, False)  # container, in main, chrome, chrome inside the container


def _names(attributes: str) -> tuple[set[str], set[str]]:
    names, roles = set(), set()
    for m in ATTRIBUTE.finditer(attributes):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "role":
            roles.add(value.strip().lower())
        else:
            for token in value.split():
                words = {w.lower() for w in WORDS.findall(token)}
                topic = any(w not in CHROME_NAMES and w not in OUTSIDE_NAMES and w not in PART_NAMES and not w.isdigit() for w in words)
                names |= words - DOUBTFUL_NAMES if topic else words
    return names, roles


def parse(page: str) -> tuple[list[str], list[str]]:
    """(blocks of the declared article, all other blocks) in page order, each with single spaces.

    An ``article`` element declares the article, else ``main`` or its role;
    ``main`` with more text outside its articles than in them is one article.
    Menus, footers, side bars, forms, adverts, notices and comments inside it
    are no part of it. Names of ``html`` and ``body`` mark nothing, and those
    of other elements around an article, and forms, not if the page has no
    other article. Text outside is the second list, scripts and styles
    excluded.
    """
    return parts_of(page)[:2]


def parts_of(page: str) -> tuple[list[str], list[str], list[tuple[str, bool]]]:
    """(blocks of the declared article, all other blocks, all blocks with their chrome mark if there is no article)."""
    blocks: list[tuple[str, str, bool, bool, bool]] = []  # text, container, in main, chrome, chrome if what is around the container is forgiven
    stack: list[tuple[str, str, bool, bool, bool, bool]] = []  # element, these, chrome that is not forgiven
    run: list[str] = []

    def close_block() -> None:
        if run:
            text = " ".join(entities.unescape("".join(run)).split())
            if text:
                blocks.append((text, *(stack[-1][1:5] if stack else OUTSIDE)))
            run.clear()

    at = 0
    while True:
        m = TAG.search(page, at)
        run.append(page[at:m.start()] if m else page[at:])
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        name = m[2].lower()
        if not m[1] and name in RAW:
            if not m[3].endswith("/"):
                end = re.compile(f"</{re.escape(name)}[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            run.append(" ")
            continue
        if name in VOID or (not m[1] and m[3].endswith("/")):
            if name in ("hr",):
                close_block()
            elif name == "br":
                run.append(" ")
            continue
        if m[1]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), -1)
            if name in BLOCK or depth >= 0:
                close_block()
            if depth >= 0:
                del stack[depth:]
            continue
        names, roles = _names(m[3]) if m[3] and name not in ("html", "body") else ((), ())
        if name in BLOCK:
            close_block()
            while stack and stack[-1][0] in IMPLIED_END and (stack[-1][0] == "p" or name == "li"):
                stack.pop()
        inside, in_main, chrome, inner, hard = stack[-1][1:] if stack else (*OUTSIDE, False)
        if name in BLOCK and (name == "article" or name == "main" or "main" in roles):
            around = inside
            inside = "article" if name == "article" or inside == "article" else "main"
            in_main = in_main or name != "article"
            if inside != around:
                inner = hard
        here = name in CHROME or (name == "header" and not inside) or (names or roles) and bool(
            CHROME_NAMES & set(names) or CHROME_ROLES & set(roles) or not inside and OUTSIDE_NAMES & set(names))
        if name in BLOCK or here:
            if here and name not in BLOCK:
                close_block()
            stack.append((name, inside, in_main, chrome or bool(here), inner or bool(here), hard or name in CHROME and name != "form"))
    close_block()
    size = lambda kind: sum(len(t) for t, inside, in_main, chrome, _ in blocks if in_main and not chrome and inside == kind)
    whole_main = size("main") > size("article")
    for mark in (3, 4):
        for container in ("article", "main"):
            declared = [not b[mark] and (b[2] if whole_main and mark == 3 else b[1] == container) for b in blocks]
            if any(declared):
                return [b[0] for b, d in zip(blocks, declared) if d], [b[0] for b, d in zip(blocks, declared) if not d], []
    return [], [b[0] for b in blocks], [(b[0], b[3]) for b in blocks]


def stream(blocks: list[str]) -> tuple[np.ndarray, list[tuple[int, list[str]]]]:
    """(hash of every token, (first position, tokens) of every block); blocks are set apart by a mark."""
    parts, hashes, at = [], [], 0
    for b in blocks:
        words = b.split(" ")
        parts.append((at, words))
        hashes += [hash_word(w) for w in words]
        hashes.append(0)
        at += len(words) + 1
    return np.array(hashes, np.uint64), parts


_WORD: dict[str, int] = {}


def hash_word(word: str) -> int:
    h = _WORD.get(word)
    if h is None:
        import xxhash

        if len(_WORD) > 200_000:
            _WORD.clear()
        h = _WORD[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
    return h


def leading_tokens(hashes: np.ndarray, host: str, length: int) -> np.ndarray:
    """A hash of host and leading tokens for every suffix of at least ``length`` tokens."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    key = np.full(n, hash_word("host " + host), np.uint64)
    for k in range(length):
        key = mix(key + hashes[k:n + k], k + 1)
    return key.view(np.int64)


def codes(hashes: np.ndarray, host: str) -> tuple[bytes, bytes]:
    """(host, token stream with an end of ``DEPTH`` marks) as they are sorted: four bytes a token, the most significant first."""
    stream_codes = np.concatenate([hashes >> np.uint64(32), np.zeros(DEPTH, np.uint64)]).astype(">u4")
    return hash_word("host " + host).to_bytes(8, "big"), stream_codes.tobytes()


def parsed(pages: DataFrame, url: str, html: str, length: int) -> DataFrame:
    """The rows with ``_text`` (null if the page declares no article), ``_blocks`` of such pages.

    ``_suffixes`` has the hash of the leading tokens of every suffix, ``_site`` and ``_stream`` the host and the tokens.
    """
    passed = [c for c in pages.columns if c != html]
    rows = pages.select(F.struct(*passed).alias("_own"), F.col(html).cast("string").alias("_html"), canonical(url)[0].alias("_host"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, open_blocks, keys, sizes, sites, streams = [], [], [], [0], [], []
            for page, host in zip(batch.column("_html").to_pylist(), batch.column("_host").to_pylist()):
                own, other, marked = parts_of(page or "")
                kept = [t for t, chrome in marked if not chrome] or other  # a page of marked blocks only keeps them
                if not own and len(kept) < len(other):  # marked blocks only show what pages share, behind the others
                    other = kept + [t for t, chrome in marked if chrome]
                texts.append("\n".join(own) if own else None)
                open_blocks.append(None if own else kept)
                hashes = stream(other)[0]
                keys.append(leading_tokens(hashes, host, length))
                sizes.append(sizes[-1] + len(keys[-1]))
                site, tokens = codes(hashes, host)
                sites.append(site)
                streams.append(tokens)
            suffixes = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_own"), batch.column("_row"), pa.array(texts, pa.string()),
                 pa.array(open_blocks, pa.list_(pa.string())), suffixes, pa.array(sites, pa.binary()), pa.array(streams, pa.binary())],
                ["_own", "_row", "_text", "_blocks", "_suffixes", "_site", "_stream"])

    out = T.StructType([rows.schema["_own"], rows.schema["_row"], T.StructField("_text", T.StringType()),
                        T.StructField("_blocks", T.ArrayType(T.StringType())), T.StructField("_suffixes", T.ArrayType(T.LongType())),
                        T.StructField("_site", T.BinaryType()), T.StructField("_stream", T.BinaryType())])
    return rows.mapInArrow(run, out)


def shared_lengths(leads: np.ndarray, pages: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For sorted suffixes, the longest prefix that each shares with a suffix of another page in its bucket.

    ``leads`` has a row of tokens for each suffix; ``first`` marks where a bucket begins.
    """
    n = len(pages)
    common = np.zeros(n + 1, np.int64)  # with the suffix before
    equal = leads[1:] == leads[:-1]
    common[1:n] = np.where(equal.all(1), leads.shape[1], equal.argmin(1))
    common[:n][first] = 0
    before, after = common[:n].copy(), common[1:].copy()
    own = np.flatnonzero(pages[1:] == pages[:-1])  # a neighbour of the same page: what it shares goes on, as far as both agree
    for i in own:
        before[i + 1] = min(before[i], common[i + 1])
    for i in own[::-1]:
        after[i] = min(after[i + 1], common[i + 1])
    return np.maximum(before, after)


def shared_strings(suffixes: DataFrame, length: int) -> DataFrame:
    """``_row``, ``pos`` and ``len`` of the shared strings that begin at suffixes of ``_row``, ``pos``, ``key``, ``n`` and ``lead``.

    Suffixes with the same leading tokens have the same ``key``; ``n`` is the number of pages that have it. Each bucket is sorted by
    ``lead``, and neighbours are compared token by token, so equal keys of different tokens share nothing.
    """
    part = F.pmod(F.xxhash64("_row"), F.ceil(F.col("n") / BUCKET_PAGES))
    dealt = (suffixes.select("key", part.alias("part"), "lead", "_row", "pos").repartition("key", "part")
             .sortWithinPartitions("key", "part", "lead", "_row", "pos"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def judged(rows: pa.Table) -> pa.RecordBatch:
            key, part, pages, pos = (rows.column(c).to_numpy() for c in ("key", "part", "_row", "pos"))
            leads = np.frombuffer(b"".join(rows.column("lead").to_pylist()), ">u4").reshape(len(key), -1)
            first = np.ones(len(key), bool)
            first[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
            shared = shared_lengths(leads, pages, first) - 2  # two codes are the host
            found = shared >= length
            return pa.RecordBatch.from_arrays([pa.array(pages[found]), pa.array(pos[found]), pa.array(shared[found].astype(np.int32))],
                                              ["_row", "pos", "len"])

        held: list[pa.RecordBatch] = []  # the last bucket so far, which may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            key, part = batch.column("key").to_numpy(), batch.column("part").to_numpy()
            rest = int(np.flatnonzero((key != key[-1]) | (part != part[-1]))[-1]) + 1 if key[0] != key[-1] or part[0] != part[-1] else 0
            if held and (rest or held[-1].column("key")[0] != batch.column("key")[0] or held[-1].column("part")[0] != batch.column("part")[0]):
                yield judged(pa.Table.from_batches([*held, batch.slice(0, rest)]))
                held = []
            elif rest:
                yield judged(pa.Table.from_batches([batch.slice(0, rest)]))
            held.append(batch.slice(rest))
        if held:
            yield judged(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "_row long, pos int, len int")


def unique_runs(blocks: list[str], covered: set[int]) -> str:
    """The blocks without their covered tokens; a block with none left goes."""
    out = []
    for first, words in stream(blocks)[1]:
        kept = [w for k, w in enumerate(words) if first + k not in covered]
        if kept:
            out.append(" ".join(kept))
    return "\n".join(out)


def extract(pages: DataFrame, url: str = "url", html: str = "html", length: int = LONG) -> DataFrame:
    """Every row without ``html``, with its main ``text`` and ``n_chars``.

    Null or empty html, and a page without text, give an empty text. A null
    URL counts as one host without name. Blocks of a declared article stay
    whole, copies included; white space inside a block becomes one space, and
    blocks are joined by a line feed. Rows repeat as they are; repeated rows
    are distinct pages. An empty table gives an empty result. Other columns
    pass through; columns named ``text`` or ``n_chars`` are replaced.
    """
    pages = pages.drop(*[c for c in ("text", "n_chars") if c not in (url, html)])
    rows = stored(parsed(pages, url, html, length), "pages")
    waiting = rows.where("_text is null and size(_blocks) > 0")
    # buckets that decide something: of two pages or more, one of them without article; a hot one meets as one row per task
    keys = rows.select(F.expr("_text is null and size(_blocks) > 0").alias("open"), F.explode(F.array_distinct("_suffixes")).alias("key"))
    buckets = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("open").alias("open")).where("n > 1 and open").select("key", "n")
    buckets = stored(buckets, "buckets")
    few = buckets.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    lead = F.concat("_site", F.substring("_stream", F.col("pos") * 4 + 1, F.lit(DEPTH * 4)))
    suffixes = (rows.select("_row", "_site", "_stream", F.posexplode("_suffixes").alias("pos", "key"))
                .select("_row", "pos", "key", lead.alias("lead")).join(F.broadcast(buckets) if few else buckets, "key"))
    found = shared_strings(suffixes, length).groupBy("_row").agg(F.collect_list(F.struct("pos", "len")).alias("_strings"))

    @F.udf("string", useArrow=True)
    def remaining(blocks, strings):
        return unique_runs(blocks, {k for s in strings if s is not None for k in range(s[0], s[0] + s[1])} if strings is not None else set())

    judged = waiting.join(found, "_row", "left").select("_own", remaining("_blocks", "_strings").alias("text"))
    settled = rows.where("_text is not null or size(_blocks) = 0 or _blocks is null").select("_own", F.coalesce("_text", F.lit("")).alias("text"))
    both = settled.union(judged).select("_own", F.coalesce("text", F.lit("")).alias("text"))
    return both.select("_own.*", "text", F.char_length("text").cast("long").alias("n_chars"))


@query("op2_html_text")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
