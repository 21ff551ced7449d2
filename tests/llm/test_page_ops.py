"""Pages: text extraction, archives, URL rules."""

import base64
import hashlib
import html as entities
import re

import numpy as np
import pytest

from voxledger.llm import html_text, url_filter, warc
from voxledger.llm.common import shared_folder


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "http://Www.A.net/en/x?q#f", "<p>one</p>"), (2, "https://a.net", "<p>one</p>"), (3, None, None), (4, "no scheme", ""),
            (5, "x://B.ORG/fr/y#/z", "<p>é &amp; " + "long " * 50_000 + "</p>"), (6, "http://b.org/fr/\r\n%41", "<p>two</p>"),
            (None, "http://b.org/q", "<p>one</p>"), (1, "http://Www.A.net/en/x?q#f", "<p>one</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for c in ("text", "host", "rule", "_rule", "_row", "_own", "_text", "key"):
        df = df.selectExpr("*", f"'{c}' AS `{c}`")
    return df.cache()


# --- text

def test_parts_of_a_page():
    own, other = html_text.parse(
        '<html><head><title>x</title></head><body><header>Site</header><div class="cookie-notice">We use cookies</div><main>'
        '<article class="post"><header><h1>T &amp; U</h1></header><p class="ad">buy<p>Hello <b>wor</b>ld<br>again &lt;b&gt;'
        '<ul><li>one<li>two</ul><aside>side</aside><div id="comments"><p>nice</p></div><script>if(a<b){"</p>"}</script>'
        '<form><p>send</p></form><p> the  end\n.</p></article></main><footer>f</footer></body>')
    assert own == ["T & U", "Hello world again <b>", "one", "two", "the end ."]
    assert other == ["Site", "We use cookies", "buy", "side", "nice", "send", "f"]
    assert html_text.parse("") == ([], []) and html_text.parse("a < b <!-- x") == ([], ["a < b"])
    assert html_text.parse("<main><p>m</main><p>q") == (["m"], ["q"])
    assert html_text.parse("<p>a<p>b<div>c</div>d<style>p{}</style>") == ([], ["a", "b", "c", "d"])


def test_marked_parts_without_article(spark):
    menu, form = "<nav>Home News</nav><div class='menu'>About</div>", "<form>send</form><div id='comments'><p>nice</p></div><footer>f</footer>"
    rows = [(1, f"<body class='has-sidebar'>{menu}<p>Own text</p>{form}</body>"), (2, f"<body class='comments-open'>{menu}<article><p>A</p></article>{form}"),
            (3, f"<div class='widget'>{menu}<article><p>A</p><div class='ad'>buy</div></article></div>"),
            (4, f"<main>{menu}<p>A long story of the main part.</p><article>Teaser</article></main>"),
            (5, f"<form id='page'>{menu}<main><p>M</p></main></form>"), (6, "<form><p>All in a form</p></form>"),
            (7, "<article><p>A</p></article><div class='sidebar'><article>Teaser</article></div>")]
    df = spark.createDataFrame([(k, f"http://h{k}.example/", h) for k, h in rows], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_text.extract(df).collect()} == {
        1: "Own text", 2: "A", 3: "A", 4: "A long story of the main part.\nTeaser", 5: "M", 6: "All in a form", 7: "A"}


@pytest.mark.parametrize("name, kept", [
    ("lead social-science", True), ("share-price", True), ("search-results-list", True), ("related-work", True), ("notice-period", True),
    ("menu-engineering", True), ("comment-density", True), ("share-buttons", False), ("cookie-notice", False), ("social", False),
    ("related-posts", False), ("comment-list", False), ("user-comments", False), ("x share", False), ("comment-17", False), ("sidebar-x", False)])
def test_names_of_topics_stay(name, kept):
    """A name that may be a topic marks a block only alone or beside words for page parts."""
    own, _ = html_text.parse(f"<article><h1>T</h1><div class='{name}'>Intro</div><p id='{name.split()[-1]}'>More</p></article>")
    assert own == (["T", "Intro", "More"] if kept else ["T"])


def test_articles_of_the_table(spark, sf):
    from voxledger.llm.catalog import QUERIES

    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op2_html_text"](spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        parts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        want = "\n".join(p for p in parts if p)
        assert got[r.page_id] == (want, len(want))


def test_shared_strings_of_a_host_go(spark):
    menu = "<div>Home News Sport Weather Travel Culture Food Shop About</div>"
    rows = [(k, f"http://h{k % 2}.example/p", f"{menu}<p>Only page {k} says this</p>") for k in range(6)]
    rows += [(9, "http://other.example/", menu)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(6):
        assert got[k].startswith(f"{k} says this") or got[k] == f"Only page {k} says this"
        assert "Home" not in got[k]
    assert got[9].startswith("Home News")  # another host: no copy


def test_sorted_suffixes_against_all_pairs(spark):
    """Shared strings come from neighbours of the sorted suffixes; leading hashes that are equal for other tokens show nothing."""
    rng = np.random.default_rng(3)
    streams = [rng.integers(1, 3, rng.integers(1, 30)).tolist() for _ in range(25)] + [[1] * 40]
    leads = [(p, k, [7, 7, *s[k:], *[0] * html_text.DEPTH][:html_text.DEPTH + 2]) for p, s in enumerate(streams) for k in range(len(s))]
    common = lambda a, b: next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    for buckets, pages, arrow in ((lambda x: hash(tuple(x[2:6])), 2, 10_000), (lambda x: 1, 2, 7), (lambda x: x[2], 2, 1)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", arrow)
        rows = [(p, k, buckets(x), pages, np.array(x, ">u4").tobytes()) for p, k, x in leads]
        got = html_text.shared_strings(spark.createDataFrame(rows, "_row long, pos int, key long, n long, lead binary"), 4).collect()
        want = {}
        for p, k, x in leads:
            best = max(common(x, y) for q, _, y in leads if q != p) - 2
            if best >= 4:
                want[p, k] = best
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert {(r._row, r.pos): r.len for r in got} == want and len(got) == len(want)


def test_hot_strings_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(html_text, "BUCKET_PAGES", 8)
    notice = "<p>This site is kept by volunteers and needs your kind help now</p>"
    rows = [(k, "http://h.example/", f"{notice}<p>Only{k} here{k}</p>" + "<article>A</article>" * (k % 2)) for k in range(200)]
    rows += [(900, "http://i.example/", notice)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert got[900].startswith("This site") and len(got) == 201
    assert all(got[k] == ("A" if k % 2 else f"Only{k} here{k}") for k in range(200))


def test_extract_odd_rows(pages):
    out = html_text.extract(pages)
    assert set(pages.columns) - {"html"} <= set(out.columns)
    rows = out.collect()
    assert len(rows) == 8 and {r.text for r in rows if r.page_id in (3, 4)} == {""}
    assert [r.text for r in rows if r.page_id == 5] == ["é & " + ("long " * 50_000).strip()]
    assert html_text.extract(pages.limit(0)).count() == 0


# --- archives

def test_archives_round_trip(spark, pages):
    folder = shared_folder(spark, "test-warc")
    written = warc.write_archives(pages, folder).collect()
    assert sum(r.records for r in written) == 8
    rows = warc.read_archives(spark, folder).collect()
    sha = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
    text = {r.page_id: (r.html or "", r.url) for r in pages.collect()}
    assert len(rows) == 8
    for r in rows:
        t, url = text[r.page_id]
        assert (r.payload_bytes, r.payload_digest, r.url) == (len(t.encode()), sha(t), url)
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == t.encode()
    kinds = {(r.page_id, r.record_type, r.refers_to) for r in rows}
    assert kinds == {(1, "response", None), (2, "revisit", 1), (3, "response", None), (4, "revisit", 3), (5, "response", None),
                     (6, "response", None), (None, "revisit", 1)}


def test_small_payloads_stay_responses(spark, pages):
    folder = shared_folder(spark, "test-warc")
    warc.write_archives(pages, folder, least=100, size=1).collect()
    assert {r.record_type for r in warc.read_archives(spark, folder).collect()} == {"response"}
    assert warc.write_archives(pages.limit(0), shared_folder(spark, "test-warc")).count() == 0


def test_records_are_frames_behind_a_skippable_one():
    import zstandard

    d = warc.build_dictionary([])
    press = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d))
    one = warc.record(1, "u", b"body", 4, warc.digest(b"body"))
    archive = warc.dictionary_frame(d) + press.compress(one) + press.compress(one)
    assert archive[:4] == bytes.fromhex("5d2a4d18") and list(warc.records(archive)) == [one, one]
    with pytest.raises(ValueError):
        list(warc.records(archive[:-3]))


# --- URL rules

def brute_rule(url, rules=url_filter.RULES):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    m = re.match(r"(?s)([^/?#]*)([^?#]*)", rest)
    host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1])
    fits = []
    for verdict, rule in rules:
        rh, _, rp = rule.partition("/")
        if (host == rh or host.endswith("." + rh)) and m[2].startswith("/" + rp):
            fits.append((len(rule), rule, verdict))
    best = max(fits, default=(0, None, "allow"))
    return host, m[2], best[1], best[2]


def test_url_rules(spark, pages):
    more = [f"http://{h}{p}" for h in ("net", "xnet", "a.net", "example.net", "b.example.net:80", "org", "a.org", "example.com", "é.org", "a.com/x.net")
            for p in ("", "/", "/en/", "/en", "/de/x", "/fr/y?z", "/en/#/fr/", "//net/")] + ["://", "a://b://c.net/", "HTTP://EXAMPLE.NET/en/x/" + "y" * 5000]
    df = spark.createDataFrame([(k, u) for k, u in enumerate(more)], "page_id long, url string")
    for r in url_filter.filter_urls(df).collect():
        assert (r.host, r.path, r.rule, r.verdict) == brute_rule(r.url), r.url
    out = url_filter.filter_urls(pages)
    assert out.count() == 8 and "_rule" in out.columns and url_filter.filter_urls(pages.limit(0)).count() == 0


def test_globs_over_many_words():
    rules = [("block", f"host{k}.example/dir{k}/") for k in range(200)]
    auto = url_filter.compile_globs(url_filter.rule_globs(rules))
    assert auto.start.shape[0] > 10
    urls = [f"x.host{k}.example/dir{k}/p".encode() for k in range(200)] + [b"", b"host1.example/dir2/"]
    hit = url_filter.simulate(auto, urls, 200)
    assert (hit[:200].argmax(1) == range(200)).all() and (hit.sum(1)[:200] == 1).all() and not hit[200:].any()
    literal = url_filter.compile_globs([(0, r"a\*b**c")])
    assert url_filter.simulate(literal, [b"a*b/x/c", b"axbc", b"a*bc"], 1)[:, 0].tolist() == [True, False, True]
