"""URL filters, sharding and HTML extraction against brute force on small tables."""

import re
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from productlens.llm import html_text, queries, sharding, url_filters
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD

LIST = "host string, path string, verdict string, is_rule boolean"


def judged(spark, urls, listings, **kw):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in urls], "page_id long, url string, host string, verdict string")
    rows = url_filters.judge_urls(pages, spark.createDataFrame(listings, LIST), **kw).collect()
    return sorted((r.page_id is None, r.page_id or 0, r.host, r.path, r.rule, r.listed, r.verdict) for r in rows)


def brute(url, listings):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda c: c[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(rule, len(h + p), v == "allow", h + p) for h, p, v, rule in listings
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, _, allow, key = max(fits, default=(False, 0, True, None))
    return host, path, key if rule else None, None if rule else key, "allow" if allow else "block"


RULES = [("org", "/", "allow", True), ("example.org", "/es/", "block", True), ("example.org", "/en/1", "allow", True),
         ("com", "/fr/", "allow", True), ("com", "/de/", "block", True), ("bad.example.net", "/", "block", False),
         ("example.net", "/x/", "block", False), ("example.net", "/x/", "allow", False), ("bad.example.org", "/", "block", False)]
URLS = [None, "", "no scheme", "http://", "http://EXAMPLE.org/es/1", "http://a.b.example.org/en/12?x#y", "ftp://x.com/fr/",
        "http://x.com", "http://com/de/", "http://xcom/de/", "http://bad.example.net/q", "http://q.bad.example.net#f",
        "http://bad.example.net?f", "http://bad.example.org/", "http://example.net/x/y", "a://b://c.org/", "://org/",
        "http://É.org/", "http://x.com/de/\n/z", "http://" + "a." * 30_000 + "com/fr/" + "z" * 50_000, "http://org./"]


def test_urls_equal_brute_force(spark):
    urls = list(enumerate(URLS)) + [(3, URLS[4])] * 2 + [(None, URLS[5])]
    want = sorted((i is None, i or 0, *brute(u, RULES)) for i, u in urls)
    assert judged(spark, urls, RULES) == want
    # a filter so small that nearly everything passes it: the join removes the false positives
    assert judged(spark, urls, RULES, filter_bytes=64) == want


def test_registered_url_query_blocks_every_spelling(spark, tmp_path):
    site, key = "casino-win.example.com", "casino-win.example.com/"
    spelled = [site, site + "?q=1", site + "#f", site + ":8080/x", site + ":", site + "./x", "u:p@q@" + site + "/x", "a.B." + site.upper(),
               "casino%2dwin.example%2Ecom/x", "%63ASINO-win.example.com:80"]
    free = ["xcasino-win.example.com/", site + ".de/", site + "@other.example.com/x", "casino%252dwin.example.com/x", "a:80/" + site]
    urls = [(i, f"http://{u}") for i, u in enumerate(spelled + free)] + [(50, f"http://{site}:80/fr/"), (51, f"http://{site}/fr/"), (52, None)]
    spark.createDataFrame(urls, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = {r.page_id: r for r in queries.op4_url_filters(spark, str(tmp_path)).collect()}
    for i, u in enumerate(spelled):
        assert (got[i].listed, got[i].verdict, got[i].rule) == (key, "block", None), u
    for i, u in enumerate(free, len(spelled)):
        assert (got[i].listed, got[i].verdict) == (None, "allow"), u
    # host, path and rules as written: a port keeps the rule from fitting
    assert (got[50].host, got[50].rule, got[50].listed) == (site + ":80", None, key)
    assert (got[51].rule, got[51].verdict, got[52].verdict) == ("com/fr/", "allow", "allow")
    assert (got[1].host, got[1].path, got[6].host) == (site, "", "u:p@q@" + site)


def test_listings_meet_urls_in_canonical_form(spark):
    listings = [("Site.example:80", "", "block", False), ("b%2Eexample.", "/%7ea/%c3%a9", "block", False), ("b.example", "/%7ea", "allow", True)]
    got = judged(spark, list(enumerate(["x://site.example", "x://b.example/~a/%C3%A9/x%", "x://b.example/%7ea/%C3%A9", "x://b.example/~a/%c3", "x://b.example/~a/%C3%A9%4"])),
                 listings, canonical=True)
    assert [r[4:] for r in got] == [(None, "site.example/", "block"), (None, "b.example/~a/%C3%A9", "block"), ("b.example/%7ea", None, "allow"),
                                    (None, None, "allow"), (None, "b.example/~a/%C3%A9", "block")]


def test_urls_without_listings_or_rows(spark):
    assert {r[-1] for r in judged(spark, list(enumerate(URLS)), [])} == {"allow"}
    assert judged(spark, [], RULES) == []


def test_many_listings_pass_the_filter(spark):
    rng = np.random.default_rng(1)
    hosts = [f"h{n}.example" for n in range(3000)]
    listings = [(h, "/", "block", False) for h in hosts[::2]]
    urls = [(i, f"http://{hosts[i]}/p") for i in rng.integers(0, 3000, 400).tolist()]
    got = judged(spark, urls, listings)
    assert [r[-1] for r in got] == ["block" if r[1] % 2 == 0 else "allow" for r in got]


def test_registered_url_query(spark):
    listings = [(h, p, v, True) for h, p, v in queries.URL_RULES] + [
        (f"{s}.{z}", "/", "block", False) for s in queries.LISTED_SITES for z in queries.LISTED_ZONES]
    urls = {r.page_id: r.url for r in queries.table(spark, SF_SMALL, "pages").collect()}
    got = {r.page_id: (r.host, r.path, r.rule, r.listed, r.verdict) for r in queries.op4_url_filters(spark, SF_SMALL).collect()}
    assert got == {i: brute(u, listings) for i, u in urls.items()}


def test_registered_url_rules_are_those_of_the_contract(spark, tmp_path):
    contract = "allow org/, block example.org/es/, block example.org/en/1, allow com/fr/, block com/de/"
    want = {key: verdict for verdict, key in (r.split(" ") for r in contract.split(", "))}
    assert {h + p: v for h, p, v in queries.URL_RULES} == want
    urls = ["http://example.org/en/1", "http://a.Example.org/en/12?x", "http://example.org/en/2", "http://example.org/es/1",
            "http://x.com/fr/", "http://x.com/de/1"]
    rules = ["example.org/en/1", "example.org/en/1", "org/", "example.org/es/", "com/fr/", "com/de/"]
    spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted((r.page_id, r.rule, r.verdict) for r in queries.op4_url_filters(spark, str(tmp_path)).collect())
    assert got == [(i, r, want[r]) for i, r in enumerate(rules)]
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert sorted(con.sql(queries.ORACLE["op4_url_filters"]).project("page_id, rule, verdict").fetchall()) == got


def test_url_sql_equals_query_on_odd_urls(spark, tmp_path):
    site = "casino-win.example.com"
    spelled = [site, site + "./x", "u:p@q@" + site + "/x", "a.B." + site.upper() + ":80?", "casino%2dwin.example%2Ecom/%zz%", "%63ASINO-win.example.com:80",
               "casino%252dwin.example.com/x", "%", "%e9%2", site + ":80/fr/", "\n" + site, site + ":8\n"]
    urls = [*URLS, *(f"http://{u}" for u in spelled), URLS[4]]
    rows = [(None if k == 5 else k % 20, u) for k, u in enumerate(urls)]
    spark.createDataFrame(rows, "page_id long, url string").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    got = queries.op4_url_filters(spark, str(tmp_path))
    want = con.sql(queries.ORACLE["op4_url_filters"])
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())


def test_filter_grows_with_the_list_up_to_a_bound():
    sizes = [url_filters.filter_size(n) for n in (0, 1, 100_000, 10_000_000, 1 << 40)]
    assert sizes[0] == sizes[1] == url_filters.LEAST_BYTES and sizes[-1] == url_filters.MOST_BYTES
    assert all(b % 64 == 0 for b in sizes) and 100_000 * url_filters.KEY_BYTES <= sizes[2] < sizes[3]


def check_shards(rows, texts, shards):
    assert sorted(((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in rows)) == sorted(
        (i is None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(shards))
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    return {k: sum(r.size for r in v) for k, v in by.items()}


def test_shards_on_odd_rows(odd_docs, make_docs):
    check_shards(sharding.shard_by_bytes(odd_docs, 4).collect(), ODD, 4)
    assert sharding.shard_by_bytes(make_docs([]), 4).count() == 0
    one = sharding.shard_by_bytes(make_docs([(1, "x")]), 16).collect()
    assert len(one) == 1 and one[0].slot == 0


def test_shards_are_balanced_and_contiguous_with_a_hot_text(make_docs):
    rng = np.random.default_rng(5)
    texts = [(i, "hot copy " * 20 if i % 3 == 0 else "w" * int(rng.integers(0, 400))) for i in range(3000)]
    sizes = check_shards(sharding.shard_by_bytes(make_docs(texts), 16).collect(), texts, 16)
    target = sum(sizes.values()) / 16
    assert len(sizes) == 16 and max(abs(s - target) for s in sizes.values()) <= 401
    rows = sharding.shard_by_bytes(make_docs(texts), 16).collect()
    shards_of = {}
    for r in rows:
        shards_of.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(s) > 1 for s in shards_of.values()) <= 15  # only texts at a cut
    hot = shards_of[zlib.crc32(("hot copy " * 20).encode())]
    assert sorted(hot) == list(range(min(hot), max(hot) + 1))


def test_registered_shards(spark):
    docs = [(r.doc_id, r.text) for r in queries.table(spark, SF_SMALL, "documents").collect()]
    rows = queries.op5_sharding(spark, SF_SMALL).collect()
    sizes = check_shards(rows, docs, 16)
    largest = max(len(t.encode()) + 1 for _, t in docs)
    assert max(abs(s - sum(sizes.values()) / 16) for s in sizes.values()) <= largest
    assert {(r.law, r.grown_shard) for r in rows} == {("bytes", None)}


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site name</h2></header><nav><ul><li><a href="/x">menu one</a></li></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies here</div><div class="ad">Buy this now</div>
<article><h1>A &lt;b&gt; title&nbsp;here</h1><p><b>First</b> <i>bold</i>text   of\nthe page.<br>Next line<p>Second &amp; last
<div class="adBanner"><p>advert inside</p></div><p>Fish &#38; chips<form><input><button>Send</button></form></p>
<noscript>hidden</noscript><p>End.</p></article>
<section id="comments"><p>nice post reader comment</p></section><aside>side bar text</aside><footer>&copy; us</footer></body></html>"""
TEXT = "A <b> title here First boldtext of the page. Next line Second & last Fish & chips End."


def test_page_text():
    assert html_text.main_text(PAGE, {}) == TEXT
    assert html_text.tag_counts(PAGE)["h1", 1] == 2 and ("h2", 0) not in html_text.tag_counts(PAGE)
    assert html_text.main_text("", {}) == html_text.main_text("<p><b></p>", {}) == ""
    assert html_text.main_text("plain < text &amp; more", {}) == "plain < text & more"
    assert html_text.main_text("<p>one two three<p class='x", {}) == "one two three"
    assert html_text.main_text("<article><p>cut off <a href=\"x", {}) == "cut off"


def test_marks_and_links():
    for mark in ('class="commentlist"', "id=respond", "class='x topBanner'", 'role="navigation"', 'id="userComments"'):
        assert html_text.main_text(f"<p>one two three</p><div {mark}><p>four five</p></div>", {}) == "one two three", mark
    for free in ('class="commentary"', 'class="badge header-less"'[:13], 'data-x="1"', 'class="adapt"'):
        assert html_text.main_text(f"<p>one two three</p><div {free}><p>four five</p></div>", {}).endswith("five"), free
    assert html_text.main_text("<h1><a href=x>A title</a></h1><p>one two</p><ul><li><a href=y>more links here</a></li></ul>", {}) \
        == "A title one two"


def test_marked_wrappers_do_not_hide():
    for mark in ('class="layout has-sidebar"', 'class="wrapper header-fixed"', 'id="no-comments"', 'role="alert"'):
        article = f"<div {mark}><div class='sidebar'>side words</div><article><h1>Title</h1><p>one two three</p></article></div>"
        assert html_text.main_text(article, {"article": 30.0}) == "Title one two three", mark
        assert html_text.tag_counts(article)["h1", 1] == 2
        body = f"<p>Lead here</p><div {mark}><p>{'w ' * 9}</p><div class=ad>buy it</div><p>end</p></div><aside>{'s ' * 40}</aside>"
        assert html_text.main_text(body, {}) == "Lead here " + "w " * 9 + "end", mark
        posts = "".join(f"<article><h2>T{i}</h2><div {mark}><p>{'v ' * 5}</p></div></article>" for i in range(2))
        assert html_text.main_text(posts, {}) == " ".join(f"T{i} v v v v v" for i in range(2)), mark
    # comments longer than the article, each an article of its own, stay out
    comments = "<section id=comments>" + "<article class=comment><p>" + "c " * 30 + "</p></article>" * 3 + "</section>"
    for page in ("<article><p>one two three</p></article>" + comments,
                 "<main><article><p>one two three</p></article>" + comments + "</main>"):
        assert html_text.main_text(page, {}) == "one two three"


@pytest.mark.parametrize("inside, want", [
    ("<p>Before it. <svg class='i'/> After it.</p><p>Last one.</p>", "Before it. After it. Last one."),
    ("<p>Draw <svg><path d='M0'/><text>no</text></svg> a line.</p>", "Draw a line."),
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>5</mn></math> be five.</p>", "Let x=5 be five."),
    ("<p>So <math><semantics><mi>y</mi><annotation encoding='TeX'>y^2</annotation></semantics></math>.</p>", "So y."),
    ("<p id='comments-on-trade'>On trade we wrote much.</p>", "On trade we wrote much."),
    ("<section id='social-history'><p>History of towns and people.</p></section>", "History of towns and people."),
    ("<div id='comments'><p>first! great!</p></div><p>The end is here.</p>", "The end is here."),
    ("<ul>" + "".join(f"<li><a href='/{i}'>Long link name number {i} here</a></li>" for i in range(30))
     + "</ul><p>A closing word.</p>", " ".join(f"Long link name number {i} here" for i in range(30)) + " A closing word."),
])
def test_article_text_is_not_lost(inside, want):
    page = ("<body><nav><a href='/'>Home page</a></nav><article><h1>Title</h1><p>A first paragraph of some words, long enough.</p>"
            f"{inside}</article><footer>Imprint</footer></body>")
    costs = {"nav": 30.0, "article": 30.0, "footer": 30.0, **{n: 0.02 for n in ("p", "h1", "ul", "li", "a", "div", "section")}}
    assert html_text.main_text(page, costs) == "Title A first paragraph of some words, long enough. " + want


@pytest.mark.parametrize("tags", ["<div>", "<font>", "<p><font>", "<b><div><i>", "<i></b>", "<div></p>", "<li><a href=x>"])
def test_unclosed_tags_take_linear_time(tags):
    page = "<article><b>" + (tags + "word ") * 80_000 + "</b></article>"
    start = time.perf_counter()
    text = html_text.main_text(page, {})
    assert time.perf_counter() - start < 5 and set(text.split()) <= {"word"}


def test_region_is_the_best_run():
    costs = {"hr": 5.0}
    assert html_text.main_text("<p>a b<hr><p>" + "w " * 9 + "<p>x y<hr><p>z", costs) == ("w " * 9 + "x y")
    assert html_text.main_text("<p>" + "v " * 6 + "<hr><p>" + "w " * 9, costs) == ("v " * 6 + "w " * 9).strip()


def test_extraction_on_odd_rows(spark):
    deep = "<div>" * 3000 + "<p>deep words here</p>" + "</div>" * 3000
    rows = [(1, "u", PAGE), (1, "u", PAGE), (2, None, None), (None, "v", ""), (3, "w", deep)]
    pages = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, id long")
    got = sorted((r.page_id or 0, r.url or "", r.text) for r in html_text.extract(pages).collect())
    assert got == sorted([(1, "u", TEXT), (1, "u", TEXT), (2, "", ""), (0, "v", ""), (3, "w", "deep words here")])
    assert html_text.extract(pages.limit(0)).count() == 0


def test_registered_extraction(spark):
    import html
    pages = {r.page_id: r.html for r in queries.table(spark, SF_SMALL, "pages").collect()}
    for r in queries.op3_html_text(spark, SF_SMALL).collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", pages[r.page_id], re.S)[1]
        inner = re.sub(r"</?b>", "", re.sub(r"<[^>]*$", "", inner))
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inner)).split())
        assert (r.text, r.n_chars) == (want, len(want))
