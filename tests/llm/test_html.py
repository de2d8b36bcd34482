import re

import cases
import pytest
from pyspark.sql import functions as F

from storelens.llm import html

PAGES = [
    ("<html><body><nav>menu</nav><article><h1>T</h1><p>one <b>t</b>wo<br>three<p>four &amp; five&nbsp;six</article><footer>f</footer>", "T one two three four & five six"),
    ("<body><header>h</header><main><div class='ad'>ad</div><p>text</p><aside>side</aside></main></body>", "text"),
    ("<body><div id=cookie-notice>c</div><div>body <i>text</i></div><form><input value=x>send</form><ul class=\"menu\"><li>m</ul></body>", "body text"),
    ("<article>a<section class='comments'><article class=comment>c</article></section></article><article class='comment'>d</article>", "a"),
    ("<article>a<script>var t='</p>';</script><style>p{}</style><!-- x <p>y</p> -->b</article>", "ab"),
    ("<p>one</p><script>never closed", "one"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a b c d e"),
    ("<article>x &lt;b&gt; &#233; &copy &am; <img src=a>y</article>", "x <b> é © &am; y"),
    ("<ARTICLE><P>Up</P></ARTICLE><FOOTER>no", "Up"),
    ("<article><p title='a > b'>q</p>tail <b", "q tail"),
    ("<article><header><h1>Head</h1></header>text</article>", "Head text"),
    ("<article><p hidden>no</p><div style='display: none'>no</div><div role=complementary>no</div>yes</article>", "yes"),
    ("just text", "just text"), ("", ""), (None, ""), ("<nav>only</nav>", ""), ("< not a tag", "< not a tag"), ("<article></b></p>x</div></article>", "x"),
    ("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>", "deep"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_templates_are_counted_by_host_and_deleted(spark):
    rows = []
    for k in range(12):
        body = f"<article><p>own text {k}</p><p>shared line</p><div class=x>Read more <a href=/s>at our site</a></div></article><div>Imprint of the host</div>"
        rows.append((k, "http://a.example/%d" % k, body))
        rows.append((100 + k, "https://b.example/%d" % k, body if k == 0 else f"<div>plain {k}</div>"))
        rows.append((200 + k, "http://c.example/", "<article><div>copied page</div></article>"))
    pages = spark.createDataFrame([(*r, "clash", 1, "c") for r in rows], "page_id long, url string, html string, text string, n_chars long, `_host` string")
    got = {r[0]: r[1] for r in html.extract_pages(pages).select("_row.page_id", "text").collect()}
    assert got[3] == "own text 3 shared line"  # the paragraph recurs too, but only containers are templates
    assert got[100] == "own text 0 shared line Read more at our site" and got[103] == "plain 3"
    assert got[200] == "copied page"  # copies of one page are no template


@pytest.mark.parametrize("sent", [html.SENT_TEMPLATES, 0])
def test_templates_of_large_hosts(spark, monkeypatch, sent):
    monkeypatch.setattr(html, "SENT_TEMPLATES", sent)
    rows = [(k, "http://a.example/%d" % k, f"<article><p>own {k}</p>" + (f"<div class=x><a href=/s>Section {k % 100}</a></div>" if k < 500 else "") + "</article>") for k in range(1000)]
    rows += [(2000 + k, "http://b.example/%d" % k, f"<article><p>own {k}</p><div class=x><a href=/s>Section 0</a></div></article>") for k in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r[0]: r[1] for r in html.extract_pages(pages).select("_row.page_id", "text").collect()}
    assert all(got[k] == f"own {k}" for k in range(1000))  # 100 templates on 5 of 1,000 pages each
    assert all(got[2000 + k] == f"own {k} Section 0" for k in range(4))  # on four pages of this host only


def test_articles_shared_by_pages_stay(spark):
    """One body under five titles, a list of parts on every page, a box that also stands outside articles, and a list of links."""
    body = "<div class=content><p>Long shared body.</p><ul><li>flour<li>salt</ul><table><tr><td>w<td>3</table></div>"
    rows = [(k, "http://a.example/%d" % k, f"<div>Call us</div><article><h1>Title {k}</h1>{body}<div>Call us</div><ul><li><a href=/x>More of this</a></ul></article>") for k in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r[0]: r[1] for r in html.extract_pages(pages).select("_row.page_id", "text").collect()}
    assert got == {k: f"Title {k} Long shared body. flour salt w 3" for k in range(9)}


def test_templates_counted_by_hand(spark):
    """Subtrees outside articles and link lists inside, counted over different pages of a host by plain Python."""
    from collections import Counter

    d = cases.table("pages")
    seen = {(re.sub(r"^https?://([^/:]*).*", r"\1", u or "").lower(), h or "") for u, h in zip(d["url"], d["html"])}
    counts = Counter(x for host, h in seen for x in html.template_hashes(html.parse(h), host))
    rows = html.packed(spark.read.parquet(f"{cases.SF}/pages.parquet"), "html").withColumn("_host", F.coalesce(F.lower(F.regexp_extract("_row.url", html._HOST, 1)), F.lit("")))
    found = html.site_templates(html.page_trees(rows.withColumn("_page", F.xxhash64("_host", F.coalesce("_text", F.lit("")))).select("_host", "_text", "_page")))
    assert {r["tree"]: r["n"] for r in found.collect()} == {x: n for x, n in counts.items() if n >= html.LEAST_PAGES}


NAMES = [
    ("<h2 id='Related_work'>Related work</h2>", True), ("<section id='social-history'>s</section>", True), ("<div class='share-price'>s</div>", True),
    ("<p class='notice'>s</p>", True), ("<div class='share-buttons'>s</div>", False), ("<div class='cookie_notice_box'>s</div>", False), ("<div class='x ad'>s</div>", False),
    ("<div id=comments-2>s</div>", False), ("<div class='ad-slot top'>s</div>", False), ("<div class='advertisement_policy_history'>s</div>", True),
]


@pytest.mark.parametrize("part, kept", NAMES)
def test_names_inside_an_article(part, kept):
    text = html.main_text(f"<article>T {part} x</article>")
    assert text == ("T " + re.sub("<[^>]*>", "", part) + " x" if kept else "T x")


def test_time_grows_with_the_text():
    import time

    hostile = ["<span>" * 150_000 + "<p>x" * 150_000, "<b>x</div>" * 200_000, "<b><div>" + "<span>" * 150_000 + "</b>" * 150_000, "<li>" * 200_000 + "</td>" * 200_000, "<table>" * 90_000 + "<tr><td>" * 90_000]
    for page in hostile:
        start = time.time()
        html.main_text(f"<article>{page}</article>")
        assert time.time() - start < 20


def test_awkward_pages(spark):
    rows = [(k, None if k % 2 else f"http://h{k}/", p) for k, (p, _) in enumerate(PAGES)] + [(0, "http://h0/", PAGES[0][0]), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r[0] is None, r[0], r[1], r[2]) for r in html.extract_pages(pages).select("_row.page_id", "text", "n_chars").collect())
    want = [PAGES[r[0]][1] if r[0] is not None else "" for r in rows]
    assert got == sorted((r[0] is None, r[0], t, len(t)) for r, t in zip(rows, want))
    assert html.extract_pages(pages.limit(0)).count() == 0


def test_small_table(spark):
    import re
    from html import unescape

    d = cases.table("pages")
    got = {r[0]: r[1] for r in html.extract_pages(spark.read.parquet(f"{cases.SF}/pages.parquet")).select("_row.page_id", "text").collect()}
    for page, source in zip(d["page_id"], d["html"]):
        m = re.search(r"<article>(.*?)</article>", source, re.S)
        plain = unescape(re.sub(r"<[^>]*>", "", re.sub(r"</?(p|br|h1)>", " ", m[1] if m else "")))
        assert got[page] == " ".join(plain.split())
