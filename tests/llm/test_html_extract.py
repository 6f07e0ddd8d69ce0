import html
import re

import pyarrow.parquet as pq
from llm_rows import SF01, shipped  # noqa: F401

from loyalspark.llm import html_extract as H
from loyalspark.llm.queries import QUERIES


def test_blocks_of_tag_soup():
    cases = {
        "<p>a<b>b</b> c &amp; d<br>e<p>f<ul><li>x<li>y</ul>z": "ab c & d e|f|x|y|z",
        "<article><header><h1>T</h1></header><p>x&nbsp;y</p><form>no</form><div id=ad-1>no</div>ok</article>": "T|x y|ok",
        "<div class='comment-list'>no</div><aside>no</aside><nav>no<div>no</div></nav><div role=banner>no</div>yes": "yes",
        "<table><tr><td>1<td>2<tr><td>3</table>t": "1|2|3|t",
        "<script>if(a<b)</script>x<style>p{}</style>": "x", "<p>1 < 2 &lt; 3 &#x41;&bogus;": "1 < 2 < 3 A&bogus;",
        "": "", "<": "<", "<a": "", "<!-- never closed": "", "text only": "text only", "</p></div>x": "x",
        "<article class='comment'>c</article>a<span class=ad>q</span>w": "a|w", "<title>no</title><body>b": "b",
    }
    for page, want in cases.items():
        assert H.main_text(page, frozenset()) == want.replace("|", "\n\n"), page


def test_class_words_alone_do_not_remove_the_article():
    art = "<h1>T</h1><p>A long story.</p><div class=share-box>no</div>"
    cases = {
        f"<div class='content has-sidebar'><article>{art}</article><div class=sidebar>no</div></div>": "T|A long story.",
        f"<main class=no-sidebar>{art}</main><div class=comments>{'no ' * 40}</div>": "T|A long story.",
        f"<article class='post comments-open'>{art}</article><article class=comment>{'no ' * 40}</article>": "T|A long story.",
        f"<div class='page nav-fixed'><div class=story>{art}</div></div><div class=related>no</div>": "T|A long story.",
        f"<article>{art}</article><div class=related><article>no</article></div>": "T|A long story.",
        f"<div class=has-sidebar><nav>{'no ' * 40}</nav><div hidden>no</div>{art}</div>": "T|A long story.",
    }
    for page, want in cases.items():
        assert H.main_text(page, frozenset()) == want.replace("|", "\n\n"), page
    page = f"<div class='content has-sidebar'><p>x</div><p>{art}"
    path = next(p for t, p, *_ in H.parse(page)[0] if t == "A long story.")
    assert "A long story." not in H.main_text(page, frozenset([path]))  # the tree still decides


def test_deep_and_long_pages_take_linear_time():
    assert H.main_text("<div>" * 20_000 + "x", frozenset()) == "x"
    assert len(H.main_text("<p>word " * 50_000, frozenset()).split("\n\n")) == 50_000


def wanted(page):
    art = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", p)).split()) for p in re.split(r"<p>|</p>|</h1>", art))
    return "\n\n".join(p for p in parts if p)


def test_whole_table(spark):
    got = {r.page_id: (r.text, r.n_chars) for r in QUERIES["op3_html_extraction"](spark, SF01).collect()}
    rows = pq.read_table(f"{SF01}/pages.parquet").to_pylist()
    assert got == {r["page_id"]: (wanted(r["html"]), len(wanted(r["html"]))) for r in rows}


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'t' AS text", "'h' AS host", "1 AS cut", "2 AS id")


def test_style_tree_cuts_what_a_site_repeats(spark):
    """No tag or class says what is what: only the host's pages together do."""
    page = "<body><div class=xa>Shop Cart Help</div><div class=xb><p>Story {0} tells of {0}.</p><p>More of {0}.</p></div><div class=xc>All rights</div>"
    rows = [(i, "http://a.net/p", page.format(i)) for i in range(20)] + [(99, "http://b.net/", page.format("b"))]
    got = {r.page_id: r.text for r in H.extract(pages(spark, rows)).collect()}
    assert all(got[i] == f"Story {i} tells of {i}.\n\nMore of {i}." for i in range(20))
    assert got[99].startswith("Shop Cart Help")  # a single page shows no repetition
    tree = {(r.host, r.m): r for r in H.style_tree(pages(spark, rows)).filter("share < 0.4 and host = 'a.net'").collect()}
    assert min(r.importance for r in tree.values()) < 0.01


def test_copies_of_pages_keep_their_text(spark):
    page = "<nav>menu</nav><article><h1>T</h1><p>Same words.</p></article><footer>f</footer>"
    got = H.extract(pages(spark, [(i, "http://a.net/", page) for i in range(30)])).collect()
    assert {r.text for r in got} == {"T\n\nSame words."} and len(got) == 30


def test_odd_rows(spark, monkeypatch):
    rows = [(1, None, None), (1, None, None), (2, "no host", ""), (None, "http://a.net", "<p>x"), (3, "http://a.net", "<p>y" * 3000)]
    for bound in (H.MAX_BROADCAST_CUTS, -1):
        monkeypatch.setattr(H, "MAX_BROADCAST_CUTS", bound)
        got = sorted(((r.page_id, r.url, r.text) for r in H.extract(pages(spark, rows)).collect()), key=str)
        assert got == sorted([(1, None, ""), (1, None, ""), (2, "no host", ""), (None, "http://a.net", "x"),
                              (3, "http://a.net", "\n\n".join("y" * 3000))], key=str)
    assert H.extract(pages(spark, [])).count() == 0


def test_stray_quotes_lose_no_text():
    pages = {
        1: "<p class=it's>hello world</p><p>I don't stop</p><p>end</p>",
        2: '<p title=5">hello world</p><p>next para</p><p>a "quoted" end</p>',
        3: """<p title="a > b" class='x'>one</p><p a"b c'd>two</p><p = x="1"y='2'/>three</p><p title = "class=ad">four</p>""",
        4: '<p title="never closed>five</p><p>six',
        5: "<p " + "a'" * 50_000 + ">seven</p>" + "<p x=" + "y\"" * 50_000 + ">eight</p>",
    }
    want = {1: "hello world\n\nI don't stop\n\nend", 2: 'hello world\n\nnext para\n\na "quoted" end', 3: "one\n\ntwo\n\nthree\n\nfour",
            4: "five\n\nsix", 5: "seven\n\neight"}
    for i, page in pages.items():
        assert H.main_text(page, frozenset()) == want[i], i
