"""Operator 11: texts of known pages, the votes against a plain version, long and broken pages."""

import html as entities
import random
import re
import time
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF001
from convaudit.llm import html_text
from convaudit.llm.queries import QUERIES

LONG = [f"Paragraph {i} of the story goes on for a while, with words & more words." for i in range(6)]
BODY = "".join(f"<p>{entities.escape(p)}</p>" for p in LONG)
GOLD = "\n".join(["A title", *LONG])
JUNK = {
    "menu": "<nav><ul><li><a href='/a'>Home</a><li><a href='/b'>News of the day</a></ul></nav><div class='main-menu'>Start Here</div><ul role=navigation><li>More</ul>",
    "header": "<header class='site-header'><h2>The Site</h2><p>A long claim about the site, longer than it has to be.</p></header>",
    "footer": "<footer>&copy; 2024 Site, all rights reserved, read the terms of it.</footer><div id='page-footer'>Imprint</div>",
    "sidebar": "<aside><p>About the author, who writes a lot about all the things of this world.</p></aside><div class='sideBar widget-area'>Popular posts</div>",
    "notice": "<div class='cookie-notice'><p>We use cookies, and we would like to use some more of them on you.</p></div><p role='alert'>Careful</p>",
    "advert": "<div class='ad'>Buy now!</div><ins class='adsbygoogle'>Ad</ins><p>x</p>".replace("<p>x</p>", "") + "<div class='sponsored-box'><p>Pills at half the price.</p></div>",
    "form": "<form action='/s'><label>Search</label><input name=q><select><option>One</select><button>Go</button></form>",
    "script": "<script>if (a < b) document.write('<p>no</p>')</script><style>p{}</style><noscript>Turn it on</noscript><!-- hidden <p>no</p> -->",
    "comments": "<section class='comments'><h3>2 comments</h3><article class=comment><p>I agree with all of it, and have more to say about it than the author.</p></article></section>",
}
EVERY = "".join(JUNK.values())
PAGES = {
    "semantic": f"<html><body>{EVERY}<article><header><h1>A title</h1></header>{BODY}</article>{EVERY}</body></html>",
    "junk inside": f"<body><main><h1>A title</h1>{BODY[:len(BODY) // 2]}{BODY[len(BODY) // 2:]}{EVERY}</main></body>",
    "divs": f"<body><div class='wrap'>{JUNK['menu']}<div class='post-content'><h1>A title</h1>{BODY}{JUNK['comments']}</div>{JUNK['sidebar']}</div></body>",
    "unclosed": f"<body><nav><ul><li>x</ul></nav><article><h1>A title</h1>{BODY.replace('</p>', '')}<footer>Site",
    "unclosed advert": f"<body><div class='ad'>Buy<article><h1>A title{BODY}</article>",
    "whole page in a form": f"<body><form id=aspnet><div class=content><h1>A title</h1>{BODY}</div></form></body>",
    "upper case": f"<BODY><NAV>x</NAV><ARTICLE><H1>A  title</H1>{BODY.replace('<p>', '<P CLASS=intro>').replace('</p>', '</P >')}</ARTICLE></BODY>",
    "inline": f"<body><article><h1>A <b>ti</b>tle</h1>{BODY.replace('story', '<a href=x>sto</a><i>ry<!-- c --></i>')}</article><aside>x</aside>",
    "attributes": f"<body><article data-x='<p>no</p>' title=don't class=\"post-12 has-sidebar\"><h1>A title</h1>{BODY}</article>",
    "references": f"<body><article><h1>A&#32;t&#x69;tle</h1>{BODY}</article>",
    "heading apart": f"<body>{JUNK['header']}<div class=row><h1>A title</h1><div class='txt'>{BODY}</div><div class=x>Short note</div></div>",
    "sections": f"<body><div id=page><h1>A title</h1><div class=s1>{BODY[:len(BODY) // 2]}</div><div class=s2>{BODY[len(BODY) // 2:]}</div></div>{JUNK['sidebar']}",
    "article in main": f"<body><main><article><div><h1>A title</h1></div><div>{BODY}</div></article><p>Read the next one too</p></main>",
    "wrapped": f"<body class='single no-comments'><div id='content-sidebar-wrap'><div class='entry'><div class='entry-header'><h1>A title</h1></div>{BODY}</div></div>",
}


@pytest.mark.parametrize("name", PAGES)
def test_known_pages(name):
    assert html_text.extract(PAGES[name], []) == GOLD


def test_blocks_and_white_space():
    def text(s):
        return html_text.extract(f"<body><article>{s}</article>", [])
    assert text("one<br>two&nbsp; three\n\tfour") == "one two three four"
    assert text("<ul><li>a<li>b</ul><dl><dt>c<dd>d</dl><pre>e  f\ng</pre>") == "a\nb\nc\nd\ne f g"
    assert text("<table><tr><td>a<td>b<tr><td>c</table>") == "a b\nc"
    assert text("a &lt;b&gt; &am &amp &eacute; &#233; 1 < 2 <3") == "a <b> &am & é é 1 < 2 <3"
    assert text("x<p>y</p>z") == "x\ny\nz"
    assert text("keep <a href=x>every link</a>") == "keep every link"
    assert text("") == "" and html_text.extract("", []) == "" and html_text.extract("bare text", []) == "bare text"
    assert html_text.extract("<nav>only a menu</nav>", []) == ""


def test_consensus_corrects_a_page_whose_comments_are_longer(spark):
    def page(i, words, remarks):
        return f"<body><div class='c{i}'><div class='txt'><p>Text {i} {'word ' * words}</p></div><div class='talk'><p>Said {i} {'blah ' * remarks}</p></div></div>"

    rows = [(i, "http://h.example/x", page("", 40 + i, 2)) for i in range(9)] + [(9, "https://u@H.example:80/y?q", page("", 4, 60))]
    rows += [(20, "http://other.example/", page("", 4, 60)), (21, None, page("", 40, 5)), (22, "odd", ""), (23, "http://h.example/z", "<body><div class='solo'>Solo text</div>")]
    docs = spark.createDataFrame([(*r, "x", 0) for r in rows], "page_id long, url string, html string, host string, n long").repartition(3)
    assert {r.host: r.winners for r in html_text.winning_paths(docs).collect()}["h.example"] == ["body/div.c/div.txt"]
    for bound in (1 << 26, 0):
        got = {r.page_id: r.text for r in html_text.extract_pages(docs, broadcast_bytes=bound).collect()}
        assert got[9].startswith("Text") and "Said" not in got[9]
        assert got[20].startswith("Said") and got[22] == "" and got[23] == "Solo text"
        assert all(got[i] == " ".join(re.search("<p>(Text.*?)</p>", page("", 40 + i, 2))[1].split()) for i in range(9))


def plain(rows):
    """Votes and choices of all pages by loops."""
    votes, totals = defaultdict(Counter), Counter()
    scores = defaultdict(float)
    for _, url, html in rows:
        host = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", (url or "").lower())
        host = host[1] if host else ""
        v = html_text.vote(html or "")
        if v:
            votes[host][v[0]] += 1
            scores[host, v[0]] += v[1]
            totals[host] += 1
    out = []
    for i, url, html in rows:
        host = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", (url or "").lower())
        host = host[1] if host else ""
        won = sorted((p for p, n in votes[host].items() if n >= html_text.SHARE * totals[host]), key=lambda p: (-votes[host][p], -scores[host, p], p))
        out.append((i, url, html_text.extract(html or "", won)))
    return out


def test_query_equals_the_plain_version_and_the_articles(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF001}/pages.parquet", columns=["page_id", "url", "html"]).to_pylist()]
    out = QUERIES["op11_html_text"](spark, SF001)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and dict(out.dtypes)["n_chars"] == "bigint"
    got = sorted(map(tuple, out.collect()))
    assert got == sorted((i, u, t, len(t)) for i, u, t in plain(rows))
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString().replace("BroadcastExchange", "")
    by_id = {r[0]: r[2] for r in got}
    for i, _, h in rows:  # what stands between the article's tags, split at its blocks
        blocks = re.split("</?(?:p|h1)>", re.search("<article>(.*?)</article>", h, re.S)[1])
        words = (" ".join(entities.unescape(re.sub("<[^>]+>", "", b.replace("<br>", " "))).split()) for b in blocks)
        assert by_id[i] == "\n".join(w for w in words if w)


def test_odd_rows(spark):
    rng = random.Random(2)
    parts = ["<div class='a'>", "</div>", "<p>", "some words of text ", "<article>", "</article>", "<a href=x>", "</a>", "<nav>", "</nav>", "<b>", "&am", "<", "<!--", "-->", "\x00", "é😀"]
    rows = [(i, rng.choice(["http://a.b/c", "http://d.e", None, ""]), "".join(rng.choice(parts) for _ in range(rng.randrange(40)))) for i in range(120)]
    rows += [(None, None, None), (1, "http://a.b", ""), (1, "http://a.b", ""), (3, "http://a.b/", PAGES["divs"]), (3, "http://a.b/", PAGES["divs"])]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r.page_id, r.url, r.text) for r in html_text.extract_pages(docs).collect()), key=str)
    assert got == sorted(plain(rows), key=str)
    assert html_text.extract_pages(docs.where("false")).count() == 0
    assert [r.text for r in html_text.extract_pages(docs.where("page_id is null")).collect()] == [""]


@pytest.mark.parametrize("unit", ["<div>", "<p>", "<b>", "<a href='", "</b>", "<li>", "</div>", "<!--", "<div class=ad>", "<script>", "&amp", "< ", "<a b=\"", "<i><p></b>", "<td>", "<ul><li>",
                                  "<span class=ad>", "<form><b>", "<a><div>", "<table><tr>", "<x y='' ", "<article>x"])
def test_long_pages_take_linear_time(unit):
    page = "<div><b><p>hello</p>" + unit * (500_000 // len(unit))
    start = time.time()
    assert html_text.extract(page, ["body/div"]).startswith("hello")
    assert time.time() - start < 6


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("<>/=\"'! -abdivp&;\n")), max_size=60))
def test_any_input_is_read(s):
    html_text.extract(s, ["body"])
    html_text.extract("<article>" + s, [])
