"""HTML extraction (operator 11): consensus host paths.

Three steps. Each page is parsed once and its containers are scored; the path of its
best ones (tags and classes from the body down, digits left out) is the page's vote.
Spark counts the votes per host: paths with a fifth of a host's votes or more win. Every page
is then extracted anew: its own best path stands if it is among the winners, else the
winner with most votes that the page has, else (none there) its own.

Containers are scored by the text in them outside boilerplate, less the text of links. What lies in an inner
container counts four fifths, so an outer one wins only with a fourth more; in an ``article``, or
else a ``main`` or a container named as content, all of it counts. A heading of the first level that stands before
the chosen containers, outside boilerplate, belongs to the text. Boilerplate is known by its tag, role or names
(menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles,
reader comments) and never part of a text. Blocks are joined in page order by line breaks; white space
within a block becomes one space; character references are decoded; nothing else is dropped.

The parser reads a page in one pass, linear in its length whatever is left unclosed: an open
paragraph, item or cell ends where the next begins, an end tag ends what is open within its
element, a page that breaks off ends everything.

For scale: votes are counted before they are shuffled. Winners are at most five paths a host; while their bytes are
within ``broadcast_bytes`` (measured) they go to the pages, which then aren't shuffled; beyond that pages and
winners are joined by host and adaptive execution splits a hot host.

Null and empty pages, and pages without text, give an empty text. Pages without a host (null or odd
urls) vote together. Repeated rows each vote and each come back. Ties between paths go to more score,
then to the smaller path. Long pages are read whole. Other columns aren't read; an empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from convaudit.llm.common import drop_stored, map_slices, stored
from convaudit.operators.util import BROADCAST_BYTES, is_bounded, maybe_broadcast

# ---------------------------------------------------------------------------
# HTML's element kinds, and names that sites give to boilerplate.
# ---------------------------------------------------------------------------
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe noembed noframes xmp".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
            "header hgroup html legend li main menu nav ol p pre search section summary table tbody tfoot thead tr ul caption".split())
#: Ended by the next of their kind, unless one of the elements after them has been opened since.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
            "p": ({"p"}, BLOCK - {"p"})}
CONTAINERS = set("body main article section div center blockquote table td".split())
BOILERPLATE_TAGS = set("nav aside footer menu dialog search svg object video audio canvas select button template".split())
BOILERPLATE_ROLES = set("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
COMMENT_NAMES = set("comment comments commentlist thread feedback responses comentarios kommentare commentaires disqus respond replies reply discussion".split())
NAMES = set("ad ads adv advert adverts advertisement advertisements advertising adsense adsbygoogle adslot banner banners sponsor sponsors sponsored promo promos promotion "
            "nav navbar navigation menu menus menubar submenu topbar toolbar breadcrumb breadcrumbs pagination pager skiplink skip "
            "sidebar sidebars aside widget widgets rail related recommended recommendations "
            "header masthead footer colophon cookie cookies consent gdpr notice notices alert alerts notification notifications popup modal overlay "
            "newsletter subscribe subscription signup login share sharing sharebar social paywall disclaimer".split())
#: Names of an article's own head, which isn't boilerplate.
HEAD_OF = set("article entry post story content title".split())
CONTENT_NAMES = set("article articlebody content main post entry story text body".split())
WRAPPERS = set("wrap wrapper container area layout inner grid".split())
# ---------------------------------------------------------------------------

FORM, SOFT, HARD, COMMENTS = 1, 2, 4, 8
#: How far down the open elements an implied end is looked for.
REACH = 64
#: What the text of an inner container counts in the one around it.
INNER = 0.8
#: A path wins with this share of its host's votes.
SHARE = 0.2

START = re.compile(r"""<([a-zA-Z][^\s/>]*+)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|(?!["'])[^\s>]*+))?+)*+)>""")
END = re.compile(r"</([a-zA-Z][^\s/>]*+)[^>]*+>")
ATTRIBUTE = re.compile(r"""([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|((?!["'])[^\s>]*+)))?+""")
COMMENT_END = re.compile("--!?>")
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+>", re.I) for t in RAW}
NAMED = re.compile(r"\b(?:class|id|role)\b", re.I)
WORD_BORDER = re.compile(r"[^a-z]+")


def names_kind(attributes: str) -> tuple[int, bool, str]:
    """Boilerplate bits, whether named as content, and the generalised classes."""
    found = {}
    for m in ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), unescape(m[2] or m[3] or m[4] or ""))
    classes = found.get("class", "").split()
    bits = HARD if found.get("role", "").strip().lower() in BOILERPLATE_ROLES else 0
    content = found.get("role", "").strip().lower() == "main"
    for token in [*classes, found.get("id", "")]:
        parts = [p for p in WORD_BORDER.split(re.sub(r"(?<=[a-z])(?=[A-Z])", "-", token).lower()) if p]
        if not parts or parts[0] in ("has", "with", "no", "without", "is", "not"):
            continue
        words = {*parts, "".join(parts)}
        content = content or not words.isdisjoint(CONTENT_NAMES)
        if not words.isdisjoint(COMMENT_NAMES):
            bits |= COMMENTS
        wrapper = parts[-1] in WRAPPERS and not CONTENT_NAMES.isdisjoint(parts[:1])
        named = words & NAMES
        if named and not wrapper and not (named == {"header"} and not words.isdisjoint(HEAD_OF)):
            bits |= SOFT
    return bits, content, "".join(sorted({"." + c.lower() for c in classes if not any(d.isdigit() for d in c)}))


class Page:
    """Containers and text blocks of one page."""

    def __init__(self, html: str):
        self.paths: dict[tuple[int, str], int] = {}  # (parent path, step) -> path
        self.parent: list[int] = []  # of each path
        self.rank: list[int] = []  # of each path: 2 an article, 1 named as content, 0 others
        self.node_path, self.node_up = [-1], [-1]  # containers; 0 stands for the page
        self.blocks: list[tuple[int, str, int, int, bool]] = []  # container, text, characters in links, boilerplate bits, in a heading
        self.parse(html)

    def path_of(self, up: int, step: str, rank: int) -> int:
        k = self.paths.setdefault((up, step), len(self.paths))
        if k == len(self.parent):
            self.parent.append(up)
            self.rank.append(rank)
        return k

    def parse(self, html: str) -> None:
        tags: list[str] = []  # open elements
        nodes, bits = [0], [0]  # the container and boilerplate bits within each, after those of the page
        count: dict[str, int] = {}
        text: list[str] = []
        state = {"in_link": 0, "linked": 0}
        inline: list = []  # an open inline element that is boilerplate: name, how many of it are open
        at, n = 0, len(html)

        def flush() -> None:
            if text:
                words = " ".join("".join(text).split())
                if words:
                    self.blocks.append((nodes[-1], words, min(state["linked"], len(words)), bits[-1], bool(count.get("h1"))))
                text.clear()
            state["linked"] = 0

        def pop(to: int) -> None:
            while len(tags) > to:
                count[tags.pop()] -= 1
                nodes.pop()
                bits.pop()
            state["in_link"] = 0 if state["in_link"] > len(tags) + 1 else state["in_link"]
            inline.clear()

        def end_siblings(tag: str) -> None:
            own, stop = SIBLINGS[tag]
            if not any(count.get(t) for t in own):
                return
            for k in range(len(tags) - 1, max(-1, len(tags) - 1 - REACH), -1):
                if tags[k] in own:
                    pop(k)
                    return
                if tags[k] in stop:
                    return

        def say(s: str) -> None:
            if inline:
                return
            s = unescape(s) if "&" in s else s
            text.append(s)
            if state["in_link"]:
                state["linked"] += len(" ".join(s.split()))

        def start(tag: str, attributes: str) -> None:
            block = tag in BLOCK
            own, content, classes = names_kind(attributes) if attributes and NAMED.search(attributes) else (0, False, "")
            if tag in ("html", "body"):
                own = 0
            if not block and tag not in CONTAINERS and tag not in BOILERPLATE_TAGS:
                if tag == "a":
                    state["in_link"] = len(tags) + 1
                elif tag in ("br", "td", "th"):
                    text.append(" ")
                if inline:
                    inline[1] += tag == inline[0]
                elif own & (SOFT | COMMENTS) and tag not in VOID and tag != "th":
                    inline[:] = [tag, 1]
                return
            if block:
                flush()
                end_siblings("p")
                if tag in SIBLINGS and tag != "p":
                    end_siblings(tag)
            elif tag == "td":
                text.append(" ")
            if tag in BOILERPLATE_TAGS:
                own |= HARD
            if tag == "header" and not count.get("article"):
                own |= HARD
            own |= FORM if tag == "form" else 0
            above = bits[-1]
            if tag == "main" and not own:
                above = 0
            elif tag == "article" and not own and not above & COMMENTS and not any(count.get(t) for t in ("aside", "footer")):
                above = 0
            tags.append(tag)
            count[tag] = count.get(tag, 0) + 1
            bits.append(above | own)
            if tag in CONTAINERS:
                up = nodes[-1]
                rank = 2 if tag == "article" else int(content or tag == "main")
                self.node_path.append(self.path_of(self.node_path[up], tag + classes, rank))
                self.node_up.append(up)
                nodes.append(len(self.node_path) - 1)
            else:
                nodes.append(nodes[-1])

        def end(tag: str) -> None:
            block = tag in BLOCK
            if block:
                flush()
            if tag == "a":
                state["in_link"] = 0
            if inline and tag == inline[0]:
                inline[1] -= 1
                if not inline[1]:
                    inline.clear()
            if not count.get(tag):
                return
            k, least = len(tags) - 1, -1 if block and tag != "p" else len(tags) - 1 - REACH
            while k > least and tags[k] != tag:
                k -= 1
            if k >= 0 and tags[k] == tag:
                if not block:  # what boilerplate such as a button said is a block of its own
                    flush()
                pop(k)

        while at < n:
            k = html.find("<", at)
            if k < 0:
                say(html[at:])
                break
            if k > at:
                say(html[at:k])
            c = html[k + 1:k + 2]
            if c == "!" and html.startswith("<!--", k):
                m = COMMENT_END.search(html, k + 2)  # <!--> and <!---> are whole
                at = m.end() if m else n
            elif c in ("!", "?"):
                at = html.find(">", k) + 1 or n
            elif c == "/":
                m = END.match(html, k)
                if m:
                    end(m[1].lower())
                    at = m.end()
                else:
                    at = html.find(">", k) + 1 or n
            elif c.isascii() and c.isalpha():
                m = START.match(html, k)
                if not m:
                    break  # cut off within a tag
                tag, at = m[1].lower(), m.end()
                if tag in RAW:
                    m = RAW_END[tag].search(html, at)
                    at = m.end() if m else n
                elif tag in BOILERPLATE_TAGS and tag not in BLOCK:
                    flush()
                    start(tag, m[2])
                else:
                    start(tag, m[2])
            else:
                say("<")
                at = k + 1
        flush()

    def scores(self, allowed: int) -> tuple[list[float], list[int]]:
        """Score and characters of each path; blocks with bits outside ``allowed`` don't count."""
        n = len(self.node_path)
        good, held, top, chars = [0.0] * n, [0] * n, [0] * n, [0] * n
        for node, words, linked, bits, _ in self.blocks:
            if not bits & ~allowed:
                good[node] += len(words) - 2 * linked
                chars[node] += len(words)
        held = good.copy()  # without what depth takes off
        score, size = [0.0] * len(self.parent), [0] * len(self.parent)
        for k in range(n - 1, 0, -1):
            path, up = self.node_path[k], self.node_up[k]
            rank = self.rank[path]
            if rank > top[k]:
                good[k], top[k] = held[k], rank
            score[path] += good[k]
            size[path] += chars[k]
            good[up] += INNER * good[k]
            held[up] += held[k]
            chars[up] += chars[k]
            top[up] = max(top[up], top[k])
        return score, size

    def best(self) -> tuple[int, float, int] | None:
        """The best path, its score and the bits allowed; text within a form is looked at only if there is no other."""
        for allowed in (0, FORM):
            score, chars = self.scores(allowed)
            having = [k for k, c in enumerate(chars) if c]
            if having:
                k = max(having, key=lambda k: (score[k], k))  # of equal ones the inner
                return k, score[k], allowed
        return None

    def written(self, path: int) -> str:
        step = {k: s for (_, s), k in self.paths.items()}
        out = []
        while path >= 0:
            out.append(step[path])
            path = self.parent[path]
        return "/".join(reversed(out))

    def find(self, path: str) -> int:
        k = -1
        for step in path.split("/"):
            k = self.paths.get((k, step), -2)
            if k == -2:
                return -1
        return k

    def text(self, path: int, allowed: int) -> str:
        inside = [path < 0] + [False] * (len(self.node_path) - 1)
        for k in range(1, len(self.node_path)):
            inside[k] = self.node_path[k] == path or inside[self.node_up[k]]
        out, heading, headed = [], None, False
        for node, words, _, bits, h1 in self.blocks:
            if bits & ~allowed:
                continue
            if inside[node]:
                out.append(words)
                headed = headed or h1
            elif h1 and not out:
                heading = words
        return "\n".join(out if headed or heading is None else [heading, *out])


def vote(html: str) -> tuple[str, int] | None:
    page = Page(html)
    best = page.best()
    return None if best is None else (page.written(best[0]), round(best[1]))


def extract(html: str, winners: list[str]) -> str:
    page = Page(html)
    best = page.best()
    if best is None:  # text outside every container, if any
        return page.text(-1, 0)
    own, _, allowed = best
    chosen = own
    if winners and page.written(own) not in winners:
        chars = page.scores(allowed)[1]
        chosen = next((k for k in map(page.find, winners) if k >= 0 and chars[k]), own)
    return page.text(chosen, allowed)


def host_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def winning_paths(pages: DataFrame, url: str = "url", html: str = "html", share: float = SHARE) -> DataFrame:
    """``host`` and ``winners``: its paths with ``share`` of the votes or more, those with most votes first."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        votes = [(i, *v) for i, t in enumerate(batch.column(1).to_pylist()) if (v := vote(t or ""))]
        index, path, score = ([v[k] for v in votes] for k in range(3))
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(index, pa.int64())), pa.array(path, pa.string()), pa.array(score, pa.int64())],
                                          ["host", "path", "score"])

    votes = map_slices(pages.select(host_of(url).alias("host"), html), run, "host string, path string, score long")
    # rounded to whole numbers, so that their sums don't depend on the order
    counted = stored(votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("score")), "votes")
    enough = counted.groupBy("host").agg((F.sum("n") * F.lit(share)).alias("least"))
    order = F.struct((-F.col("n")).alias("n"), (-F.col("score")).alias("score"), "path")
    won = counted.join(enough, "host").where(F.col("n") >= F.col("least")).groupBy("host").agg(F.sort_array(F.collect_list(order)).alias("w"))
    winners = stored(won.select("host", F.transform("w", lambda x: x.path).alias("winners")), "winners")
    drop_stored(counted)
    return winners


def extract_pages(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``key``, ``url`` and ``text`` of every row."""
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(html).alias("html"))
    winners = winning_paths(rows)
    known = winners.select(F.col("host").alias("__host"), "winners")
    joined = rows.join(maybe_broadcast(known, is_bounded(known, broadcast_bytes)), host_of("url") == F.col("__host"), "left")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [extract(t or "", w or []) for t, w in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], [key, url, "text"])

    kind = rows.schema["key"].dataType.simpleString()
    return map_slices(joined.select("key", "url", "html", "winners"), run, f"`{key}` {kind}, `{url}` string, text string")
