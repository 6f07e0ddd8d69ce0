"""Main text of web pages by site style trees.

The DOMs of a host's pages are merged: elements with the same path of tags and
classes are one node of the host's style tree. A node knows on how many pages
it occurs (m), the variants of its children's sequence (presentation) and the
texts below it (content). With k pages sharing a variant or text, importance is
``1 - sum(k ln k) / (sum(k) ln m)``: 0 if all pages show the same, 1 if each
page shows its own or there is one page only. A node's composite importance
weighs content with presentation and with a prior for elements whose tag, role
or class says what they are (menus, footers, adverts, ... weigh nothing). A
branch whose importance is small against the best branch of its host is cut
from every page; what is left are the page's blocks. Class words alone never
remove main, an article (unless all its classes say so, as a comment's do) or
the branch with most of a page's article, or of its text if it has none: there
the host's statistics decide.

Trees are aggregated node by node with map-side combining, so a host with a
third of all pages is no single task; pages meet only the list of branches
that their host cuts.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import size_of, stage, text_or_empty
from .url_filter import url_host

#: Weight of presentation in composite importance, and the share of the best
#: branch's importance below which a branch is cut, outside and inside of
#: elements that are said to be the article.
PRESENTATION, CUT, CUT_INSIDE = 0.1, 0.93, 0.5
#: Pages that must show a branch before statistics alone can cut it.
PAGES = 3
#: Cut branches (about 60 bytes each) that may be broadcast.
MAX_BROADCAST_CUTS = 100_000

# Elements of HTML by how they shape text.
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt
ruby s samp small span strike strong sub sup time tt u var wbr""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEAD = frozenset("base link meta noscript script style template title".split())
CLOSES_P = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul""".split())
ENDS = {  # a start tag ends an open sibling of these, up to the container
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"thead", "tbody", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
}
# Tags, roles and class words of elements that are no main text.
NOISE_TAGS = frozenset("""nav footer aside form script style noscript template button select textarea iframe object
svg canvas audio video dialog menu head title datalist input search""".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
NOISE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion
nav navbar navigation menu breadcrumb breadcrumbs sidebar footer cookie cookies consent gdpr notice popup modal
newsletter subscribe signup comment comments disqus respond reply replies related recommended share sharing social
widget login banner masthead toolbar pagination skip""".split())
#: A page's own heading may stand in a header inside the article.
HEADER = "header"
PROTECTED = frozenset(["article", "main"])

# An attribute's value is quoted only if the quote stands right after the
# equals sign; other values run to white space or the tag's end, and a quote
# anywhere else is a character like any other.
_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)"
                    rf"((?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE})?+)*+)>?", re.S)
_ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+({_VALUE}))?+")
_WORD = re.compile("[A-Z]?[a-z]+|[A-Z]+")


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


class Element:
    __slots__ = ("tag", "path", "parent", "noise", "worded", "inside", "body", "chars", "children")

    def __init__(self, tag: str, key: str, parent: Element | None, noise: bool, worded: bool):
        self.tag, self.parent = tag, parent
        self.path = _hash(f"{parent.path if parent else ''}/{key}")
        self.noise = noise or bool(parent and parent.noise)
        #: the innermost branch, up to here, that class words call noise
        self.worded: Element | None = self if worded else parent.worded if parent else None
        self.inside = tag in PROTECTED or bool(parent and parent.inside)
        self.body = tag in PROTECTED and not worded or bool(parent and parent.body)
        self.chars = 0
        self.children: list[str] = []

    def up(self) -> tuple[int, ...]:
        """Paths of all ancestors."""
        out, e = [], self.parent
        while e:
            out.append(e.path)
            e = e.parent
        return tuple(out)

    def word_branches(self):
        """Branches around this element that class words call noise."""
        e = self.worded
        while e:
            yield e
            e = e.parent.worded


def _worded(words: list[str], inside: bool) -> bool:
    return not NOISE_WORDS.isdisjoint(words) or HEADER in words and not inside


def describe(tag: str, attributes: str, inside: bool) -> tuple[str, bool, bool]:
    """(tag and class words without digits, whether its tag or role is noise,
    whether its class words are)."""
    noise = tag in NOISE_TAGS or tag == HEADER and not inside
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return tag, noise, False
    names: list[list[str]] = []
    for name, value in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name not in ("class", "id", "role", "hidden"):
            continue
        if value[:1] in ("'", '"') and len(value) > 1 and value[-1] == value[0]:
            value = value[1:-1]
        if name == "role":
            noise = noise or value.strip().lower() in NOISE_ROLES
        elif name == "hidden":
            noise = True
        else:
            names += [[w.lower() for w in _WORD.findall(v)] for v in html.unescape(value).split()]
    words = [w for v in names for w in v]
    if tag in ("html", "body", "main"):
        worded = False
    elif tag == "article":
        worded = bool(words) and all(_worded(v, inside) for v in names if v)
    else:
        worded = _worded(words, inside)
    return ".".join([tag, *sorted(set(words))]), noise, worded


def parse(page: str):
    """(blocks, styles): blocks as (text, path, ancestors, noise, inside the
    article) in page order; styles as {(path, variant of its children)}. Tags may be left open
    or closed out of order, as browsers take them."""
    root = Element("#", "#", None, False, False)
    stack, text, is_open = [root], [], Counter()
    blocks: list[tuple[str, Element]] = []
    styles: set[tuple[int, int]] = set()

    def flush():
        if text:
            joined = " ".join("".join(text).split())
            text.clear()
            if joined:
                blocks.append((joined, stack[-1]))

    def close(n: int):
        flush()
        while len(stack) > n:
            e = stack.pop()
            is_open[e.tag] -= 1
            styles.add((e.path, _hash(" ".join(k for k, _ in groupby(e.children)))))

    def start(tag: str, key: str, noise: bool, worded: bool):
        stack.append(Element(tag, key, stack[-1], noise, worded))
        is_open[tag] += 1

    def open_at(tags, barrier) -> int | None:
        """Place of the innermost open one of ``tags`` above the barrier."""
        if not any(is_open[t] for t in tags):
            return None
        for n in range(len(stack) - 1, 0, -1):
            if stack[n].tag in tags:
                return n
            if stack[n].tag in barrier:
                return None
        return None

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            text.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            text.append(html.unescape(page[at:m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if stack[-1].tag == tag:
                close(len(stack) - 1)
            elif tag not in VOID and (n := open_at({tag}, ())) is not None:
                close(n)
            continue
        if stack[-1].tag == "head" and tag not in HEAD:
            close(len(stack) - 1)
        if tag in INLINE:
            if m[3]:
                key, noise, worded = describe(tag, m[3], stack[-1].inside)
                if (noise or worded) and tag not in VOID:  # an inline advert, say, is a branch of its own
                    flush()
                    stack[-1].children.append(key)
                    start(tag, key, noise, worded)
                    continue
            if tag == "br":
                text.append(" ")
            continue
        flush()
        if tag in CLOSES_P and (n := open_at({"p"}, {"table", "td", "th", "button", "object"})) is not None:
            close(n)
        if tag in ENDS and (n := open_at(*ENDS[tag])) is not None:
            while n > 1 and stack[n - 1].tag in ENDS[tag][0]:
                n -= 1
            close(n)
        if tag in ("html", "body") and is_open[tag]:
            continue
        key, noise, worded = describe(tag, m[3], stack[-1].inside)
        stack[-1].children.append(key)
        if tag in VOID:
            continue
        start(tag, key, noise, worded)
        if tag in RAW:
            end = re.compile(f"</{tag}", re.I).search(page, at)
            at = end.start() if end else size
        elif m[3].rstrip().endswith("/") and tag in ("svg", "path", "g", "use"):
            close(len(stack) - 1)
    close(0)
    live = [(len(joined), e) for joined, e in blocks if not e.noise]
    if any(e.body for _, e in live):
        live = [(n, e) for n, e in live if e.body]
    for n, e in live:
        for branch in e.word_branches():
            branch.chars += n
    half = sum(n for n, _ in live) / 2
    return [(joined, e.path, e.up(), e.noise or any(x.chars <= half for x in e.word_branches()), e.inside)
            for joined, e in blocks], styles


def main_text(page: str, cut: frozenset) -> str:
    """Blocks outside noise and cut branches, joined by an empty line."""
    kept = [text for text, path, up, noise, _ in parse(page)[0] if not noise and path not in cut and cut.isdisjoint(up)]
    return "\n\n".join(kept)


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, path, m, inside, share, importance): the merged tree of every
    host, with the share of the host's text below each node."""
    def run(batches):
        for b in batches:
            contents, styles = [], []
            for page in b.column("html"):
                blocks, variants = parse(page.as_py() or "")
                seen = {(path, _hash(text)): (len(text), up, inside) for text, path, up, _, inside in blocks}
                contents.append([{"path": p, "up": list(up), "text": t, "chars": n, "inside": inside}
                                 for (p, t), (n, up, inside) in seen.items()])
                styles.append([{"path": p, "variant": v} for p, v in variants] +
                              [{"path": p, "variant": None} for p in {p for p, _ in variants}])
            yield pa.RecordBatch.from_arrays([b.column("host"), pa.array(contents, pa.list_(pa.struct([
                ("path", pa.int64()), ("up", pa.list_(pa.int64())), ("text", pa.int64()), ("chars", pa.int64()),
                ("inside", pa.bool_())]))),
                pa.array(styles, pa.list_(pa.struct([("path", pa.int64()), ("variant", pa.int64())])))],
                names=["host", "contents", "styles"])

    src = pages.select(url_host(F.col(url_col).cast("string")).alias("host"), text_or_empty(html_col).alias("html"))
    seen = stage(pages.sparkSession, src.mapInArrow(run, (
        "host string, contents array<struct<path: long, up: array<long>, text: long, chars: long, inside: boolean>>, "
        "styles array<struct<path: long, variant: long>>")), "style-tree")
    klnk = F.sum(F.col("k") * F.log("k")).alias("klnk")
    # presentation: pages with each variant of a node; a null variant counts its pages
    variants = (seen.select("host", F.inline("styles")).groupBy("host", "path", "variant").agg(F.count("*").alias("k")))
    nodes = (variants.groupBy("host", "path").agg(
        F.max(F.when(F.col("variant").isNull(), F.col("k"))).alias("m"),
        F.sum(F.when(F.col("variant").isNotNull(), F.col("k") * F.log("k"))).alias("style_klnk"),
        F.sum(F.when(F.col("variant").isNotNull(), F.col("k"))).alias("style_k")))
    # content: pages with each text at a node, then summed up the branches
    texts = (seen.select("host", F.inline("contents")).groupBy("host", "path", "text")
             .agg(F.count("*").alias("k"), F.sum("chars").alias("chars"), F.first("up").alias("up"),
                  F.max("inside").alias("inside")))
    leaves = texts.groupBy("host", "path").agg(klnk, F.sum("k").alias("k"), F.sum("chars").alias("chars"),
                                              F.first("up").alias("up"), F.max("inside").alias("inside"))
    branches = (leaves.select("host", F.explode(F.concat("up", F.array("path"))).alias("path"), "klnk", "k", "chars", "inside")
                .groupBy("host", "path").agg(F.sum("klnk").alias("klnk"), F.sum("k").alias("k"), F.sum("chars").alias("chars"),
                                             F.max("inside").alias("inside")))

    def importance(klnk: str, k: str):
        return F.when((F.col("m") > 1) & (F.col(k) > 0), 1 - F.col(klnk) / (F.col(k) * F.log("m"))).otherwise(F.lit(1.0))

    whole = leaves.groupBy("host").agg(F.sum("chars").alias("all_chars"))
    return (branches.join(nodes, ["host", "path"]).join(whole, "host").select(
        "host", "path", "m", "inside", (F.col("chars") / F.col("all_chars")).alias("share"),
        ((1 - PRESENTATION) * importance("klnk", "k") + PRESENTATION * importance("style_klnk", "style_k")).alias("importance")))


def cut_branches(tree: DataFrame, least: int = PAGES) -> DataFrame:
    """(host, cut): the branches of little importance, beside the host's best
    branch among those with a tenth of its text. A branch with half of the
    text is never cut; one that holds or is in the article only far below."""
    best = tree.filter("share >= 0.1").groupBy("host").agg(F.max("importance").alias("best"))
    below = F.col("importance") < F.when(F.col("inside"), CUT_INSIDE).otherwise(CUT) * F.col("best")
    low = tree.join(best, "host").filter(below & (F.col("share") < 0.5) & (F.col("m") >= least))
    return low.groupBy("host").agg(F.collect_set("path").alias("cut"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id, url, text) for every row; an empty text where nothing is left.

    A null html counts as empty, a null url or one without ``://`` belongs to
    the host with an empty name. Rows that repeat are pages like any other.
    Other columns are not looked at.
    """
    cuts = stage(pages.sparkSession, cut_branches(style_tree(pages, url_col, html_col)), "cut-branches")
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                       url_host(F.col(url_col).cast("string")).alias("host"), text_or_empty(html_col).alias("html"))
    # few long rows or many: the bound is on the branches, not the hosts
    small = size_of(cuts.select(F.explode("cut")), MAX_BROADCAST_CUTS)
    src = src.join(F.broadcast(cuts) if small else cuts, "host", "left")
    kind = src.schema["id"].dataType.simpleString()

    def run(batches):
        known: dict[tuple, frozenset] = {}
        for b in batches:
            texts = []
            for page, cut in zip(b.column("html"), b.column("cut").to_pylist()):
                key = tuple(cut or ())
                if key not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[key] = frozenset(key)
                texts.append(main_text(page.as_py() or "", known[key]))
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(texts, pa.string())],
                                             names=["id", "url", "text"])

    return src.select("id", "url", "html", "cut").mapInArrow(run, f"id {kind}, url string, text string") \
        .withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)
