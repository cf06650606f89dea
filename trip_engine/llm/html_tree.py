"""Operator 1: main text of web pages by site style trees.

First pass: every page is parsed into a tree of block elements. An element is
named by its tag, classes and id, and a node of the site's style tree is a
path of such names (a 63-bit hash of its parent's and its own name, so that deep pages
stay small), and the DOMs of all pages of a host merge into one tree. A
node collects its presentation (the sequence of its children's names) and its
content (hashes of text blocks). What is shuffled are counts per host, node and
feature, combined before the shuffle; a host with a third of all pages is just
a larger count.

Importance, with ``m`` pages holding a node: a feature spread evenly over the
pages has an entropy near 1 (base m), one of a single page 0. Content
importance is one minus the mean entropy of the node's content features,
presentation importance the entropy of its styles, and the composite of an
inner node joins its own presentation importance with the mean of its children
(damped by the number of its styles). A node that few pages have seen says
little, so the markup's own meaning enters as a prior: navigation, headers,
footers, forms, adverts, notices, comments and the like (by tag, role, class or
id) get importance 0 with all below them; plain paragraphs and headings of an
article keep 1, because copied articles repeat without being noise. A class or id
(and a form) is a guess, as wrappers of whole pages have such names, too: it does
not hold for a branch with more text than the page has outside of noise (counted
in its article or main elements, if it has some, which then are no noise). Such
branches are measured like others, and the style tree decides.

Second pass: each page is parsed again and the branches whose importance is
below the threshold are removed. A page with an article or main element yields
only text inside it. A page that would lose all its text gets back the
unremoved blocks without the entropy test, or else all but those in navigation,
asides, footers and the like.

Defined cases: null or empty html yields empty text; a null url is a host of
its own (empty name); broken markup is read as far as it goes, the rest of an
unclosed script is skipped; repeated rows come back each; an empty table gives an
empty result; other columns are ignored, whatever their names; features that
tie in their counts weigh the same; pages of any length and depth are read whole (noise names
nested in each other are decided one by one, quadratic in how deep they nest).
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trip_engine.llm.common import prepare_workers, materialize

THRESHOLD = 0.3            # branches below this importance go
DAMPING = 0.9
MIN_PAGES = 3              # of a host that hold a node, for its entropy to count

# The meaning of HTML names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb "
                   "rt rp s samp small span strike strong sub sup time tt u var wbr img".split())
RAW = frozenset("script style textarea title noscript iframe template svg math canvas object audio video "
                "noembed noframes xmp select".split())
PLAIN = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table caption thead tbody tfoot tr td th "
                  "figure figcaption hr br address center".split())
MAIN = frozenset("article main".split())
NOISE_TAGS = frozenset("head nav aside footer button dialog menu menuitem input fieldset legend map "
                       "frameset".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu "
                        "menubar toolbar note".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner banners breadcrumb breadcrumbs "
    "comment comments commentlist consent cookie cookies copyright disclaimer disqus footer gdpr hidden "
    "login masthead menu menus modal nav navbar navigation newsletter notice notices notification overlay "
    "pager pagination paywall popup promo promoted promotion recommended recommendations related "
    "replies reply respond search share sharing sidebar signup skip social sponsor sponsored sponsors "
    "subscribe subscription tags teaser toc toolbar topbar trending widget widgets".split())
# of these the names that hardly ever stand on a wrapper: what lies in them must outweigh the rest by far
BESIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot breadcrumb breadcrumbs comment comments "
    "commentlist consent cookie cookies disqus gdpr newsletter pager pagination promo promoted promotion recommended "
    "recommendations related replies reply respond sponsor sponsored sponsors teaser trending".split())
BESIDE_WEIGHT = 10
# an element of these names ends an open paragraph or an open one of the same kind
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
          "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tr", "td", "th")}
SCOPE = frozenset("ul ol table article main section div body nav aside footer header form blockquote dl td th".split())

_TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
                  r"""|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)""", re.DOTALL)
_ATTR = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z0-9])([A-Z])")
_DIGITS = re.compile(r"\d+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)|^//([^/?#:]*)")


def host_of(url: str | None) -> str:
    m = _HOST.match((url or "").strip())
    return (m[1] or m[2] or "").lower() if m else ""


def _attributes(text: str) -> dict[str, str]:
    if not text.strip(" /"):
        return {}
    return {k.lower(): html.unescape(v.strip("\"'")) if v else "" for k, v in reversed(_ATTR.findall(text))}


class Node:
    __slots__ = ("tag", "name", "path", "depth", "up", "hard", "soft", "beside", "main", "in_main", "noise", "inside", "open",
                 "lifted", "weight", "mains", "children", "low", "cut")

    def __init__(self, tag: str, name: str, up: Node | None, hard: bool = False, soft: bool = False,
                 beside: bool = False, main: bool = False):
        self.tag, self.name, self.up = tag, name, up
        self.path = 0 if up is None else xxhash.xxh64_intdigest(name.encode("utf-8", "replace"), up.path) >> 1
        self.depth = 0 if up is None else up.depth + 1
        self.hard = hard or up is not None and up.hard      # noise by what it is, or in such an element
        self.soft, self.beside = soft, beside               # noise by its own name
        self.main = main and not (self.hard or soft)
        self.in_main = self.main or up is not None and up.in_main
        self.noise = self.inside = self.open = self.lifted = False  # see _settle
        self.low = self.cut = False                         # see main_text
        self.weight = self.mains = 0
        self.children: list[str] = []


def _open(tag: str, attrs: dict[str, str], up: Node) -> Node:
    marks = f"{attrs.get('class', '')} {attrs.get('id', '')}".strip()
    name = tag
    if marks:
        name += "." + ".".join(sorted(_DIGITS.sub("0", marks).split()))
    words = set(_NAME_WORD.findall(_CAMEL.sub(r"\1 \2", marks).lower())) if marks else set()
    role = attrs.get("role", "").lower()
    hard = (tag in NOISE_TAGS or role in NOISE_ROLES or (tag == "header" and not up.in_main) or "hidden" in attrs
            or attrs.get("aria-hidden") == "true"
            or "display:none" in attrs.get("style", "").replace(" ", "").lower())
    soft = tag == "form" or bool(words & NOISE_WORDS) and tag not in ("html", "body", "main")
    main = tag in MAIN or role in ("main", "article") or attrs.get("itemprop", "") == "articleBody"
    return Node(tag, name, up, hard, soft, bool(words & BESIDE_WORDS), main)


def _mark(nodes: list[Node]) -> None:
    """Noise and insides of all elements (parents first), given the lifted names."""
    for n in nodes:
        up = n.up
        if up is None:
            continue
        n.open = (up.open or n.lifted) and (n.lifted or not n.beside)
        if n.hard or n.soft and not n.lifted:
            n.noise = True
        elif n.lifted:
            n.noise = n.mains > 0
        elif n.main and up.open:
            n.noise = False
        else:
            n.noise = up.noise
        if not n.noise:
            n.open = False
        n.inside = not n.noise and (n.main or up.inside)


def _settle(out: list[tuple[Node, str]], nodes: list[Node]) -> None:
    """Decide which names hold: outer ones first, each against the text that is left."""
    _mark(nodes)
    soft = [n for n in nodes if n.soft and not n.hard]
    if not soft:
        return
    for n, text in out:
        if not n.hard:
            n.weight += len(text)
    for n in reversed(nodes[1:]):
        if n.main:
            n.mains = n.weight
        n.up.weight += n.weight
        n.up.mains += n.mains
    clean = sum(len(t) for n, t in out if not n.noise)
    for n in soft:
        # (each lifted name doubles the clean text at least, so there are few)
        if not n.up.noise and (n.mains or n.weight) > clean * (BESIDE_WEIGHT if n.beside else 1):
            n.lifted = True
            _mark(nodes)
            clean = sum(len(t) for n, t in out if not n.noise)


def blocks(page: str) -> tuple[list[tuple[Node, str]], list[Node]]:
    """The text blocks of a page with their nodes, and all block elements."""
    root = Node("", "", None)
    stack, nodes, out, text = [root], [root], [], []
    held: Counter = Counter()  # open elements by tag
    pos, raw = 0, None

    def flush():
        if text:
            whole = "".join(text)
            text.clear()
            if "&" in whole:
                whole = html.unescape(whole)
            whole = " ".join(whole.split())
            if whole:
                out.append((stack[-1], whole))

    def close(names, scope):
        if not any(held[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                flush()
                held.subtract(n.tag for n in stack[i:])
                del stack[i:]
                return
            if stack[i].tag in scope:
                return

    while pos < len(page):
        m = _TAG.search(page, pos)
        if m is None:
            text.append(page[pos:])
            break
        if m.start() > pos:
            text.append(page[pos:m.start()])
        pos = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if tag == "br" or tag == "p" and not held["p"]:
                flush()
            elif tag not in INLINE:
                close((tag,), ())
            continue
        if tag in INLINE:
            continue
        if tag in RAW:
            raw = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, pos)
            if not (m[3] or m[6] or "").rstrip().endswith("/") or tag in ("script", "style", "title", "textarea"):
                pos = raw.end() if raw else len(page)
            flush()
            continue
        flush()
        if tag in VOID:
            continue
        if tag in CLOSES:
            close(CLOSES[tag], SCOPE - {"td", "th"} if tag in ("tr", "td", "th", "tbody", "tfoot") else SCOPE)
        if stack[-1].tag == "p" or any(n.tag == "p" for n in stack[-3:]):
            close(("p",), SCOPE)
        node = _open(tag, _attributes(m[3] or m[6] or ""), stack[-1])
        if not stack[-1].children or stack[-1].children[-1] != node.name:
            stack[-1].children.append(node.name)
        stack.append(node)
        nodes.append(node)
        held[tag] += 1
    flush()
    _settle(out, nodes)
    return out, nodes


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page: (host, path, parent's path, depth, kind, feature, count, count * log count),
    kind 0 the style of an element, 1 a text block, 2 the page itself."""
    for b in batches:
        got: Counter = Counter()
        logs: Counter = Counter()
        for url, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            host = host_of(url)
            out, nodes = blocks(page or "")
            own: Counter = Counter()
            place = {n.path: (n.up.path if n.up else 0, n.depth) for n in nodes}
            for n in nodes:
                if not n.noise:
                    own[n.path, 0, crc32("|".join(n.children).encode("utf-8", "replace"))] += 1
            for n, t in out:
                if not n.noise:
                    own[n.path, 1, _name_of(t)] += 1
            for path in {n.path for n in nodes if not n.noise}:
                own[path, 2, 0] = 1
            for (path, kind, feature), c in own.items():
                key = (host, path, *place[path], kind, feature)
                got[key] += c
                if c > 1:
                    logs[key] += c * math.log(c)
        keys = [*got]
        cols = list(zip(*keys)) if keys else [()] * 6
        types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, t) for c, t in zip(cols, types)), pa.array([got[k] for k in keys], pa.int64()),
             pa.array([float(logs[k]) for k in keys], pa.float64())],
            ["host", "path", "up", "depth", "kind", "feature", "n", "n_log_n"])


def _name_of(text: str) -> int:
    data = text.encode("utf-8", "replace")
    return crc32(data) << 31 | crc32(data, 0x9E3779B9) >> 1


def _importance(rows: pd.DataFrame) -> dict[int, float]:
    """Composite importance per path of one host's tree, from rows (path, up, depth, pages,
    content (mean entropy or NaN), presentation, n_styles)."""
    below: dict[int, list[float]] = {}
    found: dict[int, float] = {}
    for r in sorted(rows.itertuples(), key=lambda r: -r.depth):
        parts = below.get(r.path, [])
        if r.content == r.content:
            parts = [*parts, 1.0 - r.content]
        if not parts:
            found[r.path] = 1.0
        else:
            keep = DAMPING ** r.n_styles
            found[r.path] = (1 - keep) * r.presentation + keep * sum(parts) / len(parts)
            if r.pages < MIN_PAGES:
                found[r.path] = 1.0
        if r.depth:
            below.setdefault(r.up, []).append(found[r.path])
    return found


def style_trees(pages: DataFrame) -> DataFrame:
    """host and the paths of its style tree whose importance is below the threshold."""
    prepare_workers(pages.sparkSession)
    counts = pages.select("url", "html").mapInArrow(
        _features, "host string, path bigint, up bigint, depth int, kind int, feature bigint, n bigint, n_log_n double")
    feature = counts.groupBy("host", "path", "up", "depth", "kind", "feature").agg(
        F.sum("n").alias("n"), F.sum("n_log_n").alias("n_log_n"))
    total = F.sum(F.when(F.col("kind") == 0, F.col("n")))
    node = feature.groupBy("host", "path", "up", "depth").agg(
        F.max(F.when(F.col("kind") == 2, F.col("n"))).alias("pages"),
        # entropy of a feature over the pages, in nats
        F.avg(F.when(F.col("kind") == 1, F.log("n") - F.col("n_log_n") / F.col("n"))).alias("content"),
        F.count(F.when(F.col("kind") == 0, 1)).alias("n_styles"),
        F.coalesce(F.log(total) - F.sum(F.when(F.col("kind") == 0, F.col("n") * F.log("n"))) / total,
                   F.lit(0.0)).alias("presentation"))
    base = F.log(F.greatest(F.col("pages"), F.lit(2)))
    # (least() passes over a null, but a node without text has no content importance)
    scaled = node.withColumn("content", F.when(F.col("content").isNotNull(), F.least(
        F.lit(1.0), F.col("content") / base))) \
        .withColumn("presentation", F.least(F.lit(1.0), F.col("presentation") / base))

    def low(rows: pd.DataFrame) -> pd.DataFrame:
        found = _importance(rows)
        paths = sorted(p for p, v in found.items() if p and v < THRESHOLD)  # the page itself is path 0
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "low": [paths]})

    return scaled.groupBy("host").applyInPandas(low, "host string, low array<bigint>")


def main_text(page: str | None, low: frozenset[int] = frozenset()) -> str:
    """The text of a page without noise and without the branches in ``low``. Plain elements
    of an article stand and fall with the article."""
    out, nodes = blocks(page or "")
    clean = [(n, t) for n, t in out if not n.noise] or [(n, t) for n, t in out if not n.hard]
    if any(n.inside for n, _ in clean):
        clean = [(n, t) for n, t in clean if n.inside]
    if low:
        for n in nodes[1:]:  # parents first
            hit = n.path in low
            n.low = n.up.low or hit
            n.cut = n.up.cut or hit and n.name not in _KEPT
    kept = [t for n, t in clean if not (n.cut if n.inside else n.low)]
    return " ".join(kept or (t for _, t in clean))


_KEPT = PLAIN | MAIN | {"html", "body", "header", "section"}


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per page."""
    prepare_workers(pages.sparkSession)
    trees = materialize(style_trees(pages).where("size(low) > 0").withColumnRenamed("host", "t_host"), "style-trees")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(p, frozenset(low or ())) for p, low in
                     zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                        _host_column().alias("p_host"))
    joined = rows.join(trees, F.col("p_host") == F.col("t_host"), "left")
    return joined.select("page_id", "url", "html", "low").mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint")


def _host_column():
    """``host_of`` as an expression."""
    url = F.trim(F.coalesce(F.col("url"), F.lit("")))
    return F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def op1_html_extraction(pages: DataFrame) -> DataFrame:
    return extract(pages)
