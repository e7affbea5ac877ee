"""Main text of web pages by consensus host paths.

1. Each page's containers are scored: the text of their blocks that is not in
   links, in full for the container itself and less for those around it.
2. From the best container the page climbs to what it is a part of: to the
   article around it, and otherwise to the sections, divs and main around it
   while the text that this adds is not mostly links.  So a title, a lede,
   other sections or the text around a quote or a cell are kept.
3. The path reached (tags and classes from the root down, numbers replaced, as
   a 64-bit hash) is the page's vote for its host; votes are counted by host
   and path in Spark.
4. Each page is read again: the containers at its host's winning path are
   taken, or, where a page has none, the page's own best container; both climb
   as above.

Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles
and reader comments are left out by element, role and class or id.  A class
names clutter by its last word (``post-navigation``, ``comment-list`` without
the word for a part), not by any word in it; an id only if all of it does, so
that the slug of a heading (``related-work``) names none.  Headings,
paragraphs and inline elements go only by whole, unmistakable classes.  What
is named by a word that a text may be about (``legal``, ``navigation``) is
left out only if it is mostly links or short, and by an id inside an article
only if it is mostly links.

Defined results: null and empty pages give an empty text; a page without a
container gives the text of its body that is not left out; pages without a
host vote together; very long and very deep pages are read whole, in memory
that grows with their length; ties between paths are settled as ``host_paths``
says; repeated rows repeat their result; other columns are ignored, whatever
their names; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, small_side, stored

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>", re.S)
_CUT_OFF = re.compile(r"<[a-zA-Z/!?]")
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_NUMBER = re.compile(r"\d+")

# FIXED VALUES of HTML: elements without content, raw-text elements, blocks, and what a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea svg math object title".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
          "option": ("option",), "tbody": ("tr", "td", "th", "tbody", "thead"), "thead": (), "body": ("head",)}
LISTS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "tbody": ("table",)}
CONTAINERS = frozenset("article main section div td body blockquote".split())
#: Containers that a climb may reach.
AROUND = frozenset("article main section div".split())

# What is left out, wherever it stands.
LEFT_OUT = frozenset("head nav header footer aside form button select menu dialog".split())
LEFT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar".split())
LEFT_WORDS = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads adv advert adverts advertisement advertising adsbygoogle "
    "taboola outbrain werbung publicidad publicite gdpr kommentare kommentar comentarios commentaires reviews sponsor "
    "sponsored promo promotion banner cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup login comment comments commentlist reply replies respond disqus share sharing social related recommended breadcrumb "
    "breadcrumbs pagination pager widget toolbar copyright legal hidden".split())
#: Of these, those that name clutter whatever is in it, however long.
CERTAIN_WORDS = frozenset(
    "adsbygoogle taboola outbrain werbung publicidad publicite gdpr kommentare kommentar comentarios commentaires "
    "ad ads adv advert adverts comment comments commentlist replies respond disqus sidebar footer masthead navbar cookie consent popup "
    "modal overlay breadcrumb breadcrumbs pagination pager hidden newsletter".split())
#: Whole classes by which inline elements and headings are left out, too.
INLINE_WORDS = frozenset("ad ads adv advert adverts advertisement sponsored hidden".split())
#: A class that ends with one of these names the content, whatever else the element's classes say.
CONTENT_WORDS = frozenset("content article post entry main story body text page".split())
KEPT_OUT = frozenset("comment comments ad ads sidebar footer".split())
#: Words after the one that says what it is: the parts of a thing and its place.
PART_WORDS = frozenset(
    "list lists item items box boxes bar bars wrap wrapper container area block blocks section sections link links left right top bottom "
    "inner outer slot unit button buttons btn icon icons thread panel group row col column holder content body text title heading label "
    "posts post articles article stories story entries entry pages page widget widgets form count meta main primary secondary site global "
    "mobile desktop fixed sticky small large bg".split())
#: Words before it that make it a mode of something else.
MODE_WORDS = frozenset("with has no without is not js".split())
#: Text of more characters is long.
LONG = 1000
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    path: int  # of tags and classes from the root down, as a hash
    out: bool  # left out
    doubt: str = "no"  # left out if its text is short, or mostly links
    in_article: bool = False
    score: float = 0.0
    chars: int = 0  # of the text inside, and of that in links
    linked: int = 0


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)  # node, text

    def settle(self, linked: list[int]) -> list[int]:
        """Leave out what is in doubt by its text; the links of the blocks that stay."""
        nodes = self.nodes
        if not any(n.doubt != "no" for n in nodes):
            return linked
        chars, links = [0] * len(nodes), [0] * len(nodes)
        for (at, text), k in zip(self.blocks, linked):
            if at >= 0:
                chars[at] += len(text)
                links[at] += k
        for i in range(len(nodes) - 1, -1, -1):
            node = nodes[i]
            if node.doubt != "no" and (2 * links[i] > chars[i] or node.doubt == "short" and chars[i] <= LONG):
                node.out = True
            if node.parent >= 0:
                chars[node.parent] += chars[i]
                links[node.parent] += links[i]
        for node in nodes:
            node.out = node.out or node.parent >= 0 and nodes[node.parent].out
        stay = [at < 0 or not nodes[at].out for at, _ in self.blocks]
        self.blocks = [b for b, s in zip(self.blocks, stay) if s]
        return [k for k, s in zip(linked, stay) if s]

    def score(self, linked: list[int]) -> None:
        """Scores and lengths of the text, of which ``linked`` characters a block are links."""
        nodes = self.nodes
        for (at, text), links in zip(self.blocks, linked):
            if at >= 0:
                nodes[at].chars += len(text)
                nodes[at].linked += links
            share = 1.0
            while at >= 0 and share > 0.1:
                if nodes[at].tag in CONTAINERS:
                    nodes[at].score += (len(text) - links) * share
                    share /= 2
                at = nodes[at].parent
        for node in reversed(nodes):  # children come after their parents
            if node.parent >= 0:
                nodes[node.parent].chars += node.chars
                nodes[node.parent].linked += node.linked

    def climb(self, at: int) -> int:
        """The container that ``at`` is a part of: the article around it, else the
        outermost one up to which what is added is not mostly links."""
        nodes = self.nodes
        reached, up = at, nodes[at].parent
        around = nodes[at].tag == "article"
        while up >= 0 and not around:
            if nodes[up].tag == "article":
                reached, around = self._wider(reached, up), True
            up = nodes[up].parent
        up = nodes[reached].parent
        while up >= 0:
            # from an article only to the main element
            if nodes[up].tag in AROUND and (nodes[up].tag == "main" or not around):
                chars, links = (nodes[up].chars - nodes[reached].chars, nodes[up].linked - nodes[reached].linked)
                if 2 * links > chars:
                    break
                reached = self._wider(reached, up)
            up = nodes[up].parent
        return reached

    def _wider(self, a: int, b: int) -> int:
        return b if self.nodes[b].chars > self.nodes[a].chars else a

    def text_in(self, roots: set[int]) -> list[str]:
        """The blocks inside ``roots``, all without any."""
        inside = [not roots] * (len(self.nodes) + 1)  # the last one is that of no node
        for i, node in enumerate(self.nodes):  # parents come before their children
            inside[i] = not roots or i in roots or node.parent >= 0 and inside[node.parent]
        return [text for at, text in self.blocks if inside[at]]


def _words(name: str) -> list[str]:
    return [w.lower() for w in _WORDS.findall(name)]


def _named(token: str) -> str | None:
    """The word of LEFT_WORDS that a class says the element is."""
    words = [w for w in _words(token) if len(w) > 1]
    if not words or words[0] in MODE_WORDS:
        return None
    if words[-1] == "header" and set(words[:-1]) & CONTENT_WORDS:
        return None  # the head of the content has its title
    while len(words) > 1 and words[-1] in PART_WORDS:
        words.pop()
    return words[-1] if words[-1] in LEFT_WORDS else None


def _left_out(tag: str, attrs: dict[str, str], in_article: bool) -> str:
    """``yes``, ``no``, or what its text must be to be left out: ``short`` (or
    mostly links) or ``links`` (mostly links)."""
    if tag in LEFT_OUT:
        return "yes"
    if tag in ("html", "body", "main"):
        return "no"
    if attrs.get("role", "").lower() in LEFT_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return "yes"
    if "style" in attrs and re.search(r"display\s*:\s*none", attrs["style"]):
        return "yes"
    tokens = attrs.get("class", "").split()
    if tag not in BLOCK or tag == "p" or tag in HEADINGS:
        whole = CERTAIN_WORDS | INLINE_WORDS if tag == "p" else INLINE_WORDS
        return "yes" if any(t.lower() in whole for t in tokens) else "no"
    words = set()
    for token in tokens:
        if word := _named(token):
            words.add(word)
            if word not in CERTAIN_WORDS:  # cookie-notice
                words |= set(_words(token)) & CERTAIN_WORDS
    content = any((w := _words(t)) and w[-1] in CONTENT_WORDS and not _named(t) for t in tokens)
    if content and not words & KEPT_OUT:
        return "no"
    if words:
        return "yes" if words & CERTAIN_WORDS else "short"
    if content:
        return "no"
    # an id: every word of it
    words = {w for w in _words(attrs.get("id", "")) if len(w) > 1}
    named = words & LEFT_WORDS
    if named and words <= LEFT_WORDS | PART_WORDS:
        return "yes" if named & CERTAIN_WORDS else "links" if in_article else "short"
    return "no"


def parse(html: str) -> Page:
    """Open elements, their generalised paths, and the text blocks that are not left out."""
    page = Page()
    nodes, stack = page.nodes, []
    pieces: list[str] = []
    linked = [0, 0]  # depth in links, characters in links of this block
    links: list[int] = []  # the latter for every block

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            page.blocks.append((stack[-1] if stack else -1, text))
            links.append(min(len(text), linked[1]))
        linked[1] = 0

    def text_of(raw: str) -> None:
        if raw and not (stack and nodes[stack[-1]].out):
            text = unescape(raw) if "&" in raw else raw
            pieces.append(text)
            if linked[0]:
                linked[1] += len(text)

    open_tags: Counter[str] = Counter()

    def close(down_to: int) -> None:
        while len(stack) > down_to:
            tag = nodes[stack[-1]].tag
            open_tags[tag] -= 1
            if tag in BLOCK:
                flush()
            if tag == "a":
                linked[0] -= 1
            stack.pop()

    at, n = 0, len(html)
    while at < n:
        m = _TAG.search(html, at) if html.find(">", at) >= 0 or html.find("<!--", at) >= 0 else None
        if not m:  # a tag that the page's end cuts off is no text
            cut = _CUT_OFF.search(html, at)
            text_of(html[at:cut.start()] if cut else html[at:])
            break
        text_of(html[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            continue
        tag, ends = name.lower(), bool(m[1] or m[4])
        if ends:
            for k in range(len(stack) - 1 if open_tags[tag] else -1, -1, -1):
                if nodes[stack[k]].tag == tag:
                    close(k)
                    break
                if nodes[stack[k]].tag in ("table", "body") and tag not in ("html", "body", "table"):
                    break
            continue
        if tag in RAW:
            if not (m[3] or m[6] or "").rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
                at = end.end() if end else n
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                text_of(" ")
            continue
        if tag in BLOCK and tag != "html":
            for k in range(len(stack) - 1 if open_tags["p"] else -1, -1, -1):  # a block ends an open paragraph
                t = nodes[stack[k]].tag
                if t == "p":
                    close(k)
                    break
                if t in BLOCK:
                    break
        if tag in CLOSES and any(open_tags[t] for t in CLOSES[tag]):
            for k in range(len(stack) - 1, -1, -1):
                t = nodes[stack[k]].tag
                if t in LISTS.get(tag, ()):
                    break
                if t in CLOSES[tag]:
                    close(k)
                    if tag not in ("tr", "tbody", "td", "th"):
                        break
        if tag in BLOCK:
            flush()
        parent = stack[-1] if stack else -1
        raw = m[3] or m[6] or ""
        attrs = {}
        for a in _ATTR.finditer(raw):
            attrs.setdefault(a[1].lower(), unescape((a[2] or "").strip("\"'")))
        around = nodes[parent] if parent >= 0 else None
        classes = ".".join(sorted(set(_NUMBER.sub("#", attrs.get("class", "")).lower().split())))
        step = f"{tag}.{classes}" if classes else tag
        in_article = tag in ("article", "main") or bool(around and around.in_article)
        left = "yes" if around and around.out else _left_out(tag, attrs, in_article)
        nodes.append(Node(tag, parent, _path(around, step), left == "yes",
                          left if left in ("short", "links") else "no", in_article))
        stack.append(len(nodes) - 1)
        open_tags[tag] += 1
        if tag == "a":
            linked[0] += 1
    close(0)
    flush()
    page.score(page.settle(links))
    return page


def best_container(page: Page) -> int:
    """Where the climb from the container with the highest score ends; -1 without any."""
    best, at = 0.0, -1
    for i, node in enumerate(page.nodes):
        if node.score > best:
            best, at = node.score, i
    return page.climb(at) if at >= 0 else -1


def _path(around: Node | None, step: str) -> int:
    """A step further down than ``around``."""
    before = around.path if around else 0
    return int.from_bytes(blake2b(step.encode("utf-8", "surrogatepass"), digest_size=8, key=before.to_bytes(8, "little", signed=True)).digest(), "little", signed=True)


def main_text(html: str, host_path: int | None) -> str:
    page = parse(html)
    roots = {i for i, n in enumerate(page.nodes) if n.path == host_path and not n.out}
    if any(page.nodes[i].chars for i in roots):
        roots = {page.climb(i) for i in roots if page.nodes[i].chars}
    else:
        own = best_container(page)
        roots = {own} if own >= 0 else set()
    return "\n\n".join(page.text_in(roots))


def _vote_task(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        paths, scores = [], []
        for html in batch.column("html").to_pylist():
            page = parse(html or "")
            at = best_container(page)
            paths.append(page.nodes[at].path if at >= 0 else None)
            scores.append(page.nodes[at].score if at >= 0 else 0.0)
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(paths, pa.int64()), pa.array(scores, pa.float64())],
                                         ["host", "path", "score"])


def _extract_task(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        texts = [main_text(h or "", p) for h, p in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                                         ["page_id", "url", "text"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the path most pages of the host vote for, as its hash (ties: the one
    with more text, then the smaller hash)."""
    votes = pages.select("host", "html").mapInArrow(_vote_task, "host string, path long, score double")
    counted = votes.where("path is not null").groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.floor("score").cast("long")).alias("s"))
    top = counted.groupBy("host").agg(F.min_by("path", F.struct(-F.col("n"), -F.col("s"), F.col("path"))).alias("path"))
    return stored(top, "host-paths")


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for every row of ``pages`` (page_id, url, html)."""
    prepare(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select("page_id", "url", F.col("html").cast("string"), host.alias("host"))
    paths = host_paths(rows).withColumnRenamed("host", "_host")
    both = rows.join(small_side(paths), F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "path")
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return both.mapInArrow(_extract_task, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
