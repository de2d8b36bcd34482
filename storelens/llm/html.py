"""Main text of web pages; site templates are found by counting element subtrees per host."""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.llm.tables import each_slice, packed, stored
from storelens.operators.joins import skew_join

#: A subtree is a site template if so many different pages of a host have it, however many pages the host has.
LEAST_PAGES = 5
#: Templates of all hosts that are sent to every executor as they are (8 bytes each); more are joined by a shuffle.
SENT_TEMPLATES = 2_000_000

#: Elements by their part in a page.
RAW = ["script", "style"]
UNSEEN = ["script", "style", "template", "noscript", "link", "meta", "input"]  # nothing is shown, so no word ends there
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"]
DROPPED = ["head", "script", "style", "noscript", "template", "iframe", "object", "svg", "canvas", "form", "button", "select", "textarea", "input", "label",
           "fieldset", "nav", "footer", "aside", "menu", "dialog", "audio", "video"]
CONTAINERS = ["div", "section", "ul", "ol", "dl", "table", "nav", "footer", "header", "aside", "form", "figure", "details", "center"]
INLINE = ["a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "s", "samp",
          "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "ruby", "rt", "rp", "rb", "nobr"]
#: Words in class, id and role that mark what is not the article.
NOISE = ["ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored", "promo", "promotion", "cookie", "cookies", "consent",
         "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "sidebar", "menu", "nav",
         "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "contentinfo", "complementary", "search", "comment", "comments", "disqus",
         "replies", "respond", "share", "sharing", "social", "related", "recommended", "widget", "pagination", "pager", "toolbar", "skip"]
#: What may stand beside such a word in a compound name (share-buttons, cookie_notice_box); other compounds (share-price) are names of their own.
BESIDE = ["area", "bar", "block", "body", "bottom", "box", "button", "buttons", "container", "content", "footer", "form", "header", "icon", "icons", "inner", "item", "items",
          "left", "link", "links", "list", "main", "outer", "page", "panel", "posts", "right", "row", "section", "site", "slot", "space", "text", "title", "top", "unit",
          "wrap", "wrapper"]
#: Text of an article whatever its names say.
TEXT = ["h1", "h2", "h3", "h4", "h5", "h6", "p", "pre", "blockquote"]
COMMENTS = ["comment", "comments", "disqus", "replies", "reply"]
#: A start tag ends an open element of these kinds, up to a container that holds them apart.
CLOSES = {"li": ["li"], "dt": ["dt", "dd"], "dd": ["dt", "dd"], "tr": ["tr", "td", "th"], "td": ["td", "th"], "th": ["td", "th"], "option": ["option"]}
SCOPES = ["ul", "ol", "dl", "table", "select", "html", "body", "article", "section", "div"]

_RAW, _VOID, _DROPPED, _CONTAINERS, _INLINE, _UNSEEN, _NOISE, _BESIDE, _TEXT, _SCOPES = map(frozenset, (RAW, VOID, DROPPED, CONTAINERS, INLINE, UNSEEN, NOISE, BESIDE, TEXT, SCOPES))
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"']++)*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[a-z0-9]+")
_HOST = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


class Node:
    __slots__ = ("tag", "attributes", "items")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.items = tag, attributes, []


class _Open:
    """The open elements, and where the last one of each tag, the last block and the last scope stand, so that no tag looks through them all."""

    def __init__(self, root: Node):
        self.nodes, self.by_tag, self.blocks, self.scopes = [root], {}, [], []

    def add(self, node: Node) -> None:
        at = len(self.nodes)
        self.nodes.append(node)
        self.by_tag.setdefault(node.tag, []).append(at)
        if node.tag not in _INLINE:
            self.blocks.append(at)
        if node.tag in _SCOPES:
            self.scopes.append(at)

    def close(self, at: int) -> None:
        """Everything from ``at`` on."""
        while len(self.nodes) > at:
            node = self.nodes.pop()
            self.by_tag[node.tag].pop()
            if node.tag not in _INLINE:
                self.blocks.pop()
            if node.tag in _SCOPES:
                self.scopes.pop()

    def last(self, tags: list[str]) -> int:
        return max((self.by_tag[t][-1] for t in tags if self.by_tag.get(t)), default=0)


def parse(html: str) -> Node:
    """A forgiving tree of elements and texts (still with character references), in time that grows with the text alone."""
    root = Node("#page")
    open_, at = _Open(root), 0
    while True:
        m = _TAG.search(html, at)
        stop = m.start() if m else len(html)
        if stop > at:
            open_.nodes[-1].items.append(html[at:stop])
        if not m:
            return root
        at = m.end()
        slash, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            if m[0].startswith("<![CDATA["):
                open_.nodes[-1].items.append(m[0][9:].removesuffix("]]>").replace("&", "&amp;"))
            continue
        name = name.lower()
        if slash:
            last, block = open_.last([name]), open_.blocks[-1] if open_.blocks else 0
            if last and (name not in _INLINE or last > block):  # an inline end tag closes no block
                open_.close(last)
            continue
        if (name not in _INLINE and name not in _VOID and name not in _UNSEEN or name == "hr") and open_.blocks and open_.nodes[open_.blocks[-1]].tag == "p":
            open_.close(open_.blocks[-1])
        if name in CLOSES and (last := open_.last(CLOSES[name])) > (open_.scopes[-1] if open_.scopes else 0):
            open_.close(last)
        node = Node(name, attributes)
        open_.nodes[-1].items.append(node)
        if name in _RAW:
            end = re.compile(rf"</{name}[^>]*(?:>|\Z)", re.I).search(html, at)
            at = end.end() if end else len(html)
        elif name not in _VOID and not attributes.endswith("/"):
            open_.add(node)


def _attributes(node: Node) -> dict[str, str]:
    return {k.lower(): unescape(a or b or c) for k, a, b, c in _ATTRIBUTE.findall(node.attributes)}


def _is_noise(node: Node, inside: bool) -> bool:
    if node.tag in _DROPPED or node.tag == "header" and not inside:
        return True
    if not node.attributes or node.tag in ("html", "body", "main"):
        return False
    found = _attributes(node)
    if "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
        return True
    names = f"{found.get('class', '')} {found.get('id', '')} {found.get('role', '')}".lower().split()
    if inside and node.tag in _TEXT:
        return False
    words = frozenset(COMMENTS) if node.tag == "article" or node.tag in _INLINE else _NOISE
    return any(_says(words, name) for name in names)


def _says(words: frozenset[str], name: str) -> bool:
    """Whether a class name is one of ``words`` or a compound of them with words that only say what kind of element it is."""
    parts = {p.rstrip("0123456789") for p in _PART.findall(name)} - {""}
    return not parts.isdisjoint(words) and parts <= words | _BESIDE | _NOISE


def subtree_hashes(root: Node, host: str = "") -> tuple[dict[int, int], set[int]]:
    """A hash of host, tag, attributes and content for every element that can be a site template, by the node's identity; and
    which of these nodes are mostly links."""
    seed = xxhash.xxh64_intdigest(host.encode("utf-8", "surrogatepass"))
    out: dict[int, int] = {}
    links: set[int] = set()
    todo: list[tuple[Node, list[str] | None]] = [(root, None)]
    made: dict[int, tuple[str, int, int]] = {}
    while todo:  # children first, without recursion: pages can be nested deeply
        node, seen = todo.pop()
        if seen is None:
            todo.append((node, []))
            todo.extend((x, None) for x in node.items if isinstance(x, Node))
            continue
        whole, size, linked = xxhash.xxh64(f"{node.tag} {' '.join(node.attributes.split())}>", seed), 0, 0
        for x in node.items:
            written, n, of_links = made.pop(id(x)) if isinstance(x, Node) else (" ".join(x.split()), len(x.strip()), 0)
            whole.update(written)
            size, linked = size + n, linked + of_links
        if node.tag == "a":
            linked = size
        digest = whole.intdigest()
        made[id(node)] = (f"<{digest:016x}>", size, linked)
        if node.tag in _CONTAINERS:
            out[id(node)] = digest - (1 << 64) if digest >> 63 else digest
            if 2 * linked >= size:
                links.add(id(node))
    return out, links


def template_hashes(page: Node, host: str = "") -> set[int]:
    """Hashes of the subtrees that speak for a template where they recur: those outside the article and, inside it, those that are mostly
    links. An article's own parts may stand on any number of pages (copies, pages of one text, lists of parts) and stay text."""
    hashes, links = subtree_hashes(page, host)
    roots, inside = _roots(page), set()
    if roots != [page]:
        todo = list(roots)
        while todo:
            x = todo.pop()
            inside.add(id(x))
            todo.extend(c for c in x.items if isinstance(c, Node))
    return {h for node, h in hashes.items() if node not in inside or node in links}


def _roots(page: Node) -> list[Node]:
    """The outermost articles; without one the main part; else the page."""
    articles, mains, todo = [], [], [page]
    while todo:
        node = todo.pop()
        if node.tag == "article" and not _is_noise(node, True):
            articles.append(node)
            continue
        if node.tag == "main" or node.attributes and _attributes(node).get("role") == "main":
            mains.append(node)
        if node is page or not _is_noise(node, False):
            todo.extend(x for x in reversed(node.items) if isinstance(x, Node))
    return articles or mains[:1] or [page]


class Templates:
    """Sorted hashes of templates."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys

    def __len__(self) -> int:
        return len(self.keys)

    def __contains__(self, tree: int | None) -> bool:
        if tree is None:
            return False
        at = int(np.searchsorted(self.keys, tree))
        return at < len(self.keys) and int(self.keys[at]) == tree


def main_text(html: str | None, templates: Templates | frozenset[int] = frozenset(), host: str = "") -> str:
    """The article's text: no menus, headers, footers, sidebars, notices, adverts, forms, scripts, comments, and no subtree in
    ``templates``. White space is one space, blocks are joined by one space in page order. Null is empty."""
    page = parse(html or "")
    hashes = subtree_hashes(page, host)[0] if templates else {}
    roots = _roots(page)
    inside, parts = roots != [page], []
    for root in roots:
        todo: list[Node | str] = [root]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                parts.append(unescape(x) if "&" in x else x)
                continue
            if x is not root and (_is_noise(x, inside) or hashes.get(id(x)) in templates):
                parts.append("" if x.tag in _INLINE or x.tag in _UNSEEN else " ")
                continue
            edge = "" if x.tag in _INLINE or x.tag in _UNSEEN else " "
            parts.append(edge)
            todo.append(edge)
            todo.extend(reversed(x.items))
        parts.append(" ")
    return " ".join("".join(parts).split())


def page_trees(rows: DataFrame) -> DataFrame:
    """(_page, trees): the template hashes of each page of rows (_host, _text, _page), where exact copies of a page count once."""

    def compute(part: pa.RecordBatch) -> list:
        given = zip(part.column("_text").to_pylist(), part.column("_host").to_pylist())
        return [[sorted(template_hashes(parse(t or ""), host)) for t, host in given]]

    return each_slice(rows, compute, [T.StructField("trees", T.ArrayType(T.LongType()))], ["_page"]).distinct()


def site_templates(seen: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """(tree, n): subtrees that recur on ``least_pages`` pages of a host, from ``page_trees``; the hash of a subtree holds its host.

    The number of pages is the same for every host. Counting combines before the shuffle, so a host with a third of all pages is no single group.
    """
    return seen.select(F.explode("trees").alias("tree")).groupBy("tree").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)


def extract_pages(pages: DataFrame, html: str = "html", url: str = "url", carry: tuple[str, ...] = ("_row",)) -> DataFrame:
    """Every row of ``pages`` as ``carry`` (see ``tables.packed``) with text and n_chars (code points).

    Null and empty html, and pages without an article text, give the empty text. Rows without a url form one host.
    Repeated rows are extracted one by one. Text inside the article is kept even where it recurs: only whole containers (lists, divisions,
    tables and the like) can be templates, never paragraphs, and those inside an article only where they are mostly links or recur outside articles too.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(f"_row.{url}").cast("string"), _HOST, 1)), F.lit(""))
    rows = packed(pages, html).withColumn("_host", host)
    rows = rows.withColumn("_page", F.xxhash64("_host", F.coalesce("_text", F.lit(""))))
    seen = stored(page_trees(rows.select("_host", "_text", "_page")))
    templates = stored(site_templates(seen))
    sent, shared = templates.count() <= SENT_TEMPLATES, None
    if sent:
        keys = templates.select("tree").toArrow().column("tree").to_numpy()
        shared = pages.sparkSession.sparkContext.broadcast(np.sort(keys))
    else:
        # Each page with those of its subtrees that are templates, at most as many as it has; pages and copies too many for a task are salted.
        trees = seen.select("_page", F.explode("trees").alias("tree"))
        marked = skew_join(trees, templates.select("tree"), ["tree"], "inner", templates)
        rows = skew_join(rows, stored(marked.groupBy("_page").agg(F.collect_list("tree").alias("_templates"))), ["_page"])
    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]

    def compute(part: pa.RecordBatch) -> list:
        texts, hosts = part.column("_text").to_pylist(), part.column("_host").to_pylist()
        own = [Templates(shared.value)] * len(texts) if sent else [frozenset(t or ()) for t in part.column("_templates").to_pylist()]
        out = [main_text(*page) for page in zip(texts, own, hosts)]
        return [out, list(map(len, out))]

    return each_slice(rows, compute, fields, list(carry))
