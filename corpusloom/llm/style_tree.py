"""Main text of web pages with a style tree per site.

The element trees of all pages of a host are merged: a node stands for a path of tags with their class and id. Headings,
paragraphs, list items and inline elements belong to the container around them. For each node the tree keeps in which
styles (sequences of children) and with which own texts it occurs. A node's importance is the entropy of its styles or of
its texts, whichever is larger, relative to the number of occurrences: templates repeat the same few styles and texts,
articles do not. A branch is noise if it and all below it have a low importance.

A page's text comes from its articles if they hold most of what is kept of it, or else its main element, or else its
body, without noise branches and without elements that are never main text by their tag or name (menus, headers, footers,
sidebars, notices, adverts, forms, comments, scripts, styles). Names say nothing about html, body, main and a chosen
article, and ``has-sidebar``, ``no-ads`` or ``menu-open`` are no names of the element itself. Texts of inline elements are joined; white space inside a block becomes one space, and
blocks are joined by an empty line.

A node seen ``FEW`` times or less is never noise by its importance, nor is a chosen article or main element or what
encloses it; inside one, noise branches that would take most of its text are none. Null and empty pages have an empty text, pages
without host share one tree, and broken markup is read as far as it goes: open elements end with the page. Branches
deeper than ``DEEP`` levels belong to the node at that level. Equal pages of a host count as one in its tree, however
often they stand in the table; each of the rows gets its text.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize

#: Importance below which a node is noise, and occurrences from which that is judged.
LOW, FEW = 0.3, 8
DEEP = 48
#: Up to so many noise branches travel to all tasks; more are joined page by page.
SENT_BRANCHES = 100_000
#: Up to so many different pages that stand in the table several times travel to all tasks; more are joined.
SENT_COPIES = 100_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(?P<close2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)",
    re.DOTALL,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset(("script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp"))
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Elements that are no nodes of the style tree of their own, but parts of the text around them.
PARTS = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote li dt dd tr td th figcaption caption tbody thead tfoot".split())
#: Start tags that end an open paragraph, and those that end an open element of their own kind.
ENDS_P = frozenset("address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
ENDS_OWN = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
LISTS = frozenset(("ul", "ol", "dl", "table", "select"))
NEVER_TAGS = frozenset("nav header footer aside form button select script style textarea noscript template iframe head title dialog menu svg".split())
NEVER_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer header masthead menu nav navbar navigation newsletter notice notices popup promo promoted related replies respond share sharing sidebar social sponsor sponsored subscribe toolbar widget".split()
)
#: Parts of a name that say what an element has or in which state it is, not what it is.
BEFORE, LAST = frozenset("has no not with without is".split()), frozenset("open opened closed active inactive visible hidden enabled disabled free on off".split())
#: Elements that are not judged by their names.
UNNAMED = frozenset("html body main article".split())


def never_named(names: str) -> bool:
    """Whether one of the names tells that an element is never main text."""
    for name in names.lower().split():
        parts = re.split("[-_]+", name)
        found = next((i for i, part in enumerate(parts) if part in NEVER_NAMES), None)
        if found is not None and BEFORE.isdisjoint(parts[:found]) and (len(parts) == 1 or parts[-1] not in LAST):
            return True
    return False


class Node:
    __slots__ = ("tag", "path", "never", "named", "styles", "text", "parent")

    def __init__(self, tag: str, path: int, never: bool, parent: Node | None, named: bool = False):
        self.tag, self.path, self.never, self.parent, self.named = tag, path, never, parent, named
        self.styles: list[str] = []
        self.text: list[str] = []


def number(*parts: object) -> int:
    """A 64-bit number that depends on the parts alone."""
    value = 0xCBF29CE484222325
    for byte in "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass"):
        value = (value ^ byte) * 0x100000001B3 & 0xFFFFFFFFFFFFFFFF
    return value - (1 << 64) if value >> 63 else value


def container(node: Node) -> Node:
    """The node that a part of running text belongs to: it is judged as a whole."""
    while node.tag in PARTS and node.parent is not None:
        node = node.parent
    return node


class Page:
    """A page as nodes and the pieces of text between tags, in order."""

    numbers: dict[tuple, int] = {}

    def __init__(self, source: str):
        self.root = Node("", 0, False, None)
        self.nodes: list[Node] = [self.root]
        self.pieces: list[tuple[Node, str | None]] = []
        self.stack = [self.root]
        at, raw = 0, None
        size = len(source)
        while at < size:
            if raw:
                end = re.compile(rf"</{raw}\b", re.IGNORECASE).search(source, at)
                at, raw = (end.start() if end else size), None
                continue
            token = TOKEN.search(source, at)
            self.say(source[at : token.start() if token else size])
            if not token:
                break
            at = token.end()
            tag = (token["tag"] or token["tag2"] or "").lower()
            if not tag:
                continue
            if token["close"] or token["close2"]:
                self.close(tag)
            else:
                rest = token["rest"] or token["rest2"] or ""
                self.open(tag, rest)
                if tag in RAW and not rest.endswith("/"):
                    raw = re.escape(tag)

    def say(self, text: str) -> None:
        if text:
            self.pieces.append((self.stack[-1], text))
            container(self.stack[-1]).text.append(text)

    def child(self, parent: Node, tag: str, names: str) -> int:
        if len(self.stack) > DEEP:
            return parent.path
        key = (parent.path, tag, names)
        if key not in self.numbers:
            if len(self.numbers) > 100_000:
                self.numbers.clear()
            self.numbers[key] = number(*key)
        return self.numbers[key]

    def open(self, tag: str, rest: str) -> None:
        if tag in ENDS_P:
            self.end_within("p", LISTS | {"div", "article", "section", "body", "td"})
        for own in ENDS_OWN.get(tag, ()):
            self.end_within(own, LISTS)
        parent = self.stack[-1]
        names = " ".join(a or b or c for a, b, c in NAMES.findall(rest)) if rest else ""
        named = bool(names) and never_named(names)
        never = parent.never or tag in NEVER_TAGS or (named and tag not in UNNAMED)
        label = re.sub(r"\d+", "0", names)
        node = Node(tag, self.child(parent, tag, label), never, parent, named)
        if tag not in INLINE:
            container(parent).styles.append(f"{tag}.{label}" if label else tag)
        self.nodes.append(node)
        self.border(node)
        if tag not in VOID and not rest.endswith("/"):
            self.stack.append(node)

    def border(self, node: Node) -> None:
        if node.tag == "br":
            self.pieces.append((node.parent, " "))
        elif node.tag not in INLINE:
            self.pieces.append((node, None))

    def end_within(self, tag: str, barrier: frozenset[str]) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                return self.cut(depth)
            if self.stack[depth].tag in barrier:
                return

    def close(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                return self.cut(depth)
            if tag in INLINE and self.stack[depth].tag not in INLINE:
                return

    def cut(self, depth: int) -> None:
        for node in self.stack[depth:]:
            self.border(node)
        del self.stack[depth:]

    def seen(self) -> list[tuple[int, int, int, int]]:
        """What the style tree counts: path, parent's path, kind (0 style, 1 text) and its number."""
        out = []
        for node in self.nodes[1:]:
            if container(node) is not node:
                continue
            above = container(node.parent).path
            if node.styles:
                out.append((node.path, above, 0, hash_text("|".join(node.styles))))
            text = " ".join(" ".join(node.text).split()) if node.text and node.tag not in RAW else ""
            if text:
                out.append((node.path, above, 1, hash_text(text)))
        return out

    def tops(self, tag: str) -> list[Node]:
        """The outermost elements of a tag that may be main text."""
        within: set[int] = set()
        out = []
        for node in self.nodes[1:]:
            if id(node.parent) in within:
                within.add(id(node))
            elif node.tag == tag and not node.never:
                within.add(id(node))
                out.append(node)
        return out

    def inside(self, region: list[Node], noise: frozenset[int]) -> set[int]:
        """The nodes of a region that are kept; its own elements and html and body are not judged as noise, nor the former by name."""
        chosen, out = set(map(id, region)), set()
        for node in self.nodes:
            if id(node) in chosen:
                out.add(id(node))
            elif id(node.parent) in out and not node.never and (node.tag in ("html", "body") or not (node.tag == "article" and node.named or node.path in noise)):
                out.add(id(node))
        return out

    def region(self, noise: frozenset[int]) -> set[int]:
        """The kept nodes of the articles, the main element or the whole page."""
        sizes = [(id(node), len(text.strip())) for node, text in self.pieces if text is not None]

        def size(kept: set[int]) -> int:
            return sum(n for node, n in sizes if node in kept)

        def kept(region: list[Node]) -> set[int]:
            found = self.inside(region, noise)
            whole = self.inside(region, frozenset()) if noise else found
            return whole if 2 * size(found) < size(whole) else found

        articles = self.tops("article")
        plain = [a for a in articles if not a.named]
        named = sorted((a for a in articles if a.named), key=lambda a: -size(self.inside([a], frozenset())))[:1]
        for some in (plain, named):
            if some:
                found = kept(some)
                if 2 * size(found) > size(found | self.inside([self.root, *plain, *some], noise)):
                    return found
        mains = self.tops("main")
        if mains and size(found := kept(mains)):
            return found
        return self.inside([self.root], noise)

    def main_text(self, noise: frozenset[int]) -> str:
        """The blocks of the main region without noise."""
        kept = self.region(noise)
        blocks, current = [], []
        for node, text in [*self.pieces, (self.root, None)]:
            if text is None:
                block = " ".join("".join(current).split())
                if block:
                    blocks.append(block)
                current = []
            elif id(node) in kept:
                current.append(html.unescape(text))
        return "\n\n".join(blocks)


def hash_text(text: str) -> int:
    import hashlib

    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def rows_of_pages(pages: DataFrame, id_column: str, url_column: str, html_column: str) -> DataFrame:
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_column), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))
    return pages.select(F.col(id_column).alias("page"), F.col(url_column).alias("url"), F.coalesce(F.col(html_column), F.lit("")).alias("html"), host.alias("host"))


def with_copies(pages: DataFrame) -> DataFrame:
    """Host and html of every row, and in how many rows the host has this html."""
    keyed = pages.select("host", "html", F.xxhash64("host", "html").alias("key"))
    copies = materialize(keyed.groupBy("key").agg(F.count("*").alias("copies")).where("copies > 1"), "copies")
    if copies.count() <= SENT_COPIES:
        copies = F.broadcast(copies)
    return keyed.join(copies, "key", "left").select("host", "html", F.coalesce("copies", F.lit(1)).alias("copies"))


def style_trees(pages: DataFrame) -> DataFrame:
    """For every host and path: its parent's path, occurrences in different pages and importance."""

    def count(batches):
        for batch in batches:
            found: dict[tuple, float] = defaultdict(float)
            rows = Counter(zip(*(batch.column(name).to_pylist() for name in ("host", "html", "copies")), strict=True))
            for (host, source, copies), times in rows.items():
                for row in Page(source).seen():
                    found[host, *row] += times / copies
            columns = list(zip(*found, strict=True)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.record_batch([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)] + [pa.array(list(found.values()), pa.float64())], ["host", "path", "parent", "kind", "value", "n"])

    values = with_copies(pages).mapInArrow(count, "host string, path long, parent long, kind int, value long, n double")
    node = ["host", "path", "parent", "kind"]
    # The copies of a page add up to one, so each value's sum is a whole number.
    values = values.groupBy(*node, "value").agg(F.round(F.sum("n")).cast("long").alias("n"))
    # The entropy of shares n / total is log(total) - sum(n log n) / total; relative to log(total) it is at most 1.
    sums = values.groupBy(*node).agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.log("n")).alias("weighted"))
    entropy = (F.log("total") - F.col("weighted") / F.col("total")) / F.log("total")
    importance = F.when(F.col("total") <= FEW, 1.0).otherwise(F.round(entropy, 9))
    return sums.withColumn("importance", importance).groupBy("host", "path", "parent").agg(F.max("total").alias("total"), F.max("importance").alias("importance"))


def noise_branches(trees: DataFrame) -> DataFrame:
    """Host and path of the nodes that are unimportant together with all below them."""
    trees = materialize(trees, "trees")
    left = trees.select("host", "path", "parent", "importance")
    # The highest importance below goes up one level each turn; the depth of a tree is bounded.
    high = left.select("host", "path", F.col("importance").alias("highest"))
    front = left.select("host", F.col("parent").alias("path"), "importance").groupBy("host", "path").agg(F.max("importance").alias("importance"))
    parents = trees.select("host", "path", "parent")
    for _ in range(DEEP + 1):
        front = materialize(front.where("path != 0").where(F.col("importance") >= LOW).select("host", "path").distinct(), "front")
        if front.isEmpty():
            break
        high = high.union(front.select("host", "path", F.lit(1.0)))
        front = front.join(parents, ["host", "path"]).select("host", F.col("parent").alias("path"), F.lit(1.0).alias("importance"))
    return high.groupBy("host", "path").agg(F.max("highest").alias("highest")).where(F.col("highest") < LOW).select("host", "path")


def extract(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """For each row: id, url, text and n_chars (code points)."""
    rows = rows_of_pages(pages, id_column, url_column, html_column)
    noise = materialize(noise_branches(style_trees(rows)), "noise")
    by_host = noise.groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("noise"))
    # The size of what is sent is checked; beyond it the join may shuffle the pages.
    if noise.count() <= SENT_BRANCHES:
        by_host = F.broadcast(by_host)
    kind = rows.schema["page"].dataType.simpleString()

    def read(batches):
        for batch in batches:
            texts = []
            for source, paths in zip(batch.column("html").to_pylist(), batch.column("noise").to_pylist(), strict=True):
                texts.append(Page(source).main_text(frozenset(paths or ())))
            sizes = pa.array(np.array([len(t) for t in texts], np.int64))
            yield pa.record_batch([batch.column("page"), batch.column("url"), pa.array(texts, pa.string()), sizes], ["page", "url", "text", "n_chars"])

    found = rows.join(by_host, "host", "left").select("page", "url", "html", "noise").mapInArrow(read, f"page {kind}, url string, text string, n_chars long")
    return found.withColumnsRenamed({"page": id_column, "url": url_column})
