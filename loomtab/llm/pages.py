"""Main text of web pages by site style trees.

Pages of one host are merged into one tree: a node is a path of block elements with their names, and each
page adds to every node the style it uses there (the sequence of child elements) and the texts below it; equal pages
of a host count as one. A
node's importance joins the entropy of its styles over the pages with that of its texts: a branch that
looks alike and says the same on every page has none. Presentation weighs in as well: elements
made for menus, footers and the like have no importance anywhere, nor have branches with a name made for such, however long; an article
and what it stands in are important as such. Where names would leave nothing of a page, they are no evidence and entropy decides. The
tree is a table of hashes and counts, so a host of any size is spread over tasks; only the hosts' unimportant
paths go back to the pages.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from loomtab.llm.common import map_batches, steps, stored, text_or_empty

THRESHOLD = 0.3
MIN_PAGES = 5
STYLE_WEIGHT = 0.4

# A quote opens a value only right after the equals sign; elsewhere it is a sign like others.
TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?)*+)>|<[a-zA-Z/!?][^>]*(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/<>"'][^\s=/<>]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*)))?""")
NAME = re.compile(r"[a-z]+")
BLANK = re.compile(r"\s+")

# Elements of HTML by their role.
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s samp small span strike "
                   "strong sub sup svg time tt u var wbr".split())
CHROME = frozenset("nav footer aside form button select option input menu dialog object audio video canvas svg head fieldset".split())
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
CHROME_NAMES = frozenset("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice "
                         "notices alert popup modal overlay sidebar aside widget menu nav navbar navigation breadcrumb breadcrumbs footer masthead "
                         "comment comments reply replies disqus share sharing social related newsletter subscribe signup login pagination pager toolbar".split())
CONTENT_NAMES = frozenset("article body content entry main page post story text".split())
LAYOUT_WORDS = frozenset("has no not with without".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class Node:
    """``chrome`` by element, ``named`` by names; ``own`` is 2 for an article, 1 for the main part."""

    __slots__ = ("tag", "path", "article", "chrome", "children", "parent", "named", "own")

    def __init__(self, tag: str, path: str, article: bool, chrome: bool, parent: Node | None = None, named: bool = False):
        self.tag, self.path, self.article, self.chrome, self.children = tag, path, article, chrome, []
        self.parent, self.named, self.own = parent, named, 0

    def line(self) -> list[Node]:
        """The node and all above it."""
        out, node = [], self
        while node.parent is not None:
            out.append(node)
            node = node.parent
        return out


def below(parent: Node, tag: str, attributes: str) -> Node:
    """The node of one start tag: its names are part of the path, numbers in them are not."""
    found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
    tokens = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    words = [NAME.findall(t) for t in tokens]
    names = [w for ws in words for w in ws]
    role = found.get("role", "").lower()
    own = 2 if tag == "article" or role == "article" else 1 if tag == "main" or role == "main" else 0
    chrome = parent.chrome or tag in CHROME or role in CHROME_ROLES or (tag == "header" and not parent.article) \
        or "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    # "with-sidebar" tells of the layout, and what calls itself content as well is no such branch.
    told = [w for ws in words if ws and ws[0] not in LAYOUT_WORDS for w in ws]
    named = tag not in ("html", "body") and CONTENT_NAMES.isdisjoint(tokens) and (not CHROME_NAMES.isdisjoint(told) or ("header" in told and not parent.article))
    node = Node(tag, f"{parent.path}/{tag}" + "".join("." + n for n in sorted(set(names))), parent.article or own > 0, chrome, parent, named)
    node.own = own
    return node


def blocks(page: str) -> tuple[list[tuple[Node, str]], list[Node]]:
    """Text blocks in page order with the block element each stands in, and all block elements."""
    stack, nodes, out, held = [Node("", "", False, False)], [], [], []
    at, end = 0, len(page)

    def flush() -> None:
        text = BLANK.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        if text:
            out.append((stack[-1], text))

    while at < end:
        token = TOKEN.search(page, at)
        held.append(page[at:token.start() if token else end])
        if not token:
            break
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if tag in RAW and not token[1]:
            close = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
        elif tag in INLINE:
            held.append(" " if tag == "br" else "")
        elif token[1]:
            depth = next((d for d in range(len(stack) - 1, 0, -1) if stack[d].tag == tag), 0)
            flush()
            if depth:
                del stack[depth:]
        else:
            flush()
            if tag in CLOSES:
                while len(stack) > 1 and stack[-1].tag in CLOSES[tag]:
                    stack.pop()
            elif stack[-1].tag == "p":
                stack.pop()
            stack[-1].children.append(tag)
            node = below(stack[-1], tag, token[3] or "")
            nodes.append(node)
            if tag not in VOID and not (token[3] or "").rstrip().endswith("/"):
                stack.append(node)
    flush()
    return out, nodes


def digest(value: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(value.encode()) - (1 << 63)


def ancestors(path: str) -> list[str]:
    parts = path.split("/")[1:]
    return ["/" + "/".join(parts[:i + 1]) for i in range(len(parts))]


def host_of(url: str) -> Column:
    return F.lower(F.regexp_extract(text_or_empty(url), "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def page_features(page: str) -> set[tuple[int, int, int]]:
    """(path, 0, style) and (path, 1, text) of one page, as hashes; each once."""
    texts, nodes = blocks(page)
    found = {(digest(n.path), 0, digest(" ".join(n.children))) for n in nodes}
    for node, text in texts:
        value = digest(text)
        found.update((digest(p), 1, value) for p in ancestors(node.path))
    return found


def style_tree(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``host``, ``path`` (hash), different ``pages`` that have it and its ``importance`` from 0 to 1; pages without a host are left out.

    Each of n equal pages of a host counts 1/n, so no page has to be moved to its copies: only their hashes are counted, and
    those that repeat go back to the pages.
    """
    def run(batches):
        for batch in batches:
            counts: dict = {}
            for host, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
                for feature in page_features(text):
                    counts[host, *feature] = counts.get((host, *feature), 0) + 1 / copies
            host, path, kind, value = ([k[i] for k in counts] for i in range(4))
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(path, pa.int64()), pa.array(kind, pa.int32()), pa.array(value, pa.int64()),
                                              pa.array(list(counts.values()), pa.float64())], ["host", "path", "kind", "value", "n"])

    rows = pages.select(host_of(url).alias("host"), text_or_empty(page).alias("page")).where("host <> ''").withColumn("digest", F.xxhash64("page"))
    repeated = rows.groupBy("host", "digest").agg(F.count("*").alias("copies")).where("copies > 1")
    # Written out for the same reason as below: few copies are broadcast.
    rows = rows.join(stored(repeated, "page-copies"), ["host", "digest"], "left").select("host", "page", F.coalesce("copies", F.lit(1)).alias("copies"))
    features = map_batches(rows, run, "host string, path long, kind int, value long, n double") \
        .groupBy("host", "path", "kind", "value").agg(F.round(F.sum("n")).alias("n"))
    style, text = F.col("kind") == 0, F.col("kind") == 1
    nodes = features.groupBy("host", "path").agg(
        F.sum(F.when(style, F.col("n"))).alias("pages"), F.sum(F.when(style, F.col("n") * F.log("n"))).alias("styles"),
        F.sum(F.when(text, F.log("n"))).alias("texts"), F.sum(F.when(text, 1)).alias("features"))
    size = F.log("pages")
    by_style = 1 - F.col("styles") / (F.col("pages") * size)
    by_text = F.when(F.col("features") > 0, 1 - F.least(F.col("texts") / (F.col("features") * size), F.lit(1.0))).otherwise(0.0)
    return nodes.select("host", "path", "pages", F.when(F.col("pages") > 1, by_style * STYLE_WEIGHT + by_text * (1 - STYLE_WEIGHT)).otherwise(1.0).alias("importance"))


def main_text(page: str, unimportant: set[int]) -> str:
    """Blocks of the article if the page has one, else all, without branches of no importance.

    The article is the longest one in the fewest named branches, or the main part of a page without; other articles beside it go. It and all that it stands in
    stay whatever their names and entropy; other branches go by a name or for want of entropy. Where names leave nothing, entropy
    alone decides, and if nothing is left of the article then, all of it stays.
    """
    found = [(n, t) for n, t in blocks(page)[0] if not n.chrome]
    inside = [(n, t) for n, t in found if n.article]
    found = inside or found
    size: dict[Node, int] = {}
    for node, text in found:
        for n in node.line():
            if n.own:
                size[n] = size.get(n, 0) + len(text)
    chosen = max(size, key=lambda n: (n.own, -sum(a.named and not a.own for a in n.parent.line()), size[n]), default=None)
    around = chosen.line() if chosen else []

    def beside(n: Node) -> bool:
        return n.own == 2 and chosen.own == 2 and n not in around and chosen not in n.line()

    def left(by_name: bool) -> list[str]:
        kept = dict.fromkeys(around, True)

        def stays(n: Node) -> bool:
            if n not in kept:
                kept[n] = not (by_name and n.named) and not beside(n) and digest(n.path) not in unimportant
            return kept[n]

        return [t for node, t in found if all(map(stays, node.line()))]

    return "\n".join(left(True) or left(False) or [t for n, t in inside if chosen in n.line()])


def extract_text(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html", threshold: float = THRESHOLD, min_pages: int = MIN_PAGES) -> DataFrame:
    """``key``, ``url`` and ``text`` of every page.

    A NULL or empty page has the empty text. A NULL url or one without a host has no style tree, so only presentation
    decides. A host of fewer than ``min_pages`` pages gives no evidence. Repeated rows and keys stay as they are. An
    empty table gives an empty one. Other columns are not read.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), host_of(url).alias("host"), text_or_empty(page).alias("page"))
    noise = style_tree(pages, url, page).where((F.col("pages") >= min_pages) & (F.col("importance") < threshold)) \
        .groupBy("host").agg(F.collect_list("path").alias("noise"))
    # Written out, so that the planner knows its size: a small table is broadcast and no page is moved, a large one is joined by host.
    noise = stored(noise, "style-trees")
    joined = rows.join(noise, "host", "left").select("key", "url", "page", F.coalesce("noise", F.array().cast("array<bigint>")).alias("noise"))

    def run(batches):
        for batch in batches:
            texts, paths = batch.column(2), batch.column(3)
            for a, b in steps(pa.compute.binary_length(texts).to_pylist()):
                out = [main_text(p, set(n)) for p, n in zip(texts.slice(a, b - a).to_pylist(), paths.slice(a, b - a).to_pylist())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(out, pa.string())], ["key", "url", "text"])

    kind = pages.schema[key].dataType.simpleString()
    return map_batches(joined, run, f"key {kind}, url string, text string").select(F.col("key").alias(key), F.col("url").alias(url), "text")
