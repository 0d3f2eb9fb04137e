"""Main text of web pages: pages of a host are merged into a style tree, and branches of low importance are taken out of each page."""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Scratch
from tidelog.llm.urls import host

# A branch goes if its importance (0 to 1) is below this, seen on so many different pages of its host.
LOW, PAGES = 0.2, 4
# How much a node's own style tells, the less the fewer styles its children come in.
DAMPING = 0.9
# Levels of blocks in a style tree: what lies deeper is content of the block at that level.
LEVELS = 12
SALTS = 8

# Elements of HTML by what they are.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td "
    "tfoot th thead tr ul button select noscript template object video audio canvas svg".split())
HEAD = frozenset("base link meta noscript script style template title head html".split())
NEVER_MAIN = frozenset("head nav footer aside dialog menu search button select noscript template object video audio canvas svg datalist".split())
# Start tags that close an open element of the given names, looked for up to an element of the second set.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)), "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot"), ("table",)), "thead": (("tbody", "thead", "tfoot"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot"), ("table",)), "option": (("option",), ("select", "optgroup")), "optgroup": (("optgroup",), ("select",)),
}
P_STAYS = frozenset("body head html td th caption option optgroup tr tbody thead tfoot button object select noscript template video audio canvas svg".split())
# Words of a class, id or role that name parts around the main text, and words that name the main text.
AROUND = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot banner promo promoted promotion sponsor sponsored sponsors nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs sidebar aside footer masthead copyright skip cookie cookies consent gdpr notice notices notification alert newsletter subscribe "
    "subscription signup login comment comments disqus respond reply replies share sharing social related recommended recommendations popup modal overlay "
    "toolbar pagination pager search complementary contentinfo dialog".split())
HEADER = frozenset("header".split())
MAIN = frozenset("article main content post entry story articlebody".split())

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_TELLING = re.compile(r"class|id|role|hidden|style", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _number(*parts) -> int:
    """A signed 64-bit number of the parts."""
    h = xxhash.xxh64_intdigest("\0".join(map(str, parts)).encode("utf-8", "surrogatepass"), 42)
    return h - (1 << 64) if h >> 63 else h


def _look(tag: str, attributes: str) -> tuple[str, bool, bool, bool, bool]:
    """(how an element is presented, whether its names tell of a part around the main text, of a header, of the main text, whether it is hidden)."""
    if not _TELLING.search(attributes):
        return tag, False, tag == "header", False, False
    found = {}
    for name, *values in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), unescape("".join(values)))
    names = " ".join(found.get(k, "") for k in ("class", "id", "role"))
    words = {w.lower() for w in _WORDS.findall(names)}
    hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(found.get("style", "")))
    shown = " ".join(sorted(_DIGITS.sub("", found.get("class", "")).split())) + "#" + _DIGITS.sub("", found.get("id", ""))
    headline = len(tag) == 2 and tag[0] == "h"
    return f"{tag}.{shown}", bool(words & AROUND), tag == "header" or bool(words & HEADER) and not headline, bool(words & MAIN), hidden


class Page:
    """The blocks of a page as a tree: elements in page order, and the text blocks with the element each is in."""

    def __init__(self, html: str):
        self.parent, self.tag, self.look = [-1], ["#page"], ["#page"]
        self.around, self.header, self.main, self.never = [False], [False], [False], [False]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters inside links
        # What each element holds, in order: elements as numbers, text as -1.
        self.children: list[list[int]] = [[]]
        self._parse(html)
        self._judge()

    def _parse(self, html: str) -> None:
        stack: list[tuple[str, int, bool]] = [("#page", 0, True)]  # tag, innermost block, whether a block
        opened: dict[str, int] = {}
        text: list[str] = []
        linked = 0
        skipping: list[int] = []  # stack heights of inline elements whose text is left out

        def flush():
            nonlocal linked
            words = " ".join("".join(text).split())
            text.clear()
            if words:
                at = stack[-1][1]
                self.blocks.append((at, words, min(linked, len(words))))
                if not self.children[at] or self.children[at][-1] != -1:
                    self.children[at].append(-1)
            linked = 0

        def add(chars: str):
            nonlocal linked
            if skipping:
                return
            if "&" in chars:
                chars = unescape(chars)
            if opened.get("head") and chars.strip():
                close("head")
            text.append(chars)
            if opened.get("a"):
                linked += len(chars.strip())

        def pop():
            tag, at, block = stack[-1]
            if block:
                flush()
            stack.pop()
            opened[tag] -= 1
            while skipping and skipping[-1] > len(stack):
                skipping.pop()

        def close(tag: str) -> None:
            while stack[-1][0] != tag:
                pop()
            pop()

        at, n = 0, len(html)
        while at < n:
            found = _TOKEN.search(html, at)
            if found is None:
                add(html[at:])
                break
            if found.start() > at:
                add(html[at:found.start()])
            at = found.end()
            name = found[2]
            if name is None:
                continue
            tag = name.lower()
            if found[1]:
                if tag == "br":
                    add(" ")
                elif opened.get(tag):
                    if tag not in BLOCK:
                        # A block left open inside keeps an inline element open.
                        up = len(stack) - 1
                        while stack[up][0] != tag and not stack[up][2]:
                            up -= 1
                        if stack[up][0] == tag:
                            close(tag)
                    elif tag not in ("body", "html"):
                        close(tag)
                continue
            if opened.get("head") and tag not in HEAD:
                close("head")
            if tag in RAW:
                end = re.compile(f"</{tag}(?=[\\s/>])[^>]*(?:>|\\Z)", re.I).search(html, at)
                at = end.end() if end else n
                continue
            if tag in ("br", "img", "wbr"):
                if tag == "br":
                    add(" ")
                continue
            if tag in ("html", "body") and opened.get(tag):
                continue
            if tag in BLOCK:
                if opened.get("p") and tag not in P_STAYS:
                    up = len(stack) - 1
                    while up and stack[up][0] not in ("p", "table", "td", "th", "caption", "button", "object", "template"):
                        up -= 1
                    if stack[up][0] == "p":
                        close("p")
                if tag in CLOSES:
                    names, bounds = CLOSES[tag]
                    if any(opened.get(x) for x in names):
                        up = len(stack) - 1
                        while up and stack[up][0] not in names and stack[up][0] not in bounds:
                            up -= 1
                        if stack[up][0] in names:
                            close(stack[up][0])
                flush()
                if tag in VOID:
                    continue
                look, around, header, main, hidden = _look(tag, found[3])
                up, new = stack[-1][1], len(self.tag)
                self.parent.append(up)
                self.tag.append(tag)
                self.look.append(look)
                self.around.append(around)
                self.header.append(header)
                self.main.append(main)
                self.never.append(hidden or tag in NEVER_MAIN)
                self.children.append([])
                self.children[up].append(new)
                stack.append((tag, new, True))
                opened[tag] = opened.get(tag, 0) + 1
            elif tag not in VOID:
                _, around, _, _, hidden = _look(tag, found[3])
                stack.append((tag, stack[-1][1], False))
                opened[tag] = opened.get(tag, 0) + 1
                if around or hidden:
                    skipping.append(len(stack))
        while len(stack) > 1:
            pop()
        flush()

    def _judge(self) -> None:
        """Which elements the page's own marks take out, and where its main text is."""
        n = len(self.tag)
        parts = [t in ("article", "main") for t in self.tag]
        named = [m and not a for m, a in zip(self.main, self.around)]
        # A form or a part with a misleading name may wrap a whole page: if nothing is left, what holds the main part is spared.
        for spared in ([False] * n, parts, [p or m for p, m in zip(parts, named)]):
            self._take_out(parts, spared)
            self._choose(parts)
            if self.kept:
                return
        self._take_out(parts, [False] * n)
        self._choose(parts)

    def _take_out(self, parts: list[bool], spared: list[bool]) -> None:
        n = len(self.tag)
        holds = list(spared)
        for e in range(n - 1, 0, -1):
            holds[self.parent[e]] |= holds[e]
        self.out, inside = [False] * n, [False] * n
        for e in range(1, n):
            up = self.parent[e]
            inside[e] = inside[up] or parts[e]
            # The header of an article has its headline.
            beside = self.around[e] and self.tag[e] not in ("body", "html") or self.tag[e] == "form" or self.header[e] and not inside[e]
            self.out[e] = self.out[up] or self.never[e] or (beside and not holds[e])

    def _choose(self, parts: list[bool]) -> None:
        """The region of the main text and its blocks."""
        n = len(self.tag)
        region = [parts[e] and not self.out[e] for e in range(n)]
        self.marked = any(region)
        if not self.marked:
            size, links, linked = [0] * n, [0] * n, [0] * n
            for e, text, chars in self.blocks:
                if not self.out[e]:
                    size[e] += len(text)
                    links[e] += chars
                    linked[e] += chars > 0
            for e in range(n - 1, 0, -1):
                up = self.parent[e]
                size[up] += size[e]
                links[up] += links[e]
                linked[up] += linked[e]
            region = [self.main[e] and not self.out[e] and size[0] <= 2 * size[e] for e in range(n)]
            if not any(region):
                region[0] = True
            # Lists of links are menus, outside marked articles.
            for e in range(1, n):
                self.out[e] = self.out[e] or self.out[self.parent[e]] or (linked[e] >= 3 and links[e] >= 0.8 * size[e])
        for e in range(1, n):
            region[e] = region[e] or region[self.parent[e]]
        self.kept = [(e, text) for e, text, _ in self.blocks if region[e] and not self.out[e]]

    def tree(self, host: str):
        """Numbers of the page's places in the style tree of its host.

        Gives (nodes, styles, contents): nodes (node, style above, level) and styles (node, style)
        as sets of rows, and for every kept block the nodes it lies in and the number of its content. A style
        is the sequence of what an element holds, like neighbours told once; a node is a place in a style.
        """
        nodes, styles = set(), set()
        place: dict[int, tuple[int, int]] = {0: (_number(host), 0)}
        nodes.add((place[0][0], 0, 0))
        leaf: dict[int, int] = {}
        for e, held in enumerate(self.children):
            if e not in place:
                if self.parent[e] in leaf or self.out[self.parent[e]]:
                    leaf[e] = leaf.get(self.parent[e], 0)
                continue
            node, level = place[e]
            looks: list[str] = []
            at = []
            for c in held:
                look = self.look[c] if c >= 0 else "#text"
                if not looks or looks[-1] != look:
                    looks.append(look)
                at.append(len(looks) - 1)
            if self.out[e]:
                leaf[e] = 0
                continue
            if level == LEVELS or looks in ([], ["#text"]):
                leaf[e] = node
                continue
            style = _number(node, *looks)
            styles.add((node, style))
            for c, k in zip(held, at):
                below = _number(style, k)
                nodes.add((below, style, level + 1))
                if c >= 0:
                    place[c] = below, level + 1
                else:
                    leaf[e] = below
        contents = []
        for e, text in self.kept:
            node = leaf[e]
            path = [node]
            while e >= 0:
                if e in place:
                    path.append(place[e][0])
                e = self.parent[e]
            contents.append((path, _number(node, _DIGITS.sub("0", text)), node))
        return nodes, styles, contents


NODE, STYLE, CONTENT = 0, 1, 2
MARKS = "row long, page long, kind int, node long, above long, level int, item long"


def _marks(rows):
    """Rows of MARKS of every page with a host: pages of equal kept text are one ``page``."""
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
    names = [part.split()[0] for part in MARKS.split(", ")]
    for batch in rows:
        out = []
        for row, host, html in zip(*(batch.column(c).to_pylist() for c in ("row", "host", "html"))):
            if host:
                page = Page(html)
                nodes, styles, contents = page.tree(host)
                name = _number(host, *[text for _, text in page.kept])
                out += [(row, name, NODE, node, above, level, node) for node, above, level in nodes]
                out += [(row, name, STYLE, node, 0, 0, style) for node, style in styles]
                out += [(row, name, CONTENT, node, 0, 0, item) for item, node in {(item, node) for _, item, node in contents}]
        columns = zip(*out) if out else [[] for _ in names]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _importance(scratch: Scratch, marks: DataFrame) -> DataFrame:
    """(key) of the nodes and contents of low importance on their hosts.

    A node's own importance is the entropy of its styles over the m pages that have it, to base m; that of
    a content 1 minus the entropy of its pages, log_m(pages with it). A node that holds only
    text has the mean of its contents. Others mix their own importance with that of their styles
    (the mean of the nodes in them), from the lowest level up: the more styles, the more their own tells.
    """
    counts = scratch.store(marks.groupBy("kind", "node", "item").agg(
        F.count_distinct("page").alias("c"), F.max("above").alias("above"), F.max("level").alias("level")), "counts")

    def of(kind: int, value: Column) -> Column:
        return F.when(F.col("kind") == kind, value)

    c = F.col("c").cast("double")
    nodes = counts.groupBy("node").agg(
        F.max(of(NODE, F.col("c"))).alias("m"), F.max(of(NODE, F.col("above"))).alias("above"), F.max(of(NODE, F.col("level"))).alias("level"),
        F.count(of(STYLE, c)).alias("styles"), F.sum(of(STYLE, c)).alias("total"), F.sum(of(STYLE, c * F.ln(c))).alias("weighed"),
        F.avg(of(CONTENT, F.ln(c))).alias("repeated"))
    base = F.ln(F.col("m").cast("double"))
    own = F.when(F.col("m") == 1, 1.0).otherwise(F.least(F.lit(1.0), (F.ln("total") - F.col("weighed") / F.col("total")) / base))
    text = F.when(F.col("m") == 1, 1.0).otherwise(1 - F.col("repeated") / base)
    nodes = scratch.store(nodes.select("node", "m", "above", "level", "styles", "total", own.alias("own"), text.alias("text")), "nodes")
    deepest = nodes.agg(F.max("level")).first()[0]
    below, levels = None, []
    for level in range(-1 if deepest is None else deepest, -1, -1):
        here = nodes.where(f"level = {level}")
        if below is None:
            mixed = here.withColumn("lower", F.lit(None).cast("double"))
        else:
            styles = counts.where(f"kind = {STYLE}").select("node", F.col("item").alias("above"), "c")
            means = below.groupBy("above").agg(F.avg("importance").alias("mean"))
            lower = styles.join(means, "above").groupBy("node").agg((F.sum(F.col("c") * F.col("mean")) / F.sum("c")).alias("lower"))
            mixed = here.join(lower, "node", "left")
        damped = F.pow(F.lit(DAMPING), F.col("styles"))
        # A node without any content on any page tells nothing.
        inner = (1 - damped) * F.col("own") + damped * F.coalesce("lower", F.lit(1.0))
        value = F.when(F.col("styles") > 0, inner).otherwise(F.coalesce("text", F.lit(1.0)))
        below = scratch.store(mixed.select("node", "above", "m", value.alias("importance")), f"level-{level}")
        levels.append(below)
    contents = counts.where(f"kind = {CONTENT} AND c > 1").join(nodes.where(f"m >= {PAGES}").select("node", "m"), "node")
    low = contents.where(1 - F.ln(c) / base < LOW).select(F.col("item").alias("key"))
    for found in levels:
        low = low.union(found.where(f"m >= {PAGES} AND importance < {LOW}").select(F.col("node").alias("key")))
    return low.distinct()


def main_text(html: str, host: str, low: set[int]) -> str:
    """The kept blocks of a page but those in places of ``low``.

    Low places tell nothing where they are all there is: a page keeps them if no other text would stay, and a
    marked article keeps them if most of it would go.
    """
    page = Page(html)
    texts = [text for _, text in page.kept]
    if low:
        stays = [item not in low and not any(node in low for node in path) for path, item, _ in page.tree(host)[2]]
        total, left = sum(map(len, texts)), sum(len(t) for t, s in zip(texts, stays) if s)
        if left and (not page.marked or 2 * left >= total):
            texts = [t for t, s in zip(texts, stays) if s]
    return " ".join(texts)


def _packed(rows):
    for batch in rows:
        packed = [pa.compress(html.encode("utf-8", "surrogatepass"), "zstd", asbytes=True) for html in batch.column("html").to_pylist()]
        sizes = [len(html.encode("utf-8", "surrogatepass")) for html in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("row", "page_id", "url", "host")), pa.array(packed, pa.binary()), pa.array(sizes, pa.int64())],
                                         ["row", "page_id", "url", "host", "packed", "size"])


def _extracted(rows):
    for batch in rows:
        texts = []
        for host, packed, size, keys in zip(*(batch.column(c).to_pylist() for c in ("host", "packed", "size", "keys"))):
            html = pa.decompress(packed, size, "zstd", asbytes=True).decode("utf-8", "surrogatepass") if size else ""
            texts.append(main_text(html, host or "", set(keys or ())).encode("utf-8", "replace"))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.binary()).cast(pa.string())],
                                         ["page_id", "url", "text"])


def extract(pages: DataFrame, name: str = "pages") -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages`` (page_id, url, html): the main text, blocks joined by one space.

    Scripts, styles, comments, menus, footers, sidebars, forms, hidden parts and parts whose class, id or role says
    that they are beside the matter go; where a page marks its article or main part, what is outside goes
    too. Of the rest, branches whose style and content are the same on most pages of the host have low
    importance and go. Copies of a page count once, and hosts with fewer than PAGES different
    pages decide by their own marks alone. Null html is empty, an empty page or one without main text gives an empty text,
    a null url has no host. Repeated rows each give a row; other columns are ignored; an empty
    table gives no rows. Broken markup is read as browsers do: missing end tags are implied, a ``<`` before no name is text.
    """
    rows = pages.select("page_id", "url", host(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.select(F.xxhash64("page_id", "url", "html").alias("row"), "page_id", "url", "host", "html")
    scratch = Scratch(pages.sparkSession, name)
    marks = rows.select("row", "host", "html").mapInArrow(_marks, MARKS)
    low = scratch.store(_importance(scratch, marks), "low")
    # One low node of a large host is in all its pages: they meet it in several parts.
    spread = low.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    keys = marks.where(f"kind != {STYLE}").select("row", F.col("item").alias("key"), F.pmod("row", F.lit(SALTS)).cast("int").alias("salt"))
    hits = keys.join(spread, ["key", "salt"]).groupBy("row").agg(F.collect_set("key").alias("keys"))
    id_type = pages.schema["page_id"].dataType.simpleString()
    packed = rows.mapInArrow(_packed, f"row long, page_id {id_type}, url string, host string, packed binary, size long")
    found = packed.join(hits, "row", "left").mapInArrow(_extracted, f"page_id {id_type}, url string, text string")
    return found.withColumn("n_chars", F.length("text").cast("long"))
