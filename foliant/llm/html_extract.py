"""HTML extraction with a site style tree.

*Tree.* The pages of a host are merged into one tree: a node is a path of tags with their
classes, whatever their names mean. A node's importance is half the entropy of its content
(the text below it on each page, relative to the most that so many pages allow, with one
page of other text added so that few equal pages prove little) and half the entropy of
its presentation (the styles of its children and the size of its own text, relative to
that of ``KINDS`` equally frequent ones).

*Main branch.* Menus, adverts and footers may read differently on every page, but they are
built alike; articles are not. So the outermost nodes of high importance that hold enough
of a host's text are the article, with the title beside it if an ``article`` element holds both.

*Cut branches.* Nodes that look and read alike on nearly every page are cut from it.

*Names.* Reader comments, forms, share buttons and the like differ as articles do; tags,
roles and class names, by fixed lists, take them out of the main branch. Where the tree
finds none (hosts with few pages, single pages of another build), names alone decide: what is in ``article``, else
in ``main``, else all that no name takes out.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, only

#: From this importance on a node is a main branch, if it holds this share of the host's text.
MOST_IMPORTANCE, LEAST_MASS = 0.85, 0.2
#: Below this importance a branch is cut.
LEAST_IMPORTANCE = 0.2
#: Weight of content against presentation; presentations that make a node fully important.
CONTENT, KINDS = 0.5, 8
#: Up to so many of these nodes are sent to every task; more are joined to the pages by host.
SENT = 50_000

# HTML's own names, and names that sites give to what isn't the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("body caption dd dt html legend li option tbody td tfoot th thead tr".split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "thead": ("caption",)}
SCOPES = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "tbody": ("table",), "tfoot": ("table",), "thead": ("table",), "option": ("select",)}
NOISE_TAGS = frozenset("head nav footer aside form script style noscript template iframe svg math canvas button select textarea input dialog menu object applet audio video map title".split())
NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense adslot sponsor sponsors sponsored promo promos promotion banner banners "
    "nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar sidebars rail aside footer footers footnav masthead topbar toolbar "
    "cookie cookies consent gdpr notice notices notification notifications alert alerts popup popups modal overlay lightbox "
    "newsletter newsletters subscribe subscription signup signin login register paywall "
    "share shares sharing social socials related recommended recommendations widget widgets comment comments commentlist disqus reply replies respond discussion "
    "search searchbox searchform pagination pager copyright disclaimer skip skiplink contentinfo complementary".split()
)
PAGE_HEADERS = frozenset(("header", "banner", "siteheader", "pageheader"))
NEVER_NOISE = frozenset(("html", "body", "article", "main"))
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

TOKEN = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][\w:.-]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: numbers in class names that count pages rather than styles
_DIGITS = re.compile(r"\d{3,}")
NAMES = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


class Node:
    """An open element. noise: by names; inside: an article, main or main branch; article: number of the outermost one."""

    __slots__ = ("tag", "path", "noise", "inside", "cut", "high", "article", "main")

    def __init__(self, tag: str, path: int, noise: bool, inside: bool, cut: bool, high: bool, article: int, main: bool) -> None:
        self.tag, self.path, self.noise, self.inside, self.cut, self.high, self.article, self.main = tag, path, noise, inside, cut, high, article, main


class Block(NamedTuple):
    text: str
    cut: bool
    high: bool
    article: int
    main: bool


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): references.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)} if text.strip(" /\n\t") else {}


def noisy(tag: str, given: dict[str, str], inside: bool) -> bool:
    """Is the element something else than the article, by its own name? inside: an article or main branch."""
    if tag in NEVER_NOISE and not inside:
        return False
    if tag in NOISE_TAGS or tag == "header" and not inside:
        return True
    if not given:
        return False
    if "hidden" in given or given.get("aria-hidden") == "true" or HIDDEN.search(given.get("style", "")):
        return True
    names = {n.lower() for k in ("class", "id", "role") if k in given for n in NAMES.findall(given[k])}
    return bool(names & NOISE_NAMES) or not inside and bool(names & PAGE_HEADERS)


class Page:
    """One pass over a page: its blocks of text, or with ``tree`` the nodes for the style tree."""

    def __init__(self, source: str, low: frozenset[int] | set[int] = frozenset(), high: frozenset[int] | set[int] = frozenset(), tree: bool = False) -> None:
        self.blocks: list[Block] = []
        self.styles: dict[int, int] = {}
        self.contents: dict[int, int] = {}
        self.sizes: dict[int, int] = {}
        self.own: dict[int, int] = {}
        self._low, self._high, self._tree, self._articles = low, high, tree, 0
        self._stack = [Node("", 0, False, False, False, False, 0, False)]
        self._text: list[str] = []
        self._parse(source)

    def _flush(self) -> None:
        if self._text:
            if text := " ".join("".join(self._text).split()):
                top = self._stack[-1]
                self.blocks.append(Block(text, top.cut, top.high, top.article, top.main))
            self._text = []

    def _words(self, raw: str) -> None:
        top = self._stack[-1]
        if self._tree:
            if not raw.isspace():
                text = " ".join((references.unescape(raw) if "&" in raw else raw).split())
                h = xxhash.xxh3_64_intdigest(text)
                for path in {n.path for n in self._stack}:
                    self.contents[path] = (self.contents.get(path, 0) * 0x9E3779B1 + h) & 0xFFFFFFFFFFFFFFFF
                    self.sizes[path] = self.sizes.get(path, 0) + len(text)
                self.own[top.path] = self.own.get(top.path, 0) + len(text)
        elif not top.noise:
            self._text.append(references.unescape(raw) if "&" in raw else raw)

    def _pop(self, at: int) -> None:
        if any(n.tag in BLOCKS for n in self._stack[at:]):
            self._flush()
        del self._stack[at:]

    def _close(self, tags: tuple[str, ...], scopes: tuple[str, ...]) -> None:
        """Ends the outermost open element of the tags within the scope."""
        found = None
        for k in range(len(self._stack) - 1, 0, -1):
            if self._stack[k].tag in tags:
                found = k
            elif self._stack[k].tag in scopes:
                break
        if found:
            self._pop(found)

    def _open(self, tag: str, given: dict[str, str], empty: bool) -> None:
        if tag in CLOSES_P:
            self._close(("p",), ("table", "td", "th", "button"))
        if tag in SIBLINGS:
            self._close(SIBLINGS[tag], SCOPES.get(tag, ()))
        if tag in BLOCKS:
            self._flush()
        top = self._stack[-1]
        style = f"{tag}.{'.'.join(sorted(_DIGITS.sub('0', given.get('class', '')).split()))}"
        path = xxhash.xxh3_64_intdigest(f"{top.path}/{style}")
        if self._tree:
            self.styles[top.path] = (self.styles.get(top.path, 0) * 0x85EBCA77 + xxhash.xxh3_64_intdigest(style)) & 0xFFFFFFFFFFFFFFFF
        if tag == "br":
            self._text.append("\n")
        if tag in VOID or empty:
            return
        noise = top.noise or noisy(tag, given, top.inside)
        high = top.high or path in self._high
        inside = top.inside or high or tag in ("article", "main") or given.get("role") in ("main", "article")
        article = top.article
        if tag == "article" and not article:
            self._articles += 1
            article = self._articles
        self._stack.append(Node(tag, path, noise, inside, top.cut or path in self._low, high, article, top.main or tag == "main"))

    def _parse(self, source: str) -> None:
        at = 0
        while (m := TOKEN.search(source, at)) is not None:
            if m.start() > at:
                self._words(source[at : m.start()])
            at = m.end()
            name = m[2] or m[5]
            if not name or at == len(source) and not m[0].endswith(">"):  # a comment, or a tag that never ends
                continue
            tag = name.lower()
            if m[1] or m[4]:
                for k in range(len(self._stack) - 1, 0, -1):
                    if self._stack[k].tag == tag:
                        self._pop(k)
                        break
                continue
            rest = m[3] if m[2] else m[6]
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = end.end() if end else len(source)
                continue
            self._open(tag, attributes(rest), rest.endswith("/") and tag not in BLOCKS)
        self._words(source[at:]) if at < len(source) else None
        self._flush()

    def text(self) -> str:
        """The main branch of the tree; without one the articles, else main, else all. Cut branches stay if nothing else is left."""
        around = {b.article for b in self.blocks if b.high and b.article}
        for part in ([b for b in self.blocks if b.high or b.article in around], [b for b in self.blocks if b.article], [b for b in self.blocks if b.main], self.blocks):
            if part:
                return "\n".join(b.text for b in ([b for b in part if not b.cut] or part))
        return ""

    def nodes(self) -> list[tuple[int, int, int, int]]:
        """(path, content, presentation, characters) of nodes with text; signed 64-bit numbers."""
        signed = lambda x: x - (1 << 64) if x >> 63 else x
        shown = lambda p: (self.styles.get(p, 0) * 0x9E3779B1 + self.own.get(p, 0).bit_length()) & 0xFFFFFFFFFFFFFFFF
        return [(signed(p), signed(v), signed(shown(p)), self.sizes[p]) for p, v in self.contents.items()]


def host_of(url):
    """The host in lower case without user and port; empty for null or what has none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("path", pa.int64()), ("content", pa.int64()), ("presentation", pa.int64()), ("size", pa.int64())]))
    for batch in batches:
        sources = batch.column(1).to_pylist()
        nodes = [[{"path": p, "content": c, "presentation": v, "size": n} for p, c, v, n in Page(s or "", tree=True).nodes()] for s in sources]
        pages = [xxhash.xxh3_128_digest((s or "").encode("utf-8", "surrogatepass")) for s in sources]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pages, pa.binary()), pa.array(nodes, kind)], ["host", "page", "nodes"])


def style_tree(pages: DataFrame) -> DataFrame:
    """host, path, pages, content, presentation, importance, mass: the nodes of every host's style tree.

    ``path`` 0 is the root. Copies of a page count once. Counts are combined before each
    shuffle, so a host with very many pages meets in no task.
    """
    rows = only(pages, url="string", html="string").select(host_of(F.col("url")).alias("host"), "html")
    each = rows.mapInArrow(_trees, "host string, page binary, nodes array<struct<path:bigint,content:bigint,presentation:bigint,size:bigint>>").dropDuplicates(["host", "page"])
    values = each.select("host", F.inline("nodes")).select("host", "path", F.inline(F.array(F.struct(F.lit(0).alias("kind"), F.col("content").alias("value"), "size"), F.struct(F.lit(1).alias("kind"), F.col("presentation").alias("value"), F.lit(0).cast("bigint").alias("size")))))
    counted = values.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    sums = counted.groupBy("host", "path").agg(
        F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("pages"),
        F.sum(F.when(F.col("kind") == 0, F.col("n") * F.log("n"))).alias("texts"),
        F.sum(F.when(F.col("kind") == 1, F.col("n") * F.log("n"))).alias("looks"),
        F.sum("size").alias("size"),
    )
    more = F.col("pages") + 1
    content = (F.log(more) - F.col("texts") / more) / F.log(more)
    presentation = F.least(F.lit(1.0), (F.log("pages") - F.col("looks") / F.col("pages")) / F.log(F.lit(KINDS)))
    whole = sums.filter("path = 0").select("host", F.col("size").alias("whole"))
    out = sums.join(whole, "host").select("host", "path", "pages", content.alias("content"), presentation.alias("presentation"), (F.col("size") / F.col("whole")).alias("mass"))
    return out.withColumn("importance", CONTENT * F.col("content") + (1 - CONTENT) * F.col("presentation"))


def _texts(batches: Iterator[pa.RecordBatch], known: dict[str, tuple[set[int], set[int]]] | None) -> Iterator[pa.RecordBatch]:
    """Columns page_id, url, host, html, and low, high if ``known`` is None."""
    nothing: tuple[set[int], set[int]] = (set(), set())
    for batch in batches:
        hosts, sources = batch.column(2).to_pylist(), batch.column(3).to_pylist()
        of = [known.get(h, nothing) for h in hosts] if known is not None else [(set(x or ()), set(y or ())) for x, y in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)]
        texts = [Page(s or "", *({p & 0xFFFFFFFFFFFFFFFF for p in x} for x in paths)).text() for s, paths in zip(sources, of, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])


def extract_pages(pages: DataFrame, least_importance: float = LEAST_IMPORTANCE, most_importance: float = MOST_IMPORTANCE, sent: int = SENT) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Null or empty html gives the empty text; pages without a url share the empty host;
    repeated rows give repeated rows; an empty table gives an empty table; other columns
    are ignored. If cutting by importance leaves a main branch no text at all, nothing is cut.
    Of several ``article`` elements outside a main branch all count.
    """
    spark = pages.sparkSession
    rows = only(pages, page_id="bigint", url="string", html="string").select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
    low, high = F.col("importance") < least_importance, (F.col("importance") >= most_importance) & (F.col("mass") >= LEAST_MASS)
    marked = materialise(style_tree(pages).filter((F.col("path") != 0) & (low | high)).select("host", "path", high.alias("high")), "style-tree")
    schema = "page_id bigint, url string, text string, n_chars bigint"
    if marked.count() <= sent:
        found: dict[str, tuple[set[int], set[int]]] = {}
        for r in marked.collect():  # at most ``sent`` rows
            found.setdefault(r.host, (set(), set()))[r.high].add(r.path)
        known = spark.sparkContext.broadcast(found)
        return rows.mapInArrow(lambda b: _texts(b, known.value), schema)
    of = marked.groupBy("host").agg(F.collect_set(F.when(~F.col("high"), F.col("path"))).alias("low"), F.collect_set(F.when(F.col("high"), F.col("path"))).alias("main"))
    return rows.join(of, "host", "left").select("page_id", "url", "host", "html", "low", "main").mapInArrow(lambda b: _texts(b, None), schema)
