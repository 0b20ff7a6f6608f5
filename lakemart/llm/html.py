"""Main text of web pages by wrapper induction.

Pages of one host are aligned with a reference page of that host by simple tree matching, which pairs as many nodes as
possible without changing order or ancestry. Over all pages of the host, aligned text that hardly ever changes is
template; text that varies is a slot. Pages with the same content text are copies and count as one page. A page's text is what it has in slots and outside the alignment, within its
content region and without the parts that its markup names as menus, headers, footers, sidebars, notices, adverts,
forms or comments. Within a region that the page itself marks as article, text counts as template only on strong
evidence: the same on every one of many pages.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import blake2b
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.urls import host_and_path
from lakemart.session import apply_defaults, materialize

# Template outside of a marked article: the same text on this share of at least so many pages; inside: on all of so many.
TEMPLATE_SHARE, TEMPLATE_PAGES = 0.9, 5
ARTICLE_TEMPLATE_PAGES = 30
DEEPEST = 200
CACHED_HOSTS = 64

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME_PART = re.compile(r"[a-z]+")
_NAME = re.compile(r"[^\s]+")
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
DROPPED = frozenset("head script style noscript template iframe svg math nav footer aside form button select textarea input dialog menu object canvas audio video".split())
CLOSED_BY_BLOCK = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"})}
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Parts of class names and ids. The first mark their element whatever else it is called, the second unless it is content.
BOILERPLATE = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs footer sidebar aside ad ads advert adverts advertisement advertising banner sponsor sponsored "
    "promo promoted notice cookie cookies consent gdpr popup newsletter subscribe signup login share sharing social related recommended pagination "
    "pager comment comments commentlist commentary disqus replies reply respond form search copyright masthead skip toc disclaimer".split()
)
# A name that begins so tells of an element's state, not of what it is: "has-comments", "no-sidebar".
STATES = frozenset("has no not with without is".split())
# These mark a compound name only before the name of a part of a page: "search-form", but not "search-results".
AMBIGUOUS = frozenset("social search".split())
PARTS = frozenset("area bar block box buttons container field form icons input items links list media menu nav section share widget wrapper".split())
WEAK_BOILERPLATE = frozenset("header widget modal overlay alert toast toolbar dialog top bottom".split())
CONTENT = frozenset("article content main post entry body story text title headline".split())


class _Node:
    __slots__ = ("tag", "children", "shape", "size", "text", "dropped", "region", "number", "block")

    def __init__(self, tag: str):
        self.tag, self.children, self.text = tag, [], None
        self.shape = self.size = self.number = 0
        self.dropped = False
        self.region = self.block = 0


def _marks(name: str) -> set[str]:
    """The words of one class name or id that may mark an element."""
    parts = _NAME_PART.findall(name)
    if len(parts) > 1 and parts[0] in STATES:
        return set()
    return {p for i, p in enumerate(parts) if p not in AMBIGUOUS or len(parts) == 1 or i == len(parts) - 1 or set(parts[i + 1 :]) & (PARTS | BOILERPLATE)}


def _named(attributes: str, tag: str = "div") -> tuple[bool, bool, bool]:
    """Whether an element's class, id or role mark it as boilerplate, and as content or as the main region.

    An article or a main region is boilerplate only if a whole name says so.
    """
    if "=" not in attributes:
        return False, False, False
    names, role = [], ""
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            names += _NAME.findall((a or b or c).lower())
        elif name.lower() == "role":
            role = (a or b or c).strip().lower()
    words = set().union(*map(_marks, names))
    is_main = role in ("main", "article")
    content = bool(set().union(*map(set, map(_NAME_PART.findall, names))) & CONTENT)
    if is_main or tag in ("article", "main"):
        bad = bool(set(names) & BOILERPLATE)
    else:
        bad = bool(words & BOILERPLATE) or (not content and bool(words & WEAK_BOILERPLATE))
    return role in ROLES or bad, content, is_main


def parse(html: str) -> tuple[_Node, list[_Node]]:
    """The page's tree and its text nodes in order.

    Unclosed and stray tags are repaired as browsers do in the common cases. Below ``DEEPEST`` levels further elements
    are not nested, so a page of any depth is safe; their text is kept.
    """
    root = _Node("#root")
    # Of each open element: its node, tag, whether its text is dropped, its article, its main region, its content region.
    stack: list[tuple] = [(root, "#root", False, 0, 0, 0)]
    texts: list[_Node] = []
    block, regions, position = 0, 0, 0

    def add_text(raw: str) -> None:
        parent, _, dropped, article, main, content = stack[-1]
        node = _Node("#text")
        node.text, node.dropped, node.block = unescape(raw), dropped, block
        node.region = (article, main, content)
        parent.children.append(node)
        texts.append(node)

    def close(tag: str, barriers: frozenset | set = frozenset()) -> bool:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][1] == tag:
                del stack[depth:]
                return True
            if stack[depth][1] in barriers:
                return False
        return False

    while position < len(html):
        found = _TOKEN.search(html, position)
        if found is None:
            add_text(html[position:])
            break
        if found.start() > position:
            add_text(html[position : found.start()])
        position = found.end()
        slash, tag, attributes = (found[1], found[2], found[3]) if found[2] else (found[4], found[5], found[6])
        if tag is None:
            continue
        tag = tag.lower()
        if tag not in INLINE:
            block += 1
        if slash:
            close(tag, {"table"} if tag not in ("table", "body", "html", "article", "main", "div", "section") else frozenset())
            continue
        if tag in CLOSED_BY_BLOCK:
            close("p", {"table", "td", "th", "button", "li", "div", "article", "section", "blockquote"})
        if tag in CLOSES:
            for name in CLOSES[tag][0].split():
                close(name, CLOSES[tag][1])
        if tag == "body":
            close("head")
        parent, _, dropped, article, main, content = stack[-1]
        bad, is_content, is_main = _named(attributes, tag)
        heading_header = tag == "header" and article
        dropped = dropped or tag in DROPPED or (tag == "header" and not heading_header) or (bad and tag not in ("html", "body"))
        if heading_header and not dropped:
            dropped = True  # its headings are taken back below
        if stack[-1][1] == "header" and article and tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
            dropped = any(open_[2] for open_ in stack[:-1])
        regions += 1
        if not dropped:
            article = article or (regions if tag == "article" else 0)
            main = main or (regions if tag == "main" or is_main else 0)
            content = content or (regions if is_content and tag in ("div", "section", "td") else 0)
        node = _Node(tag)
        if len(stack) < DEEPEST:
            parent.children.append(node)
        else:
            node = parent
        if tag in VOID or attributes.endswith("/") and tag not in ("p", "div", "article", "section", "span", "b", "i", "a"):
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(html, position)
            position = end.end() if end else len(html)
            continue
        stack.append((node, tag, dropped, article, main, content))
    _measure(root)
    for number, text in enumerate(texts):
        text.number = number
    return root, texts


def _measure(root: _Node) -> None:
    """Shape and number of nodes of every subtree, children before parents."""
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting.extend(node.children)
    for node in reversed(order):
        node.size = 1 + sum(child.size for child in node.children)
        node.shape = hash((node.tag, tuple(child.shape for child in node.children)))


def _same(a: _Node, b: _Node) -> bool:
    return a.shape == b.shape and a.tag == b.tag and a.size == b.size


def _weight(a: _Node, b: _Node, known: dict) -> int:
    """Largest number of node pairs between two trees (simple tree matching)."""
    if a.tag != b.tag:
        return 0
    if _same(a, b):
        return a.size
    key = (id(a), id(b))
    if key not in known:
        known[key] = 1 + sum(w for _, _, w in _children(a.children, b.children, known))
    return known[key]


def _children(left: list[_Node], right: list[_Node], known: dict) -> list[tuple[_Node, _Node, int]]:
    """Pairs of children that together match most; equal beginnings and ends are paired at once."""
    first = 0
    while first < min(len(left), len(right)) and _same(left[first], right[first]):
        first += 1
    last = 0
    while last < min(len(left), len(right)) - first and _same(left[-1 - last], right[-1 - last]):
        last += 1
    pairs = [(a, b, a.size) for a, b in zip(left[:first], right[:first], strict=True)]
    ends = [(a, b, a.size) for a, b in zip(left[len(left) - last :], right[len(right) - last :], strict=True)]
    a, b = left[first : len(left) - last], right[first : len(right) - last]
    if a and b:
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        own = [[_weight(x, y, known) for y in b] for x in a]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + own[i][j] if own[i][j] else 0)
        i, j, middle = len(a), len(b), []
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                middle.append((a[i], b[j], own[i][j]))
        pairs += reversed(middle)
    return pairs + ends


def align(page: _Node, reference: _Node) -> Iterator[tuple[_Node, _Node]]:
    """Pairs of aligned text nodes of two pages."""
    known: dict = {}
    waiting = [(page, reference)]
    while waiting:
        a, b = waiting.pop()
        if a.tag == "#text":
            yield a, b
        waiting.extend((x, y) for x, y, _ in _children(a.children, b.children, known))


def _clean(text: str) -> str:
    return " ".join(text.split())


def main_text(texts: list[_Node], template: set[int]) -> str:
    """The text of a page's content region, block by block, without the nodes in ``template``."""
    kept = [t for t in texts if not t.dropped and t.number not in template]
    for kind in range(3):  # a marked article, else a main region, else one named as content
        sizes: dict[int, int] = {}
        for t in kept:
            if t.region[kind] and t.text.strip():
                sizes[t.region[kind]] = sizes.get(t.region[kind], 0) + len(_clean(t.text))
        if sizes:
            largest = max(sizes, key=lambda r: (sizes[r], -r))
            kept = [t for t in kept if t.region[kind] == largest]
            break
    blocks: dict[int, list[str]] = {}
    for t in kept:
        blocks.setdefault(t.block, []).append(t.text)
    return " ".join(filter(None, (_clean("".join(parts)) for parts in blocks.values())))


def _cached(cache: dict, html: str):
    if html not in cache:
        if len(cache) >= CACHED_HOSTS:
            cache.clear()
        cache[html] = parse(html)
    return cache[html]


def _references(pages: DataFrame) -> DataFrame:
    """``host, reference``: the page of each host with the smallest hash."""
    chosen = materialize(pages.groupBy("host").agg(F.min("hash").alias("hash")), "page_chosen")
    return materialize(pages.join(chosen, ["host", "hash"]).groupBy("host").agg(F.min("html").alias("reference")), "page_references")


def _counted(pages: DataFrame) -> DataFrame:
    """``host, number, n, same``: pages aligned to each text node of the reference, and those that have the same text.

    Pages of a host whose content regions have the same text prove nothing about each other and count once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            pages_seen: dict[tuple[str, bytes], list[int]] = {}
            for host, html, reference in zip(*(batch.column(c).to_pylist() for c in ("host", "html", "reference")), strict=True):
                if not html.strip() or not reference.strip():
                    continue
                root, texts = parse(html)
                key = (host, blake2b(main_text(texts, set()).encode("utf-8", "surrogatepass"), digest_size=16).digest())
                # A text node of the reference is twice its number, plus one if it is the same here.
                seen = sorted(2 * other.number + (_clean(mine.text) == _clean(other.text)) for mine, other in align(root, _cached(cache, reference)[0]) if other.text.strip())
                pages_seen[key] = max(pages_seen.get(key, seen), seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in pages_seen], pa.string()), pa.array([k[1] for k in pages_seen], pa.binary()), pa.array(list(pages_seen.values()), pa.list_(pa.int32()))],
                ["host", "content", "seen"],
            )

    distinct = pages.mapInArrow(run, "host string, content binary, seen array<int>").groupBy("host", "content").agg(F.max("seen").alias("seen"))
    nodes = distinct.select("host", F.explode("seen").alias("node")).select("host", F.expr("node div 2").cast("int").alias("number"), (F.col("node") % 2).alias("same"))
    return nodes.groupBy("host", "number").agg(F.count("*").alias("n"), F.sum("same").alias("same"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row ``id, url, text, n_chars`` per input row, from its whole HTML.

    Character references are decoded, white space within a block is one space, blocks follow each other with one space
    between. A null or empty page, or one without content, has the empty text; pages without a host in their URL are
    aligned with each other; repeated rows are judged alike and are evidence of template only once, null ids are passed on, other columns are ignored and an
    empty table gives an empty result.
    """
    apply_defaults(pages.sparkSession)
    html = F.coalesce(F.col(html_col), F.lit(""))
    source = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), html.alias("html"), host_and_path(F.col(url_col))[0].alias("host"))
    source = source.withColumn("hash", F.xxhash64("html"))
    references = _references(source)
    steady = materialize(
        _counted(source.select("host", "html").join(references, "host")).where((F.col("n") >= TEMPLATE_PAGES) & (F.col("same") >= TEMPLATE_SHARE * F.col("n")))
        .groupBy("host").agg(F.collect_list(F.struct("number", (F.col("same") == F.col("n")).alias("always"), "n")).alias("steady")),
        "page_templates",
    )
    wrappers = materialize(references.join(steady, "host", "left"), "page_wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for batch in batches:
            made = []
            for html, reference, steady in zip(*(batch.column(c).to_pylist() for c in ("html", "reference", "steady")), strict=True):
                root, texts = parse(html)
                template: set[int] = set()
                if steady:
                    known = {s["number"]: s["always"] and s["n"] >= ARTICLE_TEMPLATE_PAGES for s in steady}
                    for mine, other in align(root, _cached(cache, reference)[0]):
                        if other.number in known and _clean(mine.text) == _clean(other.text) and (known[other.number] or not mine.region[0]):
                            template.add(mine.number)
                made.append(main_text(texts, template))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url"), pa.array(made, pa.string()), pa.array([len(m) for m in made], pa.int64())], [id_col, "url", "text", "n_chars"])

    joined = source.select("id", "url", "html", "host").join(wrappers, "host").drop("host")
    return joined.mapInArrow(run, f"`{id_col}` {pages.schema[id_col].dataType.simpleString()}, url string, text string, n_chars long")
