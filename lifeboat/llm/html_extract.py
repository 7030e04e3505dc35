"""Main text of web pages by wrapper induction.

Pages of one host are made by one template. Each page's DOM tree is aligned
with its host's reference page by simple tree matching (the largest mapping of equal nodes that keeps
order and parents). Children are aligned in linear space, so memory grows with a page's size only; the time of that step
grows with the product of the two nodes' differing children. A reference node whose own text is the same on nearly all
aligned pages is template; a node whose text varies, or that the reference
lacks, is a slot and its text is content. What a page's own markup says stays
out in any case: menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and reader comments.

An ``article`` or ``main`` element is content by declaration, unless all its text is links (a teaser). With ``firm_pages``
votes a block of constant nodes is template inside it, too (a constant word in a line that varies is not), and one varying paragraph
outside goes with the article if neither it nor its parent has a sibling like it (lists of other stories do). Where the template leaves
nothing of the declared articles, or none is declared, the slots of the rest of the page are its content. No rule compares lengths.

Each page is parsed and aligned once. The pass leaves the reference node of each
part of the page's text; those are counted by (host, node), combined map-side,
so a host with a third of all pages is a few hundred rows. A second pass takes
out what is template. The reference of a host is its first page.

Defined results: null html gives an empty text; a null or odd URL belongs to
the host ''; a host with fewer than ``least_pages`` pages has no template;
repeated rows are aligned one by one; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lifeboat.llm.common import map_columns, numbered, stage

# Fixed values of the HTML standard: elements without content, elements whose
# content is not markup, and elements that end a paragraph or a like block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp template".split())
BLOCK = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol option p pre section summary
table tbody td tfoot th thead tr ul""".split())
# A start tag of the key closes an open element of the value's names.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
ENDS_P = BLOCK - {"body", "head", "html", "option", "td", "th", "tr", "tbody", "thead", "tfoot"}
# Elements and class or id words that are never article text.
APART = frozenset("nav header footer aside form script style noscript iframe template button select textarea title head menu dialog svg".split())
# Class words that make an article element something else than the page's article.
APART_ARTICLE = frozenset("ad ads advert sponsored promo related recommended comment comments reply replies".split())
# Compounds with these words speak about the page (has-sidebar) or the article (entry-header).
NOT_APART = frozenset("no not without has have with article post entry content story body text main page single".split())
APART_ROLE = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
APART_WORD = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner
nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside related recommended
widget notice notices cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup
login share sharing social comment comments disqus reply replies respond form search pagination pager""".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")
_PART = re.compile(r"[^a-z0-9]+")


class Node:
    """An element, or a run of text (tag '#'). ``key`` is what two nodes must share to be aligned."""

    __slots__ = ("tag", "key", "kids", "text", "apart")

    def __init__(self, tag: str, key: str, text: str = "", apart: bool = False):
        self.tag, self.key, self.text, self.apart, self.kids = tag, key, text, apart, []


def _is_apart(word: str) -> bool:
    if word in APART_WORD:
        return True
    parts = [x for x in _PART.split(word) if x]
    return not APART_WORD.isdisjoint(parts) and NOT_APART.isdisjoint(parts)


def _element(tag: str, attrs: str) -> Node:
    key, apart = tag, tag in APART
    if attrs and not attrs.isspace():
        for name, a, b, c in _ATTR.findall(attrs):
            name = name.lower()
            if name in ("class", "id"):
                value = (a or b or c).lower()
                key += f"|{name}={value}"
                if tag in ("article", "main"):
                    apart = apart or not APART_ARTICLE.isdisjoint(x for w in value.split() for x in (w, *_PART.split(w)))
                elif tag not in ("html", "body"):       # a page's own class says nothing about its text
                    apart = apart or any(map(_is_apart, value.split()))
            elif name == "role":
                apart = apart or (a or b or c).lower() in APART_ROLE
            elif name == "hidden" or name == "aria-hidden" and (a or b or c).lower() == "true":
                apart = True
    return Node(tag, key, apart=apart)


def parse(page: str) -> Node:
    """The page's tree; tags left open are closed as browsers do."""
    root = Node("", "")
    stack, at, low = [root], 0, None

    def text(s: str) -> None:
        if s:
            stack[-1].kids.append(Node("#", "#", entities.unescape(s)))

    end = len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if m[1]:
            if tag in BLOCK and tag != "p":             # a block's end closes what is open inside it
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        break
            else:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        del stack[k:]
                        break
                    if stack[k].tag in BLOCK and (tag == "p" or stack[k].tag != "p"):
                        break
            if tag == "br":
                stack[-1].kids.append(Node("br", "br"))
            continue
        if tag in ENDS_P:                               # a block ends an open paragraph
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    del stack[k:]
                    break
                if stack[k].tag in BLOCK:
                    break
        if tag in CLOSES:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in CLOSES[tag]:
                    del stack[k:]
                    break
                if stack[k].tag in ("ul", "ol", "dl", "table", "select", "div", "article", "section"):
                    break
        node = _element(tag, m[3])
        stack[-1].kids.append(node)
        if tag in VOID or m[3].endswith("/") and tag in ("svg", "path"):
            continue
        if tag in RAW:
            low = page.lower() if low is None else low
            if len(low) != end:                         # lower case changed a length: look in the page itself
                found = re.compile(f"</{tag}", re.I).search(page, at)
                close = found.start() if found else -1
            else:
                close = low.find(f"</{tag}", at)
            at = end if close < 0 else (page.find(">", close) + 1 or end)
            continue
        stack.append(node)
    return root


def _flat(root: Node) -> list[Node]:
    out, todo = [], [root]
    while todo:
        n = todo.pop()
        out.append(n)
        todo.extend(reversed(n.kids))
    return out


class Shapes:
    """Numbers of tree shapes (keys only, no text): nodes of equal number have equal trees below them."""

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.key: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.size: list[int] = []
        self.known: dict[tuple[int, int], int] = {}

    def of(self, nodes: list[Node]) -> dict[int, int]:
        """id of each node -> its shape's number; ``nodes`` has parents before children."""
        out: dict[int, int] = {}
        for n in reversed(nodes):
            kids = tuple([out[id(k)] for k in n.kids])
            shape = (n.key, kids)
            got = self.number.get(shape)
            if got is None:
                got = self.number[shape] = len(self.key)
                self.key.append(n.key)
                self.kids.append(kids)
                self.size.append(1 + sum(self.size[k] for k in kids))
            out[id(n)] = got
        return out

    def value(self, a: int, b: int) -> int:
        """Pairs of the largest mapping of two shapes that maps their roots; 0 if the roots' keys differ."""
        if a == b:
            return self.size[a]
        if self.key[a] != self.key[b]:
            return 0
        got = self.known.get((a, b))
        if got is None:
            x, y = self.kids[a], self.kids[b]
            i, m, n = common_ends(x, y)
            got = 1 + sum(self.size[k] for k in x[:i]) + sum(self.size[k] for k in x[m:])
            if i < m and i < n:
                got += int(last_row(self, x[i:m], y[i:n])[-1])
            self.known[a, b] = got
        return got


def common_ends(x, y) -> tuple[int, int, int]:
    """(i, m, n): x[:i] equals y[:i], x[m:] equals y[n:]. Pairing equal shapes at the ends is part of some largest mapping."""
    m, n, i = len(x), len(y), 0
    while i < m and i < n and x[i] == y[i]:
        i += 1
    while m > i and n > i and x[m - 1] == y[n - 1]:
        m, n = m - 1, n - 1
    return i, m, n


def _weights(shapes: Shapes, x, y) -> Iterator[np.ndarray]:
    """Per child of x its values with all of y; children of one shape share them."""
    kinds, which = np.unique(np.array(y), return_inverse=True)
    by_key: dict[str, list[int]] = {}
    for j, k in enumerate(kinds.tolist()):
        by_key.setdefault(shapes.key[k], []).append(j)
    rows: dict[int, np.ndarray | None] = {}
    none = np.zeros(len(y), np.int64)
    for k in x:
        if k not in rows:
            value = np.zeros(len(kinds), np.int64)
            near = by_key.get(shapes.key[k], ())
            for j in near:
                value[j] = shapes.value(k, int(kinds[j]))
            rows[k] = value if near else None
        yield none if rows[k] is None else rows[k][which]


def last_row(shapes: Shapes, x, y) -> np.ndarray:
    """Largest sums of values of order-keeping pairs of all of x with y[:j], j = 0.. (one row of memory)."""
    best = np.zeros(len(y) + 1, np.int64)
    for w in _weights(shapes, x, y):
        best[1:] = np.maximum.accumulate(np.maximum(best[1:], best[:-1] + w))
    return best


#: Tables of up to so many cells are kept whole; larger ones are halved.
_WHOLE_CELLS = 250_000


def child_pairs(shapes: Shapes, x, y) -> Iterator[tuple[int, int]]:
    """The places paired in a largest order-keeping pairing of the shapes x and y; of equal ones those further left are paired first."""
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a, b, c, d = todo.pop()
        i, m, n = common_ends(x[a:b], y[c:d])
        yield from ((a + k, c + k) for k in range(i))
        yield from ((a + m + k, c + n + k) for k in range(b - a - m))
        a, b, c, d = a + i, a + m, c + i, c + n
        mine, other = {shapes.key[k] for k in x[a:b]}, {shapes.key[k] for k in y[c:d]}
        if not mine <= other or not other <= mine:      # a child without a like one on the other side is in no pair
            r, k = [j for j in range(a, b) if shapes.key[x[j]] in other], [j for j in range(c, d) if shapes.key[y[j]] in mine]
            yield from ((r[i], k[j]) for i, j in child_pairs(shapes, [x[j] for j in r], [y[j] for j in k]))
            continue
        if a >= b or c >= d:
            continue
        if (b - a) * (d - c) <= _WHOLE_CELLS or b - a == 1:
            w = np.stack(list(_weights(shapes, x[a:b], y[c:d])))
            best = np.zeros((b - a + 1, d - c + 1), np.int64)
            for r in range(b - a - 1, -1, -1):
                best[r, :-1] = np.maximum.accumulate(np.maximum(best[r + 1, :-1], best[r + 1, 1:] + w[r])[::-1])[::-1]
            r = k = 0
            while r < b - a and k < d - c:
                if w[r, k] and best[r, k] == best[r + 1, k + 1] + w[r, k]:
                    yield a + r, c + k
                    r, k = r + 1, k + 1
                elif best[r, k] == best[r, k + 1]:
                    k += 1
                else:
                    r += 1
        else:                                           # Hirschberg: where the best pairing of x's halves parts y
            mid = (a + b) // 2
            left = last_row(shapes, x[a:mid], y[c:d])
            right = last_row(shapes, x[mid:b][::-1], y[c:d][::-1])[::-1]
            cut = c + int((left + right).argmax())
            todo += [(a, mid, c, cut), (mid, b, cut, d)]


def align(page: Node, ref: Node, shapes: Shapes | None = None, nodes: list[Node] | None = None,
          ref_shape: dict[int, int] | None = None) -> dict[int, Node]:
    """Simple tree matching: id of a page node -> the reference node it is aligned with, in a largest mapping from the roots down."""
    shapes = shapes or Shapes()
    own = shapes.of(nodes or _flat(page))
    other = ref_shape or shapes.of(_flat(ref))
    pairs: dict[int, Node] = {}
    todo = [(page, ref)]
    while todo:
        p, r = todo.pop()
        pairs[id(p)] = r
        if p.kids and r.kids:
            x, y = [own[id(k)] for k in p.kids], [other[id(k)] for k in r.kids]
            todo += [(p.kids[i], r.kids[j]) for i, j in child_pairs(shapes, x, y)]
    return pairs


def _own_text(n: Node) -> str:
    return " ".join(n.text.split())


def _links_only(top: Node) -> bool:
    """Is there text, and all of it links?"""
    met, todo = False, [(top, False)]
    while todo:
        n, link = todo.pop()
        if n.tag == "#" and not n.text.isspace():
            if not link:
                return False
            met = True
        todo.extend((k, link or n.tag == "a") for k in n.kids)
    return met


def articles(page: Node) -> list[Node]:
    """The outermost declared articles that are not inside something apart, or else the main elements."""
    found: dict[str, list[Node]] = {"article": [], "main": []}
    todo = [(page, frozenset())]
    while todo:
        n, inside = todo.pop()
        if n.tag == "article" and _links_only(n):
            n.apart = True                              # a teaser, whatever surrounds it
        if n.apart:
            continue
        if n.tag in found and not _links_only(n):
            if n.tag not in inside:
                found[n.tag].append(n)
            inside = inside | {n.tag}
        todo.extend((k, inside) for k in reversed(n.kids) if k.kids)
    return found["article"] or found["main"]


def blocks(tops: list[Node]) -> list[list[Node]]:
    """The text nodes of each block under ``tops``, in page order, without what the markup sets apart."""
    out, line = [], []
    for start in tops:
        todo: list[Node | None] = [start]
        while todo:
            n = todo.pop()
            if n is None:
                if line:
                    out.append(line)
                    line = []
            elif n.tag == "#" or n.tag == "br":
                line.append(n)
            elif not n.apart:
                if n.tag in BLOCK:
                    if line:
                        out.append(line)
                        line = []
                    todo.append(None)
                todo.extend(n.kids[::-1])
        if line:
            out.append(line)
            line = []
    return out


def joined(parts: list[list[str]]) -> str:
    lines = (" ".join("".join(p).split()) for p in parts)
    return "\n".join(x for x in lines if x)


def lone_paragraphs(page: Node) -> set[int]:
    """ids of the text nodes of paragraphs without a sibling of their key that has text, in a parent without one."""
    text: dict[int, bool] = {}
    for n in reversed(_flat(page)):
        text[id(n)] = n.tag == "#" and not n.text.isspace() or not n.apart and any(text[id(k)] for k in n.kids)
    found, todo = set(), [(page, True)]
    while todo:
        n, single = todo.pop()
        own = [k for k in n.kids if k.kids and text[id(k)]]
        for k in own:
            lone = sum(x.key == k.key for x in own) == 1
            if k.tag == "p" and lone and single:
                found.update(id(x) for x in _flat(k) if x.tag == "#")
            todo.append((k, lone))
    return found


class Reference:
    """A host's parsed reference page: its nodes' places and shapes."""

    def __init__(self, page: str):
        self.root = parse(page)
        nodes = _flat(self.root)
        self.place = {id(n): i for i, n in enumerate(nodes)}
        self.shapes = Shapes()
        self.shape = self.shapes.of(nodes)
        self.own = len(self.shapes.key)

    def trim(self) -> None:
        """Forget the shapes of other pages when there are many."""
        if len(self.shapes.key) > self.own + 50_000 or len(self.shapes.known) > 200_000:
            self.shapes = Shapes()
            self.shape = self.shapes.of(_flat(self.root))


def read_page(page: str, ref: Reference | None) -> tuple[str, list | None, list[int], list[int]]:
    """Text, all parts of the page as (block, reference node, text, in a declared article) if there is a reference, nodes met, nodes met with equal text.

    Blank nodes have no vote, as they part words. A page whose text is all the same as the reference's has no vote: a copy says nothing about the template.
    """
    tree = parse(page)
    nodes = _flat(tree)
    pairs = align(tree, ref.root, ref.shapes, nodes, ref.shape) if ref else {}
    declared = articles(tree)
    found = blocks(declared or [tree])
    text = joined([[" " if n.tag == "br" else n.text for n in b] for b in found])
    met, same, varies = [], [], False
    for n in nodes:
        r = pairs.get(id(n)) if n.tag == "#" else None
        if r is not None and not (n.text.isspace() and r.text.isspace()):
            equal = n.text == r.text or _own_text(n) == _own_text(r)
            varies = varies or not equal
            met.append(ref.place[id(r)])
            if equal:
                same.append(met[-1])
    if ref is None or not varies:
        met, same = [], []
    parts = None
    if ref:
        inside = {id(n) for top in declared for n in _flat(top)}
        node = lambda n: -1 if n.text.isspace() else ref.place.get(id(pairs.get(id(n))), -1)
        alone = lone_paragraphs(tree)
        parts = [(i, node(n), " " if n.tag == "br" else n.text, id(n) in inside, id(n) in alone) for i, b in enumerate(blocks([tree])) for n in b]
    return text, parts, met, same


def slots(parts: list[dict], constant: frozenset[int], firm: frozenset[int], voted: bool) -> str:
    """The text of the parts that are no template: outside declared articles ``constant`` nodes, inside blocks of ``firm`` nodes only."""
    kept = {p["block"] for p in parts if p["inside"] and p["node"] not in firm and not p["text"].isspace()}
    lines: dict[int, list[str]] = {}
    inner, outer, alone = set(), set(), set()
    for p in parts:
        if p["block"] in kept if p["inside"] else p["node"] not in constant:
            lines.setdefault(p["block"], []).append(p["text"])
            if not p["text"].isspace():
                (inner if p["inside"] else outer).add(p["block"])
                if p["alone"]:
                    alone.add(p["block"])
    whole = not inner or voted and len(outer) == 1 and outer <= alone
    return joined([x for i, x in lines.items() if whole or i in inner])


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


class _References:
    """Parsed reference pages of the hosts a worker has met lately."""

    def __init__(self):
        self.known: dict[str, tuple[str, Reference]] = {}

    def get(self, host: str, page: str | None) -> Reference | None:
        if page is None:
            return None
        got = self.known.get(host)
        if got is None or got[0] != page:
            if len(self.known) > 200:
                self.known.clear()
            got = self.known[host] = (page, Reference(page))
        got[1].trim()
        return got[1]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            least_pages: int = 3, constant_share: float = 0.8, firm_pages: int = 10, row: Column | None = None) -> DataFrame:
    """id, url, text, n_chars of every page. ``row``: see ``common.numbered``."""
    kind = pages.schema[id_col].dataType.simpleString()
    base = numbered(pages, row, "row_id", [F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                                           F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"), host_of(F.col(url_col)).alias("host")])
    firsts = stage(base.groupBy("host").agg(F.min("row_id").alias("first_row"), F.count("*").alias("n"))
                   .filter(F.col("n") >= least_pages).select("first_row", F.col("host").alias("ref_host")), "hosts")
    refs = stage(base.select("row_id", F.col("html").alias("ref")).join(firsts, F.col("row_id") == F.col("first_row"))
                 .select("ref_host", "ref"), "references")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _References()
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 1_000_000))     # values of deep trees; calls between functions of Python need no stack of C
        for b in batches:
            got = [read_page(page, known.get(host, ref)) for host, page, ref in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)), strict=True)]
            text, parts, met, same = zip(*got, strict=True) if got else ((), (), (), ())
            part = pa.struct([("block", pa.int32()), ("node", pa.int32()), ("text", pa.string()), ("inside", pa.bool_()), ("alone", pa.bool_())])
            text = ["" if p is not None else t for p, t in zip(parts, text, strict=True)]      # the parts have it
            parts = [None if p is None else [{"block": i, "node": n, "text": t, "inside": x, "alone": a} for i, n, t, x, a in p] for p in parts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array(text, pa.string()), pa.array(parts, pa.list_(part)),
                 pa.array(met, pa.list_(pa.int32())), pa.array(same, pa.list_(pa.int32()))],
                ["id", "url", "host", "text", "parts", "met", "same"])

    read = stage(map_columns(base.join(refs, F.col("host") == F.col("ref_host"), "left"),
                             [F.col(c) for c in ("id", "url", "host", "html", "ref")],
                             f"id {kind}, url string, host string, text string, parts array<struct<block: int, node: int, text: string, inside: boolean, alone: boolean>>,"
                             " met array<int>, same array<int>", run), "aligned")
    votes = (read.select("host", F.explode("met").alias("node"), F.lit(0).alias("same"))
             .unionByName(read.select("host", F.explode("same").alias("node"), F.lit(1).alias("same"))))
    template = (votes.groupBy("host", "node").agg(F.sum("same").alias("same"), F.sum(1 - F.col("same")).alias("n"))
                .withColumn("fixed", (F.col("n") >= least_pages) & (F.col("same") >= constant_share * F.col("n")))
                .groupBy("host").agg(F.collect_set(F.when(F.col("fixed"), F.col("node"))).alias("constant"),
                                     F.collect_set(F.when(F.col("fixed") & (F.col("n") >= firm_pages), F.col("node"))).alias("firm"),
                                     (F.max("n") >= firm_pages).alias("voted")))
    declared = read.filter("parts IS NULL").select("id", "url", "text")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text = [slots(p, frozenset(c or ()), frozenset(f or ()), bool(v))
                    for p, c, f, v in zip(*(b.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string())], ["id", "url", "text"])

    rest = map_columns(read.filter("parts IS NOT NULL").join(stage(template, "templates"), "host", "left"),
                       [F.col(c) for c in ("id", "url", "parts", "constant", "firm", "voted")], f"id {kind}, url string, text string", settle)
    return declared.unionByName(rest).withColumn("n_chars", F.length("text").cast("long"))
