"""Main text of web pages by wrapper induction.

The pages of a host are aligned with ``REFERENCES`` of them, and with as many
of their layout (pages with the same tags and classes of their containers), by
simple tree matching: two nodes match if tag and class agree and their parents
match, and children are aligned one by one, in order, so that they share most
texts.  A block whose text is the reference's on ``SHARE`` of the different
pages of that host or layout that have such a place (the same tags and classes
down from the root), and on ``LEAST_PAGES`` at least, is template; other slots
are content.  Copies of a page count once.  A block that no reference of the group
holds is template if its text stands at its place (the same tags and classes
down from the root) on as many pages.

A page's own marks come first: what lies in menus, footers, sidebars, notices,
adverts, forms, scripts or reader comments by tag, role, class or id is never
content.  A class or id is such a mark if it is one as a whole ('site-footer',
not 'content-sidebar-wrap'), and a form's or a name's mark doesn't count on a
node that holds the article or most of the text (``_lift``).  If the page's
<article>s (else <main>s, else blocks and headings named as content) hold most
of the other text, only what they hold is content, else all; <header>s aren't,
wherever they stand.

The reference pages are broadcast if all of them together stay below
``BROADCAST_BYTES``, which is measured; beyond it the pages are joined by host
and layout with a shuffle that adaptive execution may split.  Each page is
parsed once and its blocks are staged; only pages with a block equal to a
reference's need the counts.

Defined results: null or empty html gives the empty text; without a host (no
url, no //) a page is read by its own marks alone; ids and urls may be null or
repeated, one row per row; white space is Unicode's, so no-break blanks too; an
empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from histevents.llm.tables import read, stage

SHARE, LEAST_PAGES, BROADCAST_BYTES = 0.8, 5, 32_000_000
#: Reference pages of a host, and of each layout.
REFERENCES = 4
#: Pairs of children with one text that are listed; beyond, all are compared row by row.
DENSE = 4096
#: What makes a layout: the tags of this kind, with their classes.
SKELETON = (r"(?i)<(?:article|aside|body|div|footer|form|header|main|nav|ol|section|table|ul)(?=[\s>])"
            r"(?:[^<>]*?\sclass\s*=\s*(?:\"[^\"<>]*\"|'[^'<>]*'|[^\s\"'<>]+))?")

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>", re.S)
#: A whole name, and its value if it has one.
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[a-z0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr label".split())
#: Tags that end an open one of the same group, unless one of the bounds is in between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}), "body": ({"head"}, set()),
}
BLOCK_ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu "
    "nav ol p pre section table ul".split())

#: Never content, by tag, by role, and by a class or id that is a role: one of
#: its words is in DROP_NAMES and the others say only where or what kind.
DROP_TAGS = frozenset(
    "script style noscript template iframe textarea title head nav footer aside button select option input svg "
    "canvas object embed audio video dialog menu".split())
DROP_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert dialog menu menubar alertdialog status".split())
DROP_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar menu nav "
    "navbar navigation breadcrumb breadcrumbs masthead footer comment comments disqus respond reply replies discussion "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup "
    "login share sharing social related recommended recommendations widget widgets toolbar pagination pager copyright "
    "disclaimer paywall bio".split())
KIND_NAMES = frozenset(
    "site page global main primary secondary top bottom left right upper lower side inner outer area section list box block "
    "container wrap wrapper bar row col column slot unit space zone link links button buttons icon icons item items text "
    "title head header heading body message messages policy post posts entry article articles story stories user email "
    "popular latest recent google js eu sticky fixed floating mobile desktop form trail label thread card cards info author "
    "signup prompt panel strip region inline group grid wrapper inner count text more".split())
#: Says what kind of block only after a name of DROP_NAMES: 'notice-content', not 'content-sidebar'.
LAST_NAME = "content"
COMMENT_NAMES = frozenset("comment comments disqus respond reply replies discussion".split())
CONTENT_NAMES = frozenset(("content", "post", "entry", "story", "article", "main"))
#: Tags whose names count as CONTENT_NAMES.
CONTAINERS = frozenset("div section td li h1 h2 h3 h4 h5 h6".split())


@lru_cache(10_000)
def _mark(token: str) -> int:
    """Whether a class or id is a role that isn't content: 0 no, 1 yes, 2 reader comments."""
    named = [w for w in NAME.findall(token) if not w.isdecimal()]
    if len(named) > 1 and named[-1] == LAST_NAME and named[0] in DROP_NAMES:
        named.pop()
    words = set(named)
    if words.isdisjoint(DROP_NAMES) or not words <= DROP_NAMES | KIND_NAMES:
        return 0
    return 1 if words.isdisjoint(COMMENT_NAMES) else 2


class Node:
    __slots__ = ("tag", "names", "role", "hidden", "parts", "drop", "mark")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.names, self.role, self.hidden, self.mark = tag, (), "", False, 0
        #: Children and texts in order.
        self.parts: list = []
        if "=" in attributes or "hidden" in attributes.lower():
            for name, a, b, c in ATTRIBUTE.findall(attributes):
                name, value = name.lower(), a or b or c
                if name in ("class", "id"):
                    value = entities.unescape(value).lower()
                    self.names += tuple(NAME.findall(value))
                    self.mark = max(self.mark, *map(_mark, value.split()), 0)
                elif name == "role":
                    self.role = value.lower()
                elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(
                        r"display\s*:\s*none", value):
                    self.hidden = True
        if tag in ("html", "body", "main"):
            self.mark = 0
        elif tag == "form" or self.role == "form":
            self.mark = self.mark or 1
        always = tag in DROP_TAGS or self.hidden or self.role in DROP_ROLES
        #: A mark is lifted by ``_lift``; what is dropped otherwise stays so.
        self.mark, self.drop = 0 if always else self.mark, always or self.mark > 0

    def children(self) -> list:
        return [x for x in self.parts if x.__class__ is Node]


def parse(page: str) -> Node:
    """The tree of a page; never fails, whatever is left open or unmatched."""
    root = Node("#root")
    stack, at, n, marked = [root], 0, len(page), False
    while at < n:
        m = TAG.search(page, at)
        if not m:
            stack[-1].parts.append(page[at:])
            break
        if m.start() > at:
            stack[-1].parts.append(page[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if stack[k].tag in ("article", "table", "body") and tag in INLINE | {"p"}:
                    break
            continue
        if tag in BLOCK_ENDS_P:
            _end(stack, {"p"}, {"button", "table", "td", "th", "li", "div", "article", "section", "body"})
        if tag in ENDS:
            _end(stack, *ENDS[tag])
        node = Node(tag, m[3] or m[6] or "")
        stack[-1].parts.append(node)
        marked = marked or node.mark > 0
        if tag in RAW:
            end = re.compile(f"</{tag}\\s*>", re.I).search(page, at)
            at = end.end() if end else n
        elif tag not in VOID and not (m[3] or m[6] or "").endswith("/"):
            stack.append(node)
    if marked:
        _lift(root)
    return root


def _end(stack: list, tags: set, bounds: set) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in bounds:
            return


# ---- blocks of a page -------------------------------------------------------

def _kinds(node: Node) -> int:
    """Bits 0, 1 and 2: an <article>, a <main>, a block named as content."""
    named = node.tag in CONTAINERS and not CONTENT_NAMES.isdisjoint(node.names)
    return (node.tag == "article" or node.role == "article") | (node.tag == "main" or node.role == "main") << 1 | named << 2


def _roots(root: Node) -> list[Node]:
    """The outermost nodes of the first level (<article>, <main>, named) that
    holds most of the text outside the dropped nodes; without one, the page."""
    levels: tuple[list[Node], ...] = ([], [], [])
    held, total = [0, 0, 0], 0
    todo = [(root, 0, False)]
    while todo:
        node, inside, header = todo.pop()
        if node.drop:
            continue
        kinds = _kinds(node)
        for k, level in enumerate(levels):
            if kinds & ~inside & 1 << k:
                level.append(node)
        inside, header = inside | kinds, header or node.tag == "header"
        size = sum(sum(map(len, x.split())) for x in node.parts if x.__class__ is not Node)
        if inside or not header:
            total += size
        for k in range(3):
            if inside & 1 << k:
                held[k] += size
        todo += [(x, inside, header) for x in reversed(node.children())]
    for level, size in zip(levels, held):
        if 2 * size > total:
            return level
    return [root]


class Region:
    """What a marked node holds outside the marked and dropped nodes in it; then
    (``_regions``) ``size``, ``articles``, ``largest`` and ``head`` with those in
    it too, but for reader comments."""
    __slots__ = ("node", "above", "below", "comment", "own", "size", "held", "articles", "largest", "head")

    def __init__(self, node: Node, above: Region | None):
        self.node, self.above, self.below, self.comment = node, above, [], above is not None and above.comment or node.mark == 2
        #: Characters of text that isn't a link's: all, and inside the levels of ``_roots``.
        self.own, self.held = 0, [0, 0, 0]
        self.size, self.articles, self.largest, self.head = 0, [], 0, False
        if above:
            above.below.append(self)


def _regions(root: Node) -> list[Region]:
    """The page's region and those of marked nodes, outer ones first."""
    regions = [Region(root, None)]
    #: Characters of each outermost article, by its region.
    sizes: list[list] = []
    todo = [(root, regions[0], 0, None)]
    while todo:
        node, region, inside, article = todo.pop()
        if node.drop:
            if not node.mark:
                continue
            region = Region(node, region)
            regions.append(region)
        if node.tag == "a":
            continue
        kinds = _kinds(node)
        inside |= kinds
        region.head = region.head or node.tag == "h1" or kinds & 2 > 0
        if kinds & 1 and article is None:
            article = [region, 0]
            sizes.append(article)
        size = sum(sum(map(len, x.split())) for x in node.parts if x.__class__ is not Node)
        region.own += size
        for k in range(3):
            if inside & 1 << k:
                region.held[k] += size
        if article:
            article[1] += size
        todo += [(x, region, inside, article) for x in reversed(node.children())]
    for region, size in sizes:
        region.articles.append(size)
        region.largest = max(region.largest, size)
    for region in reversed(regions):
        region.size += region.own
        above = region.above
        if above and region.comment == above.comment:
            above.size += region.size
            above.largest, above.head = max(above.largest, region.largest), above.head or region.head
    return regions


def _lift(root: Node) -> None:
    """Take marks off the nodes that hold the page's article or most of its text.

    A node with the page's only article is no sidebar, whatever its name, and
    none is that holds more than all else together, unless the rest has roots of
    its own and the node no large article, <main> or <h1>.  Where the page has no
    other text, no mark counts; reader comments are only lifted then."""
    regions = _regions(root)
    total, opened, held = regions[0].size, regions[0].own, regions[0].held

    def lift(region: Region) -> None:
        nonlocal opened, held
        while region.node.drop:
            region.node.drop = False
            opened, held = opened + region.own, [x + y for x, y in zip(held, region.held)]
            region = region.above

    holders = [r for r in regions if not r.comment for size in r.articles if size]
    if len(holders) == 1:
        lift(holders[0])
    at = regions[0]
    while at:
        at = next((x for x in at.below if not x.comment and 2 * x.size > total), None)
        if at and at.node.drop:
            rooted = any(2 * x > opened for x in held)
            if rooted and not at.head and 2 * at.largest <= at.size:
                break
            lift(at)
    if not opened:
        for region in regions:
            if region.own and region.comment == (total == 0):
                lift(region)


def blocks(root: Node) -> list[tuple[Node, str]]:
    """(block node, text) of the content in page order; texts aren't empty."""
    out: list[tuple[Node, str]] = []
    buffer: list[str] = []

    def flush(owner: Node) -> None:
        text = " ".join(entities.unescape("".join(buffer)).split())
        buffer.clear()
        if text:
            out.append((owner, text))

    for top in _roots(root):
        todo: list = [(top, top)]
        while todo:
            part, owner = todo.pop()
            if part is None:  # the end of a block
                flush(owner)
            elif part.__class__ is not Node:
                buffer.append(part)
            elif part is not top and (part.drop or part.tag == "header"):
                if part.tag not in INLINE:
                    flush(owner)
            elif part.tag in INLINE:
                if part.tag == "br":
                    buffer.append(" ")
                todo += [(x, owner) for x in reversed(part.parts)]
            else:
                flush(owner)
                todo.append((None, part))
                todo += [(x, part) for x in reversed(part.parts)]
        flush(top)
    return out


# ---- simple tree matching ---------------------------------------------------

@lru_cache(10_000)
def _key(tag: str, names: tuple) -> int:
    """A number of tag and names, the same in every process; numbers in names don't count."""
    words = [tag, *(w for w in names if not w.isdecimal())]
    return int.from_bytes(blake2b(" ".join(words).encode(), digest_size=8).digest(), "big", signed=True)


class Tree:
    """A page's blocks, and the nodes that hold some: number, key, path and the
    range of blocks in page order."""

    def __init__(self, page: str):
        root = parse(page)
        found = blocks(root)
        self.texts = [t for _, t in found]
        self.known = frozenset(self.texts)
        owner: dict[int, list[int]] = {}
        for k, (node, _) in enumerate(found):
            owner.setdefault(id(node), []).append(k)
        #: By number, in page order: key, path (keys down from the root), children, [first, end) of the blocks.
        self.keys, self.paths, self.below, self.first, self.end = [], [], [], [], []
        #: The node of each block.
        self.node = [0] * len(found)
        above, todo = [], [(root, -1)]
        while todo:
            node, up = todo.pop()
            n, key, own = len(self.keys), _key(node.tag, node.names), owner.get(id(node), ())
            self.keys.append(key)
            self.paths.append(hash((self.paths[up] if up >= 0 else 0, key)))
            self.below.append([])
            self.first.append(own[0] if own else len(found))
            self.end.append(own[-1] + 1 if own else 0)
            above.append(up)
            for k in own:
                self.node[k] = n
            todo += [(x, n) for x in reversed(node.children())]
        for n in range(len(above) - 1, 0, -1):
            up = above[n]
            if self.first[n] < self.end[n]:
                self.below[up].append(n)
                self.first[up], self.end[up] = min(self.first[up], self.first[n]), max(self.end[up], self.end[n])
        for ns in self.below:
            ns.reverse()


def align(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Matched (node of a, node of b) pairs that hold equal texts, from the roots."""
    common, out, todo = a.known & b.known, [], [(0, 0)]
    while todo and common:
        x, y = todo.pop()
        out.append((x, y))
        left, right = a.below[x], b.below[y]
        if len(left) == len(right) == 1:
            if a.keys[left[0]] == b.keys[right[0]]:
                todo.append((left[0], right[0]))
        elif left and right:
            todo += _matched(a, left, b, right, common)
    return out


def _matched(a: Tree, left: list[int], b: Tree, right: list[int], common: frozenset) -> list[tuple[int, int]]:
    """Children in order, one by one, so that they share most texts."""
    places: list[dict] = [{}, {}]
    for where, tree, nodes in ((places[0], a, left), (places[1], b, right)):
        for i, n in enumerate(nodes):
            for t in common.intersection(tree.texts[tree.first[n]:tree.end[n]]):
                where.setdefault((tree.keys[n], t), []).append(i)
    if any(len(ours) * len(places[1].get(key, ())) > DENSE for key, ours in places[0].items()):
        return [(left[i], right[j]) for i, j in _heaviest(a, left, b, right, common, places[1])]
    score: dict[tuple[int, int], int] = {}
    for key, ours in places[0].items():
        for pair in ((i, j) for i in ours for j in places[1].get(key, ())):
            score[pair] = score.get(pair, 0) + 2
    for i, j in score:
        x, y = left[i], right[j]
        score[i, j] += a.texts[a.first[x]:a.end[x]] == b.texts[b.first[y]:b.end[y]]
    # the heaviest increasing chain of pairs; best[j]: a Fenwick tree of maxima
    best: list[tuple[int, tuple | None]] = [(0, None)] * (len(right) + 1)
    for i, j in sorted(score, key=lambda p: (p[0], -p[1])):
        k, before = j, (0, None)
        while k > 0:
            before = max(before, best[k], key=lambda e: e[0])
            k -= k & -k
        entry = (before[0] + score[i, j], ((left[i], right[j]), before[1]))
        k = j + 1
        while k <= len(right):
            if best[k][0] < entry[0]:
                best[k] = entry
            k += k & -k
    k, chain = len(right), (0, None)
    while k > 0:
        chain = max(chain, best[k], key=lambda e: e[0])
        k -= k & -k
    out, link = [], chain[1]
    while link:
        out.append(link[0])
        link = link[1]
    return out


def _heaviest(a: Tree, left: list[int], b: Tree, right: list[int], common: frozenset, places: dict) -> list[tuple[int, int]]:
    """The heaviest increasing chain over all pairs, a row of their weights at a
    time (Hirschberg: the rows are halved, so no table of them is kept)."""
    kinds: dict[tuple, int] = {}
    ours, theirs = (np.array([kinds.setdefault((t.keys[n], *t.texts[t.first[n]:t.end[n]]), len(kinds)) for n in nodes])
                    for t, nodes in ((a, left), (b, right)))
    kind = list(kinds)
    held, nowhere = {k: np.array(v) for k, v in places.items()}, np.empty(0, np.int64)

    @lru_cache(64)
    def weights(k: int) -> np.ndarray:
        row = np.zeros(len(right), np.int64)
        for t in common.intersection(kind[k][1:]):
            row[held.get((kind[k][0], t), nowhere)] += 2
        row[(row > 0) & (theirs == k)] += 1
        return row

    def best(rows, j0: int, j1: int, step: int) -> np.ndarray:
        out = np.zeros(j1 - j0 + 1, np.int64)
        for i in rows:
            out[1:] = np.maximum.accumulate(np.maximum(out[1:], out[:-1] + weights(ours[i])[j0:j1][::step]))
        return out

    # equal children at either end match: no other pair of theirs weighs more
    n, m, head, tail = len(left), len(right), 0, 0
    while head < min(n, m) and ours[head] == theirs[head]:
        head += 1
    while tail < min(n, m) - head and ours[n - 1 - tail] == theirs[m - 1 - tail]:
        tail += 1
    ends = [*((i, i) for i in range(head)), *((n - 1 - i, m - 1 - i) for i in range(tail))]
    out = [(i, j) for i, j in ends if not common.isdisjoint(kind[ours[i]][1:])]
    todo = [(head, n - tail, head, m - tail)]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        if i0 >= i1 or j0 >= j1:
            continue
        if i1 - i0 == 1:
            row = weights(ours[i0])[j0:j1]
            if row.any():
                out.append((i0, j0 + int(row.argmax())))
            continue
        half = (i0 + i1) // 2
        j = j0 + int((best(range(i0, half), j0, j1, 1) + best(range(i1 - 1, half - 1, -1), j0, j1, -1)[::-1]).argmax())
        todo += [(i0, half, j0, j), (half, i1, j, j1)]
    return sorted(out)


def same(reference: Tree, own: Tree) -> list[tuple[int, int]]:
    """(reference node, block number) where a block has the reference's text."""
    partner = {y: x for x, y in align(reference, own)}
    texts: dict[int, set] = {}
    for k, n in enumerate(reference.node):
        texts.setdefault(n, set()).add(reference.texts[k])
    return [(partner[n], k) for k, n in enumerate(own.node) if n in partner and own.texts[k] in texts.get(partner[n], ())]


_REFERENCES: dict[int, Tree] = {}


def _reference(page: int, html: str) -> Tree:
    if page not in _REFERENCES:
        if len(_REFERENCES) >= 256:
            _REFERENCES.clear()
        _REFERENCES[page] = Tree(html)
    return _REFERENCES[page]


_PARSED = ("page_id bigint, url string, host string, layout bigint, page bigint, blocks array<string>, paths array<bigint>, "
           "same array<struct<grp:bigint,slot:bigint,path:bigint,block:bigint>>")
_KEPT = ("page_id", "url", "host", "layout", "page")


def _parsed(batches, references=None):
    """``references``: {(host, group): [(page, html)]}; if None, they are in the rows."""
    kind = pa.list_(pa.struct([("grp", pa.int64()), ("slot", pa.int64()), ("path", pa.int64()), ("block", pa.int64())]))
    for b in batches:
        found, paths, slots = [], [], []
        rows = zip(*(b.column(c).to_pylist() for c in ("html", "host", "layout")),
                   *([b.column("wide"), b.column("close")] if references is None else [[None] * len(b)] * 2))
        for html, host, layout, *given in rows:
            own, out, compared = Tree(html or ""), [], {}
            for grp, refs in zip((0, layout), given):
                refs = references.get((host, grp), ()) if references is not None else [
                    (r["page"], r["html"]) for r in refs.as_py() or ()]
                for page, text in refs if own.texts else ():
                    tree = _reference(page, text)
                    if page not in compared:
                        compared[page] = same(tree, own) if not tree.known.isdisjoint(own.known) else []
                    out += [{"grp": grp, "slot": hash((page, n)), "path": tree.paths[n], "block": k} for n, k in compared[page]]
            found.append(own.texts)
            paths.append([own.paths[n] for n in own.node])
            slots.append(out)
        yield pa.RecordBatch.from_arrays(
            [*map(b.column, _KEPT), pa.array(found, pa.list_(pa.string())), pa.array(paths, pa.list_(pa.int64())),
             pa.array(slots, kind)], names=[*_KEPT, "blocks", "paths", "same"])


def _references(own: DataFrame) -> DataFrame:
    """(host, grp, page, html), staged: the reference pages of a host (group 0)
    and of each layout that isn't the host's only one."""
    pages = own.where("host is not null and html is not null").groupBy("host", "layout", "page").agg(F.lit(1).alias("one"))
    drawn = F.array_distinct(F.array(*[F.min_by("page", F.xxhash64("page", F.lit(k))) for k in range(REFERENCES)]))
    groups = stage(
        pages.select("host", "page", F.explode(F.array(F.lit(0).cast("long"), "layout")).alias("grp"))
        .groupBy("host", "grp").agg(F.count("*").alias("n"), drawn.alias("pages")).where(f"n >= {LEAST_PAGES}"), "groups")
    whole = groups.where("grp = 0").select("host", F.col("n").alias("whole"))
    wanted = stage(groups.join(whole, "host").where("grp = 0 or n < whole").select(
        "host", "grp", F.explode("pages").alias("page")), "wanted")  # its size decides how html is joined
    html = own.join(wanted.select("host", "page").distinct(), ["host", "page"]).groupBy("host", "page").agg(
        F.first("html").alias("html"))
    return stage(wanted.join(html, ["host", "page"]).select("host", "grp", "page", "html"), "references")


def extract(pages: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(page_id, url, text) of every row of ``pages`` (page_id, url, html)."""
    skeleton = F.array_sort(F.array_distinct(F.transform(
        F.regexp_extract_all("html", F.lit(SKELETON), F.lit(0)), lambda x: F.regexp_replace(x, "[0-9]+", ""))))
    own = pages.select("page_id", "url", "html", F.nullif(F.lower(F.regexp_extract(
        "url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)), F.lit("")).alias("host"),
        F.xxhash64("html").alias("page"), F.xxhash64(skeleton).alias("layout"))
    references = _references(own)
    size = references.agg(F.sum(F.octet_length("html") + F.octet_length("host"))).first()[0] or 0
    if size <= broadcast_bytes:
        known: dict[tuple, list] = {}
        for r in references.toLocalIterator():
            known.setdefault((r.host, r.grp), []).append((r.page, r.html))
        shared = own.sparkSession.sparkContext.broadcast(known)
        parsed = own.mapInArrow(lambda batches: _parsed(batches, shared.value), _PARSED)
    else:
        grouped = references.groupBy("host", "grp").agg(F.collect_list(F.struct("page", "html")).alias("pages"))
        parsed = own.join(grouped.where("grp = 0").select("host", F.col("pages").alias("wide")), "host", "left").join(
            grouped.where("grp <> 0").select("host", F.col("grp").alias("layout"), F.col("pages").alias("close")),
            ["host", "layout"], "left").mapInArrow(_parsed, _PARSED)
    parsed = stage(parsed, "blocks")
    several = F.size("same") > 0
    # copies of a page count once: first by (host, page), then by group and path or slot
    mark = F.zip_with("paths", "blocks", lambda p, t: F.struct(p.alias("path"), F.xxhash64(t).alias("text")))
    distinct = parsed.where("host is not null and size(blocks) > 0").withColumn("marks", F.array_distinct(mark)).groupBy("host", "page").agg(
        F.first("layout").alias("layout"), F.first("marks").alias("marks"), F.first("same").alias("same"))
    have = distinct.select("host", F.explode(F.array(F.lit(0).cast("long"), "layout")).alias("grp"), F.array_distinct("marks.path").alias("paths")).select(
        "host", "grp", F.explode("paths").alias("path")).groupBy("host", "grp", "path").agg(F.count("*").alias("pages"))
    met = distinct.select("host", F.explode(F.array_distinct(F.transform(
        "same", lambda x: F.struct(x["grp"].alias("grp"), x["slot"].alias("slot"), x["path"].alias("path"))))).alias("s")).select(
        "host", "s.*").groupBy("host", "grp", "slot", "path").agg(F.count("*").alias("n")).where(f"n >= {LEAST_PAGES}")
    template = stage(
        met.join(have, ["host", "grp", "path"]).where(f"n >= {SHARE} * pages")
        .groupBy("host", "grp").agg(F.collect_set("slot").alias("slots")), "template")
    # what no reference of a group holds is counted by place and text
    drawn = references.select("host", "grp", "page", F.lit(True).alias("drawn"))
    rest = distinct.select("host", "page", F.explode(F.array(F.lit(0).cast("long"), "layout")).alias("grp"), "marks").join(
        drawn, ["host", "grp", "page"], "left").select("host", "grp", "drawn", F.inline("marks")).groupBy(
        "host", "grp", "path", "text").agg(F.count("*").alias("n"), F.max("drawn").alias("drawn")).where(
        f"n >= {LEAST_PAGES} and drawn is null")
    rest = stage(rest.join(have, ["host", "grp", "path"]).where(f"n >= {SHARE} * pages").groupBy("host", "grp").agg(
        F.collect_set(F.struct("path", "text")).alias("marks")), "rest")
    if not rest.isEmpty():
        parsed = (
            parsed.withColumn("mark", mark)
            .join(rest.where("grp = 0").select("host", F.col("marks").alias("wide")), "host", "left")
            .join(rest.where("grp <> 0").select("host", F.col("grp").alias("layout"), F.col("marks").alias("close")),
                  ["host", "layout"], "left")
            .withColumn("alone", F.filter(F.sequence(F.lit(0), F.size("blocks") - 1), lambda i: F.coalesce(
                F.array_contains("wide", F.get("mark", i)), F.lit(False)) | F.coalesce(
                F.array_contains("close", F.get("mark", i)), F.lit(False))))
            .drop("mark", "wide", "close"))
        parsed = parsed.withColumn("alone", F.when(F.size("blocks") > 0, F.col("alone").cast("array<bigint>")).otherwise(
            F.array().cast("array<bigint>")))
    else:
        parsed = parsed.withColumn("alone", F.array().cast("array<bigint>"))
    several = several | (F.size("alone") > 0)
    none = F.array().cast("array<bigint>")
    marked = (
        parsed.where(several)
        .join(template.where("grp = 0").select("host", F.col("slots").alias("wide")), "host", "left")
        .join(template.where("grp <> 0").select("host", F.col("grp").alias("layout"), F.col("slots").alias("close")),
              ["host", "layout"], "left")
        .withColumn("gone", F.concat("alone", F.transform(F.filter("same", lambda x: F.when(
            x["grp"] == 0, F.array_contains(F.coalesce("wide", none), x["slot"])).otherwise(
            F.array_contains(F.coalesce("close", none), x["slot"]))), lambda x: x["block"]))))
    left = F.filter("blocks", lambda t, i: ~F.array_contains("gone", i.cast("long")))
    whole = parsed.where(~several).select("page_id", "url", "blocks")
    # a page that is nothing but template is content after all
    cut = marked.select("page_id", "url", F.when(F.size(left) > 0, left).otherwise(F.col("blocks")).alias("blocks"))
    return whole.unionByName(cut).select("page_id", "url", F.array_join("blocks", "\n").alias("text"))


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    text = extract(read(spark, sf_dir, "pages", "page_id", "url", "html"))
    return text.withColumn("n_chars", F.length("text").cast("long"))
