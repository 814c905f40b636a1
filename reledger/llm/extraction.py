"""Main text of web pages by wrapper induction.

Every page is parsed into a tree. Its containers, the blocks that hold blocks, are aligned with those
of the host's reference page by simple tree matching, the largest match that keeps order and
ancestors. A text that stands in one aligned container on a good part of a host's pages is a
constant node, so template; what varies is content. All pages of a host are counted, and near
copies of one article count as one page, so that its own paragraphs never pass for template.

The content slot of a page is its largest marked article, else the body. Elements that are never
text of an article go; one that is only named like a menu or an advert goes unless it holds most
of the slot, is a heading, or has a name that is merely similar and reads like text.
"""

from __future__ import annotations

import html as references
import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rolling import mix, shingles, words
from .storage import written
from .url_filter import host_of

#: Tables of more bytes in all are joined by a shuffle instead of a broadcast.
BROADCAST_BYTES = 32 << 20
#: A constant node stands on so many different pages of its host, and on this share of them.
LEAST_PAGES = 4
LEAST_SHARE = 0.5
#: Pages are told apart by so many minima of hashes of their word sequences.
FAMILIES = 3
#: Lists of containers are compared in one table up to so many cells, else in one of few rows at a time.
TABLE_CELLS = 250_000

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_CLASS = re.compile(r"""\b(class|id|role|itemprop)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))""", re.I)
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "xmp", "noembed", "svg"}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary "
    "table tbody td tfoot th thead tr ul".split()
)
#: Opening one of the right ends the left one that is open.
_ENDS = {
    "p": _BLOCK - {"br", "option", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html", "legend"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option"},
    "tr": {"tr", "tbody", "tfoot", "thead"},
    "td": {"td", "th", "tr", "tbody", "tfoot", "thead"},
    "th": {"td", "th", "tr", "tbody", "tfoot", "thead"},
}
_SCOPE = {"li": {"ul", "ol", "menu"}, "td": {"table"}, "th": {"table"}, "tr": {"table"}, "dt": {"dl"}, "dd": {"dl"}}
_ASIDE_TAGS = set("nav footer aside form button select menu dialog input label datalist object embed audio video canvas head".split())
#: Names that alone say what an element is, and names that contain such a word.
_ASIDE_EXACT = set(
    "ad ads advert advertisement adslot ad-slot banner sponsor sponsored promo nav navbar navigation menu sidebar "
    "side-bar footer site-footer masthead comment comments commentlist comment-list respond disqus replies reply "
    "notice notices cookie cookies cookie-notice consent gdpr popup modal overlay newsletter subscribe subscription "
    "share sharing share-buttons social related related-posts related-articles recommended breadcrumb breadcrumbs "
    "pagination pager widget toolbar login signup search alert disclaimer skip outbrain taboola".split()
)
_ASIDE_NAMES = re.compile(
    r"(?:^|[-_])(?:ad|ads|adv|advert\w*|adslot|banner|sponsor\w*|promo\w*|nav|navbar|navigation|menu\w*|side-?bar\w*|"
    r"footer|masthead|comments?|commentlist|respond|disqus|replies|reply|notices?|cookies?|consent|gdpr|popup|modal|"
    r"overlay|newsletter|subscribe|subscription|share|sharing|social|related|recommend\w*|breadcrumbs?|pagination|"
    r"pager|widget\w*|toolbar|login|signup|search|alert|disclaimer|skip|outbrain|taboola)(?:$|[-_])",
    re.I,
)
_MAIN = {"article", "main"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: End tags of these reach beyond the nearest of those; others stop there.
_FAR_ENDS = {"html", "body", "article", "main", "table", "section", "div"}
_BARRIERS = {"article", "main", "body", "table"}


class Node:
    __slots__ = ("tag", "names", "children", "parent", "main", "size", "linked", "place")

    def __init__(self, tag: str, names: str = "", parent: Node | None = None, main: bool = False):
        self.tag, self.names, self.children, self.parent, self.main = tag, names, [], parent, main
        self.size = self.linked = 0
        self.place = ""

    @property
    def label(self) -> str:
        return f"{self.tag}.{self.names}" if self.names else self.tag


class _Builder:
    """The open elements of a page, with counts that spare looking for those that are not open."""

    def __init__(self) -> None:
        self.root = self.top = Node("#")
        self.open: Counter = Counter()
        self.near: list[Counter] = [Counter()]

    def push(self, node: Node) -> None:
        self.top = node
        self.open[node.tag] += 1
        self.near[-1][node.tag] += 1
        if node.tag in _BARRIERS:
            self.near.append(Counter())

    def pop(self, node: Node) -> None:
        """Closes `node` and all that is open inside it."""
        while True:
            closed, self.top = self.top, self.top.parent
            if closed.tag in _BARRIERS:
                self.near.pop()
            self.open[closed.tag] -= 1
            self.near[-1][closed.tag] -= 1
            if closed is node:
                return

    def end(self, tag: str) -> None:
        if tag in _FAR_ENDS:
            held = self.open[tag]
        else:
            held = self.near[-1][tag]
        if held > 0:
            node = self.top
            while node.tag != tag:
                node = node.parent
            self.pop(node)

    def implied(self, tag: str) -> None:
        """Closes what an opening tag ends without an end tag."""
        for open_tag, ends in _ENDS.items():
            if tag in ends and self.open[open_tag] > 0:
                node, stop = self.top, _SCOPE.get(open_tag, ())
                while node is not self.root and node.tag != open_tag and node.tag not in stop and (open_tag != "p" or node.tag not in _BLOCK):
                    node = node.parent
                if node.tag == open_tag:
                    self.pop(node)


def parse(page: str) -> Node:
    """The tree of a page; never fails, whatever is unclosed or misplaced, in time linear in its length.

    A quote that is never closed ends the meaning of quotes, a tag that is never closed is text.
    """
    built = _Builder()
    at, size, pattern = 0, len(page), _TAG
    while at < size:
        less = page.find("<", at)
        if less < 0:
            less = size
        if less > at:
            built.top.children.append(page[at:less])
        if less == size:
            break
        if page.startswith("<!--", less):
            close = page.find("-->", less + 4)
            at = size if close < 0 else close + 3
            continue
        if page.startswith(("<!", "<?"), less):
            close = page.find(">", less)
            at = size if close < 0 else close + 1
            continue
        match = None
        if page[less + 1 : less + 2].isalpha() or page[less + 1 : less + 2] == "/":
            match = pattern.match(page, less)
            if match is None and pattern is _TAG and _PLAIN_TAG.match(page, less):
                pattern = _PLAIN_TAG
                match = pattern.match(page, less)
            elif match is None and page.find(">", less) < 0:
                built.top.children.append(page[less:])
                break
        if match is None:
            built.top.children.append("<")
            at = less + 1
            continue
        at, tag = match.end(), match.group(2).lower()
        if match.group(1):
            built.end(tag)
            continue
        attributes = match.group(3)
        names, main = "", tag in _MAIN
        if "=" in attributes:
            found = [(a.lower(), b or c or d) for a, b, c, d in _CLASS.findall(attributes)]
            names = " ".join(v for a, v in found if a in ("class", "id"))
            main = main or any(a == "role" and v == "main" or a == "itemprop" and v == "articleBody" for a, v in found)
        built.implied(tag)
        node = Node(tag, names, built.top, main)
        built.top.children.append(node)
        if tag in _RAW:
            if not attributes.endswith("/"):
                close = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
                close = page.find(">", close.end()) if close else -1
                at = size if close < 0 else close + 1
        elif tag not in _VOID and not attributes.endswith("/"):
            built.push(node)
    return built.root


def _never_text(node: Node) -> bool:
    return node.tag in _RAW or node.tag in _ASIDE_TAGS


def _in_order(root: Node) -> list[Node]:
    """The nodes that may hold text, parents first; sizes of texts, and of those in links, are set."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not _never_text(c))
    for node in reversed(order):
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        node.size += own
        if node.tag == "a":
            node.linked = node.size
        if node.parent is not None:
            node.parent.size += node.size
            node.parent.linked += node.linked
    return order


def slot(order: list[Node]) -> Node:
    """The content node of a page: its largest marked article, the innermost of nearly equal ones, else its body."""
    marked = [node for node in order if node.main and node.size]
    if marked:
        most = max(node.size for node in marked)
        large = [node for node in marked if node.size >= 0.9 * most]
        return next((node for node in reversed(large) if node.tag == "article"), large[-1])
    return next((node for node in order if node.tag == "body"), order[0])


def is_aside(node: Node, whole: int) -> bool:
    """Whether an element inside a slot of `whole` characters is no part of the article."""
    if _never_text(node):
        return True
    if not node.names or node.main or node.tag in _HEADINGS or node.tag in ("html", "body") or 2 * node.size > whole:
        return False
    names = node.names.lower().split()
    if not _ASIDE_EXACT.isdisjoint(names):
        return True
    return 2 * node.linked >= node.size and any(_ASIDE_NAMES.search(name) for name in names)


def blocks(node: Node) -> list[tuple[str, str]]:
    """(place, text) of the blocks below a node, in page order, without asides."""
    out: list[tuple[str, str]] = []
    held: list[str] = []
    whole = node.size

    def flush(at: Node) -> None:
        text = " ".join(references.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((at.place, text))

    # (node, block around it, next child); an own stack, since pages may nest without end.
    stack: list[list] = [[node, node, 0]]
    while stack:
        top = stack[-1]
        own, around, i = top
        if i == len(own.children):
            stack.pop()
            if own.tag in _BLOCK:
                flush(own)
            continue
        top[2] += 1
        child = own.children[i]
        if isinstance(child, str):
            held.append(child)
            continue
        block = child.tag in _BLOCK
        if block:
            flush(around)
        if not is_aside(child, whole):
            stack.append([child, child if block else around, 0])
    flush(node)
    return out


class Container:
    """A block that holds blocks, in the tree of such blocks."""

    __slots__ = ("label", "kids", "node", "kind", "size")

    def __init__(self, label: str, node: Node | None = None):
        self.label, self.node, self.kids, self.kind, self.size = label, node, [], 0, 1


def _finished(order: list[Container]) -> Container:
    """The root of containers given parents first; equal trees get equal kinds."""
    for own in reversed(order):
        own.size = 1 + sum(kid.size for kid in own.kids)
        shape = own.label + "".join(f" {kid.kind:x}" for kid in own.kids)
        own.kind = xxhash.xxh64_intdigest(shape.encode())
    return order[0]


def containers(order: list[Node], top: Node) -> Container:
    """The tree of containers from `top` on; `order` has the page's nodes, parents first."""
    holds: set[int] = {id(top)}
    for node in order:
        if node.tag in _BLOCK and node.tag != "br":
            above = node.parent
            while above is not None and id(above) not in holds:
                if above.tag in _BLOCK:
                    holds.add(id(above))
                above = above.parent
    made = {id(top): Container(top.label, top)}
    within = {id(top): made[id(top)]}
    out = [made[id(top)]]
    for node in order:
        around = within.get(id(node.parent)) if node is not top else None
        if around is None:
            continue
        if id(node) in holds and node.tag in _BLOCK:
            own = Container(node.label, node)
            around.kids.append(own)
            out.append(own)
            within[id(node)] = own
        else:
            within[id(node)] = around
    return _finished(out)


def packed(root: Container) -> str:
    """The labels of a tree and the number of each one's parent, as text; nesting may be of any depth."""
    found, stack = [], [(root, -1)]
    while stack:
        own, above = stack.pop()
        found.append([above, own.label])
        stack.extend((kid, len(found) - 1) for kid in reversed(own.kids))
    return json.dumps(found)


def unpacked(text: str) -> Container:
    made: list[Container] = []
    for above, label in json.loads(text):
        own = Container(label)
        made.append(own)
        if above >= 0:
            made[above].kids.append(own)
    return _finished(made)


def _ends(x: list[Container], y: list[Container]) -> tuple[int, int]:
    """How many kids of two lists are equal trees at the front and, of the others, at the back."""
    low, most = 0, min(len(x), len(y))
    while low < most and x[low].kind == y[low].kind:
        low += 1
    high = 0
    while high < most - low and x[-1 - high].kind == y[-1 - high].kind:
        high += 1
    return low, high


def _worth(p: Container, q: Container, weight: dict[tuple[int, int], int]) -> int:
    """The size of the largest match of two trees of one label; only those with kids need a table."""
    if p.kind == q.kind:
        return p.size
    return weight[p.kind, q.kind] if p.kids and q.kids else 1


def _table_by_rows(x: list[Container], y: list[Container], weight: dict[tuple[int, int], int]) -> tuple[int, list[tuple[int, int]]]:
    """The match of `_aligned` for lists too long for a table: a row at a time, with as many rows
    kept as are between two kept ones, which are worked out again on the way back."""
    kinds = {q.kind: i for i, q in enumerate({q.kind: q for q in y}.values())}
    column = np.array([kinds[q.kind] for q in y])
    by_label: dict[str, list[Container]] = {}
    for q in {q.kind: q for q in y}.values():
        by_label.setdefault(q.label, []).append(q)
    worths: dict[int, np.ndarray] = {}

    def row(p: Container, above: np.ndarray) -> np.ndarray:
        if p.kind not in worths:
            worths[p.kind] = np.zeros(len(kinds), dtype=np.int32)
            for q in by_label.get(p.label, ()):
                worths[p.kind][kinds[q.kind]] = _worth(p, q, weight)
        out = np.zeros_like(above)
        np.maximum.accumulate(np.maximum(above[1:], above[:-1] + worths[p.kind][column]), out=out[1:])
        return out

    step = math.isqrt(len(x)) + 1
    kept, last = [], np.zeros(len(y) + 1, dtype=np.int64)
    for i, p in enumerate(x):
        if i % step == 0:
            kept.append(last)
        last = row(p, last)
    pairs, j = [], len(y)
    for base in range((len(kept) - 1) * step, -1, -step):
        table = [kept[base // step]]
        for p in x[base : base + step]:
            table.append(row(p, table[-1]))
        i = len(table) - 1
        while i and j:
            if table[i][j] == table[i - 1][j]:
                i -= 1
            elif table[i][j] == table[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((base + i, j))
    return int(last[-1]), pairs


def _aligned(x: list[Container], y: list[Container], weight: dict[tuple[int, int], int]) -> tuple[int, list[tuple[int, int]]]:
    """The heaviest match of two lists that keeps their order. Equal trees at both ends always match."""
    low, high = _ends(x, y)
    pairs = [(i, i) for i in range(low)] + [(len(x) - 1 - i, len(y) - 1 - i) for i in range(high)]
    total = sum(x[i].size for i, _ in pairs)
    a, b = range(low, len(x) - high), range(low, len(y) - high)
    if len(a) * len(b) > TABLE_CELLS:
        most, between = _table_by_rows(x[low : len(x) - high], y[low : len(y) - high], weight)
        return total + most, pairs + [(low + i, low + j) for i, j in between]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, p in enumerate(a):
        for j, q in enumerate(b):
            match = best[i][j] + (_worth(x[p], y[q], weight) if x[p].label == y[q].label else 0)
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], match)
    i, j = len(a), len(b)
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            pairs.append((a[i], b[j]))
    return total + best[len(a)][len(b)], pairs


def _weigh(page: Container, reference: Container, weight: dict[tuple[int, int], int]) -> None:
    """Sizes of the largest matches of two trees and of the pairs below that their match needs."""
    stack = [(page, reference, False)]
    while stack:
        a, b, ready = stack.pop()
        if (a.kind, b.kind) in weight:
            continue
        if a.kind == b.kind:
            weight[a.kind, b.kind] = a.size
        elif ready:
            weight[a.kind, b.kind] = 1 + _aligned(a.kids, b.kids, weight)[0]
        else:
            low, high = _ends(a.kids, b.kids)
            x, y = a.kids[low : len(a.kids) - high], b.kids[low : len(b.kids) - high]
            stack.append((a, b, True))
            by_label: dict[str, dict[int, Container]] = {}
            for q in y:
                if q.kids:
                    by_label.setdefault(q.label, {})[q.kind] = q
            for p in {p.kind: p for p in x if p.kids}.values():
                others = by_label.get(p.label, {}).values()
                stack.extend((p, q, False) for q in others if p.kind != q.kind and (p.kind, q.kind) not in weight)


def matched(page: Container, reference: Container) -> list[tuple[Container, Container]]:
    """Simple tree matching: the pairs of the largest top-down match that keeps order.

    Weights are kept by the kinds of both trees, so equal subtrees are matched once, and they are
    worked out on a stack, so trees may be of any depth.
    """
    weight: dict[tuple[int, int], int] = {}
    out, stack = [], [(page, reference)] if page.label == reference.label else []
    while stack:
        a, b = stack.pop()
        out.append((a, b))
        if a.kind == b.kind:
            stack.extend(zip(a.kids, b.kids, strict=True))
        else:
            _weigh(a, b, weight)
            stack.extend((a.kids[i], b.kids[j]) for i, j in _aligned(a.kids, b.kids, weight)[1])
    return out


def _place(above: str, label: str) -> str:
    return xxhash.xxh64_hexdigest(f"{above} {label}".encode())


def reference_places(reference: Container) -> dict[int, str]:
    """A name for each container of the reference page, by its ancestors and its place among its like."""
    places = {id(reference): "0"}
    stack = [reference]
    while stack:
        own = stack.pop()
        seen: Counter = Counter()
        for kid in own.kids:
            seen[kid.label] += 1
            places[id(kid)] = _place(places[id(own)], f"{kid.label} {seen[kid.label]}")
            stack.append(kid)
    return places


class Wrapper:
    """The reference page of a host, to which pages are aligned."""

    def __init__(self, outline: str | None):
        self.root = unpacked(outline) if outline else None
        self.places = reference_places(self.root) if self.root else {}

    def blocks(self, page: str) -> list[tuple[str, str]]:
        """(place, text) of the blocks of a page's slot; equal places are one place of the host."""
        order = _in_order(parse(page))
        top = slot(order)
        if self.root is not None:
            for own, other in matched(containers(order, top), self.root):
                own.node.place = self.places[id(other)]
        inside = {id(top)}
        for node in order:
            if id(node.parent) in inside and node is not top:
                inside.add(id(node))
                node.place = node.place or _place(node.parent.place, node.label)
        return blocks(top)


def page_outline(page: str) -> str:
    order = _in_order(parse(page))
    return packed(containers(order, slot(order)))


def main_text(page: str | None) -> str:
    """The text of one page by itself: its slot's blocks, joined by line feeds."""
    return "\n".join(text for _, text in Wrapper(None).blocks(page)) if page else ""


def _families(texts: list[str]) -> np.ndarray:
    """Minima of hashes of the text's word sequences: near copies agree in most of them."""
    raw = np.frombuffer("\n".join(texts).encode(), dtype=np.uint8)
    offsets = np.array([0, len(raw)])
    _, _, hashes, owner = words(raw, offsets)
    value, _ = shingles(hashes, owner, 1)
    if not len(value):
        return np.zeros(FAMILIES, dtype=np.int64)
    salts = mix(np.arange(1, FAMILIES + 1, dtype=np.uint64))
    return np.array([mix(value ^ salt).min() for salt in salts], dtype=np.uint64).view(np.int64)


def outlines(rows: DataFrame) -> DataFrame:
    """(host, outline) of one page a host, chosen by a hash of its content."""
    hashed = rows.where("octet_length(html) > 0").withColumn("chosen", F.xxhash64("html", "url"))
    least = written(hashed.groupBy("host").agg(F.min("chosen").alias("chosen")), "chosen-pages")
    one = hashed.join(_broadcast(least), ["host", "chosen"]).select("host", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [page_outline(page) for page in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["host", "outline"])

    return written(one.mapInArrow(run, "host string, outline string").groupBy("host").agg(F.min("outline").alias("outline")), "outlines")


def _broadcast(table: DataFrame) -> DataFrame:
    """`table`, to be broadcast if its values have no more bytes than BROADCAST_BYTES."""
    size = table.agg(F.sum(sum((F.octet_length(F.col(c).cast("string")) for c in table.columns), F.lit(0)))).first()[0]
    return F.broadcast(table) if (size or 0) <= BROADCAST_BYTES else table


def page_blocks(rows: DataFrame) -> DataFrame:
    """(page_id, url, host, families, marks, texts): the blocks of each page; equal marks of a host
    are equal texts at one place."""
    joined = rows.join(_broadcast(outlines(rows)), "host", "left").select("page_id", "url", "host", "html", "outline")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, Wrapper] = {}
        for batch in batches:
            families, marks, texts = [], [], []
            for host, page, text in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)), strict=True):
                if text not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[text] = Wrapper(text)
                found = known[text].blocks(page) if page else []
                texts.append([t for _, t in found])
                marks.append([xxhash.xxh64_intdigest(f"{host} {p} {t}".encode()) for p, t in found])
                families.append(_families(texts[-1]))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in range(3)),
                    pa.array(families, pa.list_(pa.int64())),
                    pa.array([np.array(m, dtype=np.uint64).view(np.int64) for m in marks], pa.list_(pa.int64())),
                    pa.array(texts, pa.list_(pa.string())),
                ],
                names=["page_id", "url", "host", "families", "marks", "texts"],
            )

    kind = rows.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(
        run, f"page_id {kind}, url string, host string, families array<bigint>, marks array<bigint>, texts array<string>"
    )


def constant_marks(found: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """(mark) of the constant nodes of every host, counted over all its pages.

    A mark counts once for each family of pages; of several ways to tell families the one with
    fewest counts, so that near copies of a page hardly ever count as different ones.
    """
    marks = found.select("host", "families", F.explode(F.array_distinct("marks")).alias("mark"))
    often = marks.groupBy("mark").agg(F.count("*").alias("pages")).where(F.col("pages") >= least_pages).select("mark")
    often = written(often, "often")
    family = [F.col("families")[i].alias(f"f{i}") for i in range(FAMILIES)]
    kinds = marks.join(_broadcast(often), "mark").select("host", "mark", *family).distinct()
    differ = F.least(*(F.count_distinct(f"f{i}") for i in range(FAMILIES)))
    counted = kinds.groupBy("host", "mark").agg(differ.alias("pages"))
    hosts = found.select("host", *family).distinct().groupBy("host").agg(differ.alias("families"))
    most = F.greatest(F.lit(least_pages), F.ceil(F.col("families") * least_share))
    return counted.join(hosts, "host").where(F.col("pages") >= most).select("mark").distinct()


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) for each row of `pages`.

    text holds the article's blocks in page order, white space inside one turned into a space,
    joined by line feeds; n_chars counts its code points. A null or empty page gives an empty text. Pages
    without a host in their url form one host. A text that is a constant node, found at one place of
    LEAST_PAGES different pages of a host and on LEAST_SHARE of them, is no part of any article.
    Repeated rows are rows of their own, but count as one page; other columns are ignored; an empty
    table gives no rows. A page is held by one task and takes time in proportion to its length, but
    for containers that stand between others that differ from the reference page's: all of those in
    one list are compared with all in the other, in memory that grows with a list's length to 1.5.
    """
    rows = pages.select(
        F.col(page_id).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.col(html).alias("html")
    )
    found = written(page_blocks(rows), "page-blocks")
    constant = written(constant_marks(found), "constant-marks")
    if constant.isEmpty():
        text = F.array_join("texts", "\n")
        return found.select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))
    # A page's marks that are constant, as an array, with the rows that have any.
    row = found.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    held = (
        row.select("file", "at", F.explode(F.array_distinct("marks")).alias("mark"))
        .join(_broadcast(constant), "mark")
        .groupBy("file", "at")
        .agg(F.collect_set("mark").alias("constant"))
    )
    kept = F.filter(F.arrays_zip("marks", "texts"), lambda block: ~F.array_contains("constant", block["marks"]))
    texts = F.when(F.col("constant").isNull(), F.col("texts")).otherwise(kept["texts"])
    text = F.array_join(texts, "\n")
    return row.join(held, ["file", "at"], "left").select("page_id", "url", text.alias("text"), F.length(text).cast("long").alias("n_chars"))
