"""Main text of pages: copies, notices, names, hostile pages, tree matching, and the sample pages by another parser."""

from __future__ import annotations

import random
import time
from html.parser import HTMLParser
from pathlib import Path

import pytest

from reledger.llm import extraction
from reledger.llm.extraction import Container, _finished, main_text, matched, packed, unpacked

SMALL = "/root/testdata/sf0.001"


def _text(rng, n=40):
    return " ".join(f"w{rng.randrange(5000)}" for _ in range(n))


def test_near_copies_keep_what_they_share_and_notices_go(spark):
    rng = random.Random(1)
    shared = [_text(rng) for _ in range(3)]
    notice = "All rights reserved by the people of this place"
    rows, expected = [], {}
    for i in range(24):  # near copies of one article, alone on their host
        parts = [*shared[:2], f"Edit {i} of it", shared[2]]
        expected[i] = "\n".join(["Title", *parts])
        rows.append((i, "http://copies.net/a", "<article><h1>Title</h1>" + "".join(f"<p>{p}</p>" for p in parts) + "</article>"))
    common = _text(rng)
    for i in range(100, 130):  # articles of their own under one notice, which one of them lacks
        parts = [_text(rng) for _ in range(i % 5 + 1)] + ([common] if i % 5 == 0 else [])
        expected[i] = "\n".join(parts)
        body = "".join(f"<p>{p}</p>" for p in parts) + ("" if i == 107 else f"<div><p>{notice}</p><p>Same</p></div>")
        rows.append((i, "https://News.org/x", f"<body><main class=wide>{body}</main></body>"))
    for i in range(200, 203):  # too few pages to tell
        expected[i] = f"{_text(random.Random(i))}\n{notice}"
        rows.append((i, "https://few.org/x", f"<body><p>{_text(random.Random(i))}<p>{notice}</body>"))
    rows += [(300, None, None), (301, "x", ""), (302, "x", "   "), (302, "x", "<p>again</p>"), (302, "x", "<p>again</p>")]
    pages = spark.createDataFrame([(*r, 1, "m") for r in rows], "page_id long, url string, html string, at int, marks string")
    found = extraction.extract(pages.repartition(3)).collect()
    assert len(found) == len(rows) and all(r.n_chars == len(r.text) for r in found)
    assert {r.page_id: r.text for r in found if r.page_id < 300} == expected
    assert sorted(r.text for r in found if r.page_id >= 300) == ["", "", "", "again", "again"]
    assert extraction.extract(pages.where("false")).collect() == []


@pytest.mark.parametrize(
    "page,text",
    [
        ('<div class="content-sidebar-wrap"><main><p>kept</main></div>', "kept"),
        ('<div class="page has-sidebar"><article><p>kept</article><div class="sidebar">side</div></div>', "kept"),
        ('<article><h1>A</h1><p>long enough to be the most of it all<section id="related-work"><h2 id="search">B</h2><p>c</section></article>',
         "A\nlong enough to be the most of it all\nB\nc"),
        ('<article><p>the article itself, more than half of it</p><div class="related-posts"><a>x</a></div><div class="share">y</div><p>end</article>',
         "the article itself, more than half of it\nend"),
        ('<article><p>the article itself, more than half<ul class="more-links menu-like"><li><a>one</a><li><a>two</a></ul></article>',
         "the article itself, more than half"),
        ("<p>a<div class=comments>b</div><div class=comments>c</div>", "a"),
        ("a &lt;b&gt; &amp;&nbsp;c\n d<br>e", "a <b> & c d\ne"),
        ("<article>x<script>if (a < b) '</p>'</script>y</article><footer>z</footer>", "xy"),
    ],
)
def test_single_pages(page, text):
    assert main_text(page) == text


def test_hostile_pages_take_time_in_proportion():
    started = time.perf_counter()
    for page in ("<a '" * 250_000, '<a b="' * 170_000, "<div>" * 50_000 + "</span>" * 50_000, "</script" * 120_000, "<script>x" * 100_000,
                 "<!--" * 250_000, "<li>a<ul>" * 20_000, "<article>" * 20_000 + "x", "<p>" * 100_000, "&" * 1_000_000):
        main_text(page)
    outline = extraction.page_outline("<article>" + "<div><p>q</p><div><p>z</p></div></div>" * 3000)
    extraction.Wrapper(outline).blocks("<article>" + "<div><p>q</p><div><div><p>z</p></div></div></div>" * 3000)
    assert time.perf_counter() - started < 60


def _tree(rng, depth):
    own = Container(rng.choice("abc"))
    own.kids = [_tree(rng, depth - 1) for _ in range(rng.randrange(4))] if depth else []
    return own


def _done(root):
    order, stack = [], [root]
    while stack:
        order.append(stack.pop())
        stack.extend(reversed(order[-1].kids))
    return _finished(order)


def _largest(a, b):
    if a.label != b.label:
        return 0
    best = [[0] * (len(b.kids) + 1) for _ in range(len(a.kids) + 1)]
    for i, p in enumerate(a.kids):
        for j, q in enumerate(b.kids):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + _largest(p, q))
    return best[-1][-1] + 1


def test_the_match_of_two_trees_is_the_largest():
    rng = random.Random(3)
    for _ in range(400):
        a, b = _done(_tree(rng, 3)), _done(_tree(rng, 3))
        pairs = matched(a, b)
        assert len(pairs) == _largest(a, b)
        assert len({id(p) for p, _ in pairs}) == len({id(q) for _, q in pairs}) == len(pairs)
        assert unpacked(packed(a)).kind == a.kind


class _Article(HTMLParser):
    """Blocks inside <article>, by the parser of the standard library."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.parts = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        if tag in ("p", "h1", "h2", "br", "li", "ul", "div", "article"):
            self.parts.append("")

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "h2", "li", "ul", "div", "article"):
            self.parts.append("")
        self.inside = self.inside and tag != "article"

    def handle_data(self, data):
        if self.inside:
            self.parts[-1] += data


@pytest.mark.skipif(not Path(SMALL).is_dir(), reason="the sample tables are not on this machine")
def test_sample_pages_by_another_parser(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    found = {r.page_id: r.text for r in extraction.extract(pages).collect()}
    assert len(found) == pages.count()
    for row in pages.collect():
        other = _Article()
        other.feed(row.html)
        assert found[row.page_id] == "\n".join(t for t in (" ".join(p.split()) for p in other.parts) if t)


def _tree(rng, depth=0):
    own = extraction.Container(rng.choice("ab"))
    if depth < 2:
        own.kids = [_tree(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return own


def _trees(*roots):
    order = list(roots)
    for own in order:
        order.extend(own.kids)
    if order:
        extraction._finished(order)
    return list(roots)


def test_long_lists_match_like_short_ones(monkeypatch):
    rng = random.Random(4)
    for _ in range(60):
        x = _trees(extraction.Container("r"))[0], _trees(extraction.Container("r"))[0]
        for root in x:
            root.kids = _trees(*(_tree(rng) for _ in range(rng.randint(0, 12))))
            extraction._finished([root])
        weighed = []
        for cells in (250_000, 0):
            monkeypatch.setattr(extraction, "TABLE_CELLS", cells)
            weight = {}
            if x[0].kind != x[1].kind:
                extraction._weigh(*x, weight)
            found = [(id(a), id(b)) for a, b in extraction.matched(*x)]
            weighed.append((weight, found))
        assert weighed[0] == weighed[1]


def test_partners_far_apart_in_long_lists_are_found():
    """Sixty other blocks in front on either side cost the blocks behind them no partner."""
    news, olds = ([extraction.Container(f"{name}{i}") for i in range(60)] for name in ("new", "old"))
    both = [[extraction.Container(f"block{i}") for i in range(600)] for _ in range(2)]
    x = _trees(*news, *both[0], extraction.Container("last"))
    y = _trees(*olds, *both[1], extraction.Container("end"))
    total, pairs = extraction._aligned(x, y, {})
    assert total == 600
    assert sorted(pairs) == [(60 + i, 60 + i) for i in range(600)]
