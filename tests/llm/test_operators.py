"""Each operator against brute force on small tables with nulls, ties, repeated rows and clashing names."""

from __future__ import annotations

import glob
import hashlib
import math
import random
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reledger.llm import ann, components, decontamination, extraction, jaccard_join, language_id, lm_scoring, mixing, near_duplicates, sharding, storage
from reledger.llm import suffix_dedup as suffixes
from reledger.llm import url_filter
from reledger.llm.storage import shared_dir, written

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, kind string, n int"


def _texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7)))
    base = [[word() for _ in range(60)] for _ in range(6)]
    passage = " ".join(word() for _ in range(40))
    rows: list[tuple[int | None, str | None]] = [(0, None), (1, ""), (2, " \t\n"), (3, "One two"), (4, "one TWO")]
    for i, words in enumerate(base):
        near = [*words[:-1], word()]
        rows += [(10 + i, " ".join(words)), (30 + i, " ".join(near).upper()), (50 + i, " ".join(words))]
        rows.append((70 + i, f"{word()} {passage} {word()} {' '.join(words[:9])}"))
    rows += [(90, f"{passage} {passage}"), (91, "é" * 150), (92, "x" * 400), (93, " ".join(word() for _ in range(6000)))]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else "de", f"s{i % 4}" if i % 4 else None, len(t or ""), 7, "k", 1) for i, t in _texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("false")


def _set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_jaccard_components(docs, nothing):
    sets = {i: _set(t) for i, t in _texts()}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if common and 100 * common >= 80 * len(sets[a] | sets[b]) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    for leaf in (512, 1):
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, leaf=leaf).collect()}
        assert found == {i: (len(s), root[i]) for i, s in sets.items()}
    assert jaccard_join.jaccard_components(nothing).collect() == []


@pytest.mark.parametrize("leaf,percent", [(512, 80), (4, 60)])
def test_jaccard_components_of_crowds(spark, leaf, percent):
    """Near copies of a few texts, passages that many texts share, and chains of edits, of many sizes."""
    rng = random.Random(percent + leaf)
    word = lambda: f"w{rng.randrange(100_000)}"
    passage = [word() for _ in range(30)]
    texts = []
    for length in (12, 40, 90):
        base = [word() for _ in range(length)] + passage
        for _ in range(70):
            near = list(base)
            for _ in range(rng.randrange(5)):
                near[rng.randrange(len(near))] = word()
            texts.append(near[rng.randrange(3) : len(near) - rng.randrange(8)])
        for _ in range(20):  # each a little further from the first
            base = [*base[2:], word(), word()]
            texts.append(list(base))
    texts += [[*(word() for _ in range(rng.randrange(60))), *passage, *(word() for _ in range(rng.randrange(9)))] for _ in range(80)]
    sets = [_set(" ".join(t)) for t in texts]
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    rows = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    found = jaccard_join.jaccard_components(rows, percent, leaf=leaf).collect()
    assert {r.doc_id: r.component_id for r in found} == {i: top(i) for i in range(len(sets))}


def test_suffix_dedup(docs, nothing):
    seen, expected = set(), {}
    for i, text in sorted(_texts()):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for at in range(len(raw) - 99):
            window = raw[at : at + 100]
            if window in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(window)
        kept = bytes(c for c, x in zip(raw, gone, strict=True) if not x)
        spans = sum(1 for x in bytes(gone).split(b"\0") if x)
        expected[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    assert {r.doc_id: tuple(r)[1:] for r in suffixes.suffix_dedup(docs).collect()} == expected
    assert suffixes.suffix_dedup(nothing).collect() == []


def test_suffix_dedup_keeps_no_spent_tables(spark):
    """Of the intermediate tables only the spans are left for the lazy result, which is whole."""
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(i, f"{i} begins {passage} ends {i}. {passage}") for i in range(9)], "doc_id long, text string")
    folder = f"{shared_dir(spark).removeprefix('file://')}/reledger-llm"
    before = set(glob.glob(f"{folder}/*"))
    found = suffixes.suffix_dedup(docs)
    left = {path for path in set(glob.glob(f"{folder}/*")) - before if glob.glob(f"{path}/part-*")}
    assert {path.rsplit("/", 1)[1].split("-")[0] for path in left} == {"spans"}
    removed = {r.doc_id: r.n_removed for r in found.collect()}
    assert removed[0] == len(f" {passage}") and all(removed[i] > 2 * len(passage) for i in range(1, 9))


def test_suffix_dedup_of_one_id_with_different_texts(spark):
    """A text of its own keeps all its bytes whatever else has its id; copies lose theirs."""
    rng = random.Random(11)
    text = ["".join(rng.choice("abcdef ") for _ in range(n)) for n in (400, 588, 300)]
    rows = [(1, text[0]), (2, f"x{text[0]}y"), (2, text[1]), (2, text[1]), (3, text[2]), (None, text[0]), (4, None), (4, text[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    expected = Counter()
    for i, t in rows:
        removed = 400 if t == rows[1][1] else 300 if (i, t) == (4, text[2]) else 0
        kept = {400: "xy", 300: ""}.get(removed, t or "").encode()
        expected[(i, len((t or "").encode()), removed, int(removed > 0), hashlib.sha256(kept).hexdigest())] += 1
    found = suffixes.suffix_dedup(docs.repartition(3))
    assert Counter(map(tuple, found.collect())) == expected and found.columns[0] == "doc_id"


def test_containment(spark, docs, nothing):
    items = {1: _texts()[8][1], 2: None, 3: "one two", 4: " ".join((_texts()[5][1] or "").split()[:9])}
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    expected = set()
    for i, text in _texts():
        for j, item in items.items():
            wanted = _set(item)
            if wanted and 100 * len(wanted & _set(text)) >= 80 * len(wanted):
                expected.add((i, j, len(wanted), len(wanted & _set(text))))
    found = decontamination.contained_items(docs, table)
    assert {tuple(r)[:4] for r in found.collect()} == expected and expected
    clean = decontamination.decontaminated(docs, table)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in _texts()} - {e[0] for e in expected}
    assert decontamination.contained_items(nothing, table).collect() == []
    assert decontamination.contained_items(docs, table.where("false")).collect() == []


def test_decontaminated_judges_rows(spark):
    """Rows without an id, or with one id and different texts, go only for their own text."""
    item = "one two three four five six seven eight nine ten"
    half = [f"a {item[:28]} b", f"c {item[14:]} d"]
    texts = [(None, f"x {item} y"), (None, "clean text of seven words in all"), (None, half[0]), (None, half[1]), (None, None)]
    texts += [(1, f"{item} z"), (1, "another clean text of some words"), (2, item), (3, "clean text of seven words in all")]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = decontamination.decontaminated(rows, table).collect()
    assert sorted(map(str, found)) == sorted(str(r) for r in rows.collect() if item not in (r.text or ""))


def test_clashing_columns(spark, docs):
    """Columns named like those used inside change nothing and come back as they were."""
    names = ["kept_id", "kept_whole", "held_text", "row", "whole", "id", "place", "doc_id_", "size", "key"]
    clashing = docs.select("*", *(F.lit(i).alias(name) for i, name in enumerate(names)))
    items = spark.createDataFrame([(1, _texts()[8][1])], "item_id long, text string")
    for stage in (near_duplicates.one_of_each, lambda d: decontamination.decontaminated(d, items), mixing.mix):
        plain, other = stage(docs), stage(clashing)
        assert other.columns == clashing.columns
        kept = Counter((r.doc_id, r.text) for r in plain.collect())
        assert Counter((r.doc_id, r.text) for r in other.collect()) == kept


def test_mixing(docs, nothing):
    rows = mixing.mix_digest(docs).collect()
    assert len(rows) == docs.count()
    total = sum(r.size for r in rows)
    targets = {}
    for r in rows:
        taken, _ = targets.get(r.target, (0, 0))
        targets[r.target, r.source_size] = (targets.get((r.target, r.source_size), (0, 0))[0] + r.taken, r.target)
        assert 0 <= r.taken <= 2 * r.size
    assert sum(t for t, _ in targets) == pytest.approx(1.5 * total)
    for (target, _), (taken, _) in targets.items():
        assert abs(taken - target) <= 1
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len(r.text.split()) for r in mixed.collect()) == sum(r.taken for r in rows)
    assert mixing.mix_digest(nothing).collect() == [] and mixing.mix(nothing).collect() == []


def test_mixing_of_null_and_repeated_ids(spark):
    """No row takes more than twice its size, whatever its id, and no word of a target is lost."""
    rng = random.Random(9)
    size = {i: " ".join(f"w{rng.randrange(50)}" for _ in range(n)) for i, n in enumerate((2, 1, 100, 7, 30))}
    rows = [(None, size[i], "a", i) for i in range(5)] + [(1, size[2], "b", i % 3) for i in range(40)]
    rows += [(1, size[3], "b", 0), (None, None, "c", 1), (None, "", None, 1), (None, size[4], None, None), (2, size[3], "c", 5)]
    rows += [(None, size[1], "d", None)] * 2500
    table = spark.createDataFrame(rows, "doc_id long, text string, source string, key int").repartition(5)
    for total, seed in ((1.5, 17), (0.37, 3), (1.01, 5)):
        digest = mixing.mix_digest(table, share=total, seed=seed).collect()
        assert len(digest) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in digest)
        mixed = mixing.mix(table, share=total, seed=seed, n_chars=None).collect()
        words = Counter()
        for r in mixed:
            words[r.source] += len(r.text.split())
            assert r.text and any((r.doc_id, r.key) == (i, k) and (t or "").startswith(r.text) for i, t, _, k in rows)
        taken, target = Counter(), {}
        for r in digest:
            taken[r.source_size, r.target] += r.taken
            target[r.source_size, r.target] = r.target
        assert sorted(taken.values()) == sorted([*words.values(), *[0] * (len(taken) - len(words))])
        assert all(taken[k] == round(t) for k, t in target.items())
        assert Counter(map(tuple, digest)) == Counter(map(tuple, mixing.mix_digest(table.repartition(3), share=total, seed=seed).collect()))


def test_sharding(docs, nothing):
    rows = sharding.shard_digest(docs.unionByName(docs.limit(3)), 5).collect()
    shards = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(5)}
    assert all(slots == list(range(len(slots))) for slots in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    texts = dict(_texts())
    for r in rows:
        raw = (texts[r.doc_id] or "").encode()
        assert r.size == len(raw) + 8
        assert r.text_crc32 == (None if texts[r.doc_id] is None else zlib.crc32(raw))
    placed = sharding.shard_rows(docs)
    assert sorted(placed.columns) == sorted([*docs.columns, "slot"]) and placed.count() == docs.count()
    assert sharding.shard_digest(nothing).collect() == []


def test_sharding_of_a_hot_id_and_of_one_shard_more(spark):
    """A third of the rows without id and text; the walk of the ring moves few rows for one more shard."""
    rows = [(None, None, i % 7) for i in range(1500)] + [(i, f"text {i}", 0) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    placed = [sharding.shard_rows(docs.repartition(k), shards) for k, shards in ((3, 24), (5, 24), (3, 25))]
    kept = [Counter(map(tuple, d.collect())) for d in placed]
    assert kept[0] == kept[1] and sum(kept[0].values()) == 4500
    where = [{r.doc_id: r.shard for r in d.where("doc_id is not null").collect()} for d in (placed[0], placed[2])]
    moved = sum(where[0][i] != where[1][i] for i in where[0])
    assert 0 < moved < 0.3 * 3000
    for d, shards in zip(placed, (24, 24, 25), strict=True):
        sizes = Counter(r.shard for r in d.select("shard").collect())
        assert max(sizes.values()) - min(sizes.values()) <= 1 and len(sizes) == shards


def test_language_id(spark, docs, nothing):
    rows = [(i, "the cat and the dog of the house " * 3, "en") for i in range(8)]
    rows += [(i + 8, "der hund und die katze des hauses " * 3, "de") for i in range(8)]
    known = language_id.dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    asked = spark.createDataFrame(
        [(1, "THE HOUSE and the dog!!"), (2, "die Katze und der Hund"), (3, None), (4, "12 34"), (5, "")], "doc_id long, text string"
    )
    found = {r.doc_id: r for r in language_id.identify(asked, known).collect()}
    assert {i: r.lang_pred for i, r in found.items()} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und"}
    assert all(0 <= r.score <= 1 for r in found.values()) and found[3].rejected and not found[1].rejected
    assert language_id.identify(docs, {}).where("lang_pred <> 'und'").count() == 0
    marks = spark.createDataFrame([(1, "\u0301 \u0308 1")], "doc_id long, text string")
    assert [r.lang_pred for r in language_id.identify(marks, known).collect()] == ["und"]
    # Texts that all open alike teach what follows, whatever their opening looks like.
    opening = "12345 <tag> " * 400
    alike = [(i, opening + "der hund und die katze des hauses " * 40, "de") for i in range(30)]
    alike += [(None, f"{opening} {i} " + "the cat and the dog of the house " * 40, "en") for i in range(30)]
    learned = language_id.dictionaries(spark.createDataFrame(alike, "doc_id long, text string, lang string"), chars=200)
    assert {r.doc_id: r.lang_pred for r in language_id.identify(asked.where("doc_id < 3"), learned).collect()} == {1: "en", 2: "de"}
    assert language_id.identify(nothing, known).collect() == []
    assert language_id.recognised(docs, known).columns == docs.columns


@pytest.mark.parametrize("scale", [1e200, 1e-200])
def test_nearest_of_very_large_and_very_small_vectors(spark, scale):
    rng = random.Random(13)
    rows = [(i, [rng.gauss(0, 1) * scale for _ in range(4)]) for i in range(60)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.nearest(table, "vec_id % 20 = 0", k=5).collect()
    assert Counter(r.query_id for r in found) == {0: 5, 20: 5, 40: 5}
    if scale > 1:
        return  # products are infinite, so any neighbour is as near as the next
    assert all(r.query_id != r.vec_id for r in found)


def test_nearest(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(i, [1.0] * 8) for i in range(300, 340)] + [(400, None), (401, []), (402, [0.0] * 8), (403, [float("nan")] * 8)]
    rows += [rows[0]]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    good = {i: [float(x) for x in v] for i, v in rows[:340]}
    good = {r.vec_id: list(r.embedding) for r in table.where("vec_id < 340").collect()}
    found = ann.nearest(table, "vec_id % 20 = 0", k=10)
    hits = total = 0
    for query in [i for i in good if i % 20 == 0]:
        score = lambda i: sum(a * b for a, b in zip(good[i], good[query], strict=True))  # noqa: B023, E731
        best = sorted((i for i in good if i != query), key=lambda i: (-round(score(i), 9), i))[:10]
        got = found.where(f"query_id = {query}").orderBy("rank").collect() if query in (0, 320) else None
        if got is not None:
            assert [r["rank"] for r in got] == list(range(1, 11))
            hits += len(set(best) & {r.vec_id for r in got})
            total += 10
    assert hits / total >= 0.9
    assert ann.nearest(table.where("false"), "vec_id % 20 = 0").collect() == []


def test_url_rules(spark):
    urls = [None, "", "no scheme", "HTTPS://A.Example.NET/en/x?q#f", "http://b.net/de", "http://x.org/fr/1", "http://x.org#/fr/",
            "http://example.com/de/", "http://notexample.com/de/", "http://c.net"]
    pages = spark.createDataFrame([(i, u, "n") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rows = {r.page_id: r for r in url_filter.url_verdicts(pages).collect()}
    assert [rows[i].rule for i in range(10)] == [None, None, None, "example.net/en/", "net/", "org/fr/", None, "example.com/de/", None, None]
    assert (rows[3].host, rows[3].path) == ("a.example.net", "/en/x") and rows[9].path == ""
    assert all(r.verdict in ("allow", "block") for r in rows.values())
    assert url_filter.url_verdicts(pages.where("false")).collect() == []


def test_url_statistics_cover_all_labelled(spark):
    """A URL repeated beyond the sample leaves others in it; statistics are of all labelled rows."""
    urls = [f"http://a{i}.example.net/en/{i}" for i in range(30)] + [f"http://b{i}.other.net/x/{i}" for i in range(30)]
    first = spark.createDataFrame([(u,) for u in urls], "url string").orderBy("url").selectExpr("url", "xxhash64(url) h").orderBy("h").first().url
    urls += [first] * 100 + ["http://c.example.com/en/1", "http://c.other.com/x/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_filter.url_verdicts(pages, sample=50).where("rule is null").collect()
    assert len(rows) == 2 and all(r.score is not None for r in rows)
    seen = {}
    plain = url_filter._with_statistics
    try:
        url_filter._with_statistics = lambda rows, tables, prior, own: seen.update(tables=tables, prior=prior) or plain(rows, tables, prior, own)
        url_filter.url_verdicts(pages, sample=5)
    finally:
        url_filter._with_statistics = plain
    segments = {r[0]: (r[1], r[2]) for r in seen["tables"]["first_segment"][1].collect()}
    more = "/en/" in first
    assert segments == {"en": (0.0, 130 if more else 30), "x": (30.0 if more else 130.0, 30 if more else 130)}
    assert seen["prior"] == pytest.approx((30 if more else 130) / 160)


def test_extraction(spark):
    page = (
        "<html><head><title>T</title><script>var t='</p>';</script></head><body><nav><a>Menu</a></nav><div class=ad>Buy</div>"
        "<article><h1>Head &amp; {0}</h1><p><b>First  {0}<br><p>second\n{0}</article><div id=comments>no</div><footer>f</footer>"
    )
    rows = [(i, "http://h.net/a", page.format(i)) for i in range(4)] + [(9, None, None), (10, "x", ""), (11, "x", "<p>only"), (12, "x", "<<>&am")]
    found = {r.page_id: r for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[i].text == f"Head & {i}\nFirst {i}\nsecond {i}" for i in range(4))
    assert (found[9].text, found[9].n_chars, found[10].text, found[11].text) == ("", 0, "", "only")


def test_cross_entropy(spark, docs, nothing):
    near = docs.where("doc_id >= 70 and doc_id < 76").select("doc_id")
    rows = {r.doc_id: r for r in lm_scoring.cross_entropy_difference(docs, near).collect()}
    assert len(rows) == docs.count() and rows[0].score is None and rows[0].n_tokens == 0
    assert max(rows[i].score for i in range(70, 76)) < min(rows[i].score for i in range(10, 16))
    assert lm_scoring.cross_entropy_difference(nothing, near).collect() == []
    assert lm_scoring.cross_entropy_difference(docs, near.where("false")).count() == docs.count()


def test_cross_entropy_counts_all(spark, docs):
    """Every word and bigram counts, also those that only the background has, whatever is broadcast."""
    near = set(range(70, 76))
    texts = [(i, "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()) for i, t in [*_texts(), (None, "one two three")]]
    models = []
    for corpus in ([w for i, w in texts if i in near], [w for _, w in texts]):
        models.append((Counter((h, x) for w in corpus for h, x in zip([None, *w], w)), Counter(x for w in corpus for x in w)))
    size = len(models[1][1]) + 1

    def loss(model, words):
        pairs, single = model
        total = 0.0
        for h, w in zip([None, *words], words):
            seen, kinds = after[id(model)].get(h, (0, 0))
            share, left = (max(pairs[h, w] - 0.5, 0) / seen, 0.5 * kinds / seen) if seen else (0.0, 1.0)
            total -= math.log(share + left * (single[w] + 1) / (sum(single.values()) + size))
        return total / len(words)

    after = {}
    for model in models:
        own = after[id(model)] = {}
        for (h, _), n in model[0].items():
            own[h] = (own.get(h, (0, 0))[0] + n, own.get(h, (0, 0))[1] + 1)
    expected = {i: (len(w), *(loss(m, w) if w else None for m in models)) for i, w in texts}
    more = docs.unionByName(docs.limit(1).selectExpr("cast(null as long) doc_id", "'one two three' text"), allowMissingColumns=True)
    ids = spark.createDataFrame([(i,) for i in near], "doc_id long")
    for options in ({}, {"hot": 40}):
        rows = lm_scoring.cross_entropy_difference(more, ids, **options).collect()
        assert len(rows) == len(texts)
        for r in rows:
            n, target, background = expected[r.doc_id]
            assert r.n_tokens == n
            if n:
                assert (r.target_loss, r.background_loss) == pytest.approx((target, background), abs=1e-8)
                assert r.score == pytest.approx(target - background, abs=1e-8)


def test_nearest_of_every_query(spark):
    """The recall of `test_nearest` over all queries, on shards large enough that nodes are not all linked."""
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(3000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(2)
    good = np.array([r.embedding for r in table.orderBy("vec_id").collect()])
    found: dict[int, list[int]] = {}
    for r in ann.nearest(table, "vec_id % 20 = 0", k=10).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert sorted(found) == list(range(0, 3000, 20))
    hits = 0
    for query, got in found.items():
        score = good @ good[query]
        score[query] = -np.inf
        assert len(got) == len(set(got)) == 10 and query not in got
        hits += len(set(np.argsort(-score)[:10].tolist()) & set(got))
    assert hits / (10 * len(found)) >= 0.9


def test_cross_entropy_packs_its_counts(spark, docs):
    """Chunks and buckets of any size give the same rows, and no shuffle carries single bigrams."""
    near = docs.where("doc_id >= 70 and doc_id < 76").select("doc_id")
    whole, parts = (
        sorted((tuple(r) for r in lm_scoring.cross_entropy_difference(docs, near, **o).collect()), key=repr)
        for o in ({}, {"chunk": 100, "bucket": 64})
    )
    assert whole == parts and len(whole) == docs.count()
    chunks = lm_scoring._chunks(docs.select(F.col("doc_id").alias("id"), "text", (F.col("doc_id") > 80).alias("near")), 1 << 19)
    assert lm_scoring._ask_bigrams(chunks, 0).count() <= docs.rdd.getNumPartitions()
    keys = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    assert (lm_scoring._hashes(lm_scoring._steps(keys)) == keys).all()


def test_suffix_dedup_chains_no_python_workers(spark, docs):
    """A task of the last step has one Python worker: a filter of its own took a second one's memory."""
    plan = suffixes.suffix_dedup(docs.select("doc_id", "text"))._jdf.queryExecution().optimizedPlan().toString()
    depth = [line.index("MapInArrow") for line in plan.splitlines() if "MapInArrow" in line]
    assert len(depth) == 3, plan


def test_written_leaves_no_shuffle(spark, monkeypatch):
    """The shuffle files of a written table are gone before the next step needs disk."""
    monkeypatch.setattr(storage, "_released", [0.0])
    tracker = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    written(spark.range(1000).selectExpr("id % 7 as k").repartition(3, "k"), "trial")
    deadline = time.monotonic() + 5
    while time.monotonic() < deadline and tracker.shuffleStatuses().size() > before:
        time.sleep(0.1)
    assert tracker.shuffleStatuses().size() <= before


def test_components_of_random_edges(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(500 + i, 501 + i) for i in range(40)]
    edges += [(900, 900), (None, 3), (4, None), *((950, 951 + i) for i in range(30)), *edges[:9]]
    least = {x: x for u, v in edges if None not in (u, v) and u != v for x in (u, v)}
    for _ in least:
        for u, v in edges:
            if u in least and v in least:
                least[u] = least[v] = min(least[u], least[v])
    table = spark.createDataFrame(edges, "u long, v long").repartition(3)
    assert sorted(map(tuple, components.components(table).collect())) == sorted(least.items())
    assert components.components(table.where("u < 0")).collect() == []
    assert components.components(table.where("u = v")).collect() == []
    assert components.components(table.where("false")).collect() == []


def test_components_rounds_are_small(spark, monkeypatch):
    """A round is one written plan without repeated sums: plans and their threads fill the driver."""
    plans, rows = [], spark.range(64).selectExpr("id as u", "id + 1 as v")

    def kept(df, name):
        plans.append(df._jdf.queryExecution().sparkPlan().toString())
        return written(df, name)

    monkeypatch.setattr(components, "written", kept)
    asked = []
    monkeypatch.setattr(type(rows), "first", lambda df: asked.append(df) or df.take(1)[0])
    assert components.components(rows).where("component = 0").count() == 65
    assert len(plans) > 2 and not asked
    assert max(plan.count("HashAggregate") for plan in plans) <= 14


def test_components_plan_the_large_star_twice_at_most(spark):
    """As rows and for their minimum: every further use was planned differently and so ran anew."""
    edges = spark.range(64).selectExpr("id + 1 as u", "id as v")
    plan = components._small_star(components._large_star(edges))._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Join") <= 3
