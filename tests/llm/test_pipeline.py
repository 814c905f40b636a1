"""The five stages of the pipeline, each against brute force on its own input."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from reledger.llm.language_id import MIN_MARGIN, UNDETERMINED, Classifier, dictionaries
from reledger.llm.storage import written

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).is_dir(), reason="the sample tables are not on this machine")


def _words(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()


def _shingles(text):
    words = _words(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _filled(sizes):
    """Targets of sources by raising one level for all until the total is shared out."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        above = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not above:
            return target | {s: weight[s] * level for s in free}
        target |= {s: 2.0 * sizes[s] for s in above}
        free -= above
    return target


def test_every_stage_by_brute_force(spark):
    plain = spark.read.parquet(f"{SMALL}/documents.parquet")
    some = plain.limit(12).collect()
    more = [(None, r.text, r.lang, r.source, r.n_chars) for r in some[:4]]  # copies without an id
    more += [(10_000 + r.doc_id, f"{r.text} end", r.lang, None, r.n_chars) for r in some[4:8]]
    more += [(some[9].doc_id, "der einzige andere text unter dieser nummer ist kurz", "de", "x", 5), (77_777, None, None, "x", 0)]
    docs = written(plain.unionByName(spark.createDataFrame(more, plain.schema)), "test-docs")
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]

    def stage(name, given):
        out = written(dict(corpus_pipeline.STAGES)[name](spark, given, SMALL), f"test-{name}")
        return out, [tuple(r) for r in out.select(*docs.columns).collect()]

    rows = [tuple(r) for r in docs.collect()]
    judge = Classifier(dictionaries(docs))
    docs1, kept = stage("language_id", docs)
    found = {r: judge(r[1]) for r in rows}
    expected = Counter(r for r in rows if found[r][0] != UNDETERMINED and found[r][1] >= MIN_MARGIN)
    assert Counter(kept) == expected and 0 < len(kept) < len(rows)

    docs2, left = stage("near_duplicates", docs1)
    sets = {text: _shingles(text) for _, text, *_ in kept}
    root = {text: text for text in sets}
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if root[a] != root[b] and common and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                low, high = sorted((root[a], root[b]))
                root = {t: low if r == high else r for t, r in root.items()}
    least = {}
    for i, text, *_ in kept:
        least[root[text]] = min(least.get(root[text], (True, 0)), (i is None, i or 0))
    assert Counter(root[r[1]] for r in left) == Counter(dict.fromkeys(least, 1)) and len(left) < len(kept)
    assert {root[r[1]]: (r[0] is None, r[0] or 0) for r in left} == least and set(left) <= set(kept)

    docs3, clean = stage("decontamination", docs2)
    wanted = [_shingles(item) for item in items]
    held = [r for r in left if any(w and 100 * len(w & _shingles(r[1])) >= 80 * len(w) for w in wanted)]
    assert Counter(clean) == Counter(left) - Counter(held) and held

    docs4, mixed = stage("mixing", docs3)
    sizes, taken, times = Counter(), Counter(), Counter()
    for r in clean:
        sizes[r[3]] += len(_words(r[1]))
    given = {(r[0], r[3]): r for r in clean}
    for r in mixed:
        taken[r[3]] += len(_words(r[1]))
        times[r[0], r[3]] += 1
        whole = given[r[0], r[3]]
        assert r == whole or (whole[1].startswith(r[1]) and r[4] == len(r[1]))
    assert dict(taken) == {s: round(t) for s, t in _filled(sizes).items() if round(t)}
    assert max(times.values()) <= 2

    docs5 = dict(corpus_pipeline.STAGES)["sharding"](spark, docs4, SMALL)
    sharded = docs5.collect()
    assert Counter(tuple(r[c] for c in docs.columns) for r in sharded) == Counter(mixed)
    slots = {s: sorted(r.slot for r in sharded if r.shard == s) for s in range(24)}
    assert all(own == list(range(len(own))) for own in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
