"""Periodic runs, SimHash classes and phrases against brute force, with nulls, ties, repeated rows and clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from reledger.llm.periodic_runs import periodic_runs, run_digest, with_planted_periods
from reledger.llm.phrases import collocations, packed
from reledger.llm import simhash
from reledger.llm.simhash import covering_links, covering_masks, simhash_components

SCHEMA = "doc_id long, text string, lang string, print int, runs string, f int, z int, n int, key int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "x", 2, 3, 4, 5) for i, t, lang in rows], SCHEMA).repartition(3)


def _periodic_texts():
    rng = random.Random(5)
    word = lambda k: f"w{rng.randrange(k)}"
    rows = [(0, None), (1, ""), (2, " \t\n"), (None, None), (3, "a"), (4, "a " * 11), (5, "a " * 12), (6, "\ta\x0b" * 40)]
    rows += [(7, "ab\x0cc " * 9 + "ab c d"), (7, "ab\x0cc " * 9), (None, "x y z " * 7), (8, "A a " * 6)]
    for i in range(20, 260):
        words = []
        while len(words) < 60:
            stretch = [word(rng.choice((1, 2, 9))) for _ in range(rng.randint(1, 12))]
            words += stretch * rng.randint(1, 5) + stretch[: rng.randint(0, 4)]
        rows.append((i, " ".join(words)))
    rows.append((300, " ".join(word(3000) for _ in range(40_000))))
    rows.append((301, "same " * 60_000 + "other"))
    return rows


def _planted(doc_id, words):
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def _runs(words, least=12):
    best = {}
    for q in range(1, min(len(words) // 2, 200) + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(least, 2 * q):
                best.setdefault((s, i + q), q)
            i += 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def test_periodic_runs(spark):
    texts = _periodic_texts()
    docs = _frame(spark, [(i, t, "en") for i, t in texts])
    expected = Counter()
    for i, text in texts:
        words = _planted(i, (text or "").encode().split())
        runs = _runs(words)
        gone = {at for s, n, q in runs for at in range(s + q, s + n)}
        kept = b" ".join(w for at, w in enumerate(words) if at not in gone)
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()
        milli = None if n is None else 1000 * n // q
        hashes = hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest()
        expected[(i, len(runs), s, n, q, milli, *hashes)] += 1
    found = run_digest(periodic_runs(with_planted_periods(docs)))
    assert Counter(map(tuple, found.collect())) == expected
    assert max(r[1] for r in expected) > 3
    assert run_digest(periodic_runs(with_planted_periods(docs.where("false")))).collect() == []


def _print(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _classes(values, radius):
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for u in values:
        for v in values:
            if u < v and (u ^ v).bit_count() <= radius:
                root[top(u)] = top(v)
    groups = {}
    for v in values:
        groups.setdefault(top(v), set()).add(v)
    return sorted(map(sorted, groups.values()))


def test_simhash_components(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6)))
    rows = [(0, None), (1, ""), (None, " \n"), (2, "One"), (3, "one two"), (4, "ONE TWO"), (None, "alone with no id here")]
    for i in range(8):
        words = [word() for _ in range(150)]
        for j in range(14):
            near = list(words)
            for _ in range(j % 4):
                near[rng.randrange(150)] = word()
            rows.append((None if j == 0 else 100 * (i + 1) - j, " ".join(near)))
    rows += [(5, rows[40][1]), (5, "another text under this id")]
    values = {t: _print(t) for _, t in rows}
    classes = {v: tuple(group) for group in _classes(set(values.values()), 3) for v in group}
    least = {}
    for i, t in rows:
        group = classes[values[t]]
        least[group] = min((x for x in (least.get(group), i) if x is not None), default=None)
    expected = Counter((i, f"{values[t]:016x}", least[classes[values[t]]]) for i, t in rows)
    docs = _frame(spark, [(i, t, "en") for i, t in rows])
    assert Counter(map(tuple, simhash_components(docs).collect())) == expected
    assert len(set(classes.values())) < len(classes)
    assert simhash_components(docs.where("false")).collect() == []


def test_simhash_memory_of_long_texts(spark, monkeypatch):
    """A worker unpacks the hashes of a long text piece by piece, and a block ends with its batch."""
    docs = _frame(spark, [(1, "a", None)])
    monkeypatch.setattr(type(docs), "mapInArrow", lambda rows, run, kind: run)
    run = simhash.fingerprints(docs)
    words = [b"w%d" % (i * i % 7919) for i in range(250_000)]
    batch = pa.record_batch([pa.array([1, 2, 3]), pa.array([b" ".join(words), None, b"B a"])], names=["doc_id", "text"])
    tracemalloc.start()
    found = [row for block in run(iter([batch, batch.slice(1), batch.slice(3)])) for row in block.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    whole = np.array([xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)], dtype="<u8")
    bit = lambda i: int(2 * int(((whole >> np.uint64(i)) & np.uint64(1)).sum()) > len(whole))
    first, short = sum(bit(i) << i for i in range(64)), xxhash.xxh64_intdigest(b"b a", 42)
    assert [(row["doc_id"], row["print"] % 2**64) for row in found] == [(1, first), (2, 0), (3, short), (2, 0), (3, short)]
    assert peak < 80 * 2**20


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_covering_masks(radius):
    masks = covering_masks(radius)
    rng = random.Random(radius)
    for _ in range(2000):
        changed = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not mask & changed for mask in masks)
    assert all(20 < mask.bit_count() < 50 for mask in masks)


@pytest.mark.parametrize("few,flipped", [(512, False), (0, True)])
def test_classes_that_share_a_large_bucket_are_compared(spark, monkeypatch, few, flipped):
    """A crowd and classes at exactly three bits from it: pairs, not all values of two changed bits."""
    rng = random.Random(12)
    centre = rng.getrandbits(64)
    crowd = {centre ^ 1 << b for b in range(40)} | {centre}
    far = {centre ^ sum(1 << b for b in rng.sample(range(64), 3)) for _ in range(30)}
    values = sorted(crowd | far | {rng.getrandbits(64) for _ in range(20)})
    seen = []
    stars = simhash._stars
    monkeypatch.setattr(simhash, "_stars", lambda around, by: (seen.append(by), stars(around, by))[1])
    prints = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "print long")
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for r in covering_links(prints, 3, 16, few).collect():
        root[top(r.u & (1 << 64) - 1)] = top(r.v & (1 << 64) - 1)
    groups = {}
    for v in values:
        groups.setdefault(top(v), []).append(v)
    assert sorted(groups.values()) == _classes(values, 3)
    assert (["table", "key", "z"] in seen) == flipped


@pytest.mark.parametrize("radius,small", [(1, 2), (2, 2), (3, 2), (3, 16)])
def test_links_of_large_buckets(spark, radius, small):
    """Crowds around a few centres, chains of exactly `radius` bits, and values on their own."""
    rng = random.Random(radius)
    values = {rng.getrandbits(64) for _ in range(40)}
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(70):
            values.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius + 1))))
        # Codes that differ in many bits, in crowds that differ in few: only links of `radius` bits join them.
        for start in range(0, 60, radius):
            centre ^= sum(1 << b for b in range(start, start + radius))
            values.add(centre)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "print long")
    links = {(r.u & (1 << 64) - 1, r.v & (1 << 64) - 1) for r in covering_links(prints, radius, small).collect()}
    root = {v: v for v in values}

    def top(v):
        while root[v] != v:
            v = root[v]
        return v

    for u, v in links:
        root[top(u)] = top(v)
    groups = {}
    for v in values:
        groups.setdefault(top(v), set()).add(v)
    assert sorted(map(sorted, groups.values())) == _classes(values, radius)


def _phrases(rows, least, per_lang, percent):
    counts, total = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lowered):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            total[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        candidates = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        scored = []
        for g, a in candidates.items():
            if any(
                len(h) > len(g) and 100 * b >= percent * a and any(h[i : i + len(g)] == g for i in range(len(h)))
                for h, b in candidates.items()
            ):
                continue
            score, k = min((1_000_000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            scored.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:per_lang], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return Counter(out)


@pytest.mark.parametrize("budget", [1 << 20, 40])
def test_collocations(spark, budget):
    rng = random.Random(7)
    rows = [(0, None, "en"), (1, "", None), (2, " \t .", "en"), (3, "x", "fr"), (None, "New York, new york; NEW YORK!", None)]
    common = ["new york", "the", "of the", "café au lait", "it is", "Straße"]
    for i in range(240):
        words = []
        for _ in range(rng.randint(1, 25)):
            words.append(rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(30)}")
            words.append(rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "\x0b"]))
        rows.append((i % 50, "".join(words), rng.choice(["en", "en", "fr", None])))
    docs = _frame(spark, rows)
    for least, per_lang in ((3, 25), (10, 2000)):
        found = collocations(docs, min_count=least, per_lang=per_lang, budget=budget)
        assert Counter(map(tuple, found.collect())) == _phrases(rows, least, per_lang, 50)
    assert collocations(docs.where("false")).collect() == []


def test_groups_fit_the_budget():
    weights = np.array([5, 0, 4, 25, 3, 8, 10, 1])
    first, spread, part = packed(weights, 10)
    load = Counter()
    for weight, group, groups in zip(weights, first, spread, strict=True):
        for i in range(groups):
            load[int(group) + i] += weight / groups
    assert max(load.values()) <= 10 and spread[3] == 3 and first[3] == part
