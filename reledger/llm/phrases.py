"""Phrase collocations from depth-truncated suffix subtrees, partitioned by word prefixes.

The suffixes of all pieces, cut after three words, are dealt to groups by their first word, so that
each group fits a memory budget; the suffixes of a prefix that is above the budget alone are dealt by
all their words. A group sorts its suffixes into a subtree of its own: equal suffixes are a leaf, and
a node's count is the total of its leaves. Words below the least count start no node and end every
suffix, since a phrase is never more frequent than its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bitmaps import bitmap, member
from .rolling import Roller, blocks, mix
from .storage import written

MIN_COUNT = 10
PER_LANG = 2000
UNDETERMINED = "und"
#: Bytes of texts worked on at a time.
BLOCK_BYTES = 1 << 21
#: Suffixes a group: what one subtree holds in memory.
GROUP_SUFFIXES = 1 << 18
#: Prefixes are counted in so many bins, whatever the number of words.
BIN_BITS = 16
BITMAP_BITS = 24

_BREAK = np.zeros(256, dtype=bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_OUTSIDE = _BREAK.copy()
_OUTSIDE[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_WORDS = Roller(29)
_FACTORS = [np.uint64(int(x) | 1) for x in mix(np.arange(211, 214, dtype=np.uint64))]


class Words:
    """The words of a block of texts: place, hash, language, and whether the next is in their piece."""

    def __init__(self, block: np.ndarray, offsets: np.ndarray, langs: list[str]):
        self.block = _LOWER[block]
        inside = ~_OUTSIDE[block]
        edge = np.zeros(len(block) + 1, dtype=bool)
        edge[offsets] = True  # a text's end ends its last word
        before = np.concatenate([[False], inside[:-1]])[: len(block)]
        after = np.concatenate([inside[1:], [False]])[: len(block)]
        self.start = np.flatnonzero(inside & (~before | edge[:-1]))
        self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        text = np.searchsorted(offsets, self.start, side="right") - 1
        breaks = np.cumsum(_BREAK[block])[self.start]
        self.joined = np.zeros(len(self.start), dtype=bool)
        self.joined[:-1] = (text[1:] == text[:-1]) & (breaks[1:] == breaks[:-1])
        names, code = np.unique(np.array(langs, dtype=object), return_inverse=True)
        seeds = np.array([xxhash.xxh64_intdigest(name.encode()) for name in names], dtype=np.uint64)
        self.names, self.lang = names, code[text]
        plain = _WORDS.windows(_WORDS.prefix(self.block), self.start, self.end) + (self.end - self.start).astype(np.uint64)
        value = mix(mix(plain) ^ seeds[self.lang]) if len(self.start) else plain
        self.hash = np.where(value == 0, np.uint64(1), value)  # 0 stands for the end of a suffix

    def spelled(self, at: np.ndarray) -> pa.Array:
        """The words numbered `at` as strings."""
        size = self.end[at] - self.start[at]
        offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        place = np.repeat(self.start[at] - offsets[:-1], size) + np.arange(offsets[-1])
        data = np.ascontiguousarray(self.block[place])
        return pa.Array.from_buffers(
            pa.large_string(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        ).cast(pa.string())


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in batches:
        langs = [UNDETERMINED if value is None else value for value in batch.column(0).to_pylist()]
        for first, last, block, offsets in blocks(batch.column(1), BLOCK_BYTES):
            if len(block):
                yield Words(block, offsets, langs[first:last])


def _counted(value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, first, count = np.unique(value, return_index=True, return_counts=True)
    return first, count


def _selected(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, word, hash, f): occurrences of each word; the empty word has those of all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _texts(batches):
            first, count = _counted(words.hash)
            total = np.bincount(words.lang, minlength=len(words.names))
            langs = [*words.names[words.lang[first]], *words.names]
            spelled = pa.concat_arrays([words.spelled(first), pa.array([""] * len(total), pa.string())])
            hashes = np.concatenate([words.hash[first], np.zeros(len(total), np.uint64)]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), spelled, pa.array(hashes), pa.array(np.concatenate([count, total]))],
                names=["lang", "word", "hash", "f"],
            )

    rows = _selected(docs, text, lang).mapInArrow(run, "lang string, word string, hash bigint, f bigint")
    return rows.groupBy("lang", "word", "hash").agg(F.sum("f").alias("f"))


def packed(weights: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(first group, groups, shared from) of each bin: neighbours share a group up to the budget.

    A bin above the budget gets groups of its own, as many as its weight fills; their numbers
    start at `shared from`.
    """
    first, spread = np.zeros(len(weights), np.int64), np.ones(len(weights), np.int64)
    group, load = 0, 0
    for i, weight in enumerate(weights.tolist()):
        if weight > budget:
            continue
        if load + weight > budget:
            group, load = group + 1, 0
        first[i] = group
        load += weight
    heavy = np.flatnonzero(weights > budget)
    spread[heavy] = -(-weights[heavy] // budget)
    first[heavy] = group + 1 + np.cumsum(spread[heavy]) - spread[heavy]
    return first, spread, group + 1


def _bin(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BIN_BITS)).astype(np.int64)


def suffixes(docs: DataFrame, known: DataFrame, text: str, lang: str, budget: int) -> tuple[DataFrame, int]:
    """(group, h1, h2, h3, f) of suffixes of two or three words in `known`, counted a block at a time.

    h3 is 0 where the piece ends or the third word is not known. Second: where groups begin that
    hold a part of a prefix.
    """
    spark = docs.sparkSession
    # At most 2**BIN_BITS rows and one bitmap of fixed size come to the driver.
    weight = np.zeros(1 << BIN_BITS, dtype=np.int64)
    binned = known.groupBy(F.expr(f"shiftrightunsigned(hash, {64 - BIN_BITS})").cast("int").alias("bin"))
    for row in binned.agg(F.sum("f").alias("f")).toLocalIterator():
        weight[row.bin] = row.f
    first, spread, part = packed(weight, budget)
    shared = spark.sparkContext.broadcast((bitmap(known, "hash", BITMAP_BITS), first, spread))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, first, spread = shared.value
        for words in _texts(batches):
            h = words.hash
            follows = words.joined & member(flags, h)
            follows[:-1] &= member(flags, h[1:])
            follows[-1:] = False
            at = np.flatnonzero(follows)
            one, two = h[at], h[at + 1]
            three = np.where(follows[at + 1], h[np.minimum(at + 2, len(h) - 1)], np.uint64(0))
            whole = mix(one * _FACTORS[0] + two * _FACTORS[1] + three * _FACTORS[2])
            leaf, count = _counted(whole)
            spot = _bin(one[leaf])
            group = first[spot] + (whole[leaf] % spread[spot].astype(np.uint64)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(group), *(pa.array(x[leaf].view(np.int64)) for x in (one, two, three)), pa.array(count)],
                names=["group", "h1", "h2", "h3", "f"],
            )

    schema = "group bigint, h1 bigint, h2 bigint, h3 bigint, f bigint"
    return _selected(docs, text, lang).mapInArrow(run, schema), part


def nodes(leaves: DataFrame, part: int, min_count: int) -> DataFrame:
    """(h1, h2, h3, f) of the subtrees' nodes of two (h3 = 0) and three words, from `min_count` on."""

    def subtree(table: pa.Table) -> pa.Table:
        h1, h2, h3, f = (table.column(c).to_numpy() for c in ("h1", "h2", "h3", "f"))
        order = np.lexsort((h3, h2, h1))
        h1, h2, h3, f = h1[order], h2[order], h3[order], f[order]
        inner = np.ones(len(f), dtype=bool)
        inner[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        leaf = inner.copy()
        leaf[1:] |= h3[1:] != h3[:-1]
        two, three = np.flatnonzero(inner), np.flatnonzero(leaf)
        total, single = np.add.reduceat(f, two), np.add.reduceat(f, three)
        if table.column("group")[0].as_py() < part:
            two, total = two[total >= min_count], total[total >= min_count]
        often = (single >= min_count) & (h3[three] != 0)
        three, single = three[often], single[often]
        at = np.concatenate([two, three])
        last = np.concatenate([np.zeros(len(two), np.int64), h3[three]])
        columns = [pa.array(x) for x in (h1[at], h2[at], last, np.concatenate([total, single]))]
        return pa.table(columns, names=["h1", "h2", "h3", "f"])

    grown = leaves.groupBy("group").applyInArrow(subtree, "h1 bigint, h2 bigint, h3 bigint, f bigint")
    return grown.groupBy("h1", "h2", "h3").agg(F.sum("f").alias("f")).where(F.col("f") >= min_count)


def _score(left: str, right: str) -> Column:
    """floor(1000000 * a * a / (left * right)) in decimals of 37 digits: exact up to 10**14 occurrences."""
    a, left, right = (f"cast({c} as decimal(14,0))" for c in ("a", left, right))
    return F.expr(f"({a} * {a} * cast(1000000 as decimal(7,0))) div ({left} * {right})")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    per_lang: int = PER_LANG,
    cover_percent: int = 50,
    budget: int = GROUP_SUFFIXES,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the strongest phrases of two or three words per language.

    Texts are lower-cased (A-Z) and split at `[.,;:!?\\x0A-\\x0D]` into pieces, those into words
    `[^\\x20\\x09]+`. Counts are per language, a null one being `und`: n of all words, a of the phrase
    within pieces. Of the cuts of a phrase into parts found l and r times the one with the lowest
    floor(1000000 a a / (l r)) counts, the earliest of equal ones. Phrases below `min_count` are no
    candidates; one of two words goes if a candidate of three that holds it is found in at least
    `cover_percent` of its places. The first `per_lang` stay by score, a (both descending), phrase.
    Null, empty and blank texts hold nothing; repeated rows count each, ids and other columns are
    ignored, and an empty table gives no rows. Words are told apart by 64-bit hashes with their language.
    """
    all_words = word_counts(docs, text, lang)
    words = written(all_words.where((F.col("f") >= min_count) | (F.col("word") == "")), "phrase-words")
    known = words.where("word <> ''")
    leaves, part = suffixes(docs, known, text, lang, budget)
    node = written(nodes(leaves, part, min_count), "phrase-nodes")
    two, three = node.where("h3 = 0").drop("h3"), node.where("h3 <> 0")

    # Both pairs of every three-word candidate, with its count.
    pairs = three.select(
        F.explode(F.array(F.struct("h1", "h2"), F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2")))).alias("of"),
        F.col("f").alias("longer"),
    ).select("of.h1", "of.h2", "longer")
    longest = pairs.groupBy("h1", "h2").agg(F.max("longer").alias("longer"))
    of_two = (
        two.join(longest, ["h1", "h2"], "left")
        .where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * cover_percent))
        .select("h1", "h2", F.col("f").alias("a"), *(F.lit(None).cast("bigint").alias(c) for c in ("h3", "f12", "f23")))
    )
    start = two.select("h1", "h2", F.col("f").alias("f12"))
    rest = two.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("f").alias("f23"))
    of_three = three.withColumnRenamed("f", "a").join(start, ["h1", "h2"]).join(rest, ["h2", "h3"])
    found = of_two.unionByName(of_three)
    for i in (1, 2, 3):
        named = [F.col("hash").alias(f"h{i}"), F.col("word").alias(f"w{i}"), F.col("f").alias(f"f{i}")]
        spelled = known.select(*named, *(["lang"] if i == 1 else []))
        found = found.join(spelled, f"h{i}", "left" if i == 3 else "inner")

    def cut(left: str, right: str) -> Column:
        return F.struct(_score(left, right).alias("score"), F.col(left).alias("l"), F.col(right).alias("r"))

    single, early, late = cut("f1", "f2"), cut("f1", "f23"), cut("f12", "f3")
    best = F.when(F.col("h3").isNull(), single).when(late["score"] < early["score"], late).otherwise(early)
    scored = found.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", best.alias("best")).select(
        "lang", "phrase", "a", "best.l", "best.r", "best.score"
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_lang)
    totals = F.broadcast(words.where("word = ''").select("lang", F.col("f").alias("n")))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
