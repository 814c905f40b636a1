"""Periodic runs of words by the dictionary of basic factors.

The basic factors of level k are the stretches of 2**k words; each that occurs more than once in its
document gets a number, made from the numbers of its halves. Two copies of a period q, 2**k <= q <
2**(k + 1), begin with the same basic factor, so the successor occurrences of a factor within
2**(k + 1) words propose all periods of a level. Occurrences closer than half the factor form
arithmetic progressions; a progression is compared as a whole, by its first member on one side, so
that a text of one repeated word costs no more than any other. Two factors of level k prove each
proposal, the numbers of all levels extend it, and equal stretches are joined into one run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words worked on at a time; a longer document makes a block of its own.
BLOCK_WORDS = 1 << 17
MIN_WORDS = 12
WORD = r"[^\x20\x09-\x0D]+"
RUN = "struct<start: bigint, length: bigint, period: bigint>"


class Factors:
    """The basic factors of a block of documents, level by level."""

    def __init__(self, word: np.ndarray, first: np.ndarray, end: np.ndarray):
        """word: a number for each word, equal for equal words; first, end: of its document."""
        self.n = len(word)
        self.first, self.end = first, end
        self.levels: list[np.ndarray] = []
        at = np.arange(self.n, dtype=np.int64)
        key = first * (int(word.max(initial=0)) + 1) + word
        self._add(at, key)

    def _add(self, at: np.ndarray, key: np.ndarray) -> None:
        """Numbers the factors at `at`, equal ones by `key`; those met once stay apart."""
        order = np.argsort(key, kind="stable")
        key = key[order]
        same = np.zeros(len(key) + 1, dtype=bool)
        same[1:-1] = key[1:] == key[:-1]
        again = same[:-1] | same[1:]
        self.at = at[order][again]
        self.name = np.cumsum(~same[:-1])[again]
        level = -np.arange(1, self.n + 1, dtype=np.int32)
        level[self.at] = self.name
        self.levels.append(level)

    def double(self) -> bool:
        """Goes on to the next level; whether a factor of it occurs twice."""
        level, size = self.levels[-1], 1 << (len(self.levels) - 1)
        at = np.sort(self.at)
        at = at[at + 2 * size <= self.end[at]]
        at = at[level[at + size] > 0]
        self._add(at, level[at].astype(np.int64) * (int(level.max(initial=0)) + 1) + level[at + size])
        return len(self.at) > 0

    def proposals(self) -> tuple[np.ndarray, np.ndarray]:
        """(start, period): stretches of two periods of this level that no earlier word extends."""
        size, at, name = 1 << (len(self.levels) - 1), self.at, self.name
        gap = np.diff(at)
        close = (name[1:] == name[:-1]) & (gap * 2 <= size)
        head = np.flatnonzero(np.concatenate([[True], ~close])) if len(at) else at
        tail = np.append(head[1:], len(at)) - 1
        starts, periods = [], []
        # Progressions lie more than half a factor apart: a period below two factors spans three gaps at most.
        for ahead in (1, 2, 3):
            x = np.arange(max(0, len(head) - ahead))
            y = x + ahead
            near = (name[head[x]] == name[head[y]]) & (at[head[y]] - at[tail[x]] < 2 * size)
            x, y = x[near], y[near]
            # Only the first member of a progression can have another word before it than the rest.
            left, right = _members(head[x], tail[x], head[y])
            starts.append(left)
            periods.append(right)
            right, left = _members(head[y] + 1, tail[y], head[x])
            starts.append(left)
            periods.append(right)
        start, other = at[np.concatenate(starts)], at[np.concatenate(periods)]
        period = other - start
        fits = (period >= size) & (period < 2 * size) & (other + period <= self.end[start])
        start, other, period = start[fits], other[fits], period[fits]
        words = self.levels[0]
        free = (start == self.first[start]) | (words[start - 1] != words[other - 1])
        start, other, period = start[free], other[free], period[free]
        level = self.levels[-1]
        twice = level[other - size] == level[other + period - size]
        return start[twice], period[twice]

    def extended(self, start: np.ndarray, period: np.ndarray) -> np.ndarray:
        """Where the words stop to repeat those `period` before them."""
        at = start + period
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            ahead = at + period
            inside = ahead < self.n
            same = inside & (level[np.where(inside, at, 0)] == level[np.where(inside, ahead, 0)])
            at = at + (same.astype(np.int64) << k)
        return at + period


def _members(low: np.ndarray, high: np.ndarray, partner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number from low to high of each row, and the row's partner beside it."""
    count = np.maximum(high - low + 1, 0)
    shift = np.cumsum(count) - count
    return np.repeat(low - shift, count) + np.arange(count.sum()), np.repeat(partner, count)


def runs_of(
    word: np.ndarray, first: np.ndarray, end: np.ndarray, min_words: int = MIN_WORDS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of a block, by start, then period."""
    factors = Factors(word, first, end)
    starts, periods = [], []
    more = len(factors.at) > 0
    while more:
        start, period = factors.proposals()
        starts.append(start)
        periods.append(period)
        more = factors.double()
    if not starts:
        return (np.zeros(0, dtype=np.int64),) * 3
    start, period = np.concatenate(starts), np.concatenate(periods)
    stop = factors.extended(start, period)
    long = stop - start >= np.maximum(min_words, 2 * period)
    start, stop, period = start[long], stop[long], period[long]
    # A stretch has one smallest period; its multiples propose the same stretch.
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, period = start[new], stop[new], period[new]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def _block(ids: list, texts: list[list[bytes]], min_words: int) -> pa.RecordBatch:
    count = np.array([len(words) for words in texts], dtype=np.int64)
    edge = np.concatenate([[0], np.cumsum(count)])
    flat = [word for words in texts for word in words]
    number = np.asarray(pa.array(flat, pa.binary()).dictionary_encode().indices).astype(np.int64)
    first, end = np.repeat(edge[:-1], count), np.repeat(edge[1:], count)
    start, stop, period = runs_of(number, first, end, min_words)
    depth = np.zeros(len(flat) + 1, dtype=np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, stop, -1)
    kept = np.cumsum(depth)[:-1] == 0
    # A run that ends with its document closes at the next one's first word, where nothing is open.
    owner = np.searchsorted(edge, start, side="right") - 1
    runs = pa.StructArray.from_arrays(
        [pa.array(start - edge[owner]), pa.array(stop - start), pa.array(period)], names=["start", "length", "period"]
    )
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    collapsed = []
    for i, words in enumerate(texts):
        if offsets[i] != offsets[i + 1]:
            words = [words[j] for j in np.flatnonzero(kept[edge[i] : edge[i + 1]])]
        collapsed.append(b" ".join(words))
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays(ids),
            pa.array(count),
            pa.ListArray.from_arrays(pa.array(offsets), runs),
            pa.array(collapsed, pa.binary()).cast(pa.string()),
        ],
        names=["doc_id", "n_words", "runs", "collapsed"],
    )


def periodic_runs(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row of `docs`, in one pass without a shuffle.

    Words are `[^\\x20\\x09-\\x0D]+`, numbered from 0, compared as they are. A run (start, length,
    period) is a stretch with smallest period `period` of at least `min_words` words and two periods
    that no neighbouring word extends; runs come by start, then period, and may overlap. collapsed
    is the words that no run holds after its first period, joined by one space. A null, empty or
    blank text has no words, no runs and an empty collapsed text. Rows are judged one by one, so
    repeated rows and ids, null ids and ties need no rule; other columns are ignored, and an empty
    table gives no rows. The whole text of a row is held by one task, with some 100 bytes a word.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[list[bytes]] = []
        size = 0
        for batch in batches:
            column = batch.column(1).cast(pa.large_binary())
            for i in range(batch.num_rows):
                words = (column[i].as_py() or b"").split()
                if texts and size + len(words) > BLOCK_WORDS:
                    yield _block(ids, texts, min_words)
                    ids, texts, size = [], [], 0
                ids.append(batch.column(0).slice(i, 1))
                texts.append(words)
                size += len(words)
        if texts:
            yield _block(ids, texts, min_words)

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words bigint, runs array<{RUN}>, collapsed string"
    )


def _let(value: Column, use) -> Column:
    """`use` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def with_planted_periods(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text): a tenth of the texts, by the hash of the id, repeat a stretch up to their end.

    Let h be the crc32 of the decimal id and g = floor(h / 10). If h % 10 = 0, each of the n words
    from a = g % n on becomes word a + (i - a) % p of the original, p = 1 + floor((n - a) / (3 + g % 8)).
    Texts without words, and rows without an id or a text, stay as they are.
    """
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def planted(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        return F.when(n > 0, _let(F.struct(words.alias("w"), n.alias("n"), a.alias("a")), cycled)).otherwise(F.lit(""))

    def cycled(x: Column) -> Column:
        rest = x["n"] - x["a"]
        period = (F.floor(rest / (g % 8 + 3)) + 1).cast("int")
        cycle = F.slice(x["w"], x["a"] + 1, period)
        again = F.flatten(F.array_repeat(cycle, F.ceil(rest / period).cast("int")))
        return F.array_join(F.concat(F.slice(x["w"], F.lit(1), x["a"]), F.slice(again, F.lit(1), rest)), " ")

    words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
    changed = F.when(F.col(text).isNotNull() & (h % 10 == 0), _let(words, planted)).otherwise(F.col(text))
    return docs.select(F.col(doc_id).alias("doc_id"), changed.alias("text"))


def run_digest(found: DataFrame) -> DataFrame:
    """The rows of `periodic_runs` as numbers and hashes: the longest run, and all runs and kept words hashed."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    row = found.withColumn("best", best)
    length, start, period = (F.col(f"best.{c}") * sign for c, sign in (("length", 1), ("col2", -1), ("col3", -1)))
    return row.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("1000 * best.length div -best.col3").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
