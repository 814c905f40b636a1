"""Repeated passages by a depth-limited radix sort of suffixes.

A byte is removed where a string of `width` bytes that covers it also starts earlier. Only the
first `width` bytes of a suffix matter, so suffixes are sorted by most-significant-digit passes up
to that depth, and equal groups are exactly the repeated windows. Groups of one drop out after
each pass:

1. First digit: `DIGIT` bytes. Instead of all suffixes, each window is represented by the
   suffix with the smallest digit hash inside it, about one suffix in 30 bytes; windows that are
   equal choose the same one. Digits that occur once are gone after a count.
2. Second digit: all bytes of the windows that a suffix represents. Suffixes that agree in it are
   repeats in all these windows; the first by document stays and goes on.
3. Last digits: where suffixes with one first digit differ in the second, their windows are looked
   up a quarter of them at a time by the bytes these share, what is left a quarter of that, down to
   single windows; the first place of a window by document and offset stays.

Every pass is a grouping with partial sums and a join that adaptive execution may split, so a
passage that a third of all documents share is no task's burden. Digits are compared by two
64-bit hashes under different bases.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling
from .bitmaps import bitmap, member
from .storage import discard, written

DIGIT = 40
FILTER_BITS = 23
_ONE = rolling.Roller(1001)
_TWO = rolling.Roller(2002)


def _sliding(values: np.ndarray, width: int, best) -> np.ndarray:
    """The best of every `width` neighbours, by joining runs of doubling length."""
    if len(values) < width:
        return values[:0]
    run, out = 1, values
    while 2 * run <= width:
        out = best(out[:-run], out[run:])
        run *= 2
    return best(out[: len(values) - width + 1], out[width - run :])


def _representatives(block: np.ndarray, offsets: np.ndarray, width: int):
    """Suffixes that represent windows: text number, offset in the block, first and second digit.

    Of suffixes of one text with both digits equal only the first is returned; the others are
    returned as spans, since all their windows are repeats within the text.
    """
    one, two = _ONE.prefix(block), _TWO.prefix(block)
    digit = rolling.mix(_ONE.fixed(one, DIGIT))
    spread = width - DIGIT
    chosen = []
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        if end - begin < width:
            continue
        own = digit[begin : end - DIGIT + 1]
        least = _sliding(own, spread + 1, np.minimum)
        # A suffix represents a window if it attains the least digit of some window around it.
        around = _sliding(np.concatenate([np.zeros(spread, np.uint64), least, np.zeros(spread, np.uint64)]), spread + 1, np.maximum)
        chosen.append(np.flatnonzero(own == around) + begin)
    at = np.concatenate(chosen) if chosen else np.zeros(0, np.int64)
    text = np.searchsorted(offsets, at, side="right") - 1
    low = np.maximum(at - spread, offsets[text])
    high = np.minimum(at + width, offsets[text + 1])
    sides = ((at - low).astype(np.uint64) << np.uint64(32)) | (high - at).astype(np.uint64)
    second = rolling.mix(_TWO.windows(two, low, high) ^ rolling.mix(sides + np.uint64(1)))
    first = digit[at]
    order = np.lexsort((at, second, first, text))
    same = np.zeros(len(order), dtype=bool)
    if len(order) > 1:
        a, b = order[1:], order[:-1]
        same[1:] = (text[a] == text[b]) & (first[a] == first[b]) & (second[a] == second[b])
    repeated = order[same]
    keep = order[~same]
    return text[keep], at[keep], first[keep], second[keep], text[repeated], low[repeated], high[repeated]


def _merged(low: np.ndarray, high: np.ndarray, edges: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Spans joined where they overlap or touch, in order; none is joined across `edges`."""
    if not len(low):
        return low, high
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.ones(len(low), dtype=bool)
    new[1:] = low[1:] > high[:-1]
    if edges is not None:
        new[1:] |= np.isin(low[1:], edges)
    starts = np.flatnonzero(new)
    ends = np.concatenate([starts[1:], [len(low)]]) - 1
    return low[starts], high[ends]


def _suffixes(docs: DataFrame, width: int) -> DataFrame:
    """(id, at, until, first, second) of the representatives, at from the start of the text.

    Rows with `until` have no digits: they are the spans at:until that repeat within their text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, block, offsets in rolling.blocks(batch.column(1)):
                text, at, first, second, of, low, high = _representatives(block, offsets, width)
                low, high = _merged(low, high, offsets)
                of = np.searchsorted(offsets, low, side="right") - 1
                digits = np.arange(len(text) + len(low)) >= len(text)
                text, at = np.concatenate([text, of]), np.concatenate([at, low])
                until = np.concatenate([np.zeros(len(first), np.int64), high - offsets[of]])
                blank = np.zeros(len(low), np.uint64)
                ids = batch.column(0).slice(start, stop - start).take(pa.array(text, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array((at - offsets[text]).astype(np.int32)),
                        pa.array(until.astype(np.int32), mask=~digits),
                        pa.array(np.concatenate([first, blank]).view(np.int64), mask=digits),
                        pa.array(np.concatenate([second, blank]).view(np.int64), mask=digits),
                    ],
                    names=["id", "at", "until", "first", "second"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id {kind}, at int, until int, first long, second long")


def repeated_suffixes(suffixes: DataFrame) -> DataFrame:
    """(id, at, whole): suffixes whose windows may start earlier elsewhere. Deletes their files.

    whole: all windows around it do. The others are the first of their second digit and share
    the first digit with suffixes that differ in the second.
    """
    digits = suffixes.where("first is not null").drop("until")
    groups = digits.groupBy("first").agg(F.count("*").alias("n")).where("n > 1").select("first")
    shared = written(digits.join(groups, "first"), "shared")
    discard(suffixes)
    classes = shared.groupBy("first", "second").agg(F.min("id").alias("owner"))
    mixed = (
        classes.groupBy("first")
        .agg(F.min("second").alias("low"), F.max("second").alias("high"))
        .where("low <> high")
        .select("first", F.lit(True).alias("mixed"))
    )
    ranked = shared.join(classes, ["first", "second"]).join(mixed, "first", "left")
    whole = ranked.where("id > owner").select("id", "at", F.lit(True).alias("whole"))
    split = ranked.where("id = owner and mixed").select("id", "at", F.lit(False).alias("whole"))
    repeats = written(whole.unionByName(split), "repeats")
    discard(shared)
    return repeats


def _contexts(docs: DataFrame, places: DataFrame, width: int) -> DataFrame:
    """(id, at, before, bytes): each suffix with the bytes of all windows it represents."""
    spread = width - DIGIT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, at, before, around = [], [], [], []
            for i in range(len(batch)):
                raw = batch.column(1)[i].as_py() or b""
                for place in batch.column(2)[i].as_py():
                    low = max(place - spread, 0)
                    which.append(i)
                    at.append(place)
                    before.append(place - low)
                    around.append(raw[low : place + width])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(which, pa.int64())),
                    pa.array(at, pa.int32()),
                    pa.array(before, pa.int32()),
                    pa.array(around, pa.binary()),
                ],
                names=["id", "at", "before", "bytes"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return (
        _with_spot(docs, _spots(docs, places))
        .join(places, "id")
        .select("id", "text", "places")
        .mapInArrow(run, f"id {kind}, at int, before int, bytes binary")
    )


def _later_windows(contexts: DataFrame, width: int) -> DataFrame:
    """(id, start, end) of bytes under windows around the given suffixes that start earlier elsewhere.

    The windows of a suffix fall into quarters. What all windows of a quarter cover, its hull, is
    the next digit: of equal hulls the first by document stays and the others are repeats as a
    whole. Of what stays, a quarter whose windows share bytes that no other hull has drops
    out; the rest is quartered again, until a part is one window.
    """
    spread = width - DIGIT
    # A window is numbered by the bytes it takes before the suffix; `low` is a part's first number.
    first = f"greatest(low, {spread} - (octet_length(bytes) - before - {DIGIT}))"
    core = F.expr(f"substring(bytes, before - low + 1, low + {width} - high)")
    hull = F.expr(f"substring(bytes, before - last + 1, last + {width} - first)")
    parts, size, spans, done = contexts.withColumn("parent", F.lit(0)), spread + 1, [], []
    while size > 1:
        step = -(-size // 4)
        keyed = (
            parts.withColumn("low", F.explode(F.expr(f"sequence(parent, least(parent + {size - 1}, {spread}), {step})")))
            .withColumn("high", F.expr(f"least(low + {step - 1}, parent + {size - 1}, {spread})"))
            .withColumns({"first": F.expr(first), "last": F.expr("least(high, before)")})
            .where("first <= last")
            .select(
                "id",
                "at",
                "low",
                "first",
                "last",
                F.xxhash64("low", core).alias("core"),
                F.xxhash64(F.lit(3), "low", "first", "last", hull).alias("hull"),
            )
        )
        keyed = written(keyed, f"parts-{step}")
        for table in done:
            discard(table)
        owner = F.min(F.struct("id", "at")).alias("owner")
        hulls = keyed.groupBy("core", "hull").agg(F.count("*").alias("n"), owner, F.first("low").alias("low"))
        hulls = written(hulls, f"hulls-{step}") if step > 1 else hulls
        repeats = keyed.join(hulls.where("n > 1").select("core", "hull", "owner"), ["core", "hull"])
        later = repeats.where(F.struct("id", "at") > F.col("owner")).select(
            "id", F.expr("at - last").alias("start"), F.expr(f"at - first + {width}").alias("end")
        )
        spans.append(written(later, f"later-{step}"))
        if step > 1:
            several = hulls.groupBy("core").agg(F.min("hull").alias("a"), F.max("hull").alias("b")).where("a <> b")
            kept = hulls.join(several.select("core"), "core").select("owner.*", "low")
            kept = kept.groupBy("id", "at").agg(F.collect_set("low").alias("parents"))
            parts = contexts.join(kept, ["id", "at"]).withColumn("parent", F.explode("parents"))
            done = [keyed, hulls]
        size = step
    discard(keyed)
    return reduce(DataFrame.unionByName, spans)


def _spots(docs: DataFrame, wanted: DataFrame) -> Broadcast:
    """A bitmap of the wanted ids for every task.

    It has 2**23 bits at any size: it only spares a shuffle of texts that are not needed,
    and lets some others pass.
    """
    spots = wanted.select(F.xxhash64("id").alias("spot"))
    return docs.sparkSession.sparkContext.broadcast(bitmap(spots, "spot", FILTER_BITS))


def _in(spots: Broadcast, batch: pa.RecordBatch) -> np.ndarray:
    """Whether the bitmap has the hash in a batch's last column."""
    return member(spots.value, batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False))


def _with_spot(docs: DataFrame, spots: Broadcast) -> DataFrame:
    """(id, text) of the rows whose id is in a bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select([0, 1]).filter(pa.array(_in(spots, batch)))

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text", F.xxhash64("id").alias("spot")).mapInArrow(run, f"id {kind}, text binary")


def _digest(docs: DataFrame, width: int, keep_text: bool, without: Broadcast | None = None) -> DataFrame:
    """One row per (id, text, around, spans) without the given places.

    No place is known by a null id: what repeats within such a text is found here. Rows whose id
    is in the bitmap `without` are left out, by the same Python worker, as each takes memory.
    """
    spread = width - DIGIT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if without is not None:
                batch = batch.filter(pa.array(~_in(without, batch)))
            for start, stop, block, offsets in rolling.blocks(batch.column(1)):
                rows = batch.slice(start, stop - start)
                unnamed = rows.column(0).is_null().to_numpy(zero_copy_only=False)
                out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "sha": [], "kept": []}
                for i in range(stop - start):
                    size = int(offsets[i + 1] - offsets[i])
                    raw = block[offsets[i] : offsets[i + 1]]
                    lows, highs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                    if unnamed[i]:
                        *_, low, high = _representatives(raw, np.array([0, size]), width)
                        lows.append(low)
                        highs.append(high)
                    at = rows.column(2)[i].values
                    if at is not None and len(at):
                        at = np.asarray(at).astype(np.int64)
                        lows.append(np.maximum(at - spread, 0))
                        highs.append(np.minimum(at + width, size))
                    at = rows.column(3)[i].values
                    if at is not None and len(at):
                        lows.append(np.asarray(at.field(0)).astype(np.int64))
                        highs.append(np.minimum(np.asarray(at.field(1)).astype(np.int64), size))
                    a, b = _merged(np.concatenate(lows), np.concatenate(highs))
                    if len(a):
                        held = np.ones(size, dtype=bool)
                        for x, y in zip(a.tolist(), b.tolist(), strict=True):
                            held[x:y] = False
                        raw = raw[held]
                    kept = raw.tobytes()
                    out["n_bytes"].append(size)
                    out["n_removed"].append(int((b - a).sum()))
                    out["n_spans"].append(len(a))
                    out["sha"].append(hashlib.sha256(kept).hexdigest())
                    out["kept"].append(kept if keep_text else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        pa.array(out["n_bytes"], pa.int64()),
                        pa.array(out["n_removed"], pa.int64()),
                        pa.array(out["n_spans"], pa.int64()),
                        pa.array(out["sha"], pa.string()),
                        pa.array(out["kept"], pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    spot = F.xxhash64("id").alias("spot")
    return docs.select("id", "text", "around", "spans", *([spot] if without is not None else [])).mapInArrow(run, schema)


def suffix_dedup(
    docs: DataFrame, width: int = 100, doc_id: str = "doc_id", text: str = "text", keep_text: bool = False
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) for each row of `docs`.

    Each byte covered by a string of `width` bytes that also starts earlier, by doc_id and then
    offset, is removed; strings are judged on the input. n_spans counts maximal removed runs;
    `kept` is the remaining bytes if asked for. A null or empty text has 0 bytes. Rows that share
    id and text are copies of one document: what goes from one goes from all, and none is the
    earlier. Different texts under one id are documents of their own, ordered by their hashes.
    Rows with a null id lose only what repeats within them. Other columns are ignored; an empty
    table gives no rows.
    """
    if width <= DIGIT:
        raise ValueError(f"width must be above {DIGIT}")
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("binary").alias("text"))
    if not _one_text_an_id(rows):
        # A key of two parts costs time in every pass, so it is used only where ids do not do.
        both = F.when(F.col("id").isNotNull(), F.struct("id", F.xxhash64("text").alias("whole")))
        found = _deduplicated(rows.select(both.alias("id"), "text"), width, keep_text)
        return found.withColumn("doc_id", F.col("doc_id.id"))
    return _deduplicated(rows, width, keep_text)


def _one_text_an_id(rows: DataFrame) -> bool:
    texts = rows.where("id is not null").select("id", F.xxhash64("text").alias("whole")).groupBy("id")
    return texts.agg(F.min("whole").alias("low"), F.max("whole").alias("high")).where("low <> high").isEmpty()


def _deduplicated(rows: DataFrame, width: int, keep_text: bool) -> DataFrame:
    named = rows.where("id is not null")
    suffixes = written(_suffixes(named, width), "suffixes")
    within = suffixes.where("until is not null").select("id", F.col("at").alias("start"), F.col("until").alias("end"))
    within = written(within, "within")
    repeats = repeated_suffixes(suffixes)
    places = repeats.where("not whole").groupBy("id").agg(F.collect_set("at").alias("places"))
    contexts = written(_contexts(named, places, width), "contexts")
    later = _later_windows(contexts, width)
    discard(contexts)
    span = F.struct("start", "end")
    spans = written(
        repeats.where("whole")
        .select("id", "at", F.lit(None).cast("struct<start:int,end:int>").alias("span"))
        .unionByName(later.unionByName(within).select("id", F.lit(None).cast("int").alias("at"), span.alias("span")))
        .groupBy("id")
        .agg(F.collect_set("at").alias("around"), F.collect_set("span").alias("spans")),
        "spans",
    )
    for table in (repeats, within, later):
        discard(table)
    alone = rows.select(
        "id", "text", F.lit(None).cast("array<int>").alias("around"), F.lit(None).cast("array<struct<start:int,end:int>>").alias("spans")
    )
    spots = _spots(rows, spans)
    touched = _with_spot(rows, spots).join(spans.withColumnRenamed("id", "of"), F.col("id") == F.col("of"), "left")
    out = _digest(alone, width, keep_text, spots).unionByName(_digest(touched, width, keep_text))
    return out if keep_text else out.drop("kept")
