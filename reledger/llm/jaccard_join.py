"""Exact Jaccard self-join of documents on word shingles, as a join in a metric space.

The Jaccard distance d is a metric, and documents link when d <= 1 - threshold (tau). Distances
between unrelated texts are all 1, so pivots drawn from the documents alone would leave nearly all
documents in one outer region. The recursion therefore has two kinds of pivots.

1. Singleton pivots. Each shingle s is a pivot {s}; d(x, {s}) is 1 - 1/|x| where x holds s, else 1.
   All shingles of x are its nearest pivots, and one total order (rare first) breaks the ties.
   A document within tau of x shares at least ceil(threshold * |x|) shingles with it, so both
   have one of their first |x| - ceil(threshold * |x|) + 1 pivots in common: x is replicated
   into these regions and no others.
2. The empty set gives the size window: d(x, y) >= 1 - min/max of the sizes, so a region splits
   into bands of sizes, each document in its own and, if its place there allows a larger
   partner, the next. A pair is formed in the band of the larger one.
3. Places. If s is the first pivot that x and y have in common, none before its place in either
   list is shared, so they share min(|x| - i, |y| - j) shingles at most, i and j being the places.
   A region forms the pairs for which that is enough; a passage that many texts share and no
   text begins its list with makes hardly any.
4. Coordinates. Counts of a set in 128 parts of all shingles bound its distance from another set
   from below; pairs that are too far apart are never measured.
5. Document pivots. In each region the member with most copies is the pivot p, and d(x, p) is computed
   exactly. Members inside p's ball are linked through it and never compared with each other, so
   a group of n near copies costs n pairs. Other pairs of a region go on only if they are in
   different components and if |d(x, p) - d(y, p)| <= tau. Regions of more than `leaf` members
   recurse with new pivots; the rest are joined exactly.

The order of shingles uses counts of all shingles in 2**21 buckets, whatever the input: 16 MB.
Each table is deleted as soon as no later step reads it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import rolling
from .bitmaps import bitmap, member
from .components import components
from .storage import discard, written

BUCKET_BITS = 21
#: Counts that travel together, and tasks whose counts are added up first.
BLOCK_BUCKETS = 1 << 14
TASKS_ADDED = 512
FILTER_BITS = 23
REGION_BITS = 25
LEAF = 512
#: Document pivots of a region at most, one after the other.
TURNS = 3
PARTS = 128


def _bucket(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def _summed(counts: DataFrame, kind: str, *by: str) -> DataFrame:
    """Blocks of counts of some integer kind added up: (*by, counts), as longs."""

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK_BUCKETS, dtype=np.int64)
        for block in group.column("counts"):
            total += np.frombuffer(block.as_buffer(), dtype=kind)
        return pa.table({**{c: group.column(c)[:1] for c in by}, "counts": pa.array([total.tobytes()], pa.binary())})

    kinds = dict(counts.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in (*by, "counts"))
    return counts.groupBy(*by).applyInArrow(add, schema)


def shingle_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Shingle occurrences of the corpus by hash bucket; 2**21 numbers at any size.

    Tasks pass on blocks of counts, which are added up in two steps, so no task adds too many.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << BUCKET_BITS, dtype=np.int32)
        for batch in batches:
            for _, _, block, offsets in rolling.blocks(batch.column(0)):
                _, _, hashes, owner = rolling.words(block, offsets)
                value, _ = rolling.shingles(hashes, owner, len(offsets) - 1)
                np.add.at(total, _bucket(value), 1)
        blocks = total.reshape(-1, BLOCK_BUCKETS)
        used = np.flatnonzero(blocks.any(axis=1))
        task = np.full(len(used), TaskContext.get().partitionId() // TASKS_ADDED, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(task), pa.array([blocks[i].tobytes() for i in used], pa.binary())],
            names=["block", "tasks", "counts"],
        )

    found = docs.select(F.col(text).alias("text")).mapInArrow(count, "block long, tasks long, counts binary")
    out = np.zeros(1 << BUCKET_BITS, dtype=np.int64).reshape(-1, BLOCK_BUCKETS)
    for row in _summed(_summed(found, "i4", "block", "tasks"), "i8", "block").toLocalIterator():
        out[row.block] = np.frombuffer(row.counts, dtype=np.int64)
    return out.ravel()


def _parts(owner: np.ndarray, value: np.ndarray, n_texts: int) -> np.ndarray:
    """How many shingles of each set fall into each of the parts of all shingles."""
    place = owner * PARTS + (value & np.uint64(PARTS - 1)).astype(np.int64)
    return np.bincount(place, minlength=n_texts * PARTS).reshape(n_texts, PARTS)


def _sets(block: np.ndarray, offsets: np.ndarray, rank: np.ndarray | None):
    """(owner, value) distinct, by owner and pivot order; sizes; class hashes."""
    _, _, hashes, owner = rolling.words(block, offsets)
    value, owner = rolling.shingles(hashes, owner, len(offsets) - 1)
    n_texts = len(offsets) - 1
    place = owner.astype(np.int64) << 40
    if rank is not None:
        place |= rank[_bucket(value)]
    order = np.lexsort((value, place))
    owner, value = owner[order], value[order]
    if len(value):
        new = np.ones(len(value), dtype=bool)
        new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
        owner, value = owner[new], value[new]
    size = np.bincount(owner, minlength=n_texts)
    total = np.zeros(n_texts + 1, dtype=np.uint64)
    if len(value):
        sums = np.zeros(len(value) + 1, dtype=np.uint64)
        np.cumsum(rolling.mix(value), out=sums[1:])
        edge = np.concatenate([[0], np.cumsum(size)])
        total = sums[edge]
    kind = rolling.mix((total[1:] - total[:-1]) + size.astype(np.uint64))
    return owner, value, size, kind.view(np.int64)


def _lists(values: np.ndarray, sizes: np.ndarray, present: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(
        pa.array(offsets), pa.array(values), mask=pa.array(~present)
    )


def shingled(docs: DataFrame, percent: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, whole, n, kind, pivots, parts): text hash, size of each set, its hash, regions and coordinates.

    Texts with equal sets have one `kind`; a task gives pivots and parts of a kind once. A text
    without words has size 0 and neither.
    """
    order = np.argsort(shingle_counts(docs, text), kind="stable")
    ranks = np.empty(len(order), dtype=np.int32)
    ranks[order] = np.arange(len(order))
    del order
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, seen = shared.value, set()
        for batch in batches:
            for first, last, block, offsets in rolling.blocks(batch.column(1)):
                owner, value, size, kind = _sets(block, offsets, rank)
                need = -(-size * percent // 100)
                take = np.where(size > 0, size - need + 1, 0)
                fresh = np.array([k not in seen and not seen.add(k) for k in kind.tolist()], dtype=bool)
                fresh &= size > 0
                take = np.where(fresh, take, 0)
                begin = np.cumsum(size) - size
                held = np.arange(len(value)) - begin[owner] < take[owner]
                parts = np.minimum(_parts(owner, value, last - first)[fresh], np.iinfo(np.int16).max)
                part_lists = np.where(fresh, PARTS, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(2).slice(first, last - first),
                        pa.array(size.astype(np.int64)),
                        pa.array(kind),
                        _lists(value[held].view(np.int64), take, fresh),
                        _lists(parts.ravel().astype(np.int16), part_lists, fresh),
                    ],
                    names=["doc_id", "whole", "n", "kind", "pivots", "parts"],
                )

    kind_of_id = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("whole")).mapInArrow(
        regions, f"doc_id {kind_of_id}, whole long, n long, kind long, pivots array<long>, parts array<smallint>"
    )


def _regions(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """(s, kind, n, place) of the pivots in `shared` (s): a bitmap spares the others the shuffle."""
    flags = rows.sparkSession.sparkContext.broadcast(bitmap(shared, "s", REGION_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            value = np.asarray(lists.flatten())
            size = np.diff(np.asarray(lists.offsets)).astype(np.int64)
            place = np.arange(len(value)) - np.repeat(np.cumsum(size) - size, size)
            hit = member(flags.value, value)
            owner = pa.array(np.repeat(np.arange(len(size)), size)[hit])
            yield pa.RecordBatch.from_arrays(
                [pa.array(value[hit]), batch.column(0).take(owner), batch.column(1).take(owner), pa.array(place[hit])],
                names=["s", "kind", "n", "place"],
            )

    found = rows.where("pivots is not null").select("kind", "n", "pivots")
    return found.mapInArrow(run, "s long, kind long, n long, place long").join(shared, "s")


def _shingle_sets(docs: DataFrame, rows: DataFrame, kinds: DataFrame, text: str) -> DataFrame:
    """(kind, members) for the given kinds, each from one of its texts.

    A bitmap of the hashes of these texts spares the others being read into words.
    """
    chosen = rows.join(kinds, "kind", "left_semi").groupBy("kind").agg(F.min("whole").alias("whole"))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap(chosen, "whole", FILTER_BITS))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = shared.value, set()
        for batch in batches:
            whole = batch.column(1).to_numpy(zero_copy_only=False)
            wanted = member(bits, whole)
            for i in np.flatnonzero(wanted):
                wanted[i] = whole[i] not in seen
                seen.add(whole[i])
            texts = batch.column(0).filter(pa.array(wanted))
            for _, _, block, offsets in rolling.blocks(texts):
                owner, value, size, kind = _sets(block, offsets, None)
                some = size > 0
                lists = _lists(value.view(np.int64), size[some], np.ones(int(some.sum()), dtype=bool))
                yield pa.RecordBatch.from_arrays([pa.array(kind[some]), lists], names=["kind", "members"])

    texts = docs.select(F.col(text).alias("text"), F.xxhash64(text).alias("whole"))
    found = texts.mapInArrow(members, "kind long, members array<long>")
    return found.join(kinds, "kind", "left_semi").dropDuplicates(["kind"])


def _possible(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that may link by their coordinates.

    A part of all shingles maps a set to how many of its shingles lie there. Two such counts differ
    by no more than the sets differ in that part, so the sum of differences is a lower bound of
    |x ^ y|, which is at most (1 - t) / (1 + t) * (|x| + |y|) for sets that link at t.
    """
    left = parts.select(F.col("kind").alias("a"), F.col("parts").alias("a_parts"), F.col("n").alias("a_n"))
    right = parts.select(F.col("kind").alias("b"), F.col("parts").alias("b_parts"), F.col("n").alias("b_n"))
    gaps = F.zip_with("a_parts", "b_parts", lambda x, y: F.abs(x.cast("int") - y.cast("int")))
    apart = F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)
    fits = apart * (100 + percent) <= (F.col("a_n") + F.col("b_n")) * (100 - percent)
    return pairs.join(left, "a").join(right, "b").where(fits).select("a", "b")


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, common, total): exact sizes of intersection and union."""
    left = sets.select(F.col("kind").alias("a"), F.col("members").alias("a_set"))
    right = sets.select(F.col("kind").alias("b"), F.col("members").alias("b_set"))
    common = F.size(F.array_intersect("a_set", "b_set"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", common.alias("common"), (F.size("a_set") + F.size("b_set") - common).alias("total"))
    )


def _merged(comps: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, component) after `links` (a, b) joined the components known so far."""
    if comps is None:
        return components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    of = [comps.select(F.col("node").alias(end), F.col("component").alias(f"{end}_comp")) for end in "ab"]
    contracted = links.join(of[0], "a", "left").join(of[1], "b", "left")
    again = components(contracted.select(F.coalesce("a_comp", "a").alias("u"), F.coalesce("b_comp", "b").alias("v")))
    up = again.select(F.col("node").alias("component"), F.col("component").alias("lifted"))
    lifted = comps.join(up, "component", "left").select("node", F.coalesce("lifted", "component").alias("component"))
    return written(lifted.unionByName(again.join(comps, "node", "left_anti")), "components")


def jaccard_components(
    docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text", leaf: int = LEAF
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of `docs`.

    Two texts link when 100 * |intersection| >= percent * |union| of their sets of five-word
    shingles (A-Z lower-cased); component_id is the smallest doc_id reachable by links. Texts with
    equal sets share everything, so copies and repeated rows are never expanded into pairs. A null,
    empty or blank text has n_shingles 0 and is linked with nothing; rows with a null doc_id take
    part in links but never name a component, unless no member has an id. Other columns
    are ignored. An empty table gives no rows. Sets and shingles are told apart by 64-bit hashes.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100")
    rows = written(shingled(docs, percent, doc_id, text), "shingled")
    held = rows.where("pivots is not null").select("kind", F.explode("pivots").alias("s"))
    shared = held.groupBy("s").agg(F.min("kind").alias("low"), F.max("kind").alias("high")).where("low <> high")
    shared = written(shared.select("s"), "shared")
    # A text with many copies is the likelier centre of its near copies: the first pivot. Every
    # task lists the pivots of a kind once, so tasks are counted here; the kind breaks ties.
    near = _regions(rows, shared).groupBy("s", "kind", "n", "place").agg(F.count("*").alias("tasks"))

    def band(size) -> Column:
        if percent == 100:
            return size.cast("long")
        return F.floor(F.log(size) / F.log(F.lit(100.0 / percent)) + 1e-9).cast("long")

    # The largest partner that may still share enough from this place on.
    largest_partner = F.floor((F.col("n") - F.col("place")) * (100 + percent) / percent) - F.col("n")
    own = band(F.col("n"))
    steps = F.when((largest_partner > F.col("n")) & (band(largest_partner) > own), F.array(F.lit(0), F.lit(1)))
    banded = written(
        near.withColumn("own", own).select(
            "s", "kind", "n", "place", "own", "tasks", F.explode(F.coalesce(steps, F.array(F.lit(0)))).alias("step")
        ).withColumn("band", F.col("own") + F.col("step")),
        "regions",
    )
    alive = (
        banded.groupBy("s", "band")
        .agg(F.min("kind").alias("low"), F.max("kind").alias("high"), F.min("step").alias("native"))
        .where("low <> high and native = 0")
    )
    members = written(
        banded.join(alive.select("s", "band"), ["s", "band"]).select(
            "s", "band", "kind", "n", "place", "own", "tasks", F.col("kind").alias("comp"), F.lit(None).cast("double").alias("d")
        ),
        "members",
    )
    for table in (shared, banded):
        discard(table)
    coordinates = written(
        rows.where("parts is not null")
        .join(members.select("kind").distinct(), "kind", "left_semi")
        .groupBy("kind", "n")
        .agg(F.first("parts").alias("parts")),
        "coordinates",
    )
    tau = 1 - percent / 100 + 1e-9
    pair = F.struct(F.greatest("kind", "p_kind").alias("a"), F.least("kind", "p_kind").alias("b"))

    def may_link(found: DataFrame) -> DataFrame:
        """The pairs (kind, p_kind) of members that this region has to form, as (a, b)."""
        return (
            found.where("comp <> p_comp and band = greatest(own, p_own)")
            .where(f"100 * least(n, p_n) >= {percent} * greatest(n, p_n)")
            .where(f"least(n - place, p_n - p_place) * {100 + percent} >= {percent} * (n + p_n)")
            .select(pair.alias("pair"))
            .select("pair.*")
            .distinct()
        )

    comps, turn = None, 0
    while True:
        pivot = F.max_by(F.struct("kind", "n", "place", "own", "comp"), F.struct("tasks", "kind")).alias("p")
        regions = (
            members.groupBy("s", "band")
            .agg(pivot, F.count("*").alias("m"), F.min("comp").alias("low"), F.max("comp").alias("high"))
            .where("low <> high")
        )
        placed = members.join(regions.drop("low", "high"), ["s", "band"])
        names = ("kind", "n", "place", "own", "comp")
        placed = written(
            placed.select(*members.columns, "m", *(F.col(f"p.{c}").alias(f"p_{c}") for c in names)), "placed"
        )
        discard(members)
        members = placed
        largest = placed.agg(F.max("m")).first()[0]
        if not largest:
            break
        final = turn > 0 and (largest <= leaf or turn >= TURNS)
        if final:
            # Of two members one at least is outside the pivot's component, and one stands so far to
            # the front that its place alone does not rule out a partner of its own size.
            placed_low = placed.withColumn("low", F.expr(f"(n - place) * {100 + percent} >= {2 * percent} * n"))
            one = placed_low.where("comp <> p_comp").select("s", "band", "d", "low", *names)
            other = placed_low.select(
                "s",
                "band",
                F.col("d").alias("p_d"),
                F.col("low").alias("p_low"),
                (F.col("comp") == F.col("p_comp")).alias("p_main"),
                *(F.col(c).alias(f"p_{c}") for c in names),
            )
            close = F.coalesce(F.abs(F.col("d") - F.col("p_d")) <= tau, F.lit(True))
            met = [
                one.where("low").join(other, ["s", "band"]),
                one.where("not low").join(other.where("p_low"), ["s", "band"]),
            ]
            pairs = reduce(DataFrame.unionByName, [may_link(x.where("p_main or kind > p_kind").where(close)) for x in met]).distinct()
        else:
            pairs = may_link(placed.where("kind <> p_kind"))
        pairs = written(_possible(pairs, coordinates, percent), "pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("kind")).distinct()
        sets = written(_shingle_sets(docs, rows, ends, text), "sets")
        measured = written(_measured(pairs, sets), "measured")
        comps = _merged(comps, measured.where(f"100 * common >= {percent} * total"))
        for table in (pairs, sets):
            discard(table)
        if final:
            discard(measured)
            break
        rest = placed.where("kind <> p_kind").select("s", "band", "d", "tasks", "p_kind", *names[:-1])
        if turn == 0:
            ends = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
            distance = measured.select(F.explode(ends).alias("p"), (1 - F.col("common") / F.col("total")).alias("new_d"))
            distance = distance.select(F.col("p.a").alias("kind"), F.col("p.b").alias("p_kind"), "new_d")
            rest = rest.drop("d").join(distance, ["kind", "p_kind"], "left").withColumnRenamed("new_d", "d")
        of = comps.select(F.col("node").alias("kind"), F.col("component").alias("comp"))
        members = written(
            rest.join(of, "kind", "left").select(
                "s", "band", "kind", "n", "place", "own", "tasks", F.coalesce("comp", "kind").alias("comp"), "d"
            ),
            "members",
        )
        for table in (placed, measured):
            discard(table)
        turn += 1
    for table in (members, coordinates):
        discard(table)
    if comps is None:
        comps = docs.sparkSession.createDataFrame([], "node long, component long")
    kinds = rows.where("n > 0").groupBy("kind").agg(F.min("doc_id").alias("least"))
    named = kinds.join(comps.withColumnRenamed("node", "kind"), "kind", "left").withColumn("component", F.coalesce("component", "kind"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of_kind = named.join(ids, "component").select("kind", "component_id")
    linked = rows.where("n > 0").join(of_kind, "kind").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)
