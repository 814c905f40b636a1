"""Consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

The ring has 2**14 cells. Every shard owns `virtual_nodes` points of it, and a row belongs to the
first point at or after its cell. Rows are counted by cell; from these counts alone (2**14
numbers at any size) the driver walks the ring once: a cell's rows go to the shard of their point
until it is full and the rest continue clockwise to the next shard with room. A shard is full at
the mean, rounded up for as many shards as the remainder needs, so row counts differ by one at
most. A row's rank inside its cell then says which part of the cell's plan holds it: shards and
gapless slots follow without any shard being sorted as a whole. Ranks are taken in parts of a cell,
by a hash of the text, and added to the rows of earlier parts, so that one id with many texts
is no task's burden.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import written

CELL_BITS = 14
#: Parts of a cell that are ranked apart.
CELL_PARTS = 256
_PLAN = "array<struct<cell:int,low:long,high:long,shard:int,slot0:long>>"


def _cell(position: Column) -> Column:
    return F.shiftrightunsigned(position, 64 - CELL_BITS).cast("int")


def ring(spark: SparkSession, shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node in ring order; as many as the parameters say.

    A shard's nodes keep their places whatever the number of shards, so one more shard takes over
    what lies before its own nodes and little else moves.
    """
    points = spark.range(shards * virtual_nodes).select(
        _cell(F.xxhash64(F.lit("virtual node"), F.col("id"))).alias("cell"),
        F.expr(f"cast(id div {virtual_nodes} as int)").alias("shard"),
        "id",
    )
    return [(r.cell, r.shard) for r in points.orderBy("cell", F.xxhash64("id"), "id").collect()]


def bounded_plan(points: list[tuple[int, int]], counts: dict[int, int], shards: int) -> list[dict]:
    """Which rows of each cell, by rank, go to which shard and from which slot on."""
    total = sum(counts.values())
    least, spare = divmod(total, shards)
    load, closed = [0] * shards, [False] * shards
    after = list(range(len(points)))

    def room(point: int) -> int:
        """The first point at or after this one whose shard is open; passed points are skipped later."""
        seen = []
        while closed[points[point][1]]:
            seen.append(point)
            point = after[point] if after[point] != point else (point + 1) % len(points)
        for passed in seen:
            after[passed] = point
        return point

    plan, point = [], 0
    for cell in sorted(counts):
        while point < len(points) and points[point][0] < cell:
            point += 1
        at, low = point % len(points), 0
        while low < counts[cell]:
            for shard in range(shards):
                closed[shard] = load[shard] >= least + (1 if spare else 0)
            at = room(at)
            shard = points[at][1]
            limit = least if load[shard] < least else least + 1
            take = min(counts[cell] - low, limit - load[shard])
            plan.append({"cell": cell, "low": low, "high": low + take, "shard": shard, "slot0": load[shard]})
            if load[shard] == least:
                spare -= 1
            load[shard] += take
            low += take
    return plan


def shard_rows(
    docs: DataFrame, shards: int = 24, virtual_nodes: int = 32, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """All columns of `docs` plus shard (from 0) and slot (gapless from 0 within the shard).

    The key on the ring is the id, or the text where the id is null. Repeated rows are rows of their
    own. Columns named shard or slot are replaced. Rows of equal id and text are ordered by a hash of
    their other columns, maps left out. Counts of shards differ by one at most; a table
    with fewer rows than shards leaves shards empty, an empty one gives no rows.
    """
    if shards < 1 or virtual_nodes < 1:
        raise ValueError("shards and virtual_nodes must be positive")
    spark = docs.sparkSession
    position = F.when(F.col(doc_id).isNull(), F.xxhash64(F.lit("text"), F.col(text))).otherwise(
        F.xxhash64(F.col(doc_id))
    )
    cell = _cell(position).alias("cell")
    part = F.pmod(F.xxhash64(position, F.col(text)), F.lit(CELL_PARTS)).cast("int").alias("part")
    by_part = written(docs.groupBy(cell, part).agg(F.count("*").alias("n")), "cell-parts")
    counts = {r.cell: r.n for r in by_part.groupBy("cell").agg(F.sum("n").alias("n")).collect()}
    plan = bounded_plan(ring(spark, shards, virtual_nodes), counts, shards)
    parts = spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(plan)), _PLAN)))
    earlier = Window.partitionBy("cell").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("cell", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    kept = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if f.name in kept and not isinstance(f.dataType, T.MapType)]
    nested = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in kept)).alias("row"),
        position.alias("position"),
        F.col(doc_id).alias("id"),
        F.crc32(F.col(text).cast("binary")).alias("crc"),
        F.xxhash64(*hashed).alias("rest"),
        cell,
        part,
    )
    order = Window.partitionBy("cell", "part").orderBy("position", "id", "crc", "rest")
    ranked = nested.withColumn("place", F.row_number().over(order) - 1).join(before, ["cell", "part"])
    ranked = ranked.withColumn("rank", F.col("place") + F.col("before"))
    placed = ranked.join(F.broadcast(parts), "cell").where("rank >= low and rank < high")
    return placed.select("row.*", "shard", (F.col("slot0") + F.col("rank") - F.col("low")).alias("slot"))


def shard_digest(docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row of `docs`.

    A null text has 8 bytes and no crc.
    """
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.col(text).cast("binary")).alias("text_crc32"),
        F.when(F.col(doc_id).isNull(), F.col(text)).alias("text"),
    )
    return shard_rows(narrow, shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
