"""Mixing sources to target weights by capped water-filling.

Only word counts by source and, later, by source and cell of the seeded order are gathered.
A source's target gives each of its documents the whole part of target / size as repetitions;
the rest goes, one more repetition each, to the first documents of the seeded order, of which
the last gets only the words still missing. So every source meets its target to the word.

The order is that of a hash of the seed, the id and the whole text. Rows that share all three are
copies of each other: where the last place falls among them, they are counted and dealt out again
from their count, so none needs a place of its own and no task holds them all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

WEIGHTS = (5, 2, 1)
CELL_DIGITS = 3
#: A plan of more sources than this is joined by shuffle.
BROADCAST_ROWS = 50_000
#: Copies that one row is dealt out into at a time.
CHUNK = 1000


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def seeded(seed: int, doc_id: str, text: str) -> Column:
    """The place of a row in the order: equal for rows of equal id and text only."""
    whole = F.md5(F.col(text).cast("binary"))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(x, F.lit("-")) for x in (F.col(doc_id).cast("string"), whole))))


def bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, a written table, to be broadcast if it has no more than `most` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def water_fill(sources: DataFrame, total: float, max_epochs: int) -> DataFrame:
    """(source, source_size, weight, target): min(max_epochs * size, level * weight), summing to total.

    Sources above their cap are clamped and the excess is shared by weight, until none is above.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    level, clamped = 0.0, -1
    while True:
        above = cap < F.col("weight") * F.lit(level)
        row = sources.agg(
            F.sum(F.when(above, 1).otherwise(0)).alias("n"),
            F.sum(F.when(above, cap).otherwise(0.0)).alias("held"),
            F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if row.n is None or row.n == clamped or not row.weight:
            break
        clamped, level = row.n, (total - row.held) / row.weight
    return sources.withColumn("target", F.least(cap, F.col("weight") * F.lit(level)))


def mixing_plan(
    narrow: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, max_epochs: int = 2
) -> DataFrame:
    """(source, source_size, target, whole, edge, left) from (source, size, key).

    Documents of a source with key < edge take one repetition more than `whole`, those at the
    edge `left` words more, together. Sources are few, so one task ranks them by code point, null last.
    """
    grouped = narrow.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    sources = written(grouped.withColumn("weight", weight), "sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    filled = (
        water_fill(sources, total * share, max_epochs)
        .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
        .withColumn("quota", F.round("target").cast("long") - F.col("whole") * F.col("source_size"))
        .select("source", "source_size", "target", F.col("whole").cast("long").alias("whole"), "quota")
    )
    filled = written(filled, "targets")
    few = bounded(filled)
    cell = F.substring("key", 1, CELL_DIGITS)
    # Cells of the seeded order first, then only the documents of each source's last cell.
    by_cell = narrow.groupBy("source", cell.alias("cell")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("cell")
    held = F.sum("words").over(upto)
    last = written(
        by_cell.withColumn("until", held)
        .withColumnRenamed("source", "s")
        .join(few, F.col("s").eqNullSafe(F.col("source")))
        .where("until > quota and until - words <= quota")
        .select("s", F.col("cell").alias("c"), (F.col("until") - F.col("words")).alias("before"), "quota"),
        "last-cells",
    )
    edges = (
        narrow.withColumn("cell", cell)
        .join(bounded(last), F.col("source").eqNullSafe(F.col("s")) & (F.col("cell") == F.col("c")))
        .groupBy("source", "key", "before", "quota")
        .agg(F.sum("size").alias("words"))
        .withColumn("until", F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("key")))
        .where("until > quota and until - words <= quota")
        .select(
            F.col("source").alias("s"),
            F.col("key").alias("edge"),
            (F.col("quota") - F.col("until") + F.col("words")).cast("long").alias("left"),
        )
    )
    plan = filled.join(edges, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "whole", F.coalesce("edge", F.lit("~")).alias("edge"), F.coalesce("left", F.lit(0)).alias("left")
    )
    return written(plan, "plan")


def _taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(row, size, source_size, target, whole, part) from (row, source, size, key): repetitions, words of one more.

    Rows at the edge of their source share their key. They are grouped with all they hold and dealt
    out again in chunks: the first ones whole, one in part, the rest not at all.
    """
    of = bounded(plan.withColumnRenamed("source", "s"))
    placed = rows.join(of, F.col("source").eqNullSafe(F.col("s")))
    out = ("row", "size", "source_size", "target", "whole")
    part = F.when(F.col("key") < F.col("edge"), F.col("size")).otherwise(0).cast("long").alias("part")
    beside = placed.where("key <> edge").select(*out, part)
    # The digest tells rows apart that differ in other columns; the first of them are taken.
    same = placed.where("key = edge").withColumn("mark", F.sha2(F.to_json("row"), 256))
    groups = same.groupBy("source", "mark").agg(
        *(F.first(c).alias(c) for c in (*out, "left")), F.count("*").alias("copies")
    )
    before = F.coalesce(F.sum("copies").over(Window.partitionBy("source").orderBy("mark").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    chunks = groups.withColumn("before", before).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / CHUNK)))
    )
    first = F.col("chunk") * CHUNK
    last = F.least(first + CHUNK, F.col("copies")) - 1
    dealt = chunks.repartition("source", "mark", "chunk").withColumn("place", F.explode(F.sequence(first, last)))
    left = F.col("left") - (F.col("before") + F.col("place")) * F.col("size")
    return beside.unionByName(
        dealt.select(*out, F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long").alias("part"))
    )


def _keyed(docs: DataFrame, seed: int, doc_id: str, text: str, source: str, keep: list[Column]) -> DataFrame:
    return docs.select(
        F.struct(*keep).alias("row"), F.col(source).alias("source"), word_count(text).alias("size"), seeded(seed, doc_id, text).alias("key")
    )


def mix_digest(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    max_epochs: int = 2,
    seed: int = 17,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """(doc_id, size, source_size, target, taken) for each row: how many of its words the mix takes.

    A null or blank text has size 0 and takes nothing; rows with a null source are one source,
    the last; a null doc_id is an id like any other. Rows of equal id and text are copies: where the
    last place falls among them, the first are taken whole, one in part and the rest not.
    """
    keyed = written(_keyed(docs, seed, doc_id, text, source, [F.col(doc_id).alias("doc_id")]), "sizes")
    plan = mixing_plan(keyed, weights, share, max_epochs)
    taken = (F.col("whole") * F.col("size") + F.col("part")).cast("long")
    return _taken(keyed, plan).select("row.doc_id", "size", "source_size", "target", taken.alias("taken"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    max_epochs: int = 2,
    seed: int = 17,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    n_chars: str | None = "n_chars",
) -> DataFrame:
    """The mix itself, with the columns of `docs`: a row for each repetition taken.

    The one document of a source that is taken in part keeps its first words, as written, and
    `n_chars`, where there is such a column, follows. Documents without words are not taken.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    narrow = written(_keyed(docs, seed, doc_id, text, source, columns[:1]).drop("row"), "sizes")
    plan = mixing_plan(narrow, weights, share, max_epochs)
    chosen = _taken(_keyed(docs, seed, doc_id, text, source, columns), plan)
    copies = chosen.withColumn(
        "words", F.explode(F.array_compact(F.array(*(
            F.when(F.col("whole") > i, F.col("size")) for i in range(max_epochs)
        ), F.col("part"))))
    ).where("words > 0")
    whole = F.col("words") == F.col("size")
    # The words up to the limit and the rest as one last part, which is cut off.
    body, space = F.col("row").getField(text), r"[\x20\x09-\x0D]"
    limit = F.col("words") + F.when(body.rlike(f"^{space}"), 2).otherwise(1)
    rest = F.element_at(F.split(body, f"{space}+", limit.cast("int")), -1)
    cut = F.regexp_replace(F.substring(body, F.lit(1), F.length(body) - F.length(rest)), f"{space}+$", "")
    out = {c: F.col("row").getField(c) for c in docs.columns}
    out[text] = F.when(whole, out[text]).otherwise(cut)
    if n_chars in docs.columns:
        out[n_chars] = F.when(whole, out[n_chars]).otherwise(F.length(cut).cast(docs.schema[n_chars].dataType))
    return copies.select(*(c.alias(name) for name, c in out.items()))
