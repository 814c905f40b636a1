"""One row of each group of near-duplicate texts, from the classes of the n-gram Jaccard join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .jaccard_join import jaccard_components


def one_of_each(docs: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, less all but one of each group of texts linked at `percent`.

    The one that stays has the smallest id, or none where no row of the group has one; the text's
    hash, then that of the whole row break ties. Links are between texts, told apart by 256-bit
    hashes, so rows without an id and different texts under one id are each judged for themselves.
    Texts without words are linked with nothing: rows that repeat id and text leave one, those
    without an id all stay. An empty table gives no rows.
    """
    base = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.unhex(F.sha2(F.col(text).cast("binary"), 256)).alias("whole"),
        F.col(doc_id).alias("id"),
        F.col(text).alias("text"),
        F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"),
    )
    worded, blank = base.where("worded"), base.where("not worded")
    found = jaccard_components(base.select(F.col("whole").alias("doc_id"), "text"), percent).where("n_shingles > 0")
    linked = found.select(F.col("doc_id").alias("of"), "component_id").distinct()
    # One row a text before the join, so that copies do not meet in one task.
    first = worded.groupBy("whole").agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id")).alias("first"))
    best = linked.join(first, F.col("of") == F.col("whole")).groupBy("component_id").agg(F.min(F.struct("first", "whole")).alias("best"))
    kept = best.select(F.col("best.whole").alias("kept_whole"), F.col("best.first.id").alias("kept_id"))
    same = (F.col("whole") == F.col("kept_whole")) & F.col("id").eqNullSafe(F.col("kept_id"))
    stays = worded.join(kept, same, "left_semi").unionByName(blank.where("id is not null"))
    place = F.row_number().over(Window.partitionBy("id", "whole").orderBy(F.xxhash64("row")))
    rows = stays.select("row", "id", "whole").withColumn("place", place).where("place = 1")
    return rows.select("row.*").unionByName(blank.where("id is null").select("row.*"))
