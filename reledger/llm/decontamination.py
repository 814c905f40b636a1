"""Short test items found inside long documents by size-partitioned MinHash containment search.

Items are partitioned by the size of their shingle sets (powers of two). An item of n shingles
keeps its n - ceil(threshold * n) + 1 smallest hashes: a document that holds enough of the item
holds one of them, so the sketch loses no match whatever the document's length. Document shingles
pass a fixed-size bitmap of the item shingles first; the few that pass go on as text, and the
candidates that share a sketch hash are verified by counting equal shingles, not hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import rolling
from .bitmaps import bitmap, member
from .storage import written

BITMAP_BITS = 24


def _shingle_texts(block: np.ndarray, offsets: np.ndarray, flags: np.ndarray | None):
    """(text number, hash, shingle as text) of the distinct shingles whose flag is set."""
    start, end, hashes, owner = rolling.words(block, offsets)
    value, of = rolling.shingles(hashes, owner, len(offsets) - 1)
    count = np.bincount(owner, minlength=len(offsets) - 1)
    # The first word of each shingle: full shingles in word order, then one of each short text.
    k = rolling.SHINGLE_WORDS
    begin = np.cumsum(count) - count
    full = np.flatnonzero(owner[k - 1 :] == owner[: len(owner) - k + 1]) if len(owner) >= k else np.zeros(0, np.int64)
    word = np.concatenate([full, begin[of[len(full) :]]]) if len(of) else full
    hit = np.flatnonzero(member(flags, value)) if flags is not None else np.arange(len(value))
    seen, out = set(), ([], [], [])
    for i in hit:
        first = int(word[i])
        last = min(first + k, int(begin[of[i]] + count[of[i]]))
        parts = [block[start[w] : end[w]].tobytes().lower() for w in range(first, last)]
        item = (int(of[i]), b" ".join(parts))
        if item not in seen:
            seen.add(item)
            out[0].append(item[0])
            out[1].append(int(value[i].view(np.int64)))
            out[2].append(item[1])
    return out


def _exploded(df: DataFrame, key: str, text: str, flags) -> DataFrame:
    """(id, hash, shingle) of the distinct shingles of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = flags.value if flags is not None else None
        for batch in batches:
            for first, last, block, offsets in rolling.blocks(batch.column(1)):
                text_no, value, shingle = _shingle_texts(block, offsets, wanted)
                ids = batch.column(0).slice(first, last - first).take(pa.array(text_no, type=pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(value, type=pa.int64()), pa.array(shingle, type=pa.binary())],
                    names=["id", "hash", "shingle"],
                )

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        run, f"id {kind}, hash long, shingle binary"
    )


def sketches(items: DataFrame, percent: int = 80, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, hash, shingle, n, size_class, sketch): all shingles of each item, sketch flags."""
    rows = _exploded(items, item_id, text, None).dropDuplicates(["id", "shingle"])
    of = Window.partitionBy("id")
    n = F.count("*").over(of)
    rank = F.row_number().over(of.orderBy("hash", "shingle"))
    need = F.ceil(F.col("n") * F.lit(percent) / 100)
    return rows.select(F.col("id").alias("item_id"), "hash", "shingle", n.alias("n"), rank.alias("rank")).select(
        "item_id",
        "hash",
        "shingle",
        "n",
        F.floor(F.log2("n")).cast("int").alias("size_class"),
        (F.col("rank") <= F.col("n") - need + 1).alias("sketch"),
    )


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    percent: int = 80,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_item, n_common, containment): items of which a document holds enough.

    Shingles are five words, A-Z lower-cased; a text of fewer words is one shingle. containment is
    the held share of the item's distinct shingles, at least percent / 100. Items and documents that
    are null, empty or blank match nothing; rows with one id count as one document or item, null ids
    too. Other columns are ignored; empty tables give no rows.
    """
    known = written(sketches(items, percent, item_id, item_text), "item-shingles")
    flags = docs.sparkSession.sparkContext.broadcast(bitmap(known, "hash", BITMAP_BITS))
    hits = written(_exploded(docs, doc_id, text, flags), "hits").distinct()
    candidates = (
        hits.join(known.where("sketch").select("size_class", "hash", "shingle", "item_id"), ["hash", "shingle"])
        .select("id", "item_id")
        .distinct()
    )
    held = hits.join(known.select("hash", "shingle", "item_id", "n"), ["hash", "shingle"])
    counted = held.groupBy("id", "item_id").agg(F.first("n").alias("n_item"), F.count("*").alias("n_common"))
    same = F.col("id").eqNullSafe(F.col("c_id")) & F.col("item_id").eqNullSafe(F.col("c_item"))
    return (
        counted.where(F.col("n_common") * 100 >= F.col("n_item") * percent)
        .join(candidates.toDF("c_id", "c_item"), same, "left_semi")
        .select(
            F.col("id").alias("doc_id"),
            "item_id",
            "n_item",
            "n_common",
            (F.col("n_common") / F.col("n_item")).alias("containment"),
        )
    )


def decontaminated(docs: DataFrame, items: DataFrame, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, whose own text holds no item; see `contained_items`.

    Rows are told apart by their whole text, not by their id, so a row without an id, or one that
    repeats an id, goes only for what it holds itself. Equal texts are judged once.
    """
    # 256 bits: a clean row never goes for another's text.
    whole = F.unhex(F.sha2(F.col(text).cast("binary"), 256))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), whole.alias("doc_id"))
    held = contained_items(docs.select(whole.alias("doc_id"), F.col(text).alias("text")), items, percent)
    return rows.join(held.select("doc_id").distinct(), "doc_id", "left_anti").select("row.*")
