"""SimHash near-duplicates by covering locality-sensitive hashing.

Each bit of a fingerprint has one of the 2**(r + 1) - 1 non-zero vectors of r + 1 bits, and each
table a mask: the bits whose vector has an odd product with the table's own. The vectors of r
differing bits always leave one table whose mask holds none of them, so fingerprints within the
radius r agree under the mask of some table, whatever they are. Equal fingerprints count once.

A bucket of few fingerprints is compared pair by pair. One of many, as a large group of near copies
makes it, gives links through common neighbours at one bit. What is one class by then is done; in
the other buckets only pairs of different classes are compared, or, in very large ones, links come
through common neighbours at all bits: fingerprints x, y within r bits have a value
z at r // 2 bits at most from one and the rest from the other. All that are so near to one z are
within the radius of an x, hence linked with it, so a star of them loses no class and its number
of links does not grow with the square of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .storage import written

BITS = 64
RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
#: Buckets up to this many fingerprints are compared pair by pair.
SMALL = 16
#: Larger ones of several classes too, up to so many; beyond, all pairs cost more than changed bits.
FEW = 512
BLOCK_SHINGLES = 1 << 16
PIECE_SHINGLES = 1 << 13


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def covering_masks(radius: int = RADIUS) -> list[int]:
    """One mask a table; any `radius` bits are outside at least one of them."""
    vectors = [i % ((2 << radius) - 1) + 1 for i in range(BITS)]
    return [
        sum(1 << i for i, vector in enumerate(vectors) if (vector & table).bit_count() & 1)
        for table in range(1, 2 << radius)
    ]


def _flips(bits: list[int], count: int) -> list[int]:
    return [_signed(sum(1 << i for i in chosen)) for chosen in combinations(bits, count)]


def _ones(flat: np.ndarray, count: np.ndarray) -> np.ndarray:
    """How many hashes of each text have each bit; `flat` holds `count` hashes a text, one after another."""
    ones = np.zeros((len(count), BITS), dtype=np.int64)
    owner = np.repeat(np.arange(len(count)), count)
    # A hash becomes 64 bytes and more here, so only a piece is unpacked at once, however long a text.
    for begin in range(0, len(flat), PIECE_SHINGLES):
        piece, own = flat[begin : begin + PIECE_SHINGLES], owner[begin : begin + PIECE_SHINGLES]
        bits = np.unpackbits(piece.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.flatnonzero(np.diff(own, prepend=-1))
        ones[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    return ones


def _block(ids: pa.Array, texts: list[np.ndarray]) -> pa.RecordBatch:
    count = np.array([len(hashes) for hashes in texts], dtype=np.int64)
    most = (2 * _ones(np.concatenate(texts), count) > count[:, None]).astype(np.uint8)
    prints = np.packbits(most, axis=1, bitorder="little").view("<u8").ravel()
    return pa.RecordBatch.from_arrays([ids, pa.array(prints.view(np.int64))], names=["doc_id", "print"])


def shingle_hashes(text: bytes) -> np.ndarray:
    """The unsigned XXH64 of each shingle of `SHINGLE_WORDS` words, in order, A-Z lower-cased."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    plain = b" ".join(words)
    end = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1)
    k = min(SHINGLE_WORDS, len(words))
    del words
    start = np.concatenate([[0], end[: len(end) - k]])
    digest = xxhash.xxh64_intdigest
    hashes = np.empty(len(start), dtype="<u8")
    for begin in range(0, len(start), PIECE_SHINGLES):
        piece = slice(begin, begin + PIECE_SHINGLES)
        ends = end[k - 1 :][piece].tolist()
        hashes[piece] = [digest(plain[a : b - 1], SEED) for a, b in zip(start[piece].tolist(), ends, strict=True)]
    return hashes


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, print): the 64-bit fingerprint of each row's whole text, as a signed long.

    A bit is set if it is in over half of the hashes of the text's three-word shingles, repeats
    included; a shorter text is one shingle, and one without words has the fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column(0), batch.column(1).cast(pa.large_binary())
            begin, texts, size = 0, [], 0
            for i in range(batch.num_rows):
                texts.append(shingle_hashes(column[i].as_py() or b""))
                size += len(texts[-1])
                if size >= BLOCK_SHINGLES or i + 1 == batch.num_rows:
                    yield _block(ids.slice(begin, len(texts)), texts)
                    begin, texts, size = i + 1, [], 0

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, print bigint"
    )


def _near(a: Column | str, b: Column | str, radius: int) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.bit_count(a.bitwiseXOR(b)) <= radius


def _small_links(members: DataFrame, radius: int, apart: str = "print") -> DataFrame:
    """Links within buckets of a few members, compared inside one row each if they differ in `apart`."""
    member = F.struct("print", F.col(apart).alias("apart"))
    listed = members.groupBy("table", "key").agg(F.sort_array(F.collect_list(member)).alias("all"))

    def linked(x: Column, i: Column) -> Column:
        later = F.slice("all", i + 2, F.size("all"))
        near = F.filter(later, lambda y: (x["apart"] != y["apart"]) & _near(x["print"], y["print"], radius))
        return F.transform(near, lambda y: F.struct(x["print"].alias("u"), y["print"].alias("v")))

    return listed.select(F.inline(F.flatten(F.transform("all", linked))))


def _stars(around: DataFrame, by: list[str]) -> DataFrame:
    """Links of the fingerprints around each centre, where one of them is `near` enough.

    A centre has as many neighbours as there are ways to change its bits, whatever the input.
    """
    found = around.groupBy(*by).agg(F.collect_set("print").alias("all"), F.max("near").alias("near"))
    first = F.array_min("all")
    return (
        found.where(F.col("near") & (F.size("all") > 1))
        .select(first.alias("u"), F.explode("all").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _large_links(members: DataFrame, masks: list[int], links: DataFrame, radius: int, few: int) -> DataFrame:
    """Links enough for the classes of buckets of many members, without comparing all pairs."""
    spark = members.sparkSession
    half = radius // 2
    prints = members.select("print").distinct()
    flips = [flip for count in range(half + 1) for flip in _flips(list(range(BITS)), count)]
    # Two that lie within 2 * half bits have a common neighbour at `half` bits from both.
    centres = F.array(*(F.col("print").bitwiseXOR(F.lit(flip)) for flip in flips))
    around = prints.select("print", F.explode(centres).alias("z"), F.lit(True).alias("near"))
    close = written(_stars(around, ["z"]), "simhash-close")
    if 2 * half == radius:
        return close
    # Buckets that are one class by now are done; the others meet at one more bit, outside the mask.
    known = components(links.unionByName(close))
    label = F.coalesce("component", "print")
    of = members.join(known, F.col("print") == F.col("node"), "left").select("table", "key", "print", label.alias("label"))
    classes = of.groupBy("table", "key").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count(F.lit(1)).alias("n")
    )
    left = written(
        of.join(classes.where("low <> high").select("table", "key", "n"), ["table", "key"]), "simhash-left"
    )
    # Only pairs of different classes can add anything.
    links = written(_small_links(left.where(F.col("n") <= few), radius, "label").distinct(), "simhash-apart")
    close = close.unionByName(links)
    left = left.where(F.col("n") > few).select("table", "key", "print")
    if left.isEmpty():
        return close
    rows = []
    for table, mask in enumerate(masks):
        free = [i for i in range(BITS) if not mask >> i & 1]
        rows += [(table, flip, True) for count in range(half + 1) for flip in _flips(free, count)]
        rows += [(table, flip, False) for flip in _flips(free, radius - half)]
    # Some thousand rows for a radius of 3, whatever the input.
    changes = F.broadcast(spark.createDataFrame(rows, "table int, flip bigint, near boolean"))
    around = left.join(changes, "table").select(
        "table", "key", "print", F.col("print").bitwiseXOR(F.col("flip")).alias("z"), "near"
    )
    return close.unionByName(written(_stars(around, ["table", "key", "z"]), "simhash-far"))


def covering_links(prints: DataFrame, radius: int = RADIUS, small: int = SMALL, few: int = FEW) -> DataFrame:
    """(u, v): links between the distinct values of `print` that give the classes of all pairs
    within `radius` bits. Each link is such a pair, or two that such pairs connect."""
    masks = covering_masks(radius)
    tables = F.array(
        *(
            F.struct(F.lit(i).alias("table"), F.col("print").bitwiseAND(F.lit(_signed(mask))).alias("key"))
            for i, mask in enumerate(masks)
        )
    )
    keyed = prints.select("print", F.explode(tables).alias("at")).select("at.table", "at.key", "print")
    buckets = keyed.groupBy("table", "key").agg(
        F.count(F.lit(1)).alias("n"), F.min("print").alias("u"), F.max("print").alias("v")
    )
    shared = written(buckets.where("n > 1"), "simhash-buckets")
    links = [shared.where((F.col("n") == 2) & _near("u", "v", radius)).select("u", "v")]
    more = shared.where("n > 2").select("table", "key", "n")
    members = written(keyed.join(more, ["table", "key"]), "simhash-members")
    links.append(_small_links(members.where(F.col("n") <= small), radius))
    found = written(reduce(DataFrame.unionByName, links).distinct(), "simhash-links")
    large = members.where(F.col("n") > small)
    if large.isEmpty():
        return found
    return found.unionByName(_large_links(large.select("table", "key", "print"), masks, found, radius, few))


def simhash_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", radius: int = RADIUS
) -> DataFrame:
    """(doc_id, fingerprint, component_id): classes of rows whose fingerprints are linked.

    Two rows link at `radius` differing bits or fewer; texts without words have the fingerprint 0
    and link like any other. fingerprint is 16 lowercase hexadecimal digits; component_id is the smallest id of
    the class, null where no row of it has one. Rows that repeat an id or a text are judged each;
    other columns are ignored, and an empty table gives no rows.
    """
    own = written(fingerprints(docs, doc_id, text), "simhash-prints")
    prints = written(own.groupBy("print").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    known = components(covering_links(prints.select("print"), radius))
    # Only linked fingerprints have a root of their own to be grouped by.
    linked = written(
        prints.join(known, F.col("print") == F.col("node")).select("print", "first", F.col("component").alias("root")),
        "simhash-roots",
    )
    roots = linked.groupBy("root").agg(F.min("first").alias("least"))
    least = linked.join(roots, "root").select(F.col("print").alias("linked"), "least")
    classes = written(
        prints.join(least, F.col("print") == F.col("linked"), "left").select(
            F.col("print").alias("of"),
            F.when(F.col("linked").isNull(), F.col("first")).otherwise(F.col("least")).alias("component_id"),
        ),
        "simhash-classes",
    )
    return own.join(classes, F.col("print") == F.col("of")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), BITS // 4, "0")).alias("fingerprint"), "component_id"
    )
