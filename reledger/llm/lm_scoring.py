"""Cross-entropy difference: a target and a background bigram model score each document.

Every word and bigram of both corpora is counted; the counts are tables that grow with the corpus.
Whole texts are packed into chunks of some hundred thousand words, as places in the chunk's own
vocabulary. A chunk asks for the totals of its distinct bigrams and words: its counts go out by
hash, are summed per bucket of hashes, and the totals come back to the chunk in the order asked. So
a bigram that every text holds is one entry a chunk, nothing is broadcast, and a shuffle carries
sorted hashes and small numbers, packed, instead of rows.

1. Bigrams: a chunk learns how often each of its bigrams is in both corpora. One of the chunks
   that hold a bigram is told to own it.
2. Words: how often each is a word, and a context, in both corpora, and how many different words
   follow it, as each owner counts its bigrams once.
3. Losses: a chunk has all that its texts need.

p(w | h) = max(c(h, w) - d, 0) / c(h) + g(h) * p(w), where g(h) is the mass that is left, 1 for a
context that was not seen, and p(w) has add-one counts over the words of the background and one
word more, which stands for all others. Bigrams and words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import rolling
from .storage import discard, written

#: Words of a chunk, or more if one text has more; and its most texts.
CHUNK_WORDS = 1 << 19
CHUNK_TEXTS = 1 << 16
#: Entries of a bucket on average. Results depend on none of these bounds.
BUCKET = 1 << 20
DISCOUNT = 0.5
#: Stands before the first word of a text.
START = np.uint64(0)
#: Losses are whole multiples of 1 / STEPS, so their sums hardly depend on the order.
STEPS = float(1 << 32)

_ASKED = "chunk long, bucket int, keys binary, counts array<binary>"
_TOLD = "chunk long, bucket int, owned long, totals array<binary>"


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers as bytes, those of one place together, compressed."""
    planes = values.astype(np.int64, copy=False).view(np.uint8).reshape(-1, 8).T
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes) -> np.ndarray:
    n = int.from_bytes(raw[:8], "little")
    planes = pa.decompress(raw[8:], decompressed_size=8 * n, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, n).T).reshape(-1).view(np.int64)


def _steps(keys: np.ndarray) -> bytes:
    """Sorted hashes, packed as the steps between them."""
    return _packed(np.diff(keys, prepend=np.uint64(0)).view(np.int64))


def _hashes(raw: bytes) -> np.ndarray:
    return np.cumsum(_unpacked(raw).view(np.uint64), dtype=np.uint64)


def _chunks(rows: DataFrame, most: int) -> DataFrame:
    """Chunks of the rows (id, text, near): ids, words of each text, near, vocabulary and words as its places."""
    kind = rows.schema["id"].dataType.simpleString()
    names = ["chunk", "ids", "sizes", "near", "vocabulary", "words", "n_words", "near_words", "n_vocabulary", "n_bigrams"]

    def chunk(number: int, ids: list, near: list, sizes: list, hashes: list) -> pa.RecordBatch:
        size, is_near, text = np.concatenate(sizes), np.concatenate(near), np.concatenate([[START], *hashes])
        vocabulary, place = np.unique(text, return_inverse=True)
        words = place[1:]
        code, _, _ = _bigrams(size, words, len(vocabulary))
        ids = pa.concat_arrays(ids)
        values = [
            pa.array([number], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            *(pa.array([x], pa.binary()) for x in (_packed(size), _packed(is_near), _steps(vocabulary), _packed(words))),
            *(pa.array([int(x)], pa.int64()) for x in (len(words), size[is_near].sum(), len(vocabulary), len(code))),
        ]
        return pa.RecordBatch.from_arrays(values, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: tuple[list, ...] = ([], [], [], [])
        n_words = n_texts = 0
        for batch in batches:
            for first, last, block, offsets in rolling.blocks(batch.column(1)):
                _, _, hashes, text = rolling.words(block, offsets)
                size = np.bincount(text, minlength=last - first).astype(np.int64)
                near = batch.column(2).slice(first, last - first).to_numpy(zero_copy_only=False)
                for parts, part in zip(held, (batch.column(0).slice(first, last - first), near, size, hashes), strict=True):
                    parts.append(part)
                n_words, n_texts = n_words + len(hashes), n_texts + last - first
                if n_words >= most or n_texts >= CHUNK_TEXTS:
                    yield chunk(number, *held)
                    held, n_words, n_texts, number = ([], [], [], []), 0, 0, number + 1
        if n_texts:
            yield chunk(number, *held)

    packed = "sizes binary, near binary, vocabulary binary, words binary"
    numbers = "n_words long, near_words long, n_vocabulary long, n_bigrams long"
    return rows.select("id", "text", "near").mapInArrow(run, f"chunk long, ids array<{kind}>, {packed}, {numbers}")


def _bigrams(sizes: np.ndarray, words: np.ndarray, n_vocabulary: int):
    """Distinct bigrams of a chunk as context * n_vocabulary + word, the bigram of each word, and each word's text."""
    text = np.repeat(np.arange(len(sizes)), sizes)
    context = np.zeros(len(words), np.int64)
    context[1:] = np.where(text[1:] == text[:-1], words[:-1], 0)  # the place of START is 0
    code, place = np.unique(context * n_vocabulary + words, return_inverse=True)
    return code, place, text


class _Chunk:
    """A row of `_chunks`: its distinct bigrams by hash, and the counts of its own texts."""

    def __init__(self, row: dict):
        self.number = row["chunk"]
        self.sizes, self.is_near = _unpacked(row["sizes"]), _unpacked(row["near"]).astype(bool)
        self.vocabulary, words = _hashes(row["vocabulary"]), _unpacked(row["words"])
        n = len(self.vocabulary)
        code, place, self.text = _bigrams(self.sizes, words, n)
        context, word = code // max(n, 1), code % max(n, 1)
        keys = rolling.mix(self.vocabulary[context]) ^ self.vocabulary[word]
        order = np.argsort(keys)
        self.keys, self.context, self.word = keys[order], context[order], word[order]
        at = np.empty(len(order), np.int64)
        at[order] = np.arange(len(order))
        self.place = at[place]
        self.far = np.bincount(self.place, minlength=len(order))
        self.near = np.bincount(self.place[self.is_near[self.text]], minlength=len(order))


_FIELDS = ("chunk", "sizes", "near", "vocabulary", "words")


def _rows(table: pa.Table | pa.RecordBatch) -> Iterator[_Chunk]:
    for row in table.select(list(_FIELDS)).to_pylist():
        yield _Chunk(row)


def _asked(number: int, keys: np.ndarray, counts: list[np.ndarray], bits: int) -> dict[str, list]:
    """The counts of a chunk's sorted keys, one row for each bucket: a key's first `bits` bits."""
    out: dict[str, list] = {"chunk": [], "bucket": [], "keys": [], "counts": []}
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        out["chunk"].append(number)
        out["bucket"].append(int(bucket[low]))
        out["keys"].append(_steps(keys[low:high]))
        out["counts"].append([_packed(c[low:high]) for c in counts])
    return out


def _table(columns: dict[str, list]) -> dict[str, pa.Array]:
    kinds = {"chunk": pa.int64(), "bucket": pa.int32(), "owned": pa.int64(), "keys": pa.binary()}
    return {name: pa.array(values, kinds.get(name, pa.list_(pa.binary()))) for name, values in columns.items()}


def _told(asked: DataFrame) -> DataFrame:
    """The totals of each row's keys over all chunks, and which of its keys it owns, in the first two counts.

    A key is owned by one of the rows that have it with a count above 0.
    """

    def total(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [_hashes(row["keys"]) for row in rows]
        ends = np.cumsum([len(k) for k in keys])[:-1]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = []
        for i in range(len(rows[0]["counts"])):
            counts = np.concatenate([_unpacked(row["counts"][i]) for row in rows])
            sums = np.zeros(len(distinct), np.int64)
            np.add.at(sums, place, counts)
            totals.append(np.split(sums[place], ends))
            if i < 2:
                has = np.flatnonzero(counts)
                _, first = np.unique(place[has], return_index=True)
                owned = np.zeros(len(place), np.int64)
                owned[has[first]] = 1
                totals.append(np.split(owned, ends))
        columns = {
            "chunk": [row["chunk"] for row in rows],
            "bucket": [row["bucket"] for row in rows],
            "owned": [int(o.sum()) for o in totals[1]],
            "totals": [[_packed(x) for x in of_row] for of_row in zip(*totals, strict=True)],
        }
        return pa.table(_table(columns))

    return asked.groupBy("bucket").applyInArrow(total, _TOLD)


def _bits(entries: int, bucket: int) -> int:
    return max(0, -(-entries // bucket) - 1).bit_length()


def _totals(told: pa.Table, kind: int, n: int) -> list[np.ndarray]:
    """What a chunk was told of its sorted keys, `n` columns of them."""
    rows = sorted((r for r in told.to_pylist() if r["kind"] == kind), key=lambda r: r["bucket"])
    return [np.concatenate([np.zeros(0, np.int64), *(_unpacked(r["totals"][i]) for r in rows)]) for i in range(n)]


def _ask_bigrams(chunks: DataFrame, bits: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                for chunk in _rows(batch.slice(i, 1)):
                    asked = _table(_asked(chunk.number, chunk.keys, [chunk.far, chunk.near], bits))
                    yield pa.RecordBatch.from_pydict(asked)

    return chunks.select(*_FIELDS).mapInArrow(run, _ASKED)


def _ask_words(chunks: DataFrame, bigrams: DataFrame, bits: int) -> DataFrame:
    """Counts of each word of a chunk: as a word, as a context, and of the bigrams it begins that the chunk owns."""

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        found: dict[str, list] = {"chunk": [], "bucket": [], "keys": [], "counts": []}
        for chunk in _rows(left):
            _, owned_far, _, owned_near = _totals(right, 0, 4)

            def of(place: np.ndarray, n: np.ndarray, chunk: _Chunk = chunk) -> np.ndarray:
                return np.bincount(place, weights=n, minlength=len(chunk.vocabulary)).astype(np.int64)

            counts = [
                *(of(chunk.word, n) for n in (chunk.far, chunk.near)),
                *(of(chunk.context, n) for n in (chunk.far, chunk.near, owned_far, owned_near)),
            ]
            for name, values in _asked(chunk.number, chunk.vocabulary, counts, bits).items():
                found[name] += values
        return pa.table(_table(found))

    return chunks.select(*_FIELDS).groupBy("chunk").cogroup(bigrams.groupBy("chunk")).applyInArrow(ask, _ASKED)


def _losses(chunks: DataFrame, told: DataFrame, n_words: int, sizes: tuple[int, int]) -> DataFrame:
    """(id, n, near, far) of each text: its words, and the sums of their losses in nats under either model."""
    kind = chunks.schema["ids"].dataType.elementType.simpleString()

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for i, chunk in enumerate(_rows(left)):
            far_n, _, near_n, _ = _totals(right, 0, 4)
            far_w, _, near_w, _, far_h, near_h, far_after, near_after = _totals(right, 1, 8)
            sums = []
            for n, w, h, after, size in ((near_n, near_w, near_h, near_after, sizes[1]), (far_n, far_w, far_h, far_after, sizes[0])):
                single = (w[chunk.word] + 1) / float(size + n_words + 1)
                context = h[chunk.context]
                share = np.maximum(n - DISCOUNT, 0.0) / np.maximum(context, 1)
                left_over = np.where(context > 0, DISCOUNT * after[chunk.context] / np.maximum(context, 1), 1.0)
                loss = np.rint(-np.log(share + left_over * single) * STEPS) / STEPS
                sums.append(np.bincount(chunk.text, weights=loss[chunk.place], minlength=len(chunk.sizes)).astype(float))
            ids = left.column("ids").slice(i, 1).combine_chunks().flatten()
            out.append(pa.table({"id": ids, "n": pa.array(chunk.sizes), "near": pa.array(sums[0]), "far": pa.array(sums[1])}))
        return pa.concat_tables(out)

    both = chunks.select(*_FIELDS, "ids").groupBy("chunk").cogroup(told.groupBy("chunk"))
    return both.applyInArrow(score, f"id {kind}, n long, near double, far double")


def cross_entropy_difference(
    docs: DataFrame,
    target_ids: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_id: str = "doc_id",
    hot: int | None = None,
    chunk: int = CHUNK_WORDS,
    bucket: int = BUCKET,
) -> DataFrame:
    """(doc_id, n_tokens, target_loss, background_loss, score) for each row of `docs`.

    The target corpus is the rows whose id is in `target_ids`, the background all rows. Losses are
    mean nats per word; score is target_loss - background_loss, lower for texts nearer to the
    target. Words are those of the shingles, A-Z lower-cased. A null, empty or blank text has
    n_tokens 0 and null losses. Without target documents the target model is uniform. Repeated rows
    count and are scored each; other columns are ignored; an empty table gives no rows. All words
    and bigrams are in both models; `chunk` and `bucket` bound what a task holds. `hot` bounded the
    bigrams that were broadcast; none are now, and results never depended on it.
    """
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    wanted = target_ids.select(F.col(target_id).alias("id")).where("id is not null").distinct()
    # One plan for a target of any size.
    wanted = wanted.withColumn("near", F.lit(True)).hint("merge")
    rows = rows.join(wanted, "id", "left").withColumn("near", F.coalesce("near", F.lit(False)))
    # Written, as a chunk's number and its texts hold for one run only.
    chunks = written(_chunks(rows, chunk), "chunks")
    sums = chunks.agg(*(F.sum(c).alias(c) for c in ("n_words", "near_words", "n_vocabulary", "n_bigrams"))).first()
    kind = F.lit(0).alias("kind")
    bigrams = written(_told(_ask_bigrams(chunks, _bits(sums.n_bigrams or 0, bucket))).select("*", kind), "bigrams")
    words = _told(_ask_words(chunks, bigrams, _bits(sums.n_vocabulary or 0, bucket)))
    words = written(words.select("*", (kind + 1).alias("kind")), "words")
    n_words = words.agg(F.sum("owned")).first()[0] or 0
    scored = _losses(chunks, bigrams.unionByName(words), n_words, (sums.n_words or 0, sums.near_words or 0))
    scored = written(scored, "scored")
    for table in (chunks, bigrams, words):
        discard(table)
    near, far = (F.when(F.col("n") > 0, F.col(c) / F.col("n")) for c in ("near", "far"))
    return scored.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_tokens"),
        near.alias("target_loss"),
        far.alias("background_loss"),
        (near - far).alias("score"),
    )
