"""Language identification by compression with one zstandard dictionary per language.

A dictionary is raw content: excerpts of labelled texts of the language. A text is compressed
with each dictionary, in blocks, so that a long text cannot become its own dictionary, and the
smallest sum wins. Texts and dictionaries are lower-cased and keep letters only, one space between
words, so that shouting, marks and digits weigh nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Bounds of the labelled sample: excerpts a language and their characters.
EXCERPTS = 160
EXCERPT_CHARS = 800
OVERSAMPLED = 40
BLOCK = 2048
#: Lazy matching from four bytes on: short words count, at a third of the time of level 9.
PARAMETERS = zstandard.ZstdCompressionParameters(
    window_log=18,
    hash_log=16,
    chain_log=17,
    search_log=4,
    min_match=4,
    target_length=32,
    strategy=zstandard.STRATEGY_LAZY,
    write_content_size=0,
)
MIN_MARGIN = 0.004
UNDETERMINED = "und"

_OTHER = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


def plain(text: str) -> str:
    """Lower-cased words of letters, one space between them."""
    return _OTHER.sub(" ", text).strip().lower()


def dictionaries(
    labelled: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    excerpts: int = EXCERPTS,
    chars: int = EXCERPT_CHARS,
) -> dict[str, bytes]:
    """Raw-content dictionary of each label, from the `excerpts` texts that a hash of id and text puts first.

    An excerpt is `chars` characters of the letters of a text, from a place that the hash names, so
    that how texts open counts no more than the rest. The driver holds excerpts * chars characters
    a label at most. Only rows whose hash is small enough are ordered, forty times as many as are
    wanted of each label, and they are limited before and after the shuffle. Labels are ordered by
    their number of rows, most first.
    """
    place = F.shiftrightunsigned(F.xxhash64(F.col(doc_id), F.col(text)), 1).alias("hash")
    usable = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    usable = usable.select(F.col(lang).alias("lang"), F.col(text).alias("text"), place)
    common = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").collect()
    limits = [(row.lang, min((1 << 63) - 1, (1 << 63) * OVERSAMPLED * excerpts // row.n)) for row in common]
    limit = F.broadcast(labelled.sparkSession.createDataFrame(limits, "lang string, most long"))
    order = Window.partitionBy("lang").orderBy("hash", "text")
    letters = F.trim(F.regexp_replace("text", r"[^\p{L}\p{M}]+", " "))
    start = F.pmod(F.xxhash64("hash"), F.greatest(F.length("letters") - chars + 1, F.lit(1))) + 1
    rows = (
        usable.join(limit, "lang")
        .where("hash <= most")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= excerpts)
        .select("lang", "place", "hash", letters.alias("letters"))
        .select("lang", F.substring("letters", start.cast("int"), F.lit(chars)).alias("part"), "place")
        .orderBy("lang", F.desc("place"))
        .collect()
    )
    out: dict[str, list[str]] = {row.lang: [] for row in common}
    for row in rows:
        out[row.lang].append(plain(row.part))
    return {k: "\n".join(v).encode() for k, v in out.items()}


class Classifier:
    """Compressors of all languages; made once in each task."""

    def __init__(self, contents: dict[str, bytes]):
        self.compressors = []
        for rank, (name, content) in enumerate(contents.items()):
            raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            raw.precompute_compress(compression_params=PARAMETERS)
            compressor = zstandard.ZstdCompressor(dict_data=raw, compression_params=PARAMETERS)
            self.compressors.append((rank, name, compressor))

    def __call__(self, text: str | None) -> tuple[str, float]:
        """(language, margin): the margin is the share by which the best sum is below the next."""
        raw = plain(text).encode() if text and _LETTER.search(text) else b""
        if not raw or not self.compressors:
            return UNDETERMINED, 0.0
        parts = [raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)]
        sizes = sorted((sum(len(c.compress(p)) for p in parts), rank, name) for rank, name, c in self.compressors)
        if len(sizes) == 1:
            return sizes[0][2], 1.0
        return sizes[0][2], 1.0 - sizes[0][0] / sizes[1][0]


def identify(
    docs: DataFrame,
    contents: dict[str, bytes],
    doc_id: str = "doc_id",
    text: str = "text",
    min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) for each row of `docs`, from its whole text alone.

    lang_pred is the language whose dictionary compresses best, the one with more labels on a tie,
    and `und` where the text is null, has no letter, or nothing was learned. score, from 0 to 1,
    is the margin to the next language; below `min_margin` the row is rejected, as is `und`.
    Repeated rows are judged each; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(contents)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Classifier(shared.value)
        for batch in batches:
            found = [judge(value.as_py()) for value in batch.column(1)]
            name, score = [x[0] for x in found], [x[1] for x in found]
            rejected = [n == UNDETERMINED or s < min_margin for n, s in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(name, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, lang_pred string, score double, rejected boolean"
    )


def recognised(
    docs: DataFrame, contents: dict[str, bytes], text: str = "text", min_margin: float = MIN_MARGIN
) -> DataFrame:
    """The rows of `docs`, all columns, that `identify` does not reject, in one pass without a shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(contents)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Classifier(shared.value)
        for batch in batches:
            found = [judge(value.as_py()) for value in batch.column(place)]
            yield batch.filter(pa.array([n != UNDETERMINED and s >= min_margin for n, s in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
