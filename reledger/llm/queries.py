"""One registered query for each operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest
from .decontamination import contained_items
from .extraction import extract
from .jaccard_join import jaccard_components
from .language_id import dictionaries, identify
from .lm_scoring import cross_entropy_difference
from .mixing import mix_digest
from .periodic_runs import periodic_runs, run_digest, with_planted_periods
from .phrases import collocations
from .sharding import shard_digest
from .simhash import simhash_components
from .storage import table
from .suffix_dedup import suffix_dedup
from .url_filter import url_verdicts


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from training: crc32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


def op4_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target corpus is the documents that `labels` calls good."""
    good = table(spark, sf_dir, "labels").where("quality = 1")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), good)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, dictionaries(docs.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_digest(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_digest(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(periodic_runs(with_planted_periods(table(spark, sf_dir, "documents"))))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ann,
        op2_suffix_dedup,
        op3_url_filter,
        op4_extraction,
        op5_lm_scoring,
        op6_language_id,
        op7_jaccard_join,
        op8_decontamination,
        op9_mixing,
        op10_sharding,
        op11_periodic_runs,
        op12_simhash,
        op13_phrases,
    )
}
