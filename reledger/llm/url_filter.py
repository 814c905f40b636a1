"""URL verdicts: rules first, then gradient-boosted trees on lexical features.

Everything is DataFrame functions and Spark's own tree learner, so no Python runs on executors.
The trees learn from the URLs that a rule decides. Features describe the URL without naming it:
lengths, depths, shares of digits, entropy, parameter counts, and how the suffixes of the host fare
among the labelled URLs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import written

#: (rule, verdict); a rule is a host, which stands for its subdomains too, and the start of a path.
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
#: Bound of the distinct labelled URLs that the trees are fitted on; beyond it, a hash of the URL chooses.
SAMPLE = 20_000
#: Statistics of fewer keys than this are broadcast.
BROADCAST_KEYS = 100_000
TREES = 12
DEPTH = 4
#: Weight of the prior in suffix statistics, in URLs.
SMOOTHING = 8.0

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FEATURES = (
    "url_length",
    "host_length",
    "path_length",
    "query_length",
    "host_depth",
    "path_depth",
    "digit_ratio",
    "letter_ratio",
    "dash_count",
    "parameter_count",
    "host_entropy",
    "path_entropy",
    "secure",
    "fragment",
    "suffix_one",
    "suffix_two",
    "first_segment",
)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        own, start = rule.split("/", 1)
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(f"/{start}")
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    marks = F.split(text, "")
    total = F.greatest(F.length(text), F.lit(1))
    shares = F.transform(
        F.array_distinct(marks), lambda c: F.size(F.filter(marks, lambda x: x == c)) / total
    )
    return F.when(F.length(text) == 0, 0.0).otherwise(
        F.aggregate(shares, F.lit(0.0), lambda acc, p: acc - p * F.log2(p))
    )


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _suffix(host: Column, labels: int) -> Column:
    return F.substring_index(host, ".", -labels)


def lexical(urls: DataFrame) -> DataFrame:
    """`urls` (url, host, path and others) with the numeric features that need no labels."""
    url = F.coalesce("url", F.lit(""))
    length = F.greatest(F.length(url), F.lit(1))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return urls.withColumns(
        {
            "url_length": F.length(url).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "query_length": F.length(query).cast("double"),
            "host_depth": _count(F.col("host"), r"\."),
            "path_depth": _count(F.col("path"), "/"),
            "digit_ratio": _count(url, "[0-9]") / length,
            "letter_ratio": _count(url, "[A-Za-z]") / length,
            "dash_count": _count(url, "[-_]"),
            "parameter_count": F.when(query == "", 0.0).otherwise(_count(query, "&") + 1),
            "host_entropy": _entropy(F.col("host")),
            "path_entropy": _entropy(F.col("path")),
            "secure": F.lower(url).startswith("https://").cast("double"),
            "fragment": url.contains("#").cast("double"),
        }
    )


def _statistics(labelled: DataFrame, key: Column, name: str) -> DataFrame:
    """(key, blocked, n): all labelled rows by one suffix or path segment; `labelled` has distinct URLs and `times`."""
    found = labelled.groupBy(key.alias(f"{name}_key")).agg(
        F.sum(F.col("label") * F.col("times")).alias(f"{name}_blocked"), F.sum("times").alias(f"{name}_n")
    )
    found = written(found, name)
    return F.broadcast(found) if found.count() < BROADCAST_KEYS else found


def _with_statistics(rows: DataFrame, tables: dict[str, tuple[Column, DataFrame]], prior: float, own: bool) -> DataFrame:
    """Adds the smoothed share of blocked URLs; own: without the labels of the row's own URL."""
    less_n, less = (F.col("times"), F.col("label") * F.col("times")) if own else (F.lit(0), F.lit(0.0))
    for name, (key, table) in tables.items():
        rows = rows.withColumn(f"{name}_key", key).join(table, f"{name}_key", "left")
        n = F.greatest(F.coalesce(f"{name}_n", F.lit(0)) - less_n, F.lit(0))
        blocked = F.greatest(F.coalesce(f"{name}_blocked", F.lit(0.0)) - less, F.lit(0.0))
        share = (blocked + F.lit(prior * SMOOTHING)) / (n + F.lit(SMOOTHING))
        rows = rows.withColumn(name, share).drop(f"{name}_key", f"{name}_n", f"{name}_blocked")
    return rows


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    page_id: str = "page_id",
    url: str = "url",
    sample: int = SAMPLE,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for each row of `pages`.

    The longest fitting rule decides; where none fits, rule is null and the trees decide, score
    being their probability of block (null where a rule decided). A null url, or one without `://`,
    has an empty host and path and is judged by the trees like any other. Where the rules decide
    no URL, or all alike, nothing can be learned: that one verdict, else allow, is given, with a
    null score. Equal URLs get equal verdicts; other columns are ignored; an empty table gives no
    rows. Statistics of suffixes and segments count all labelled rows; the trees are fitted on `sample`
    distinct labelled URLs at most, the first by hash, each with its number of rows as its weight.
    """
    verdicts = F.create_map(*(F.lit(x) for pair in rules for x in pair))
    urls = (
        pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"))
        .withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
        .withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    )
    urls = written(urls, "urls")
    ruled = urls.where("rule is not null").select("page_id", "host", "path", "rule", verdicts[F.col("rule")].alias("verdict"))
    # Equal URLs have equal labels.
    labelled = (
        urls.where("rule is not null")
        .groupBy("url", "host", "path", (verdicts[F.col("rule")] == "block").cast("double").alias("label"))
        .agg(F.count("*").alias("times"))
    )
    labelled = written(labelled, "labelled")
    seen = labelled.agg(F.sum("times").alias("n"), (F.sum(F.col("label") * F.col("times")) / F.sum("times")).alias("prior")).first()
    open_urls = urls.where("rule is null").select("page_id", "url", "host", "path")
    fixed = F.lit(None).cast("double")
    if not seen.n or seen.prior in (0.0, 1.0):
        only = F.lit("block" if seen.n and seen.prior == 1.0 else "allow")
        rest = open_urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), only.alias("verdict"), fixed.alias("score"))
    else:
        keys = {
            "suffix_one": _suffix(F.col("host"), 1),
            "suffix_two": _suffix(F.col("host"), 2),
            "first_segment": F.regexp_extract("path", r"^/([^/]*)", 1),
        }
        tables = {name: (key, _statistics(labelled, key, name)) for name, key in keys.items()}
        fitted = written(labelled.orderBy(F.xxhash64("url"), "url").limit(sample), "fitted")
        assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        train = assembler.transform(_with_statistics(lexical(fitted), tables, seen.prior, True))
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=3, maxBins=32, weightCol="weight")
        model = trees.fit(written(train.select("features", "label", F.col("times").cast("double").alias("weight")), "training"))
        judged = model.transform(assembler.transform(_with_statistics(lexical(open_urls), tables, seen.prior, False)))
        share = F.round(F.element_at(vector_to_array(F.col("probability")), 2), 9)
        rest = judged.select(
            "page_id",
            "host",
            "path",
            F.lit(None).cast("string").alias("rule"),
            F.when(share >= 0.5, "block").otherwise("allow").alias("verdict"),
            share.alias("score"),
        )
    return ruled.withColumn("score", fixed).unionByName(rest)

