"""Registered queries with SQL against that SQL, and the pipeline, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import corpus_pipeline
from reledger.llm.oracles import ORACLES
from reledger.llm.queries import REGISTRY
from tests.compare import compare, duck

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SMALL).is_dir(), reason="the sample tables are not on this machine")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    rows, difference = compare(REGISTRY[name](spark, SMALL), duck(SMALL), ORACLES[name])
    assert difference == "" and rows > 0


def test_pipeline_keeps_columns_and_one_of_each_group(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = corpus_pipeline.run(spark, SMALL)
    assert set(docs.columns) < set(rows.columns)
    sizes = [r["count"] for r in rows.groupBy("shard").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_near_duplicates_without_and_with_repeated_ids(spark):
    """One row of each group stays, whatever the ids; unlinked texts stay."""
    words = {c: [f"{c}{i}" for i in range(40)] for c in "abcdef"}
    text = {c: " ".join(w) for c, w in words.items()}
    near = {c: " ".join([*w[:-1], "other"]) for c, w in words.items()}
    rows = [
        (None, text["a"]), (None, text["a"]), (None, near["a"]),  # linked only with each other
        (5, text["b"]), (None, text["b"]), (None, near["b"]), (4, near["b"]),  # linked with a row that has an id
        (None, text["c"]),  # linked with nothing
        (7, text["d"]), (7, text["e"]), (7, text["e"]), (8, near["e"]), (6, near["d"]),  # one id, two texts
        (None, None), (None, None), (9, " "), (10, " "),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 3):
        out = [tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs.repartition(parts), SMALL).collect()]
        of_a = [r for r in out if r in ((None, text["a"]), (None, near["a"]))]
        assert len(of_a) == 1
        expected = [of_a[0], (4, near["b"]), (None, text["c"]), (6, near["d"]), (7, text["e"]), (None, None), (None, None), (9, " "), (10, " ")]
        assert sorted(map(str, out)) == sorted(map(str, expected))
