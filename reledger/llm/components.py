"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .storage import discard, written


def _minimum(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours. Partial sums meet, so a hot node costs no task more."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Distinct edges with u > v: each larger neighbour of a node and the smallest one."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.join(_minimum(both), "u")
        .where("v > u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(down: DataFrame) -> DataFrame:
    """`down` holds distinct edges with u > v, as the large star leaves them.

    The join alone has both ends of what remains, so that the large star below is planned, shuffled
    and broadcast once: a second use of the minimum would be planned differently and run anew.
    """
    return (
        down.join(_minimum(down), "u")
        .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        .where("u <> v")
        .distinct()
    )


def _written_edges(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges, written, and their number and hash, taken while they are written."""
    state = Observation()
    seen = edges.observe(
        state,
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("hash"),
    )
    return written(seen, "edges"), state.get


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of `edges` (u, v): the smallest node it is connected with.

    Loops, repeated and reversed edges are allowed; an edge with a null end is ignored; no edges
    give no rows. The number of rounds grows with the logarithm of the largest component.
    """
    current, state = _written_edges(
        edges.where("u is not null and v is not null and u <> v").select("u", "v").distinct()
    )
    while state["n"]:
        before = current
        current, then = _written_edges(_small_star(_large_star(current)))
        discard(before)
        was, state = state, then
        if was == state:
            break
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
