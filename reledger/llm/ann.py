"""Approximate nearest neighbours by one hierarchical navigable small-world graph per shard.

Vectors are dealt over shards by a hash. A task builds the graph of a shard in batches: each
batch searches the graph so far with a beam, all its vectors at once, keeps diverse neighbours and
links back. A level is one flat array of neighbour numbers, -1 where a row has fewer. Shards are
rows of a table, so a lost executor rebuilds only its own. Every query searches every shard, and
the shard results merge by a grouped top-k.

Nearness is the inner product. Within a shard vectors get one more component that makes all
norms equal, so that the graph lives in a metric space in which the order is the same.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

NEIGHBOURS = 16
BUILD_BEAM = 64
SEARCH_BEAM = 112
SHARDS = 8
#: A shard's vectors, graph and one batch of searches fit in a task's memory.
SHARD_ROWS = 250_000
QUERY_BLOCK = 256
#: Queries that one task puts to one shard.
QUERY_CHUNK = 16_384


class Graph:
    """Levels of flat neighbour arrays; level 0 holds all nodes, level l those with height >= l."""

    def __init__(self, points: np.ndarray, levels: list[np.ndarray], members: list[np.ndarray]):
        self.points, self.levels, self.members = points, levels, members

    def dump(self) -> bytes:
        out = io.BytesIO()
        parts = {f"l{i}": x for i, x in enumerate(self.levels)} | {f"m{i}": x for i, x in enumerate(self.members)}
        np.savez(out, points=self.points, **parts)
        return out.getvalue()

    @staticmethod
    def load(raw: bytes) -> Graph:
        with np.load(io.BytesIO(raw)) as held:
            n = sum(k.startswith("l") for k in held.files)
            return Graph(held["points"], [held[f"l{i}"] for i in range(n)], [held[f"m{i}"] for i in range(n)])


def _beam(points, links, queries, entry, width):
    """The `width` best nodes found for each query from its entries: (nodes, scores), best first."""
    n_queries, n = len(queries), len(points)
    rows = np.arange(n_queries)[:, None]
    seen = np.zeros((n_queries, n + 1), dtype=bool)
    seen[:, n] = True  # the place of missing neighbours
    seen[rows, entry] = True
    nodes = np.full((n_queries, width), n, dtype=np.int64)
    scores = np.full((n_queries, width), -np.inf, dtype=np.float32)
    opened = np.ones((n_queries, width), dtype=bool)
    entry = np.sort(entry, axis=1)
    start = np.einsum("qed,qd->qe", points[entry], queries)
    start[:, 1:][entry[:, 1:] == entry[:, :-1]] = -np.inf
    k = min(width, entry.shape[1])
    best = np.argsort(-start, axis=1, kind="stable")[:, :k]
    nodes[:, :k], scores[:, :k] = entry[rows, best], start[rows, best]
    opened[:, :k] = ~np.isfinite(scores[:, :k])
    active = np.arange(n_queries)
    while len(active):
        # The best node of each query that was not opened yet; a query without one is done.
        pending = np.where(opened[active], -np.inf, scores[active])
        pick = pending.argmax(axis=1)
        live = np.isfinite(pending[np.arange(len(active)), pick])
        active, pick = active[live], pick[live]
        if not len(active):
            break
        opened[active, pick] = True
        near = links[nodes[active, pick]]
        near = np.where(near < 0, n, near)
        fresh = ~seen[active[:, None], near]
        seen[active[:, None], near] = True
        score = np.einsum("qed,qd->qe", points[np.where(near < n, near, 0)], queries[active])
        score = np.where(fresh, score, -np.inf).astype(np.float32)
        all_scores = np.concatenate([scores[active], score], axis=1)
        all_nodes = np.concatenate([nodes[active], near], axis=1)
        all_opened = np.concatenate([opened[active], ~fresh], axis=1)
        keep = np.argpartition(-all_scores, width - 1, axis=1)[:, :width]
        across = np.arange(len(active))[:, None]
        scores[active] = all_scores[across, keep]
        nodes[active] = all_nodes[across, keep]
        opened[active] = all_opened[across, keep]
    nodes = np.where(np.isfinite(scores), nodes, n)
    order = np.argsort(-scores, axis=1, kind="stable")
    return nodes[rows, order], scores[rows, order]


def _diverse(points, centres, candidates, scores, keep):
    """Neighbours of each centre: a candidate stays if no closer chosen one is nearer to it."""
    n, width = candidates.shape
    order = np.argsort(-scores, axis=1, kind="stable")
    across = np.arange(n)[:, None]
    candidates, scores = candidates[across, order], scores[across, order]
    valid = np.isfinite(scores) & (candidates >= 0)
    held = points[np.where(valid, candidates, 0)]
    among = np.einsum("nid,njd->nij", held, held)
    chosen = np.zeros((n, width), dtype=bool)
    count = np.zeros(n, dtype=np.int64)
    for i in range(width):
        shadowed = ((among[:, i, :] > scores[:, i, None]) & chosen).any(axis=1)
        take = valid[:, i] & ~shadowed & (count < keep)
        chosen[:, i] = take
        count += take
    for i in range(width):  # fill with the nearest of the rest
        take = valid[:, i] & ~chosen[:, i] & (count < keep)
        chosen[:, i] |= take
        count += take
    place = np.argsort(~chosen, axis=1, kind="stable")[:, :keep]
    out = np.full((n, keep), -1, dtype=np.int64)
    out[:, : place.shape[1]] = np.where(chosen[across, place], candidates[across, place], -1)
    return out


def _link_back(points, links, sources, targets, keep):
    """Adds sources to the rows of their targets; rows that overflow keep diverse neighbours."""
    pairs = [(sources[i], t) for i in range(len(sources)) for t in targets[i] if t >= 0]
    if not pairs:
        return
    source, target = np.array(pairs).T
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    rows, first, count = np.unique(target, return_index=True, return_counts=True)
    most = int(count.max())
    extra = np.full((len(rows), most), -1, dtype=np.int64)
    which = np.repeat(np.arange(len(rows)), count)
    extra[which, np.arange(len(target)) - first[which]] = source
    both = np.sort(np.concatenate([links[rows], extra], axis=1), axis=1)
    both[:, 1:][both[:, 1:] == both[:, :-1]] = -1  # two nodes of a batch may choose each other
    full = (both >= 0).sum(axis=1) > keep
    place = np.argsort(both < 0, axis=1, kind="stable")[:, :keep]
    links[rows[~full]] = both[~full][np.arange((~full).sum())[:, None], place[~full]]
    for part in np.array_split(np.flatnonzero(full), max(1, int(full.sum()) // 256)):
        if len(part):
            candidates = both[part]
            score = np.einsum("nid,nd->ni", points[np.where(candidates >= 0, candidates, 0)], points[rows[part]])
            links[rows[part]] = _diverse(points, rows[part], candidates, np.where(candidates >= 0, score, -np.inf), keep)


def _level(points, keep, beam):
    """The flat neighbour array of one level, built in batches of at most the size so far."""
    n = len(points)
    links = np.full((n, keep), -1, dtype=np.int64)
    done = min(n, 256)
    score = points[:done] @ points[:done].T
    np.fill_diagonal(score, -np.inf)
    for part in np.array_split(np.arange(done), max(1, done // 128)):
        width = min(done, beam)
        near = np.argpartition(-score[part], width - 1, axis=1)[:, :width]
        links[part] = _diverse(points, part, near, score[part[:, None], near], keep)
    while done < n:
        batch = np.arange(done, min(n, done + max(64, min(512, done // 4))))
        entry = np.tile(np.linspace(0, done - 1, 8).astype(np.int64), (len(batch), 1))
        near, score = _beam(points[:done], links[:done], points[batch], entry, beam)
        own = points[batch] @ points[batch].T
        np.fill_diagonal(own, -np.inf)
        width = min(len(batch), keep)
        side = np.argpartition(-own, width - 1, axis=1)[:, :width]
        near = np.concatenate([np.where(near < done, near, -1), batch[side]], axis=1)
        score = np.concatenate([score, own[np.arange(len(batch))[:, None], side]], axis=1)
        best = np.argpartition(-score, beam - 1, axis=1)[:, :beam]
        across = np.arange(len(batch))[:, None]
        found = _diverse(points, batch, near[across, best], score[across, best], keep)
        links[batch] = found
        _link_back(points, links, batch, found, keep)
        done = int(batch[-1]) + 1
    return links.astype(np.int32)


def _scaled(vectors: np.ndarray, axis: int | None) -> np.ndarray:
    """Vectors, or each row, divided by their largest component: squares then neither overflow nor vanish."""
    return vectors / np.abs(vectors).max(axis=axis, keepdims=True) if vectors.size else vectors


def build(vectors: np.ndarray, keep: int = NEIGHBOURS, beam: int = BUILD_BEAM, seed: int = 11) -> Graph:
    """The graph of a shard; heights follow the usual geometric law with base `keep`."""
    vectors = _scaled(vectors.astype(np.float64), None)
    square = (vectors**2).sum(axis=1)
    lift = np.sqrt(np.maximum(square.max() - square, 0))
    points = np.concatenate([vectors, lift[:, None]], axis=1).astype(np.float32)
    scale = math.sqrt(float(square.max()))
    points /= scale if scale > 0 else 1
    rng = np.random.default_rng(seed)
    height = np.floor(-np.log(rng.random(len(points))) / math.log(keep)).astype(int)
    levels, members = [], []
    for level in range(int(height.max()) + 1):
        own = np.flatnonzero(height >= level)
        if level and len(own) < 2 * keep:
            break
        levels.append(_level(points[own], 2 * keep if level == 0 else keep, beam))
        members.append(own.astype(np.int32))
    return Graph(points, levels, members)


def search(graph: Graph, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, scores) of the `beam` best nodes found for each query, best first."""
    points = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
    top = graph.members[-1]
    entry = np.tile(np.unique(np.linspace(0, len(top) - 1, 8).astype(np.int64)), (len(points), 1))
    for level in range(len(graph.levels) - 1, 0, -1):
        own = graph.members[level]
        near, _ = _beam(graph.points[own], graph.levels[level], points, entry, 8)
        near = np.where(near < len(own), near, near[:, :1])
        entry = np.searchsorted(graph.members[level - 1], own[near])
    return _beam(graph.points, graph.levels[0], points, entry, min(beam, max(len(graph.points), 1)))


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, vector) of rows with an id and a vector that is not null, empty, zero or not finite."""
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    nonzero = F.exists("vector", lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite & nonzero, F.lit(False)))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1)


def index(rows: DataFrame, shards: int, copies: int) -> DataFrame:
    """(shard, dim, ids, starts, vectors, graph): the graph of each shard and what its nodes are.

    A node is a distinct vector. Of the ids that share it the `copies` smallest are listed: no
    other can be in a result, and a vector that a third of all rows share is one node.
    """
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    listed = rows.distinct().withColumn("place", place).where(F.col("place") <= copies)
    dealt = listed.select(
        F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"),
        F.size("vector").alias("dim"),
        "vec_id",
        "place",
        "vector",
    ).repartition(shards, "shard", "dim")

    def run(group: pa.Table) -> pa.Table:
        vectors = _matrix(group.column("vector"))
        ids = group.column("vec_id").to_numpy()
        keys = np.ascontiguousarray(vectors + 0.0).view(f"V{8 * vectors.shape[1]}").ravel()
        _, node = np.unique(keys, return_inverse=True)
        order = np.lexsort((ids, node))
        starts = np.concatenate([[0], np.cumsum(np.bincount(node))])
        nodes = vectors[order[starts[:-1]]]
        # Insertion order must not follow the bytes of the vectors.
        shuffle = np.random.default_rng(5).permutation(len(nodes))
        counts = np.diff(starts)[shuffle]
        ids = np.concatenate([ids[order[starts[i] : starts[i + 1]]] for i in shuffle])
        nodes = nodes[shuffle]
        return pa.table(
            {
                "shard": group.column("shard")[:1],
                "dim": group.column("dim")[:1],
                "ids": pa.array([ids], pa.list_(pa.int64())),
                "starts": pa.array([np.concatenate([[0], np.cumsum(counts)])], pa.list_(pa.int64())),
                "vectors": pa.array([nodes.tobytes()], pa.binary()),
                "graph": pa.array([build(nodes).dump()], pa.binary()),
            }
        )

    schema = "shard int, dim int, ids array<long>, starts array<long>, vectors binary, graph binary"
    return dealt.groupBy("shard", "dim").applyInArrow(run, schema)


def _searched(held: pa.Table, asked: pa.Table, k: int, beam: int) -> pa.Table:
    """The k nearest rows of one shard for some queries, by inner products in double precision."""
    out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
    if len(held) and len(asked):
        graph = Graph.load(held.column("graph")[0].as_py())
        dim = held.column("dim")[0].as_py()
        vectors = np.frombuffer(held.column("vectors")[0].as_py(), dtype=np.float64).reshape(-1, dim)
        ids = np.asarray(held.column("ids")[0].values)
        starts = np.asarray(held.column("starts")[0].values)
        query_ids, queries = asked.column("query_id").to_numpy(), _matrix(asked.column("vector"))
        for first in range(0, len(queries), QUERY_BLOCK):
            block = queries[first : first + QUERY_BLOCK]
            unit = _scaled(block, 1)
            unit = unit / np.sqrt((unit**2).sum(axis=1, keepdims=True))
            nodes, _ = search(graph, unit, beam)
            for query_id, query, found in zip(query_ids[first:], block, nodes, strict=False):
                found = found[found < len(vectors)]
                score = vectors[found] @ query
                many = starts[found + 1] - starts[found]
                near = np.concatenate([ids[:0], *(ids[starts[i] : starts[i + 1]] for i in found)])
                score = np.repeat(score, many)
                other = near != query_id
                near, score = near[other], score[other]
                best = np.lexsort((near, -score))[:k]
                out["query_id"].append(np.full(len(best), query_id))
                out["vec_id"].append(near[best])
                out["score"].append(score[best])
    joined = {c: np.concatenate(v) if v else [] for c, v in out.items()}
    return pa.table(
        {
            "query_id": pa.array(joined["query_id"], pa.int64()),
            "vec_id": pa.array(joined["vec_id"], pa.int64()),
            "score": pa.array(joined["score"], pa.float64()),
        }
    )


def nearest(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    beam: int = SEARCH_BEAM,
    shards: int = SHARDS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the k rows of largest inner product found.

    `is_query` is a condition on the column vec_id. Ranks start at 1 and ties go to the smaller id; the query's own id is
    never a result. Vectors that are null, empty, zero or hold null or non-finite components take
    no part, nor do rows without an id; vectors of different length never meet. Repeated rows count
    once. An empty table gives no rows. Other columns are ignored. The number of shards grows
    with the rows beyond shards * shard_rows.
    """
    rows = written(usable(vectors, vec_id, embedding), "vectors")
    shards = max(shards, -(-rows.count() // shard_rows))
    held = written(index(rows, shards, k + 1), "graphs")
    queries = rows.where(is_query).distinct()
    chunks = max(1, -(-queries.count() // QUERY_CHUNK))
    asked = queries.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.size("vector").alias("dim"),
        F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"),
        F.col("vec_id").alias("query_id"),
        "vector",
    )
    spread = held.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    keys, tasks = ["shard", "dim", "chunk"], shards * chunks
    found = (
        spread.repartition(tasks, *keys)
        .groupBy(*keys)
        .cogroup(asked.repartition(tasks, *keys).groupBy(*keys))
        .applyInArrow(lambda a, b: _searched(a, b, k, beam), "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
