"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Nodes are added in growing batches: a greedy beam search of the graph so far proposes neighbours, a
relaxed distance rule keeps the diverse ones, and edges back are pruned the same way. Queries run a
beam search in every shard; what the shards find is merged. Inner products become distances
by one more coordinate; reported scores are inner products of the original vectors in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import bounded_batches, stored

SHARD_ROWS = 4096
DEGREE, BEAM, RELAXED = 32, 64, 1.2
SEARCH_BEAM = 96
BATCH, EXPANDED = 256, 4
QUERY_BLOCK = 20_000


def beam_search(x: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and squared distances of the ``beam`` nearest nodes met, nearest first; -1 fills up.

    Each step expands the nearest unexpanded nodes of every query's beam until none is left.
    """
    n, b = len(x), len(queries)
    norms, own = (x * x).sum(axis=1), (queries * queries).sum(axis=1)
    ids = np.full((b, beam), -1, dtype=np.int64)
    far = np.full((b, beam), np.inf, dtype=np.float32)
    ids[:, 0] = entry
    far[:, 0] = norms[entry] + own - 2 * queries @ x[entry]
    expanded = np.zeros((b, beam), dtype=bool)
    met = np.zeros((b, n), dtype=bool)
    met[:, entry] = True
    rows = np.arange(b)
    while len(rows):
        open_ = ~expanded[rows] & (ids[rows] >= 0)
        wanted = open_ & (np.cumsum(open_, axis=1) <= EXPANDED)
        going = wanted.any(axis=1)
        rows, wanted = rows[going], wanted[going]
        if not len(rows):
            break
        r, c = np.nonzero(wanted)
        expanded[rows[r], c] = True
        near = edges[ids[rows[r], c]]
        at, node = np.repeat(rows[r], near.shape[1]), near.ravel()
        fresh = node >= 0
        at, node = at[fresh], node[fresh]
        fresh = ~met[at, node]
        key = np.unique(at[fresh] * n + node[fresh])
        at, node = key // n, key % n
        met[at, node] = True
        distance = norms[node] + own[at] - 2 * np.einsum("ij,ij->i", x[node], queries[at])
        # Lay the new nodes of each query out in a row of their own.
        counts = np.bincount(at, minlength=b)[rows]
        width = int(counts.max(initial=0))
        if width:
            offset = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
            slot = np.searchsorted(rows, at)
            new_ids = np.full((len(rows), width), -1, dtype=np.int64)
            new_far = np.full((len(rows), width), np.inf, dtype=np.float32)
            new_ids[slot, offset], new_far[slot, offset] = node, distance
            all_ids = np.concatenate([ids[rows], new_ids], axis=1)
            all_far = np.concatenate([far[rows], new_far], axis=1)
            all_done = np.concatenate([expanded[rows], np.zeros(new_ids.shape, dtype=bool)], axis=1)
            order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            ids[rows] = np.take_along_axis(all_ids, order, axis=1)
            far[rows] = np.take_along_axis(all_far, order, axis=1)
            expanded[rows] = np.take_along_axis(all_done, order, axis=1)
    return ids, far


def robust_prune(x: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, relaxed: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours of each node out of its row of candidates (-1: none).

    The nearest candidate left is kept and removes those that are nearer to it, by the relaxed
    measure, than to the node.
    """
    candidates = np.where(candidates == nodes[:, None], -1, candidates)
    order = np.argsort(candidates, axis=1, kind="stable")
    candidates = np.take_along_axis(candidates, order, axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    points = x[candidates]
    own = x[nodes]
    far = ((points - own[:, None, :]) ** 2).sum(axis=2)
    far[candidates < 0] = np.inf
    order = np.argsort(far, axis=1, kind="stable")
    candidates, far = np.take_along_axis(candidates, order, axis=1), np.take_along_axis(far, order, axis=1)
    points = np.take_along_axis(points, order[:, :, None], axis=1)
    norms = (points * points).sum(axis=2)
    between = norms[:, :, None] + norms[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
    alive = np.isfinite(far)
    kept = np.full((len(nodes), degree), -1, dtype=np.int64)
    rows = np.arange(len(nodes))
    for k in range(degree):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        kept[some, k] = candidates[rows, first][some]
        alive &= (relaxed * relaxed * between[rows, first] > far) | ~some[:, None]
        alive[rows, first] = False
    return kept


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relaxed: float = RELAXED) -> tuple[np.ndarray, int]:
    """Edges [node, degree] and the entry node, the one nearest to the mean."""
    n = len(x)
    edges = np.full((n, degree), -1, dtype=np.int64)
    entry = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.random.default_rng(7).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    at = 1
    while at < n:
        batch = order[at : at + min(at, BATCH)]
        at += len(batch)
        found, _ = beam_search(x, edges, entry, x[batch], beam)
        edges[batch] = robust_prune(x, batch, found, degree, relaxed)
        # Edges back, together for each target.
        source = np.repeat(batch, degree)
        target = edges[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        targets, first, counts = np.unique(target, return_index=True, return_counts=True)
        for k in range(0, len(targets), BATCH):
            own, size = targets[k : k + BATCH], counts[k : k + BATCH]
            new = np.full((len(own), int(size.max())), -1, dtype=np.int64)
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            begin = first[k]
            new[np.repeat(np.arange(len(own)), size), place] = source[begin : begin + size.sum()]
            merged = np.concatenate([edges[own], new], axis=1)
            room = (merged >= 0).sum(axis=1) <= degree
            if room.any():
                packed = np.argsort(merged[room] < 0, axis=1, kind="stable")[:, :degree]
                edges[own[room]] = np.take_along_axis(merged[room], packed, axis=1)
            if not room.all():
                edges[own[~room]] = robust_prune(x, own[~room], merged[~room], degree, relaxed)
    return edges, entry


def _lifted(vectors: np.ndarray) -> tuple[np.ndarray, float]:
    """Vectors with a coordinate that makes all norms equal, so that nearest means largest product."""
    norms = (vectors * vectors).sum(axis=1)
    most = float(norms.max(initial=0.0))
    return np.hstack([vectors, np.sqrt(np.maximum(most - norms, 0))[:, None]]).astype(np.float32), most


_ROWS = "dim int, shard int, block int, kind int, id bigint, vector array<double>, ids array<bigint>, edges array<int>"
_ARROW = pa.schema(
    [
        ("dim", pa.int32()), ("shard", pa.int32()), ("block", pa.int32()), ("kind", pa.int32()), ("id", pa.int64()),
        ("vector", pa.list_(pa.float64())), ("ids", pa.list_(pa.int64())), ("edges", pa.list_(pa.int32())),
    ]
)
_KEY = ("dim", "shard", "block", "kind")


def _runs(batches) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The stretches of equal key columns of each batch."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in _KEY], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
            yield tuple(keys[a].tolist()), batch.slice(a, b - a)


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _built(batches):
    """Graph of each shard; its rows come together and are bounded by the shard size."""
    key, held = None, []

    def done():
        rows = pa.Table.from_batches(held).combine_chunks()
        order = np.argsort(rows.column("id").to_numpy(), kind="stable")
        rows = rows.take(pa.array(order))
        x, _ = _lifted(_matrix(rows.column("vector").chunk(0)))
        edges, entry = build_graph(x)
        number = np.arange(len(x), dtype=np.int64)
        number[entry] = -1  # marks the entry; nodes are read back in this order
        at = np.argsort(number, kind="stable")
        place = np.empty_like(at)
        place[at] = np.arange(len(at))
        moved = np.where(edges[at] >= 0, place[edges[at]], -1).astype(np.int32)
        rows = rows.take(pa.array(at))
        rows = rows.set_column(rows.schema.get_field_index("id"), "id", pa.array(np.arange(len(at), dtype=np.int64)))
        rows = rows.set_column(rows.schema.get_field_index("edges"), "edges", pa.array(list(moved), pa.list_(pa.int32())))
        return rows.cast(_ARROW).to_batches(max_chunksize=1024)

    for own, part in _runs(batches):
        if own != key:
            if held:
                yield from done()
            key, held = own, []
        held.append(part)
    if held:
        yield from done()


def _searched(k: int, beam: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def task(batches):
        key, held, graph = None, [], None
        for own, part in _runs(batches):
            if own[3] == 0:
                if own != key:
                    key, held, graph = own, [], None
                held.append(part)
                continue
            if not held or own[:3] != key[:3]:
                continue  # a shard without vectors of this length
            if graph is None:
                rows = pa.Table.from_batches(held).combine_chunks()
                vectors = _matrix(rows.column("vector").chunk(0))
                x, _ = _lifted(vectors)
                edges = _matrix(rows.column("edges").chunk(0), np.int64)
                graph = vectors, x, edges, rows.column("ids").to_pylist()
            vectors, x, edges, ids = graph
            for a in range(0, part.num_rows, BATCH):
                piece = part.slice(a, BATCH)
                queries = _matrix(piece.column(piece.schema.get_field_index("vector")))
                lifted = np.hstack([queries, np.zeros((len(queries), 1))]).astype(np.float32)
                found, _ = beam_search(x, edges, 0, lifted, beam)
                out = [], [], []
                for q, vector, near in zip(piece.column(piece.schema.get_field_index("id")).to_pylist(), queries, found, strict=True):
                    near = near[near >= 0]
                    best = [
                        (-s, i) for s, node in zip((vectors[near] * vector).sum(axis=1).tolist(), near.tolist(), strict=True)
                        for i in ids[node] if i != q
                    ]
                    for s, i in sorted(best)[:k]:
                        out[0].append(q)
                        out[1].append(i)
                        out[2].append(-s)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return task


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, vector) of the vectors that take part: not null, finite throughout and not zero."""
    v = F.col("vector")
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & F.exists(v, lambda c: c != 0)
    return rows.where(F.col("id").isNotNull() & v.isNotNull()).where(fine)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    beam: int = SEARCH_BEAM,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products found for every query.

    Equal vectors are one node, which carries the k + 1 smallest ids of its copies: others can't be
    among k results. Nodes are dealt by a hash of the vector to shards of about ``shard_rows``, so copies
    do not gather anywhere. Ties go to the smaller id; a query's own id is never a result. Vectors that
    are null, zero or not finite take no part, and vectors of another length than the query's are no
    candidates. Rows repeated with their id count once. With no candidates a query has no row. The
    beam is at least twice ``k``.
    """
    spark = vectors.sparkSession
    beam = max(beam, 2 * k)
    bounded_batches(spark, 2048)
    rows = usable(vectors, id_column, vector_column)
    copies = Window.partitionBy("vector").orderBy("id")
    # dense_rank: a repeated row does not use up a place.
    smallest = rows.withColumn("place", F.dense_rank().over(copies)).where(F.col("place") <= k + 1)
    nodes = smallest.groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    nodes = stored(nodes, "graph-nodes")
    shards = max(1, math.ceil(nodes.count() / shard_rows))
    placed = nodes.select(
        F.size("vector").cast("int").alias("dim"),
        F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"),
        F.lit(0).alias("block"),
        F.lit(0).alias("kind"),
        F.element_at("ids", 1).alias("id"),
        "vector",
        "ids",
        F.lit(None).cast("array<int>").alias("edges"),
    )
    graphs = placed.repartition(shards, "dim", "shard").sortWithinPartitions("dim", "shard", "id").mapInArrow(_built, _ROWS)
    graphs = stored(graphs, "graphs")

    asked = stored(usable(queries, id_column, vector_column).dropDuplicates(["id"]), "graph-queries")
    blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    every_shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    asked = asked.select(
        F.size("vector").cast("int").alias("dim"),
        every_shard.alias("shard"),
        F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
        F.lit(1).alias("kind"),
        "id",
        "vector",
        F.lit(None).cast("array<bigint>").alias("ids"),
        F.lit(None).cast("array<int>").alias("edges"),
    )
    copies_of_graph = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(asked.columns)
    both = copies_of_graph.unionByName(asked).repartition(shards * blocks, "dim", "shard", "block")
    both = both.sortWithinPartitions("dim", "shard", "block", "kind", "id")
    found = both.mapInArrow(_searched(k, beam), "query_id bigint, vec_id bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
