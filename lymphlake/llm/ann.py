"""Approximate nearest neighbours by a robust-pruned directed graph per shard."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lymphlake.plans.tables import written

#: Vectors a shard at most, and shards at least, as far as each has FEW vectors; edges a node; width of the search beam; slack of the pruning rule.
SHARD_ROWS, LEAST_SHARDS, FEW = 32_768, 12, 4096
DEGREE, BEAM, ALPHA = 24, 64, 1.2
#: Queries that are searched side by side, and a query block's rows.
TOGETHER, PRUNED_TOGETHER = 256, 128
#: Entry nodes of a shard.
ENTRIES = 256
INDEX_COLUMNS = ("ids", "vectors", "owners", "edges", "entries")
INDEX_SCHEMA = "shard int, ids binary, vectors binary, owners binary, edges binary, entries binary"
HIT_SCHEMA = "query_id long, vec_id long, score double"


def _usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``vec_id, v``: vectors without null, NaN or infinite components, and not all zero, null ids aside."""
    v = F.col(vector_column).cast("array<double>")
    fine = F.col(vector_column).isNotNull() & (F.size(vector_column) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.where(F.col(id_column).isNotNull() & fine).select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v"))


def shard_count(n: int, shard_rows: int = SHARD_ROWS) -> int:
    """Shards of at most ``shard_rows`` vectors, and enough of them for a small table to keep several tasks busy."""
    return max(1, -(-n // shard_rows), min(LEAST_SHARDS, -(-n // min(FEW, shard_rows))))


def _beam(points: np.ndarray, norms: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of many queries at once: nodes and squared distances, nearest first, -1 where none.

    The beam starts with the nearest of the entry nodes, at most half full, so
    that one dense cluster does not hold the whole search. Each round every
    live query expands the nearest node of its beam that it has not expanded;
    new neighbours enter the beam by distance.
    """
    n = len(queries)
    row = np.arange(n)
    seen = np.zeros((n, len(points)), bool)
    nodes = np.full((n, beam), -1, np.int32)
    far = np.full((n, beam), np.inf, np.float32)
    far_entries = norms[entries] - 2 * (queries @ points[entries].T)
    first = min(len(entries), max(1, beam // 2))
    pick = np.argpartition(far_entries, first - 1, axis=1)[:, :first]
    nodes[:, :first] = entries[pick]
    far[:, :first] = np.take_along_axis(far_entries, pick, 1)
    open_ = np.zeros((n, beam), bool)
    open_[:, :first] = True
    seen[row[:, None], nodes[:, :first]] = True
    live = row
    while len(live):
        best = np.where(open_[live], far[live], np.inf).argmin(axis=1)
        open_[live, best] = False
        near = edges[nodes[live, best]]
        fresh = (near >= 0) & ~seen[live[:, None], near]
        seen[live[:, None], np.where(fresh, near, nodes[live, best][:, None])] = True
        d = norms[near] - 2 * np.matmul(points[near], queries[live][:, :, None])[:, :, 0]
        d[~fresh] = np.inf
        all_d = np.concatenate([far[live], d], axis=1)
        pick = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        far[live] = np.take_along_axis(all_d, pick, 1)
        nodes[live] = np.take_along_axis(np.concatenate([nodes[live], near], axis=1), pick, 1)
        open_[live] = np.take_along_axis(np.concatenate([open_[live], fresh], axis=1), pick, 1)
        open_[live] &= np.isfinite(far[live])
        live = live[open_[live].any(axis=1)]
    order = np.argsort(far, axis=1, kind="stable")
    far = np.take_along_axis(far, order, 1)
    return np.where(np.isfinite(far), np.take_along_axis(nodes, order, 1), -1), far


def _robust_prune(points: np.ndarray, own: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours for each node of ``own``.

    The nearest candidate is kept; every other that is ``alpha`` times nearer
    to it than to the node goes; and again with the nearest of the rest.
    """
    out = np.full((len(own), degree), -1, np.int32)
    by = np.argsort((candidates >= 0).sum(axis=1), kind="stable")  # rows of like width together
    for start in range(0, len(own), PRUNED_TOGETHER):
        rows = by[start : start + PRUNED_TOGETHER]
        some = np.sort(candidates[rows], axis=1)[:, ::-1]  # absent ones, -1, move to the end
        some = some[:, : max(1, int((some >= 0).sum(axis=1).max()))]
        there = points[np.maximum(some, 0)]
        length = (there * there).sum(axis=2)
        home = points[own[rows]]
        d = length + (home * home).sum(axis=1)[:, None] - 2 * np.matmul(there, home[:, :, None])[:, :, 0]
        between = length[:, :, None] + length[:, None, :] - 2 * np.matmul(there, there.transpose(0, 2, 1))
        d[(some < 0) | (some == own[rows][:, None])] = np.inf
        d[:, 1:][some[:, 1:] == some[:, :-1]] = np.inf  # listed twice
        left, row = d.copy(), np.arange(len(rows))
        for k in range(degree):
            best = left.argmin(axis=1)
            ok = np.isfinite(left[row, best])
            if not ok.any():
                break
            out[rows[ok], k] = some[row[ok], best[ok]]
            left[(alpha * alpha * between[row, best] <= d) & ok[:, None]] = np.inf
            left[row, best] = np.inf
    return out


def build_graph(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Edges (nodes x degree, -1 where none) and the entry nodes: the one nearest the mean and the first random ones.

    Nodes enter in random order, in batches of growing size. A batch searches
    the graph of those before it; the beam and the other members of the batch
    that are near are proposed as neighbours and pruned; the reverse edges are
    added, and where they overflow, pruned again.
    """
    n = len(points)
    norms = (points * points).sum(axis=1)
    entry = int((norms - 2 * (points @ points.mean(axis=0))).argmin())
    edges = np.full((n, degree), -1, np.int32)
    order = np.random.default_rng(seed).permutation(n).astype(np.int32)
    order = np.concatenate([[entry], order[order != entry]]).astype(np.int32)
    start = 1
    while start < n:
        new = order[start : start + min(max(8, start), TOGETHER)]
        nodes, _ = _beam(points, norms, edges, order[: min(start, ENTRIES)], points[new], beam)
        mates = norms[new] - 2 * (points[new] @ points[new].T)
        mates = new[np.argsort(mates, axis=1)[:, : degree // 2 + 1]]
        edges[new] = _robust_prune(points, new, np.concatenate([nodes, mates], axis=1), degree, alpha)
        source = np.repeat(new, degree)
        target = edges[new].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        touched, first, count = np.unique(target, return_index=True, return_counts=True)
        wide = np.full((len(touched), degree + int(count.max(initial=0))), -1, np.int32)
        wide[:, :degree] = edges[touched]
        wide[np.repeat(np.arange(len(touched)), count), degree + np.arange(len(target)) - np.repeat(first, count)] = source
        fits = (wide >= 0).sum(axis=1) <= degree
        if fits.any():
            wide_fit = wide[fits]
            left = np.argsort(wide_fit < 0, axis=1, kind="stable")[:, :degree]
            edges[touched[fits]] = np.take_along_axis(wide_fit, left, 1)
        if (~fits).any():
            edges[touched[~fits]] = _robust_prune(points, touched[~fits], wide[~fits], degree, alpha)
        start += len(new)
    return edges, order[:ENTRIES].copy()


def build_index(vectors: DataFrame, id_column: str, vector_column: str, shard_rows: int = SHARD_ROWS, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> DataFrame:
    """One row a shard, written to the shared folder: ids, vectors, graph.

    Every usable row of the commonest length (of equally common ones the
    longest) is indexed; vectors of another length take no part. Ids are
    hashed to shards of at most about ``shard_rows``, so equal vectors spread
    evenly and a shard always fits a task. Rows that repeat id and vector
    count once; equal vectors of a shard are one node with several ids. For
    the inner product each vector gets one more component that brings all to
    the same length, so that nearest by distance is largest by product.
    """
    rows = _usable(vectors, id_column, vector_column)
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    per_width = rows.groupBy(F.size("v").alias("width")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("longest"))
    width, n, longest = per_width.orderBy(F.desc("n"), F.desc("width")).first() or (0, 0, 0.0)
    shards = shard_count(n, shard_rows)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        v = table.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        nodes, owners = np.unique(v, axis=0, return_inverse=True)
        listed = np.unique(np.stack([owners.ravel(), ids], axis=1), axis=0)  # by node, then id
        extra = np.sqrt(np.maximum(longest - (nodes * nodes).sum(axis=1), 0.0))
        points = np.concatenate([nodes, extra[:, None]], axis=1).astype(np.float32)
        edges, entries = build_graph(points, degree, beam, alpha)
        values = [key[0].as_py(), listed[:, 1].tobytes(), nodes.tobytes(), listed[:, 0].astype(np.int32).tobytes(), edges.tobytes(), entries.tobytes()]
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
        return pa.table({name: pa.array([x], t) for name, x, t in zip(("shard", "ids", "vectors", "owners", "edges", "entries"), values, kinds, strict=True)})

    dealt = rows.where(F.size("v") == width).withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return written(dealt.groupBy("shard").applyInArrow(run, INDEX_SCHEMA), "graph-index")


def search(index: DataFrame, queries: DataFrame, id_column: str, vector_column: str, k: int = 20, beam: int = BEAM, degree: int = DEGREE, block: int = 1024) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found for each query, its own id left out.

    Queries are packed into blocks. A shard's task reads its index once and
    then the blocks one after the other, so an index moves once, whatever the
    number of queries. A beam search per shard proposes nodes, all ids of a
    node count, and scores are exact products in double precision, added up
    component by component. Ties go to the smaller id.

    A result lists a ``vec_id`` once, at its best score, also if the index
    holds several vectors of it. A query id with several vectors is searched
    with each, and the best of its scores counts. Queries of another length
    than the index have no result.
    """
    rows = _usable(queries, id_column, vector_column).dropDuplicates()
    shape = index.agg(F.max("shard"), F.max(F.octet_length("vectors") / F.greatest(F.lit(1), F.octet_length("edges") / (4 * degree)))).first()
    shards, width = (shape[0] or 0) + 1, int((shape[1] or 0) // 8)
    rows = rows.where(F.size("v") == width)
    blocks = max(1, -(-rows.count() // block))

    def pack(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        v = table.column("v").combine_chunks().flatten().to_numpy()
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "query_ids": pa.array([table.column("vec_id").to_numpy().tobytes()], pa.binary()), "query_vectors": pa.array([v.tobytes()], pa.binary())})

    packed = written(rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).groupBy("block").applyInArrow(pack, "block int, query_ids binary, query_vectors binary"), "graph-queries")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            for row in range(batch.num_rows):
                cell = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                if cell["block"] < 0:
                    shard = _Shard(cell, degree)
                elif shard is not None and shard.number == cell["shard"]:
                    yield shard.search(cell["query_ids"], cell["query_vectors"], k, beam)

    # every block goes to every shard, stated work of a search; a shard's index sorts before its blocks
    none = F.lit(None).cast("binary")
    work = packed.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "block", "query_ids", "query_vectors", *[none.alias(c) for c in INDEX_COLUMNS])
    work = index.select("shard", F.lit(-1).alias("block"), none.alias("query_ids"), none.alias("query_vectors"), *INDEX_COLUMNS).unionByName(work)
    hits = work.repartition(shards, "shard").sortWithinPartitions("shard", "block").mapInArrow(run, HIT_SCHEMA)
    best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.col("vec_id")))
    return best.select("query_id", rank.cast("int").alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


class _Shard:
    """One shard's arrays, ready to search; ids are listed by node, and ascend within one."""

    def __init__(self, cell: dict, degree: int):
        self.number = cell["shard"]
        self.ids, owners = np.frombuffer(cell["ids"], np.int64), np.frombuffer(cell["owners"], np.int32)
        self.edges, self.entries = np.frombuffer(cell["edges"], np.int32).reshape(-1, degree), np.frombuffer(cell["entries"], np.int32)
        self.nodes = np.frombuffer(cell["vectors"], np.float64).reshape(len(self.edges), -1)
        self.counts = np.bincount(owners, minlength=len(self.edges))
        length = (self.nodes * self.nodes).sum(axis=1)
        self.points = np.concatenate([self.nodes, np.sqrt(np.maximum(length.max() - length, 0))[:, None]], axis=1).astype(np.float32)
        self.norms = (self.points * self.points).sum(axis=1)

    def search(self, ids: bytes, vectors: bytes, k: int, beam: int) -> pa.RecordBatch:
        """The ``k`` best ids of the shard for each query of a block."""
        query_ids = np.frombuffer(ids, np.int64)
        q = np.frombuffer(vectors, np.float64).reshape(len(query_ids), -1)
        ends = np.cumsum(self.counts)
        out: list[tuple[np.ndarray, ...]] = []
        for start in range(0, len(q), TOGETHER):
            some = q[start : start + TOGETHER]
            wide = np.concatenate([some, np.zeros((len(some), 1))], axis=1).astype(np.float32)
            found, _ = _beam(self.points, self.norms, self.edges, self.entries, wide, beam)
            which, place = np.nonzero(found >= 0)
            node = found[which, place]
            score = np.zeros(len(node))
            for c in range(q.shape[1]):
                score += some[which, c] * self.nodes[node, c]
            # of a node's ids, at most k + 1 can be among the k nearest besides the query's own
            many = np.minimum(self.counts[node], k + 1)
            at = np.repeat(ends[node] - self.counts[node], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            which, near, score = np.repeat(which, many), self.ids[at], np.repeat(score, many)
            other = near != query_ids[start + which]
            which, near, score = which[other], near[other], score[other]
            # an id of several vectors counts with the best one
            order = np.lexsort((-score, near, which))
            which, near, score = which[order], near[order], score[order]
            once = np.concatenate([[True], (which[1:] != which[:-1]) | (near[1:] != near[:-1])])[: len(which)]
            which, near, score = which[once], near[once], score[once]
            order = np.lexsort((near, -score, which))
            which, near, score = which[order], near[order], score[order]
            keep = np.arange(len(which)) - np.searchsorted(which, which) < k
            out.append((query_ids[start + which[keep]], near[keep], score[keep]))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, id_column: str, vector_column: str, every: int = 20, k: int = 20) -> DataFrame:
    """Index all rows and search for those whose id is divisible by ``every``.

    Vectors that are null, empty, zero or hold a null or non-finite component
    take no part, neither as query nor as candidate; nor do rows without id.
    Vectors of another length than the commonest one take no part either.
    Fewer than ``k`` candidates: all of them. An empty table gives no row.
    Repeated rows count once; candidates are ids, so a result lists an id once.
    """
    index = build_index(vectors, id_column, vector_column)
    return search(index, vectors.where(F.col(id_column) % every == 0), id_column, vector_column, k)
