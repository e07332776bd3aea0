"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

A shard's graph grows in batches: a greedy beam search over the graph so far proposes neighbours for each new vector, and
pruning keeps the nearest proposal, drops what is nearer to it than to the vector by the factor ``relax``, and goes on with
the rest, so that edges point in diverse directions. Edges are added backwards too, and full nodes are pruned again. A query is
answered by a beam search in every shard's graph and a merge of what they found.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoardline.llm.common import list_parts
from hoardline.llm.subspaces import comparable
from hoardline.session import cut_lineage


@dataclass(frozen=True)
class Settings:
    shard_rows: int = 8_192  # different vectors in a shard, on average
    degree: int = 24  # edges kept by pruning; a node is pruned again when it has a third more
    build_beam: int = 48
    query_beam: int = 160
    relax: float = 1.2
    passes: int = 2
    batch: int = 512
    width: int = 4  # nodes that a search expands at a time
    entries: int = 16
    query_rows: int = 2_048  # queries searched together
    seed: int = 7


class Graph:
    """Edges over unit vectors ``x``; ``edges`` is padded with -1."""

    def __init__(self, x: np.ndarray, s: Settings, edges: np.ndarray | None = None, entries: np.ndarray | None = None):
        self.x, self.s = x, s
        self.room = s.degree + s.degree // 3
        if edges is not None:
            self.edges, self.entries = edges, entries
            return
        n = len(x)
        rng = np.random.default_rng(s.seed)
        middle = int(np.argmax(x @ x.mean(0)))
        some = rng.choice(n, min(n, s.entries), replace=False)
        self.entries = np.unique(np.append(some, middle)).astype(np.int32)
        self.edges = np.full((n, self.room), -1, np.int32)
        order = rng.permutation(n)
        seeds = order[: min(n, 2 * s.degree)]  # the first few are joined with one another
        self._keep(seeds, np.broadcast_to(seeds, (len(seeds), len(seeds))), 1.0)
        ready = len(seeds)
        # Until the first pass is over, only vectors that are in the graph can be reached; entries are those among them.
        inside = np.zeros(n, bool)
        inside[seeds] = True
        while ready < n:
            rows = order[ready : ready + max(32, min(s.batch, ready))]
            self._insert(rows, self._open(inside, seeds), 1.0 if s.passes > 1 else s.relax)
            inside[rows] = True
            ready += len(rows)
        for _ in range(s.passes - 1):
            for a in range(0, n, s.batch):
                self._insert(order[a : a + s.batch], self.entries, s.relax)

    def _open(self, inside: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        return np.unique(np.append(self.entries[inside[self.entries]], seeds[:8])).astype(np.int32)

    def search(self, q: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` most similar nodes that a greedy search meets per query, best first, and their similarities; -1 pads."""
        n, count, w = len(self.x), len(q), self.s.width
        beam = min(beam, n)
        seen = np.zeros((count, n), bool)
        seen[:, entries] = True
        ids = np.full((count, max(beam, len(entries))), -1, np.int32)
        near = np.full(ids.shape, -np.inf, np.float32)
        ids[:, : len(entries)] = entries
        near[:, : len(entries)] = q @ self.x[entries].T
        done = ids < 0
        active = np.arange(count)
        while len(active):
            order = np.argsort(-near[active], axis=1, kind="stable")[:, :beam]
            ids_a, near_a, done_a = (np.take_along_axis(v[active], order, 1) for v in (ids, near, done))
            waiting = np.cumsum(~done_a, axis=1)
            pick = ~done_a & (waiting <= w)
            row, _ = np.nonzero(pick)
            node = ids_a[pick]
            done_a |= pick
            new = self.edges[node]
            row = np.repeat(row, new.shape[1])
            new = new.ravel()
            fine = new >= 0
            row, new = row[fine], new[fine]
            fresh = ~seen[active[row], new]
            key = np.unique(row[fresh].astype(np.int64) * n + new[fresh])
            row, new = key // n, key % n
            seen[active[row], new] = True
            value = np.einsum("ij,ij->i", q[active[row]], self.x[new])
            each = np.bincount(row, minlength=len(active))
            wide = int(each.max()) if len(each) else 0
            more_ids = np.full((len(active), wide), -1, np.int32)
            more_near = np.full((len(active), wide), -np.inf, np.float32)
            place = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
            more_ids[row, place], more_near[row, place] = new, value
            all_ids, all_near = np.concatenate([ids_a, more_ids], 1), np.concatenate([near_a, more_near], 1)
            all_done = np.concatenate([done_a, more_ids < 0], 1)
            if all_near.shape[1] > beam:
                top = np.argpartition(-all_near, beam - 1, axis=1)[:, :beam]
                all_ids, all_near, all_done = (np.take_along_axis(v, top, 1) for v in (all_ids, all_near, all_done))
            if ids.shape[1] != all_ids.shape[1]:
                ids, near, done = ids[:, : all_ids.shape[1]], near[:, : all_ids.shape[1]], done[:, : all_ids.shape[1]]
            ids[active], near[active], done[active] = all_ids, all_near, all_done
            active = active[~all_done.all(1)]
        order = np.argsort(-near, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)

    def _insert(self, rows: np.ndarray, entries: np.ndarray, relax: float) -> None:
        found, _ = self.search(self.x[rows], entries, self.s.build_beam)
        self._keep(rows, np.concatenate([found, self.edges[rows]], 1), relax)
        target = self.edges[rows].ravel()
        source = np.repeat(rows, self.room)
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        known = (self.edges[target] == source[:, None]).any(1)
        source, target = source[~known], target[~known]
        if not len(target):
            return
        nodes, first, each = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, each)
        have = (self.edges[nodes] >= 0).sum(1)
        fits = have + each <= self.room
        simple = np.repeat(fits, each)
        self.edges[target[simple], np.repeat(have, each)[simple] + place[simple]] = source[simple]
        full = np.flatnonzero(~fits)
        full = full[np.argsort(each[full], kind="stable")]  # alike in size, so that little is padded
        owner = np.full(len(nodes), -1)
        for a in range(0, len(full), 512):
            part = full[a : a + 512]
            owner[part] = np.arange(len(part))
            offered = np.full((len(part), int(each[part].max())), -1, np.int64)
            mine = np.repeat(owner, each) >= 0
            offered[np.repeat(owner, each)[mine], place[mine]] = source[mine]
            self._keep(nodes[part], np.concatenate([self.edges[nodes[part]], offered], 1), relax)
            owner[part] = -1

    def _keep(self, rows: np.ndarray, candidates: np.ndarray, relax: float) -> None:
        """Sets the edges of ``rows`` to the robust-pruned ``candidates`` (-1 pads)."""
        step = max(1, (1 << 22) // max(1, candidates.shape[1] ** 2))
        for a in range(0, len(rows), step):
            self._keep_some(rows[a : a + step], candidates[a : a + step].astype(np.int64), relax)

    def _keep_some(self, rows: np.ndarray, c: np.ndarray, relax: float) -> None:
        c = np.sort(c, axis=1)
        valid = (c >= 0) & (c != rows[:, None])
        valid[:, 1:] &= c[:, 1:] != c[:, :-1]
        v = self.x[np.maximum(c, 0)]
        own = np.sqrt(np.maximum(2 - 2 * np.einsum("rcd,rd->rc", v, self.x[rows]), 0))
        own[~valid] = np.inf
        between = np.sqrt(np.maximum(2 - 2 * (v @ v.transpose(0, 2, 1)), 0)) * np.float32(relax)
        kept = np.full((len(rows), self.room), -1, np.int32)
        line = np.arange(len(rows))
        distance = own.copy()
        for k in range(min(self.s.degree, c.shape[1])):
            best = np.argmin(distance, axis=1)
            alive = np.isfinite(distance[line, best])
            if not alive.any():
                break
            kept[alive, k] = c[line[alive], best[alive]]
            distance[between[line, best] <= own] = np.inf
            distance[line, best] = np.inf
        self.edges[rows] = kept


def unit_rows(x: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


INDEX_SCHEMA = "shard int, size int, members array<array<long>>, vectors array<double>, edges array<int>, entries array<int>"


def build(vectors: DataFrame, k: int, settings: Settings | None = None, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """The stored index: a row per shard and vector length with its vectors, its graph and, per vector, the ``k + 1`` smallest ids that
    have it. Every comparable vector is in it. Equal vectors are one node, found by rank within the vector, which Spark
    limits before it shuffles; shards follow a hash of the vector and hold about ``shard_rows`` nodes."""
    s = settings or Settings()
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    rows = rows.where(comparable(F.col("vector")) & F.col("vec_id").isNotNull()).withColumn("key", F.xxhash64("vector"))
    place = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    few = rows.withColumn("_at", place).where(F.col("_at") <= k + 1)
    nodes = few.groupBy("key").agg(F.array_sort(F.collect_list("vec_id")).alias("members"), F.first("vector").alias("vector"))
    nodes = cut_lineage(nodes.withColumn("vector", F.col("vector").cast("array<double>")).withColumn("size", F.size("vector")), "graph-nodes")
    shards = max(1, -(-nodes.count() // s.shard_rows))
    nodes = nodes.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))

    def one(key, table):
        shard, size = (v.as_py() for v in key)
        order = np.argsort(table.column("key").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        x = list_parts(table.column("vector").combine_chunks())[0].reshape(len(order), size)
        graph = Graph(unit_rows(x), s)
        return pa.table(
            {
                "shard": pa.array([shard], pa.int32()),
                "size": pa.array([size], pa.int32()),
                "members": pa.array([table.column("members").to_pylist()], pa.list_(pa.list_(pa.int64()))),
                "vectors": pa.array([x.ravel()], pa.list_(pa.float64())),
                "edges": pa.array([graph.edges.ravel()], pa.list_(pa.int32())),
                "entries": pa.array([graph.entries], pa.list_(pa.int32())),
            }
        )

    return cut_lineage(nodes.groupBy("shard", "size").applyInArrow(one, INDEX_SCHEMA), "graph-index")


def search(index: DataFrame, queries: DataFrame, k: int, settings: Settings | None = None, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best vectors found for each query, its own id left out.

    Blocks of queries meet every shard of their vector length; each meeting is one bounded job that returns at most ``k`` rows per query.
    The score is the cosine in double precision of the vectors as given, ties go to the smaller id. Queries that cannot be compared,
    or have no id, get no rows; a query given twice is answered once."""
    s = settings or Settings()
    asked = queries.select(F.col(id_column).cast("long").alias("query_id"), F.col(vector_column).cast("array<double>").alias("query"))
    asked = asked.where(comparable(F.col("query")) & F.col("query_id").isNotNull()).dropDuplicates(["query_id"])
    asked = cut_lineage(asked.withColumn("size", F.size("query")), "graph-queries")
    blocks = max(1, -(-asked.count() // s.query_rows))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int"))
    places = index.select(F.col("shard").alias("at_shard"), F.col("size").alias("at_size"))
    meetings = asked.join(places, F.col("size") == F.col("at_size")).drop("size")  # a row per query and shard
    jobs = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def one(key, left, right):
        empty = {"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())}
        if not left.num_rows or not right.num_rows:
            return pa.table(empty)
        size = left.column("size")[0].as_py()
        x = list_parts(left.column("vectors").combine_chunks())[0].reshape(-1, size)
        edges = list_parts(left.column("edges").combine_chunks())[0].reshape(len(x), -1)
        entries = list_parts(left.column("entries").combine_chunks())[0]
        members = left.column("members")[0].as_py()
        q = list_parts(right.column("query").combine_chunks())[0].reshape(right.num_rows, size)
        ids = right.column("query_id").to_pylist()
        graph = Graph(unit_rows(x), s, edges, entries)
        norms = np.linalg.norm(x, axis=1)
        out = ([], [], [])
        for a in range(0, len(q), s.batch):
            part = q[a : a + s.batch]
            found, _ = graph.search(unit_rows(part), entries, s.query_beam)
            found = found[:, : 2 * k + 2]
            for i in range(len(part)):
                near = found[i][found[i] >= 0]
                scores = (x[near] * part[i]).sum(1) / (norms[near] * np.linalg.norm(part[i]))
                own = ids[a + i]
                best = sorted((-v, m) for v, node in zip(scores.tolist(), near.tolist(), strict=True) for m in members[node] if m != own)[:k]
                out[0].extend([own] * len(best))
                out[1].extend(m for _, m in best)
                out[2].extend(-v for v, _ in best)
        return pa.table({"query_id": pa.array(out[0], pa.int64()), "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    met = meetings.groupBy("at_size", "at_shard", "block")
    found = jobs.groupBy("size", "shard", "block").cogroup(met).applyInArrow(one, "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, settings: Settings | None = None, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``search`` of ``queries`` in an index over ``vectors``. Other columns are ignored; an empty table gives no rows; vectors
    that are null, empty or zero, or hold null or non-finite components, take no part."""
    return search(build(vectors, k, settings, id_column, vector_column), queries, k, settings, id_column, vector_column)
