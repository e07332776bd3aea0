"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine c are at squared distance 2 - 2c. After a rotation, which keeps distances and spreads them evenly, the
coordinates are split into blocks; two vectors within the budget are within its proportional part in at least one block.
Each block is joined by range: vectors fall into grid cells over the block's first coordinates and visit the neighbouring
cells that their range reaches. Inside a cell only pairs within the block's budget go on to the exact comparison, and a pair that
several blocks find belongs to the first of them, so nothing has to be emitted to be counted once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.llm.common import by_batch, list_parts
from hoardline.operators.components import connected_components
from hoardline.session import cut_lineage

THRESHOLD = 0.95
BLOCKS = 4
GRID = 2  # coordinates of a block that make its cells
CELL_ROWS = 16_384  # larger cells are cut into tiles of two parts of about this many rows
STRIP, PANEL = 256, 4_096  # rows and columns compared at a time
SLACK = 1e-5  # on squared distances in single precision, which only choose what is compared in double
EDGE = 1e-9  # on squared distances in double precision


def rotation(size: int, seed: int) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def comparable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """One row per different vector: its smallest id as ``rep``, ``copies`` and the vector. Null ids come last."""
    return rows.groupBy("vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))


def _cells(reps: DataFrame, size: int, blocks: int, threshold: float, seed: int) -> DataFrame:
    """``block, cell, home, rep, copies, vector``: a row for each cell of each block that a vector lives in or visits.

    A pair in neighbouring cells meets once: in the cell of the two that comes later, which the other one visits."""
    turn = rotation(size, seed)
    budget = 2 - 2 * threshold
    edges = np.linspace(0, size, blocks + 1).astype(int)

    def one(batch):
        values, _ = list_parts(batch.column("vector"))
        x = values.reshape(batch.num_rows, size).astype(np.float64)
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        turned = unit @ turn
        rows, block_no, cell_no, home = [], [], [], []
        for b in range(blocks):
            a, z = edges[b], edges[b + 1]
            reach = np.sqrt(budget * (z - a) / size) + SLACK
            width = 2 * reach
            grid = min(GRID, z - a)
            side = int(np.ceil(2.0 / width)) + 3
            at = (turned[:, a : a + grid] + 1.0) / width + 1.0
            own = np.floor(at).astype(np.int64)
            number = own @ (side ** np.arange(grid - 1, -1, -1))
            shifts = np.stack(np.meshgrid(*[[-1, 0, 1]] * grid, indexing="ij"), -1).reshape(-1, grid)
            for shift in shifts:
                # distance to the neighbouring cell along each shifted coordinate
                gap = np.where(shift == 1, own + 1 - at, np.where(shift == -1, at - own, 0.0)) * width
                other = (own + shift) @ (side ** np.arange(grid - 1, -1, -1))
                ok = ((gap**2).sum(1) <= reach**2) & (other >= number)
                hit = np.flatnonzero(ok)
                rows.append(hit)
                block_no.append(np.full(len(hit), b))
                cell_no.append(other[hit])
                home.append(np.full(len(hit), not shift.any()))
        take = np.concatenate(rows)
        order = np.argsort(take, kind="stable")
        take = take[order]
        parts = [np.concatenate(v)[order] for v in (block_no, cell_no, home)]
        return pa.RecordBatch.from_arrays(
            [pa.array(parts[0].astype(np.int32)), pa.array(parts[1]), pa.array(parts[2]), *(batch.column(c).take(pa.array(take)) for c in ("rep", "copies", "vector"))],
            ["block", "cell", "home", "rep", "copies", "vector"],
        )

    return reps.select("rep", "copies", "vector").mapInArrow(by_batch(one), f"block int, cell long, home boolean, rep long, copies long, vector {dict(reps.dtypes)['vector']}")


def _tiles(cells: DataFrame, cell_rows: int) -> DataFrame:
    """``cells`` with ``left_part`` and ``right_part``: a cell of n rows has parts of about ``cell_rows`` and a tile for every two of them,
    so that no task gets more than two parts, and every pair of rows of a cell is in one tile or, within a part, in its own."""
    counts = cells.groupBy("block", "cell").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.col("home").cast("long")).alias("_homes"))
    counts = counts.where("_n > 1 AND _homes > 0").select(F.col("block").alias("_b"), F.col("cell").alias("_c"), F.ceil(F.col("_n") / cell_rows).cast("int").alias("_parts"))
    rows = cells.join(counts, (F.col("block") == F.col("_b")) & (F.col("cell") == F.col("_c")))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("rep"), F.col("_parts").cast("long")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_other")
    return rows.select("*", other).select(
        "block", "cell", F.least("part", "_other").alias("left_part"), F.greatest("part", "_other").alias("right_part"), "part", "home", "rep", "copies", "vector"
    )


class Labels:
    """Disjoint sets over positions, joined by arrays of pairs; ``joined`` holds the pairs that were needed."""

    def __init__(self, n: int):
        self.label, self.joined = np.arange(n), []

    def join(self, p: np.ndarray, q: np.ndarray) -> None:
        a, b = self.label[p], self.label[q]
        apart = a != b
        pairs = np.unique(np.stack([a[apart], b[apart]], 1), axis=0)
        if not len(pairs):
            return
        up = np.arange(len(self.label))

        def root(i: int) -> int:
            while up[i] != i:
                up[i] = up[up[i]]
                i = int(up[i])
            return i

        for a, b in pairs.tolist():
            u, v = root(a), root(b)
            if u != v:
                up[max(u, v)] = min(u, v)
                self.joined.append((a, b))
        while True:
            flat = up[up]
            if (flat == up).all():
                break
            up = flat
        self.label = up[self.label]


def _tile_links(block: int, same: bool, part: np.ndarray, left_part: int, home: np.ndarray, x: np.ndarray, copies: np.ndarray, turn, edges, threshold: float):
    """Links found in one tile: (number of linked copies per row, (row, row) pairs that connect what is linked)."""
    n, size = x.shape
    norm = np.linalg.norm(x, axis=1)
    turned = (x / norm[:, None]) @ turn
    budget = 2 - 2 * threshold
    within = [budget * (edges[b + 1] - edges[b]) / size for b in range(len(edges) - 1)]
    own = turned[:, edges[block] : edges[block + 1]]
    square = (own**2).sum(1, keepdims=True)
    one = np.ones_like(square)
    # The product of these two is the squared distance.
    one_side = np.concatenate([-2 * own, square, one], 1).astype(np.float32)
    other_side = np.ascontiguousarray(np.concatenate([own, one, square], 1).astype(np.float32).T)
    limit = np.float32(within[block] + SLACK)
    links = np.zeros(n, np.int64)
    labels = Labels(n)
    homes, visitors = np.flatnonzero(home), np.flatnonzero(~home)
    if same:  # rows at home with all later rows, and with visitors
        strips = [(homes[s : s + STRIP], np.concatenate([homes[s:], visitors])) for s in range(0, len(homes), STRIP)]
    else:
        left, right = part == left_part, part != left_part
        sides = [(np.flatnonzero(left & home), np.flatnonzero(right)), (np.flatnonzero(left & ~home), np.flatnonzero(right & home))]
        strips = [(a[s : s + STRIP], b) for a, b in sides for s in range(0, len(a), STRIP)]
    for rows, columns in ((r, c[t : t + PANEL]) for r, c in strips for t in range(0, len(c), PANEL)):
        hit = np.flatnonzero(one_side[rows] @ other_side[:, columns] <= limit)
        if not len(hit):
            continue
        i, j = rows[hit // len(columns)], columns[hit % len(columns)]
        if same:
            once = ~home[j] | (i < j)
            i, j = i[once], j[once]
        for a in range(0, len(i), 1 << 15):  # bounded whatever the number of pairs
            p, q = i[a : a + (1 << 15)], j[a : a + (1 << 15)]
            for b in range(block + 1):  # in its own block and in no earlier one, by one and the same bound
                cut = slice(edges[b], edges[b + 1])
                inside = ((turned[p, cut] - turned[q, cut]) ** 2).sum(1) <= within[b] + EDGE
                p, q = (p[inside], q[inside]) if b == block else (p[~inside], q[~inside])
            cosine = (x[p] * x[q]).sum(1) / (norm[p] * norm[q])
            linked = cosine >= threshold
            p, q = p[linked], q[linked]
            links += np.bincount(p, copies[q], n).astype(np.int64) + np.bincount(q, copies[p], n).astype(np.int64)
            labels.join(p, q)
    return links, labels.joined


def _tile(size: int, blocks: int, threshold: float, seed: int):
    """The function of one tile: linked copies ``n`` per row ``u``, and pairs ``u``, ``v`` that connect what is linked."""
    edges, turn = np.linspace(0, size, blocks + 1).astype(int), rotation(size, seed)

    def tile(key, table):
        block, _, left_part, right_part = (k.as_py() for k in key)
        values, _ = list_parts(table.column("vector").combine_chunks())
        ids = table.column("rep").to_numpy()
        order = np.argsort(ids, kind="stable")
        x = values.reshape(len(ids), size)[order].astype(np.float64)
        ids = ids[order]
        part, home, copies = (table.column(c).to_numpy()[order] for c in ("part", "home", "copies"))
        links, joined = _tile_links(block, left_part == right_part, part, left_part, home.astype(bool), x, copies, turn, edges, threshold)
        some = np.flatnonzero(links)
        pairs = np.array(joined, np.int64).reshape(-1, 2)
        none = np.zeros(len(pairs), np.int64)
        return pa.table({"u": np.append(ids[some], ids[pairs[:, 0]]), "v": np.append(ids[some], ids[pairs[:, 1]]), "n": np.append(links[some], none)})

    return tile


def linked(vectors: DataFrame, threshold: float = THRESHOLD, blocks: int = BLOCKS, cell_rows: int = CELL_ROWS, seed: int = 3, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Vectors link if their cosine in double precision is ``threshold`` or more. Those that cannot be compared, and vectors of
    another length, link with nothing; rows that repeat an id count as further vectors. A null id takes part, but is the
    name of a component only if the whole component has none. Columns besides the id and the vector are ignored."""
    everything = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("vector"))
    rows = everything.where(comparable(F.col("vector")))
    reps = cut_lineage(distinct_vectors(rows).withColumn("rep_key", F.xxhash64("vector")), "subspace-vectors")
    sizes = [r[0] for r in reps.select(F.size("vector").alias("n")).distinct().sort("n").collect()]  # dimensions that occur
    counts = edges_found = None
    for size in sizes:
        own = reps.where(F.size("vector") == size).select(F.col("rep_key").alias("rep"), "copies", "vector")
        tiles = _tiles(_cells(own, size, min(blocks, size), threshold, seed), cell_rows)
        found = tiles.groupBy("block", "cell", "left_part", "right_part").applyInArrow(_tile(size, min(blocks, size), threshold, seed), "u long, v long, n long")
        found = cut_lineage(found, "subspace-links")
        some = found.where("n > 0").groupBy(F.col("u").alias("key")).agg(F.sum("n").alias("links"))
        counts = some if counts is None else counts.unionByName(some)
        pairs = found.where("u != v").select("u", "v")
        edges_found = pairs if edges_found is None else edges_found.unionByName(pairs)
    members = reps.select(F.col("rep_key").alias("id"), "rep", "copies")
    if counts is None:
        joined_rows = members.withColumn("component", F.col("id")).withColumn("links", F.lit(0).cast("long"))
    else:
        joined_rows = connected_components(members, edges_found).join(counts, F.col("id") == F.col("key"), "left").drop("key")
    joined_rows = cut_lineage(joined_rows.select("id", "rep", "copies", "component", F.coalesce("links", F.lit(0)).alias("links")), "subspace-members")
    least = joined_rows.groupBy(F.col("component").alias("_component")).agg(F.min("rep").alias("component_id"))
    answers = joined_rows.join(least, F.col("component") == F.col("_component")).select(
        "id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    keyed = everything.select("vec_id", F.when(comparable(F.col("vector")), F.xxhash64("vector")).alias("_own"))
    out = keyed.join(answers, F.col("_own") == F.col("id"), "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
