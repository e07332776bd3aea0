"""All rows within a distance of one another, without listing the pairs.

Vectors (scaled to unit length) are put into grid cells as wide as the radius along the few directions in which they spread most, so
that partners are in the same or a neighbouring cell. Cells are dealt into tiles of bounded size, and pairs of tiles are multiplied
in tasks. A task returns, per row, how many partners it met and the nearest few distances, or, per pair of groups that
already hang together inside their tiles, one witness link. What leaves a task therefore grows with its rows, not with
its pairs. Copies of a vector are one weighted row throughout.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoardline.operators.knn import DECIMALS, SCORES_AT_ONCE, matrix, unit_rows
from hoardline.session import cut_lineage

TILE_ROWS = 1024  # least size of a tile
TILES = 24  # a table without structure is dealt to so many tiles until they reach TILE_BYTES
TILE_BYTES = 16 << 20
AXES = 3
SAMPLE_ROWS = 4096  # rows that the directions are taken from; any directions give right results
CELL = [f"_c{i}" for i in range(AXES)]


def distinct_vectors(df: DataFrame, id_column: str = "id", vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """``_id, _v, weight`` with one row per different vector, named by its lowest id, and ``id, _head`` for all rows with a vector."""
    rows = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("_v")).where("_v IS NOT NULL")
    keys = [F.xxhash64("_v").alias("_h1"), F.xxhash64(F.lit(1), F.col("_v")).alias("_h2")]
    keyed = rows.select("id", *keys)
    sets = keyed.groupBy("_h1", "_h2").agg(F.min("id").alias("_head"), F.count(F.lit(1)).alias("weight"))
    heads = sets.join(rows, F.col("_head") == F.col("id")).select(F.col("_head").alias("_id"), "_v", "weight")
    members = keyed.join(sets, ["_h1", "_h2"]).select("id", "_head")
    return heads.dropDuplicates(["_id"]), members


def _directions(heads: DataFrame) -> np.ndarray:
    """Orthonormal directions of the largest spread in a bounded, repeatable sample."""
    sample = heads.orderBy(F.xxhash64("_id"), "_id").limit(SAMPLE_ROWS).select("_v").toArrow()
    if sample.num_rows == 0:
        return np.zeros((0, AXES))
    rows = np.nan_to_num(unit_rows(matrix(sample.combine_chunks()["_v"].combine_chunks())))
    _, _, axes = np.linalg.svd(rows - rows.mean(axis=0), full_matrices=False)
    found = np.zeros((rows.shape[1], AXES))
    found[:, : min(AXES, len(axes))] = axes[:AXES].T
    return found


def cell_side(eps: float, decimals: int = DECIMALS) -> float:
    """Width of a cell: no pair whose distance from the rounded similarity is within ``eps`` is farther apart than this."""
    return float(np.sqrt(eps * eps + 2 * 10.0**-decimals) * (1 + 1e-9))


def rows_of_tile(rows: int, dimension: int) -> int:
    """Rows of a tile: a row is sent to as many tasks as there are tiles around it, so their number does not grow with the table
    until a tile reaches ``TILE_BYTES``."""
    return int(max(TILE_ROWS, min(-(-rows // TILES), TILE_BYTES // (8 * max(1, dimension)))))


def tiles(heads: DataFrame, eps: float, tile_rows: int | None = None) -> DataFrame:
    """``_id, weight, _v`` with the cell ``_c0 ...`` and ``_part``, the tile inside the cell."""
    if tile_rows is None:
        first = heads.select(F.size("_v").alias("d")).head()
        tile_rows = rows_of_tile(heads.count(), first["d"] if first else 1)
    directions, side = _directions(heads), cell_side(eps)
    kind = heads.schema["_v"].dataType.simpleString()

    def place(batches):
        for batch in batches:
            if batch.num_rows:
                along = np.nan_to_num(unit_rows(matrix(batch.column(2)))) @ directions
                cells = np.floor(along / side).astype(np.int64)
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c) for c in cells.T)], ["_id", "weight", "_v", *CELL])

    placed = heads.select("_id", "weight", "_v").mapInArrow(place, f"_id long, weight long, _v {kind}, " + ", ".join(f"{c} long" for c in CELL))
    placed = cut_lineage(placed, "radius-cells")
    parts = placed.groupBy(*CELL).agg(F.ceil(F.count(F.lit(1)) / F.lit(tile_rows)).alias("_parts"))
    return placed.join(parts, CELL).withColumn("_part", F.pmod(F.xxhash64("_id"), F.col("_parts"))).drop("_parts")


def packed(placed: DataFrame, *extra: str) -> DataFrame:
    """One row per tile with its rows as arrays."""
    rows = placed.groupBy(*CELL, "_part").agg(F.collect_list(F.struct("_id", "weight", "_v", *extra)).alias("r"))
    return rows.select(*CELL, "_part", F.col("r._id").alias("ids"), F.col("r.weight").alias("weights"), F.col("r._v").alias("vectors"), *[F.col(f"r.{e}").alias(e) for e in extra])


def tile_pairs(packs: DataFrame, same: bool = True) -> DataFrame:
    """Every pair of tiles of one cell or of neighbouring cells once: columns of both with the prefixes ``a_`` and ``b_``."""
    steps = [s for s in product((-1, 0, 1), repeat=AXES) if s >= (0,) * AXES]
    tile = [*CELL, "_part"]
    steps = F.array(*[F.struct(*[F.lit(x).cast("long").alias(f"s{i}") for i, x in enumerate(s)]) for s in steps])
    left = packs.select(*[F.col(c).alias(f"a_{c}") for c in tile]).withColumn("s", F.explode(steps))
    wanted = left.select("a__part", *[f"a_{c}" for c in CELL], *[(F.col(f"a_{c}") + F.col(f"s.s{i}")).alias(f"b_{c}") for i, c in enumerate(CELL)])
    right = packs.select(*[F.col(c).alias(f"b_{c}") for c in tile])
    pairs = wanted.join(right, [f"b_{c}" for c in CELL])
    own = F.lit(True)
    for c in CELL:
        own &= F.col(f"a_{c}") == F.col(f"b_{c}")
    # Each pair of parts once, so that every part is first and second equally often.
    even = (F.col("a__part") + F.col("b__part")) % 2 == 0
    once = (F.col("a__part") != F.col("b__part")) & ((F.col("a__part") < F.col("b__part")) == even)
    pairs = pairs.where(~own | ((F.col("a__part") == F.col("b__part")) | once if same else once))
    a, b = (packs.select(*[F.col(c).alias(f"{p}_{c}") for c in packs.columns]) for p in "ab")
    return pairs.join(a, [f"a_{c}" for c in tile]).join(b, [f"b_{c}" for c in tile])


def distances(left: np.ndarray, right: np.ndarray, decimals: int = DECIMALS) -> np.ndarray:
    """Euclidean distances of unit vectors from similarities rounded as everywhere."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.round(left @ right.T, decimals)))


def _tile(batch: pa.RecordBatch, row: int, side: str, *names: str):
    one = [batch.column(f"{side}_{n}").slice(row, 1).flatten() for n in names]
    return [unit_rows(matrix(c)) if n == "vectors" else c.to_numpy(zero_copy_only=False) for n, c in zip(names, one, strict=True)]


def _strips(rows: int, width: int):
    """Ranges of rows whose distances to ``width`` others are held at a time; the first ones are short."""
    start, step = 0, 8
    while start < rows:
        yield start, min(rows, start + step)
        start, step = start + step, max(1, min(2 * step, SCORES_AT_ONCE // max(1, width)))


def _nearest(found: np.ndarray, weights: np.ndarray, eps: float, k: int):
    """Per row of ``found`` the weight within ``eps`` and the ``k`` least distances there, repeated by weight."""
    within = found <= eps
    counts = within @ weights
    lists = []
    width = min(k, found.shape[1])
    order = np.argpartition(np.where(within, found, np.inf), width - 1, axis=1)[:, :width] if width else np.zeros((len(found), 0), int)
    for i, at in enumerate(order):
        at = at[within[i, at]]
        at = at[np.argsort(found[i, at], kind="stable")]
        lists.append(np.repeat(found[i, at], np.minimum(weights[at], k))[:k])
    return counts, lists


def core_distances(packs: DataFrame, eps: float, k: int) -> DataFrame:
    """``_id, core`` of the rows with at least ``k`` others within ``eps``: the distance of the ``k``-th of them."""

    def count(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                a, aw, av = _tile(batch, row, "a", "ids", "weights", "vectors")
                b, bw, bv = _tile(batch, row, "b", "ids", "weights", "vectors")
                if len(a) == len(b) and (a == b).all():  # a tile with itself
                    sides = []
                    for start, stop in _strips(len(a), len(a)):
                        found, w = distances(av[start:stop], av), aw[start:stop]
                        found[np.arange(stop - start), np.arange(start, stop)] = np.inf  # a row is not its own partner, its copies are
                        counts, lists = _nearest(found, aw, eps, k)
                        lists = [np.append(np.zeros(min(n - 1, k)), near)[:k] for near, n in zip(lists, w.tolist(), strict=True)]
                        sides.append((a[start:stop], counts + w - 1, lists))
                else:
                    sides = [
                        (ids[start:stop], *_nearest(distances(mine[start:stop], others), weights, eps, k))
                        for ids, mine, others, weights in ((a, av, bv, bw), (b, bv, av, aw))
                        for start, stop in _strips(len(ids), len(others))
                    ]
                for ids, counts, lists in sides:
                    some = np.flatnonzero(counts)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[some]), pa.array(counts[some].astype(np.int64)), pa.array([lists[i] for i in some], pa.list_(pa.float64()))], ["_id", "n", "near"]
                    )

    met = tile_pairs(packs).mapInArrow(count, "_id long, n long, near array<double>")
    merged = met.groupBy("_id").agg(F.sum("n").alias("n"), F.flatten(F.collect_list("near")).alias("near"))
    return merged.where(F.col("n") >= k).select("_id", F.element_at(F.array_sort("near"), k).alias("core"))


def _groups(size: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The lowest position that each of ``size`` positions is linked to."""
    label = np.arange(size)
    while True:
        before = label.copy()
        low = np.minimum(label[u], label[v])
        np.minimum.at(label, u, low)
        np.minimum.at(label, v, low)
        label = label[label]
        if (label == before).all():
            return label


def _joined(label: np.ndarray, u: np.ndarray, v: np.ndarray, near: np.ndarray) -> np.ndarray:
    """``label``, the lowest of each group, after the groups ``u`` (rows) and ``v`` (columns) that are ``near`` have been joined."""
    u, v = label[u], label[v]
    row, column = np.nonzero(near & (u[:, None] != v[None, :]))
    if not len(row):
        return label
    ends = np.unique(u[row] * len(label) + v[column])
    return _groups(len(label), ends // len(label), ends % len(label))[label]


def links(packs: DataFrame, eps: float) -> DataFrame:
    """``u, v``: links that connect exactly the rows that are connected by steps of at most ``eps``.

    Inside a tile every row is linked to the lowest of its group; between two tiles there is at most one link for each group."""

    def inside(batches):
        for batch in batches:
            roots = []
            for row in range(batch.num_rows):
                one = batch.column("ids").slice(row, 1).flatten().to_numpy()
                vectors = unit_rows(matrix(batch.column("vectors").slice(row, 1).flatten()))
                order = np.argsort(one)
                vectors, label = vectors[order], np.arange(len(one))
                for start, stop in _strips(len(one), len(one)):
                    label = _joined(label, np.arange(start, stop), np.arange(len(one)), distances(vectors[start:stop], vectors) <= eps)
                lowest = np.empty(len(one), np.int64)
                lowest[order] = one[order][label]
                roots.append(lowest)
            kept = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(roots, pa.list_(pa.int64()))], [*batch.schema.names, "roots"])

    def between(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                av, ar = _tile(batch, row, "a", "vectors", "roots")
                bv, br = _tile(batch, row, "b", "vectors", "roots")
                names, at = np.unique(np.concatenate([ar, br]), return_inverse=True)
                label = np.arange(len(names))
                for start, stop in _strips(len(av), len(bv)):
                    label = _joined(label, at[start:stop], at[len(ar) :], distances(av[start:stop], bv) <= eps)
                group = names[label]
                linked = group != names
                if linked.any():
                    yield pa.RecordBatch.from_arrays([pa.array(names[linked]), pa.array(group[linked])], ["u", "v"])

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in packs.schema)
    grouped = cut_lineage(packs.mapInArrow(inside, f"{kind}, roots array<long>"), "radius-groups")
    own = grouped.select(F.explode(F.arrays_zip("ids", "roots")).alias("z")).select(F.col("z.ids").alias("u"), F.col("z.roots").alias("v"))
    across = tile_pairs(grouped, same=False).mapInArrow(between, "u long, v long")
    return own.where("u <> v").unionByName(across)
