"""Approximate nearest neighbours by an inverted index of cells.

The corpus is dealt to the nearest of about as many centers as the root of its size; a query is compared with the rows of the
``probes`` cells whose centers are nearest to it. With n rows that is in the order of probes * n * sqrt(n) instead of n * n comparisons for all
queries. With all cells probed the answers are exact. Rows of a cell are packed into blocks of bounded size, and blocks of both sides
are dealt into tiles, as in the exact join: a query is sent once to each tile that holds one of its cells, not once to each cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoardline.operators import knn
from hoardline.session import cut_lineage

PROBES = 8
SAMPLE_PER_CELL = 64
ROUNDS = 5
BLOCK_ROWS = 512


def cell_count(rows: int, dimension: int, budget: int = knn.BROADCAST_BYTES) -> int:
    """The root of ``rows``, within what may be sent to every task."""
    return int(max(1, min(np.ceil(np.sqrt(rows)), budget // (8 * max(1, dimension)))))


def train_cells(corpus: DataFrame, cells: int, seed: int = 42) -> np.ndarray:
    """Unit-length centers from a bounded, repeatable sample of ``corpus`` (``_id, _v``): 64 rows a cell."""
    sample = corpus.orderBy(F.xxhash64("_id"), "_id").limit(cells * SAMPLE_PER_CELL)
    norm = F.sqrt(F.aggregate("_w", F.lit(0.0), lambda a, x: a + x * x)) + 1e-12
    scaled = sample.select(F.col("_v").cast("array<double>").alias("_w")).select(F.transform("_w", lambda x: x / norm).alias("_w"))
    features = cut_lineage(scaled.select(array_to_vector("_w").alias("features")), "cells-sample")
    model = KMeans(k=max(2, cells), seed=seed, maxIter=ROUNDS, initMode="random", featuresCol="features").fit(features)
    return knn.unit_rows(np.stack(model.clusterCenters()))


def _to_cells(df: DataFrame, centers, probes: int) -> DataFrame:
    """``_id, _v, cell`` with the nearest cell, and ``probed``, the ``probes`` nearest ones; null stands for all cells."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle = centers.value
        for batch in batches:
            for part in knn.slices(batch, len(middle)):
                scores = knn.unit_rows(knn.matrix(part.column(1))) @ middle.T
                near = None if probes >= len(middle) else np.argpartition(-scores, probes - 1, axis=1)[:, :probes].astype(np.int32)
                probed = pa.nulls(part.num_rows, pa.list_(pa.int32())) if near is None else pa.array(list(near), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(scores.argmax(axis=1).astype(np.int64)), probed], ["_id", "_v", "cell", "probed"]
                )

    return df.select("_id", "_v").mapInArrow(place, f"_id long, _v {df.schema['_v'].dataType.simpleString()}, cell long, probed array<int>")


def _blocks(placed: DataFrame, block_rows: int, order: np.ndarray) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Numbered blocks of rows of one cell, near cells in a row, and per cell the number of its first block and that of its blocks."""
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("long").alias("n")).toArrow()  # a row per cell
    chunks = np.zeros(len(order), np.int64)
    chunks[sizes["cell"].to_numpy()] = sizes["n"].to_numpy()
    before, by_place = np.zeros(len(order), np.int64), np.argsort(order)
    before[by_place] = np.cumsum(chunks[by_place]) - chunks[by_place]
    table = pa.table({"cell": pa.array(np.arange(len(order))), "chunks": pa.array(chunks), "before": pa.array(before)})
    known = F.broadcast(placed.sparkSession.createDataFrame(table))
    dealt = placed.join(known, "cell").withColumn("block", F.col("before") + F.pmod(F.xxhash64("_id"), F.col("chunks")))
    rows = dealt.groupBy("cell", "block").agg(F.collect_list(F.struct("_id", "_v", "probed")).alias("r"))
    return rows.select("cell", "block", F.col("r._id").alias("ids"), F.col("r._v").alias("vectors"), F.col("r.probed").alias("probed")), before, chunks


def probed_neighbours(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    *,
    cells: int | None = None,
    probes: int | None = None,
    exclude_self: bool = True,
    decimals: int = knn.DECIMALS,
    block_rows: int = BLOCK_ROWS,
    compared=None,
) -> DataFrame:
    """The ``k`` nearest of the rows in the probed cells: query_id, rank, neighbor_id, similarity.

    ``queries`` and ``corpus`` hold ``_id, _v`` without nulls. ``compared``, an accumulator, sums up the pairs that were
    multiplied. Copies of a vector are solved once, as in the exact join."""
    spark = queries.sparkSession

    def solve(solved: DataFrame, answers: DataFrame, wanted: int) -> DataFrame:
        rows = answers.count()
        first = answers.select(F.size("_v").alias("d")).head()
        if first is None:
            return spark.createDataFrame([], knn.RANKED_SCHEMA)
        middle = train_cells(answers, cells or cell_count(rows, first["d"]))
        centers, order = spark.sparkContext.broadcast(middle), knn._chain(middle)
        placed = cut_lineage(_to_cells(solved, centers, probes or PROBES), "cells-queries")
        own = placed if solved is answers else cut_lineage(_to_cells(answers, centers, 1), "cells-corpus")
        c_blocks, before, chunks = _blocks(own, block_rows, order)
        q_blocks, _, q_chunks = _blocks(placed, block_rows, order)
        c_total, q_total = max(1, int(chunks.sum())), max(1, int(q_chunks.sum()))
        c_tiles = min(c_total, knn.tile_count(rows, first["d"]))
        q_tiles = min(q_total, knn.tile_count(q_total * block_rows, first["d"], knn.QUERY_TILES))
        # A query asks the tiles from the first to the last block of each of its cells.
        table = pa.table({
            "first": pa.array(before * c_tiles // c_total, pa.int32()),
            "last": pa.array((before + chunks - 1) * c_tiles // c_total, pa.int32()), "chunks": pa.array(chunks), "number": pa.array(np.arange(len(chunks)), pa.int32()),
        })
        reach = F.broadcast(spark.createDataFrame(table).where("chunks > 0").select("number", F.sequence("first", "last").alias("reach")))
        asked = (
            q_blocks.select("block", F.explode(F.array_distinct(F.flatten("probed"))).alias("number"))
            .join(reach, "number")
            .groupBy("block")
            .agg(F.array_distinct(F.flatten(F.collect_list("reach"))).alias("near"))
        )
        tile = F.floor(F.col("block") * q_tiles / q_total)
        every = F.sequence(F.lit(0), F.lit(c_tiles - 1))
        asking = q_blocks.join(asked, "block", "left").select(tile.alias("tile"), F.coalesce("near", every).alias("slices"), "ids", "vectors", "probed")
        corpus = c_blocks.select(F.floor(F.col("block") * c_tiles / c_total).cast("int").alias("tile"), "ids", "vectors", "cell")

        def score(q: pa.Table, c: pa.Table) -> Iterator[pa.RecordBatch]:
            c_ids, c_vectors, q_ids, q_vectors, q_probed = (knn._array(t[n]) for t, n in ((c, "ids"), (c, "vectors"), (q, "ids"), (q, "vectors"), (q, "probed")))
            cell = c["cell"].to_numpy()
            for row in range(q.num_rows):
                names = q_ids.slice(row, 1).flatten().to_numpy(zero_copy_only=False)
                vectors, probed = knn._block_matrix(q_vectors, row), q_probed.slice(row, 1).flatten()
                near = None if probed.null_count else np.stack(probed.to_numpy(zero_copy_only=False))
                found, kept = np.full((len(names), wanted), knn.NOTHING), np.full((len(names), wanted), -np.inf)
                for at in range(c.num_rows):
                    some = np.arange(len(names)) if near is None else np.flatnonzero((near == cell[at]).any(axis=1))
                    if not len(some):
                        continue
                    right = knn._block_matrix(c_vectors, at)
                    if compared is not None:
                        compared.add(len(some) * len(right))
                    ids = c_ids.slice(at, 1).flatten().to_numpy(zero_copy_only=False)
                    least = kept[some, -1] - 2.0 * 10.0**-decimals
                    new = knn.best_columns(vectors[some] @ right.T, ids, wanted, decimals, np.where(np.isfinite(least), least, -2.0))
                    found[some], kept[some] = knn.better(found[some], kept[some], *new)
                yield knn.long_rows(names, found, kept)

        return knn._ranked(knn.over_tiles(asking, corpus, score, knn.NEIGHBOUR_SCHEMA), wanted)

    return knn.over_distinct(queries, corpus, k, exclude_self, solve)
