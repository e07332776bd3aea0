"""Exact k-nearest neighbours by cosine similarity.

Three plans, chosen by checked size:

* few queries: the queries are broadcast and the corpus is scanned once, each task keeping a running
  top-k (:func:`top_k`);
* small corpus: the corpus is broadcast and the queries are streamed past it;
* both large (:func:`knn_join`): vectors are put into blocks around pivots, block pairs that the
  triangle inequality rules out are dropped, and only the remaining pairs are multiplied. Blocks are dealt
  into a few tiles a side, and pairs of tiles rather than of blocks are what tasks receive: each row is sent
  as often as the other side has tiles (some dozens), not as often as it has blocks.

The last follows the pivot-based k-NN joins known from the literature. Copies of a vector are one row
throughout, and only the ``k + 1`` lowest ids of a set of copies can be neighbours, so a vector that makes up
much of the table costs no more than any other. Blocks have a bounded number of rows, tiles a bounded size.

Similarities are rounded to ``decimals`` places before ranking, ties go to the lower id, and a row is
never its own neighbour.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoardline.operators.ranking import first_rows
from hoardline.session import cut_lineage

DECIMALS = 6
BROADCAST_BYTES = 64 << 20  # largest set of queries that is sent to every task
CORPUS_BYTES = 16 << 20  # largest corpus that is sent to every task: each Python worker holds a copy
TILE_BYTES = 32 << 20  # most of either side that a task of the block plan holds
QUERY_TILES = 24  # least number of parts that the queries of the block plan are dealt to
BLOCK_ROWS = 1024
MAX_PIVOTS = 1024
RINGS = 16
SCORES_AT_ONCE = 1 << 20
NEIGHBOUR_SCHEMA = "query_id long, neighbor_id long, similarity double"
RANKED_SCHEMA = "query_id long, rank long, neighbor_id long, similarity double"
NEIGHBOUR_ARROW = pa.schema([("query_id", pa.int64()), ("neighbor_id", pa.int64()), ("similarity", pa.float64())])
NOTHING = np.iinfo(np.int64).max


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a float64 matrix."""
    if len(column) == 0:
        return np.zeros((0, 0))
    lengths = pc.list_value_length(column)
    if column.null_count or pc.min_max(lengths)["min"] != pc.min_max(lengths)["max"]:
        raise ValueError("vectors of one table must have the same length, and none may be null here")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def unit_rows(rows: np.ndarray) -> np.ndarray:
    if rows.size == 0:
        return rows
    return rows / (np.linalg.norm(rows, axis=1, keepdims=True) + 1e-12)


def best_columns(
    scores: np.ndarray, ids: np.ndarray, k: int, decimals: int, least: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Per row of ``scores`` the ids and rounded scores of its ``k`` best columns, best first.

    ``least`` leaves out columns below a score per row. Columns within a rounding step of the k-th best are kept too, so that ties at the cut are settled
    by id. Columns scored ``-inf`` or NaN are out; free places hold the id ``NOTHING``.
    """
    rows, width = scores.shape
    if not np.isfinite(scores.sum()):
        scores = np.where(np.isnan(scores), -np.inf, scores)
    keep = scores > -np.inf if least is None else scores >= least[:, None]
    if width > k and (least is None or np.count_nonzero(keep) > 8 * k * rows):
        cut = np.partition(scores, width - k, axis=1)[:, width - k]
        keep &= scores >= (cut - 1.5 * 10.0**-decimals)[:, None]
    row, column = np.nonzero(keep)
    value, name = np.round(scores[row, column] * 10.0**decimals), ids[column]
    order = np.lexsort((name, -value, row))
    row, value, name = row[order], value[order], name[order]
    place = np.arange(len(row)) - np.searchsorted(row, np.arange(rows))[row]
    first = place < k
    found = np.full((rows, k), NOTHING)
    best = np.full((rows, k), -np.inf)
    found[row[first], place[first]] = name[first]
    best[row[first], place[first]] = value[first] / 10.0**decimals
    return found, best


def better(
    found: np.ndarray, kept: np.ndarray, new_ids: np.ndarray, new_scores: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The best of two results of :func:`best_columns` per row, as many as the first has."""
    every_id = np.concatenate([found, new_ids], axis=1)
    every = np.concatenate([kept, new_scores], axis=1)
    order = np.lexsort((every_id, -every), axis=-1)[:, : found.shape[1]]
    return np.take_along_axis(every_id, order, axis=1), np.take_along_axis(every, order, axis=1)


def slices(batch: pa.RecordBatch, width: int) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch small enough that their scores against ``width`` rows stay in memory."""
    rows = max(1, SCORES_AT_ONCE // max(1, width))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def long_rows(query_ids: np.ndarray, found: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    rows, columns = np.nonzero(found != NOTHING)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(query_ids[rows], pa.int64()),
            pa.array(found[rows, columns], pa.int64()),
            pa.array(scores[rows, columns], pa.float64()),
        ],
        names=["query_id", "neighbor_id", "similarity"],
    )


def rows_that_fit(df: DataFrame, vector: str, budget: int = BROADCAST_BYTES) -> int:
    """How many vectors of this table's dimension fit into ``budget`` bytes."""
    first = df.select(F.size(vector).alias("d")).head()
    return budget // (8 * max(1, first["d"])) if first else budget


def collect_small(df: DataFrame, vector: str, budget: int = BROADCAST_BYTES) -> pa.Table | None:
    """The table on the driver if it is within ``budget``, else None.

    The row limit is part of the job, so an oversized table is never pulled in whole.
    """
    limit = rows_that_fit(df, vector, budget)
    table = df.limit(limit + 1).toArrow()
    return table if table.num_rows <= limit else None


def _ranked(candidates: DataFrame, k: int) -> DataFrame:
    order = [F.col("similarity").desc(), F.col("neighbor_id")]
    top = first_rows(candidates, k, by=["query_id"], order=order)
    return top.select("query_id", F.col("rank").cast("long").alias("rank"), "neighbor_id", "similarity")


def top_k(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    *,
    query_id: str = "query_id",
    corpus_id: str = "id",
    vector: str = "embedding",
    filters: dict[str, str] | None = None,
    decimals: int = DECIMALS,
) -> DataFrame:
    """The ``k`` best corpus rows for each of a bounded number of queries.

    ``filters`` maps a corpus text column to the query column with the wanted part of it: a match is a
    case-insensitive substring, and ``all``, blank or null match everything. Filters apply before the
    cut to ``k``. Where the queries exceed the broadcast budget, each combination of filter values
    becomes a block join against the matching part of the corpus.
    """
    filters = filters or {}
    picked = queries.select(
        F.col(query_id).cast("long").alias("_q"), F.col(vector).alias("_v"), *filters.values()
    )
    table = collect_small(picked, "_v")
    if table is None:
        return _filtered_joins(queries, corpus, k, query_id, corpus_id, vector, filters, decimals)
    table = table.combine_chunks()
    ids = table["_q"].to_numpy()
    vectors = (
        unit_rows(matrix(table["_v"].combine_chunks())) if len(ids) else np.zeros((0, 0))
    )
    wanted = {
        column: [(w or "all").lower() for w in table[source].to_pylist()]
        for column, source in filters.items()
    }
    shared = queries.sparkSession.sparkContext.broadcast((ids, vectors, wanted))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, query_vectors, filter_values = shared.value
        found = np.full((len(query_ids), k), NOTHING)
        kept = np.full((len(query_ids), k), -np.inf)
        for batch in batches:
            if batch.num_rows == 0 or len(query_ids) == 0:
                continue
            for part_of in slices(batch, len(query_ids)):
                scores = query_vectors @ unit_rows(matrix(part_of.column(1))).T
                for i, parts in enumerate(filter_values.values()):
                    text = np.array([t or "" for t in part_of.column(2 + i).to_pylist()])
                    for part in set(parts) - {"all"}:
                        misses = np.char.find(text, part) < 0
                        rows = [q for q, p in enumerate(parts) if p == part]
                        scores[np.ix_(rows, misses)] = -np.inf
                new_ids, new_scores = best_columns(
                    scores, part_of.column(0).to_numpy(zero_copy_only=False), k, decimals
                )
                found, kept = better(found, kept, new_ids, new_scores)
        yield long_rows(query_ids, found, kept)

    scanned = corpus.select(
        F.col(corpus_id).cast("long").alias("_id"),
        vector,
        *[F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in filters],
    )
    return _ranked(scanned.mapInArrow(search, NEIGHBOUR_SCHEMA), k)


def _filtered_joins(
    queries: DataFrame, corpus: DataFrame, k: int, query_id: str, corpus_id: str, vector: str,
    filters: dict[str, str], decimals: int,
) -> DataFrame:
    wanted = {
        source: F.lower(F.coalesce(F.nullif(F.col(source), F.lit("")), F.lit("all")))
        for source in filters.values()
    }
    lowered = queries.withColumns(wanted)
    # Filter values come from drop-down lists, so their combinations are few.
    combinations = lowered.select(*wanted).distinct().collect() if filters else [{}]
    parts = []
    for values in combinations:
        asked, matching = lowered, corpus
        for column, source in filters.items():
            asked = asked.where(F.col(source) == values[source])
            if values[source] != "all":
                text = F.lower(F.coalesce(F.col(column).cast("string"), F.lit("")))
                matching = matching.where(text.contains(values[source]))
        parts.append(
            knn_join(
                asked, matching, k, query_id=query_id, corpus_id=corpus_id, vector=vector,
                exclude_self=False, decimals=decimals,
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _against_broadcast(
    queries: DataFrame, table: pa.Table, k: int, exclude_self: bool, decimals: int
) -> DataFrame:
    table = table.combine_chunks()
    vectors = unit_rows(matrix(table["_v"].combine_chunks())) if table.num_rows else np.zeros((0, 0))
    shared = queries.sparkSession.sparkContext.broadcast((table["_id"].to_numpy(), vectors))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, corpus = shared.value
        for batch in batches:
            if len(ids) == 0:
                continue
            for part in slices(batch, len(ids)):
                query_ids = part.column(0).to_numpy(zero_copy_only=False)
                scores = unit_rows(matrix(part.column(1))) @ corpus.T
                if exclude_self:
                    scores[query_ids[:, None] == ids[None, :]] = -np.inf
                yield _with_ranks(query_ids, *best_columns(scores, ids, k, decimals))

    # A task has seen the whole corpus, so its ranks are final and nothing is shuffled.
    return queries.mapInArrow(search, RANKED_SCHEMA)


def _with_ranks(query_ids: np.ndarray, found: np.ndarray, scores: np.ndarray) -> pa.RecordBatch:
    rows, columns = np.nonzero(found != NOTHING)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(query_ids[rows], pa.int64()),
            pa.array(columns + 1, pa.int64()),
            pa.array(found[rows, columns], pa.int64()),
            pa.array(scores[rows, columns], pa.float64()),
        ],
        names=["query_id", "rank", "neighbor_id", "similarity"],
    )


def knn_join(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    *,
    query_id: str = "id",
    corpus_id: str = "id",
    vector: str = "embedding",
    exclude_self: bool = True,
    strategy: str = "auto",
    decimals: int = DECIMALS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``k`` nearest corpus rows of every query: query_id, rank, neighbor_id, similarity. Rows without a vector take no part.

    ``strategy`` is ``broadcast`` (corpus within ``BROADCAST_BYTES``), ``blocks``, ``auto``, which
    checks the corpus size first, or ``probed``, which searches the nearest cells of an inverted
    index only (:mod:`hoardline.operators.cells`).
    """
    q = queries.select(F.col(query_id).cast("long").alias("_id"), F.col(vector).alias("_v")).where("_v IS NOT NULL")
    c = corpus.select(F.col(corpus_id).cast("long").alias("_id"), F.col(vector).alias("_v")).where("_v IS NOT NULL")
    if queries is corpus and query_id == corpus_id:
        c = q  # work on the vectors is done once
    if strategy in ("auto", "broadcast"):
        table = collect_small(c, "_v", BROADCAST_BYTES if strategy == "broadcast" else CORPUS_BYTES)
        if table is not None:
            return _against_broadcast(q, table, k, exclude_self, decimals)
        if strategy == "broadcast":
            raise ValueError("the corpus exceeds the broadcast budget")
    if strategy == "probed":
        from hoardline.operators.cells import probed_neighbours

        return probed_neighbours(q, c, k, exclude_self=exclude_self, decimals=decimals)
    return _knn_blocks(q, c, k, exclude_self, decimals, block_rows)


# ---- block plan -------------------------------------------------------------------------------


def _keyed(df: DataFrame) -> DataFrame:
    """With a 128-bit key that copies of a vector share."""
    return df.withColumns(
        {"_h1": F.xxhash64("_v"), "_h2": F.xxhash64(F.lit(1), F.col("_v"))}
    )


def _assigner(pivots) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = pivots.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            scores = unit_rows(matrix(batch.column(1))) @ centers.T
            cell = scores.argmax(axis=1)
            distance = _distance(scores[np.arange(len(cell)), cell])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(cell.astype(np.int64)),
                    pa.array(distance),
                ],
                names=["_id", "_v", "cell", "distance"],
            )

    return assign


def _distance(similarity: np.ndarray) -> np.ndarray:
    """Euclidean distance of unit vectors."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * similarity))


def _packed(df: DataFrame, rings: DataFrame) -> DataFrame:
    """Vectors packed into numbered blocks of about ``block_rows`` rows of one ring.

    ``rings`` has one row per occupied ring, at most ``MAX_PIVOTS * RINGS``, hence the broadcast.
    """
    placed = df.join(F.broadcast(rings), ["cell", "ring"]).withColumn("chunk", F.pmod(F.xxhash64("_id"), F.col("chunks")))
    packed = placed.groupBy("cell", "ring", "chunk", (F.col("before") + F.col("chunk")).alias("block")).agg(
        F.collect_list(F.struct("_id", "_v")).alias("rows")
    )
    return packed.select(
        "block", "cell", "ring", "chunk", F.col("rows._id").alias("ids"), F.col("rows._v").alias("vectors")
    )


def _with_rings(df: DataFrame, block_rows: int) -> DataFrame:
    """Cells cut into rings of equal width, about as many as the cell fills blocks.

    There is one row per cell, at most ``MAX_PIVOTS``, hence the broadcast.
    """
    cells = df.groupBy(F.col("cell").alias("_cell")).agg(
        F.min("distance").alias("_from"),
        F.max("distance").alias("_to"),
        F.least(F.lit(RINGS), F.ceil(F.count(F.lit(1)) / F.lit(block_rows))).alias("_rings"),
    )
    share = (F.col("distance") - F.col("_from")) / (F.col("_to") - F.col("_from") + F.lit(1e-9))
    ring = F.least(F.col("_rings") - 1, F.floor(share * F.col("_rings")))
    return df.join(F.broadcast(cells), F.col("cell") == F.col("_cell")).select(
        "_id", "_v", "cell", ring.cast("long").alias("ring"), "distance"
    )


def _ring_sizes(df: DataFrame, block_rows: int, place: np.ndarray) -> pa.Table:
    """The occupied rings, at most ``MAX_PIVOTS * RINGS``, in the order of their pivots' places, with the number of the first block."""
    rings = df.groupBy("cell", "ring").agg(
        F.min("distance").alias("nearest"),
        F.max("distance").alias("farthest"),
        F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("long").alias("chunks"),
    ).toArrow().combine_chunks()
    rings = rings.take(np.lexsort((rings["ring"].to_numpy(), place[rings["cell"].to_numpy()])))
    chunks = rings["chunks"].to_numpy()
    return rings.append_column("before", pa.array(np.cumsum(chunks) - chunks, pa.int64()))


def _chain(centers: np.ndarray) -> np.ndarray:
    """Places of the pivots in a walk to the nearest pivot not yet seen, so that near cells get into one tile."""
    near = centers @ centers.T
    place, here = np.zeros(len(centers), np.int64), 0
    for step in range(len(centers)):
        place[here] = step
        near[:, here] = -np.inf
        here = int(np.argmax(near[here]))
    return place


def tile_count(rows: int, dimension: int, least: int = 1) -> int:
    """How many tiles a table of vectors is dealt to, for a tile to be within ``TILE_BYTES``."""
    return max(least, -(-rows * 8 * max(1, dimension) // TILE_BYTES))


def over_tiles(queries: DataFrame, corpus: DataFrame, score: Callable, schema: str) -> DataFrame:
    """``score`` for each pair of a query tile and a corpus tile that some query block asks for.

    ``queries`` has ``tile`` and ``slices``, the corpus tiles that a row asks for; ``corpus`` has ``tile``. ``score`` gets the rows of
    both sides as Arrow tables."""
    asked = queries.select(F.col("tile").alias("q_tile"), F.explode("slices").alias("c_tile"))
    pairs = asked.distinct()  # at most a few dozen tiles a side, hence the broadcast
    left = queries.select(F.col("tile").alias("q_tile"), F.explode("slices").alias("c_tile"), "*").drop("tile", "slices")
    right = corpus.join(F.broadcast(pairs), F.col("tile") == F.col("c_tile")).drop("tile")
    names, own = [c for c in left.columns if c not in ("q_tile", "c_tile")], [c for c in right.columns if c not in ("q_tile", "c_tile")]
    rows = left.withColumn("_side", F.lit(0)).unionByName(right.withColumn("_side", F.lit(1)), allowMissingColumns=True)

    def run(table: pa.Table) -> pa.Table:
        q, c = (table.filter(pc.equal(table["_side"], side)) for side in (0, 1))
        batches = list(score(q.select(names).combine_chunks(), c.select(own).combine_chunks()))
        return pa.Table.from_batches(batches, None if batches else NEIGHBOUR_ARROW)

    return rows.groupBy("q_tile", "c_tile").applyInArrow(run, schema)


def _array(column) -> pa.Array:
    """A column of a table, in one piece."""
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _block_matrix(column: pa.ListArray, row: int) -> np.ndarray:
    """Vectors of one packed block."""
    return unit_rows(matrix(column.slice(row, 1).flatten()))


_BOUND_SCHEMA = "block long, bounds array<double>, targets array<struct<c_cell:long, c_ring:long>>, rings array<int>, slices array<int>"
_RINGS = pa.list_(pa.struct([("c_cell", pa.int64()), ("c_ring", pa.int64())]))
BOUNDS_AT_ONCE = 64


def _bounder(pivots, ring_table, k: int, decimals: int):
    """For each query block: a lower bound of every query's k-th similarity, the corpus rings that
    can still hold a neighbour, and the tiles these are in."""
    slack = 2.0 * 10.0**-decimals

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centers = pivots.value
        cells, rings, nearest, farthest, first, last = ring_table.value
        for whole in batches:
            for start in range(0, whole.num_rows, BOUNDS_AT_ONCE):
                batch = whole.slice(start, BOUNDS_AT_ONCE)
                q_vectors, c_vectors = batch.column("vectors"), batch.column("c_vectors")
                bounds, alive, tiles = [], [], []
                for row in range(batch.num_rows):
                    queries = _block_matrix(q_vectors, row)
                    to_pivots = queries @ centers.T
                    # Pivots and home block hold corpus rows: the k-th best of either is a valid bound.
                    limit = np.full(len(queries), -1.0)
                    known = [to_pivots]
                    if c_vectors[row].is_valid:
                        known.append(queries @ _block_matrix(c_vectors, row).T)
                    for scores in known:
                        if scores.shape[1] >= k:
                            place = scores.shape[1] - k
                            limit = np.maximum(limit, np.partition(scores, place, axis=1)[:, place])
                    limit -= slack
                    reach = _distance(limit) + 1e-9
                    away = _distance(to_pivots)
                    low = (away - reach[:, None]).min(axis=0)[cells]
                    high = (away + reach[:, None]).max(axis=0)[cells]
                    left = np.nonzero((low <= farthest + 1e-9) & (high >= nearest - 1e-9))[0]
                    # A ring may reach over several tiles.
                    edges = np.zeros(last.max() + 2, np.int64)
                    np.add.at(edges, first[left], 1)
                    np.add.at(edges, last[left] + 1, -1)
                    bounds.append(limit)
                    alive.append(left)
                    tiles.append(np.flatnonzero(np.cumsum(edges)[:-1]))
                at = np.concatenate(alive)
                ends = pa.array(np.cumsum([0, *map(len, alive)]), pa.int32())
                ring = pa.StructArray.from_arrays([pa.array(cells[at]), pa.array(rings[at])], fields=list(_RINGS.value_type))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("block"),
                        pa.array(bounds, pa.list_(pa.float64())),
                        pa.ListArray.from_arrays(ends, ring),
                        pa.ListArray.from_arrays(ends, pa.array(at, pa.int32())),
                        pa.array(tiles, pa.list_(pa.int32())),
                    ],
                    names=["block", "bounds", "targets", "rings", "slices"],
                )

    return bound


def _scorer(k: int, decimals: int):
    """Blocks of a query tile against the blocks of a corpus tile that are in rings left to them."""
    slack = 2.0 * 10.0**-decimals

    def score(q: pa.Table, c: pa.Table) -> Iterator[pa.RecordBatch]:
        sizes = pc.list_value_length(_array(c["ids"])).to_numpy(zero_copy_only=False)
        ring = np.repeat(c["number"].to_numpy(), sizes)
        ids = _array(c["ids"]).flatten().to_numpy(zero_copy_only=False)
        corpus = unit_rows(matrix(_array(c["vectors"]).flatten()))
        q_ids, q_vectors, q_bounds, q_rings = (_array(q[n]) for n in ("ids", "vectors", "bounds", "rings"))
        for row in range(q.num_rows):
            query_ids, limit, alive = (x.slice(row, 1).flatten().to_numpy(zero_copy_only=False) for x in (q_ids, q_bounds, q_rings))
            chosen = np.flatnonzero(np.isin(ring, alive))
            queries = _block_matrix(q_vectors, row)
            found, kept = np.full((len(query_ids), k), NOTHING), np.full((len(query_ids), k), -np.inf)
            width = max(1, SCORES_AT_ONCE // max(1, len(query_ids)))
            for start in range(0, len(chosen), width):
                at = chosen[start : start + width]
                new = best_columns(queries @ corpus[at].T, ids[at], k, decimals, limit)
                found, kept = better(found, kept, *new)
                limit = np.maximum(limit, kept[:, -1] - slack)
            yield long_rows(query_ids, found, kept)

    return score


def over_distinct(
    queries: DataFrame,
    corpus: DataFrame,
    k: int,
    exclude_self: bool,
    solve: Callable[[DataFrame, DataFrame, int], DataFrame],
) -> DataFrame:
    """Neighbours of all queries from those of each different query vector.

    ``solve(queries, corpus, wanted)`` ranks different vectors (``_id, _v``, one row for a set of copies, named by its lowest id)
    and may return the query itself. Ties go to the lower id, so all answers are among the lowest ids of the ``wanted`` best
    vectors. Where ``queries`` is ``corpus``, so are the arguments of ``solve``.
    """
    wanted = k + 1 if exclude_self else k

    def different(df: DataFrame) -> DataFrame:
        sets = _keyed(df).groupBy("_h1", "_h2").agg(F.min("_id").alias("_id"), F.first("_v").alias("_v"))
        return cut_lineage(sets, "knn-vectors")

    corpus_sets = different(corpus)
    query_sets = corpus_sets if queries is corpus else different(queries)
    answers = corpus_sets.select("_id", "_v")
    top = solve(answers if queries is corpus else query_sets.select("_id", "_v"), answers, wanted)
    # Vectors stand for the lowest ids of their copies; ids and keys only from here on.
    keys = _keyed(corpus).select("_id", "_h1", "_h2")
    lowest = first_rows(keys, wanted, by=["_h1", "_h2"], order=[F.col("_id")], name="_n")
    copies = lowest.groupBy("_h1", "_h2").agg(F.min("_id").alias("_head"), F.collect_list("_id").alias("_ids"))
    rows = top.join(copies.select("_head", "_ids"), F.col("neighbor_id") == F.col("_head")).select(
        "query_id", "similarity", F.explode("_ids").alias("neighbor_id")
    )
    answer = F.struct((-F.col("similarity")).alias("order"), F.col("neighbor_id"), F.col("similarity"))
    per_query = rows.groupBy("query_id").agg(F.slice(F.array_sort(F.collect_list(answer)), 1, wanted).alias("answers"))
    # Hand each answer to all copies of its query, minus the row itself.
    per_key = query_sets.select("_id", "_h1", "_h2").join(
        per_query, F.col("_id") == F.col("query_id")
    ).select("_h1", "_h2", "answers")
    own = F.filter("answers", lambda a: a["neighbor_id"] != F.col("_id")) if exclude_self else F.col("answers")
    expanded = _keyed(queries).select("_id", "_h1", "_h2").join(per_key, ["_h1", "_h2"])
    return expanded.select(
        F.col("_id").alias("query_id"), F.posexplode(F.slice(own, 1, k)).alias("position", "a")
    ).select(
        "query_id",
        (F.col("position") + 1).cast("long").alias("rank"),
        "a.neighbor_id",
        "a.similarity",
    )


def _knn_blocks(
    queries: DataFrame, corpus: DataFrame, k: int, exclude_self: bool, decimals: int, block_rows: int
) -> DataFrame:
    def solve(solved: DataFrame, answers: DataFrame, wanted: int) -> DataFrame:
        return _block_answers(solved, answers, wanted, decimals, block_rows)

    return over_distinct(queries, corpus, k, exclude_self, solve)


def _block_answers(
    solved: DataFrame, answers: DataFrame, wanted: int, decimals: int, block_rows: int
) -> DataFrame:
    spark = solved.sparkSession
    rows = answers.count()
    # 1. A bounded, repeatable sample of distinct corpus vectors as pivots.
    size = int(np.clip(np.ceil(rows / block_rows), 8, MAX_PIVOTS))
    sample = answers.orderBy(F.xxhash64("_id"), "_id").limit(size).select("_v").toArrow()
    if sample.num_rows == 0:
        return spark.createDataFrame([], RANKED_SCHEMA)
    centers = unit_rows(matrix(sample.combine_chunks()["_v"].combine_chunks()))
    pivots, order = spark.sparkContext.broadcast(centers), _chain(centers)
    # 2. Cells around pivots, rings by distance to the pivot, blocks inside rings, tiles of blocks.
    vector_type = answers.schema["_v"].dataType.simpleString()
    placed = f"_id long, _v {vector_type}, cell long, distance double"

    def blocks(df: DataFrame) -> tuple[DataFrame, pa.Table]:
        assigned = cut_lineage(df.select("_id", "_v").mapInArrow(_assigner(pivots), placed), "knn-cells")
        in_rings = _with_rings(assigned, block_rows)
        rings = _ring_sizes(in_rings, block_rows, order)
        known = spark.createDataFrame(rings.select(["cell", "ring", "chunks", "before"]))
        return cut_lineage(_packed(in_rings, known), "knn-blocks"), rings

    c_blocks, c_rings = blocks(answers)
    q_blocks, q_rings = (c_blocks, c_rings) if solved is answers else blocks(solved)
    before, chunks = c_rings["before"].to_numpy(), c_rings["chunks"].to_numpy()
    c_total, q_total = (max(1, int(np.sum(r["chunks"].to_numpy()))) for r in (c_rings, q_rings))
    c_tiles = min(c_total, tile_count(rows, centers.shape[1]))
    q_tiles = min(q_total, tile_count(q_total * block_rows, centers.shape[1], QUERY_TILES))
    ring_table = spark.sparkContext.broadcast(
        (
            *[c_rings[n].to_numpy() for n in ("cell", "ring", "nearest", "farthest")],
            before * c_tiles // c_total,
            (before + chunks - 1) * c_tiles // c_total,
        )
    )
    # 3. Bounds from the home block of each query block, and the corpus tiles they leave.
    numbered = c_rings.select(["cell", "ring", "chunks", "before"]).append_column("number", pa.array(np.arange(c_rings.num_rows), pa.int32()))
    rings = F.broadcast(spark.createDataFrame(numbered))
    homes = (
        q_blocks.join(rings, ["cell", "ring"], "left")
        .select("block", "vectors", (F.col("before") + F.pmod(F.col("chunk"), F.col("chunks"))).alias("home"))
        .join(c_blocks.select(F.col("block").alias("home"), F.col("vectors").alias("c_vectors")), "home", "left")
    )
    bounded = cut_lineage(
        homes.select("block", "vectors", "c_vectors").mapInArrow(_bounder(pivots, ring_table, wanted, decimals), _BOUND_SCHEMA),
        "knn-bounds",
    )
    # 4. Multiply what is left of each pair of tiles; a pair of tiles is the largest thing a task holds.
    asking = q_blocks.select("block", "ids", "vectors").join(bounded.drop("targets"), "block").select(
        F.floor(F.col("block") * q_tiles / q_total).alias("tile"), "slices", "ids", "vectors", "bounds", "rings"
    )
    corpus = c_blocks.join(rings, ["cell", "ring"]).select(
        F.floor(F.col("block") * c_tiles / c_total).cast("int").alias("tile"), "ids", "vectors", "number"
    )
    return _ranked(over_tiles(asking, corpus, _scorer(wanted, decimals), NEIGHBOUR_SCHEMA), wanted)


# ---- uses --------------------------------------------------------------------------------------


def with_neighbour_fields(neighbours: DataFrame, metadata: DataFrame, fields: list[str]) -> DataFrame:
    """Fields of the neighbour row added to every neighbour."""
    extra = metadata.select(F.col("id").alias("_id"), *fields)
    return neighbours.join(extra, F.col("neighbor_id") == F.col("_id")).drop("_id")


def knn_index(
    rows: DataFrame, k: int, *, strategy: str = "auto", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Neighbour table of all rows with distance, cluster and period of each neighbour."""
    return described_index(knn_join(rows, rows, k, strategy=strategy, block_rows=block_rows), rows)


def described_index(found: DataFrame, rows: DataFrame) -> DataFrame:
    """Neighbours with distance, and cluster and period from ``rows``."""
    described = rows.select(
        "id",
        "cluster_id",
        F.coalesce("parser_period", F.lit("unknown")).alias("period"),
    )
    return with_neighbour_fields(found, described, ["cluster_id", "period"]).withColumn(
        "distance", F.round(1 - F.col("similarity"), DECIMALS)
    )


def nested_index(neighbours: DataFrame) -> DataFrame:
    """The index in nested form, one row per query; a list holds at most k neighbours."""
    entry = F.struct(
        F.col("rank"), F.col("neighbor_id").alias("id"), F.col("distance"), F.col("cluster_id"),
        F.col("period"),
    )
    return neighbours.groupBy("query_id").agg(
        F.array_sort(F.collect_list(entry)).alias("neighbors")
    )


def reassign_noise(
    clusters: DataFrame,
    k: int = 5,
    *,
    threshold: float = 0.6,
    max_distance: float | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """Noise rows put into the cluster most of their ``k`` neighbours belong to.

    Votes use the labels as they were before any reassignment. Fewer than ``k / 2`` clustered
    neighbours, or a winner below ``threshold`` of ``k``, leave a row as noise. Ties go to the cluster
    of the nearest neighbour.
    """
    from hoardline.functions.paths import is_noise

    noise = clusters.where(is_noise(F.col("cluster_id")))
    found = knn_join(noise, clusters, k, strategy=strategy)
    if max_distance is not None:
        found = found.where(F.round(1 - F.col("similarity"), DECIMALS) <= max_distance)
    labelled = with_neighbour_fields(found, clusters, ["cluster_id"]).where(
        ~is_noise(F.col("cluster_id"))
    )
    votes = labelled.groupBy("query_id", "cluster_id").agg(
        F.count(F.lit(1)).alias("votes"), F.min("rank").alias("nearest")
    )
    winner = votes.groupBy("query_id").agg(
        F.sum("votes").alias("clustered"),
        F.max(F.struct(F.col("votes"), (-F.col("nearest")).alias("closeness"), F.col("cluster_id"))).alias("top"),
    )
    decided = winner.where(
        (F.col("clustered") >= k / 2) & (F.col("top.votes") / F.lit(k) >= threshold)
    ).select(F.col("query_id").alias("_id"), F.col("top.cluster_id").alias("_new"))
    assigned = F.col("_new").isNotNull()
    method = (
        F.when(~is_noise(F.col("cluster_id")), "clustered")
        .when(assigned, "knn_assigned")
        .otherwise("noise")
    )
    return (
        clusters.join(decided, F.col("id") == F.col("_id"), "left")
        .withColumn("assignment_method", method)
        .withColumn("cluster_id", F.coalesce("_new", "cluster_id"))
        .drop("_id", "_new")
    )
