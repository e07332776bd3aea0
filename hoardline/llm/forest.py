"""Documents that share most of their word n-grams, by a MinHash LSH forest and exact verification.

Documents with equal n-gram sets are one class. A class's signature is cut into trees, each a sorted trie of prefixes. Whole
prefixes are matched first; then prefixes are shortened until the chance that a pair at the threshold meets in some
tree reaches the target, and groups whose members are connected already are passed over. Signature agreement, with five standard
deviations to spare, decides which classes of a group belong together; inside the components that result, all pairs
are compared exactly in tiles of bounded size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.llm.common import binary_values, by_batch, list_parts, mix64, row_key, text_or_empty, tidy
from hoardline.llm.subspaces import Labels
from hoardline.operators.components import connected_components
from hoardline.session import cut_lineage

WORDS = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
TREES, STEP = 24, 3
TILE = 1_024  # classes on a side of a tile
GROUP_ROWS = 4_096
BUCKET_ROWS = 8_192
COLUMNS = 8_192
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_POWERS = np.cumprod(np.full(1 << 16, 0x100000001B3, dtype=np.uint64))


def recall(depth: int, threshold: float, trees: int = TREES) -> float:
    """The chance that two documents at the threshold share a prefix of ``depth`` in one of the trees."""
    return 1 - (1 - threshold**depth) ** trees


def depths(threshold: float, target: float, trees: int = TREES, step: int = STEP, longest: int = 12) -> list[int]:
    """Prefix lengths from the longest down to the first that reaches the target recall."""
    out = [longest]
    while recall(out[-1], threshold, trees) < target and out[-1] > 1:
        out.append(max(1, out[-1] - step))
    return out


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of ``words`` words; a shorter text that has words is one run."""
    data = np.frombuffer(text, np.uint8)
    inside = ~_SPACE[data]
    spots = np.flatnonzero(inside)
    if not len(spots):
        return np.empty(0, np.uint64)
    begins = np.append(True, np.diff(spots) > 1)
    first = np.flatnonzero(begins)
    length = np.diff(np.append(first, len(spots)))
    place = np.arange(len(spots)) - np.repeat(first, length)
    with np.errstate(over="ignore"):
        value = (data[spots].astype(np.uint64) + np.uint64(1)) * _POWERS[place & 0xFFFF]
        value ^= (place >> 16).astype(np.uint64) << np.uint64(32)
        word = mix64(np.add.reduceat(value, first) + length.astype(np.uint64))
        n = max(1, len(word) - words + 1)
        out = np.zeros(n, np.uint64)
        for k in range(min(words, len(word))):
            out = mix64(out ^ word[k : k + n])
    return np.unique(out)


def _hashers(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(2 * count, dtype=np.uint64))
    return seeds[:count] | np.uint64(1), seeds[count:]


def signature(hashes: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    with np.errstate(over="ignore"):
        for s in range(0, len(hashes), 1_024):  # stays in the cache
            part = ((hashes[s : s + 1_024, None] * a + b) >> np.uint64(32)).astype(np.uint32)
            out = np.minimum(out, part.min(0))
    return out


def _class_of(hashes: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int((mix64(hashes).sum(dtype=np.uint64) ^ mix64(np.array([len(hashes)], np.uint64))[0]).view(np.int64))


def _signed(rows: DataFrame, words: int, values: int) -> DataFrame:
    """``doc_id, row, cls, sig``; texts without words have no class."""

    def run(batches):
        a, b = _hashers(values)

        def one(batch):
            classes, signatures = [], []
            for text in binary_values(batch.column("text")):
                found = shingles(text, words)
                classes.append(_class_of(found) if len(found) else None)
                signatures.append(signature(found, a, b).view(np.int32) if len(found) else None)
            arrays = [batch.column("doc_id"), batch.column("row"), pa.array(classes, pa.int64()), pa.array(signatures, pa.list_(pa.int32()))]
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "row", "cls", "sig"])

        yield from by_batch(one)(batches)

    return rows.select("doc_id", "row", "text").mapInArrow(tidy(run), "doc_id long, row long, cls long, sig array<int>")


def _prefixes(classes: DataFrame, depth: int, trees: int, width: int) -> DataFrame:
    """``cls, prefix``: the hash of each tree's first ``depth`` values; a tree's values run on into the next tree's."""
    endless = F.concat("sig", "sig")
    keys = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.xxhash64(t, F.slice(endless, t * width + 1, depth)))
    return classes.select("cls", F.explode(keys).alias("prefix"))


def _tiled(rows: DataFrame, keys: list[str], counts: DataFrame, side: int) -> DataFrame:
    """``rows`` with ``part, left_part, right_part``: a group of n rows has parts of about ``side`` and a tile for every two of them."""
    named = counts.select(*[F.col(k).alias(f"_{k}") for k in keys], F.ceil(F.col("_n") / side).cast("int").alias("_parts"))
    condition = [F.col(k) == F.col(f"_{k}") for k in keys]
    rows = rows.join(named, condition).withColumn("part", F.pmod(F.xxhash64("cls"), F.col("_parts").cast("long")).cast("int"))
    rows = rows.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    rows = rows.withColumn("left_part", F.least("part", "_other")).withColumn("right_part", F.greatest("part", "_other"))
    return rows.drop("_other", "_parts", *[f"_{k}" for k in keys])


def _bucketed(rows: DataFrame, keys: list[str], bucket_rows: int) -> tuple[DataFrame, Column]:
    """``rows`` stored, and a bucket column: many small tiles make up one task's group."""
    rows = cut_lineage(rows, "forest-tiles")
    buckets = max(1, -(-rows.count() // bucket_rows))
    return rows, F.pmod(F.xxhash64(*keys), F.lit(buckets))


def _tiles_of(table: pa.Table, keys: list[str]):
    """Row numbers of each tile in a bucket."""
    columns = [table.column(k).to_numpy() for k in keys]
    order = np.lexsort(columns[::-1])
    changed = np.zeros(len(order), bool)
    for c in columns:
        changed[1:] |= c[order][1:] != c[order][:-1]
    return np.split(order, np.flatnonzero(changed))


def _agreeing(threshold: float, values: int):
    """Edges between classes of different components in a prefix group whose signatures agree enough."""
    least = values * (threshold - 5 * math.sqrt(threshold * (1 - threshold) / values))
    keys = ["prefix", "left_part", "right_part"]

    def run(table):
        cls, comp, part = (table.column(c).to_numpy() for c in ("cls", "comp", "part"))
        sig = list_parts(table.column("sig").combine_chunks())[0].reshape(len(cls), values)
        edges = []
        for rows in _tiles_of(table, keys):
            left = table.column("left_part")[int(rows[0])].as_py()
            right = table.column("right_part")[int(rows[0])].as_py()
            first = rows if left == right else rows[part[rows] == left]
            second = rows if left == right else rows[part[rows] != left]
            labels = Labels(len(cls))
            for s in range(0, len(first), 64):
                own = first[s : s + 64]
                for t in range(0, len(second), 256):
                    other = second[t : t + 256]
                    apart = comp[own][:, None] != comp[other][None, :]
                    i, j = np.nonzero(apart)
                    if len(i):
                        i, j = own[i], other[j]
                        near = (sig[i] == sig[j]).sum(1) >= least
                        labels.join(i[near], j[near])
            edges += labels.joined
        pairs = np.array(edges, np.int64).reshape(-1, 2)
        return pa.table({"u": cls[pairs[:, 0]], "v": cls[pairs[:, 1]]})

    return run


def _components(classes: DataFrame, edges: DataFrame) -> DataFrame:
    return connected_components(classes.select(F.col("cls").alias("id")), edges).select(F.col("id").alias("cls"), F.col("component").alias("comp"))


def candidates(classes: DataFrame, threshold: float, target: float, trees: int, width: int) -> DataFrame:
    """``cls, comp``: components that hold every pair of classes at the threshold, up to the target recall."""
    wanted = depths(threshold, target, trees)
    rows = _prefixes(classes, wanted[0], trees, width)
    least = rows.groupBy(F.col("prefix").alias("_prefix")).agg(F.min("cls").alias("least"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    edges = rows.join(least, F.col("prefix") == F.col("_prefix")).where("cls != least").select(F.col("cls").alias("u"), F.col("least").alias("v")).distinct()
    edges = cut_lineage(edges, "forest-edges")
    comps = cut_lineage(_components(classes, edges), "forest-components")
    for depth in wanted[1:]:
        rows = _prefixes(classes, depth, trees, width).join(comps, "cls")
        counts = rows.groupBy("prefix").agg(F.count(F.lit(1)).alias("_n"), F.min("comp").alias("_low"), F.max("comp").alias("_high"))
        open_ = counts.where("_low != _high").select("prefix", "_n")
        tiles = _tiled(rows, ["prefix"], open_, GROUP_ROWS).join(classes.select("cls", "sig"), "cls")
        tiles, bucket = _bucketed(tiles, ["prefix", "left_part", "right_part"], BUCKET_ROWS)
        more = cut_lineage(tiles.groupBy(bucket).applyInArrow(_agreeing(threshold, trees * width), "u long, v long"), "forest-edges")
        edges = edges.unionByName(more)
        comps = cut_lineage(_components(classes, edges), "forest-components")
    return comps


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left sets with all right sets, by products of blocks of columns."""
    sizes_l, sizes_r = [len(x) for x in left], [len(x) for x in right]
    values, column = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    shared = np.intersect1d(np.unique(column[: sum(sizes_l)]), np.unique(column[sum(sizes_l) :]), assume_unique=True)
    number = np.full(len(values), -1)
    number[shared] = np.arange(len(shared))
    column = number[column]
    row_l, row_r = np.repeat(np.arange(len(left)), sizes_l), np.repeat(np.arange(len(right)), sizes_r)
    column_l, column_r = column[: len(row_l)], column[len(row_l) :]
    order_l, order_r = np.argsort(column_l, kind="stable"), np.argsort(column_r, kind="stable")
    out = np.zeros((len(left), len(right)), np.float64)
    for a in range(0, len(shared), COLUMNS):
        blocks = []
        for order, col, row, n in ((order_l, column_l, row_l, len(left)), (order_r, column_r, row_r, len(right))):
            part = order[np.searchsorted(col, a, sorter=order) : np.searchsorted(col, a + COLUMNS, sorter=order)]
            block = np.zeros((n, min(COLUMNS, len(shared) - a)), np.float32)
            block[row[part], col[part] - a] = 1
            blocks.append(block)
        out += blocks[0] @ blocks[1].T
    return out


def _verified(threshold: float):
    keys = ["comp", "left_part", "right_part"]

    def run(table):
        cls, part, copies = (table.column(c).to_numpy() for c in ("cls", "part", "copies"))
        hashes, cuts = list_parts(table.column("hashes").combine_chunks())
        sets = [hashes[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        size = np.diff(cuts)
        links, edges = np.zeros(len(cls), np.int64), []
        for rows in _tiles_of(table, keys):
            left = table.column("left_part")[int(rows[0])].as_py()
            same = left == table.column("right_part")[int(rows[0])].as_py()
            first = rows if same else rows[part[rows] == left]
            second = rows if same else rows[part[rows] != left]
            if not len(first) or not len(second) or (same and len(rows) < 2):
                continue
            inter = _intersections([sets[i] for i in first], [sets[j] for j in second])
            similar = inter / (size[first][:, None] + size[second][None, :] - inter) >= threshold
            if same:
                similar = np.triu(similar, 1)
            i, j = np.nonzero(similar)
            i, j = first[i], second[j]
            links += np.bincount(i, copies[j], len(cls)).astype(np.int64) + np.bincount(j, copies[i], len(cls)).astype(np.int64)
            labels = Labels(len(cls))
            labels.join(i, j)
            edges += labels.joined
        pairs = np.array(edges, np.int64).reshape(-1, 2)
        some = np.flatnonzero(links)
        none = np.zeros(len(pairs), np.int64)
        return pa.table({"u": np.append(cls[some], cls[pairs[:, 0]]), "v": np.append(cls[some], cls[pairs[:, 1]]), "n": np.append(links[some], none)})

    return run


def join(
    documents: DataFrame,
    threshold: float = THRESHOLD,
    target: float = TARGET_RECALL,
    words: int = WORDS,
    trees: int = TREES,
    tile: int = TILE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: ``doc_id, row, class_id, n_links, kept``.

    Two documents link if the Jaccard similarity of their sets of ``words``-word runs is ``threshold`` or more; words are what white space
    separates. ``n_links`` counts the other documents linked directly, ``class_id`` is the smallest id that links lead to, and
    ``kept`` marks the row with that id; of several, or where no id is given and ``class_id`` is null, the one with the least ``row``, a hash of
    id and text. Texts without words, null ones too, link with nothing and are kept. Rows that repeat an id or a whole row count as further
    documents; equal rows are kept or not together. Other columns are ignored. Links that no prefix and no chain of other candidates leads to are missed with a
    chance of 1 - ``target`` at the threshold, and less above it."""
    width = min(depths(threshold, target, trees))
    rows = documents.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).cast("binary").alias("text"))
    rows = rows.withColumn("row", row_key(rows, "doc_id", "text"))
    signed = cut_lineage(_signed(rows, words, trees * width), "forest-signatures")
    named = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    grouped = signed.where(F.col("cls").isNotNull()).groupBy("cls")
    classes = cut_lineage(grouped.agg(F.count(F.lit(1)).alias("copies"), F.min(named).alias("name"), F.first("sig").alias("sig")), "forest-classes")
    comps = candidates(classes, threshold, target, trees, width)
    counts = comps.groupBy("comp").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    open_ = comps.join(counts.select("comp"), "comp").join(classes.select("cls", "copies", F.col("name.row").alias("_row")), "cls")

    def sets(batch):
        found = [shingles(t, words).view(np.int64) for t in binary_values(batch.column("text"))]
        arrays = [*(batch.column(c) for c in ("cls", "comp", "copies")), pa.array(found, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, ["cls", "comp", "copies", "hashes"])

    carriers = rows.join(open_, F.col("row") == F.col("_row")).dropDuplicates(["cls"]).select("cls", "comp", "copies", "text")
    texts = carriers.mapInArrow(tidy(by_batch(sets)), "cls long, comp long, copies long, hashes array<long>")
    tiles, bucket = _bucketed(_tiled(texts, ["comp"], counts, tile), ["comp", "left_part", "right_part"], tile)
    found = cut_lineage(tiles.groupBy(bucket).applyInArrow(_verified(threshold), "u long, v long, n long"), "forest-links")
    links = found.where("n > 0").groupBy(F.col("u").alias("_cls")).agg(F.sum("n").alias("_links"))
    final = _components(classes, found.where("u != v").select("u", "v")).join(classes.select("cls", "copies", "name"), "cls")
    final = cut_lineage(final.join(links, F.col("cls") == F.col("_cls"), "left").drop("_cls"), "forest-final")
    least = final.groupBy(F.col("comp").alias("_comp")).agg(F.min("name").alias("least"))
    answer = final.join(least, F.col("comp") == F.col("_comp")).select(
        F.col("cls").alias("_cls"), "least", (F.coalesce("_links", F.lit(0)) + F.col("copies") - 1).alias("_n")
    )
    out = signed.select("doc_id", "row", "cls").join(answer, F.col("cls") == F.col("_cls"), "left")
    first = F.coalesce(F.col("row") == F.col("least.row"), F.lit(True))
    return out.select(
        "doc_id",
        "row",
        F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("class_id"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
        first.alias("kept"),
    )
