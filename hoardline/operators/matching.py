"""Joins of records to vectors and files by derived keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.functions.paths import canonical_lot_key, normal_path, path_keys


def _indexed(vectors: DataFrame, keys: dict[str, Column], payload: list[str]) -> DataFrame:
    """One row per key (or key tuple); of several vectors with a key the highest ``vec_id`` counts."""
    rows = vectors
    for name, spelled in keys.items():
        rows = rows.withColumn(name, F.explode(spelled))
    return rows.groupBy(*keys).agg(F.max(F.struct("vec_id", *payload)).alias("_hit"))


def vectors_by_path(
    records: DataFrame,
    vectors: DataFrame,
    pairs: list[tuple[str, str]],
    payload: list[str],
    data_root: str = "data",
) -> DataFrame:
    """Records with the vector listed under an equivalent spelling of their path or path pair.

    ``pairs`` lists (record column, vector column): one for single sides, two for obverse and reverse.
    Each record takes the hit of its best spelling. Unmatched records drop out.
    """
    names = [f"_key{i}" for i in range(len(pairs))]
    index = _indexed(
        vectors,
        {n: path_keys(F.col(v), data_root) for n, (_, v) in zip(names, pairs, strict=True)},
        payload,
    )
    candidates = records.select("id", *[r for r, _ in pairs])
    places = []
    for name, (record_column, _) in zip(names, pairs, strict=True):
        place = f"_place{name}"
        spelled = path_keys(F.col(record_column), data_root)
        candidates = candidates.select("*", F.posexplode(spelled).alias(place, name))
        places.append(F.col(place))
    match = index.select(*[F.col(n).alias(f"_v{n}") for n in names], "_hit")
    on = reduce(lambda a, b: a & b, [F.col(n) == F.col(f"_v{n}") for n in names])
    best = (
        candidates.join(match, on)
        .groupBy("id")
        .agg(F.min(F.struct(*places, "_hit")).alias("_best"))
        .select(F.col("id").alias("_id"), F.col("_best._hit").alias("_hit"))
    )
    return records.join(best, F.col("id") == F.col("_id")).select(*records.columns, "_hit.*")


def vectors_by_lot(
    sides: DataFrame, vectors: DataFrame, payload: list[str], with_side: bool = True
) -> DataFrame:
    """Manifest sides with the vector of the same lot key; unmatched sides keep a null ``vec_id``.

    ``with_side=False`` ignores the side in the key, so both sides of a lot share the last vector.
    """
    index = (
        vectors.withColumn("_key", canonical_lot_key(F.col("path"), with_side))
        .where(F.col("_key") != "")
        .groupBy("_key")
        .agg(F.max(F.struct("vec_id", *payload)).alias("_hit"))
    )
    keyed = sides.withColumn("_side_key", canonical_lot_key(F.col("image_path"), with_side))
    return keyed.join(index, F.col("_side_key") == F.col("_key"), "left").select(
        *sides.columns, "_hit.*"
    )


def match_counts(matched: DataFrame) -> DataFrame:
    hit = F.col("vec_id").isNotNull()
    return matched.agg(F.count_if(hit).alias("matched"), F.count_if(~hit).alias("unmatched"))


def side_of_path(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Side of each picture from the manifest, matched by normalised path; ``unknown`` if absent."""
    sides = manifest.groupBy(normal_path(F.col("image_path")).alias("_path")).agg(
        F.max("side").alias("_side")
    )
    return (
        rows.join(sides, normal_path(F.col("image_path")) == F.col("_path"), "left")
        .withColumn("side", F.coalesce("_side", F.lit("unknown")))
        .drop("_path", "_side")
    )


def overlap_diagnostics(manifest: DataFrame, vectors: DataFrame, sale: str) -> DataFrame:
    """How many manifest rows meet a vector by id, by file name, and how many vectors are of a sale."""
    name = F.substring_index("path", "/", -1)
    by_id = manifest.join(
        vectors.select(F.col("coin_id").alias("_vid")), F.col("id") == F.col("_vid"), "left_semi"
    )
    by_name = manifest.withColumn("_name", F.substring_index("image_path", "/", -1)).join(
        vectors.select(name.alias("_vname")), F.col("_name") == F.col("_vname"), "left_semi"
    )
    folded = F.lower("path")
    of_sale = vectors.where(folded.contains(sale) | folded.contains(sale.replace("_", "/")))

    def counted(df: DataFrame, label: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(label).alias("test"), "rows")

    return (
        counted(by_id, "same_id")
        .unionByName(counted(by_name, "same_file_name"))
        .unionByName(counted(of_sale, "vectors_of_sale"))
    )
