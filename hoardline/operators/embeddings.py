"""Coin-level vectors from side vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoardline.functions.vectors import bind, halves_average, joined_pair, mean_pair, normalize

SIDES = ("obverse", "reverse", "unknown")


def best_side_vectors(sides: DataFrame) -> DataFrame:
    """One row per coin with the best vector of each side: highest quality, then lowest vec_id.

    A combinable maximum, so repeated pictures of one side are reduced in every task.
    """
    candidate = F.struct(
        F.col("quality"), (-F.col("vec_id")).alias("age"), F.col("embedding"), F.col("period")
    )
    return sides.groupBy("coin_id").agg(
        *[F.max(F.when(F.col("side") == s, candidate)).alias(s) for s in SIDES]
    )


def coin_vectors(sides: DataFrame) -> DataFrame:
    """Normalised mean of the normalised obverse and reverse; the unknown side only if there is neither.

    The period is the alphabetically first among the chosen sides.
    """
    obverse, reverse, unknown = (F.col(f"{s}.embedding") for s in SIDES)
    both = bind(mean_pair(normalize(obverse), normalize(reverse)), normalize)
    one = F.coalesce(obverse, reverse, unknown)
    vector = F.when(obverse.isNotNull() & reverse.isNotNull(), both).otherwise(
        bind(normalize(one), normalize)
    )
    present = [F.when(F.col(s).isNotNull(), F.lit(s)) for s in SIDES]
    periods = [F.nullif(F.col(f"{s}.period"), F.lit("")) for s in SIDES]
    best = best_side_vectors(sides)
    return best.where(one.isNotNull()).select(
        "coin_id",
        vector.alias("embedding"),
        F.array_min(F.array_compact(F.array(*periods))).alias("period"),
        F.array_compact(F.array(*present)).alias("sides_available"),
    )


def pair_vectors(sides: DataFrame, normalize_sides: bool = True) -> DataFrame:
    """Concatenated vector of every coin that has both sides."""
    best = best_side_vectors(sides).where(
        F.col("obverse").isNotNull() & F.col("reverse").isNotNull()
    )
    pair = joined_pair(F.col("obverse.embedding"), F.col("reverse.embedding"), normalize_sides)
    return best.select("coin_id", pair.alias("embedding"))


def search_vectors(pairs: DataFrame, half: int) -> DataFrame:
    """Search vectors of half the dimension."""
    return pairs.select("coin_id", halves_average(F.col("embedding"), half).alias("embedding"))


def class_centroids(rows: DataFrame, label: str, vector: str = "embedding") -> DataFrame:
    """Mean vector per class; averaged by position, so no class is gathered."""
    parts = rows.select(label, F.posexplode(vector).alias("position", "x"))
    means = parts.groupBy(label, "position").agg(F.avg("x").alias("mean"))
    ordered = F.array_sort(F.collect_list(F.struct("position", "mean")))
    return means.groupBy(label).agg(F.transform(ordered, lambda p: p["mean"]).alias(vector))
