"""Connected components by alternating star contractions over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoardline.session import cut_lineage


def _fingerprint(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)).alias("h"),
    ).first()
    return row["n"], row["h"]


def _large_star(edges: DataFrame) -> DataFrame:
    """Every vertex hands its larger neighbours to the smallest vertex it knows."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    least = least.select("w", F.least("w", "m").alias("m"))
    return (
        both.where(F.col("v") > F.col("u"))
        .join(least, F.col("u") == F.col("w"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Every vertex hands its smaller neighbours, and itself, to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    moved = down.join(least, F.col("u") == F.col("w")).select(
        F.col("v").alias("u"), F.col("m").alias("v")
    )
    own = least.select(F.col("w").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(own).where(F.col("u") != F.col("v")).distinct()


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``vertices`` (id) with ``component``: the lowest id they are connected to through ``edges`` (u, v).

    Rounds alternate until the edge set no longer changes; each round is written out, so the plan stays
    short and a lost executor costs one round at most.
    """
    current = cut_lineage(
        edges.select(F.col("u").cast("long"), F.col("v").cast("long"))
        .where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "components",
    )
    before = _fingerprint(current)
    while True:
        current = cut_lineage(_small_star(_large_star(current)), "components")
        after = _fingerprint(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("u").alias("_member"), F.col("v").alias("_root"))
    return vertices.join(roots, F.col("id") == F.col("_member"), "left").select(
        *vertices.columns, F.coalesce("_root", F.col("id").cast("long")).alias("component")
    )
