"""Cluster summaries, names and bookkeeping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hoardline.functions.paths import basename, is_noise
from hoardline.operators.ranking import first_rows, seeded_order


def period_breakdown(clusters: DataFrame) -> DataFrame:
    """Rows and summed confidence per (cluster, period), with the period's rank in its cluster.

    Ranked is one row per cluster and period, never the members of a cluster.
    """
    known = clusters.select(
        F.col("cluster_id").cast("string").alias("cluster_id"),
        F.coalesce(F.nullif(F.col("parser_period"), F.lit("")), F.lit("unknown")).alias("period"),
        F.col("cluster_confidence").alias("confidence"),
    )
    grouped = known.groupBy("cluster_id", "period").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("confidence").alias("confidence_sum")
    )
    place = F.row_number().over(
        Window.partitionBy("cluster_id").orderBy(F.desc("rows"), F.col("period"))
    )
    return grouped.withColumn("place", place)


def cluster_summary(clusters: DataFrame) -> DataFrame:
    """Size, dominant period, purity and mean confidence of each cluster, largest first."""
    parts = period_breakdown(clusters)
    top = {1: "dominant_period", 2: "second_period"}
    summary = parts.groupBy("cluster_id").agg(
        F.sum("rows").alias("size"),
        *[F.max(F.when(F.col("place") == i, F.col("period"))).alias(n) for i, n in top.items()],
        F.max("rows").alias("_most"),
        F.sum("confidence_sum").alias("_confidence"),
        F.map_from_entries(F.collect_list(F.struct("period", "rows"))).alias("period_breakdown"),
    )
    return summary.select(
        F.when(is_noise(F.col("cluster_id")), "noise")
        .otherwise(F.concat(F.lit("cluster_"), "cluster_id"))
        .alias("cluster"),
        "cluster_id",
        "size",
        "dominant_period",
        "second_period",
        (F.col("_most") / F.col("size")).alias("purity"),
        "period_breakdown",
        (F.col("_confidence") / F.col("size")).alias("avg_confidence"),
    ).orderBy(F.desc("size"), "cluster_id")


def cluster_counts(clusters: DataFrame) -> DataFrame:
    noise = is_noise(F.col("cluster_id"))
    return clusters.agg(
        F.countDistinct(F.when(~noise, F.col("cluster_id"))).alias("clusters"),
        F.count_if(noise).alias("noise"),
        (F.avg(noise.cast("int")) * 100).alias("noise_percent"),
    )


def suggest_names(summary: DataFrame) -> DataFrame:
    """Names from the composition: pure above 0.8, dominant with second above 0.5, else mixed."""
    first, second = F.col("dominant_period"), F.col("second_period")
    name = (
        F.when(F.col("purity") > 0.8, F.concat(first, F.lit("_pure")))
        .when(F.col("purity") > 0.5, F.concat_ws("_with_", first, F.coalesce(second, F.lit("mixed"))))
        .otherwise(F.concat_ws("_", F.lit("mixed"), first, second))
    )
    return summary.where(~is_noise(F.col("cluster_id"))).select(
        "cluster_id", name.alias("suggested_name")
    )


def original_name(path):
    """File name without the numeric prefix given on splitting."""
    return F.regexp_replace(basename(path), r"^\d+_(?=.)", "")


def merge_subclusters(master: DataFrame, sub: DataFrame) -> DataFrame:
    """Sub-cluster ids (``parent-n`` or ``parent-noise``) written back to the rows of their parent.

    ``sub`` holds parent_id, image_path and cluster_id; files are matched by name without the split
    prefix, and only within the parent.
    """
    new_id = F.concat_ws(
        "-",
        F.col("parent_id").cast("string"),
        F.when(is_noise(F.col("cluster_id")), "noise").otherwise(F.col("cluster_id").cast("string")),
    )
    assigned = sub.groupBy(
        F.col("parent_id").cast("string").alias("_parent"), original_name(F.col("image_path")).alias("_name")
    ).agg(F.max(new_id).alias("_new"))
    joined = master.join(
        assigned,
        (F.col("cluster_id").cast("string") == F.col("_parent"))
        & (basename(F.col("image_path")) == F.col("_name")),
        "left",
    )
    hit = F.col("_new").isNotNull()
    return joined.withColumns(
        {
            "cluster_id": F.coalesce("_new", F.col("cluster_id").cast("string")),
            "visual_cluster": F.when(hit, F.concat(F.lit("cluster_"), "_new")).otherwise(
                F.col("visual_cluster")
            ),
        }
    ).select(*master.columns)


def split_subset(clusters: DataFrame, index: str = "id") -> DataFrame:
    """Every picture under a name that is unique within its cluster: ``index_file``."""
    return clusters.select(
        F.col("cluster_id").cast("string").alias("parent_id"),
        F.col(index),
        F.concat_ws("_", F.col(index).cast("string"), basename(F.col("image_path"))).alias("unique_name"),
    )


def in_cluster(clusters: DataFrame, cluster: str) -> DataFrame:
    """Rows of one cluster by display name; by id if no row carries the name."""
    wanted = str(cluster)
    named = F.coalesce(F.col("visual_cluster") == f"cluster_{wanted}", F.lit(False))
    any_named = clusters.agg(F.count_if(named) > 0).scalar()
    by_id = F.col("cluster_id").cast("string") == wanted
    return clusters.where(F.when(any_named, named).otherwise(by_id))


def samples_per_cluster(clusters: DataFrame, n: int = 20, seed: int = 42) -> DataFrame:
    """Up to ``n`` random members of each cluster."""
    return first_rows(
        clusters,
        n,
        by=["cluster_id"],
        order=[seeded_order("id", seed), F.col("id")],
        name="sample_rank",
    )
