"""Clustering of embedding vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, PCAModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoardline.operators import radius
from hoardline.operators.components import connected_components
from hoardline.operators.ranking import spread_row_number
from hoardline.session import cut_lineage


def reduce_dimensions(df: DataFrame, k: int, vector: str = "embedding") -> tuple[DataFrame, PCAModel]:
    """``reduced`` array of ``k`` principal components, and the model with its explained variance."""
    features = df.withColumn("_features", array_to_vector(vector))
    model = PCA(k=k, inputCol="_features", outputCol="_reduced").fit(features)
    reduced = model.transform(features).withColumn("reduced", vector_to_array("_reduced"))
    return reduced.drop("_features", "_reduced"), model


def density_clusters(
    df: DataFrame,
    *,
    eps: float,
    min_samples: int = 10,
    min_cluster_size: int = 20,
    vector: str = "embedding",
    tile_rows: int | None = None,
) -> DataFrame:
    """Density clusters: rows with ``min_samples`` others within ``eps``, joined by steps of at most ``eps``.

    The core distance of a row is the distance to its ``min_samples``-th neighbour, and two rows hang together if
    their mutual reachability (the largest of both core distances and their own length) is at most
    ``eps``. Connected groups of at least ``min_cluster_size`` rows are clusters, numbered by size, and
    everything else is noise, -1, rows without a vector included. Copies of a vector count as many rows but are
    compared once; links are witnesses between groups (:mod:`hoardline.operators.radius`), so
    nothing that is stored grows with the square of a dense region. The result is that of a flat density cut rather than of a hierarchy.
    """
    heads, members = radius.distinct_vectors(df, "id", vector)
    heads, members = cut_lineage(heads, "density-vectors"), cut_lineage(members, "density-members")
    placed = cut_lineage(radius.tiles(heads, eps, tile_rows), "density-tiles")
    cores = cut_lineage(radius.core_distances(radius.packed(placed), eps, min_samples), "density-cores")
    dense = placed.join(cores.select("_id"), "_id", "left_semi")
    edges = radius.links(radius.packed(dense), eps)
    roots = connected_components(cores.select(F.col("_id").alias("id")), edges)
    found = (
        members.join(roots.select(F.col("id").alias("_head"), "component"), "_head")
        .join(cores.withColumnRenamed("_id", "_head"), "_head")
        .select(F.col("id").alias("_member"), "component", "core")
    )
    members = cut_lineage(
        df.select(F.col("id").cast("long").alias("id")).join(found, F.col("id") == F.col("_member"), "left").drop("_member"), "density-found"
    )
    sizes = members.where("component IS NOT NULL").groupBy("component").agg(F.count(F.lit(1)).alias("size")).where(
        F.col("size") >= min_cluster_size
    )
    # Clusters numbered by size: ranked inside powers of two, so no task sees all clusters.
    numbered = spread_row_number(
        sizes,
        "_place",
        bucket=-F.floor(F.log2(F.col("size").cast("double"))),
        order=[F.col("size").desc(), F.col("component")],
    ).select(F.col("component").alias("_component"), (F.col("_place") - 1).alias("cluster_id"))
    labelled = (
        members.join(numbered, F.col("component") == F.col("_component"), "left")
        .select("id", F.coalesce("cluster_id", F.lit(-1)).cast("long").alias("cluster_id"), "core")
    )
    densest = labelled.groupBy(F.col("cluster_id").alias("_cluster")).agg(F.min("core").alias("_densest"))
    confidence = (
        F.when(F.col("cluster_id") < 0, 0.0)
        .when(F.col("core") > 0, F.col("_densest") / F.col("core"))
        .otherwise(1.0)
    )
    return labelled.join(densest, F.col("cluster_id") == F.col("_cluster")).select(
        "id", "cluster_id", confidence.alias("cluster_confidence")
    )


def kmeans_clusters(
    df: DataFrame, k: int, *, vector: str = "embedding", seed: int = 42, max_iter: int = 20
) -> DataFrame:
    """Partition-based clusters with the same output columns, for very large corpora.

    The confidence is 1 less the distance to the nearest centre as a share of that to the second: 1 on a centre, 0 half-way
    between two (or where two centres coincide), 1 if there is one centre only."""
    features = df.select("id", array_to_vector(vector).alias("features"))
    centres = np.array(KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features").fit(features).clusterCenters())
    place = nearest_centre(centres)
    return df.select("id", place(F.col(vector).cast("array<double>")).alias("_place")).select("id", "_place.*")


def nearest_centre(centres: np.ndarray):
    """A function of a vector column: the nearest of ``centres`` (k rows, so its size is a parameter's) and the confidence in it."""

    @F.pandas_udf("struct<cluster_id:long,cluster_confidence:double>")
    def place(vectors: pd.Series) -> pd.DataFrame:
        x = np.stack(vectors.to_numpy()) if len(vectors) else np.zeros((0, centres.shape[1]))
        squares = (x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)
        # Exact distances of the two nearest only: the expanded square loses digits near a centre.
        two = np.argsort(squares, 1, kind="stable")[:, :2]
        distances = np.sqrt(((x[:, None, :] - centres[two]) ** 2).sum(2))
        swap = np.argsort(distances, 1, kind="stable")
        two, distances = np.take_along_axis(two, swap, 1), np.take_along_axis(distances, swap, 1)
        sure = np.ones(len(x))
        if centres.shape[0] > 1:
            second = distances[:, 1]
            sure = np.where(second > 0, 1 - distances[:, 0] / np.where(second > 0, second, 1), 0.0)
        return pd.DataFrame({"cluster_id": two[:, 0].astype(np.int64), "cluster_confidence": sure})

    return place


def with_plane(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``df`` with ``x`` and ``y``, its first two principal components. The largest loading of a component is positive, so that
    reruns do not mirror the map."""
    reduced, model = reduce_dimensions(df, 2, vector)
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(0), [0, 1]])
    axes = {name: F.col("reduced")[i] * float(signs[i]) for i, name in enumerate("xy")}
    return reduced.withColumns(axes).drop("reduced")


def variance_parts(df: DataFrame, clusters: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row: ``rows``, ``clusters``, and the squared distances ``within`` clusters (to their means) and ``between`` them (means to the
    common mean). Their sum does not depend on the clusters."""
    found = clusters.select(F.col("id").alias("_id"), "cluster_id")
    parts = df.join(found, F.col("id") == F.col("_id")).select("cluster_id", F.posexplode(F.col(vector).cast("array<double>")).alias("axis", "value"))
    each = parts.groupBy("cluster_id", "axis").agg(
        F.count("value").alias("n"), F.avg("value").alias("mean"), (F.var_pop("value") * F.count("value")).alias("within")
    )
    axes = each.groupBy("axis").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("clusters"),
        F.sum("within").alias("within"),
        (F.sum(F.col("n") * F.col("mean") * F.col("mean")) - F.sum(F.col("n") * F.col("mean")) ** 2 / F.sum("n")).alias("between"),
    )
    return axes.agg(F.max("n").alias("rows"), F.max("clusters").alias("clusters"), F.sum("within").alias("within"), F.sum("between").alias("between"))


def drill_down(
    df: DataFrame, clusters: DataFrame, *, parent: str, eps: float, min_samples: int = 2,
    min_cluster_size: int = 5,
) -> DataFrame:
    """One cluster split again with finer settings; rows keep their ``parent_id``."""
    inside = clusters.where(F.col("cluster_id").cast("string") == parent).select(F.col("id").alias("_in"))
    subset = df.join(inside, F.col("id") == F.col("_in"), "left_semi")
    return density_clusters(
        subset, eps=eps, min_samples=min_samples, min_cluster_size=min_cluster_size
    ).withColumn("parent_id", F.lit(parent))


def result_rows(df: DataFrame, clusters: DataFrame) -> DataFrame:
    """Result table: record fields, display name, id and confidence of the cluster."""
    found = clusters.select(
        F.col("id").alias("_id"), "cluster_id", "cluster_confidence"
    )
    name = F.when(F.col("cluster_id") >= 0, F.concat(F.lit("cluster_"), "cluster_id")).otherwise("noise")
    return (
        df.drop("cluster_id", "cluster_confidence", "visual_cluster")
        .join(found, F.col("id") == F.col("_id"))
        .drop("_id")
        .withColumn("visual_cluster", name)
        .withColumn("cluster_id", F.col("cluster_id").cast("string"))
    )
