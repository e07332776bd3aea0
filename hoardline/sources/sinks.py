"""Writers. A target path is always new: versions are added, never overwritten."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoardline.functions import vocabulary as V
from hoardline.operators.knn import nested_index


def write_manifests(rows: DataFrame, path: str) -> None:
    """One folder per split, as JSON lines and as CSV."""
    rows.write.partitionBy("split").json(f"{path}/json")
    rows.write.partitionBy("split").option("header", True).csv(f"{path}/csv")


def write_training_manifest(rows: DataFrame, path: str) -> None:
    rows.write.json(path)


def export_summary(statistics: DataFrame, config: dict[str, str]) -> DataFrame:
    """One row with the statistics, the settings and the taxonomy as JSON.

    ``statistics`` holds one row per section and label, so the list inside the row stays small.
    """
    counted = F.sort_array(F.collect_list(F.struct("section", "key", "rows")))
    settings = F.create_map(*[F.lit(x) for pair in config.items() for x in pair])
    return statistics.agg(counted.alias("statistics")).select(
        F.to_json(
            F.struct(
                F.col("statistics"),
                settings.alias("config"),
                F.array(*[F.lit(p) for p in V.TAXONOMY_PERIODS]).alias("taxonomy"),
            )
        ).alias("summary")
    )


def write_knn_index(neighbours: DataFrame, path: str) -> None:
    """The neighbour index in nested form, one JSON line per row."""
    nested_index(neighbours).write.json(path)


def write_vectors(vectors: DataFrame, path: str, label: str = "period") -> DataFrame:
    """Vectors as Parquet; returns the coverage per label of what was written."""
    vectors.write.parquet(path)
    written = vectors.sparkSession.read.parquet(path)
    return written.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))


def append_feedback(confirmations: DataFrame, corrections: DataFrame, path: str) -> None:
    """Both record shapes appended to one JSON-lines log."""
    both = confirmations.withColumn("type", F.lit("confirmation")).unionByName(
        corrections.withColumn("type", F.lit("correction")), allowMissingColumns=True
    )
    both.write.mode("append").json(path)


def append_rows(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
