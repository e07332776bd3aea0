"""Immutable snapshots with an append-only delta.

A snapshot is the folder ``snapshot=vN``; new rows go to ``delta=vN`` until compaction writes
``snapshot=v(N+1)`` from both. Nothing is changed in place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COMPACTION_SHARE = 0.10  # fixed value: delta share that triggers a compaction


def snapshot_path(root: str, version: int) -> str:
    return f"{root}/snapshot=v{version}"


def delta_path(root: str, version: int) -> str:
    return f"{root}/delta=v{version}"


def write_snapshot(df: DataFrame, root: str, version: int, partition_by: str | None = None) -> None:
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(snapshot_path(root, version))


def append_delta(df: DataFrame, root: str, version: int, partition_by: str | None = None) -> None:
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(delta_path(root, version))


def has_delta(spark: SparkSession, root: str, version: int) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(delta_path(root, version))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_current(spark: SparkSession, root: str, version: int) -> DataFrame:
    """Snapshot and delta together, as served."""
    snapshot = spark.read.parquet(snapshot_path(root, version))
    if not has_delta(spark, root, version):
        return snapshot
    return snapshot.unionByName(spark.read.parquet(delta_path(root, version)))


def compact(
    spark: SparkSession, root: str, version: int, share: float = COMPACTION_SHARE,
    partition_by: str | None = None,
) -> int:
    """Write the next snapshot once the delta exceeds ``share`` of the snapshot; returns the version
    to serve. Row counts must agree before the new version counts."""
    if not has_delta(spark, root, version):
        return version
    base = spark.read.parquet(snapshot_path(root, version)).count()
    added = spark.read.parquet(delta_path(root, version)).count()
    if added <= share * base:
        return version
    write_snapshot(read_current(spark, root, version), root, version + 1, partition_by)
    written = spark.read.parquet(snapshot_path(root, version + 1)).count()
    if written != base + added:
        raise RuntimeError(f"snapshot v{version + 1} holds {written} rows, not {base + added}")
    return version + 1


def freeze_manifest(df: DataFrame, key: str, coverage: list[str]) -> DataFrame:
    """Row count, key range, distinct keys and coverage of a frozen table."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(key).alias("first_id"),
        F.max(key).alias("last_id"),
        *[F.avg(F.col(c).isNotNull().cast("int")).alias(f"{c}_coverage") for c in coverage],
    )
