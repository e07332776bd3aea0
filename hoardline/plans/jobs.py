"""End-to-end jobs over a folder of catalogue tables.

Each job reads ``<tables>/<name>`` (Parquet) and writes new folders below ``out``; input tables are
never changed. Run one with ``spark-submit -m hoardline <job> --tables … --out …``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoardline.functions.labels import with_labels
from hoardline.operators import (
    audit,
    clusters,
    enrich,
    export,
    feedback,
    grouping,
    knn,
    mutate,
    pairing,
    stats,
)
from hoardline.session import cut_lineage
from hoardline.sources import files, sinks
from hoardline.streaming.feedback import feedback_rows

Table = Callable[[str], DataFrame]


def label(spark: SparkSession, table: Table, out: str) -> None:
    """Labels of all lots."""
    with_labels(table("auction_data")).write.parquet(f"{out}/labelled_lots")


def pair(spark: SparkSession, table: Table, out: str) -> None:
    """New coins for unlinked detections, and the next version of both tables."""
    detections, coins = table("coin_detections"), table("coins")
    created, links = pairing.pair_unlinked(detections, coins)
    # Links and coins share the numbering; both are stored before they are used again.
    created, links = cut_lineage(created, "pairing"), cut_lineage(links, "pairing")
    pairing.pairing_statistics(created).write.json(f"{out}/pairing_statistics")
    pairing.link_detections(detections, links).write.parquet(f"{out}/coin_detections")
    coins.unionByName(created.drop("detections"), allowMissingColumns=True).write.parquet(f"{out}/coins")


def repair(spark: SparkSession, table: Table, out: str) -> None:
    """Legacy lots with two detections paired again; orphaned coins removed."""
    detections, coins = table("coin_detections"), table("coins")
    _, links, repaired = pairing.repair_legacy_pairs(detections, coins)
    pairing.link_detections(detections, links).write.parquet(f"{out}/coin_detections")
    repaired.write.parquet(f"{out}/coins")


def _write_export(rows: DataFrame, out: str, path_columns: list[str]) -> None:
    rows = cut_lineage(rows, "export")
    rows.write.parquet(f"{out}/dataset")
    fit = rows.where(F.col("period").isNotNull() & (F.col("label_confidence") >= 0.6))
    columns = [*path_columns, "period", "denomination", "material", "label_confidence", "needs_review", "split"]
    sinks.write_manifests(fit.select(*columns), f"{out}/manifests")
    export.label_mapping(rows, ["period", "denomination", "material"]).write.json(f"{out}/label_mappings")
    config = {"train_ratio": "0.70", "val_ratio": "0.15", "test_ratio": "0.15", "min_coin_likelihood": "0.5"}
    sinks.export_summary(export.export_statistics(rows), config).write.text(f"{out}/summary")


def export_pairs(
    spark: SparkSession, table: Table, out: str, rule: str = "skip", placeholder: str | None = None
) -> None:
    """Paired dataset with manifests, label mapping and summary."""
    coins = export.exportable_coins(
        table("coins"), table("auction_data"), table("auction_info"), table("coin_detections"),
        table("ml_coin_dataset"),
    )
    rows = export.export_pairs(coins, rule=rule, placeholder=placeholder)
    _write_export(rows, out, ["coin_id", "obv_path", "rev_path", "has_obv", "has_rev"])


def export_detections(spark: SparkSession, table: Table, out: str) -> None:
    """Single-side dataset with manifests, label mapping and summary."""
    rows = export.exportable_detections(
        table("coin_detections"), table("auction_data"), table("auction_info"), table("ml_dataset")
    )
    _write_export(export.export_detections(rows), out, ["coin_detection_id", "image_path"])


def report(spark: SparkSession, table: Table, out: str) -> None:
    """Catalogue statistics."""
    stats.catalogue_totals(
        table("auction_data"), table("coin_detections"), table("ml_dataset")
    ).write.json(f"{out}/totals")
    stats.period_distribution(table("ml_dataset")).write.json(f"{out}/periods")
    stats.pair_totals(table("ml_coin_dataset")).write.json(f"{out}/pairs")
    stats.side_status(table("coins"), table("coin_detections")).write.json(f"{out}/side_status")
    stats.exclusion_report(table("ml_dataset")).write.json(f"{out}/exclusions")


def check(spark: SparkSession, table: Table, out: str, fix: bool = False) -> None:
    """Integrity issues, samples and health; ``fix`` also writes the repaired dataset."""
    dataset = table("ml_dataset")
    found = cut_lineage(audit.all_issues(dataset, table("coin_detections"), table("auction_data")), "audit")
    found.write.parquet(f"{out}/issues")
    audit.issue_report(found).write.json(f"{out}/health")
    audit.issue_samples(found).write.json(f"{out}/samples")
    if fix:
        fixed = mutate.integrity_fixes(dataset)
        mutate.fix_counts(fixed).write.json(f"{out}/fixes")
        fixed.drop("fix_1", "fix_2", "fix_3").write.parquet(f"{out}/ml_dataset")


def sync(spark: SparkSession, table: Table, out: str, log: str | None = None) -> None:
    """Feedback logs merged into the dataset."""
    from hoardline import schemas

    if not log:
        raise ValueError("sync needs the path of the feedback log")
    dataset = table("ml_dataset")
    entries = files.read_json_lines(spark, log, schemas.FEEDBACK)
    rows = cut_lineage(feedback_rows(entries, dataset), "feedback")
    rows.write.parquet(f"{out}/verified_feedback")
    feedback.mark_verified(dataset, rows).write.parquet(f"{out}/ml_dataset")


def cluster(spark: SparkSession, table: Table, out: str, eps: str = "0.5") -> None:
    """Density clusters of ``vectors`` (id, period, embedding) with summary and suggested names."""
    vectors = table("vectors")
    found = grouping.density_clusters(vectors.select("id", "embedding"), eps=float(eps))
    rows = grouping.result_rows(grouping.with_plane(vectors.withColumnRenamed("period", "parser_period")), found)
    rows = cut_lineage(rows, "clusters")
    rows.drop("embedding").write.parquet(f"{out}/cluster_results")
    summary = clusters.cluster_summary(rows)
    summary.write.json(f"{out}/cluster_summary")
    clusters.suggest_names(summary).write.json(f"{out}/cluster_names")


def enrich_results(spark: SparkSession, table: Table, out: str) -> None:
    """Cluster results with labels and lots, and the share that matched."""
    rows = cut_lineage(
        enrich.enrich_clusters(
            table("cluster_results"), table("ml_coin_dataset"), table("coin_detections"), table("auction_data")
        ),
        "enriched",
    )
    rows.write.parquet(f"{out}/enriched")
    enrich.match_rate(rows).write.json(f"{out}/match_rate")


def index(spark: SparkSession, table: Table, out: str, k: str = "10") -> None:
    """Neighbour index of ``cluster_results`` with embeddings, long and nested."""
    found = cut_lineage(knn.knn_index(table("cluster_results"), int(k)), "index")
    found.write.parquet(f"{out}/knn_index")
    sinks.write_knn_index(found, f"{out}/knn_index_nested")


JOBS = {
    "label": label,
    "pair": pair,
    "repair": repair,
    "export-pairs": export_pairs,
    "export-detections": export_detections,
    "stats": report,
    "check": check,
    "sync": sync,
    "cluster": cluster,
    "enrich": enrich_results,
    "index": index,
}


def run(spark: SparkSession, job: str, tables: str, out: str, **options) -> None:
    JOBS[job](spark, lambda name: spark.read.parquet(f"{tables}/{name}"), out, **options)
