"""Cluster results enriched with their labels and auction lots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL_FIELDS = [
    "coin_id", "raw_label", "period", "subperiod", "authority", "denomination", "material", "mint",
    "obv_path", "rev_path",
]
LOT_FIELDS = {
    "auction_house": "auction_house", "sale_id": "sale_id", "lot_number": "lot_number",
    "title": "lot_title", "description": "lot_description", "image_url": "image_url",
    "current_bid": "current_bid", "closing_date": "closing_date", "site": "site",
    "auction_id": "auction_id", "lot_url": "lot_url",
}


def text_key(column: Column) -> Column:
    return F.trim(column.cast("string"))


def latest_per_key(df: DataFrame, key: str, payload: list[str], order: str = "id") -> DataFrame:
    """The row with the highest ``order`` per trimmed text key, by a combinable maximum."""
    newest = F.max(F.struct(F.col(order), *[F.col(c) for c in payload if c != order])).alias("_row")
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(text_key(F.col(key)).alias("_key"))
        .agg(newest)
        .select("_key", "_row.*")
    )


def enrich_clusters(
    clusters: DataFrame, pairs: DataFrame, detections: DataFrame, lots: DataFrame
) -> DataFrame:
    """Every cluster row with the latest label of its coin and the lot of its latest detection.

    Label columns carry the prefix ``label_`` so that nothing overlaps with the cluster columns.
    """
    label_fields = [c for c in LABEL_FIELDS if c in pairs.columns]
    labels = latest_per_key(pairs, "coin_id", label_fields).select(
        F.col("_key").alias("_label_key"), *[F.col(c).alias(f"label_{c}") for c in label_fields]
    )
    seen = latest_per_key(detections, "coin_id", ["auction_record_id"]).select(
        F.col("_key").alias("_seen_key"), "auction_record_id"
    )
    lot_fields = {c: n for c, n in LOT_FIELDS.items() if c in lots.columns}
    lot_columns = lots.select(
        F.col("id").alias("_lot_id"), *[F.col(c).alias(n) for c, n in lot_fields.items()]
    )
    # Detections meet their lots first: clusters without a detection then never join on a missing lot.
    seen_lots = seen.join(lot_columns, F.col("auction_record_id") == F.col("_lot_id")).select(
        "_seen_key", *lot_fields.values()
    )
    own = [c for c in clusters.columns if c not in lot_fields.values()]
    key = text_key(F.col("id"))
    return (
        clusters.select(*own)
        .join(labels, key == F.col("_label_key"), "left")
        .join(seen_lots, key == F.col("_seen_key"), "left")
        .drop("_label_key", "_seen_key")
    )


def match_rate(enriched: DataFrame) -> DataFrame:
    matched = F.col("lot_number").isNotNull()
    return enriched.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(matched).alias("matched"),
        (F.avg(matched.cast("int")) * 100).alias("percent"),
    )
