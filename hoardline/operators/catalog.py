"""Catalogue reads: batches, lookups, orders and scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: sides in review order; any other side sorts before them.
SIDE_ORDER = ("obverse", "reverse", "unknown")


def has_text(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def unprocessed_batch(lots: DataFrame, limit: int = 100) -> DataFrame:
    """The next ``limit`` lots with a picture that the detector has not seen, by id."""
    waiting = lots.where((F.col("vision_processed") == 0) & has_text("image_path"))
    return waiting.orderBy("id").limit(limit)


def with_record_defaults(lots: DataFrame) -> DataFrame:
    """Nulls replaced by the defaults of an auction record."""
    return lots.select(
        *[
            F.coalesce(F.col(f.name), F.lit("")).alias(f.name)
            if f.dataType.typeName() == "string"
            else F.col(f.name)
            for f in lots.schema.fields
        ]
    )


def record_by_id(lots: DataFrame, record_id: int) -> DataFrame:
    return with_record_defaults(lots.where(F.col("id") == record_id))


def coins_of_record(coins: DataFrame, record_id: int) -> DataFrame:
    return coins.where(F.col("auction_record_id") == record_id).orderBy("group_index")


def side_rank(side: Column) -> Column:
    ranks = [F.when(side == name, F.lit(i + 1)) for i, name in enumerate(SIDE_ORDER)]
    return F.coalesce(*ranks, F.lit(0))


def by_side(detections: DataFrame) -> DataFrame:
    """Detections of each coin ordered by side, newest first.

    The order runs over (coin, side, id), so a coin with very many detections is spread over tasks.
    """
    return detections.orderBy("coin_id", side_rank(F.col("side")), F.col("id").desc())


def unlinked_detections(detections: DataFrame, min_likelihood: float = 0.5) -> DataFrame:
    """Usable detections without a coin."""
    return detections.where(
        F.col("coin_id").isNull()
        & (F.col("coin_likelihood") >= min_likelihood)
        & has_text("normalized_path")
    )


def active_dataset(dataset: DataFrame) -> DataFrame:
    return dataset.where((F.col("is_active") == 1) & has_text("image_path"))


def paired_dataset(pairs: DataFrame) -> DataFrame:
    """Non-duplicates with both sides, both paths and a period; missing side flags count as set."""
    return pairs.where(
        (F.col("is_duplicate") == 0)
        & (F.coalesce("has_obv", F.lit(1)) == 1)
        & (F.coalesce("has_rev", F.lit(1)) == 1)
        & has_text("obv_path")
        & has_text("rev_path")
        & has_text("period")
    )
