"""Pairing of detections into two-sided coins.

A lot needs its number of detections and its first two boxes, never the whole list: the count is a
combinable aggregate and the first two come from a group limit. Detections then meet their lot's one
summary row in a join, which AQE can split when a single lot holds very many of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.functions.geometry import LAYOUT_CONFIDENCE, first_box_leads, pair_layout
from hoardline.operators.catalog import unlinked_detections
from hoardline.operators.mutate import last_changes
from hoardline.operators.ranking import first_rows, id_row_number, spread_row_number
from hoardline.session import cut_lineage

POSITION_SLICE = 10_000_000
REPAIR_CONFIDENCE = 0.9  # fixed value: confidence of a repaired pair


def lot_layouts(detections: DataFrame, order: list[str]) -> DataFrame:
    """Per lot: number of detections, its first two boxes, their layout and sides.

    ``order`` ranks the detections of a lot; the id breaks ties.
    """
    box = F.struct(
        F.col("id"),
        F.col("bbox_x").cast("double").alias("x"),
        F.col("bbox_y").cast("double").alias("y"),
        F.col("bbox_w").cast("double").alias("w"),
        F.col("bbox_h").cast("double").alias("h"),
    )
    ranking = [F.col(c) for c in [*order, "id"]]
    leading = first_rows(detections, 2, by=["auction_record_id"], order=ranking, name="_rank")
    boxes = leading.groupBy("auction_record_id").agg(
        *[F.max(F.when(F.col("_rank") == i, box)).alias(n) for i, n in ((1, "_first"), (2, "_second"))]
    )
    sizes = detections.groupBy("auction_record_id").agg(F.count(F.lit(1)).alias("detections"))
    layout = F.when(
        F.col("_second").isNotNull(), pair_layout(F.col("_first"), F.col("_second"))
    ).otherwise("ambiguous")
    lots = sizes.join(boxes, "auction_record_id").withColumn("layout", layout)
    clear = F.col("layout") != "ambiguous"
    leads = first_box_leads(F.col("_first"), F.col("_second"), F.col("layout"))
    return lots.select(
        "auction_record_id",
        "detections",
        "layout",
        F.when(clear, F.when(leads, F.col("_first.id")).otherwise(F.col("_second.id"))).alias("obverse_id"),
        F.when(clear, F.when(leads, F.col("_second.id")).otherwise(F.col("_first.id"))).alias("reverse_id"),
    )


def _sides(detection_id: Column) -> tuple[Column, Column]:
    side = (
        F.when(detection_id == F.col("obverse_id"), "obverse")
        .when(detection_id == F.col("reverse_id"), "reverse")
        .otherwise("unknown")
    )
    paired = F.coalesce(
        detection_id.isin(F.col("obverse_id"), F.col("reverse_id")), F.lit(False)
    )
    return side, F.when(paired, F.lit(LAYOUT_CONFIDENCE)).otherwise(F.lit(0.0))


def new_coins(lots: DataFrame, coins: DataFrame, method: Column, confidence: Column) -> DataFrame:
    """One coin per lot, numbered after the highest coin id in lot order.

    The lots, one short row each, are stored first: numbering reads them twice, and the detections
    behind them should be read only once.
    """
    numbered = id_row_number(cut_lineage(lots, "lots"), "_number", "auction_record_id")
    last = coins.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return numbered.select(
        (last + F.col("_number")).cast("long").alias("id"),
        "auction_record_id",
        F.lit(0).alias("group_index"),
        method.alias("pairing_method"),
        confidence.alias("pairing_confidence"),
        "detections",
        "obverse_id",
        "reverse_id",
    )


def pair_unlinked(
    detections: DataFrame, coins: DataFrame, min_likelihood: float = 0.5
) -> tuple[DataFrame, DataFrame]:
    """New coins and the detection links for all usable detections without a coin.

    The first two detections of a lot are paired where their layout is clear; all others of the lot
    belong to the same coin with an unknown side.
    """
    loose = unlinked_detections(detections, min_likelihood)
    lots = lot_layouts(loose, ["detection_index"])
    clear = F.col("layout") != "ambiguous"
    created = new_coins(
        lots,
        coins,
        F.when(clear, F.col("layout")).otherwise("spatial"),
        F.when(clear, F.lit(LAYOUT_CONFIDENCE)).otherwise(F.lit(0.0)),
    )
    side, confidence = _sides(F.col("detection_id"))
    links = (
        loose.select(F.col("id").alias("detection_id"), "auction_record_id")
        .join(created.withColumnRenamed("id", "coin_id"), "auction_record_id")
        .select(
            "detection_id",
            "coin_id",
            "auction_record_id",
            side.alias("side"),
            confidence.alias("side_confidence"),
        )
    )
    return created.drop("obverse_id", "reverse_id"), links


def pairing_statistics(new: DataFrame) -> DataFrame:
    """One row of totals over the coins made by :func:`pair_unlinked`."""
    size = F.col("detections")
    return new.agg(
        F.count(F.lit(1)).alias("records_processed"),
        F.count(F.lit(1)).alias("coins_created"),
        F.coalesce(F.sum("detections"), F.lit(0)).alias("detections_linked"),
        F.count_if(size == 2).alias("pairs_assigned"),
        F.count_if(size == 1).alias("singles"),
        F.count_if(size >= 3).alias("multi_detection"),
    )


def link_detections(detections: DataFrame, links: DataFrame) -> DataFrame:
    """Detections with coin, side and side confidence replaced where a link exists; of several links the one to the newest coin counts."""
    changes = last_changes(links, "detection_id", ["coin_id", "side", "side_confidence"], "coin_id")
    linked = F.col("_id").isNotNull()
    joined = detections.join(changes, F.col("id") == F.col("_id"), "left")
    return joined.withColumns(
        {
            "coin_id": F.when(linked, F.col("_coin_id")).otherwise(F.col("coin_id")),
            "side": F.when(linked, F.col("_side")).otherwise(F.col("side")),
            "side_confidence": F.when(linked, F.col("_side_confidence")).otherwise(F.col("side_confidence")),
        }
    ).select(*detections.columns)


def repair_legacy_pairs(
    detections: DataFrame, coins: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Re-pair every lot with exactly two clearly laid-out detections.

    Returns the new coins, the links, and the coin table after adding the new coins and dropping
    those no detection refers to any more.
    """
    lots = lot_layouts(detections, []).where(
        (F.col("detections") == 2) & (F.col("layout") != "ambiguous")
    )
    created = cut_lineage(new_coins(lots, coins, F.lit("spatial"), F.lit(REPAIR_CONFIDENCE)), "coins")
    links = created.select(
        F.col("id").alias("coin_id"),
        "auction_record_id",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.col(f"{side}_id").alias("detection_id"),
                        F.lit(side).alias("side"),
                        F.lit(LAYOUT_CONFIDENCE).alias("side_confidence"),
                    )
                    for side in ("obverse", "reverse")
                ]
            )
        ).alias("link"),
    ).select("link.detection_id", "coin_id", "auction_record_id", "link.side", "link.side_confidence")
    every = coins.unionByName(created.select(*coins.columns))
    return created, links, without_orphans(every, link_detections(detections, links))


def without_orphans(coins: DataFrame, detections: DataFrame) -> DataFrame:
    """Coins that at least one detection refers to."""
    used = detections.where(F.col("coin_id").isNotNull()).select(F.col("coin_id").alias("_used"))
    return coins.join(used, F.col("id") == F.col("_used"), "left_semi")


def sides_by_position(detections: DataFrame) -> DataFrame:
    """Left-to-right index per picture, and obverse/reverse where it shows exactly two coins.

    The index of every box is wanted, so boxes are ranked in slices of equal x position and near ids.
    """
    ranked = spread_row_number(
        detections,
        "_position",
        bucket=F.struct(F.col("bbox_x"), F.floor(F.col("id") / POSITION_SLICE)),
        order=[F.col("id")],
        by=["auction_record_id"],
        group_size="_boxes",
    )
    side = (
        F.when((F.col("_boxes") == 2) & (F.col("_position") == 1), "obverse")
        .when((F.col("_boxes") == 2) & (F.col("_position") == 2), "reverse")
        .otherwise("unknown")
    )
    return ranked.withColumns(
        {"position_index": F.col("_position") - 1, "inferred_side": side}
    ).drop("_position", "_boxes")
