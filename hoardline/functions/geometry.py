"""Geometry of detection boxes and the scores derived from it."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Share of the mean box size that counts as apart, and the confidence of a clear layout.
LAYOUT_SHARE = 0.3
LAYOUT_CONFIDENCE = 0.8


def center(start: Column, size: Column) -> Column:
    return start + size / 2


def pair_layout(first: Column, second: Column) -> Column:
    """``left_right``, ``top_bottom`` or ``ambiguous`` for two boxes (structs x, y, w, h)."""

    def gap(start: str, size: str) -> Column:
        return F.abs(center(first[start], first[size]) - center(second[start], second[size]))

    def reach(size: str) -> Column:
        return (first[size] + second[size]) / 2 * F.lit(LAYOUT_SHARE)

    across, down = gap("x", "w"), gap("y", "h")
    return (
        F.when((across > down) & (across > reach("w")), "left_right")
        .when((down > across) & (down > reach("h")), "top_bottom")
        .otherwise("ambiguous")
    )


def first_box_leads(first: Column, second: Column, layout: Column) -> Column:
    """The first box comes first in the layout's reading order; equal centres keep their order."""
    return (
        F.when(
            layout == "left_right",
            center(first["x"], first["w"]) <= center(second["x"], second["w"]),
        )
        .when(
            layout == "top_bottom",
            center(first["y"], first["h"]) <= center(second["y"], second["h"]),
        )
        .otherwise(F.lit(True))
    )


def box_with_margin(
    x: Column, y: Column, w: Column, h: Column, width: Column, height: Column, ratio: float = 0.12
) -> Column:
    """Box grown by ``ratio`` of its longer side and clamped to the image."""
    margin = F.floor(F.greatest(w, h) * F.lit(ratio))
    left, top = F.greatest(F.lit(0), x - margin), F.greatest(F.lit(0), y - margin)
    right, bottom = F.least(width, x + w + margin), F.least(height, y + h + margin)
    return F.struct(
        left.alias("x"), top.alias("y"), (right - left).alias("w"), (bottom - top).alias("h")
    )


def circularity(area: Column, perimeter: Column) -> Column:
    return F.when(perimeter > 0, F.lit(4 * math.pi) * area / (perimeter * perimeter)).otherwise(0.0)


def solidity(area: Column, hull_area: Column) -> Column:
    return F.when(hull_area > 0, area / hull_area).otherwise(0.0)


def fallback_likelihood(circle: Column, solid: Column) -> Column:
    return 0.5 * circle + 0.3 * solid + 0.2


def edge_likelihood(circle: Column, edges: Column, solid: Column) -> Column:
    return 0.45 * F.least(circle, F.lit(1.0)) + 0.35 * edges + 0.20 * solid


def centered_likelihood(
    circle: Column, edges: Column, solid: Column, centered: Column, area_ratio: Column
) -> Column:
    """Likelihood with a bonus for being central, boosted by the share of the image covered."""
    base = 0.30 * F.least(circle, F.lit(1.0)) + 0.20 * edges + 0.20 * solid + 0.30 * centered
    return base * (1.0 + area_ratio * 3.0)


def shape_class(circle: Column) -> Column:
    return (
        F.when(circle > 0.75, "Round Object (Coin/Medallion)")
        .when(circle > 0.5, "Geometric Form")
        .otherwise("Artifact (Isolated)")
    )


def container(circle: Column) -> Column:
    return F.when(circle > 0.6, "Round_Artifact").otherwise("Unknown")


def two_coin_gate(width: Column, height: Column, blob_w: Column, blob_h: Column) -> Column:
    """Whether a picture may show both sides: wide enough, and its blob neither coin-shaped nor tiny.

    Without a blob the first test alone decides.
    """
    ratio = F.when(blob_h > 0, blob_w / blob_h).otherwise(0.0)
    area = (blob_w * blob_h) / (width * height)
    blob_ok = F.coalesce((ratio >= 1.15) & (area >= 0.06), F.lit(True))
    return (width / height > 1.2) & blob_ok
