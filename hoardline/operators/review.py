"""Review queue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoardline.operators.ranking import seeded_order

MODES = ("priority", "flagged", "low_confidence", "high_confidence", "random")


def review_queue(dataset: DataFrame, mode: str, limit: int = 1, seed: int = 42) -> DataFrame:
    """The next ``limit`` rows to review.

    ``priority`` flagged rows first, then the least confident; ``flagged`` only flagged ones;
    ``low_confidence`` below 0.7; ``high_confidence`` a random pick above 0.85; ``random`` any
    unverified row. Sorting with a limit keeps only ``limit`` rows per task.
    """
    open_rows = dataset.where(F.col("is_verified") == 0)
    confidence = F.col("label_confidence").asc_nulls_first()
    if mode == "priority":
        picked = open_rows.orderBy(F.desc("needs_review"), confidence, "id")
    elif mode == "flagged":
        picked = dataset.where(F.col("needs_review") == 1).orderBy(confidence, "id")
    elif mode == "low_confidence":
        picked = open_rows.where(F.col("label_confidence") < 0.7).orderBy(confidence, "id")
    elif mode == "high_confidence":
        picked = open_rows.where(F.col("label_confidence") > 0.85).orderBy(seeded_order("id", seed), "id")
    elif mode == "random":
        picked = open_rows.orderBy(seeded_order("id", seed), "id")
    else:
        raise ValueError(f"unknown review mode: {mode}")
    return picked.limit(limit)


def random_sample(df: DataFrame, n: int, key: str = "id", seed: int = 42) -> DataFrame:
    """``n`` rows in a repeatable random order."""
    return df.orderBy(seeded_order(key, seed), key).limit(n)
