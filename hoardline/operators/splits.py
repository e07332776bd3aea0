"""Training-set splits, samples and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.operators.catalog import has_text
from hoardline.operators.ranking import (
    first_rows,
    seeded_cuts,
    seeded_order,
    seeded_row_number,
    sorted_row_number,
    within_cut,
)

GROUP_LIMIT = 1000  # largest rank filter that Spark evaluates before the shuffle


def holdout(size: Column, share: float, least: int) -> Column:
    return F.greatest(F.lit(least), F.floor(size * F.lit(share)))


def split_by_class(
    df: DataFrame,
    label: str,
    key: str,
    *,
    share: float = 0.2,
    least: int = 1,
    min_class: int = 1,
    seed: int = 42,
) -> DataFrame:
    """Hold out ``share`` of each class, at least ``least`` rows; a class of one row stays in training.

    Classes below ``min_class`` rows are left out.
    """
    known = df.where(has_text(label))
    cuts = seeded_cuts(
        known,
        key,
        label,
        {"val": lambda size: F.when(size > 1, holdout(size, share, least)).otherwise(0)},
        seed=seed,
    ).where(F.col("_size") >= min_class)
    split = F.when(within_cut("val", key, seed), "val").otherwise("train")
    joined = known.join(cuts, F.col(label) == F.col("_group"))
    return joined.withColumn("split", split).select(*[c for c in df.columns if c != "split"], "split")


def split_by_identity(
    df: DataFrame, label: str, identity: str, *, share: float = 0.2, seed: int = 42
) -> DataFrame:
    """Hold out identities within each class, so that no identity of a class is on both sides."""
    known = df.where(has_text(label) & F.col(identity).isNotNull())
    identities = split_by_class(
        known.select(label, identity).distinct(), label, identity, share=share, seed=seed
    ).select(F.col(label).alias("_label"), F.col(identity).alias("_identity"), "split")
    return known.join(
        identities, (F.col(label) == F.col("_label")) & (F.col(identity) == F.col("_identity"))
    ).drop("_label", "_identity")


def balanced_sample(
    df: DataFrame, label: str, key: str, cap: int, *, min_class: int = 10, seed: int = 42
) -> DataFrame:
    """Up to ``cap`` random rows of every class with at least ``min_class`` rows."""
    sizes = (
        df.groupBy(F.col(label).alias("_label"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .where(F.col("_size") >= min_class)
    )
    if cap <= GROUP_LIMIT:
        order = [seeded_order(key, seed), F.col(key)]
        picked = first_rows(df, cap, by=[label], order=order, name="_rank")
    else:
        picked = seeded_row_number(df, "_rank", key, by=[label], seed=seed).where(
            F.col("_rank") <= cap
        )
    return picked.join(sizes.select("_label"), F.col(label) == F.col("_label"), "left_semi").drop("_rank")


def head(df: DataFrame, n: int, index: str) -> DataFrame:
    """The first ``n`` rows by manifest index."""
    return df.orderBy(index).limit(n)


def known_subclass(
    df: DataFrame, period: str, field: str, min_class: int = 15
) -> DataFrame:
    """Rows of one period with a known value of ``field`` that at least ``min_class`` rows share."""
    rows = df.where((F.col("period") == period) & has_text(field))
    big = (
        rows.groupBy(F.col(field).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_size"))
        .where(F.col("_size") >= min_class)
    )
    return rows.join(big, F.col(field) == F.col("_value")).drop("_value").withColumnRenamed(
        "_size", "class_size"
    )


def class_weights(df: DataFrame, label: str, cap: float = 10.0) -> DataFrame:
    """Weight ``min(N / (C * n), cap)`` per class."""
    sizes = df.where(has_text(label)).groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    total = sizes.agg(F.sum("rows") / F.count(F.lit(1))).scalar()
    return sizes.withColumn("weight", F.least(total / F.col("rows"), F.lit(float(cap))))


def label_index(df: DataFrame, label: str) -> DataFrame:
    """Alphabetical index from 0 over the distinct labels."""
    labels = df.where(has_text(label)).select(label).distinct()
    ranked = sorted_row_number(labels, "_place", [label])
    return ranked.select(label, (F.col("_place") - 1).alias("label_index"))


def pairs_to_sides(pairs: DataFrame) -> DataFrame:
    """Two rows per pair, one per side."""
    sides = F.array(
        *[
            F.struct(F.lit(side).alias("side"), F.col(column).alias("image_path"))
            for side, column in (("obverse", "obv_path"), ("reverse", "rev_path"))
        ]
    )
    return pairs.select("coin_id", "period", F.explode(sides).alias("s")).select(
        "coin_id", "period", "s.side", "s.image_path"
    )


def canonical_pairs(manifest: DataFrame) -> DataFrame:
    """Path pair, completeness and identity of manifest records of any of the three pair schemas."""
    names = set(manifest.columns)

    def first(*candidates: str) -> Column:
        present = [F.nullif(F.col(c), F.lit("")) for c in candidates if c.split(".")[0] in names]
        return F.coalesce(*present, F.lit(None).cast("string"))

    from hoardline.functions.text import is_set

    obverse = first("obverse.image_path", "obv_path", "obverse_path")
    reverse = first("reverse.image_path", "rev_path", "reverse_path")
    complete = obverse.isNotNull() & reverse.isNotNull()
    for flag in ("has_obv", "has_rev"):
        if flag in names:
            complete = complete & is_set(F.col(flag))
    identity = F.coalesce(
        first("coin_identity"),
        F.col("coin_id").cast("string") if "coin_id" in names else F.lit(None).cast("string"),
        F.concat(F.lit("coin_"), F.col("_manifest_index").cast("string")),
    )
    return manifest.withColumns(
        {
            "pair_obverse": obverse,
            "pair_reverse": reverse,
            "is_complete": complete,
            "pair_identity": identity,
        }
    )


def manifest_kind(pairs: DataFrame) -> DataFrame:
    """``pairs`` if any record has both paths, else ``sides``."""
    both = F.col("pair_obverse").isNotNull() & F.col("pair_reverse").isNotNull()
    return pairs.agg(
        F.when(F.coalesce(F.bool_or(both), F.lit(False)), "pairs").otherwise("sides").alias("kind")
    )
