"""Catalogue statistics: counts that combine in every map task before they are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.operators.catalog import has_text


def counts(df: DataFrame, *keys: Column | str, name: str = "rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def split_counts(dataset: DataFrame) -> DataFrame:
    return counts(dataset, "split")


def period_distribution(dataset: DataFrame) -> DataFrame:
    return counts(dataset.where(has_text("period")), "period").orderBy(F.desc("rows"), "period")


def pair_totals(pairs: DataFrame) -> DataFrame:
    """Non-duplicate pairs by available side, and the number of duplicates; one pass."""
    fresh = F.col("is_duplicate") == 0
    obverse, reverse = F.col("has_obv"), F.col("has_rev")
    return pairs.agg(
        F.count_if(fresh & (obverse == 1) & (reverse == 1)).alias("both_sides"),
        F.count_if(fresh & (obverse == 1) & (reverse == 0)).alias("obv_only"),
        F.count_if(fresh & (obverse == 0) & (reverse == 1)).alias("rev_only"),
        F.count_if(fresh).alias("total"),
        F.count_if(F.col("is_duplicate") == 1).alias("duplicates_tracked"),
    )


def dataset_totals(dataset: DataFrame) -> DataFrame:
    return dataset.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("needs_review") == 1).alias("flagged"),
        F.count_if(F.col("is_verified") == 1).alias("verified"),
        F.count_if(F.col("is_verified") == 0).alias("unverified"),
    )


def catalogue_totals(lots: DataFrame, detections: DataFrame, dataset: DataFrame) -> DataFrame:
    """Size and processed share of the main tables, long form."""
    parts = [
        lots.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("lots").alias("item"), "rows"),
        lots.agg(F.count_if(F.col("vision_processed") == 1).alias("rows")).select(
            F.lit("lots_processed").alias("item"), "rows"
        ),
        detections.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit("detections").alias("item"), "rows"
        ),
        dataset.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("dataset").alias("item"), "rows"),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def side_status(coins: DataFrame, detections: DataFrame) -> DataFrame:
    """Coins with both, one or no known side; detections are counted per coin before the join."""
    sides = detections.where(F.col("coin_id").isNotNull()).groupBy("coin_id").agg(
        F.count_if(F.col("side") == "obverse").alias("obverses"),
        F.count_if(F.col("side") == "reverse").alias("reverses"),
    )
    status = (
        F.when((F.col("obverses") > 0) & (F.col("reverses") > 0), "both_sides")
        .when(F.col("obverses") > 0, "obverse_only")
        .when(F.col("reverses") > 0, "reverse_only")
        .otherwise("unknown_only")
    )
    joined = coins.select("id").join(sides, F.col("id") == F.col("coin_id"), "left")
    return counts(joined, status.alias("side_status"), name="coins")


def pairing_methods(coins: DataFrame) -> DataFrame:
    method = F.coalesce(F.nullif(F.col("pairing_method"), F.lit("")), F.lit("null"))
    return counts(coins, method.alias("pairing_method"), name="coins")


def two_detection_lots(detections: DataFrame) -> DataFrame:
    return counts(detections, "auction_record_id", name="detections").where(F.col("detections") == 2)


def distributions(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Several value counts in one pass: (field, value, rows), nulls left out."""
    facts = F.array(
        *[F.struct(F.lit(n).alias("field"), c.cast("string").alias("value")) for n, c in columns.items()]
    )
    exploded = df.select(F.explode(facts).alias("fact")).select("fact.field", "fact.value")
    return counts(exploded.where(F.col("value").isNotNull()), "field", "value")


def filter_options(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-blank values per column, for drop-down filters."""
    found = distributions(df, {c: F.col(c) for c in columns}).where(F.col("value") != "")
    return found.select("field", "value").orderBy("field", "value")


def corpus_statistics(clusters: DataFrame, vector: str = "embedding") -> DataFrame:
    """Corpus size, vector dimension and the three distributions of the search corpus, long form."""
    facts = {
        "total": F.lit("rows"),
        "dimension": F.size(vector),
        "period": F.col("parser_period"),
        "denomination": F.col("denomination"),
        "auction_house": F.col("auction_house"),
    }
    return distributions(clusters, facts)


def exclusion_report(dataset: DataFrame) -> DataFrame:
    """Totals with percentages, rows by reason, and active rows by period; one pass, long form."""
    active = F.col("is_active") == 1
    facts = {
        "state": F.when(active, "active").otherwise("excluded"),
        "reason": F.coalesce("exclude_reason", F.lit("active")),
        "active_period": F.when(active, F.coalesce("period", F.lit("null"))),
    }
    found = distributions(dataset, facts)
    total = dataset.agg(F.count(F.lit(1))).scalar()
    return found.withColumn("percent", 100.0 * F.col("rows") / total)
