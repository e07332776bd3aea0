"""Data-quality checks as long-form issues (category, id, details) and one-pass distributions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.functions import vectors
from hoardline.functions.paths import parent_folder
from hoardline.operators.catalog import has_text
from hoardline.operators.ranking import first_rows

METRICS = ("coin_likelihood", "circularity", "solidity", "edge_support")

# How many issues the capped score counts per category.
CAPS = {
    "ORPHAN_DETECTION": 100,
    "DUPLICATE_HASH": 50,
    "INVALID_DETECTION_METRICS": 50,
    "PATH_PERIOD_MISMATCH": 5,
}


def issues(df: DataFrame, category: str, key: Column | str, details: Column) -> DataFrame:
    key = F.col(key) if isinstance(key, str) else key
    return df.select(
        F.lit(category).alias("category"), key.cast("long").alias("id"), details.alias("details")
    )


Check = tuple[str, Column, Column]  # category, condition, details


def findings(rows: DataFrame, checks: list[Check]) -> DataFrame:
    """All findings of row-level checks from one scan: each row makes an array of what was found, which is then opened."""
    found = [F.when(condition, F.struct(F.lit(category).alias("category"), details.alias("details"))) for category, condition, details in checks]
    hit = rows.where(reduce(lambda a, b: a | b, [F.coalesce(condition, F.lit(False)) for _, condition, _ in checks]))
    opened = hit.select(F.col("id").cast("long").alias("id"), F.inline(F.filter(F.array(*found), lambda f: f.isNotNull())))
    return opened.select("category", "id", "details")


def confidence_checks() -> list[Check]:
    """Zero confidence with a period, and no period with a confidence above one half."""
    details = F.concat(F.lit("period="), F.coalesce("period", F.lit("NULL")))
    return [
        ("CONFIDENCE_ZERO_WITH_PERIOD", (F.col("label_confidence") == 0) & has_text("period"), details),
        ("NULL_PERIOD_HIGH_CONFIDENCE", F.col("period").isNull() & (F.col("label_confidence") > 0.5), details),
    ]


def confidence_issues(dataset: DataFrame) -> DataFrame:
    return findings(dataset, confidence_checks())


def with_parent(rows: DataFrame, reference: str, parents: DataFrame) -> DataFrame:
    """``rows`` with ``_parent``: the parent id that ``reference`` names, null if there is none."""
    ids = parents.select(F.col("id").alias("_parent")).distinct()
    return rows.join(ids, F.col(reference) == F.col("_parent"), "left")


def orphan_check(reference: str, category: str) -> Check:
    return category, F.col("_parent").isNull(), F.concat(F.lit(f"missing {reference}="), F.col(reference).cast("string"))


def orphans(rows: DataFrame, reference: str, parents: DataFrame, category: str) -> DataFrame:
    """Rows whose ``reference`` no parent id matches."""
    return findings(with_parent(rows, reference, parents), [orphan_check(reference, category)])


def duplicate_hashes(dataset: DataFrame) -> DataFrame:
    """Size, lowest id and surplus of every hash that occurs more than once."""
    return (
        dataset.where(has_text("image_hash"))
        .groupBy("image_hash")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first_id"))
        .where(F.col("copies") > 1)
        .withColumn("extras", F.col("copies") - 1)
    )


def duplicate_hash_members(dataset: DataFrame) -> DataFrame:
    """All ids of each duplicated hash, one row each rather than one list per hash."""
    sizes = duplicate_hashes(dataset).select(F.col("image_hash").alias("_hash"), "copies", "first_id")
    return dataset.join(sizes, F.col("image_hash") == F.col("_hash")).select(
        "image_hash", "id", "copies", (F.col("id") != F.col("first_id")).alias("is_extra")
    )


def path_period_check() -> Check:
    folder = parent_folder(F.col("image_path"))
    wrong = F.col("period").isNotNull() & (F.col("period") != folder)
    return "PATH_PERIOD_MISMATCH", wrong, F.concat_ws(" / ", folder, F.col("period"))


def path_period_mismatches(dataset: DataFrame) -> DataFrame:
    return dataset.withColumn("path_folder", parent_folder(F.col("image_path"))).where(path_period_check()[1])


def path_period_counts(dataset: DataFrame) -> DataFrame:
    return path_period_mismatches(dataset).groupBy("path_folder", "period").agg(
        F.count(F.lit(1)).alias("rows")
    )


def metric_check() -> Check:
    outside = reduce(lambda a, b: a | b, [(F.col(m) < 0) | (F.col(m) > 1) for m in METRICS])
    return "INVALID_DETECTION_METRICS", outside, F.lit("score outside 0..1")


def metric_issues(detections: DataFrame) -> DataFrame:
    """Detections with a score outside 0..1."""
    return findings(detections, [metric_check()])


def flag_check() -> Check:
    both = (F.col("needs_review") == 1) & (F.col("is_verified") == 1)
    return "CONFLICTING_FLAGS", both, F.lit("needs_review and is_verified")


def flag_issues(dataset: DataFrame) -> DataFrame:
    return findings(dataset, [flag_check()])


def bucket_counts(df: DataFrame, value: str, edges: list[tuple[float, str]], last: str) -> DataFrame:
    """Rows per named bucket: exactly zero, below each edge, and the rest."""
    bucket = F.when(F.col(value) == 0, "zero")
    for edge, name in edges:
        bucket = bucket.when(F.col(value) < edge, name)
    return df.groupBy(bucket.otherwise(last).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))


def confidence_buckets(dataset: DataFrame) -> DataFrame:
    return bucket_counts(
        dataset, "label_confidence", [(0.6, "low"), (0.8, "medium"), (0.95, "high")], "very_high"
    )


def edge_support_buckets(detections: DataFrame) -> DataFrame:
    return bucket_counts(
        detections, "edge_support", [(0.2, "very_low"), (0.5, "low"), (0.8, "medium")], "high"
    )


def flag_contingency(dataset: DataFrame) -> DataFrame:
    return dataset.groupBy("needs_review", "is_verified").agg(F.count(F.lit(1)).alias("rows"))


def missing_files(rows: DataFrame, listing: DataFrame, roots: list[str]) -> DataFrame:
    """``rows`` with ``found``: whether the picture is listed under any of the candidate roots.

    Candidates are looked up in the listing by equality; a row has as many as there are roots.
    """
    path = F.col("image_path")
    relative = F.array(*[F.concat(F.lit(r), path) if r else path for r in roots])
    candidates = rows.select(
        "id", F.explode(F.when(path.startswith("/"), F.array(path)).otherwise(relative)).alias("_file")
    )
    files = listing.select(F.col("path").alias("_listed")).distinct()
    hits = candidates.join(files, F.col("_file") == F.col("_listed"), "left_semi")
    found = hits.select(F.col("id").alias("_found")).distinct()
    return (
        rows.join(found, F.col("id") == F.col("_found"), "left")
        .withColumn("found", F.col("_found").isNotNull())
        .drop("_found")
    )


def all_issues(dataset: DataFrame, detections: DataFrame, lots: DataFrame) -> DataFrame:
    """The union of all checks: one scan of each table for its row-level checks, one more of the dataset for repeated hashes."""
    repeated = F.concat(F.lit("copies="), F.col("copies").cast("string"))
    checks = [
        findings(
            with_parent(dataset, "coin_detection_id", detections),
            [*confidence_checks(), orphan_check("coin_detection_id", "ORPHAN_ML_DATASET"), path_period_check(), flag_check()],
        ),
        findings(with_parent(detections, "auction_record_id", lots), [orphan_check("auction_record_id", "ORPHAN_DETECTION"), metric_check()]),
        issues(duplicate_hashes(dataset), "DUPLICATE_HASH", "first_id", repeated),
    ]
    return reduce(DataFrame.unionByName, checks)


def issue_report(found: DataFrame, caps: bool = False) -> DataFrame:
    """Issues per category, the total, and the health score ``max(0, 100 - total)``.

    ``caps`` counts no more per category than the capped score does.
    """
    counts = found.groupBy("category").agg(F.count(F.lit(1)).alias("issues"))
    if caps:
        limit = F.coalesce(*[F.when(F.col("category") == c, F.lit(n)) for c, n in CAPS.items()])
        counts = counts.withColumn("issues", F.least("issues", limit.cast("long")))
    total = counts.agg(F.coalesce(F.sum("issues"), F.lit(0))).scalar()
    return counts.withColumn("total_issues", total.cast("long")).withColumn(
        "health", F.greatest(F.lit(0), 100 - F.col("total_issues"))
    )


def issue_samples(found: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` issues of each category, by id."""
    return first_rows(
        found, n, by=["category"], order=[F.col("id"), F.col("details")], name="position"
    )


def readiness_funnel(lots: DataFrame, found: Column, label: Column) -> DataFrame:
    """Lots that pass each further condition: has path, file found, label found."""
    has_path = has_text("image_path")
    found_file = has_path & found
    ready = found_file & label.isNotNull()
    return lots.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(has_path).alias("with_path"),
        F.count_if(has_path & ~found).alias("missing_files"),
        F.count_if(found_file & label.isNull()).alias("unlabelled"),
        F.count_if(ready).alias("ready"),
    )


def null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of nulls per column; one pass, long form."""
    rates = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_rate")) for c in columns]
    )
    return rates.select(F.explode(pairs).alias("r")).select("r.column_name", "r.null_rate")


def coverage_checks(df: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Non-null share of each column against its required share."""
    required = F.coalesce(
        *[F.when(F.col("column_name") == c, F.lit(t)) for c, t in thresholds.items()]
    )
    return null_rates(df, list(thresholds)).select(
        "column_name",
        (1 - F.col("null_rate")).alias("coverage"),
        (1 - F.col("null_rate") >= required).alias("passed"),
    )


def vector_quality(df: DataFrame, vector: str, dimension: int) -> DataFrame:
    """Rows per outcome of the vector checks: dimension, finite values, norm within 0.99..1.01."""
    checked = df.select(
        (F.size(vector) == dimension).alias("dimension_ok"),
        vectors.is_finite(F.col(vector)).alias("finite"),
        vectors.norm(F.col(vector)).alias("length"),
    )
    return checked.agg(
        F.count(F.lit(1)).alias("vectors"),
        F.count_if(~F.col("dimension_ok")).alias("wrong_dimension"),
        F.count_if(~F.col("finite")).alias("not_finite"),
        F.count_if(~F.col("length").between(0.99, 1.01) | F.isnan("length")).alias("bad_norm"),
    )


def alignment(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Whether two tables agree on their keys: rows, keys on one side only, repeated keys.

    Keys are reduced to counts on each side before they meet.
    """

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(key).alias(f"_{name}_key")).agg(F.count(F.lit(1)).alias(name))

    both = counted(left, "l").join(
        counted(right, "r"), F.col("_l_key") == F.col("_r_key"), "full_outer"
    )
    return both.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows"),
        F.count_if(F.col("r").isNull()).alias("left_only"),
        F.count_if(F.col("l").isNull()).alias("right_only"),
        F.count_if(F.col("l") > 1).alias("left_repeated"),
        F.count_if(F.col("r") > 1).alias("right_repeated"),
    )
