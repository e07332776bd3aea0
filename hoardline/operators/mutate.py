"""Changes to tables, as functions from a table and its changes to the next version of the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.functions.paths import canonical_raw_key, cluster_key, cluster_label
from hoardline.functions.text import blank_to_null
from hoardline.operators.catalog import has_text
from hoardline.operators.ranking import id_row_number, or_unmatched
from hoardline.session import cut_lineage


def _marked(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """``df`` with ``_hit`` true where its key is among ``ids``.

    The ids are stored first. Spark then knows their size, and a short list of changes is broadcast
    instead of shuffling the whole table.
    """
    hits = cut_lineage(ids.select(F.col(key).alias("_hit_key")).distinct(), "changes")
    return df.join(hits, F.col(key) == F.col("_hit_key"), "left").withColumn(
        "_hit", F.col("_hit_key").isNotNull()
    )


def update_by_id(df: DataFrame, ids: DataFrame, changes: dict[str, Column], key: str = "id") -> DataFrame:
    """Set ``changes`` on the rows whose key is among ``ids``."""
    marked = _marked(df, ids, key)
    return marked.withColumns(
        {c: F.when(F.col("_hit"), v).otherwise(F.col(c)) for c, v in changes.items()}
    ).select(*df.columns)


def last_changes(changes: DataFrame, key: str, columns: list[str], order: str) -> DataFrame:
    """One row per key: ``_id`` and ``_<column>`` of the last change by ``order``, ties by their values."""
    rank = F.struct(F.col(order).alias("_rank"), *[F.col(c).alias(f"_tie_{c}") for c in columns])
    values = F.struct(*[F.col(c).alias(f"_{c}") for c in columns])
    last = changes.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_id")).agg(F.max_by(values, rank).alias("_last"))
    return last.select("_id", "_last.*")


def mark_processed(lots: DataFrame, ids: DataFrame) -> DataFrame:
    return update_by_id(lots, ids, {"vision_processed": F.lit(1)})


def set_lot_metadata(lots: DataFrame, metadata: DataFrame, order: str) -> DataFrame:
    """Site and sale taken from ``metadata`` (id, site, sale_id) where present there; of several rows for a lot the last by ``order`` counts."""
    new = last_changes(metadata, "id", ["site", "sale_id"], order)
    found = F.col("_id").isNotNull()
    return (
        lots.join(new, F.col("id") == F.col("_id"), "left")
        .withColumns(
            {
                "site": F.when(found, F.col("_site")).otherwise(F.col("site")),
                "sale_id": F.when(found, F.col("_sale_id")).otherwise(F.col("sale_id")),
            }
        )
        .select(*lots.columns)
    )


def push_clusters(dataset: DataFrame, clusters: DataFrame) -> DataFrame:
    """Cluster id and name written to the dataset rows with the same picture path."""
    new = (
        clusters.groupBy(F.col("image_path").alias("_path"))
        .agg(F.max("cluster_id").alias("_cluster"))
    )
    found = F.col("_path").isNotNull()
    return (
        dataset.join(new, F.col("image_path") == F.col("_path"), "left")
        .withColumns(
            {
                "visual_cluster_id": F.when(found, cluster_key(F.col("_cluster"))).otherwise(
                    F.col("visual_cluster_id")
                ),
                "visual_cluster_name": F.when(found, cluster_label(F.col("_cluster"))),
            }
        )
        .drop("_path", "_cluster")
    )


def exclude(dataset: DataFrame, condition: Column, reason: str) -> DataFrame:
    """Deactivate rows and record why."""
    return dataset.withColumns(
        {
            "exclude_reason": F.when(condition, F.lit(reason)).otherwise(F.col("exclude_reason")),
            "is_active": F.when(condition, F.lit(0)).otherwise(F.col("is_active")),
        }
    )


def exclude_matching(dataset: DataFrame, pattern: Column, reason: str) -> DataFrame:
    """Deactivate still active, reasonless rows for which a text pattern was found."""
    condition = (
        (F.col("is_active") == 1) & F.col("exclude_reason").isNull() & F.col("_pattern").isNotNull()
    )
    return exclude(dataset.withColumn("_pattern", pattern), condition, reason).drop("_pattern")


def apply_decisions(dataset: DataFrame, decisions: DataFrame, order: str) -> DataFrame:
    """Review decisions in the order of a column, as if they were made one by one: rows become verified; a period is taken
    unless blank, and a subperiod unless missing (blank clears it), so that an earlier period stays when a later decision
    leaves it blank. Rows decided as ``delete`` go away, whatever else was decided for them. Decisions at the same place
    count by value; a missing place comes first."""

    def last(column: str, given: Column) -> Column:
        place = F.struct(F.col(order).alias("_place"), F.col(column).alias("_value"))
        return F.max(F.when(given, place))["_value"].alias(f"_{column}")

    new = decisions.where(F.col("id").isNotNull()).groupBy(F.col("id").alias("_id")).agg(
        F.bool_or(F.coalesce(F.col("action") == "delete", F.lit(False))).alias("_delete"),
        last("period", blank_to_null(F.col("period")).isNotNull()),
        last("subperiod", F.col("subperiod").isNotNull()),
    )
    joined = dataset.join(new, F.col("id") == F.col("_id"), "left").where(~F.coalesce(F.col("_delete"), F.lit(False)))
    decided = F.col("_id").isNotNull()
    return joined.withColumns(
        {
            "period": F.coalesce(F.col("_period"), F.col("period")),
            "subperiod": F.coalesce(F.col("_subperiod"), F.col("subperiod")),
            "needs_review": F.when(decided, F.lit(0)).otherwise(F.col("needs_review")),
            "is_verified": F.when(decided, F.lit(1)).otherwise(F.col("is_verified")),
        }
    ).select(*dataset.columns)


def integrity_fixes(dataset: DataFrame) -> DataFrame:
    """The three repairs in order; ``fix_1`` to ``fix_3`` tell which of them touched a row."""
    first = (F.col("needs_review") == 1) & (F.col("is_verified") == 1)
    step = dataset.withColumn("fix_1", first).withColumn(
        "needs_review", F.when(F.col("fix_1"), F.lit(0)).otherwise(F.col("needs_review"))
    )
    second = F.col("period").isNull() & (F.col("is_verified") == 0)
    step = step.withColumn("fix_2", second).withColumn(
        "needs_review", F.when(F.col("fix_2"), F.lit(1)).otherwise(F.col("needs_review"))
    )
    third = F.col("period").isNull() & (F.col("label_confidence") > 0.5)
    return step.withColumn("fix_3", third).withColumn(
        "label_confidence", F.when(F.col("fix_3"), F.lit(0.3)).otherwise(F.col("label_confidence"))
    )


def fix_counts(fixed: DataFrame) -> DataFrame:
    counts = [F.count_if(f"fix_{i}").alias(f"fix_{i}") for i in (1, 2, 3)]
    return fixed.agg(*counts).withColumn("fixes_applied", F.expr("fix_1 + fix_2 + fix_3"))


def migrate_paths(lots: DataFrame, listing: DataFrame, *, owner: str | None = None) -> DataFrame:
    """Legacy picture paths turned into canonical keys where the file is listed.

    ``migration`` is null for rows out of scope, else ``skipped``, ``missing`` or ``migrated``. Several lots may name one path:
    with ``owner``, a lot's key that the listing has too, a file counts only for the lot it was stored for.
    """
    in_scope = has_text("image_path") & ~F.col("image_path").startswith("raw/")
    owned = [F.col(owner).alias("_owner")] if owner else []
    files = listing.select(F.col("path").alias("_file"), *owned).distinct()
    keyed = lots.withColumns(
        {
            "_key": F.when(in_scope, canonical_raw_key(F.col("image_path"))),
        }
    ).withColumn(
        "_name",
        or_unmatched(F.ltrim(F.trim("image_path"), F.lit("./")), F.col("_key").isNotNull(), "id"),
    )
    same = F.col("_name") == F.col("_file")
    if owner:
        same &= F.col(owner) == F.col("_owner")
    joined = keyed.join(files, same, "left")
    outcome = F.when(
        in_scope,
        F.when(F.col("_key").isNull(), "skipped")
        .when(F.col("_file").isNull(), "missing")
        .otherwise("migrated"),
    )
    return (
        joined.withColumn("migration", outcome)
        .withColumn(
            "image_path",
            F.when(F.col("migration") == "migrated", F.col("_key")).otherwise(F.col("image_path")),
        )
        .select(*lots.columns, "migration")
    )


def append_with_keys(target: DataFrame, rows: DataFrame, order_key: str, key: str = "id") -> DataFrame:
    """Rows given consecutive keys after the target's highest one, in the order of an integer column."""
    numbered = id_row_number(rows, "_number", order_key)
    last = target.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    return numbered.withColumn(key, (last + F.col("_number")).cast("long")).drop("_number")
