"""Mixing sources to target weights by weighted fair queueing.

The documents of every source queue up in a shuffled order. A document finishes at the virtual time (words of its
source up to and with it) / weight; a source whose words run out starts over, at most ``repeats`` times in all. Served by
finish time until the budget is used up, each source receives words in proportion to its weight, and what
exhausted sources leave is shared by the others. That is the same rule as sharing the excess of capped targets by weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoardline.llm.common import row_key, text_or_empty
from hoardline.session import cut_lineage

REPEATS = 3
SHUFFLE_DIGITS = 4  # of the shuffle key, in hexadecimal: the slices of a source whose sums are added up
ROWS_PER_SLICE = 2_000  # expected in a slice of all sources
WORD = r"[^ \t\n\x0B\f\r]+"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def shuffle_key(seed: str, *columns: str) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
    return F.md5(F.concat_ws("|", F.lit(seed), *parts))


def source_targets(sizes: DataFrame, share: float = 1.0, repeats: int = REPEATS) -> DataFrame:
    """``source, source_size, weight, target`` from one row per source with its ``source_size``.

    Weights are 1, 2, 3, repeating, by code point of the source, null last. The excess of sources above ``repeats``
    times their size is shared again until none is above: sources are capped in the order of size / weight, so the level
    of the rest follows from running sums over that order."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    sizes = sizes.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)
    cap = F.lit(repeats) * F.col("source_size")
    by_cap = Window.orderBy(cap / F.col("weight"), F.col("source").isNull(), "source")
    everything = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    budget = F.sum("source_size").over(everything) * F.lit(share)
    level = (budget - F.coalesce(F.sum(cap).over(before), F.lit(0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    sizes = sizes.withColumn("_level", F.greatest(level, F.lit(0.0))).withColumn("_capped", cap / F.col("weight") <= F.col("_level"))
    # Once a source is not capped, none after it is, and its level is everyone's.
    final = F.min(F.when(~F.col("_capped"), F.struct(cap / F.col("weight"), "_level"))).over(everything)["_level"]
    target = F.when(F.col("_capped"), cap.cast("double")).otherwise(final * F.col("weight"))
    return sizes.select("source", "source_size", "weight", target.alias("target"))


def queued(documents: DataFrame, seed: str, id_column: str = "doc_id") -> DataFrame:
    """``documents`` with ``size``, ``_order`` (shuffle key) and ``_before`` (words of the source in front of the row).

    The running sums are taken in slices of the shuffle order: sums per slice are added up first, so that no source, however
    large, is sorted or summed in one task. Equal keys are ordered by size; equal rows are interchangeable."""
    rows = documents.withColumn("_slice", F.substring("_order", 1, SHUFFLE_DIGITS))
    total = rows.count()
    slices = max(1, -(-total // ROWS_PER_SLICE))
    number = F.conv("_slice", 16, 10).cast("long")
    rows = rows.withColumn("_slice", F.floor(number * F.lit(slices) / F.lit(16**SHUFFLE_DIGITS)))
    sums = rows.groupBy("source", "_slice").agg(F.sum("size").alias("_sum"))
    ahead = Window.partitionBy("source").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("_s"), F.col("_slice").alias("_n"), F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("source", "_slice").orderBy("_order", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows.join(sums, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_slice") == F.col("_n"))).withColumn(
        "_before", F.col("_ahead") + F.col("_inside")
    ).drop("_s", "_n", "_slice", "_ahead", "_inside")


def _last_served(entries: DataFrame, budget: int) -> tuple | None:
    """The key of the last entry that fits the budget when all are served in order.

    A range sort puts the order into partitions; sums per partition tell which of them the budget ends in, and running sums
    within partitions do the rest."""
    key = ["finish", "_order", "size", "_pass"]
    stored = cut_lineage(entries.repartitionByRange(*key).withColumn("_part", F.spark_partition_id()), "mix-served")
    sums = stored.groupBy("_part").agg(F.sum("size").alias("_sum"))  # a row per partition
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_ahead", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)))
    ending = sums.where(F.col("_ahead") <= budget).orderBy(F.desc("_part")).limit(1)
    row = ending.first()
    if row is None:
        return None
    running = F.sum("size").over(Window.partitionBy("_part").orderBy(*key).rowsBetween(Window.unboundedPreceding, 0))
    inside = stored.where(F.col("_part") == row["_part"]).withColumn("_sum", running + F.lit(row["_ahead"]))
    last = inside.where(F.col("_sum") <= budget).agg(F.max(F.struct(*key)).alias("last")).first()["last"]
    if last is None:  # the budget ends with the partition before
        before = stored.where(F.col("_part") < row["_part"])
        last = before.agg(F.max(F.struct(*key)).alias("last")).first()["last"]
    return last


def mix(
    documents: DataFrame,
    share: float = 1.0,
    repeats: int = REPEATS,
    seed: str = "mix",
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """One row per input row: ``doc_id, row, size, source, source_size, target, taken``; ``row`` is a hash of id and text.

    ``size`` counts words (null and empty texts: 0). Sources take part by weight 1, 2, 3, repeating, in the order of
    code points with null last, and share ``share`` of all words. ``taken`` is ``size`` times the number of passes in which
    the row was served, at most ``repeats``. Reruns agree: the order is an MD5 of the seed and the id, and rows
    that share an id are ordered by size; equal rows are interchangeable. An empty table gives no rows. Only one row, the last one
    served, and one sum reach the driver."""
    keyed = documents.withColumn("_id", F.col(id_column).cast("long")).withColumn("_text", text_or_empty(text_column))
    narrow = keyed.select(
        F.col("_id").alias("doc_id"),
        row_key(keyed, "_id", "_text").alias("row"),
        F.col(source_column).cast("string").alias("source"),
        word_count(text_or_empty(text_column)).alias("size"),
    ).withColumn("_order", shuffle_key(seed, "doc_id"))
    narrow = cut_lineage(narrow, "mix-sizes")
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = cut_lineage(source_targets(sizes, share, repeats), "mix-targets")
    named = targets.withColumnRenamed("source", "_source")
    rows = queued(narrow, seed).join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rows = cut_lineage(rows, "mix-queued")
    budget = targets.agg(F.sum("source_size").alias("n")).first()["n"]
    budget = int(budget * share) if budget else 0

    def finish(passed: Column) -> Column:
        done = passed * F.col("source_size") + F.col("_before") + F.col("size")
        return done.cast("double") / F.col("weight")

    entries = rows.where("size > 0").withColumn("_pass", F.explode(F.array(*[F.lit(i) for i in range(repeats)])))
    last = _last_served(entries.select(finish(F.col("_pass")).alias("finish"), "_order", "size", "_pass"), budget)
    if last is None:
        taken = F.lit(0)
    else:
        limit = F.struct(*[F.lit(last[k]).cast(t).alias(k) for k, t in (("finish", "double"), ("_order", "string"), ("size", "long"), ("_pass", "int"))])
        served = [
            F.struct(finish(F.lit(i)).alias("finish"), F.col("_order").alias("_order"), F.col("size").alias("size"), F.lit(i).alias("_pass")) <= limit
            for i in range(repeats)
        ]
        taken = sum(s.cast("long") for s in served) * F.col("size")
    return rows.select("doc_id", "row", "size", "source", "source_size", "target", F.when(F.col("size") > 0, taken).otherwise(0).cast("long").alias("taken"))
