"""Exact ranks inside groups of any size.

``row_number() OVER (PARTITION BY g ORDER BY o)`` puts a whole group in one task. Where every row
needs its rank, the operators here cut each group into buckets that follow the requested order, count
the buckets, and add the running count of the earlier buckets to a rank taken inside the bucket.
Where only the first few rows of a group are wanted, :func:`first_rows` keeps the window filter that
Spark evaluates before the shuffle as well as after it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hoardline.session import cut_lineage

HASH_DIGITS = 3  # 16**3 buckets per group


def seeded_order(key: Column | str, seed: int = 42) -> Column:
    """Pseudo-random but repeatable sort key, spelled the same in any SQL engine."""
    column = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("-", column.cast("string"), F.lit(str(seed))))


def or_unmatched(key: Column, usable: Column, unique: Column | str) -> Column:
    """``key`` for a left join where usable, else a text of its own that matches nothing.

    Rows without a usable key would otherwise all be sent to the task of the null or blank key.
    """
    own = F.concat(F.lit("\u0000"), F.col(unique).cast("string") if isinstance(unique, str) else unique)
    return F.when(usable, key).otherwise(own)


def exact_share(size: Column, share: float) -> Column:
    """The whole rows in a decimal ``share`` of ``size``, without binary rounding: 0.7 of 90 is 63."""
    return F.floor(size.cast("decimal(19,0)") * F.lit(Decimal(str(share)))).cast("long")


def spread_row_number(
    df: DataFrame,
    name: str,
    *,
    bucket: Column,
    order: Sequence[Column],
    by: Sequence[str] = (),
    group_size: str | None = None,
) -> DataFrame:
    """Add the 1-based rank ``name`` within ``by``, in the order (``bucket``, ``order``).

    ``bucket`` must be non-decreasing in the wanted order and split big groups finely. Only the bucket
    counts meet in one task; the rows themselves are ranked bucket by bucket.
    """
    by = list(by)
    keyed = df.withColumn("_bucket", bucket)
    counts = keyed.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    columns = [
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_bucket").alias("_by_bucket"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    ]
    if group_size:
        columns.append(F.sum("_rows").over(Window.partitionBy(*by)).alias(group_size))
    offsets = counts.select(*columns)
    local = F.row_number().over(Window.partitionBy(*by, "_bucket").orderBy(*order))
    ranked = keyed.withColumn("_local", local)
    match = F.col("_bucket").eqNullSafe(F.col("_by_bucket"))
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    kept = [*df.columns, *([group_size] if group_size else [])]
    return ranked.join(offsets, match).select(
        *kept, (F.col("_before") + F.col("_local")).cast("long").alias(name)
    )


def seeded_row_number(
    df: DataFrame,
    name: str,
    key: str,
    *,
    by: Sequence[str] = (),
    seed: int = 42,
    group_size: str | None = None,
    digits: int = HASH_DIGITS,
) -> DataFrame:
    """Rank every row in a repeatable random order of ``key`` within ``by``."""
    hashed = df.withColumn("_seeded", seeded_order(key, seed))
    ranked = spread_row_number(
        hashed,
        name,
        bucket=F.substring("_seeded", 1, digits),
        order=[F.col("_seeded"), F.col(key)],
        by=by,
        group_size=group_size,
    )
    return ranked.drop("_seeded")


def seeded_cuts(
    df: DataFrame,
    key: str,
    by: str,
    limits: dict[str, Callable[[Column], Column]],
    *,
    seed: int = 42,
    digits: int = HASH_DIGITS,
) -> DataFrame:
    """Where the seeded order of each group has to be cut, one row per group.

    ``limits`` maps a name to the number of leading rows as a function of the group size. The result
    holds ``_size`` and, per name, the (hash, key) of the last of these rows, null if there is none. A
    row belongs to them exactly if its own (hash, key) is not greater: groups of any size are split by a
    comparison, without sorting or shuffling their rows. Only the key and group columns are read here,
    and only the few hash buckets that hold a cut are ranked. Groups must not be null.
    """
    hashed = df.select(by, key, seeded_order(key, seed).alias("_hash")).withColumn(
        "_bucket", F.substring("_hash", 1, digits)
    )
    counts = hashed.groupBy(by, "_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy(by)
    running = counts.select(
        F.col(by).alias("_by"),
        F.col("_bucket").alias("_by_bucket"),
        (F.sum("_rows").over(group.orderBy("_bucket")) - F.col("_rows")).alias("_before"),
        F.col("_rows"),
        F.sum("_rows").over(group).alias("_size"),
    ).withColumns({f"_n_{name}": limit(F.col("_size")) for name, limit in limits.items()})
    running = cut_lineage(running, "cuts")

    def inside(name: str) -> Column:
        wanted = F.col(f"_n_{name}")
        return (wanted > F.col("_before")) & (wanted <= F.col("_before") + F.col("_rows"))

    edges = running.where(reduce(lambda a, b: a | b, map(inside, limits)))
    local = F.row_number().over(Window.partitionBy(by, "_bucket").orderBy("_hash", key))
    ranked = (
        hashed.join(edges, (F.col(by) == F.col("_by")) & (F.col("_bucket") == F.col("_by_bucket")))
        .withColumn("_rank", F.col("_before") + local)
    )
    cuts = ranked.groupBy("_by").agg(
        *[
            F.max(F.when(F.col("_rank") == F.col(f"_n_{n}"), F.struct("_hash", key))).alias(f"_cut_{n}")
            for n in limits
        ]
    )
    sizes = running.groupBy(F.col("_by").alias("_group")).agg(F.max("_size").alias("_size"))
    joined = sizes.join(cuts, F.col("_group") == F.col("_by"), "left").drop("_by")
    return cut_lineage(joined, "cuts")


def within_cut(name: str, key: str, seed: int = 42) -> Column:
    """Whether a row joined to its group's cuts is among the leading rows called ``name``."""
    own = F.struct(seeded_order(key, seed).alias("_hash"), F.col(key))
    return F.coalesce(own <= F.col(f"_cut_{name}"), F.lit(False))


def sorted_row_number(df: DataFrame, name: str, order: Sequence[Column | str]) -> DataFrame:
    """Rank every row of a table by ``order``, from 1.

    The rows are ranged into partitions that follow the order and stored; each partition ranks its own, and
    the rows in front of it are the summed counts of the partitions before. Only one count per partition is
    brought together, so neither sparse keys nor many rows meet in one task."""
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    stored = cut_lineage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranked")
    counts = sorted((r["_part"], r["n"]) for r in stored.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect())
    before, offsets = 0, []
    for part, n in counts:
        offsets.append((part, before))
        before += n
    starts = df.sparkSession.createDataFrame(offsets, "_of int, _before long")  # a row per partition
    local = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    ranked = stored.withColumn("_local", local).join(F.broadcast(starts), F.col("_part") == F.col("_of"))
    return ranked.select(*df.columns, (F.col("_before") + F.col("_local")).cast("long").alias(name))


def id_row_number(df: DataFrame, name: str, key: str) -> DataFrame:
    """Rank rows by a key of any kind, dense or sparse."""
    return sorted_row_number(df, name, [key])


def first_rows(
    df: DataFrame,
    n: int,
    *,
    by: Sequence[str],
    order: Sequence[Column],
    name: str = "rank",
) -> DataFrame:
    """The first ``n`` rows per group.

    Spark turns the bounded rank filter into a group limit that runs in every map task, so at most
    ``n`` rows per group and task are shuffled, however large the group is.
    """
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)
