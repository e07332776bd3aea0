"""Paired and single-side exports: best detection per side, lot ranges, missing sides, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.functions.text import blank_to_null, resolved_period, safe_int, whole_number
from hoardline.operators.catalog import has_text
from hoardline.operators.ranking import exact_share, seeded_cuts, sorted_row_number, within_cut

SIDES = {"obverse": "obv", "reverse": "rev", "unknown": "unk"}
LEVEL_BITS = 5  # a block of one level is 32 of the level below
LEVELS = 13  # enough for 64 bits


def best_detection_per_side(
    detections: DataFrame, min_likelihood: float = 0.5, skip_blank_paths: bool = True
) -> DataFrame:
    """One row per coin with its best obverse, reverse and unknown detection.

    Best is the highest side confidence (missing counts as 0), then the newest. One aggregate with
    map-side combining does the ranking and the pivot, so no coin is ever gathered in a task.
    """
    path_ok = has_text("normalized_path") if skip_blank_paths else F.col("normalized_path").isNotNull()
    usable = detections.where(path_ok & (F.col("coin_likelihood") >= min_likelihood))
    candidate = F.struct(
        F.coalesce("side_confidence", F.lit(0.0)).alias("order_confidence"),
        F.col("id"),
        F.col("normalized_path"),
        F.col("coin_likelihood"),
        F.col("side_confidence"),
    )
    best = usable.where(F.col("coin_id").isNotNull() & F.col("side").isin(*SIDES)).groupBy("coin_id").agg(
        *[
            F.max(F.when(F.col("side") == side, candidate)).alias(short)
            for side, short in SIDES.items()
        ]
    )
    columns = []
    for short in SIDES.values():
        columns += [
            F.col(f"{short}.id").alias(f"{short}_detection_id"),
            F.col(f"{short}.normalized_path").alias(f"{short}_path"),
            F.col(f"{short}.coin_likelihood").alias(f"{short}_likelihood"),
            F.col(f"{short}.side_confidence").alias(f"{short}_side_confidence"),
        ]
    return best.select("coin_id", *columns)


def range_pieces(start: Column, end: Column) -> Column:
    """``[start, end]`` as blocks of ``(level, block)``: block b of level n holds the numbers from b * 32**n up to the next block.

    On every level it takes the blocks that lie in the range and in no larger block that does, so there are
    at most 62 on a level, and one level more for a range 32 times as long."""

    def inside(level: int) -> tuple[Column, Column]:  # first and last whole block of a level
        bits = level * LEVEL_BITS
        mask = F.lit((1 << bits) - 1).cast("long")
        complete = end.bitwiseAND(mask) == mask
        return -F.shiftright(-start, bits), F.shiftright(end, bits) - F.when(complete, 0).otherwise(1)

    nothing = F.array().cast("array<struct<level:int,block:bigint>>")

    def run(level: int, first: Column, last: Column) -> Column:
        blocks = F.transform(F.sequence(first, last), lambda b: F.struct(F.lit(level).alias("level"), b.alias("block")))
        return F.when(first <= last, blocks).otherwise(nothing)

    levels = []
    for level in range(LEVELS):
        first, last = inside(level)
        if level == LEVELS - 1:
            levels.append(run(level, first, last))
            continue
        above_first, above_last = inside(level + 1)
        some = above_first <= above_last
        levels.append(run(level, first, F.when(some, F.shiftleft(above_first, LEVEL_BITS) - 1).otherwise(last)))
        covered = F.shiftleft(above_last, LEVEL_BITS) + ((1 << LEVEL_BITS) - 1)
        levels.append(F.when(some & (covered < last), run(level, covered + 1, last)).otherwise(nothing))
    return F.concat(*levels)


def with_lot_range(
    lots: DataFrame, ranges: DataFrame, *, first_range_only: bool = False, ignore_case: bool = False
) -> DataFrame:
    """Left join of lots to the lot ranges of their sale (house, sale, lot between start and end).

    Ranges are cut into blocks of 32**n lots (:func:`range_pieces`), a few dozen for a range of any length, and every lot
    number that occurs in a sale is looked up by its block on each level that some range uses: an equality join
    on (house, sale, level, block) of the numbers alone. Lots then join what their number found. A
    lot within several ranges yields several rows, unless ``first_range_only`` keeps the range that starts (then ends) first.
    """

    def key(column: str) -> Column:
        return F.lower(column) if ignore_case else F.col(column)

    lot = safe_lot(F.col("lot_number"))
    # Lots without a number match nothing; a hash keeps them from sharing one key per sale.
    spread = F.coalesce(lot, -1 - F.pmod(F.xxhash64("lot_number"), F.lit(1 << 20)))
    left = lots.withColumns({"_lot": lot, "_spread": spread, "_own_house": key("auction_house"), "_own_sale": key("sale_id")})
    valid = ranges.where(F.col("lot_start") <= F.col("lot_end")).select(
        key("auction_house").alias("_house"),
        key("sale_id").alias("_sale"),
        F.col("lot_start").cast("long").alias("_start"),
        F.col("lot_end").cast("long").alias("_end"),
        F.col("period").alias("auction_period"),
        F.col("auction_house").alias("range_house"),
    )
    pieces = valid.select("*", F.explode(range_pieces(F.col("_start"), F.col("_end"))).alias("_p")).select("*", "_p.level", "_p.block").drop("_p")
    numbers = left.where("_lot IS NOT NULL AND _own_house IS NOT NULL AND _own_sale IS NOT NULL")
    numbers = numbers.select(F.col("_own_house").alias("_house"), F.col("_own_sale").alias("_sale"), F.col("_lot").alias("_number")).distinct()
    used = pieces.agg(F.collect_set("level")).scalar()  # one row: at most LEVELS numbers
    probes = numbers.withColumn("_levels", used).select(
        "_house", "_sale", "_number", F.explode(F.expr(f"transform(_levels, n -> struct(n AS level, shiftright(_number, n * {LEVEL_BITS}) AS block))")).alias("_p")
    ).select("_house", "_sale", "_number", "_p.level", "_p.block")
    hits = probes.join(pieces, ["_house", "_sale", "level", "block"])
    if first_range_only:
        first = F.min_by(F.struct("auction_period", "range_house"), F.struct("_start", "_end"))
        hits = hits.groupBy("_house", "_sale", "_number").agg(first.alias("_first")).select("_house", "_sale", "_number", "_first.*")
    hits = hits.select("_house", "_sale", "_number", "auction_period", "range_house")
    joined = left.join(
        hits,
        (F.col("_own_house") == F.col("_house")) & (F.col("_own_sale") == F.col("_sale")) & (F.col("_spread") == F.col("_number")) & F.col("_lot").isNotNull(),
        "left",
    )
    return joined.select(*lots.columns, "auction_period", "range_house")


def safe_lot(lot: Column) -> Column:
    """Lot number as an integer, null if it is not one."""
    return whole_number(lot)


def exportable_coins(
    coins: DataFrame,
    lots: DataFrame,
    ranges: DataFrame,
    detections: DataFrame,
    exported: DataFrame,
    min_likelihood: float = 0.5,
    skip_blank_paths: bool = True,
) -> DataFrame:
    """Coins with at least one usable side that no non-duplicate export row covers yet."""
    sides = best_detection_per_side(detections, min_likelihood, skip_blank_paths)
    done = exported.where(F.col("is_duplicate") == 0).select(F.col("coin_id").alias("_done"))
    fresh = coins.join(done, F.col("id") == F.col("_done"), "left_anti").select(
        F.col("id").alias("coin_id"), "auction_record_id", "pairing_method", "pairing_confidence"
    )
    ranged = with_lot_range(
        lots.select(
            F.col("id").alias("lot_id"), "title", "description", "site", "auction_house", "sale_id",
            "lot_number",
        ),
        ranges,
    )
    return (
        fresh.join(sides, "coin_id")
        .join(ranged, F.col("auction_record_id") == F.col("lot_id"))
        .withColumn("auction_house", F.coalesce("range_house", "site"))
        .drop("lot_id", "range_house")
    )


def exportable_detections(
    detections: DataFrame,
    lots: DataFrame,
    ranges: DataFrame,
    exported: DataFrame,
    min_likelihood: float = 0.5,
) -> DataFrame:
    """Usable detections whose id no dataset row refers to, with their lot and its range period."""
    usable = detections.where(
        (F.col("coin_likelihood") >= min_likelihood) & F.col("normalized_path").isNotNull()
    )
    done = exported.select(F.col("coin_detection_id").alias("_done"))
    ranged = with_lot_range(
        lots.select(
            F.col("id").alias("lot_id"), "title", "description", "site", "auction_house", "sale_id",
            "lot_number",
        ),
        ranges,
    )
    return (
        usable.join(done, F.col("id") == F.col("_done"), "left_anti")
        .join(ranged, F.col("auction_record_id") == F.col("lot_id"))
        .withColumnRenamed("auction_period", "period")
        .drop("lot_id", "range_house")
    )


def side_category() -> Column:
    """``both``, ``obv_only``, ``rev_only``, ``unknown_only`` or null for a coin without paths."""
    obverse, reverse, unknown = (
        F.coalesce(blank_to_null(F.col(f"{s}_path")), F.lit("")) != "" for s in SIDES.values()
    )
    return (
        F.when(obverse & reverse, "both")
        .when(obverse, "obv_only")
        .when(reverse, "rev_only")
        .when(unknown, "unknown_only")
    )


def apply_missing_side_rule(
    coins: DataFrame, rule: str = "skip", placeholder: str | None = None
) -> DataFrame:
    """Final side paths under ``skip``, ``duplicate`` or ``placeholder``, plus the side category."""
    if rule not in ("skip", "duplicate", "placeholder"):
        raise ValueError(f"unknown missing-side rule: {rule}")
    if rule == "placeholder" and not placeholder:
        raise ValueError("the placeholder rule needs a placeholder path")
    sorted_coins = coins.withColumn("side_category", side_category()).where(
        F.col("side_category").isNotNull()
    )
    category = F.col("side_category")
    flagged = sorted_coins.withColumns(
        {
            "has_obv": category.isin("both", "obv_only"),
            "has_rev": category.isin("both", "rev_only"),
        }
    )
    if rule == "skip":
        return flagged.where(category == "both")
    known = F.coalesce(
        F.when(category == "obv_only", F.col("obv_path")),
        F.when(category == "rev_only", F.col("rev_path")),
        F.when(category == "unknown_only", F.col("unk_path")),
    )
    filler = known if rule == "duplicate" else F.lit(placeholder)
    return flagged.withColumns(
        {
            "obv_path": F.when(category == "both", F.col("obv_path"))
            .when(category == "rev_only", filler)
            .otherwise(known),
            "rev_path": F.when(category == "both", F.col("rev_path"))
            .when(category == "rev_only", known)
            .otherwise(filler),
        }
    )


def stratified_split(
    df: DataFrame,
    stratum: Column,
    key: str,
    *,
    train: float = 0.70,
    val: float = 0.15,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Train, validation and test labels with exact shares per stratum, in seeded random order.

    The shares are found as cuts in the seeded order of each stratum, so a stratum may hold any part of
    the data, and the rows themselves are neither sorted nor shuffled.
    """
    marked = df.withColumn("_stratum", F.coalesce(blank_to_null(stratum), F.lit("unknown")))

    def first(size: Column) -> Column:
        return exact_share(size, train)

    def second(size: Column) -> Column:
        return first(size) + exact_share(size, val)

    cuts = seeded_cuts(marked, key, "_stratum", {"train": first, "val": second}, seed=seed)
    label = (
        F.when(within_cut("train", key, seed), "train")
        .when(within_cut("val", key, seed), "val")
        .otherwise("test")
    )
    joined = marked.join(cuts, F.col("_stratum") == F.col("_group"))
    return joined.withColumn(name, label).select(
        *[c for c in df.columns if c != name], name
    )


def inherit_primary_split(pairs: DataFrame) -> DataFrame:
    """Duplicates take the split of their primary coin, ``train`` if the primary has none."""
    primaries = pairs.where(~F.col("is_duplicate")).select(
        F.col("coin_id").alias("_primary"), F.col("split").alias("_primary_split")
    )
    # Only duplicates are joined: the others have no primary and would share one join key.
    inherited = (
        pairs.where(F.col("is_duplicate"))
        .join(primaries, F.col("duplicate_of_coin_id") == F.col("_primary"), "left")
        .withColumn("split", F.coalesce("_primary_split", F.lit("train")))
        .select(*pairs.columns)
    )
    return pairs.where(~F.col("is_duplicate")).unionByName(inherited)


def split_manifest(
    dataset: DataFrame, split: str, min_confidence: float = 0.6, drop_non_coin: bool = False
) -> DataFrame:
    """Rows of a split fit for training."""
    rows = dataset.where(
        (F.col("split") == split)
        & F.col("period").isNotNull()
        & (F.col("label_confidence") >= min_confidence)
    )
    return rows.where(F.col("period") != "non_coin") if drop_non_coin else rows


def pair_manifest(pairs: DataFrame, split: str, min_confidence: float = 0.6) -> DataFrame:
    return split_manifest(pairs, split, min_confidence).where(F.col("is_duplicate") == 0)


def training_ready(dataset: DataFrame) -> DataFrame:
    """Active rows with a period and a path."""
    return dataset.where(
        (F.col("is_active") == 1) & has_text("period") & F.col("image_path").isNotNull()
    )


def label_mapping(df: DataFrame, columns: list[str], skip: tuple[str, ...] = ("", "unknown")) -> DataFrame:
    """Alphabetical index from 0 of every label of every column, in long form.

    Labels are reduced to distinct values first; those few rows are then numbered.
    """
    long = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("label")) for c in columns])
        ).alias("pair")
    ).select("pair.field", "pair.label")
    labels = long.where(F.col("label").isNotNull() & ~F.col("label").isin(*skip)).distinct()
    ranked = sorted_row_number(labels, "_place", ["field", "label"])
    first = ranked.groupBy(F.col("field").alias("_field")).agg(F.min("_place").alias("_first"))  # a row per column
    joined = ranked.join(F.broadcast(first), F.col("field") == F.col("_field"))
    return joined.select("field", "label", (F.col("_place") - F.col("_first")).alias("label_index"))


def export_statistics(pairs: DataFrame) -> DataFrame:
    """Counts of an export in long form (section, key, rows); one pass over it."""
    facts = F.array(
        F.struct(F.lit("split").alias("section"), F.col("split").alias("key")),
        F.struct(
            F.lit("period").alias("section"),
            F.when(F.col("period") != "unknown", F.col("period")).alias("key"),
        ),
        F.struct(
            F.lit("denomination").alias("section"), blank_to_null(F.col("denomination")).alias("key")
        ),
        F.struct(F.lit("material").alias("section"), blank_to_null(F.col("material")).alias("key")),
        F.struct(
            F.lit("flag").alias("section"),
            F.when(F.col("needs_review").cast("boolean"), "needs_review").alias("key"),
        ),
        F.struct(
            F.lit("flag").alias("section"),
            F.when(F.col("label_confidence") > 0.7, "high_confidence").alias("key"),
        ),
    )
    return (
        pairs.select(F.explode(facts).alias("fact"))
        .select("fact.section", "fact.key")
        .where(F.col("key").isNotNull())
        .groupBy("section", "key")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def export_pairs(
    exportable: DataFrame,
    *,
    rule: str = "skip",
    placeholder: str | None = None,
    seed: int = 42,
    stage: bool = True,
) -> DataFrame:
    """The paired export: missing-side rule, labels, resolved period and split.

    ``stage`` writes the labelled rows once, because the split reads them twice and the label rules
    are the expensive part.
    """
    from hoardline.functions.labels import with_labels
    from hoardline.session import cut_lineage

    labelled = with_labels(apply_missing_side_rule(exportable, rule, placeholder))
    resolved = labelled.withColumn(
        "period", resolved_period(F.col("auction_period"), F.col("period"))
    ).select(
        "coin_id", "obv_path", "rev_path", "has_obv", "has_rev", "period", "denomination", "material",
        F.col("title").alias("raw_label"), "label_confidence", "needs_review", "side_category",
        "auction_house", "sale_id", safe_int(F.col("lot_number")).alias("lot_number"),
    )
    rows = cut_lineage(resolved, "export") if stage else resolved
    return stratified_split(rows, F.col("period"), "coin_id", seed=seed)


def export_detections(
    exportable: DataFrame, *, seed: int = 42, stage: bool = True
) -> DataFrame:
    """The single-side export; stratified by the parsed period, stored with the resolved one."""
    from hoardline.functions.labels import with_labels
    from hoardline.session import cut_lineage

    usable = exportable.where(has_text("normalized_path")).withColumnRenamed("period", "range_period")
    labelled = with_labels(usable)
    resolved = labelled.select(
        F.col("id").alias("coin_detection_id"),
        F.col("normalized_path").alias("image_path"),
        F.col("period").alias("parsed_period"),
        resolved_period(F.col("range_period"), F.col("period")).alias("period"),
        "denomination", "material", F.col("title").alias("raw_label"), "label_confidence",
        "needs_review",
    )
    rows = cut_lineage(resolved, "export") if stage else resolved
    return stratified_split(rows, F.col("parsed_period"), "coin_detection_id", seed=seed)
