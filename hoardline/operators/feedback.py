"""Feedback reconciliation: logs to verified rows, and live accuracy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.functions.paths import basename
from hoardline.operators.mutate import update_by_id
from hoardline.session import cut_lineage, spread_narrow

HIGH_CONFIDENCE = 0.85  # fixed value: errors above it count as dangerous


def align_logs(
    corrections: DataFrame, confirmations: DataFrame, keep: list[str] | None = None
) -> DataFrame:
    """Both log shapes under common columns; corrections are wrong predictions.

    ``keep`` names further columns of both logs to carry along.
    """
    keep = keep or []
    wrong = corrections.select(
        "filename",
        F.col("original_prediction").alias("predicted"),
        F.col("corrected_label").alias("actual"),
        F.col("original_confidence").alias("confidence"),
        F.lit("WRONG").alias("result"),
        *keep,
    )
    right = confirmations.select(
        "filename",
        F.col("label").alias("predicted"),
        F.col("label").alias("actual"),
        "confidence",
        F.lit("CORRECT").alias("result"),
        *keep,
    )
    return wrong.unionByName(right)


def match_by_basename(entries: DataFrame, rows: DataFrame) -> DataFrame:
    """Entries joined to the rows whose picture has exactly that file name."""
    named = rows.withColumn("_name", basename(F.col("image_path")))
    return entries.join(named, F.col("filename") == F.col("_name")).drop("_name")


def match_by_suffix(entries: DataFrame, rows: DataFrame) -> DataFrame:
    """Entries joined to the rows whose path ends with the file name.

    A path is looked up by its suffixes of those lengths that occur among the file names, so this is an
    equality join: no pair of rows is compared that does not match.
    """
    names = entries.where(F.col("filename") != "")
    lengths = names.select(F.length("filename").alias("_length")).distinct()
    # One row: at most as many lengths as the longest file name has characters.
    all_lengths = lengths.agg(F.collect_set("_length")).scalar()
    path = F.col("image_path")
    suffixes = F.transform(
        F.filter("_lengths", lambda n: n <= F.length(path)),
        lambda n: F.substring(path, F.length(path) - n + 1, n),
    )
    tails = rows.withColumn("_lengths", all_lengths).select("*", F.explode(suffixes).alias("_suffix"))
    tails = tails.drop("_lengths")
    return names.join(tails, F.col("filename") == F.col("_suffix")).drop("_suffix")


HEAD = 4  # leading plain characters of a segment by which windows of paths are chosen
MAX_HEADS = 1000  # beyond so many different ones all windows of a path are kept


def _plain(token: Column) -> Column:
    return F.substring(token, -1, 1)


def with_pattern(entries: DataFrame) -> DataFrame:
    """``entries`` with their ``filename`` read as a pattern: ``_`` is any one character, ``%`` any characters, a backslash
    makes the next character plain.

    ``_like`` is the pattern with a ``%`` in front. Of the segments between its ``%`` the one with the most plain characters is described, the last
    one if they are equal: ``_length`` in characters, ``_shape`` the places of its plain characters, ``_key`` these
    characters, ``_head`` the first few of them if it begins with them, and ``_last`` whether it is bound to the end of the path."""
    tokens = F.regexp_extract_all(F.col("filename"), F.lit(r"(?s)(\\.|.)"), F.lit(0))
    wild = lambda t: t.isin("_", "%")
    quoted = lambda t: F.when(wild(t), t).when(_plain(t).isin("_", "%", "\\"), F.concat(F.lit("\\"), _plain(t))).otherwise(_plain(t))
    rows = entries.withColumn("_tokens", tokens)
    like = F.concat(F.lit("%"), F.array_join(F.transform("_tokens", quoted), ""))
    # The places of the %, with one before the first and one behind the last token.
    bars = F.filter(F.transform("_tokens", lambda t, i: F.when(t == "%", i)), lambda i: i.isNotNull())
    rows = rows.withColumn("_like", like).withColumn("_bars", F.concat(F.array(F.lit(-1)), bars, F.array(F.size("_tokens"))))
    segments = F.transform(
        F.sequence(F.lit(0), F.size("_bars") - 2),
        lambda n: F.slice("_tokens", F.get("_bars", n) + 2, F.get("_bars", n + 1) - F.get("_bars", n) - 1),
    )
    described = F.transform(
        segments,
        lambda segment, n: F.struct(
            F.size(F.filter(segment, lambda t: t != "_")).alias("plain"), (n == F.size("_bars") - 2).alias("last"), segment.alias("tokens")
        ),
    )
    rows = rows.withColumn("_best", F.array_max(described))
    placed = F.filter(F.transform("_best.tokens", lambda t, i: F.struct(t.alias("token"), i.alias("at"))), lambda t: t["token"] != "_")
    rows = rows.withColumn("_placed", placed)
    lead = F.filter("_placed", lambda t, i: (t["at"] == i) & (i < HEAD))
    return (
        rows.withColumn("_length", F.size("_best.tokens"))
        .withColumn("_last", F.col("_best.last"))
        .withColumn("_shape", F.transform("_placed", lambda t: t["at"]))
        .withColumn("_key", F.array_join(F.transform("_placed", lambda t: _plain(t["token"])), ""))
        .withColumn("_head", F.array_join(F.transform(lead, lambda t: _plain(t["token"])), ""))
        .drop("_tokens", "_bars", "_best", "_placed")
    )


def match_by_pattern(entries: DataFrame, rows: DataFrame) -> DataFrame:
    """Entries joined to the rows whose path ends with the file name as a pattern (``LIKE '%name'``).

    A pattern meets paths through its segment with the most plain characters, so a name of a few wildcards is looked up by what is
    particular to it and not by an ending that all paths share. Paths are cut into windows of each length and set of plain places that occurs, at the end only
    where the segment is bound to it, so this is an equality join; where the heads of the segments are few, windows
    that begin otherwise are left out before the join. Names that
    are null or have no plain character match nothing. Names compare exactly, case included."""
    patterns = with_pattern(entries.where(F.col("filename").isNotNull())).where(F.col("_key") != "")
    patterns = cut_lineage(patterns, "patterns")
    # The shapes of file names: far fewer than names, as names of one origin look alike.
    shape = [F.col("_last"), F.col("_length"), F.col("_shape"), F.substring("_head", 1, HEAD).alias("_head")]
    heads = patterns.select(*shape).distinct()
    forms = heads.groupBy("_last", "_length", "_shape").agg(F.collect_set("_head").alias("_heads"))
    limited = F.when(F.array_contains("_heads", "") | (F.size("_heads") > MAX_HEADS), F.array(F.lit(""))).otherwise(F.col("_heads"))
    all_forms = forms.agg(F.collect_list(F.struct("_last", "_length", "_shape", limited.alias("_heads")))).scalar()

    path = F.col("image_path")
    begins = lambda f, s: F.exists(f["_heads"], lambda h: F.substring(path, s, F.length(h)) == h)
    fitting = F.filter("_forms", lambda f: (f["_length"] <= F.length(path)) & (~f["_last"] | begins(f, F.length(path) - f["_length"] + 1)))
    cut = spread_narrow(rows).withColumn("_forms", all_forms).select(*rows.columns, F.explode(fitting).alias("_form"))
    form, end = F.col("_form"), F.length(path) - F.col("_form._length") + 1
    places = F.when(form["_last"], F.array(end)).otherwise(F.sequence(F.lit(1), end))
    starts = F.filter(places, lambda s: begins(form, s))
    whole = F.size(form["_shape"]) == form["_length"]
    letters = lambda s: F.array_join(F.transform(form["_shape"], lambda i: F.substring(path, s + i, F.lit(1))), "")
    windows = F.transform(starts, lambda s: F.when(whole, F.substring(path, s, form["_length"])).otherwise(letters(s)))
    parts = cut.select(
        *rows.columns, *[form[f"_{n}"].alias(f"_of_{n}") for n in ("last", "length", "shape")], F.explode(F.array_distinct(windows)).alias("_part")
    )
    same = (F.col("_key") == F.col("_part")) & F.expr(r"image_path LIKE _like ESCAPE '\\'")
    for n in ("last", "length", "shape"):
        same &= F.col(f"_{n}") == F.col(f"_of_{n}")
    return patterns.join(parts, same).select(*entries.columns, *rows.columns)


def verified_feedback(
    log: DataFrame, dataset: DataFrame, match: str = "basename", keep: list[str] | None = None
) -> DataFrame:
    """Feedback rows for the dataset pictures the log entries name."""
    rows = dataset.select("id", "image_path")
    joined = {"basename": match_by_basename, "suffix": match_by_suffix, "like": match_by_pattern}[match](log, rows)
    return joined.select(
        F.col("id").alias("ml_dataset_id"),
        F.col("predicted").alias("model_prediction"),
        F.col("confidence").alias("model_confidence"),
        F.col("actual").alias("human_label"),
        F.when(F.col("result") == "WRONG", "correction").otherwise("confirm").alias("feedback_type"),
        F.lit("classifier_app").alias("feedback_source"),
        *(keep or []),
    )


def verified_ids(feedback: DataFrame) -> DataFrame:
    """``id`` of every row that feedback confirms or corrects, once."""
    named = feedback.where(F.col("feedback_type").isin("confirm", "correction"))
    return named.select(F.col("ml_dataset_id").alias("id")).distinct()


def mark_ids(dataset: DataFrame, ids: DataFrame) -> DataFrame:
    return update_by_id(dataset, ids, {"is_verified": F.lit(1), "needs_review": F.lit(0)})


def mark_verified(dataset: DataFrame, feedback: DataFrame) -> DataFrame:
    """Rows with feedback become verified and leave the review queue."""
    return mark_ids(dataset, verified_ids(feedback))


def live_accuracy(log: DataFrame) -> DataFrame:
    correct = (F.col("result") == "CORRECT").cast("int")
    return log.agg(
        F.count(F.lit(1)).alias("reviewed"), (F.avg(correct) * 100).alias("accuracy_percent")
    )


def confusion_pairs(log: DataFrame) -> DataFrame:
    return (
        log.where(F.col("result") == "WRONG")
        .groupBy("predicted", "actual")
        .agg(F.count(F.lit(1)).alias("errors"))
        .orderBy(F.desc("errors"), "predicted", "actual")
    )


def class_accuracy(log: DataFrame, by: str | Column = "actual") -> DataFrame:
    return log.groupBy(by).agg(F.avg((F.col("result") == "CORRECT").cast("int")).alias("correct_share"))


def confident_errors(log: DataFrame, above: float = HIGH_CONFIDENCE) -> DataFrame:
    return log.where((F.col("result") == "WRONG") & (F.col("confidence") > above))
