"""Evaluation of predictions; everything derives from one aggregate per (true, predicted)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hoardline.functions.vectors import ranked_classes


def confusion_matrix(predictions: DataFrame) -> DataFrame:
    """Long form: rows per (true, predicted) and their share of the true class."""
    cells = predictions.groupBy("y_true", "y_pred").agg(F.count(F.lit(1)).alias("rows"))
    of_class = F.sum("rows").over(Window.partitionBy("y_true"))
    return cells.withColumn("share", F.col("rows") / of_class)


def confusion_pivot(predictions: DataFrame, labels: list[str], normalized: bool = False) -> DataFrame:
    """One row per true class, one column per predicted one; empty rows stay zero. Classes besides ``labels``, and missing
    ones, are counted in the row and the column ``other``."""
    value = "share" if normalized else "rows"
    named = [F.when(F.col(c).isin(labels), F.col(c)).otherwise("other").alias(c) for c in ("y_true", "y_pred")]
    labels = [*labels, "other"]
    cells = confusion_matrix(predictions.select(*named))
    wide = cells.groupBy("y_true").pivot("y_pred", labels).agg(F.max(value))
    every = predictions.sparkSession.createDataFrame([(x,) for x in labels], "label string")
    return every.join(wide, F.col("label") == F.col("y_true"), "left").drop("y_true").na.fill(0)


def classification_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    cells = predictions.groupBy("y_true", "y_pred").agg(F.count(F.lit(1)).alias("rows"))
    hit = F.when(F.col("y_true") == F.col("y_pred"), F.col("rows")).otherwise(0)
    facts = F.array(
        F.struct(
            F.col("y_true").alias("label"),
            F.col("rows").alias("actual"),
            F.lit(0).cast("long").alias("predicted"),
            hit.cast("long").alias("hits"),
        ),
        F.struct(
            F.col("y_pred").alias("label"),
            F.lit(0).cast("long").alias("actual"),
            F.col("rows").alias("predicted"),
            F.lit(0).cast("long").alias("hits"),
        ),
    )
    classes = (
        cells.select(F.explode(facts).alias("f"))
        .groupBy("f.label")
        .agg(
            F.sum("f.actual").alias("support"),
            F.sum("f.predicted").alias("predicted"),
            F.sum("f.hits").alias("hits"),
        )
    )

    def ratio(a: Column, b: Column) -> Column:
        return F.when(b > 0, a / b).otherwise(0.0)

    scored = classes.withColumns(
        {
            "precision": ratio(F.col("hits"), F.col("predicted")),
            "recall": ratio(F.col("hits"), F.col("support")),
        }
    ).withColumn(
        "f1",
        ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
    )
    per_class = scored.select("label", "precision", "recall", "f1", "support")
    metrics = ("precision", "recall", "f1")
    macro = per_class.agg(
        *[F.avg(m).alias(m) for m in metrics], F.sum("support").alias("support")
    ).select(F.lit("macro avg").alias("label"), *metrics, "support")
    weighted = per_class.agg(
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in metrics],
        F.sum("support").alias("support"),
    ).select(F.lit("weighted avg").alias("label"), *metrics, "support")
    accuracy = scored.agg(
        (F.sum("hits") / F.sum("support")).alias("a"), F.sum("support").alias("support")
    ).select(F.lit("accuracy").alias("label"), *[F.col("a").alias(m) for m in metrics], "support")
    return per_class.unionByName(accuracy).unionByName(macro).unionByName(weighted)


def class_accuracy(predictions: DataFrame) -> DataFrame:
    right = (F.col("y_true") == F.col("y_pred")).cast("int")
    return predictions.groupBy("y_true").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(right).alias("accuracy")
    )


def _percent(hits: Column, total: Column) -> Column:
    return 100.0 * hits / F.greatest(F.lit(1), total)


def evaluate_sides(pairs: DataFrame) -> DataFrame:
    """Pair-level scores of a model that classifies each side by itself (y_true, obv_pred, rev_pred)."""
    obverse = F.col("obv_pred") == F.col("y_true")
    reverse = F.col("rev_pred") == F.col("y_true")
    total = F.count(F.lit(1))
    return pairs.agg(
        _percent(F.count_if(obverse & reverse), total).alias("pair_accuracy"),
        _percent(F.count_if(obverse) + F.count_if(reverse), 2 * total).alias("side_accuracy"),
        _percent(F.count_if(obverse), total).alias("obverse_accuracy"),
        _percent(F.count_if(reverse), total).alias("reverse_accuracy"),
        _percent(F.count_if(F.col("obv_pred") != F.col("rev_pred")), total).alias("disagreement_rate"),
        total.alias("total_pairs"),
    )


def compare_modes(pairs: DataFrame) -> DataFrame:
    """Side mode against pair mode (``pair_pred``) on the same pairs, in one pass."""
    total = F.count(F.lit(1))
    both = (F.col("obv_pred") == F.col("y_true")) & (F.col("rev_pred") == F.col("y_true"))
    return pairs.agg(
        _percent(F.count_if(both), total).alias("sides_accuracy"),
        _percent(F.count_if(F.col("pair_pred") == F.col("y_true")), total).alias("pairs_accuracy"),
    ).select(
        "*",
        (F.col("pairs_accuracy") - F.col("sides_accuracy")).alias("improvement"),
        (F.col("pairs_accuracy") > F.col("sides_accuracy")).alias("pairs_better"),
    )


def calibration_error(predictions: DataFrame, bins: int = 10) -> DataFrame:
    """Expected calibration error over equal confidence bins."""
    right = (F.col("y_true") == F.col("y_pred")).cast("double")
    bin_of = F.least(F.lit(bins - 1), F.floor(F.col("confidence") * bins))
    per_bin = predictions.groupBy(bin_of.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg(right).alias("accuracy"),
        F.avg("confidence").alias("confidence"),
    )
    gap = F.abs(F.col("accuracy") - F.col("confidence")) * F.col("rows")
    return per_bin.agg((F.sum(gap) / F.sum("rows")).alias("ece"), F.sum("rows").alias("rows"))


def most_confused(predictions: DataFrame, n: int = 5) -> DataFrame:
    return (
        predictions.where(F.col("y_true") != F.col("y_pred"))
        .groupBy("y_true", "y_pred")
        .agg(F.count(F.lit(1)).alias("errors"))
        .orderBy(F.desc("errors"), "y_true", "y_pred")
        .limit(n)
    )


def acceptance(
    report: DataFrame,
    calibration: DataFrame,
    *,
    macro_f1: float = 0.80,
    recall: float = 0.60,
    min_support: int = 50,
    max_ece: float = 0.10,
) -> DataFrame:
    """The three release conditions: macro F1, recall of well-supported classes, calibration."""
    averages = ("accuracy", "macro avg", "weighted avg")
    macro = report.where(F.col("label") == "macro avg").select(
        F.lit("macro_f1").alias("check"), F.col("f1").alias("value"), (F.col("f1") >= macro_f1).alias("passed")
    )
    weakest = (
        report.where(~F.col("label").isin(*averages) & (F.col("support") >= min_support))
        .agg(F.min("recall").alias("value"))
        .select(
            F.lit("class_recall").alias("check"),
            "value",
            F.coalesce(F.col("value") >= recall, F.lit(True)).alias("passed"),
        )
    )
    ece = calibration.select(
        F.lit("ece").alias("check"), F.col("ece").alias("value"), (F.col("ece") <= max_ece).alias("passed")
    )
    return macro.unionByName(weakest).unionByName(ece)


def top_classes(probabilities: DataFrame, column: str = "probs", n: int = 3) -> DataFrame:
    """The ``n`` most probable classes per row, in long form."""
    ranked = ranked_classes(F.col(column), n)
    return probabilities.select("id", F.posexplode(ranked).alias("place", "c")).select(
        "id",
        (F.col("place") + 1).cast("long").alias("place"),
        F.col("c.class_index").cast("long").alias("class_index"),
        F.col("c.probability").alias("probability"),
    )


def cascade(general: DataFrame, specialist: DataFrame, classes: list[str]) -> DataFrame:
    """Final prediction: the specialist's where the general class is one of ``classes``."""
    expert = specialist.select(
        F.col("id").alias("_id"), F.col("y_pred").alias("_pred"), F.col("confidence").alias("_conf")
    )
    joined = general.join(expert, F.col("id") == F.col("_id"), "left")
    used = F.col("y_pred").isin(*classes) & F.col("_id").isNotNull()
    return joined.select(
        "id",
        F.col("y_pred").alias("level1_prediction"),
        F.col("confidence").alias("level1_confidence"),
        used.alias("used_specialist"),
        F.when(used, F.col("_pred")).otherwise(F.col("y_pred")).alias("final_prediction"),
        F.when(used, F.col("_conf")).otherwise(F.col("confidence")).alias("final_confidence"),
    )
