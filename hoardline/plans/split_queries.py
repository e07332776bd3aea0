"""Splits, samples, evaluation and the classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from hoardline.operators import classify, evaluate, export, splits
from hoardline.plans.registry import query
from hoardline.plans.shaping import flag, r6


def ranked(table: str, stratum: str, key: str, where: str = "TRUE") -> str:
    return f"""rk AS (SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY md5(CAST({key} AS VARCHAR) || '-42'), {key}) AS rn, count(*) OVER (PARTITION BY {stratum}) AS n
 FROM {table} WHERE {where})"""


@query(
    "stratified_split",
    views=["ml_dataset"],
    sql=f"""WITH {ranked('ml_dataset', "coalesce(nullif(period, ''), 'unknown')", 'id')}
 SELECT id, period, CASE WHEN rn <= floor(n * 0.7) THEN 'train' WHEN rn <= floor(n * 0.7) + floor(n * 0.15) THEN 'val' ELSE 'test' END AS new_split FROM rk""",
)
def stratified_split(v):
    rows = v.ml_dataset.select("id", "period")
    return export.stratified_split(rows, F.col("period"), "id", name="new_split")


@query(
    "coin_split",
    views=["ml_coin_dataset"],
    sql=f"""WITH {ranked('ml_coin_dataset', "coalesce(nullif(period, ''), 'unknown')", 'coin_id')}
 SELECT coalesce(period, 'unknown') AS period, CASE WHEN rn <= floor(n * 0.7) THEN 'train' WHEN rn <= floor(n * 0.7) + floor(n * 0.15) THEN 'val' ELSE 'test' END AS new_split, count(*) AS rows
 FROM rk GROUP BY 1, 2""",
)
def coin_split(v):
    rows = v.ml_coin_dataset.select("coin_id", F.coalesce("period", F.lit("unknown")).alias("period"))
    labelled = export.stratified_split(rows, F.col("period"), "coin_id", name="new_split")
    return labelled.groupBy("period", "new_split").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "split_80_20",
    views=["ml_dataset"],
    sql=f"""WITH {ranked('ml_dataset', 'period', 'id', "period <> ''")} SELECT id, period, CASE WHEN n > 1 AND rn <= greatest(1, floor(n * 0.2)) THEN 'val' ELSE 'train' END AS split FROM rk""",
)
def split_80_20(v):
    rows = v.ml_dataset.select("id", "period")
    return splits.split_by_class(rows, "period", "id")


@query(
    "split_min_class",
    views=["ml_coin_dataset"],
    sql=f"""WITH {ranked('ml_coin_dataset', 'period', 'coin_id', "period <> ''")} SELECT coin_id, period, CASE WHEN rn <= greatest(3, floor(n * 0.2)) THEN 'val' ELSE 'train' END AS split FROM rk WHERE n >= 15""",
)
def split_min_class(v):
    rows = v.ml_coin_dataset.select("coin_id", "period")
    return splits.split_by_class(rows, "period", "coin_id", least=3, min_class=15)


@query(
    "identity_split",
    views=["ml_coin_dataset"],
    sql="""WITH ids AS (SELECT DISTINCT period, pair_hash FROM ml_coin_dataset WHERE period <> '' AND pair_hash IS NOT NULL),
 rk AS (SELECT *, row_number() OVER (PARTITION BY period ORDER BY md5(pair_hash || '-42'), pair_hash) AS rn, count(*) OVER (PARTITION BY period) AS n FROM ids)
 SELECT m.coin_id, m.period, m.pair_hash, CASE WHEN n > 1 AND rn <= greatest(1, floor(n * 0.2)) THEN 'val' ELSE 'train' END AS split FROM ml_coin_dataset m JOIN rk ON m.period = rk.period AND m.pair_hash = rk.pair_hash""",
)
def identity_split(v):
    rows = v.ml_coin_dataset.select("coin_id", "period", "pair_hash")
    return splits.split_by_identity(rows, "period", "pair_hash")


@query(
    "balanced_sample",
    views=["ml_coin_dataset"],
    sql=f"""WITH {ranked('ml_coin_dataset', 'period', 'coin_id')} SELECT coin_id, coalesce(period, 'none') AS period FROM rk WHERE n >= 10 AND rn <= 60 AND period IS NOT NULL""",
)
def balanced_sample(v):
    rows = v.ml_coin_dataset.select("coin_id", "period").where(F.col("period").isNotNull())
    return splits.balanced_sample(rows, "period", "coin_id", 60).select("coin_id", "period")


@query(
    "head_subset",
    views=["ml_coin_dataset"],
    sql="SELECT coin_id, period FROM ml_coin_dataset ORDER BY coin_id LIMIT 500",
)
def head_subset(v):
    return splits.head(v.ml_coin_dataset, 500, "coin_id").select("coin_id", "period")


@query(
    "known_subclass",
    views=["ml_coin_dataset"],
    sql="""SELECT coin_id, authority, class_size FROM (SELECT coin_id, authority, count(*) OVER (PARTITION BY authority) AS class_size FROM ml_coin_dataset
 WHERE period = 'roman_imperial' AND authority <> '') WHERE class_size >= 15""",
)
def known_subclass(v):
    return splits.known_subclass(v.ml_coin_dataset, "roman_imperial", "authority").select(
        "coin_id", "authority", "class_size"
    )


@query(
    "class_weights",
    views=["ml_coin_dataset"],
    sql="""WITH c AS (SELECT period, count(*) AS rows FROM ml_coin_dataset WHERE period <> '' GROUP BY 1)
 SELECT period, rows, round(least((SELECT sum(rows) FROM c) / ((SELECT count(*) FROM c) * rows), 10.0), 6) AS weight FROM c""",
)
def class_weights(v):
    return splits.class_weights(v.ml_coin_dataset, "period").select("period", "rows", r6("weight"))


@query(
    "label_index",
    views=["ml_coin_dataset"],
    sql="SELECT period, row_number() OVER (ORDER BY period) - 1 AS label_index FROM (SELECT DISTINCT period FROM ml_coin_dataset WHERE period <> '')",
)
def label_index(v):
    return splits.label_index(v.ml_coin_dataset, "period")


@query(
    "pairs_to_sides",
    views=["ml_coin_dataset"],
    sql="""SELECT coin_id, period, 'obverse' AS side, obv_path AS image_path FROM ml_coin_dataset UNION ALL SELECT coin_id, period, 'reverse', rev_path FROM ml_coin_dataset""",
)
def pairs_to_sides(v):
    return splits.pairs_to_sides(v.ml_coin_dataset)


# ---- evaluation ---------------------------------------------------------------------------------


@query(
    "confusion_matrix",
    views=["predictions"],
    sql="""SELECT y_true, y_pred, count(*) AS rows, round(count(*) / sum(count(*)) OVER (PARTITION BY y_true), 6) AS share FROM predictions GROUP BY 1, 2""",
)
def confusion_matrix(v):
    return evaluate.confusion_matrix(v.predictions).select("y_true", "y_pred", "rows", r6("share"))


LANGS = ["de", "en", "es", "fr", "it"]


@query(
    "confusion_pivot",
    views=["predictions"],
    sql="SELECT l.label, "
    + ", ".join(f"count(*) FILTER (p.y_pred = '{x}') AS {x}" for x in LANGS)
    + f", count(*) FILTER (p.id IS NOT NULL AND (p.y_pred IN {tuple(LANGS)}) IS NOT TRUE) AS other"
    + f" FROM (SELECT unnest({[*LANGS, 'other']}) AS label) l LEFT JOIN predictions p"
    + f" ON l.label = CASE WHEN p.y_true IN {tuple(LANGS)} THEN p.y_true ELSE 'other' END GROUP BY 1",
)
def confusion_pivot(v):
    return evaluate.confusion_pivot(v.predictions, LANGS)


CLASS = """lab AS (SELECT y_true AS label FROM predictions UNION SELECT y_pred FROM predictions),
 cl AS (SELECT label, count(p.id) FILTER (y_true = label AND y_pred = label) AS tp, count(p.id) FILTER (y_true = label) AS support, count(p.id) FILTER (y_pred = label) AS predicted
  FROM lab LEFT JOIN predictions p ON p.y_true = label OR p.y_pred = label GROUP BY 1),
 sc AS (SELECT label, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS pr, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS re, support, tp FROM cl),
 fs AS (SELECT *, CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END AS f FROM sc),
 rep AS (SELECT label, pr, re, f, support FROM fs UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) FROM fs
 UNION ALL SELECT 'macro avg', avg(pr), avg(re), avg(f), sum(support) FROM fs UNION ALL SELECT 'weighted avg', sum(pr * support) / sum(support), sum(re * support) / sum(support), sum(f * support) / sum(support), sum(support) FROM fs)"""


@query(
    "classification_report",
    views=["predictions"],
    sql=f"WITH {CLASS} SELECT label, round(pr, 6) AS precision, round(re, 6) AS recall, round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM rep",
)
def classification_report(v):
    report = evaluate.classification_report(v.predictions)
    return report.select("label", r6("precision"), r6("recall"), r6("f1"), "support")


@query(
    "class_accuracy",
    views=["predictions"],
    sql="SELECT y_true, count(*) AS rows, round(avg(CASE WHEN y_true = y_pred THEN 1 ELSE 0 END), 6) AS accuracy FROM predictions GROUP BY 1",
)
def class_accuracy(v):
    return evaluate.class_accuracy(v.predictions).select("y_true", "rows", r6("accuracy"))


def _pairs(v):
    return v.predictions.withColumnRenamed("y_pred", "obv_pred")


@query(
    "pair_evaluation",
    views=["predictions"],
    sql="""SELECT round(100.0 * count(*) FILTER (y_pred = y_true AND rev_pred = y_true) / count(*), 6) AS pair_accuracy,
 round(100.0 * (count(*) FILTER (y_pred = y_true) + count(*) FILTER (rev_pred = y_true)) / (2 * count(*)), 6) AS side_accuracy, round(100.0 * count(*) FILTER (y_pred = y_true) / count(*), 6) AS obverse_accuracy,
 round(100.0 * count(*) FILTER (rev_pred = y_true) / count(*), 6) AS reverse_accuracy, round(100.0 * count(*) FILTER (y_pred <> rev_pred) / count(*), 6) AS disagreement_rate, count(*) AS total_pairs FROM predictions""",
)
def pair_evaluation(v):
    scores = evaluate.evaluate_sides(_pairs(v))
    return scores.select(*[r6(c) for c in scores.columns if c != "total_pairs"], "total_pairs")


@query(
    "mode_comparison",
    views=["predictions"],
    sql="""WITH a AS (SELECT 100.0E0 * count(*) FILTER (y_pred = y_true AND rev_pred = y_true) / count(*) AS s, 100.0E0 * count(*) FILTER (pair_pred = y_true) / count(*) AS p FROM predictions)
 SELECT round(s, 6) AS sides_accuracy, round(p, 6) AS pairs_accuracy, round(p - s, 6) AS improvement, CAST(p > s AS INT) AS pairs_better FROM a""",
)
def mode_comparison(v):
    compared = evaluate.compare_modes(_pairs(v))
    return compared.select(
        r6("sides_accuracy"), r6("pairs_accuracy"), r6("improvement"), flag("pairs_better", "pairs_better")
    )


ECE = """bn AS (SELECT least(9, floor(confidence * 10)) AS b, count(*) AS n, avg(CASE WHEN y_true = y_pred THEN 1.0E0 ELSE 0.0E0 END) AS acc, avg(confidence) AS conf FROM predictions GROUP BY 1),
 ec AS (SELECT sum(abs(acc - conf) * n) / sum(n) AS ece, sum(n) AS rows FROM bn)"""


@query(
    "calibration_ece",
    views=["predictions"],
    sql=f"WITH {ECE} SELECT round(ece, 6) AS ece, CAST(rows AS BIGINT) AS rows FROM ec",
)
def calibration_ece(v):
    return evaluate.calibration_error(v.predictions).select(r6("ece"), "rows")


@query(
    "most_confused",
    views=["predictions"],
    sql="SELECT y_true, y_pred, count(*) AS errors FROM predictions WHERE y_true <> y_pred GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 5",
)
def most_confused(v):
    return evaluate.most_confused(v.predictions)


@query(
    "release_checks",
    views=["predictions"],
    sql=f"""WITH {CLASS}, {ECE} SELECT 'macro_f1' AS "check", round(f, 6) AS value, CAST(f >= 0.8 AS INT) AS passed FROM rep WHERE label = 'macro avg'
 UNION ALL SELECT 'class_recall', round(min(re), 6), CAST(coalesce(min(re) >= 0.6, TRUE) AS INT) FROM fs WHERE support >= 50 UNION ALL SELECT 'ece', round(ece, 6), CAST(ece <= 0.1 AS INT) FROM ec""",
)
def release_checks(v):
    checks = evaluate.acceptance(
        evaluate.classification_report(v.predictions), evaluate.calibration_error(v.predictions)
    )
    return checks.select("check", r6("value"), flag("passed", "passed"))


@query(
    "cascade_prediction",
    views=["predictions"],
    sql="""SELECT id, y_pred AS level1_prediction, CAST(y_pred IN ('de', 'fr') AS INT) AS used_specialist, CASE WHEN y_pred IN ('de', 'fr') THEN pair_pred ELSE y_pred END AS final_prediction,
 CASE WHEN y_pred IN ('de', 'fr') THEN round(1 - confidence, 6) ELSE confidence END AS final_confidence FROM predictions""",
)
def cascade_prediction(v):
    specialist = v.predictions.select(
        "id", F.col("pair_pred").alias("y_pred"), F.round(1 - F.col("confidence"), 6).alias("confidence")
    )
    final = evaluate.cascade(v.predictions.select("id", "y_pred", "confidence"), specialist, ["de", "fr"])
    return final.select(
        "id", "level1_prediction", flag("used_specialist", "used_specialist"), "final_prediction", "final_confidence"
    )


@query("train_classifier")
def train_classifier(v):
    """Report of the class-weighted classifier, trained and scored on a per-class split."""
    rows = v.embeddings.select(
        F.col("vec_id").alias("id"), F.concat(F.lit("p"), F.col("label").cast("string")).alias("period"), "embedding"
    )
    prepared = classify.training_rows(splits.split_by_class(rows, "period", "id"), "period", "embedding")
    model = classify.train(prepared.where(F.col("split") == "train"))
    scored = classify.predict(model, prepared.where(F.col("split") == "val"))
    labelled = scored.select(
        "id", F.col("y_true").cast("string").alias("y_true"), F.col("y_pred").cast("string").alias("y_pred")
    )
    return evaluate.classification_report(labelled).select(
        "label", r6("precision"), r6("recall"), r6("f1"), "support"
    )


