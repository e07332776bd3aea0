"""Catalogue reads and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from hoardline.functions.text import is_set, nan_safe, safe_int
from hoardline.operators import catalog, feedback, mutate, review, stats
from hoardline.plans.registry import query
from hoardline.plans.shaping import big, r6

LOT = "id, lot_number, title, coalesce(description, '') AS description, image_path, auction_house"


@query(
    "unprocessed_batch",
    views=["auction_data"],
    sql=f"""SELECT {LOT} FROM auction_data WHERE vision_processed = 0 AND image_path IS NOT NULL AND image_path <> ''
 ORDER BY id LIMIT 100""",
)
def unprocessed_batch(v):
    batch = catalog.with_record_defaults(catalog.unprocessed_batch(v.auction_data, 100))
    return batch.select("id", "lot_number", "title", "description", "image_path", "auction_house")


@query(
    "record_by_id",
    views=["auction_data"],
    sql="""SELECT id, coalesce(title, '') AS title, coalesce(description, '') AS description, coalesce(image_path, '') AS image_path
 FROM auction_data WHERE id = 13""",
)
def record_by_id(v):
    return catalog.record_by_id(v.auction_data, 13).select("id", "title", "description", "image_path")


@query(
    "coins_for_record",
    views=["coins"],
    sql="SELECT id, auction_record_id, coalesce(pairing_method, '') AS pairing_method FROM coins WHERE auction_record_id = 14",
)
def coins_for_record(v):
    coins = v.coins.withColumn("group_index", F.lit(0))
    return catalog.coins_of_record(coins, 14).select(
        "id", "auction_record_id", F.coalesce("pairing_method", F.lit("")).alias("pairing_method")
    )


@query(
    "detections_side_order",
    views=["coin_detections"],
    sql="""SELECT coin_id, id, side, CASE side WHEN 'obverse' THEN 1 WHEN 'reverse' THEN 2 WHEN 'unknown' THEN 3 ELSE 0 END AS side_rank
 FROM coin_detections WHERE coin_id IS NOT NULL ORDER BY coin_id, side_rank, id DESC""",
)
def detections_side_order(v):
    linked = v.coin_detections.where(F.col("coin_id").isNotNull())
    return catalog.by_side(linked).select(
        "coin_id", "id", "side", catalog.side_rank(F.col("side")).alias("side_rank")
    )


@query(
    "unlinked_grouped",
    views=["coin_detections"],
    sql="""SELECT auction_record_id, count(*) AS detections, min(detection_index) AS first_index, min(id) AS first_id FROM coin_detections
 WHERE coin_id IS NULL AND coin_likelihood >= 0.5 AND normalized_path IS NOT NULL AND normalized_path <> '' GROUP BY 1""",
)
def unlinked_grouped(v):
    loose = catalog.unlinked_detections(v.coin_detections)
    return loose.groupBy("auction_record_id").agg(
        F.count(F.lit(1)).alias("detections"),
        F.min("detection_index").alias("first_index"),
        F.min("id").alias("first_id"),
    )


@query(
    "active_dataset",
    views=["ml_dataset"],
    sql="SELECT id, image_path, period FROM ml_dataset WHERE is_active = 1 AND image_path IS NOT NULL AND image_path <> ''",
)
def active_dataset(v):
    return catalog.active_dataset(v.ml_dataset).select("id", "image_path", "period")


@query(
    "paired_dataset",
    views=["ml_coin_dataset"],
    sql="""SELECT coin_id, obv_path, rev_path, period, label_confidence FROM ml_coin_dataset WHERE is_duplicate = 0
 AND coalesce(has_obv, 1) = 1 AND coalesce(has_rev, 1) = 1 AND obv_path IS NOT NULL AND obv_path <> ''
 AND rev_path IS NOT NULL AND rev_path <> '' AND period IS NOT NULL AND period <> ''""",
)
def paired_dataset(v):
    return catalog.paired_dataset(v.ml_coin_dataset).select(
        "coin_id", "obv_path", "rev_path", "period", "label_confidence"
    )


@query(
    "random_sample",
    views=["ml_coin_dataset"],
    sql="SELECT coin_id, period FROM ml_coin_dataset ORDER BY md5(CAST(coin_id AS VARCHAR) || '-42'), coin_id LIMIT 200",
)
def random_sample(v):
    return review.random_sample(v.ml_coin_dataset, 200, key="coin_id").select("coin_id", "period")


@query(
    "safe_values",
    views=["auction_data"],
    sql="""SELECT id, coalesce(TRY_CAST(lot_number AS BIGINT), 0) AS lot, coalesce(description, '') AS description,
 CAST(coalesce(lower(trim(CAST(vision_processed AS VARCHAR))) IN ('1', 'true', 'yes', 'y', 't'), TRUE) AS INT) AS is_set FROM auction_data""",
)
def safe_values(v):
    return v.auction_data.select(
        "id",
        safe_int(F.col("lot_number")).alias("lot"),
        nan_safe(F.col("description")).alias("description"),
        is_set(F.col("vision_processed")).cast("int").alias("is_set"),
    )


# ---- statistics --------------------------------------------------------------------------------


@query("split_counts", views=["ml_dataset"], sql="SELECT split, count(*) AS rows FROM ml_dataset GROUP BY 1")
def split_counts(v):
    return stats.split_counts(v.ml_dataset)


@query(
    "period_distribution",
    views=["ml_dataset"],
    sql="SELECT period, count(*) AS rows FROM ml_dataset WHERE period IS NOT NULL AND period <> '' GROUP BY 1 ORDER BY 2 DESC, 1",
)
def period_distribution(v):
    return stats.period_distribution(v.ml_dataset)


@query(
    "dataset_stats",
    views=["ml_dataset"],
    sql="""SELECT count(*) AS total, count(*) FILTER (needs_review = 1) AS flagged, count(*) FILTER (is_verified = 1) AS verified,
 count(*) FILTER (is_verified = 0) AS unverified FROM ml_dataset""",
)
def dataset_stats(v):
    return stats.dataset_totals(v.ml_dataset)


@query(
    "catalogue_totals",
    views=["auction_data", "coin_detections", "ml_dataset"],
    sql="""SELECT 'lots' AS item, count(*) AS rows FROM auction_data UNION ALL
 SELECT 'lots_processed', count(*) FILTER (vision_processed = 1) FROM auction_data UNION ALL
 SELECT 'detections', count(*) FROM coin_detections UNION ALL SELECT 'dataset', count(*) FROM ml_dataset""",
)
def catalogue_totals(v):
    return stats.catalogue_totals(v.auction_data, v.coin_detections, v.ml_dataset)


@query(
    "coin_dataset_stats",
    views=["ml_coin_dataset"],
    sql="""SELECT count(*) FILTER (is_duplicate = 0 AND has_obv = 1 AND has_rev = 1) AS both_sides,
 count(*) FILTER (is_duplicate = 0 AND has_obv = 1 AND has_rev = 0) AS obv_only,
 count(*) FILTER (is_duplicate = 0 AND has_obv = 0 AND has_rev = 1) AS rev_only,
 count(*) FILTER (is_duplicate = 0) AS total, count(*) FILTER (is_duplicate = 1) AS duplicates_tracked FROM ml_coin_dataset""",
)
def coin_dataset_stats(v):
    return stats.pair_totals(v.ml_coin_dataset)


@query(
    "side_status",
    views=["coins", "coin_detections"],
    sql="""SELECT CASE WHEN o > 0 AND r > 0 THEN 'both_sides' WHEN o > 0 THEN 'obverse_only' WHEN r > 0 THEN 'reverse_only'
 ELSE 'unknown_only' END AS side_status, count(*) AS coins FROM (
 SELECT c.id, sum(CASE WHEN d.side = 'obverse' THEN 1 ELSE 0 END) AS o, sum(CASE WHEN d.side = 'reverse' THEN 1 ELSE 0 END) AS r
 FROM coins c LEFT JOIN coin_detections d ON d.coin_id = c.id GROUP BY c.id) GROUP BY 1""",
)
def side_status(v):
    return stats.side_status(v.coins, v.coin_detections)


@query(
    "pairing_methods",
    views=["coins"],
    sql="SELECT coalesce(nullif(pairing_method, ''), 'null') AS pairing_method, count(*) AS coins FROM coins GROUP BY 1",
)
def pairing_methods(v):
    return stats.pairing_methods(v.coins)


@query(
    "two_detection_lots",
    views=["coin_detections"],
    sql="SELECT auction_record_id, count(*) AS detections FROM coin_detections GROUP BY 1 HAVING count(*) = 2",
)
def two_detection_lots(v):
    return stats.two_detection_lots(v.coin_detections)


@query(
    "filter_options",
    views=["cluster_results"],
    sql="""SELECT DISTINCT 'parser_period' AS field, parser_period AS value FROM cluster_results WHERE parser_period <> '' UNION ALL
 SELECT DISTINCT 'denomination', denomination FROM cluster_results WHERE denomination <> ''""",
)
def filter_options(v):
    return stats.filter_options(v.cluster_results, ["parser_period", "denomination"])


@query(
    "corpus_stats",
    views=["cluster_results"],
    sql="""SELECT 'total' AS field, 'rows' AS value, count(*) AS rows FROM cluster_results UNION ALL
 SELECT 'dimension', CAST(len(embedding) AS VARCHAR), count(*) FROM cluster_results GROUP BY 2 UNION ALL
 SELECT 'period', parser_period, count(*) FROM cluster_results WHERE parser_period IS NOT NULL GROUP BY 2 UNION ALL
 SELECT 'denomination', denomination, count(*) FROM cluster_results WHERE denomination IS NOT NULL GROUP BY 2 UNION ALL
 SELECT 'auction_house', auction_house, count(*) FROM cluster_results WHERE auction_house IS NOT NULL GROUP BY 2""",
)
def corpus_stats(v):
    return stats.corpus_statistics(v.cluster_results)


@query(
    "embedding_coverage",
    views=["side_embeddings"],
    sql="SELECT coalesce(period, 'unknown') AS period, count(*) AS rows FROM side_embeddings GROUP BY 1",
)
def embedding_coverage(v):
    return stats.counts(v.side_embeddings, F.coalesce("period", F.lit("unknown")).alias("period"))


# ---- feedback and review ------------------------------------------------------------------------


def _log(v):
    return v.feedback_log.withColumn(
        "result", F.when(F.col("kind") == "correction", "WRONG").otherwise("CORRECT")
    )


FEEDBACK = """fb AS (SELECT d.id AS ml_dataset_id, f.predicted AS model_prediction, f.confidence AS model_confidence, f.actual AS human_label,
 CASE WHEN f.kind = 'correction' THEN 'correction' ELSE 'confirm' END AS feedback_type
 FROM feedback_log f JOIN ml_dataset d ON regexp_extract(d.image_path, '[^/]*$') = f.filename)"""


@query(
    "feedback_sync",
    views=["feedback_log", "ml_dataset"],
    sql=f"WITH {FEEDBACK} SELECT * FROM fb",
)
def feedback_sync(v):
    return feedback.verified_feedback(_log(v), v.ml_dataset).drop("feedback_source")


@query(
    "feedback_suffix",
    views=["feedback_log", "ml_dataset"],
    sql="""WITH f AS (SELECT DISTINCT filename FROM feedback_log)
 SELECT f.filename, count(*) AS pictures, min(d.id) AS first_id FROM f JOIN ml_dataset d ON ends_with(d.image_path, f.filename) GROUP BY 1""",
)
def feedback_suffix(v):
    names = v.feedback_log.select("filename").distinct()
    matched = feedback.match_by_suffix(names, v.ml_dataset.select("id", "image_path"))
    return matched.groupBy("filename").agg(
        F.count(F.lit(1)).alias("pictures"), F.min("id").alias("first_id")
    )


LIKE_NAMES = """CASE event_id % 5 WHEN 0 THEN filename WHEN 1 THEN replace(filename, '1', '_') WHEN 2 THEN replace(filename, '.', '%')
 WHEN 3 THEN replace(filename, '_', '\\_') ELSE replace(filename, 'jpg', '%') END"""


@query(
    "feedback_like",
    views=["feedback_log", "ml_dataset"],
    sql=f"""WITH f AS (SELECT DISTINCT {LIKE_NAMES} AS filename FROM feedback_log)
 SELECT f.filename, count(*) AS pictures, min(d.id) AS first_id, max(d.id) AS last_id
 FROM f JOIN ml_dataset d ON d.image_path LIKE '%' || f.filename ESCAPE '\\' GROUP BY 1""",
)
def feedback_like(v):
    names = v.feedback_log.select(F.expr(LIKE_NAMES.replace("\\", "\\\\")).alias("filename")).distinct()
    matched = feedback.match_by_pattern(names, v.ml_dataset.select("id", "image_path"))
    return matched.groupBy("filename").agg(
        F.count(F.lit(1)).alias("pictures"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


@query(
    "verified_update",
    views=["feedback_log", "ml_dataset"],
    sql=f"""WITH {FEEDBACK} SELECT id, CAST(CASE WHEN id IN (SELECT ml_dataset_id FROM fb) THEN 1 ELSE is_verified END AS INT) AS is_verified,
 CAST(CASE WHEN id IN (SELECT ml_dataset_id FROM fb) THEN 0 ELSE needs_review END AS INT) AS needs_review FROM ml_dataset""",
)
def verified_update(v):
    found = feedback.verified_feedback(_log(v), v.ml_dataset)
    return feedback.mark_verified(v.ml_dataset, found).select(
        "id", F.col("is_verified").cast("int"), F.col("needs_review").cast("int")
    )


@query(
    "feedback_union",
    views=["feedback_log"],
    sql="""SELECT filename, predicted, actual, confidence, CASE WHEN kind = 'correction' THEN 'WRONG' ELSE 'CORRECT' END AS result
 FROM feedback_log""",
)
def feedback_union(v):
    log = v.feedback_log
    corrections = log.where(F.col("kind") == "correction").select(
        "filename",
        F.col("predicted").alias("original_prediction"),
        F.col("confidence").alias("original_confidence"),
        F.col("actual").alias("corrected_label"),
    )
    confirmations = log.where(F.col("kind") == "confirmation").select(
        "filename", F.col("actual").alias("label"), "confidence"
    )
    return feedback.align_logs(corrections, confirmations)


@query(
    "live_accuracy",
    views=["feedback_log"],
    sql="SELECT count(*) AS reviewed, round(avg(CASE WHEN kind = 'confirmation' THEN 1 ELSE 0 END) * 100, 6) AS accuracy_percent FROM feedback_log",
)
def live_accuracy(v):
    return feedback.live_accuracy(_log(v)).select("reviewed", r6("accuracy_percent"))


@query(
    "confusion_pairs",
    views=["feedback_log"],
    sql="SELECT predicted, actual, count(*) AS errors FROM feedback_log WHERE kind = 'correction' GROUP BY 1, 2",
)
def confusion_pairs(v):
    return feedback.confusion_pairs(_log(v))


@query(
    "feedback_class_accuracy",
    views=["feedback_log"],
    sql="SELECT actual, round(avg(CASE WHEN kind = 'confirmation' THEN 1 ELSE 0 END), 6) AS correct_share FROM feedback_log GROUP BY 1",
)
def feedback_class_accuracy(v):
    return feedback.class_accuracy(_log(v)).select("actual", r6("correct_share"))


@query(
    "confident_errors",
    views=["feedback_log"],
    sql="SELECT event_id, filename, predicted, actual, confidence FROM feedback_log WHERE kind = 'correction' AND confidence > 0.85",
)
def confident_errors(v):
    return feedback.confident_errors(_log(v)).select(
        "event_id", "filename", "predicted", "actual", "confidence"
    )


QUEUES = {
    "priority": "is_verified = 0 ORDER BY needs_review DESC, label_confidence ASC NULLS FIRST, id",
    "flagged": "needs_review = 1 ORDER BY label_confidence ASC NULLS FIRST, id",
    "low_confidence": "is_verified = 0 AND label_confidence < 0.7 ORDER BY label_confidence ASC NULLS FIRST, id",
    "high_confidence": "is_verified = 0 AND label_confidence > 0.85 ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id",
    "random": "is_verified = 0 ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id",
}

for _mode, _clause in QUEUES.items():

    @query(
        f"review_queue_{_mode}",
        views=["ml_dataset"],
        sql=f"SELECT id, period, label_confidence FROM ml_dataset WHERE {_clause} LIMIT 25",
    )
    def review_queue(v, mode=_mode):
        return review.review_queue(v.ml_dataset, mode, 25).select("id", "period", "label_confidence")


DECISIONS = """dec AS (SELECT doc_id AS id, CASE WHEN toxic = 1 THEN 'delete' ELSE 'update' END AS action,
 CASE WHEN quality = 1 THEN 'greek' WHEN doc_id % 2 = 0 THEN '' ELSE NULL END AS period,
 CASE WHEN quality = 0 THEN '' WHEN doc_id % 3 = 0 THEN 'early' ELSE NULL END AS subperiod FROM labels)"""


@query(
    "apply_decisions",
    views=["ml_dataset"],
    sql=f"""WITH {DECISIONS} SELECT m.id, CASE WHEN d.period <> '' THEN d.period ELSE m.period END AS period, coalesce(d.subperiod, m.subperiod) AS subperiod,
 CAST(CASE WHEN d.id IS NOT NULL THEN 0 ELSE m.needs_review END AS INT) AS needs_review,
 CAST(CASE WHEN d.id IS NOT NULL THEN 1 ELSE m.is_verified END AS INT) AS is_verified
 FROM ml_dataset m LEFT JOIN dec d ON m.id = d.id WHERE d.action IS DISTINCT FROM 'delete'""",
)
def apply_decisions(v):
    odd = F.col("doc_id") % 2 == 1
    good = F.col("quality") == 1
    decisions = v.labels.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("toxic") == 1, "delete").otherwise("update").alias("action"),
        F.when(good, "greek").when(~odd, "").alias("period"),
        F.when(~good, "").when(F.col("doc_id") % 3 == 0, "early").alias("subperiod"),
        F.col("doc_id").alias("at"),
    )
    return mutate.apply_decisions(v.ml_dataset, decisions, "at").select(
        "id", "period", "subperiod", F.col("needs_review").cast("int"), F.col("is_verified").cast("int")
    )


@query(
    "decisions_in_order",
    views=["ml_dataset"],
    sql="""WITH e AS (SELECT user_id * 5 + event_id % 5 AS id, event_id AS place, event_type = 'error' AND event_id % 17 = 0 AS gone,
  CASE event_type WHEN 'view' THEN 'roman' WHEN 'click' THEN 'greek' WHEN 'purchase' THEN '' END AS period,
  CASE event_type WHEN 'signup' THEN 'early' WHEN 'purchase' THEN '' END AS subperiod FROM events),
 d AS (SELECT id, bool_or(gone) AS gone, arg_max(period, place) FILTER (period <> '') AS period, arg_max(subperiod, place) FILTER (subperiod IS NOT NULL) AS subperiod FROM e GROUP BY id)
 SELECT m.id, coalesce(d.period, m.period) AS period, coalesce(d.subperiod, m.subperiod) AS subperiod,
  CAST(CASE WHEN d.id IS NOT NULL THEN 1 ELSE m.is_verified END AS INT) AS is_verified
 FROM ml_dataset m LEFT JOIN d ON m.id = d.id WHERE d.gone IS DISTINCT FROM true""",
)
def decisions_in_order(v):
    """Many decisions for a row, made one after the other by the number of the event."""
    kind = F.col("event_type")
    decisions = v.events.select(
        (F.col("user_id") * 5 + F.col("event_id") % 5).alias("id"),
        F.col("event_id").alias("at"),
        F.when((kind == "error") & (F.col("event_id") % 17 == 0), "delete").otherwise("update").alias("action"),
        F.when(kind == "view", "roman").when(kind == "click", "greek").when(kind == "purchase", "").alias("period"),
        F.when(kind == "signup", "early").when(kind == "purchase", "").alias("subperiod"),
    )
    changed = mutate.apply_decisions(v.ml_dataset, decisions, "at")
    return changed.select("id", "period", "subperiod", F.col("is_verified").cast("int"))


@query(
    "mark_processed",
    views=["auction_data", "coin_detections"],
    sql="""SELECT id, CAST(CASE WHEN id IN (SELECT auction_record_id FROM coin_detections) THEN 1 ELSE vision_processed END AS INT) AS vision_processed
 FROM auction_data""",
)
def mark_processed(v):
    seen = v.coin_detections.select(F.col("auction_record_id").alias("id"))
    return mutate.mark_processed(v.auction_data, seen).select("id", "vision_processed")


@query(
    "set_lot_metadata",
    views=["auction_data"],
    sql="""SELECT a.id, CASE WHEN c.c_custkey IS NOT NULL THEN c.c_mktsegment ELSE a.site END AS site,
 CASE WHEN c.c_custkey IS NOT NULL THEN CAST(c.c_nationkey AS VARCHAR) ELSE a.sale_id END AS sale_id
 FROM auction_data a LEFT JOIN customer c ON a.id = c.c_custkey""",
)
def set_lot_metadata(v):
    metadata = v.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("site"),
        F.col("c_nationkey").cast("string").alias("sale_id"),
        F.col("c_custkey").alias("at"),
    )
    return mutate.set_lot_metadata(v.auction_data, metadata, "at").select("id", "site", "sale_id")


@query(
    "metadata_in_order",
    views=["auction_data"],
    sql="""WITH n AS (SELECT l_orderkey AS id, max({'n': l_linenumber, 'site': l_returnflag || l_linestatus, 'sale': CAST(l_suppkey AS VARCHAR)}) AS last FROM lineitem WHERE l_quantity < 30 GROUP BY 1)
 SELECT a.id, CASE WHEN n.id IS NOT NULL THEN n.last.site ELSE a.site END AS site, CASE WHEN n.id IS NOT NULL THEN n.last.sale ELSE a.sale_id END AS sale_id
 FROM auction_data a LEFT JOIN n ON a.id = n.id""",
)
def metadata_in_order(v):
    """Several site and sale changes for a lot, the one with the highest line number last, ties by value."""
    metadata = v.lineitem.where(F.col("l_quantity") < 30).select(
        F.col("l_orderkey").alias("id"),
        F.concat("l_returnflag", "l_linestatus").alias("site"),
        F.col("l_suppkey").cast("string").alias("sale_id"),
        F.col("l_linenumber").alias("at"),
    )
    return mutate.set_lot_metadata(v.auction_data, metadata, "at").select("id", "site", "sale_id")


@query(
    "append_with_keys",
    views=["coins", "ml_coin_dataset"],
    sql="""SELECT (SELECT max(id) FROM ml_coin_dataset) + row_number() OVER (ORDER BY id) AS id, id AS coin_id, pairing_method FROM coins""",
)
def append_with_keys(v):
    rows = v.coins.select(F.col("id").alias("coin_id"), "pairing_method")
    return mutate.append_with_keys(v.ml_coin_dataset, rows, "coin_id").select(
        big("id", "id"), "coin_id", "pairing_method"
    )


@query(
    "insert_unless_duplicate",
    views=["ml_coin_dataset"],
    sql="""WITH fresh AS (SELECT id AS k, image_hash FROM (
  SELECT doc_id AS id, CASE WHEN doc_id % 12 = 5 THEN '' ELSE md5(text) END AS image_hash FROM documents)),
 known AS (SELECT md5(d.text) AS h FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
 ok AS (SELECT k, image_hash, row_number() OVER (PARTITION BY image_hash ORDER BY k) AS rn FROM fresh
  WHERE image_hash <> '' AND image_hash NOT IN (SELECT h FROM known))
 SELECT k AS id, image_hash FROM ok WHERE rn = 1 UNION ALL SELECT k, image_hash FROM fresh WHERE image_hash = ''""",
)
def insert_unless_duplicate(v):
    from hoardline.operators.dedup import new_by_hash

    hashed = F.md5("text")
    rows = v.documents.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("doc_id") % 12 == 5, "").otherwise(hashed).alias("image_hash"),
    )
    target = v.documents.join(v.labels, "doc_id", "left_semi").select(hashed.alias("image_hash"))
    return new_by_hash(rows, target, "image_hash", "id")


