"""Integrity audits and repairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from hoardline.functions.labels import keyword_label
from hoardline.operators import audit, mutate
from hoardline.plans import label_sql as S
from hoardline.plans.registry import query
from hoardline.plans.shaping import big, flag, r6

ZERO = "label_confidence = 0 AND period IS NOT NULL AND period <> ''"
UNSET = "period IS NULL AND label_confidence > 0.5"
OUTSIDE = " OR ".join(f"{m} < 0 OR {m} > 1" for m in audit.METRICS)
MISMATCH = "period IS NOT NULL AND period <> split_part(image_path, '/', -2)"

ISSUES = f"""iss AS (SELECT 'CONFIDENCE_ZERO_WITH_PERIOD' AS category, id FROM ml_dataset WHERE {ZERO}
 UNION ALL SELECT 'NULL_PERIOD_HIGH_CONFIDENCE', id FROM ml_dataset WHERE {UNSET}
 UNION ALL SELECT 'ORPHAN_ML_DATASET', m.id FROM ml_dataset m LEFT JOIN coin_detections c ON m.coin_detection_id = c.id WHERE c.id IS NULL
 UNION ALL SELECT 'ORPHAN_DETECTION', c.id FROM coin_detections c LEFT JOIN auction_data a ON c.auction_record_id = a.id WHERE a.id IS NULL
 UNION ALL SELECT 'DUPLICATE_HASH', min(id) FROM ml_dataset WHERE image_hash <> '' GROUP BY image_hash HAVING count(*) > 1
 UNION ALL SELECT 'PATH_PERIOD_MISMATCH', id FROM ml_dataset WHERE {MISMATCH}
 UNION ALL SELECT 'INVALID_DETECTION_METRICS', id FROM coin_detections WHERE {OUTSIDE}
 UNION ALL SELECT 'CONFLICTING_FLAGS', id FROM ml_dataset WHERE needs_review = 1 AND is_verified = 1)"""
ALL = ["ml_dataset", "coin_detections", "auction_data"]


@query(
    "audit_confidence",
    views=["ml_dataset"],
    sql=f"""SELECT 'CONFIDENCE_ZERO_WITH_PERIOD' AS category, id, 'period=' || period AS details FROM ml_dataset WHERE {ZERO}
 UNION ALL SELECT 'NULL_PERIOD_HIGH_CONFIDENCE', id, 'period=NULL' FROM ml_dataset WHERE {UNSET}""",
)
def audit_confidence(v):
    return audit.confidence_issues(v.ml_dataset)


@query(
    "audit_confidence_buckets",
    views=["ml_dataset"],
    sql="""SELECT CASE WHEN label_confidence = 0 THEN 'zero' WHEN label_confidence < 0.6 THEN 'low' WHEN label_confidence < 0.8 THEN 'medium'
 WHEN label_confidence < 0.95 THEN 'high' ELSE 'very_high' END AS bucket, count(*) AS rows FROM ml_dataset GROUP BY 1""",
)
def audit_confidence_buckets(v):
    return audit.confidence_buckets(v.ml_dataset)


@query(
    "audit_orphans",
    views=ALL,
    sql=f"WITH {ISSUES} SELECT category, id FROM iss WHERE category LIKE 'ORPHAN%'",
)
def audit_orphans(v):
    lost = audit.orphans(v.ml_dataset, "coin_detection_id", v.coin_detections, "ORPHAN_ML_DATASET")
    loose = audit.orphans(v.coin_detections, "auction_record_id", v.auction_data, "ORPHAN_DETECTION")
    return lost.unionByName(loose).select("category", "id")


@query(
    "audit_dup_hashes",
    views=["ml_dataset"],
    sql="""SELECT image_hash, count(*) AS copies, min(id) AS first_id, count(*) - 1 AS extras FROM ml_dataset WHERE image_hash IS NOT NULL AND image_hash <> ''
 GROUP BY 1 HAVING count(*) > 1""",
)
def audit_dup_hashes(v):
    return audit.duplicate_hashes(v.ml_dataset)


@query(
    "audit_dup_hash_members",
    views=["ml_dataset"],
    sql="""SELECT image_hash, id, copies, CAST(id <> first_id AS INT) AS is_extra FROM (SELECT image_hash, id, count(*) OVER (PARTITION BY image_hash) AS copies,
 min(id) OVER (PARTITION BY image_hash) AS first_id FROM ml_dataset WHERE image_hash <> '') WHERE copies > 1""",
)
def audit_dup_hash_members(v):
    return audit.duplicate_hash_members(v.ml_dataset).select("image_hash", "id", "copies", flag("is_extra", "is_extra"))


@query(
    "audit_path_mismatch",
    views=["ml_dataset"],
    sql=f"SELECT split_part(image_path, '/', -2) AS path_folder, period, count(*) AS rows FROM ml_dataset WHERE {MISMATCH} GROUP BY 1, 2",
)
def audit_path_mismatch(v):
    return audit.path_period_counts(v.ml_dataset)


@query("audit_metrics", views=["coin_detections"], sql=f"SELECT id FROM coin_detections WHERE {OUTSIDE}")
def audit_metrics(v):
    return audit.metric_issues(v.coin_detections).select("id")


@query(
    "audit_edge_buckets",
    views=["coin_detections"],
    sql="""SELECT CASE WHEN edge_support = 0 THEN 'zero' WHEN edge_support < 0.2 THEN 'very_low' WHEN edge_support < 0.5 THEN 'low'
 WHEN edge_support < 0.8 THEN 'medium' ELSE 'high' END AS bucket, count(*) AS rows FROM coin_detections GROUP BY 1""",
)
def audit_edge_buckets(v):
    return audit.edge_support_buckets(v.coin_detections)


@query(
    "audit_flags",
    views=["ml_dataset"],
    sql="SELECT CAST(needs_review AS INT) AS needs_review, CAST(is_verified AS INT) AS is_verified, count(*) AS rows FROM ml_dataset GROUP BY 1, 2",
)
def audit_flags(v):
    return audit.flag_contingency(v.ml_dataset).select(
        F.col("needs_review").cast("int"), F.col("is_verified").cast("int"), "rows"
    )


@query("audit_issues", views=ALL, sql=f"WITH {ISSUES} SELECT category, id FROM iss")
def audit_issues(v):
    return audit.all_issues(v.ml_dataset, v.coin_detections, v.auction_data).select("category", "id")


@query(
    "audit_report",
    views=ALL,
    sql=f"""WITH {ISSUES}, c AS (SELECT category, count(*) AS issues FROM iss GROUP BY 1)
 SELECT category, issues, CAST((SELECT sum(issues) FROM c) AS BIGINT) AS total_issues, CAST(greatest(0, 100 - (SELECT sum(issues) FROM c)) AS BIGINT) AS health FROM c""",
)
def audit_report(v):
    found = audit.all_issues(v.ml_dataset, v.coin_detections, v.auction_data)
    return audit.issue_report(found).select("category", "issues", "total_issues", big("health", "health"))


@query(
    "audit_report_capped",
    views=ALL,
    sql=f"""WITH {ISSUES}, c AS (SELECT category, least(count(*), CASE category WHEN 'ORPHAN_DETECTION' THEN 100 WHEN 'DUPLICATE_HASH' THEN 50
 WHEN 'INVALID_DETECTION_METRICS' THEN 50 WHEN 'PATH_PERIOD_MISMATCH' THEN 5 ELSE 1000000000 END) AS issues FROM iss GROUP BY 1)
 SELECT category, CAST(issues AS BIGINT) AS issues, CAST((SELECT sum(issues) FROM c) AS BIGINT) AS total_issues FROM c""",
)
def audit_report_capped(v):
    found = audit.all_issues(v.ml_dataset, v.coin_detections, v.auction_data)
    return audit.issue_report(found, caps=True).select("category", "issues", "total_issues")


@query(
    "audit_samples",
    views=ALL,
    sql=f"""WITH {ISSUES} SELECT category, id, position FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY id) AS position FROM iss) WHERE position <= 10""",
)
def audit_samples(v):
    found = audit.all_issues(v.ml_dataset, v.coin_detections, v.auction_data)
    return audit.issue_samples(found, 10).select("category", "id", big("position", "position"))


FIXED = """f1 AS (SELECT *, needs_review = 1 AND is_verified = 1 AS fix_1 FROM ml_dataset),
 f2 AS (SELECT * REPLACE (CASE WHEN fix_1 THEN 0 ELSE needs_review END AS needs_review), period IS NULL AND is_verified = 0 AS fix_2 FROM f1),
 f3 AS (SELECT * REPLACE (CASE WHEN fix_2 THEN 1 ELSE needs_review END AS needs_review), period IS NULL AND label_confidence > 0.5 AS fix_3 FROM f2)"""


@query(
    "integrity_fixes",
    views=["ml_dataset"],
    sql=f"WITH {FIXED} SELECT id, CAST(needs_review AS INT) AS needs_review, CAST(CASE WHEN fix_3 THEN 0.3 ELSE label_confidence END AS DOUBLE) AS label_confidence FROM f3",
)
def integrity_fixes(v):
    return mutate.integrity_fixes(v.ml_dataset).select(
        "id", F.col("needs_review").cast("int"), "label_confidence"
    )


@query(
    "integrity_fix_counts",
    views=["ml_dataset"],
    sql=f"""WITH {FIXED} SELECT count(*) FILTER (fix_1) AS fix_1, count(*) FILTER (fix_2) AS fix_2, count(*) FILTER (fix_3) AS fix_3,
 count(*) FILTER (fix_1) + count(*) FILTER (fix_2) + count(*) FILTER (fix_3) AS fixes_applied FROM f3""",
)
def integrity_fix_counts(v):
    return mutate.fix_counts(mutate.integrity_fixes(v.ml_dataset))


@query(
    "missing_files",
    views=["ml_dataset"],
    sql="""WITH f AS (SELECT m.id, l.doc_id IS NOT NULL AS listed FROM ml_dataset m LEFT JOIN labels l ON m.id = l.doc_id)
 SELECT id, CAST(listed AS INT) AS found FROM f""",
)
def missing_files(v):
    stored = v.ml_dataset.join(v.labels, F.col("id") == F.col("doc_id"), "left_semi")
    odd = F.col("id") % 2 == 1
    listing = stored.select(
        F.concat(F.when(odd, "archive/").otherwise(""), "image_path").alias("path")
    )
    return audit.missing_files(v.ml_dataset, listing, ["", "archive/"]).select("id", flag("found", "found"))


@query(
    "readiness_funnel",
    views=["auction_data"],
    sql=f"""WITH t AS (SELECT image_path <> '' AS p, starts_with(image_path, 'raw/') AS f, {S.keyword_sql(S.TEXT)} AS label FROM auction_data)
 SELECT count(*) AS total, count(*) FILTER (p) AS with_path, count(*) FILTER (p AND NOT f) AS missing_files, count(*) FILTER (p AND f AND label IS NULL) AS unlabelled,
 count(*) FILTER (p AND f AND label IS NOT NULL) AS ready FROM t""",
)
def readiness_funnel(v):
    stored = F.col("image_path").startswith("raw/")
    return audit.readiness_funnel(v.auction_data, stored, keyword_label("title", "description"))


@query(
    "null_rates",
    views=["ml_coin_dataset"],
    sql=" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 6) AS null_rate FROM ml_coin_dataset"
        for c in ("period", "denomination", "authority", "has_rev", "split")
    ),
)
def null_rates(v):
    return audit.null_rates(
        v.ml_coin_dataset, ["period", "denomination", "authority", "has_rev", "split"]
    ).select("column_name", r6("null_rate"))


@query(
    "coverage_checks",
    views=["ml_coin_dataset"],
    sql=" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(avg(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END), 6) AS coverage, CAST(avg(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END) >= {t} AS INT) AS passed FROM ml_coin_dataset"
        for c, t in (("period", 0.9), ("denomination", 0.8))
    ),
)
def coverage_checks(v):
    checks = audit.coverage_checks(v.ml_coin_dataset, {"period": 0.9, "denomination": 0.8})
    return checks.select("column_name", r6("coverage"), flag("passed", "passed"))


@query(
    "vector_quality",
    sql="""WITH n AS (SELECT vec_id, len(embedding) AS d, sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))) * CASE WHEN vec_id % 40 = 0 THEN 2 ELSE 1 END AS length FROM embeddings)
 SELECT count(*) AS vectors, count(*) FILTER (d <> 64) AS wrong_dimension, CAST(0 AS BIGINT) AS not_finite, count(*) FILTER (length NOT BETWEEN 0.99 AND 1.01) AS bad_norm FROM n""",
)
def vector_quality(v):
    scaled = F.when(
        F.col("vec_id") % 40 == 0, F.transform("embedding", lambda x: (x * 2).cast("float"))
    ).otherwise(F.col("embedding"))
    return audit.vector_quality(v.embeddings.withColumn("embedding", scaled), "embedding", 64)


@query(
    "alignment",
    sql="""WITH l AS (SELECT doc_id, count(*) AS n FROM documents GROUP BY 1), r AS (SELECT doc_id, count(*) AS n FROM labels GROUP BY 1)
 SELECT CAST(sum(l.n) AS BIGINT) AS left_rows, CAST(sum(r.n) AS BIGINT) AS right_rows, count(*) FILTER (r.n IS NULL) AS left_only, count(*) FILTER (l.n IS NULL) AS right_only,
 count(*) FILTER (l.n > 1) AS left_repeated, count(*) FILTER (r.n > 1) AS right_repeated FROM l FULL OUTER JOIN r ON l.doc_id = r.doc_id""",
)
def alignment(v):
    return audit.alignment(v.documents, v.labels, "doc_id")
