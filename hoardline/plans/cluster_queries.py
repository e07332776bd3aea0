"""Cluster bookkeeping and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from hoardline.operators import clusters, enrich, grouping, matching, mutate
from hoardline.plans.registry import query
from hoardline.plans.shaping import big, r6

PARTS = """prt AS (SELECT cluster_id, coalesce(nullif(parser_period, ''), 'unknown') AS period, count(*) AS rows, sum(cluster_confidence) AS conf FROM cluster_results GROUP BY 1, 2),
 rkd AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY rows DESC, period) AS place FROM prt),
 summ AS (SELECT cluster_id, CAST(sum(rows) AS BIGINT) AS size, max(CASE WHEN place = 1 THEN period END) AS dominant_period, max(CASE WHEN place = 2 THEN period END) AS second_period,
  max(rows) / CAST(sum(rows) AS DOUBLE) AS purity, sum(conf) / CAST(sum(rows) AS DOUBLE) AS avg_confidence FROM rkd GROUP BY 1)"""


@query(
    "cluster_summary",
    views=["cluster_results"],
    sql=f"""WITH {PARTS} SELECT CASE WHEN cluster_id = '-1' THEN 'noise' ELSE 'cluster_' || cluster_id END AS cluster, size, dominant_period,
 round(purity, 6) AS purity, round(avg_confidence, 6) AS avg_confidence FROM summ""",
)
def cluster_summary(v):
    return clusters.cluster_summary(v.cluster_results).select(
        "cluster", "size", "dominant_period", r6("purity"), r6("avg_confidence")
    )


@query(
    "cluster_breakdown",
    views=["cluster_results"],
    sql=f"WITH {PARTS} SELECT cluster_id, period, rows, place FROM rkd",
)
def cluster_breakdown(v):
    return clusters.period_breakdown(v.cluster_results).select(
        "cluster_id", "period", "rows", big("place", "place")
    )


@query(
    "cluster_counts",
    views=["cluster_results"],
    sql="""SELECT count(DISTINCT CASE WHEN cluster_id <> '-1' THEN cluster_id END) AS clusters, count(*) FILTER (cluster_id = '-1') AS noise,
 round(avg(CASE WHEN cluster_id = '-1' THEN 1 ELSE 0 END) * 100, 6) AS noise_percent FROM cluster_results""",
)
def cluster_counts(v):
    return clusters.cluster_counts(v.cluster_results).select("clusters", "noise", r6("noise_percent"))


@query(
    "cluster_names",
    views=["cluster_results"],
    sql=f"""WITH {PARTS} SELECT cluster_id, CASE WHEN purity > 0.8 THEN dominant_period || '_pure' WHEN purity > 0.5 THEN dominant_period || '_with_' || coalesce(second_period, 'mixed')
 ELSE 'mixed_' || dominant_period || '_' || second_period END AS suggested_name FROM summ WHERE cluster_id <> '-1'""",
)
def cluster_names(v):
    return clusters.suggest_names(clusters.cluster_summary(v.cluster_results))


SUB = """sub AS (SELECT cluster_id AS parent_id, id, CASE WHEN id % 7 = 0 THEN '-1' ELSE CAST(id % 3 AS VARCHAR) END AS sub_id FROM cluster_results WHERE cluster_id <> '-1')"""


@query(
    "merge_subclusters",
    views=["cluster_results"],
    sql=f"""WITH {SUB}, m AS (SELECT id, parent_id || '-' || CASE WHEN sub_id = '-1' THEN 'noise' ELSE sub_id END AS nid FROM sub)
 SELECT c.id, coalesce(m.nid, c.cluster_id) AS cluster_id, CASE WHEN m.nid IS NOT NULL THEN 'cluster_' || m.nid ELSE c.visual_cluster END AS visual_cluster
 FROM cluster_results c LEFT JOIN m ON c.id = m.id""",
)
def merge_subclusters(v):
    staged = clusters.split_subset(v.cluster_results).where(F.col("parent_id") != "-1")
    sub = staged.select(
        "parent_id",
        F.concat(F.lit("staging/"), "unique_name").alias("image_path"),
        F.when(F.col("id") % 7 == 0, "-1").otherwise((F.col("id") % 3).cast("string")).alias("cluster_id"),
    )
    return clusters.merge_subclusters(v.cluster_results, sub).select("id", "cluster_id", "visual_cluster")


@query(
    "split_subset",
    views=["cluster_results"],
    sql="SELECT cluster_id AS parent_id, id, CAST(id AS VARCHAR) || '_' || regexp_extract(image_path, '[^/]*$') AS unique_name FROM cluster_results",
)
def split_subset(v):
    return clusters.split_subset(v.cluster_results)


@query(
    "samples_per_cluster",
    views=["cluster_results"],
    sql="""SELECT cluster_id, id, sample_rank FROM (SELECT cluster_id, id, row_number() OVER (PARTITION BY cluster_id ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id) AS sample_rank FROM cluster_results)
 WHERE sample_rank <= 20""",
)
def samples_per_cluster(v):
    return clusters.samples_per_cluster(v.cluster_results, 20).select(
        "cluster_id", "id", big("sample_rank", "sample_rank")
    )


PUSHED = """(SELECT source || '/' || lang || '/doc_' || CAST(doc_id AS STRING) || CASE WHEN n_chars > 500 THEN '.jpg' ELSE '.png' END AS image_path,
 CASE WHEN doc_id % 5 = 0 THEN '-1' WHEN doc_id % 11 = 0 THEN '4-noise' ELSE CAST(doc_id % 7 AS STRING) END AS cluster_id FROM {documents})"""


@query(
    "push_clusters",
    views=["ml_dataset"],
    sql=f"""SELECT m.id, CASE WHEN p.cluster_id IS NULL THEN m.visual_cluster_id WHEN p.cluster_id = '-1' OR contains(p.cluster_id, 'noise') THEN '-1' ELSE p.cluster_id END AS visual_cluster_id,
 CASE WHEN p.cluster_id = '-1' OR contains(p.cluster_id, 'noise') THEN 'Noise' ELSE 'Cluster ' || p.cluster_id END AS visual_cluster_name
 FROM ml_dataset m LEFT JOIN {PUSHED.format(documents='documents')} p ON m.image_path = p.image_path""",
)
def push_clusters(v):
    results = v.spark.sql(f"SELECT * FROM {PUSHED}", documents=v.documents)
    return mutate.push_clusters(v.ml_dataset, results).select(
        "id", "visual_cluster_id", "visual_cluster_name"
    )


# The newest label row and the newest detection's lot of each coin, as one struct each.
ENRICHED = """newest_label AS (SELECT coin_id AS label_coin, max({'id': id, 'path': obv_path, 'denomination': denomination, 'period': period}) AS label
 FROM ml_coin_dataset GROUP BY label_coin),
 newest_lot AS (SELECT coin_id AS lot_coin, max({'id': found.id, 'number': lot.lot_number, 'sale': lot.sale_id, 'house': lot.auction_house, 'title': lot.title}) AS lot
 FROM coin_detections found LEFT JOIN auction_data lot ON lot.id = found.auction_record_id GROUP BY lot_coin),
 en AS (SELECT id, cluster_id, lot.title AS lot_title, lot.number AS lot_number, lot.house AS auction_house, lot.sale AS sale_id,
 label.path AS label_obv_path, label.denomination AS label_denomination, label.period AS label_period
 FROM cluster_results LEFT JOIN newest_lot ON lot_coin = id LEFT JOIN newest_label ON label_coin = id)"""
ENRICH_VIEWS = ["cluster_results", "ml_coin_dataset", "coin_detections", "auction_data"]


def _enriched(v):
    return enrich.enrich_clusters(
        v.cluster_results.select("id", "cluster_id", "image_path"), v.ml_coin_dataset, v.coin_detections, v.auction_data
    )


@query("enrich_clusters", views=ENRICH_VIEWS, sql=f"WITH {ENRICHED} SELECT * FROM en")
def enrich_clusters(v):
    return _enriched(v).select(
        "id", "cluster_id", "label_period", "label_denomination", "label_obv_path", "lot_number",
        "lot_title", "auction_house", "sale_id",
    )


@query(
    "enrich_match_rate",
    views=ENRICH_VIEWS,
    sql=f"""WITH {ENRICHED} SELECT count(*) AS rows, count(lot_number) AS matched, round(100.0 * count(lot_number) / count(*), 6) AS percent FROM en""",
)
def enrich_match_rate(v):
    return enrich.match_rate(_enriched(v)).select("rows", "matched", r6("percent"))


# ---- vectors joined by path ----------------------------------------------------------------------


@query(
    "embedding_join",
    views=["cluster_results"],
    sql="SELECT id, id AS vec_id, CAST(round(embedding[1], 6) AS DOUBLE) AS first_value FROM cluster_results",
)
def embedding_join(v):
    spelled = (
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("./"), "image_path"))
        .when(F.col("id") % 3 == 1, F.concat(F.lit("/"), "image_path"))
        .otherwise(F.col("image_path"))
    )
    records = v.cluster_results.select("id", spelled.alias("image_path"))
    vectors = v.cluster_results.select(F.col("id").alias("vec_id"), F.col("image_path").alias("path"), "embedding")
    joined = matching.vectors_by_path(records, vectors, [("image_path", "path")], ["embedding"])
    return joined.select("id", "vec_id", r6(F.get("embedding", F.lit(0)).cast("double"), "first_value"))


@query(
    "pair_embedding_join",
    views=["ml_coin_dataset"],
    sql="""SELECT coin_id AS id, coin_id AS vec_id FROM ml_coin_dataset WHERE has_rev = 1""",
)
def pair_embedding_join(v):
    records = v.ml_coin_dataset.select(
        F.col("coin_id").alias("id"), F.concat(F.lit("./"), "obv_path").alias("obv_path"), "rev_path"
    )
    vectors = v.ml_coin_dataset.where(F.col("has_rev") == 1).select(
        F.col("coin_id").alias("vec_id"),
        F.col("obv_path").alias("obverse_path"),
        F.concat(F.lit("/"), "rev_path").alias("reverse_path"),
    )
    pairs = [("obv_path", "obverse_path"), ("rev_path", "reverse_path")]
    return matching.vectors_by_path(records, vectors, pairs, []).select("id", "vec_id")


SIDE_ROWS = """(SELECT vec_id AS id, replace(path, '_224.jpg', '.png') AS image_path, path FROM side_embeddings)"""


@query(
    "lot_key_join",
    views=["side_embeddings"],
    sql=f"""WITH k AS (SELECT *, regexp_replace(path, '_224.jpg', '') AS k FROM side_embeddings), m AS (SELECT lower(k) AS k, max(vec_id) AS vec_id FROM k GROUP BY 1)
 SELECT s.id, m.vec_id FROM {SIDE_ROWS} s JOIN m ON lower(replace(s.path, '_224.jpg', '')) = m.k""",
)
def lot_key_join(v):
    sides = v.side_embeddings.select(
        F.col("vec_id").alias("id"),
        F.replace("path", F.lit("_224.jpg"), F.lit(".png")).alias("image_path"),
    )
    return matching.vectors_by_lot(sides, v.side_embeddings.select("vec_id", "path"), []).select("id", "vec_id")


@query(
    "lot_key_match_counts",
    views=["side_embeddings", "cluster_results"],
    sql="""WITH k AS (SELECT DISTINCT lower(split_part(path, '/', -3)) || '_' || split_part(path, '/', -2) || '_' || regexp_extract(path, 'Lot_([0-9]+)', 1) AS k FROM side_embeddings)
 SELECT count(*) FILTER (c.n IN (SELECT k FROM k)) AS matched, count(*) FILTER (c.n NOT IN (SELECT k FROM k)) AS unmatched
 FROM (SELECT replace(regexp_extract(image_path, '[^/]*$'), '.jpg', '') AS n FROM cluster_results) c""",
)
def lot_key_match_counts(v):
    sides = v.cluster_results.select("id", "image_path")
    matched = matching.vectors_by_lot(sides, v.side_embeddings.select("vec_id", "path"), [], with_side=False)
    return matching.match_counts(matched)


@query(
    "side_of_path",
    views=["side_embeddings", "ml_dataset"],
    sql="""SELECT vec_id, CASE WHEN period IS NULL THEN 'unknown' ELSE s.side END AS looked_up FROM (
  SELECT vec_id, period, CASE WHEN path LIKE '%_obv%' THEN 'obverse' ELSE 'reverse' END AS side FROM side_embeddings) s""",
)
def side_of_path(v):
    unique = F.concat(F.col("path"), F.lit("#"), F.col("vec_id").cast("string"))
    rows = v.side_embeddings.select("vec_id", unique.alias("image_path"))
    manifest = v.side_embeddings.where(F.col("period").isNotNull()).select(
        F.concat(F.lit("./"), F.replace(unique, F.lit("/"), F.lit("\\"))).alias("image_path"),
        F.when(F.col("path").contains("_obv"), "obverse").otherwise("reverse").alias("side"),
    )
    return matching.side_of_path(rows, manifest).select("vec_id", F.col("side").alias("looked_up"))


@query(
    "overlap_diagnostics",
    views=["side_embeddings", "cluster_results"],
    sql="""SELECT 'same_id' AS test, count(*) AS rows FROM cluster_results WHERE id IN (SELECT coin_id FROM side_embeddings)
 UNION ALL SELECT 'same_file_name', count(*) FROM cluster_results WHERE regexp_extract(image_path, '[^/]*$') IN (SELECT regexp_extract(path, '[^/]*$') FROM side_embeddings)
 UNION ALL SELECT 'vectors_of_sale', count(*) FROM side_embeddings WHERE contains(lower(path), 'leu_1') OR contains(lower(path), 'leu/1')""",
)
def overlap_diagnostics(v):
    return matching.overlap_diagnostics(
        v.cluster_results.select("id", "image_path"), v.side_embeddings.select("coin_id", "path"), "leu_1"
    )


# ---- clustering ---------------------------------------------------------------------------------


@query("pca_reduce", views=["cluster_results"])
def pca_reduce(v):
    reduced, model = grouping.reduce_dimensions(v.cluster_results.select("id", "embedding"), 8)
    explained = float(model.explainedVariance.toArray().sum())
    return reduced.select("id", F.size("reduced").alias("dimension"), F.lit(round(explained, 4)).alias("explained"))


def density_sql(rows: str, eps: float, min_samples: int, least: int, extra: str = "") -> str:
    """Flat density cut over ``rows`` (id, embedding); the similarities are rounded as in the operators."""
    return f"""WITH RECURSIVE pairs AS (SELECT a.id AS u, b.id AS v, sqrt(greatest(0, 2 - 2 * round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6))) AS d
  FROM {rows} a JOIN {rows} b ON a.id <> b.id),
 cores AS (SELECT u, d AS core FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY d) AS n FROM pairs) WHERE n = {min_samples} AND d <= {eps}),
 steps AS (SELECT p.u, p.v FROM pairs p JOIN cores a ON p.u = a.u JOIN cores b ON p.v = b.u WHERE d <= {eps}),
 reach AS (SELECT u, u AS c FROM cores UNION SELECT s.v, r.c FROM reach r JOIN steps s ON s.u = r.u),
 parts AS (SELECT u, min(c) AS c FROM reach GROUP BY u),
 numbered AS (SELECT c, row_number() OVER (ORDER BY count(*) DESC, c) - 1 AS cluster_id FROM parts GROUP BY c HAVING count(*) >= {least}),
 found AS (SELECT r.id, coalesce(n.cluster_id, -1) AS cluster_id, core FROM {rows} r LEFT JOIN parts p ON p.u = r.id LEFT JOIN numbered n ON n.c = p.c LEFT JOIN cores k ON k.u = r.id)
 SELECT id, cluster_id, round(CASE WHEN cluster_id < 0 THEN 0.0 WHEN core > 0 THEN min(core) OVER (PARTITION BY cluster_id) / core ELSE 1.0 END, 6) AS cluster_confidence{extra} FROM found"""


@query("density_cluster", views=["cluster_results"], sql=density_sql("cluster_results", 1.05, 5, 10))
def density_cluster(v):
    rows = v.cluster_results.select("id", "embedding")
    found = grouping.density_clusters(rows, eps=1.05, min_samples=5, min_cluster_size=10)
    return found.select("id", "cluster_id", r6("cluster_confidence"))


@query("kmeans_cluster", views=["cluster_results"])
def kmeans_cluster(v):
    found = grouping.kmeans_clusters(v.cluster_results.select("id", "embedding"), 10)
    return grouping.result_rows(grouping.with_plane(v.cluster_results), found).select(
        "id", "cluster_id", "visual_cluster", r6("cluster_confidence"), r6("x"), r6("y")
    )


@query(
    "kmeans_variance",
    views=["cluster_results"],
    sql="""WITH p AS (SELECT id, unnest(range(len(embedding))) AS axis, CAST(unnest(embedding) AS DOUBLE) AS value FROM cluster_results),
 a AS (SELECT axis, count(*) AS n, var_pop(value) * count(*) AS squares FROM p GROUP BY axis)
 SELECT max(n) AS rows, CAST(10 AS BIGINT) AS clusters, round(sum(squares), 4) AS total, 1 AS closer FROM a""",
)
def kmeans_variance(v):
    """The squares within and between the clusters make up those of the whole, and clusters are closer than the whole."""
    rows = v.cluster_results.select("id", "embedding")
    parts = grouping.variance_parts(rows, grouping.kmeans_clusters(rows, 10))
    whole = F.col("within") + F.col("between")
    return parts.select(
        "rows", "clusters", F.round(whole, 4).alias("total"), F.when(F.col("within") < whole, 1).otherwise(0).alias("closer")
    )


@query(
    "drill_down",
    views=["cluster_results"],
    sql=density_sql("(SELECT * FROM cluster_results WHERE cluster_id = '3')", 1.2, 2, 5, ", '3' AS parent_id"),
)
def drill_down(v):
    found = grouping.drill_down(
        v.cluster_results.select("id", "embedding"), v.cluster_results, parent="3", eps=1.2
    )
    return found.select("id", "cluster_id", r6("cluster_confidence"), "parent_id")
