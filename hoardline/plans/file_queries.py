"""File sources and sinks, snapshots and incremental jobs.

Each query writes a whole table in the format under test to a new folder below the shared scratch
folder and reads it back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from hoardline import schemas
from hoardline.functions.labels import keyword_label
from hoardline.operators import knn, search, splits
from hoardline.plans import label_sql as S
from hoardline.plans.catalogue_queries import FEEDBACK
from hoardline.plans.registry import query
from hoardline.plans.shaping import big, flag, r6
from hoardline.plans.vector_queries import neighbours_sql
from hoardline.session import scratch_path
from hoardline.sources import files, sinks, snapshots, tables
from hoardline.streaming import feedback as feedback_stream
from hoardline.streaming import lots as lot_stream

# ---- manifests ----------------------------------------------------------------------------------


def _manifest(v):
    """Records of the three pair schemas and of single sides, in document order."""
    kind = F.col("doc_id") % 4
    path = F.format_string("img/%06d", "doc_id")
    obverse, reverse = F.concat(path, F.lit("_obv.jpg")), F.concat(path, F.lit("_rev.jpg"))
    return v.documents.orderBy("doc_id").select(
        F.col("doc_id").alias("id"),
        F.when(kind == 3, F.concat(path, F.lit(".jpg"))).alias("image_path"),
        F.when(kind == 0, F.struct(obverse.alias("image_path"))).alias("obverse"),
        F.when(kind == 0, F.struct(reverse.alias("image_path"))).alias("reverse"),
        F.when(kind == 1, obverse).alias("obv_path"),
        F.when(kind == 1, reverse).alias("rev_path"),
        F.when(kind == 2, obverse).alias("obverse_path"),
        F.when(kind == 2, reverse).alias("reverse_path"),
        F.when(F.col("n_chars") % 3 == 0, "no").when(F.col("n_chars") % 3 == 1, "Yes ").alias("has_obv"),
        F.when(F.col("n_chars") % 2 == 0, F.concat(F.lit("c"), F.col("source"))).alias("coin_identity"),
        F.col("lang").alias("period"),
    )


def _read_manifest(v):
    path = scratch_path(v.spark, "manifest")
    _manifest(v).write.json(path)
    return files.read_manifest(v.spark, path)


@query(
    "manifest_index",
    sql="""SELECT doc_id AS id, row_number() OVER (ORDER BY doc_id) - 1 AS manifest_index, lang AS period FROM documents""",
)
def manifest_index(v):
    return _read_manifest(v).select("id", F.col("_manifest_index").alias("manifest_index"), "period")


@query(
    "manifest_pairs",
    sql="""WITH m AS (SELECT doc_id AS id, row_number() OVER (ORDER BY doc_id) - 1 AS i, n_chars, source, doc_id % 4 < 3 AS pair, 'img/' || lpad(CAST(doc_id AS VARCHAR), 6, '0') AS p FROM documents)
 SELECT id, CASE WHEN pair THEN p || '_obv.jpg' END AS obverse, CASE WHEN pair THEN p || '_rev.jpg' END AS reverse, CAST(pair AND n_chars % 3 <> 0 AS INT) AS is_complete,
 CASE WHEN n_chars % 2 = 0 THEN 'c' || source ELSE 'coin_' || CAST(i AS VARCHAR) END AS coin_identity FROM m""",
)
def manifest_pairs(v):
    pairs = splits.canonical_pairs(_read_manifest(v))
    return pairs.select(
        "id", F.col("pair_obverse").alias("obverse"), F.col("pair_reverse").alias("reverse"),
        flag("is_complete", "is_complete"), F.col("pair_identity").alias("coin_identity"),
    )


@query("manifest_kind", sql="SELECT CASE WHEN count(*) FILTER (doc_id % 4 < 3) > 0 THEN 'pairs' ELSE 'sides' END AS kind FROM documents")
def manifest_kind(v):
    return splits.manifest_kind(splits.canonical_pairs(_read_manifest(v)))


@query(
    "split_manifest_union",
    views=["ml_dataset"],
    sql="SELECT id, image_path, period, split FROM ml_dataset",
)
def split_manifest_union(v):
    path = scratch_path(v.spark, "manifests")
    sinks.write_manifests(v.ml_dataset.select("id", "image_path", "period", "split"), path)
    parts = {s: f"{path}/json/split={s}" for s in ("train", "val", "test")}
    return files.read_split_manifests(v.spark, parts).select("id", "image_path", "period", "split")


@query(
    "manifest_csv",
    views=["ml_dataset"],
    sql="SELECT id, image_path, period, split FROM ml_dataset",
)
def manifest_csv(v):
    path = scratch_path(v.spark, "manifests")
    sinks.write_manifests(v.ml_dataset.select("id", "image_path", "period", "split"), path)
    schema = "id long, image_path string, period string, split string"
    return v.spark.read.schema(schema).option("header", True).csv(f"{path}/csv")


@query(
    "training_manifest",
    views=["auction_data", "ml_dataset"],
    sql=f"""SELECT image_path, period, 'database' AS source, id AS db_id FROM (SELECT id, image_path, {S.keyword_sql(S.TEXT)} AS period FROM auction_data WHERE image_path <> '') WHERE period IS NOT NULL
 UNION ALL SELECT 'corrections/' || c || '/' || CAST(id AS VARCHAR) || '.JPG', c, 'human_correction', -1 FROM (SELECT id, CASE WHEN period = 'en' THEN 'greek' WHEN period = 'de' THEN 'celtic' ELSE 'misc' END AS c FROM ml_dataset WHERE is_verified = 1) WHERE c <> 'misc'""",
)
def training_manifest(v):
    labelled = v.auction_data.where(F.col("image_path") != "").withColumn(
        "period", keyword_label("title", "description")
    )
    folder = (
        F.when(F.col("period") == "en", "greek").when(F.col("period") == "de", "celtic").otherwise("misc")
    )
    listing = v.ml_dataset.where(F.col("is_verified") == 1).select(
        F.concat_ws("/", F.lit("corrections"), folder, F.concat(F.col("id").cast("string"), F.lit(".JPG"))).alias("path")
    )
    manifest = files.training_manifest(
        labelled.where(F.col("period").isNotNull()), files.class_folders(listing)
    )
    return manifest.select(
        "image_path", "period", "source", F.coalesce("db_id", F.lit(-1)).alias("db_id")
    )


@query(
    "verified_manifest",
    views=["ml_dataset"],
    sql="""SELECT image_path, period, 'ml_dataset' AS source, id AS db_id, CAST(is_verified AS INT) AS is_verified FROM ml_dataset WHERE image_path IS NOT NULL AND period IS NOT NULL""",
)
def verified_manifest(v):
    path = scratch_path(v.spark, "manifest")
    rows = v.ml_dataset.where(F.col("image_path").isNotNull() & F.col("period").isNotNull()).select(
        "image_path", "period", F.lit("ml_dataset").alias("source"), F.col("id").alias("db_id"),
        F.col("is_verified").cast("int"),
    )
    sinks.write_training_manifest(rows, path)
    return v.spark.read.schema(rows.schema).json(path)


@query(
    "directory_dataset",
    views=["ml_dataset"],
    sql="""WITH f AS (SELECT CASE WHEN doc_id % 5 = 0 THEN 'img/x' || lpad(CAST(doc_id AS VARCHAR), 6, '0') || '.png' ELSE 'img/' || CAST(doc_id * 2 AS VARCHAR) || '_a.jpg' END AS path, doc_id FROM documents WHERE n_chars % 7 <> 0),
 k AS (SELECT doc_id * 2 AS id, path FROM f WHERE doc_id % 5 <> 0), u AS (SELECT -row_number() OVER (ORDER BY md5(path || '-42'), path) AS id, path FROM f WHERE doc_id % 5 = 0)
 SELECT k.id, k.path AS image_path, m.period FROM k JOIN ml_dataset m ON k.id = m.id UNION ALL SELECT id, path, 'unknown' FROM u""",
)
def directory_dataset(v):
    unnamed = F.format_string("img/x%06d.png", "doc_id")
    named = F.format_string("img/%d_a.jpg", F.col("doc_id") * 2)
    other = F.format_string("img/%d_a.txt", F.col("doc_id"))
    path = F.when(F.col("n_chars") % 7 == 0, other).when(F.col("doc_id") % 5 == 0, unnamed).otherwise(named)
    listing = v.documents.select(path.alias("path"))
    return files.directory_dataset(listing, v.ml_dataset).select("id", "image_path", "period")


# ---- logs and results ----------------------------------------------------------------------------


def _write_log(v, path, with_junk=False):
    log = v.feedback_log
    at = F.col("event_id").alias("timestamp")
    corrections = log.where(F.col("kind") == "correction").select(
        at, "filename", F.col("predicted").alias("original_prediction"),
        F.col("confidence").alias("original_confidence"), F.col("actual").alias("corrected_label"),
    )
    confirmations = log.where(F.col("kind") == "confirmation").select(
        at, "filename", F.col("actual").alias("label"), "confidence"
    )
    sinks.append_feedback(confirmations, corrections, path)
    if with_junk:
        broken = log.where(F.col("confidence") > 0.9).select(F.lit('{"filename": "cut off').alias("value"))
        broken.write.mode("append").text(path)
    return path


@query(
    "feedback_logs",
    views=["feedback_log"],
    sql="SELECT event_id AS timestamp, filename, kind AS type, predicted, actual, confidence FROM feedback_log",
)
def feedback_logs(v):
    path = _write_log(v, scratch_path(v.spark, "log"), with_junk=True)
    log = files.read_json_lines(v.spark, path, schemas.FEEDBACK)
    wrong = F.col("type") == "correction"
    return log.select(
        "timestamp", "filename", "type",
        F.when(wrong, F.col("original_prediction")).otherwise(F.col("label")).alias("predicted"),
        F.when(wrong, F.col("corrected_label")).otherwise(F.col("label")).alias("actual"),
        F.when(wrong, F.col("original_confidence")).otherwise(F.col("confidence")).alias("confidence"),
    )


@query(
    "cluster_csv",
    views=["cluster_results"],
    sql="SELECT CASE WHEN id % 10 = 0 THEN -1 ELSE id END AS id, image_path, cluster_id, cluster_confidence FROM cluster_results",
)
def cluster_csv(v):
    path = scratch_path(v.spark, "clusters")
    spelled = F.when(F.col("id") % 10 == 0, "n/a").otherwise(F.col("id").cast("double").cast("string"))
    v.cluster_results.select(
        spelled.alias("id"), "image_path", "parser_period", "visual_cluster", "cluster_id", "cluster_confidence"
    ).write.option("header", True).csv(path)
    return files.read_cluster_results(v.spark, path).select(
        F.coalesce("id", F.lit(-1)).alias("id"), "image_path", "cluster_id", "cluster_confidence"
    )


@query(
    "knn_index_nested",
    views=["cluster_results"],
    sql=f"WITH {neighbours_sql('cluster_results', 'cluster_results', 5)} SELECT query_id, count(*) AS neighbours, string_agg(CAST(neighbor_id AS VARCHAR), ',' ORDER BY rank) AS ids FROM nn GROUP BY 1",
)
def knn_index_nested(v):
    path = scratch_path(v.spark, "index")
    sinks.write_knn_index(knn.knn_index(v.cluster_results, 5), path)
    schema = "query_id long, neighbors array<struct<rank: long, id: long, distance: double>>"
    index = v.spark.read.schema(schema).json(path)
    return index.select(
        "query_id",
        big(F.size("neighbors"), "neighbours"),
        F.array_join(F.transform("neighbors", lambda n: n["id"].cast("string")), ",").alias("ids"),
    )


@query(
    "vector_export",
    views=["side_embeddings"],
    sql="SELECT coalesce(period, 'unknown') AS period, count(*) AS rows FROM side_embeddings GROUP BY 1",
)
def vector_export(v):
    rows = v.side_embeddings.withColumn("period", F.coalesce("period", F.lit("unknown")))
    return sinks.write_vectors(rows, scratch_path(v.spark, "vectors"))


@query(
    "side_vectors_aligned",
    views=["side_embeddings"],
    sql="SELECT count(*) AS rows FROM side_embeddings",
)
def side_vectors_aligned(v):
    tables.check_alignment(v.side_embeddings.select("vec_id"), v.embeddings.select("vec_id"), "vec_id")
    return v.side_embeddings.agg(F.count(F.lit(1)).alias("rows"))


# ---- snapshots and incremental jobs ---------------------------------------------------------------


def _snapshot(v):
    """Labelled documents as the snapshot, the others as its delta."""
    root = scratch_path(v.spark, "store")
    rows = v.documents.select("doc_id", "lang", "source", "n_chars")
    labelled = v.labels.select("doc_id")
    snapshots.write_snapshot(rows.join(labelled, "doc_id", "left_semi"), root, 1, "lang")
    snapshots.append_delta(rows.join(labelled, "doc_id", "left_anti"), root, 1, "lang")
    return root


WHOLE = "SELECT doc_id, lang, source, n_chars FROM documents"


@query("snapshot_delta_union", sql=WHOLE)
def snapshot_delta_union(v):
    return snapshots.read_current(v.spark, _snapshot(v), 1).select("doc_id", "lang", "source", "n_chars")


@query("compaction", sql="SELECT doc_id, lang, source, n_chars, 2 AS version FROM documents")
def compaction(v):
    root = _snapshot(v)
    version = snapshots.compact(v.spark, root, 1, partition_by="lang")
    return snapshots.read_current(v.spark, root, version).select(
        "doc_id", "lang", "source", "n_chars", F.lit(version).alias("version")
    )


@query(
    "search_period_pruned",
    views=["cluster_results"],
    sql="""WITH q AS (SELECT id AS query_id, parser_period AS period, embedding AS e FROM cluster_results WHERE parser_period IN ('greek', 'islamic')),
 s AS (SELECT query_id, c.id AS neighbor_id, round(list_cosine_similarity(CAST(q.e AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), 6) AS similarity FROM q JOIN cluster_results c ON c.parser_period = q.period)
 SELECT query_id, rank, neighbor_id, similarity FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, neighbor_id) AS rank FROM s) WHERE rank <= 5""",
)
def search_period_pruned(v):
    """Each query searches its own period's partitions; the others are not opened."""
    root = scratch_path(v.spark, "corpus")
    snapshots.write_snapshot(v.cluster_results, root, 1, "parser_period")
    asked = v.cluster_results.where(F.col("parser_period").isin("greek", "islamic"))
    asked = asked.select(F.col("id").alias("query_id"), F.col("parser_period").alias("period"), "embedding")
    return search.search_partitions(asked, snapshots.read_current(v.spark, root, 1), 5, partition="parser_period", wanted="period")


@query(
    "period_prefilter",
    views=["cluster_results"],
    sql="SELECT id, cluster_id FROM cluster_results WHERE parser_period = 'greek'",
)
def period_prefilter(v):
    """Corpus partitioned by period, so a period filter reads only its folder."""
    root = scratch_path(v.spark, "corpus")
    snapshots.write_snapshot(v.cluster_results, root, 1, "parser_period")
    current = snapshots.read_current(v.spark, root, 1)
    return current.where(F.col("parser_period") == "greek").select("id", "cluster_id")


def _streamed(v):
    """Feedback of three deliveries, a file a batch: the log, the log again, and older entries that come late."""
    log, again, target, marks = (scratch_path(v.spark, x) for x in ("log", "log-part", "feedback", "marks"))
    late = F.col("event_id") % 7 == 0
    for part in (v.feedback_log.where(~late), v.feedback_log.where(~late), v.feedback_log.where(late)):
        lines = feedback_lines(part)
        lines.coalesce(1).write.mode("append").text(log)
    feedback_stream.sync_feedback(
        v.spark, log, v.ml_dataset, target, scratch_path(v.spark, "checkpoint"), marks=marks, files_per_batch=1
    ).awaitTermination()
    return target, marks


def feedback_lines(log):
    """The entries of ``feedback_log`` as the apps write them, one JSON object a line."""
    correction = F.col("kind") == "correction"
    return log.select(
        F.to_json(
            F.struct(
                F.col("event_id").alias("timestamp"), "filename",
                F.when(correction, F.col("predicted")).alias("original_prediction"),
                F.when(correction, F.col("confidence")).alias("original_confidence"),
                F.when(correction, F.col("actual")).alias("corrected_label"),
                F.when(~correction, F.col("actual")).alias("label"),
                F.when(~correction, F.col("confidence")).alias("confidence"),
            )
        ).alias("value")
    )


@query(
    "feedback_stream",
    views=["feedback_log", "ml_dataset"],
    sql=f"WITH {FEEDBACK} SELECT * FROM fb",
)
def feedback_streamed(v):
    target, _ = _streamed(v)
    return v.spark.read.parquet(target).select(
        "ml_dataset_id", "model_prediction", "model_confidence", "human_label", "feedback_type"
    )


@query(
    "feedback_stream_verified",
    views=["feedback_log", "ml_dataset"],
    sql=f"""WITH {FEEDBACK} SELECT id, CAST(CASE WHEN id IN (SELECT ml_dataset_id FROM fb) THEN 1 ELSE is_verified END AS INT) AS is_verified,
 CAST(CASE WHEN id IN (SELECT ml_dataset_id FROM fb) THEN 0 ELSE needs_review END AS INT) AS needs_review FROM ml_dataset""",
)
def feedback_stream_verified(v):
    _, marks = _streamed(v)
    return feedback_stream.verified_dataset(v.ml_dataset, marks).select(
        "id", F.col("is_verified").cast("int"), F.col("needs_review").cast("int")
    )


@query(
    "new_lots_stream",
    views=["auction_data"],
    sql=lambda: f"""WITH todo AS (SELECT * FROM auction_data WHERE vision_processed = 0 AND image_path <> ''), lab AS ({S.labels_sql('todo', 'id').strip()})
 SELECT id, period, label_confidence FROM lab""",
)
def new_lots_stream(v):
    source, target = scratch_path(v.spark, "lots"), scratch_path(v.spark, "labelled")
    v.auction_data.write.parquet(source)
    lot_stream.label_new_lots(
        v.spark, source, v.auction_data.schema, target, scratch_path(v.spark, "checkpoint")
    ).awaitTermination()
    return v.spark.read.parquet(target).select("id", "period", "label_confidence")


@query(
    "new_lots_incremental",
    views=["auction_data", "coin_detections"],
    sql="""SELECT id, image_path FROM auction_data WHERE image_path <> '' AND id NOT IN (SELECT auction_record_id FROM coin_detections)""",
)
def new_lots_incremental(v):
    processed = v.coin_detections.select(F.col("auction_record_id").alias("id"))
    return lot_stream.unprocessed(v.auction_data, processed).select("id", "image_path")


@query(
    "vector_delta_stream",
    sql="SELECT vec_id, label, round(CAST(embedding[1] AS DOUBLE), 6) AS first_value FROM embeddings",
)
def vector_delta_stream(v):
    source, delta = scratch_path(v.spark, "arrivals"), scratch_path(v.spark, "delta")
    v.embeddings.write.parquet(source)
    lot_stream.append_vectors(
        v.spark, source, v.embeddings.schema, delta, scratch_path(v.spark, "checkpoint")
    ).awaitTermination()
    return v.spark.read.parquet(delta).select(
        "vec_id", "label", r6(F.get("embedding", F.lit(0)).cast("double"), "first_value")
    )




# ---- databases ----------------------------------------------------------------------------------


@query(
    "jdbc_lots",
    views=["auction_data"],
    sql="SELECT id, sale_id, lot_number FROM auction_data WHERE id > 100",
)
def jdbc_lots(v):
    """Lots written to a database and read back in key ranges; the filter is left to the database.

    The database is embedded and opens for one Java process only, so this query is for local sessions; ``read_jdbc`` is not."""
    v.spark.sparkContext._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    url = f"jdbc:derby:{scratch_path(v.spark, 'lots').removeprefix('file:')};create=true"
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    lots = v.auction_data.select("id", "sale_id", "lot_number")
    lots.write.mode("append").options(**options).option("createTableColumnTypes", "sale_id VARCHAR(64), lot_number VARCHAR(64)").jdbc(url, "lots")
    return tables.read_jdbc(v.spark, url, "lots", rows=20_000, options=options).where(F.col("id") > 100)
