"""Catalogue views over the given tables.

One SQL text per view, valid in Spark and in DuckDB. ``{name}`` stands for a base table or for another
view. Every view keeps all rows of the table it is built from.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

HOUSES = "CASE {k} % 5 WHEN 0 THEN 'leu' WHEN 1 THEN 'cng' WHEN 2 THEN 'gorny' WHEN 3 THEN 'nomos' ELSE 'spink' END"
PERIODS = (
    "CASE {k} % 7 WHEN 0 THEN 'greek' WHEN 1 THEN 'roman_imperial' WHEN 2 THEN 'byzantine' "
    "WHEN 3 THEN 'islamic' WHEN 4 THEN 'roman_imperial' WHEN 5 THEN NULL ELSE 'medieval' END"
)
# lot, position in the lot: runs of one, two and three events
REC = "(floor(event_id / 6.0E0) * 3 + CASE event_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 2 END)"
POS = "CASE event_id % 6 WHEN 0 THEN 0 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 0 WHEN 4 THEN 1 ELSE 2 END"

VIEW_SQL = {
    "auction_data": f"""
SELECT CASE WHEN o_orderkey % 211 = 5 THEN -o_orderkey ELSE o_orderkey END AS id,
 CASE WHEN o_orderkey % 97 = 0 THEN 'A' || CAST(o_orderkey % 500 AS STRING) ELSE CAST(o_orderkey % 500 AS STRING) END AS lot_number,
 CASE o_orderkey % 16 WHEN 0 THEN 'Athens tetradrachm' WHEN 1 THEN 'Augustus denarius RIC' WHEN 2 THEN 'Byzantine solidus'
  WHEN 3 THEN 'Parthian drachm' WHEN 4 THEN 'Abbasid dirham' WHEN 5 THEN 'Anglo-Saxon penny' WHEN 6 THEN 'Republik Crawford 44'
  WHEN 7 THEN 'Replica token' WHEN 8 THEN 'stater' WHEN 9 THEN 'Hanover crown' WHEN 10 THEN 'Boii obol' WHEN 11 THEN 'Shahi, local issues'
  WHEN 12 THEN 'hemiobol' WHEN 13 THEN 'Victoria RIC sestertius' WHEN 14 THEN 'follis Venice' ELSE 'unlisted piece' END AS title,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 'Pisidia, AE' WHEN o_orderkey % 5 = 2 THEN 'AR, toned as struck'
  WHEN o_orderkey % 5 = 3 THEN 'lot of 5 coins' ELSE 'gold, 1887' END AS description,
 CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 19 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'leu_7/Lot_' || lpad(CAST(o_orderkey AS STRING),6,'0') || '.jpg'
  ELSE 'raw/auctions/leu/7/Lot_' || lpad(CAST(o_orderkey AS STRING),6,'0') || '.jpg' END AS image_path,
 {HOUSES.format(k="o_custkey")} AS auction_house, {HOUSES.format(k="o_custkey")} AS site,
 CAST(o_orderkey % 5 + 1 AS STRING) AS sale_id,
 CAST(o_totalprice AS STRING) AS current_bid,
 CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS vision_processed
FROM {{orders}}""",
    "auction_info": f"""
SELECT {HOUSES.format(k="n_nationkey")} AS auction_house,
 CAST(CAST(floor(n_nationkey / 5.0E0) AS INT) + 1 AS STRING) AS sale_id,
 n_regionkey * 60 AS lot_start, n_regionkey * 60 + 179 AS lot_end,
 CASE n_nationkey % 4 WHEN 0 THEN 'greek' WHEN 1 THEN 'roman_imperial' WHEN 2 THEN NULL ELSE 'byzantine' END AS period
FROM {{nation}}""",
    "coin_detections": f"""
SELECT id, CAST(rec AS BIGINT) AS auction_record_id, CAST(pos AS INT) AS detection_index,
 CASE WHEN floor(rec / 3.0E0) % 4 = 0 THEN NULL ELSE CAST(rec AS BIGINT) END AS coin_id,
 CASE id % 5 WHEN 0 THEN 'obverse' WHEN 1 THEN 'reverse' WHEN 2 THEN 'unknown' WHEN 3 THEN 'obverse' ELSE 'reverse' END AS side,
 CASE WHEN id % 7 = 0 THEN NULL ELSE pos / 4.0E0 END AS side_confidence,
 (id * 37 % 101) / 100.0E0 AS coin_likelihood, (id * 53 % 107) / 100.0E0 AS edge_support,
 (id * 29 % 101) / 100.0E0 AS circularity, (id * 41 % 103) / 100.0E0 AS solidity,
 CASE WHEN rec % 5 = 4 THEN 100 WHEN rec % 5 = 3 THEN 100 + 10 * pos
      WHEN rec % 10 = 7 THEN (2 - pos) * 300 ELSE pos * 300 + id % 17 END AS bbox_x,
 CASE WHEN rec % 5 = 4 THEN pos * 260 WHEN rec % 5 = 3 THEN 100 + 10 * pos ELSE id % 11 END AS bbox_y,
 200 + id % 23 AS bbox_w, 210 + id % 19 AS bbox_h,
 CASE WHEN id % 29 = 0 THEN NULL WHEN id % 31 = 0 THEN '' ELSE 'processed/vision/v1/crops/leu/7/Lot_' || lpad(CAST(id AS STRING),6,'0') || '_224.jpg' END AS normalized_path
FROM (SELECT event_id AS id, {REC} AS rec, {POS} AS pos FROM {{events}}) e""",
    "coins": """
SELECT DISTINCT coin_id AS id, coin_id AS auction_record_id,
 CASE coin_id % 4 WHEN 0 THEN 'left_right' WHEN 1 THEN 'top_bottom' WHEN 2 THEN NULL ELSE 'spatial' END AS pairing_method,
 0.8E0 AS pairing_confidence
FROM {coin_detections} WHERE coin_id IS NOT NULL
UNION ALL
SELECT -c_custkey - 1 AS id, c_custkey AS auction_record_id, 'legacy_backfill' AS pairing_method, 0.0E0 AS pairing_confidence FROM {customer}""",
    "ml_dataset": """
SELECT d.doc_id AS id, CASE WHEN d.doc_id % 6 = 0 THEN -d.doc_id - 1 ELSE d.doc_id * 2 END AS coin_detection_id,
 d.source || '/' || d.lang || '/doc_' || CAST(d.doc_id AS STRING) || '.jpg' AS image_path,
 md5(d.text) AS image_hash, CASE WHEN d.doc_id % 10 < 7 THEN 'train' WHEN d.doc_id % 10 < 8 THEN 'val' ELSE 'test' END AS split,
 CASE WHEN d.doc_id % 23 = 0 THEN NULL WHEN d.doc_id % 4 = 0 THEN 'en' ELSE d.lang END AS period,
 CASE WHEN d.doc_id % 3 = 0 THEN 'late' ELSE '' END AS subperiod,
 CASE d.doc_id % 5 WHEN 0 THEN 'denarius' WHEN 1 THEN 'drachm' WHEN 2 THEN NULL ELSE 'solidus' END AS denomination,
 CASE d.doc_id % 8 WHEN 0 THEN 'Lot of 12 coins. ' WHEN 1 THEN 'Victoria, 1887. ' WHEN 2 THEN 'Various bronze coins; ' WHEN 3 THEN 'George iv crown, proof. '
  WHEN 4 THEN '5 mark, 1914. ' ELSE '' END || d.text AS raw_label,
 (d.doc_id * 61 % 101) / 100.0E0 AS label_confidence, coalesce(l.toxic, 0) AS needs_review, coalesce(l.quality, 0) AS is_verified,
 CASE WHEN d.doc_id % 9 = 0 THEN 0 ELSE 1 END AS is_active,
 CASE WHEN d.doc_id % 18 = 0 THEN 'group_lot' WHEN d.doc_id % 9 = 0 THEN 'modern_coin' ELSE NULL END AS exclude_reason,
 CASE WHEN d.doc_id % 11 = 0 THEN 'old' ELSE NULL END AS visual_cluster_id
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id""",
    "ml_coin_dataset": f"""
SELECT o_orderkey + 1 AS id, o_orderkey * 3 AS coin_id,
 'crops/' || CAST(o_orderkey AS STRING) || '_obv.jpg' AS obv_path, 'crops/' || CAST(o_orderkey AS STRING) || '_rev.jpg' AS rev_path,
 CASE WHEN o_orderkey % 8 = 1 THEN 0 ELSE 1 END AS has_obv, CASE WHEN o_orderkey % 9 = 2 THEN 0 WHEN o_orderkey % 9 = 3 THEN NULL ELSE 1 END AS has_rev,
 CASE WHEN o_orderkey % 10 = 4 THEN '' ELSE md5(CAST(o_custkey AS STRING)) END AS pair_hash,
 CASE WHEN o_orderkey % 20 = 0 THEN 1 ELSE 0 END AS is_duplicate,
 CASE WHEN o_orderkey % 10 < 7 THEN 'train' WHEN o_orderkey % 10 < 8 THEN 'val' ELSE 'test' END AS split,
 {PERIODS.format(k="o_orderkey")} AS period,
 CASE o_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Nero' WHEN 2 THEN 'Trajan' WHEN 3 THEN 'Titus' WHEN 4 THEN '' ELSE 'Galba' END AS authority,
 CASE o_orderkey % 5 WHEN 0 THEN 'denarius' WHEN 1 THEN 'drachm' WHEN 2 THEN NULL ELSE 'solidus' END AS denomination,
 CASE o_orderkey % 3 WHEN 0 THEN 'gold' WHEN 1 THEN 'silver' ELSE '' END AS material,
 o_orderpriority AS raw_label,
 (o_orderkey * 61 % 101) / 100.0E0 AS label_confidence, CASE WHEN o_orderkey % 7 = 5 THEN 1 ELSE 0 END AS needs_review
FROM {{orders}}""",
    "cluster_results": """
SELECT vec_id AS id, CASE WHEN vec_id % 9 = 0 THEN '-1' ELSE CAST(label AS STRING) END AS cluster_id,
 CASE WHEN vec_id % 9 = 0 THEN 'noise' ELSE 'cluster_' || CAST(label AS STRING) END AS visual_cluster,
 CASE WHEN vec_id % 13 = 0 THEN NULL WHEN vec_id % 3 = 0 THEN 'greek' ELSE 'p' || CAST(label % 4 AS STRING) END AS parser_period,
 (vec_id * 61 % 101) / 100.0E0 AS cluster_confidence,
 'crops/leu_7_' || lpad(CAST(vec_id AS STRING), 5, '0') || '.jpg' AS image_path,
 CASE vec_id % 4 WHEN 0 THEN 'denarius' WHEN 1 THEN 'drachm' WHEN 2 THEN NULL ELSE 'tetradrachm' END AS denomination,
 CASE vec_id % 5 WHEN 0 THEN 'leu' WHEN 1 THEN 'cng' WHEN 2 THEN 'gorny' WHEN 3 THEN NULL ELSE 'spink' END AS auction_house,
 CAST(vec_id % 6 AS STRING) AS sale_id, CAST(vec_id * 7 AS STRING) AS lot_number, embedding
FROM {embeddings}""",
    "side_embeddings": """
SELECT CAST(floor(vec_id / 5.0E0) AS BIGINT) AS coin_id, vec_id,
 CASE WHEN floor(vec_id / 5.0E0) % 4 = 3 THEN 'unknown' WHEN vec_id % 5 = 4 THEN 'unknown' WHEN vec_id % 2 = 0 THEN 'obverse' ELSE 'reverse' END AS side,
 (vec_id * 37 % 11) / 10.0E0 AS quality, CASE WHEN vec_id % 8 = 0 THEN NULL ELSE 'p' || CAST(label AS STRING) END AS period,
 '/data/processed/vision/crops/Leu/' || CAST(vec_id % 6 AS STRING) || '/Lot_' || lpad(CAST(CAST(floor(vec_id / 5.0E0) AS BIGINT) AS STRING), 5, '0') || CASE vec_id % 2 WHEN 0 THEN '_obv' ELSE '_rev' END || '_224.jpg' AS path,
 embedding
FROM {embeddings}""",
    "feedback_log": """
SELECT event_id, 'doc_' || CAST(user_id AS STRING) || '.jpg' AS filename,
 CASE WHEN event_type = 'error' THEN 'correction' ELSE 'confirmation' END AS kind,
 event_type AS predicted,
 CASE WHEN event_type = 'error' THEN CASE event_id % 3 WHEN 0 THEN 'view' WHEN 1 THEN 'click' ELSE 'purchase' END ELSE event_type END AS actual,
 (event_id * 61 % 101) / 100.0E0 AS confidence
FROM {events}""",
    "predictions": """
SELECT doc_id AS id, lang AS y_true,
 CASE WHEN doc_id % 5 = 0 THEN CASE lang WHEN 'en' THEN 'de' WHEN 'de' THEN 'fr' WHEN 'fr' THEN 'en' ELSE 'en' END ELSE lang END AS y_pred,
 (doc_id * 61 % 101) / 100.0E0 AS confidence,
 CASE WHEN doc_id % 7 < 2 THEN 'en' ELSE lang END AS rev_pred,
 CASE WHEN doc_id % 4 = 0 THEN 'de' ELSE lang END AS pair_pred
FROM {documents}""",
}

_REFERENCE = re.compile(r"\{(\w+)\}")


def _needed(names: Iterable[str]) -> list[str]:
    """``names`` and the views below them, each after those it is built on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in BASE_TABLES or name in ordered:
            return
        for inner in _REFERENCE.findall(VIEW_SQL[name]):
            visit(inner)
        ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def with_views(names: Iterable[str], sql: str) -> str:
    """``sql`` with the definitions of ``names`` in front of it."""
    ctes = ", ".join(
        f"{n} AS ({_REFERENCE.sub(lambda m: m.group(1), VIEW_SQL[n])})" for n in _needed(names)
    )
    body = sql.strip()
    if not ctes:
        return body
    if body[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes}, {body[15:]}"
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes}, {body[5:]}"
    return f"WITH {ctes} {body}"


class Views:
    """Base tables and catalogue views of one scale-factor folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name in BASE_TABLES:
                frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            else:
                text = VIEW_SQL[name]
                inputs = {n: self(n) for n in set(_REFERENCE.findall(text))}
                frame = self.spark.sql(text, **inputs)
            self._cache[name] = frame
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES or name in VIEW_SQL:
            return self(name)
        raise AttributeError(name)
