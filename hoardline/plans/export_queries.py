"""Exports, labels, exclusion flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from hoardline.functions import labels as L
from hoardline.functions import vocabulary as V
from hoardline.functions.text import longest_key_value, resolved_period, words_found
from hoardline.operators import clusters, dedup, export, feedback, mutate, stats
from hoardline.plans import label_sql as S
from hoardline.plans.registry import query
from hoardline.plans.shaping import flag, r6
from hoardline.session import spread_narrow
from hoardline.sources import sinks, snapshots

# The best detection of each side of a coin as one aggregate, then what is known about the coin's lot.
_PICK = """max({{'rank': coalesce(side_confidence, 0), 'id': id, 'path': normalized_path, 'likelihood': coin_likelihood, 'confidence': side_confidence}})
  FILTER (side = '{side}') AS {side}"""
COINS = f"""sides AS (SELECT coin_id, {_PICK.format(side="unknown")}, {_PICK.format(side="reverse")}, {_PICK.format(side="obverse")}
 FROM coin_detections WHERE coin_likelihood >= 0.5 AND normalized_path IS NOT NULL {{blank}} GROUP BY coin_id),
 places AS (SELECT lot.id AS lot_id, lot.lot_number, lot.sale_id, lot.site, lot.title, lot.description, part.period AS auction_period,
  coalesce(part.auction_house, lot.site) AS auction_house FROM auction_data lot LEFT JOIN (SELECT * FROM auction_info) part
  ON (lot.sale_id, lot.auction_house) = (part.sale_id, part.auction_house) AND part.lot_start <= TRY_CAST(lot.lot_number AS BIGINT)
  AND part.lot_end >= TRY_CAST(lot.lot_number AS BIGINT)),
 open_coins AS (SELECT * FROM coins ANTI JOIN (SELECT coin_id FROM ml_coin_dataset WHERE is_duplicate = 0) done ON coins.id = done.coin_id),
 x AS (SELECT places.* EXCLUDE (lot_id), coin.id AS coin_id, coin.auction_record_id, coin.pairing_confidence, coin.pairing_method,
  unknown.id AS unk_detection_id, unknown.path AS unk_path,
  reverse.id AS rev_detection_id, reverse.path AS rev_path, reverse.likelihood AS rev_likelihood, reverse.confidence AS rev_side_confidence,
  obverse.id AS obv_detection_id, obverse.path AS obv_path, obverse.likelihood AS obv_likelihood, obverse.confidence AS obv_side_confidence
  FROM sides, open_coins coin, places WHERE sides.coin_id = coin.id AND places.lot_id = coin.auction_record_id
  AND coalesce(unknown.id, reverse.id, obverse.id) IS NOT NULL)"""
X = COINS.replace("{blank}", "AND normalized_path <> ''")
COIN_VIEWS = ["coins", "auction_data", "auction_info", "coin_detections", "ml_coin_dataset"]
COIN_COLUMNS = """coin_id, auction_record_id, coalesce(pairing_method, '') AS pairing_method, coalesce(obv_detection_id, -1) AS obv_detection_id,
 obv_path, coalesce(rev_detection_id, -1) AS rev_detection_id, rev_path, coalesce(unk_detection_id, -1) AS unk_detection_id, unk_path,
 coalesce(obv_side_confidence, -1.0) AS obv_side_confidence, title, lot_number, auction_house, auction_period"""


def _exportable(v, skip_blank_paths=True):
    return export.exportable_coins(
        v.coins, v.auction_data, v.auction_info, v.coin_detections, v.ml_coin_dataset,
        skip_blank_paths=skip_blank_paths,
    )


def _coin_columns(df):
    minus = F.lit(-1)
    return df.select(
        "coin_id",
        "auction_record_id",
        F.coalesce("pairing_method", F.lit("")).alias("pairing_method"),
        *[F.coalesce(f"{s}_detection_id", minus).alias(f"{s}_detection_id") for s in ("obv", "rev", "unk")],
        "obv_path", "rev_path", "unk_path",
        F.coalesce("obv_side_confidence", F.lit(-1.0)).alias("obv_side_confidence"),
        "title", "lot_number", "auction_house", "auction_period",
    )


@query("exportable_coins", views=COIN_VIEWS, sql=f"WITH {X} SELECT {COIN_COLUMNS} FROM x")
def exportable_coins(v):
    return _coin_columns(_exportable(v))


@query(
    "exportable_coins_any_path",
    views=COIN_VIEWS,
    sql=f"WITH {COINS.replace('{blank}', '')} SELECT {COIN_COLUMNS} FROM x",
)
def exportable_coins_any_path(v):
    return _coin_columns(_exportable(v, skip_blank_paths=False))


D = """d AS (SELECT d.id, d.normalized_path, a.title, a.description, a.lot_number, ai.period FROM coin_detections d
 JOIN auction_data a ON d.auction_record_id = a.id
 LEFT JOIN auction_info ai ON a.auction_house = ai.auction_house AND a.sale_id = ai.sale_id AND TRY_CAST(a.lot_number AS BIGINT) BETWEEN ai.lot_start AND ai.lot_end
 WHERE d.coin_likelihood >= 0.5 AND d.normalized_path IS NOT NULL AND d.id NOT IN (SELECT coin_detection_id FROM ml_dataset))"""
D_VIEWS = ["coin_detections", "auction_data", "auction_info", "ml_dataset"]


def _detections(v):
    return export.exportable_detections(v.coin_detections, v.auction_data, v.auction_info, v.ml_dataset)


@query(
    "exportable_detections",
    views=D_VIEWS,
    sql=f"WITH {D} SELECT id, normalized_path, title, lot_number, period FROM d",
)
def exportable_detections(v):
    return _detections(v).select("id", "normalized_path", "title", "lot_number", "period")


CATEGORY = """CASE WHEN obv_path <> '' AND rev_path <> '' THEN 'both' WHEN obv_path <> '' THEN 'obv_only' WHEN rev_path <> '' THEN 'rev_only'
 WHEN unk_path <> '' THEN 'unknown_only' END"""
RULES = {
    "skip": "SELECT coin_id, obv_path, rev_path, side_category FROM y WHERE side_category = 'both'",
    "duplicate": """SELECT coin_id, CASE side_category WHEN 'rev_only' THEN rev_path WHEN 'unknown_only' THEN unk_path ELSE obv_path END AS obv_path,
 CASE side_category WHEN 'obv_only' THEN obv_path WHEN 'unknown_only' THEN unk_path ELSE rev_path END AS rev_path, side_category FROM y""",
    "placeholder": """SELECT coin_id, CASE side_category WHEN 'rev_only' THEN 'blank.png' WHEN 'unknown_only' THEN unk_path ELSE obv_path END AS obv_path,
 CASE side_category WHEN 'obv_only' THEN 'blank.png' WHEN 'unknown_only' THEN 'blank.png' ELSE rev_path END AS rev_path, side_category FROM y""",
}

for _rule, _select in RULES.items():

    @query(
        f"missing_side_{_rule}",
        views=COIN_VIEWS,
        sql=f"WITH {X}, y AS (SELECT *, {CATEGORY} AS side_category FROM x) {_select}",
    )
    def missing_side(v, rule=_rule):
        rows = export.apply_missing_side_rule(_exportable(v), rule, "blank.png")
        return rows.select("coin_id", "obv_path", "rev_path", "side_category")


@query(
    "missing_side_counts",
    views=COIN_VIEWS,
    sql=f"WITH {X}, y AS (SELECT {CATEGORY} AS side_category FROM x) SELECT side_category, count(*) AS coins FROM y GROUP BY 1",
)
def missing_side_counts(v):
    categories = _exportable(v).select(export.side_category().alias("side_category"))
    return stats.counts(categories, "side_category", name="coins")


def _with_period(frame: str, known: str) -> str:
    """Labels of ``frame`` joined to its rows, with the resolved period."""
    labels = S.labels_sql(frame, "k").strip()
    return f"lab AS ({labels}), res AS (SELECT f.*, l.period AS parsed, coalesce(nullif(f.{known}, ''), l.period, 'unknown') AS resolved, l.denomination, l.material, l.label_confidence, l.needs_review FROM {frame} f JOIN lab l ON f.k = l.k)"


SPLIT = """CASE WHEN rn <= floor(n * 0.7) THEN 'train' WHEN rn <= floor(n * 0.7) + floor(n * 0.15) THEN 'val' ELSE 'test' END AS split"""


def _split_sql(stratum: str, key: str) -> str:
    return f"""row_number() OVER (PARTITION BY {stratum} ORDER BY md5(CAST({key} AS VARCHAR) || '-42'), {key}) AS rn,
 count(*) OVER (PARTITION BY {stratum}) AS n"""


@query(
    "pair_export",
    views=COIN_VIEWS,
    sql=lambda: f"""WITH {X}, keyed AS (SELECT *, coin_id AS k FROM x WHERE {CATEGORY} = 'both'), {_with_period('keyed', 'auction_period')},
 s AS (SELECT *, {_split_sql('resolved', 'coin_id')} FROM res)
 SELECT coin_id, obv_path, rev_path, resolved AS period, denomination, material, title AS raw_label, label_confidence, needs_review,
 coalesce(TRY_CAST(lot_number AS BIGINT), 0) AS lot_number, {SPLIT} FROM s""",
)
def pair_export(v):
    return export.export_pairs(_exportable(v)).select(
        "coin_id", "obv_path", "rev_path", "period", "denomination", "material", "raw_label",
        "label_confidence", flag("needs_review", "needs_review"), "lot_number", "split",
    )


@query(
    "detection_export",
    views=D_VIEWS,
    sql=lambda: f"""WITH {D}, keyed AS (SELECT *, id AS k FROM d WHERE normalized_path <> ''), {_with_period('keyed', 'period')},
 s AS (SELECT *, {_split_sql("coalesce(parsed, 'unknown')", 'id')} FROM res)
 SELECT id AS coin_detection_id, parsed AS parsed_period, resolved AS period, denomination, label_confidence, needs_review, {SPLIT} FROM s""",
)
def detection_export(v):
    return export.export_detections(_detections(v)).select(
        "coin_detection_id", "parsed_period", "period", "denomination", "label_confidence",
        flag("needs_review", "needs_review"), "split",
    )


@query(
    "export_summary",
    views=COIN_VIEWS,
    sql=None,
)
def export_summary(v):
    rows = export.export_pairs(_exportable(v), rule="duplicate")
    statistics = export.export_statistics(rows)
    return sinks.export_summary(statistics, {"train_ratio": "0.70", "val_ratio": "0.15"})


@query(
    "resolved_period",
    views=["auction_data", "auction_info"],
    sql=f"""WITH l AS (SELECT a.id, ai.period AS known, {S.keyword_sql(S.TEXT)} AS parsed FROM auction_data a
 LEFT JOIN auction_info ai ON a.auction_house = ai.auction_house AND a.sale_id = ai.sale_id AND TRY_CAST(a.lot_number AS BIGINT) BETWEEN ai.lot_start AND ai.lot_end)
 SELECT id, coalesce(nullif(known, ''), nullif(parsed, ''), 'unknown') AS period, count(*) AS ranges FROM l GROUP BY 1, 2""",
)
def resolved(v):
    lots = export.with_lot_range(v.auction_data, v.auction_info)
    period = resolved_period(F.col("auction_period"), L.keyword_label("title", "description"))
    return stats.counts(lots, "id", period.alias("period"), name="ranges")


@query(
    "first_lot_range",
    views=["auction_data", "auction_info"],
    sql="""SELECT id, auction_period FROM (SELECT a.id, ai.period AS auction_period, row_number() OVER (PARTITION BY a.id ORDER BY ai.lot_start, ai.lot_end) AS rn
 FROM auction_data a LEFT JOIN auction_info ai ON a.auction_house = ai.auction_house AND a.sale_id = ai.sale_id
 AND TRY_CAST(a.lot_number AS BIGINT) BETWEEN ai.lot_start AND ai.lot_end) WHERE rn = 1""",
)
def first_lot_range(v):
    lots = v.auction_data.select("id", "auction_house", "sale_id", "lot_number")
    return export.with_lot_range(lots, v.auction_info, first_range_only=True).select("id", "auction_period")


for _split in ("train", "val", "test"):

    @query(
        f"split_manifest_{_split}",
        views=["ml_dataset"],
        sql=f"""SELECT id, image_path, period, label_confidence FROM ml_dataset WHERE split = '{_split}' AND period IS NOT NULL AND label_confidence >= 0.6""",
    )
    def split_manifest(v, split=_split):
        return export.split_manifest(v.ml_dataset, split).select(
            "id", "image_path", "period", "label_confidence"
        )

    @query(
        f"pair_manifest_{_split}",
        views=["ml_coin_dataset"],
        sql=f"""SELECT coin_id, obv_path, rev_path, period, label_confidence FROM ml_coin_dataset
 WHERE split = '{_split}' AND is_duplicate = 0 AND period IS NOT NULL AND label_confidence >= 0.6""",
    )
    def pair_manifest(v, split=_split):
        return export.pair_manifest(v.ml_coin_dataset, split).select(
            "coin_id", "obv_path", "rev_path", "period", "label_confidence"
        )


@query(
    "training_ready",
    views=["ml_dataset"],
    sql="SELECT id, image_path, period FROM ml_dataset WHERE is_active = 1 AND period IS NOT NULL AND period <> '' AND image_path IS NOT NULL",
)
def training_ready(v):
    return export.training_ready(v.ml_dataset).select("id", "image_path", "period")


@query(
    "duplicate_split_inherit",
    views=["ml_coin_dataset"],
    sql="""WITH m AS (SELECT coin_id, pair_hash, split, CASE WHEN pair_hash <> '' THEN min(coin_id) OVER (PARTITION BY pair_hash) ELSE coin_id END AS primary_id FROM ml_coin_dataset)
 SELECT m.coin_id, CAST(m.coin_id <> m.primary_id AS INT) AS is_duplicate, CASE WHEN m.coin_id <> m.primary_id THEN coalesce(p.split, 'train') ELSE m.split END AS split
 FROM m LEFT JOIN ml_coin_dataset p ON p.coin_id = m.primary_id""",
)
def duplicate_split_inherit(v):
    marked = dedup.mark_duplicates(v.ml_coin_dataset.select("coin_id", "pair_hash", "split"))
    return export.inherit_primary_split(marked).select("coin_id", flag("is_duplicate", "is_duplicate"), "split")


@query(
    "pair_hash_lookup",
    views=["ml_coin_dataset"],
    sql="""WITH q AS (SELECT DISTINCT md5(CAST(c_custkey AS VARCHAR)) AS pair_hash FROM customer),
 k AS (SELECT pair_hash, min(coin_id) AS coin_id FROM ml_coin_dataset WHERE is_duplicate = 0 AND pair_hash <> '' GROUP BY 1)
 SELECT q.pair_hash, coalesce(k.coin_id, -1) AS existing_coin_id FROM q LEFT JOIN k ON q.pair_hash = k.pair_hash""",
)
def pair_hash_lookup(v):
    hashes = v.customer.select(F.md5(F.col("c_custkey").cast("string")).alias("pair_hash")).distinct()
    return dedup.primary_of_hash(hashes, v.ml_coin_dataset).select(
        "pair_hash", F.coalesce("existing_coin_id", F.lit(-1)).alias("existing_coin_id")
    )


@query(
    "label_mapping",
    views=["ml_coin_dataset"],
    sql=" UNION ALL ".join(
        f"SELECT '{c}' AS field, {c} AS label, row_number() OVER (ORDER BY {c}) - 1 AS label_index FROM (SELECT DISTINCT {c} FROM ml_coin_dataset WHERE {c} <> '' AND {c} <> 'unknown')"
        for c in ("period", "denomination", "material")
    ),
)
def label_mapping(v):
    return export.label_mapping(v.ml_coin_dataset, ["period", "denomination", "material"])


@query(
    "export_stats",
    views=["ml_coin_dataset"],
    sql="""SELECT 'split' AS section, split AS key, count(*) AS rows FROM ml_coin_dataset GROUP BY 2
 UNION ALL SELECT 'period', period, count(*) FROM ml_coin_dataset WHERE period <> 'unknown' GROUP BY 2
 UNION ALL SELECT 'denomination', denomination, count(*) FROM ml_coin_dataset WHERE denomination <> '' GROUP BY 2
 UNION ALL SELECT 'material', material, count(*) FROM ml_coin_dataset WHERE material <> '' GROUP BY 2
 UNION ALL SELECT 'flag', 'needs_review', count(*) FROM ml_coin_dataset WHERE needs_review = 1
 UNION ALL SELECT 'flag', 'high_confidence', count(*) FROM ml_coin_dataset WHERE label_confidence > 0.7""",
)
def export_stats(v):
    return export.export_statistics(v.ml_coin_dataset)


@query(
    "freeze_manifest",
    views=["ml_coin_dataset"],
    sql="""SELECT count(*) AS rows, min(id) AS first_id, max(id) AS last_id,
 round(avg(CASE WHEN period IS NOT NULL THEN 1 ELSE 0 END), 6) AS period_coverage,
 round(avg(CASE WHEN denomination IS NOT NULL THEN 1 ELSE 0 END), 6) AS denomination_coverage FROM ml_coin_dataset""",
)
def freeze_manifest(v):
    frozen = snapshots.freeze_manifest(v.ml_coin_dataset, "id", ["period", "denomination"])
    return frozen.select("rows", "first_id", "last_id", r6("period_coverage"), r6("denomination_coverage"))


# ---- labels -------------------------------------------------------------------------------------


def _label_columns(df, key):
    return df.select(
        key, "period", "denomination", "material", "label_confidence",
        flag("needs_review", "needs_review"),
        F.array_join("notes", "|").alias("notes"),
        F.array_join("warnings", "|").alias("warnings"),
    )


@query("label_parse", views=["auction_data"], sql=lambda: S.labels_sql("auction_data", "id"))
def label_parse(v):
    return _label_columns(L.with_labels(spread_narrow(v.auction_data.select("id", "title", "description"))), "id")


DOC_TITLE = """CASE doc_id % 11 WHEN 0 THEN 'Ägina, stater' WHEN 1 THEN 'weight of Venice' WHEN 2 THEN 'AR denarius, George III' WHEN 3 THEN 'banknote'
 WHEN 4 THEN 'RPC AE, nero' WHEN 5 THEN 'double sestertius' WHEN 6 THEN 'hyperpyron doc' WHEN 7 THEN 'sceat or penny' ELSE source END"""
DOCS = f"(SELECT doc_id, {DOC_TITLE} AS title, text AS description FROM documents)"


@query("label_parse_documents", sql=lambda: S.labels_sql(DOCS, "doc_id"))
def label_parse_documents(v):
    rows = v.documents.select("doc_id", F.expr(DOC_TITLE).alias("title"), F.col("text").alias("description"))
    return _label_columns(L.with_labels(spread_narrow(rows)), "doc_id")


@query("label_signals", views=["auction_data"], sql=lambda: S.signals_sql("auction_data", "id"))
def label_signals(v):
    found = L.with_signals(spread_narrow(v.auction_data.select("id", "title", "description")))
    return found.select("id", flag("_junk", "junk"), F.array_join("signals", ",").alias("signals"))


@query(
    "denomination_longest",
    sql=f"""WITH t AS (SELECT doc_id, lower({DOC_TITLE} || ' ' || text) AS txt FROM documents)
 SELECT doc_id, {S.longest('txt', V.DENOMINATIONS)} AS denomination, {S.longest('txt', V.MATERIALS)} AS material FROM t""",
)
def denomination_longest(v):
    text = F.lower(F.concat_ws(" ", F.expr(DOC_TITLE), "text"))
    found = v.documents.withColumn("found", words_found(text, [*V.DENOMINATIONS, *V.MATERIALS]))
    return found.select(
        "doc_id",
        longest_key_value(F.col("found"), V.DENOMINATIONS).alias("denomination"),
        longest_key_value(F.col("found"), V.MATERIALS).alias("material"),
    )


@query(
    "denomination_spelling",
    views=["auction_data"],
    sql="WITH t AS (SELECT id, lower(title) AS txt FROM auction_data) SELECT id, CASE "
    + " ".join(f"WHEN regexp_matches(txt, '{p}') THEN '{n}'" for n, p in V.DENOMINATION_SPELLINGS.items())
    + " END AS denomination FROM t",
)
def denomination_spelling(v):
    return v.auction_data.select("id", L.denomination_spelling(F.col("title")).alias("denomination"))


@query(
    "keyword_label",
    views=["auction_data"],
    sql=f"WITH t AS (SELECT id, {S.TEXT} AS txt FROM auction_data) SELECT id, {S.keyword_sql('txt')} AS period FROM t",
)
def keyword_label(v):
    return v.auction_data.select("id", L.keyword_label("title", "description").alias("period"))


# ---- exclusion flags ----------------------------------------------------------------------------

FLAGS = {
    "group_lot": (V.GROUP_LOT_PATTERNS, L.group_lot_pattern),
    "modern_coin": (V.MODERN_PATTERNS, L.modern_pattern),
}

for _reason, (_patterns, _matcher) in FLAGS.items():

    @query(
        f"flags_{_reason}",
        views=["ml_dataset"],
        sql=f"""WITH t AS (SELECT *, {S.first_pattern("lower(coalesce(raw_label, ''))", _patterns)} AS pattern FROM ml_dataset)
 SELECT id, pattern, CASE WHEN is_active = 1 AND exclude_reason IS NULL AND pattern IS NOT NULL THEN '{_reason}' ELSE exclude_reason END AS exclude_reason,
 CASE WHEN is_active = 1 AND exclude_reason IS NULL AND pattern IS NOT NULL THEN 0 ELSE is_active END AS is_active FROM t""",
    )
    def pattern_flags(v, reason=_reason, matcher=_matcher):
        rows = v.ml_dataset.withColumn("pattern", matcher(F.col("raw_label")))
        return mutate.exclude_matching(rows, F.col("pattern"), reason).select(
            "id", "pattern", "exclude_reason", "is_active"
        )


NAMED = "regexp_extract(image_path, '[^/]*$')"
NOISE_ROWS = """noise AS (SELECT 'doc_' || CAST(id AS VARCHAR) || '.jpg' AS name FROM cluster_results WHERE {condition})"""


def _flag_by_clusters(v, rows, reason):
    names = rows.select(F.format_string("doc_%d.jpg", "id").alias("filename")).distinct()
    hits = feedback.match_by_basename(names, v.ml_dataset.select("id", "image_path")).select("id")
    active = v.ml_dataset.where(F.col("is_active") == 1).join(hits, "id", "left_semi").select("id")
    flagged = mutate.update_by_id(
        v.ml_dataset, active, {"is_active": F.lit(0), "exclude_reason": F.lit(reason)}
    )
    return flagged.select("id", "is_active", "exclude_reason")


def _flag_sql(condition: str, reason: str) -> str:
    return f"""WITH {NOISE_ROWS.format(condition=condition)}
 SELECT id, CASE WHEN hit THEN 0 ELSE is_active END AS is_active, CASE WHEN hit THEN '{reason}' ELSE exclude_reason END AS exclude_reason
 FROM (SELECT *, is_active = 1 AND {NAMED} IN (SELECT name FROM noise) AS hit FROM ml_dataset)"""


@query(
    "noise_flags",
    views=["ml_dataset", "cluster_results"],
    sql=_flag_sql("cluster_id = '-1' OR contains(lower(visual_cluster), 'noise')", "visual_noise"),
)
def noise_flags(v):
    from hoardline.functions.paths import is_noise

    noise = v.cluster_results.where(
        is_noise(F.col("cluster_id")) | F.lower("visual_cluster").contains("noise")
    )
    return _flag_by_clusters(v, noise, "visual_noise")


@query(
    "cluster_flags",
    views=["ml_dataset", "cluster_results"],
    sql=_flag_sql("visual_cluster = 'cluster_3'", "bad_cluster"),
)
def cluster_flags(v):
    return _flag_by_clusters(v, clusters.in_cluster(v.cluster_results, "3"), "bad_cluster")


@query(
    "exclusion_report",
    views=["ml_dataset"],
    sql="""WITH f AS (SELECT 'state' AS field, CASE WHEN is_active = 1 THEN 'active' ELSE 'excluded' END AS value FROM ml_dataset
 UNION ALL SELECT 'reason', coalesce(exclude_reason, 'active') FROM ml_dataset
 UNION ALL SELECT 'active_period', coalesce(period, 'null') FROM ml_dataset WHERE is_active = 1)
 SELECT field, value, count(*) AS rows, round(100.0 * count(*) / (SELECT count(*) FROM ml_dataset), 6) AS percent FROM f GROUP BY 1, 2""",
)
def exclusion_report(v):
    return stats.exclusion_report(v.ml_dataset).select("field", "value", "rows", r6("percent"))


