"""Vectors, neighbours and search."""

from __future__ import annotations

from pyspark.sql import functions as F

from hoardline.functions import vectors
from hoardline.operators import cells, clusters, embeddings, evaluate, knn, search
from hoardline.plans.registry import query
from hoardline.plans.shaping import big, r6, vector_text

DOUBLES = "CAST(embedding AS DOUBLE[])"


def text(expression: str) -> str:
    return f"array_to_string(list_transform({expression}, lambda x: format('{{:.5f}}', round(x, 5) + 0.0)), ',')"


def unit(expression: str) -> str:
    return f"list_transform({expression}, lambda x: x / (sqrt(list_sum(list_transform({expression}, lambda y: y * y))) + 1e-12))"


@query(
    "l2_normalize",
    sql=f"""WITH s AS (SELECT vec_id, list_transform({DOUBLES}, lambda x: x * (1 + vec_id % 5)) AS e FROM embeddings) SELECT vec_id, {text(unit('e'))} AS vector FROM s""",
)
def l2_normalize(v):
    factor = (F.lit(1) + F.col("vec_id") % 5).cast("double")
    scaled = F.transform(F.col("embedding").cast("array<double>"), lambda x: x * factor)
    return v.embeddings.select("vec_id", vector_text(vectors.normalize(scaled)).alias("vector"))


BEST = f"""b AS (SELECT coin_id, side, period, {DOUBLES} AS e, row_number() OVER (PARTITION BY coin_id, side ORDER BY quality DESC, vec_id) AS rn FROM side_embeddings),
 o AS (SELECT * FROM b WHERE rn = 1 AND side = 'obverse'), r AS (SELECT * FROM b WHERE rn = 1 AND side = 'reverse'), u AS (SELECT * FROM b WHERE rn = 1 AND side = 'unknown')"""
PAIRED = f"pv AS (SELECT o.coin_id, list_concat({unit('o.e')}, {unit('r.e')}) AS e FROM o JOIN r ON o.coin_id = r.coin_id), pn AS (SELECT coin_id, {unit('e')} AS e FROM pv)"


@query(
    "pair_concat",
    views=["side_embeddings"],
    sql=f"WITH {BEST}, {PAIRED} SELECT coin_id, {text('e')} AS vector FROM pn",
)
def pair_concat(v):
    pairs = embeddings.pair_vectors(v.side_embeddings)
    return pairs.select("coin_id", vector_text(F.col("embedding")).alias("vector"))


@query(
    "derive_search_vectors",
    views=["side_embeddings"],
    sql=f"""WITH {BEST}, {PAIRED}, h AS (SELECT coin_id, {unit('e[1:64]')} AS a, {unit('e[65:128]')} AS z FROM pn),
 m AS (SELECT coin_id, list_transform(list_zip(a, z), lambda p: (p[1] + p[2]) / 2) AS e FROM h) SELECT coin_id, {text(unit('e'))} AS vector FROM m""",
)
def derive_search_vectors(v):
    found = embeddings.search_vectors(embeddings.pair_vectors(v.side_embeddings), 64)
    return found.select("coin_id", vector_text(F.col("embedding")).alias("vector"))


@query(
    "coin_vectors",
    views=["side_embeddings"],
    sql=f"""WITH {BEST}, ids AS (SELECT DISTINCT coin_id FROM b),
 j AS (SELECT ids.coin_id, CASE WHEN o.e IS NOT NULL THEN {unit('o.e')} END AS oe, CASE WHEN r.e IS NOT NULL THEN {unit('r.e')} END AS re, {unit('u.e')} AS ue,
  least(o.period, r.period, u.period) AS period, concat_ws(',', CASE WHEN o.e IS NOT NULL THEN 'obverse' END, CASE WHEN r.e IS NOT NULL THEN 'reverse' END, CASE WHEN u.e IS NOT NULL THEN 'unknown' END) AS sides
  FROM ids LEFT JOIN o ON ids.coin_id = o.coin_id LEFT JOIN r ON ids.coin_id = r.coin_id LEFT JOIN u ON ids.coin_id = u.coin_id),
 m AS (SELECT coin_id, period, sides, CASE WHEN oe IS NOT NULL AND re IS NOT NULL THEN list_transform(list_zip(oe, re), lambda p: (p[1] + p[2]) / 2) ELSE coalesce(oe, re, ue) END AS e FROM j)
 SELECT coin_id, period, sides, {text(unit('e'))} AS vector FROM m""",
)
def coin_vectors(v):
    coins = embeddings.coin_vectors(v.side_embeddings)
    return coins.select(
        "coin_id", "period", F.array_join("sides_available", ",").alias("sides"),
        vector_text(F.col("embedding")).alias("vector"),
    )


@query(
    "self_similarity",
    sql=f"""WITH c AS (SELECT label, list(m ORDER BY pos) AS q FROM (SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest({DOUBLES}) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1, 2) GROUP BY 1)
 SELECT e.vec_id, round(list_cosine_similarity({DOUBLES}, c.q), 6) AS similarity FROM embeddings e JOIN c ON e.label = c.label""",
)
def self_similarity(v):
    centers = embeddings.class_centroids(v.embeddings, "label").withColumnRenamed("embedding", "center")
    joined = v.embeddings.join(centers, "label")
    return joined.select("vec_id", r6(vectors.cosine(F.col("embedding"), F.col("center")), "similarity"))


# ---- neighbours ---------------------------------------------------------------------------------


def neighbours_sql(queries: str, corpus: str, k: int, extra: str = "") -> str:
    return f"""sim AS (SELECT a.id AS query_id, b.id AS neighbor_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS similarity
  FROM {queries} a JOIN {corpus} b ON a.id <> b.id{extra}),
 nn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, neighbor_id) AS rank FROM sim) WHERE rank <= {k})"""


INDEX_SQL = f"""WITH {neighbours_sql('cluster_results', 'cluster_results', 5)}
 SELECT query_id, rank, neighbor_id, similarity, round(1 - similarity, 6) AS distance, c.cluster_id, coalesce(c.parser_period, 'unknown') AS period FROM nn JOIN cluster_results c ON nn.neighbor_id = c.id"""


def _index_columns(df):
    return df.select("query_id", "rank", "neighbor_id", "similarity", "distance", "cluster_id", "period")


@query("knn_index", views=["cluster_results"], sql=INDEX_SQL)
def knn_index(v):
    return _index_columns(knn.knn_index(v.cluster_results, 5))


@query("knn_index_blocks", views=["cluster_results"], sql=INDEX_SQL)
def knn_index_blocks(v):
    """The plan for large corpora, forced."""
    return _index_columns(knn.knn_index(v.cluster_results, 5, strategy="blocks", block_rows=128))




@query("knn_index_probed", views=["cluster_results"], sql=INDEX_SQL)
def knn_index_probed(v):
    """The inverted index with every cell probed, which makes it exact."""
    rows = v.cluster_results.select(F.col("id").cast("long").alias("_id"), F.col("embedding").alias("_v")).where("_v IS NOT NULL")
    found = cells.probed_neighbours(rows, rows, 5, probes=1 << 20)
    return _index_columns(knn.described_index(found, v.cluster_results))


@query("knn_copies")
def knn_copies(v):
    """All vectors and many copies of them: one vector makes up about a third of all rows."""
    count = v.embeddings.count()
    wanted = F.when(F.col("o_orderkey") % 3 == 0, 7).otherwise(F.col("o_orderkey") % count)
    copies = v.orders.select(F.col("o_orderkey").alias("id"), wanted.alias("w")).join(
        v.embeddings, F.col("w") == F.col("vec_id")
    )
    rows = copies.select("id", "embedding").unionByName(v.embeddings.select((-1 - F.col("vec_id")).alias("id"), "embedding"))
    return knn.knn_join(rows, rows, 3, strategy="blocks", block_rows=256)


for _side in ("obverse", "reverse"):

    @query(
        f"knn_granularity_{_side}",
        views=["side_embeddings"],
        sql=f"""WITH s AS (SELECT vec_id AS id, embedding FROM side_embeddings WHERE side = '{_side}'), {neighbours_sql('s', 's', 3)} SELECT query_id, rank, neighbor_id, similarity FROM nn""",
    )
    def knn_granularity(v, side=_side):
        rows = v.side_embeddings.where(F.col("side") == side).select(F.col("vec_id").alias("id"), "embedding")
        return knn.knn_join(rows, rows, 3)


@query(
    "knn_granularity_coin",
    views=["side_embeddings"],
    sql=f"""WITH {BEST}, {PAIRED}, s AS (SELECT coin_id AS id, e AS embedding FROM pn), {neighbours_sql('s', 's', 3)} SELECT query_id, rank, neighbor_id, similarity FROM nn""",
)
def knn_granularity_coin(v):
    rows = embeddings.pair_vectors(v.side_embeddings).withColumnRenamed("coin_id", "id")
    return knn.knn_join(rows, rows, 3)


@query(
    "cluster_neighbors",
    views=["cluster_results"],
    sql=f"""WITH q AS (SELECT id, embedding FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY md5(CAST(id AS VARCHAR) || '-42'), id) AS rn FROM cluster_results) WHERE rn <= 10),
 {neighbours_sql('q', 'cluster_results', 5)} SELECT query_id, rank, neighbor_id, similarity FROM nn""",
)
def cluster_neighbors(v):
    """Ten random members of every cluster and their nearest rows."""
    picked = clusters.samples_per_cluster(v.cluster_results, 10)
    return knn.knn_join(picked, v.cluster_results, 5)


@query(
    "noise_reassign",
    views=["cluster_results"],
    sql=f"""WITH n AS (SELECT id, embedding FROM cluster_results WHERE cluster_id = '-1'), {neighbours_sql('n', 'cluster_results', 5)},
 vt AS (SELECT query_id, c.cluster_id, count(*) AS votes, min(rank) AS nearest FROM nn JOIN cluster_results c ON nn.neighbor_id = c.id WHERE c.cluster_id <> '-1' GROUP BY 1, 2),
 w AS (SELECT *, sum(votes) OVER (PARTITION BY query_id) AS clustered, row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, nearest) AS rn FROM vt),
 d AS (SELECT query_id, cluster_id FROM w WHERE rn = 1 AND clustered >= 2.5 AND votes / 5 >= 0.6)
 SELECT c.id, coalesce(d.cluster_id, c.cluster_id) AS cluster_id, CASE WHEN c.cluster_id <> '-1' THEN 'clustered' WHEN d.query_id IS NOT NULL THEN 'knn_assigned' ELSE 'noise' END AS assignment_method
 FROM cluster_results c LEFT JOIN d ON c.id = d.query_id""",
)
def noise_reassign(v):
    return knn.reassign_noise(v.cluster_results).select("id", "cluster_id", "assignment_method")


# ---- search -------------------------------------------------------------------------------------

CENTERS = f"""qq AS (SELECT CAST(label AS BIGINT) AS query_id, list(m ORDER BY pos) AS q, CASE label % 3 WHEN 0 THEN 'all' WHEN 1 THEN 'P' ELSE 'GREEK' END AS wanted_period, CASE label % 2 WHEN 0 THEN 'drachm' ELSE 'all' END AS wanted_denomination
 FROM (SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest({DOUBLES}) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings) GROUP BY 1, 2) GROUP BY label)"""
HITS = f"""{CENTERS}, sim AS (SELECT query_id, c.*, round(list_cosine_similarity(q, CAST(embedding AS DOUBLE[])), 6) AS similarity FROM qq, cluster_results c {{filter}}),
 hit AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM sim) WHERE rank <= 10)"""
FILTER = """WHERE (wanted_period = 'all' OR contains(lower(coalesce(parser_period, '')), lower(wanted_period)))
 AND (wanted_denomination = 'all' OR contains(lower(coalesce(denomination, '')), wanted_denomination))"""


def _queries(v):
    """One query per label: the centre of its vectors."""
    label = F.col("label")
    return embeddings.class_centroids(v.embeddings, "label").select(
        label.cast("bigint").alias("query_id"),
        "embedding",
        F.when(label % 3 == 0, "all").when(label % 3 == 1, "P").otherwise("GREEK").alias("wanted_period"),
        F.when(label % 2 == 0, "drachm").otherwise("all").alias("wanted_denomination"),
    )


SEARCH_FILTERS = {"parser_period": "wanted_period", "denomination": "wanted_denomination"}


@query(
    "search_topk",
    views=["cluster_results"],
    sql=f"""WITH {HITS.format(filter=FILTER)} SELECT query_id, rank, id AS neighbor_id, similarity, coalesce(parser_period, '') AS period, coalesce(denomination, '') AS denomination, cluster_id,
 CASE auction_house WHEN 'leu' THEN 'https://leunumismatik.com/en/lot/' || sale_id || '/' || lot_number WHEN 'cng' THEN 'https://cngcoins.com/Lot.aspx?LOT_ID=' || lot_number
 WHEN 'gorny' THEN 'https://auktionen.gmcoinart.de/Los/' || sale_id || '/' || lot_number || '.0' WHEN 'spink' THEN CASE WHEN lot_number <> '0' THEN 'https://www.spink.com/lot/' || sale_id || lpad(lot_number, 6, '0') ELSE '' END ELSE '' END AS lot_url FROM hit""",
)
def search_topk(v):
    found = search.search(_queries(v), v.cluster_results, 10, filters=SEARCH_FILTERS)
    return found.select(
        "query_id", "rank", "neighbor_id", "similarity", "period", "denomination", "cluster_id", "lot_url"
    )


CLASSES = ["greek", "p0", "p1", "p2", "p3"]
BOOSTED = f"""{HITS.format(filter='')}, lg AS (SELECT query_id, [CAST(query_id % 3 AS DOUBLE), query_id % 4, query_id % 5, 1, query_id % 2] AS l FROM qq),
 pr AS (SELECT query_id, list_transform(l, lambda x: exp(x - list_max(l)) / list_sum(list_transform(l, lambda y: exp(y - list_max(l))))) AS p FROM lg),
 bo AS (SELECT h.query_id, rank, id AS neighbor_id, similarity, list_max(p) AS conf, list_position(p, list_max(p)) AS top,
  coalesce((0.04 + 0.10 * greatest(0, list_max(p) - 0.5) / 0.5) * (p[list_position({CLASSES!r}, lower(parser_period))] - 0.2), 0.0) AS boost FROM hit h JOIN pr ON h.query_id = pr.query_id)"""


def _boosted(v, rerank):
    q = F.col("query_id")
    logits = F.array(*[x.cast("double") for x in (q % 3, q % 4, q % 5, F.lit(1), q % 2)])
    queries = _queries(v).withColumn("probs", vectors.softmax(logits))
    found = search.search(queries, v.cluster_results, 10)
    boosted = search.with_period_boost(found, queries, CLASSES, rerank=rerank)
    return boosted.select(
        "query_id", "rank", "neighbor_id", "similarity", r6("period_boost"), r6("final_score"), "query_period"
    )


@query(
    "search_boosted",
    views=["cluster_results"],
    sql=f"WITH {BOOSTED} SELECT query_id, rank, neighbor_id, similarity, round(boost, 6) AS period_boost, round(similarity + boost, 6) AS final_score, {CLASSES!r}[top] AS query_period FROM bo",
)
def search_boosted(v):
    return _boosted(v, rerank=False)


@query(
    "search_boosted_reranked",
    views=["cluster_results"],
    sql=f"""WITH {BOOSTED} SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY similarity + boost DESC, neighbor_id) AS rank, neighbor_id, similarity,
 round(boost, 6) AS period_boost, round(similarity + boost, 6) AS final_score, {CLASSES!r}[top] AS query_period FROM bo""",
)
def search_boosted_reranked(v):
    return _boosted(v, rerank=True)


SIDE_HITS = f"""pic AS (SELECT CAST(floor(vec_id / 3.0) AS BIGINT) AS image_id, count(*) FILTER (side = 'obverse') AS no, count(*) FILTER (side = 'reverse') AS nr,
  min({DOUBLES}) FILTER (side = 'obverse') AS o, min({DOUBLES}) FILTER (side = 'reverse') AS r, min({DOUBLES}) FILTER (side = 'unknown') AS w FROM side_embeddings GROUP BY 1),
 asked AS (SELECT image_id, 'split' AS split_status, 'obverse' AS side, o AS q FROM pic WHERE no = 1 AND nr = 1 UNION ALL SELECT image_id, 'split', 'reverse', r FROM pic WHERE no = 1 AND nr = 1
  UNION ALL SELECT image_id, 'single', NULL, w FROM pic WHERE NOT (no = 1 AND nr = 1) AND w IS NOT NULL),
 near AS (SELECT image_id, split_status, asked.side AS side, vec_id AS neighbor_id, round(list_cosine_similarity(q, {DOUBLES}), 6) AS similarity FROM asked, side_embeddings s {{on}}),
 hit AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY image_id, side ORDER BY similarity DESC, neighbor_id) AS rank FROM near) WHERE rank <= 5)"""


def _by_side(v, same_side):
    pictures = v.side_embeddings.select(F.floor(F.col("vec_id") / 3).alias("image_id"), "side", "embedding")
    corpus = v.side_embeddings.select(F.col("vec_id").alias("id"), "side", "embedding")
    return search.search_sides(pictures, corpus, 5, same_side=same_side)


@query(
    "search_by_side",
    views=["side_embeddings"],
    sql=f"WITH {SIDE_HITS.format(on='')} SELECT image_id, split_status, side, rank, neighbor_id, similarity FROM hit",
)
def search_by_side(v):
    """Every picture asks with its two sides, or as a whole where it was not split."""
    return _by_side(v, same_side=False)


@query(
    "search_same_side",
    views=["side_embeddings"],
    sql=f"""WITH {SIDE_HITS.format(on="WHERE asked.side IS NULL OR asked.side = s.side")}, per AS (SELECT image_id, split_status, side, count(*) AS hits, max(similarity) AS best, sum(neighbor_id * rank) AS places FROM hit GROUP BY 1, 2, 3)
 SELECT image_id, split_status, CAST(count(*) AS INT) AS sides, CAST(sum(hits) AS BIGINT) AS hits, max(best) AS best, CAST(sum(places) AS BIGINT) AS places FROM per GROUP BY 1, 2""",
)
def search_same_side(v):
    """Sides against rows of their own side, put together as one answer a picture."""
    hits = F.flatten(F.transform("coins", lambda c: c["results"]))
    zero = F.lit(0).cast("bigint")
    return search.side_responses(_by_side(v, same_side=True)).select(
        "image_id", "split_status", F.size("coins").alias("sides"), F.size(hits).cast("bigint").alias("hits"),
        F.array_max(F.transform(hits, lambda h: h["similarity"])).alias("best"),
        F.aggregate(hits, zero, lambda total, h: total + h["neighbor_id"] * h["rank"]).alias("places"),
    )


@query(
    "period_index",
    views=["cluster_results"],
    sql=f"SELECT id, CAST(coalesce(list_position({CLASSES!r}, lower(trim(parser_period))), 0) - 1 AS INT) AS period_index FROM cluster_results",
)
def period_index(v):
    return v.cluster_results.select("id", search.period_index(F.col("parser_period"), CLASSES).alias("period_index"))


SOFT = f"list_transform({DOUBLES}, lambda x: exp(x - list_max({DOUBLES})) / list_sum(list_transform({DOUBLES}, lambda y: exp(y - list_max({DOUBLES})))))"


@query("softmax_probs", sql=f"SELECT vec_id, {text(SOFT)} AS probs FROM embeddings")
def softmax_probs(v):
    return v.embeddings.select("vec_id", vector_text(vectors.softmax(F.col("embedding"))).alias("probs"))


@query(
    "top3_classes",
    sql=f"""WITH p AS (SELECT vec_id AS id, {SOFT} AS p FROM embeddings), u AS (SELECT id, unnest(p) AS x, generate_subscripts(p, 1) - 1 AS i FROM p)
 SELECT id, place, class_index, round(x, 6) AS probability FROM (SELECT id, x, i AS class_index, row_number() OVER (PARTITION BY id ORDER BY x DESC, i) AS place FROM u) WHERE place <= 3""",
)
def top3_classes(v):
    rows = v.embeddings.select(F.col("vec_id").alias("id"), vectors.softmax(F.col("embedding")).alias("probs"))
    return evaluate.top_classes(rows).select("id", "place", big("class_index", "class_index"), r6("probability"))
