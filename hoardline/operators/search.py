"""Ranked retrieval: filtered top-k with an optional period boost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoardline.functions.paths import lot_url
from hoardline.functions.text import nan_safe
from hoardline.operators.knn import top_k
from hoardline.session import cut_lineage

# Fixed values of the boost: base weight, extra weight at full confidence.
BOOST_BASE = 0.04
BOOST_EXTRA = 0.10

MAX_WANTED = 10_000  # partition values sent to every task


def boost_weight(confidence: Column) -> Column:
    return F.lit(BOOST_BASE) + F.lit(BOOST_EXTRA) * F.greatest(F.lit(0.0), confidence - 0.5) / 0.5


def period_index(period: Column, classes: list[str]) -> Column:
    """Position of the lower-cased, trimmed period among ``classes``; -1 if it is none of them."""
    name = F.lower(F.trim(F.coalesce(period, F.lit(""))))
    return (F.array_position(F.array(*[F.lit(c) for c in classes]), name) - 1).cast("int")


def search(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = 10,
    *,
    filters: dict[str, str] | None = None,
) -> DataFrame:
    """Top-k corpus rows per query with the response fields.

    The hits are stored before they meet the corpus again: their size is then known to be small, and
    the corpus is only scanned, not shuffled.
    """
    found = cut_lineage(top_k(queries, corpus, k, filters=filters), "hits")
    fields = corpus.select(
        F.col("id").alias("_id"),
        nan_safe(F.col("parser_period")).alias("period"),
        nan_safe(F.col("denomination")).alias("denomination"),
        nan_safe(F.col("auction_house")).alias("auction_house"),
        nan_safe(F.col("cluster_id")).alias("cluster_id"),
        lot_url(F.col("auction_house"), F.col("sale_id"), F.col("lot_number")).alias("lot_url"),
    )
    return found.join(fields, F.col("neighbor_id") == F.col("_id")).drop("_id")


def wanted_partitions(queries: DataFrame, corpus: DataFrame, partition: str, wanted: str) -> DataFrame:
    """The rows of ``corpus``, stored by folders of ``partition``, that some query asks for.

    The folders are chosen at run time from the query table, so those that nobody asks for are never
    listed among the files to read. The wanted values are sent to all tasks only after a row-limited read has shown
    that they are few; beyond that the join is left to Spark."""
    # Folder values are never empty texts; Spark prunes at run time only for conditions that may leave something out.
    values = queries.select(F.col(wanted).alias("_wanted")).where(F.length(F.col("_wanted").cast("string")) > 0).distinct()
    few = len(values.limit(MAX_WANTED + 1).take(MAX_WANTED + 1)) <= MAX_WANTED
    return corpus.join(F.broadcast(values) if few else values, F.col(partition) == F.col("_wanted"), "left_semi")


def search_partitions(
    queries: DataFrame, corpus: DataFrame, k: int = 10, *, partition: str = "period", wanted: str = "period"
) -> DataFrame:
    """Top-k rows of each query's own partition: query_id, rank, neighbor_id, similarity.

    ``corpus`` is stored by folders of ``partition`` and ``wanted`` names a query's. Queries without one find nothing."""

    def marked(column: str) -> Column:  # the bounded text is contained in another only if it is equal
        return F.concat(F.lit("\x01"), F.col(column).cast("string"), F.lit("\x01"))

    asked = queries.where(F.col(wanted).isNotNull()).withColumn("_wanted", marked(wanted))
    rows = wanted_partitions(queries, corpus, partition, wanted).withColumn("_partition", marked(partition))
    return top_k(asked, rows, k, filters={"_partition": "_wanted"})


SIDES = ("obverse", "reverse")


def picture_queries(queries: DataFrame) -> DataFrame:
    """One query per side of a split picture, or one for a whole picture: query_id, image_id, split_status, side, embedding.

    ``queries`` holds image_id (integer, below 2^61), side and embedding; a row that is neither obverse nor reverse stands
    for the whole picture. A picture with exactly one vector of either side is ``split`` and its whole vector is not asked;
    any other is ``single`` and asks its whole vector (of several the smallest), or nothing if it has none. Rows without a
    vector or an image_id are left out."""
    is_side = {side: F.coalesce(F.col("side") == side, F.lit(False)) for side in SIDES}
    whole = ~(is_side["obverse"] | is_side["reverse"])
    counted = queries.where(F.col("embedding").isNotNull() & F.col("image_id").isNotNull()).groupBy("image_id").agg(
        *[F.count_if(at).alias(f"_n_{side}") for side, at in is_side.items()],
        *[F.min(F.when(at, F.col("embedding"))).alias(f"_{side}") for side, at in is_side.items()],
        F.min(F.when(whole, F.col("embedding"))).alias("_whole"),
    )
    split = (F.col("_n_obverse") == 1) & (F.col("_n_reverse") == 1)

    def one(code: int, side: str | None, vector: str) -> Column:
        return F.struct(F.lit(code).alias("code"), F.lit(side).cast("string").alias("side"), F.col(vector).alias("embedding"))

    sides = F.array(*[one(i + 1, side, f"_{side}") for i, side in enumerate(SIDES)])
    asked = counted.select(
        "image_id",
        F.when(split, "split").otherwise("single").alias("split_status"),
        F.explode(F.when(split, sides).otherwise(F.array(one(0, None, "_whole")))).alias("_asked"),
    ).where(F.col("_asked.embedding").isNotNull())
    number = F.shiftleft(F.col("image_id").cast("long"), 2) + F.col("_asked.code")
    return asked.select(number.alias("query_id"), "image_id", "split_status", "_asked.side", "_asked.embedding")


def search_sides(queries: DataFrame, corpus: DataFrame, k: int = 10, *, same_side: bool = False) -> DataFrame:
    """Top-k rows for each side of a picture: image_id, split_status, side, rank, neighbor_id, similarity.

    Sides are searched in one pass over ``corpus`` (id, embedding), each to its own ``k``; whole pictures have a null side.
    With ``same_side`` a side only meets corpus rows of that ``side``, and whole pictures meet all. Queries as in
    :func:`picture_queries`."""
    asked = picture_queries(queries)
    found = top_k(asked, corpus, k, filters={"side": "side"} if same_side else None)
    code = F.col("query_id").bitwiseAND(F.lit(3))
    names = F.when(code == 1, SIDES[0]).when(code == 2, SIDES[1])
    return found.select(
        F.shiftright("query_id", 2).alias("image_id"),
        F.when(code == 0, "single").otherwise("split").alias("split_status"),
        names.alias("side"), "rank", "neighbor_id", "similarity",
    )


def side_responses(results: DataFrame) -> DataFrame:
    """One row per picture: image_id, split_status and ``coins``, the ranked results of each side (two lists of k rows at most)."""
    hit = F.struct("rank", "neighbor_id", "similarity")
    sides = results.groupBy("image_id", "split_status", "side").agg(F.sort_array(F.collect_list(hit)).alias("results"))
    return sides.groupBy("image_id", "split_status").agg(F.sort_array(F.collect_list(F.struct("side", "results"))).alias("coins"))


def with_period_boost(
    results: DataFrame, queries: DataFrame, classes: list[str], rerank: bool = False
) -> DataFrame:
    """Reported score ``similarity + weight * (p(period) - 1/C)``.

    Each query row carries its class probabilities ``probs``. The order stays by similarity unless
    ``rerank`` numbers the rows by the boosted score.
    """
    probs = queries.select(
        F.col("query_id").alias("_query"), "probs", F.array_max("probs").alias("query_confidence")
    )
    joined = results.join(probs, F.col("query_id") == F.col("_query")).drop("_query")
    place = period_index(F.col("period"), classes)
    boost = F.when(
        place >= 0,
        boost_weight(F.col("query_confidence"))
        * (F.get("probs", place) - F.lit(1.0 / len(classes))),
    ).otherwise(0.0)
    boosted = joined.withColumn("period_boost", boost).withColumns(
        {
            "final_score": F.col("similarity") + F.col("period_boost"),
            "query_period": F.get(
                F.array(*[F.lit(c) for c in classes]),
                (F.array_position("probs", F.col("query_confidence")) - 1).cast("int"),
            ),
        }
    ).drop("probs")
    if not rerank:
        return boosted
    from pyspark.sql.window import Window

    order = [F.col("final_score").desc(), F.col("neighbor_id")]
    # At most k rows per query are left here.
    place_in_query = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return boosted.withColumn("rank", place_in_query.cast("long"))
