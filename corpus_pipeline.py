"""From raw documents to training samples: stages over ``documents``, each stored before the next one reads it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hoardline.llm import forest, mixing, pii, segments, toxicity
from hoardline.llm.common import free_names, row_hash, text_or_empty
from hoardline.session import cut_lineage


def _row(docs: DataFrame) -> Column:
    """The key by which the operators name a document of this id and text."""
    return row_hash(F.col("doc_id").cast("long").cast("string"), text_or_empty("text"))


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic.

    Null and empty texts are scored as texts without terms; repeated rows share their score; all columns stay,
    whatever their names; an empty table, or one where all are toxic, gives none."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.accepted(docs, toxicity.train(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its five-word runs, directly or through others.

    The smallest id stays. Null and empty texts are one group; of rows that repeat an id and text one stays, with the other columns of
    any of them; all columns stay, whatever their names; an empty table stays empty."""
    key, name = free_names(docs, "_row", "_kept")
    kept = forest.join(docs).where("kept").select(F.col("row").alias(name)).distinct()
    once = docs.withColumn(key, _row(docs)).join(kept, F.col(key) == F.col(name), "left_semi").dropDuplicates([key])
    return once.select(*_columns(docs))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind; ``n_chars``, where there is one, follows the text.

    Null and empty texts, repeated rows and further columns stay as they are; an empty table stays empty."""
    masked = pii.masked(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    Texts without a word are never taken; a null source is a source; rows that repeat an id and text are taken as often as
    all of them together; all columns stay, whatever their names; an empty table stays empty."""
    key, name, times, copy = free_names(docs, "_row", "_taken", "_times", "_copy")
    each = F.sum(F.col("taken") / F.col("size")).cast("int")
    taken = mixing.mix(docs).where("taken > 0").groupBy(F.col("row").alias(name)).agg(each.alias(times))
    rows = docs.withColumn(key, _row(docs)).dropDuplicates([key]).join(taken, F.col(key) == F.col(name))
    return rows.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*_columns(docs))


def sample_segmentations(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each document, a row each.

    Null and empty texts have none; repeated rows repeat theirs; other columns than id and text are left out."""
    return segments.drawn(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("personal data", mask_personal_data),
    ("source mixing", mix_sources),
    ("segmentations", sample_segmentations),
]
ORACLE_SQL = None  # no stage but the join and the mix can be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        if number:
            docs = cut_lineage(docs, "pipeline")
        docs = stage(spark, docs, sf_dir)
    return docs
