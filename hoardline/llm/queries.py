"""Registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoardline.llm import forest, graphs, mixing, packing, phrases, pii, secrets, segments, subspaces, suffixes, toxicity, trie, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(_table(spark, sf_dir, "documents")))


def op2_vector_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspaces.linked(_table(spark, sf_dir, "embeddings"))


def op3_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, _table(spark, sf_dir, "labels")))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.join(_table(spark, sf_dir, "documents")).drop("row")


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.without_repeats(_table(spark, sf_dir, "documents")))


def op6_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    read_back = warc.archive(_table(spark, sf_dir, "pages"))
    return read_back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return graphs.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_table(spark, sf_dir, "documents")))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


def op10_sampled_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per sampled segmentation with digests of its piece ids and of the text that they decode to."""
    drawn = segments.drawn(_table(spark, sf_dir, "documents"), decoded=True)
    return drawn.select(
        "doc_id",
        "sample",
        F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        "log_prob",
        "perturbed",
        "log_inclusion",
        F.md5("decoded").alias("text_md5"),
    )


def op11_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.packed(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefixes(_table(spark, sf_dir, "conversations")).drop("turn_id")


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_contextual_pii": op1_contextual_pii,
    "op2_vector_near_duplicates": op2_vector_near_duplicates,
    "op3_toxicity_scores": op3_toxicity_scores,
    "op4_ngram_jaccard": op4_ngram_jaccard,
    "op5_repeated_passages": op5_repeated_passages,
    "op6_warc_archive": op6_warc_archive,
    "op7_nearest_vectors": op7_nearest_vectors,
    "op8_secret_scan": op8_secret_scan,
    "op9_source_mixing": op9_source_mixing,
    "op10_sampled_segmentations": op10_sampled_segmentations,
    "op11_best_two_fit": op11_best_two_fit,
    "op12_conversation_trie": op12_conversation_trie,
    "op13_phrase_collocations": op13_phrase_collocations,
}
