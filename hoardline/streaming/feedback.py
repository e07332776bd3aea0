"""Feedback logs as a stream into the verified-feedback table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hoardline import schemas
from hoardline.operators.feedback import align_logs, mark_ids, verified_feedback, verified_ids
from hoardline.sources.files import parsed_lines

EVENT_KEY = ["filename", "type", "timestamp"]
ENTRY = [*EVENT_KEY, "corrected_label", "label"]  # two answers for one file are two entries


def with_kind(log: DataFrame) -> DataFrame:
    """``log`` with ``type`` taken from the fields where the entry does not say it."""
    guessed = F.when(F.col("corrected_label").isNotNull(), "correction").when(F.col("label").isNotNull(), "confirmation")
    return log.withColumn("type", F.coalesce("type", guessed))


def split_log(log: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Both record shapes of a log under common columns."""
    log = with_kind(log)
    return align_logs(
        log.where(F.col("type") == "correction"), log.where(F.col("type") == "confirmation"), keep
    )


def feedback_rows(log: DataFrame, dataset: DataFrame, match: str = "basename") -> DataFrame:
    """Verified-feedback rows of a batch of log entries; repeated entries count once."""
    return verified_feedback(split_log(with_kind(log).dropDuplicates(ENTRY)), dataset, match)


def sync_feedback(
    spark: SparkSession,
    log_path: str,
    dataset: DataFrame,
    target: str,
    checkpoint: str,
    *,
    marks: str | None = None,
    remember: str = "30 days",
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Append the feedback of all new log files to ``target`` and, in ``marks``, the rows it verifies.

    Entries are told apart by their key and label. The stream's keyed state holds those of files that
    arrived within ``remember``, by the files' time and not by that of the entries, so an entry that a log reports late still counts, one
    that is delivered again within that time does not, and the state stays bounded. No stored feedback is
    read again. Each micro-batch writes folders of its own, named by the batch id, so a batch that is run
    again after a failure replaces its output instead of adding to it.
    """
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.format("text").load(log_path).select("value", F.col("_metadata.file_modification_time").alias("arrived"))
    entries = with_kind(parsed_lines(lines, schemas.FEEDBACK, keep=["arrived"]))
    fresh = entries.withWatermark("arrived", remember).dropDuplicatesWithinWatermark(ENTRY).drop("arrived")

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = verified_feedback(split_log(batch, EVENT_KEY[1:]), dataset, keep=EVENT_KEY)
        folder = f"{target}/batch={batch_id}"
        rows.write.mode("overwrite").parquet(folder)
        if marks:
            stored = batch.sparkSession.read.schema(rows.schema).parquet(folder)
            verified_ids(stored).write.mode("overwrite").parquet(f"{marks}/batch={batch_id}")

    return (
        fresh.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def verified_dataset(dataset: DataFrame, marks: str) -> DataFrame:
    """``dataset`` with the rows marked verified that any batch of the stream has named."""
    ids = dataset.sparkSession.read.schema("id long, batch long").parquet(marks).select("id")
    return mark_ids(dataset, ids)
