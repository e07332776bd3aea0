"""New lots and new vectors as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hoardline.functions.labels import with_labels
from hoardline.operators.catalog import has_text


def unprocessed(lots: DataFrame, processed: DataFrame) -> DataFrame:
    """Lots with a picture whose id is not among the processed ones."""
    done = processed.select(F.col("id").alias("_done"))
    return lots.where(has_text("image_path")).join(done, F.col("id") == F.col("_done"), "left_anti")


def label_new_lots(
    spark: SparkSession, source: str, schema, target: str, checkpoint: str
) -> StreamingQuery:
    """Label every lot file that arrives in ``source``; each file is handled once."""
    lots = spark.readStream.schema(schema).parquet(source)
    waiting = lots.where((F.col("vision_processed") == 0) & has_text("image_path"))
    return (
        with_labels(waiting)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def append_vectors(
    spark: SparkSession, source: str, schema, delta: str, checkpoint: str
) -> StreamingQuery:
    """New vectors into the delta of the current snapshot."""
    return (
        spark.readStream.schema(schema)
        .parquet(source)
        .writeStream.format("parquet")
        .option("path", delta)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
