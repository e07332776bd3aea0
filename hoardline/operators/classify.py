"""Class-weighted period classifier over embedding vectors."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoardline.operators.splits import class_weights, label_index


def training_rows(df: DataFrame, label: str, vector: str, cap: float = 10.0) -> DataFrame:
    """Feature vector, label index and capped class weight per row.

    Classes are a small table; the join broadcasts it only while it is under Spark's size threshold.
    """
    weights = class_weights(df, label, cap).select(F.col(label).alias("_label"), "weight")
    index = label_index(df, label).select(
        F.col(label).alias("_class"), F.col("label_index").cast("double").alias("class_index")
    )
    return (
        df.join(weights, F.col(label) == F.col("_label"))
        .join(index, F.col(label) == F.col("_class"))
        .withColumn("features", array_to_vector(vector))
        .drop("_label", "_class")
    )


def train(rows: DataFrame, max_iter: int = 20, regularization: float = 0.01) -> LogisticRegressionModel:
    return LogisticRegression(
        featuresCol="features",
        labelCol="class_index",
        weightCol="weight",
        maxIter=max_iter,
        regParam=regularization,
    ).fit(rows)


def predict(model: LogisticRegressionModel, rows: DataFrame) -> DataFrame:
    """Predicted class index, its probability, and all probabilities."""
    scored = model.transform(rows).withColumn("probs", vector_to_array("probability"))
    return scored.select(
        "id",
        F.col("class_index").cast("long").alias("y_true"),
        F.col("prediction").cast("long").alias("y_pred"),
        F.array_max("probs").alias("confidence"),
        "probs",
    )
