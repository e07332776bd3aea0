"""File readers: manifests, feedback logs, cluster results, picture listings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoardline import schemas
from hoardline.functions import vocabulary as V
from hoardline.functions.paths import basename
from hoardline.operators.ranking import seeded_row_number, spread_row_number

# Fixed value: file endings that count as pictures.
PICTURES = ("jpg", "jpeg", "png", "webp", "bmp", "tif", "tiff")


def read_manifest(
    spark: SparkSession, paths: str | list[str], schema: str = schemas.MANIFEST, *, lines: bool = True
) -> DataFrame:
    """Manifest records with ``_manifest_index``, their position over all files in path order.

    JSON lines are split between tasks. ``lines=False`` reads files that hold one JSON array each; such
    a file is parsed by a single task, so write large manifests as lines.
    """
    read = spark.read.schema(schema).option("multiLine", not lines).json(paths)
    placed = read.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_start": F.col("_metadata.file_block_start"),
            "_line": F.monotonically_increasing_id(),
        }
    )
    # A file block is read by one task, in order, so lines are ordered within it.
    ranked = spread_row_number(
        placed, "_position", bucket=F.struct("_file", "_start"), order=[F.col("_line")]
    )
    return ranked.withColumn("_manifest_index", F.col("_position") - 1).drop(
        "_file", "_start", "_line", "_position"
    )


def read_split_manifests(spark: SparkSession, paths: dict[str, str], schema: str = schemas.MANIFEST) -> DataFrame:
    """Union of the manifests of several splits."""
    parts = [
        spark.read.schema(schema).json(path).withColumn("split", F.lit(split))
        for split, path in paths.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def read_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; only lines that are not JSON objects are left out."""
    return parsed_lines(spark.read.text(path), schema)


def parsed_lines(lines: DataFrame, schema: str, keep: list[str] | None = None) -> DataFrame:
    """The fields of ``schema`` from lines of JSON in ``value``, beside the columns to ``keep``. A field that cannot be read as its type is null; numbers may be written as
    text. Only lines that are not JSON objects are dropped."""
    keep = keep or []
    fields = lines.select(F.from_json("value", "map<string,string>").alias("fields"), *keep).where("fields IS NOT NULL AND size(fields) > 0")
    wanted = T.StructType.fromDDL(schema)
    return fields.select(*[F.col("fields").getItem(f.name).try_cast(f.dataType).alias(f.name) for f in wanted], *keep)


def read_cluster_results(spark: SparkSession, path: str) -> DataFrame:
    """Cluster results with ``id`` as an integer, null where it is not one."""
    raw = spark.read.schema(schemas.CLUSTER_RESULTS).option("header", True).csv(path)
    number = F.col("id").try_cast("double")
    return raw.withColumn("id", F.when(number == F.floor(number), number.cast("long")))


def list_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """Paths and sizes below ``root``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(root).select(
        F.regexp_replace("path", r"^file:/+", "/").alias("path"), "length"
    )


def pictures(listing: DataFrame) -> DataFrame:
    ending = F.lower(F.substring_index("path", ".", -1))
    return listing.where(ending.isin(*PICTURES))


def with_file_ids(listing: DataFrame) -> DataFrame:
    """Integer id from the file-name prefix before the first underscore.

    Files without one are numbered -1, -2, … in a repeatable order; of several files with one id the
    last path counts.
    """
    prefix = F.substring_index(basename(F.col("path")), "_", 1)
    numbered = listing.withColumn(
        "id", F.when(prefix.rlike(r"^[+-]?\d+$"), prefix.try_cast("long"))
    )
    known = numbered.where(F.col("id").isNotNull()).groupBy("id").agg(F.max("path").alias("path"))
    rest = seeded_row_number(
        numbered.where(F.col("id").isNull()).select("path"), "_n", "path"
    ).select((-F.col("_n")).alias("id"), "path")
    return known.unionByName(rest)


def directory_dataset(listing: DataFrame, dataset: DataFrame) -> DataFrame:
    """Pictures of a folder with the period of the dataset row their name refers to.

    Files with an unknown id drop out; files without an id stay, as ``unknown``.
    """
    files = with_file_ids(pictures(listing))
    fields = dataset.select(
        F.col("id").alias("_id"), "period", "label_confidence", "raw_label"
    )
    joined = files.join(fields, F.col("id") == F.col("_id"), "left")
    return joined.where((F.col("id") < 0) | F.col("_id").isNotNull()).select(
        "id",
        F.col("path").alias("image_path"),
        F.when(F.col("id") < 0, "unknown").otherwise(F.col("period")).alias("period"),
        "label_confidence",
        "raw_label",
    )


def class_folders(listing: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """Pictures labelled by their folder, where that is a known class."""
    known = classes or list(V.KEYWORD_CLASSES)
    ending = F.lower(F.substring_index("path", ".", -1))
    return (
        listing.where(ending.isin("jpg", "jpeg", "png"))
        .withColumn("period", F.element_at(F.split("path", "/"), -2))
        .where(F.col("period").isin(*known))
        .select(
            F.col("path").alias("image_path"), "period", F.lit("human_correction").alias("source")
        )
    )


def training_manifest(labelled: DataFrame, corrections: DataFrame) -> DataFrame:
    """Labelled lots and human corrections together; nothing is removed."""
    rows = labelled.select(
        "image_path", "period", F.lit("database").alias("source"), F.col("id").alias("db_id")
    )
    return rows.unionByName(corrections, allowMissingColumns=True)


def flatten_detections(raw: DataFrame, column: str = "vision_metadata") -> DataFrame:
    """Detector JSON as flat columns, with the original text kept."""
    d = F.from_json(F.col(column), schemas.DETECTION_JSON)
    parsed = raw.withColumn("_d", d)
    geometry = "_d.layer_1.geometry"
    corners = {f"bbox_{n}": F.get("_d.bbox", F.lit(i)) for i, n in enumerate("xywh")}
    zero, blank = F.lit(0.0), F.lit("")
    return parsed.select(
        *raw.columns,
        F.col("_d.detection_index").alias("detection_index"),
        F.coalesce("_d.inferred_side", F.lit("unknown")).alias("inferred_side"),
        F.coalesce(f"{geometry}.circularity", zero).alias("circularity"),
        F.coalesce(f"{geometry}.solidity", zero).alias("solidity"),
        F.coalesce(f"{geometry}.coin_likelihood", zero).alias("coin_likelihood"),
        F.coalesce("_d.layer_1.classification.confidence", zero).alias("edge_support"),
        *[F.coalesce(c, F.lit(0)).alias(n) for n, c in corners.items()],
        F.coalesce("_d.final_classification", blank).alias("final_classification"),
        F.coalesce("_d.layer_2.context_classification.inferred_container", blank).alias(
            "layer2_container"
        ),
    )
