"""Session set-up and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Laptop-sized figures for local runs only; a cluster passes its own through spark-submit.
LOCAL_DEFAULTS = {
    "spark.driver.memory": "16g",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
}

# Engine settings that hold at any scale.
COMMON = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # One matrix product per task; tasks, not threads inside them, fill the cores.
    "spark.executorEnv.OMP_NUM_THREADS": "1",
}


_LOCAL_DIRS: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "hoardline") -> SparkSession:
    """A ``local[cores]`` session for tests and the benchmark."""
    os.environ.setdefault("OMP_NUM_THREADS", "1")  # inherited by the local Python workers
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**LOCAL_DEFAULTS, **COMMON}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster the folder has to
    be readable from every executor, so a missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _LOCAL_DIRS[application]


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder; nothing is created or removed."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, purpose: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    The stored copy outlives lost executors and truncates the plan of iterative operators.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread_narrow(df: DataFrame) -> DataFrame:
    """Rows of a scan spread over all cores if the scan has fewer partitions than there are cores.

    For operators that are heavy on every row and read a small file. Large tables have many more
    partitions than cores and pass through untouched.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
