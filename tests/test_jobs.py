"""The end-to-end jobs on a folder of catalogue tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

from hoardline.plans.jobs import JOBS, run
from hoardline.plans.views import Views
from hoardline.session import scratch_path

TABLES = [
    "auction_data", "auction_info", "coin_detections", "coins", "ml_dataset", "ml_coin_dataset", "cluster_results",
]


@pytest.fixture(scope="module")
def tables(spark):
    views = Views(spark, "/root/testdata/sf0.001")
    root = scratch_path(spark, "tables")
    for name in TABLES:
        views(name).write.parquet(f"{root}/{name}")
    views.cluster_results.select("id", F.col("parser_period").alias("period"), "image_path", "embedding").write.parquet(
        f"{root}/vectors"
    )
    return root


def go(spark, job, tables, **options):
    out = scratch_path(spark, f"out-{job}")
    run(spark, job, tables, out, **options)
    return out


def test_pair(spark, tables):
    out = go(spark, "pair", tables)
    before = spark.read.parquet(f"{tables}/coin_detections")
    after = spark.read.parquet(f"{out}/coin_detections")
    assert after.count() == before.count()
    loose = "coin_id IS NULL AND coin_likelihood >= 0.5 AND normalized_path <> ''"
    assert before.where(loose).count() > 0 and after.where(loose).count() == 0
    coins = spark.read.parquet(f"{out}/coins")
    linked = after.where("coin_id IS NOT NULL").select(F.col("coin_id").alias("id")).distinct()
    assert linked.join(coins, "id", "left_anti").count() == 0


def test_exports(spark, tables):
    out = go(spark, "export-pairs", tables, rule="duplicate")
    rows = spark.read.parquet(f"{out}/dataset")
    assert rows.count() == rows.select("coin_id").distinct().count() > 0
    assert {r["split"] for r in rows.select("split").distinct().collect()} == {"train", "val", "test"}
    summary = json.loads(spark.read.text(f"{out}/summary").first()[0])
    splits = sum(s["rows"] for s in summary["statistics"] if s["section"] == "split")
    assert splits == rows.count() and summary["config"]["train_ratio"] == "0.70"
    fit = spark.read.json(f"{out}/manifests/json")
    assert fit.count() == rows.where("label_confidence >= 0.6").count()
    assert go(spark, "export-detections", tables)


def test_check_and_fix(spark, tables):
    out = go(spark, "check", tables, fix=True)
    left = spark.read.parquet(f"{out}/ml_dataset").where("needs_review = 1 AND is_verified = 1")
    assert left.count() == 0 and spark.read.json(f"{out}/health").first()["health"] == 0


def test_sync(spark, tables):
    log = scratch_path(spark, "log")
    os.makedirs(log)
    with open(f"{log}/a.jsonl", "w") as f:
        f.write('{"timestamp": 1, "type": "confirmation", "filename": "doc_5.jpg", "label": "fr", "confidence": 0.9}\n')
        f.write("{broken\n")
    out = go(spark, "sync", tables, log=log)
    assert spark.read.parquet(f"{out}/verified_feedback").count() == 1
    row = spark.read.parquet(f"{out}/ml_dataset").where("id = 5").first()
    assert row["is_verified"] == 1 and row["needs_review"] == 0


@pytest.mark.parametrize("job, options", [("label", {}), ("repair", {}), ("stats", {}), ("enrich", {}), ("index", {"k": "3"}), ("cluster", {"eps": "1.0"})])
def test_other_jobs(spark, tables, job, options):
    assert go(spark, job, tables, **options)


def test_every_job_is_covered():
    covered = {"pair", "export-pairs", "export-detections", "check", "sync", "label", "repair", "stats", "enrich", "index", "cluster"}
    assert covered == set(JOBS)
