"""Files, logs, snapshots, mutations and streams."""

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from hoardline import schemas
from hoardline.functions import vectors
from hoardline.operators import audit, catalog, clusters, evaluate, feedback, matching, mutate, splits
from hoardline.session import cut_lineage, scratch_path, shared_dir
from hoardline.sources import files, sinks, snapshots, tables
from hoardline.streaming import feedback as stream


def test_manifest_array_file(spark, tmp_path):
    records = [
        {"obverse": {"image_path": "a"}, "reverse": {"image_path": "b"}, "period": "greek", "coin_id": "9"},
        {"obv_path": "c", "rev_path": "d", "has_obv": "no"},
        {"obverse_path": "e", "reverse_path": ""},
        {"image_path": "f"},
    ]
    path = tmp_path / "m.json"
    path.write_text(json.dumps(records))
    rows = splits.canonical_pairs(files.read_manifest(spark, str(path), lines=False)).orderBy("_manifest_index").collect()
    assert [r["_manifest_index"] for r in rows] == [0, 1, 2, 3]
    assert [(r["pair_obverse"], r["pair_reverse"], r["is_complete"]) for r in rows] == [
        ("a", "b", True), ("c", "d", False), ("e", None, False), (None, None, False),
    ]
    assert [r["pair_identity"] for r in rows] == ["9", "coin_1", "coin_2", "coin_3"]


def test_listing_and_ids(spark, tmp_path, frame):
    for name in ("12_a.jpg", "sub/13_b.PNG", "x_c.jpg", "sub/y.webp", "14_d.txt"):
        target = tmp_path / name
        target.parent.mkdir(exist_ok=True)
        target.write_bytes(b"x")
    listing = files.list_files(spark, str(tmp_path))
    assert listing.count() == 5
    dataset = frame("id long, period string, label_confidence double, raw_label string", (12, "greek", 0.5, "r"))
    rows = {r["image_path"].split("/")[-1]: r for r in files.directory_dataset(listing, dataset).collect()}
    assert set(rows) == {"12_a.jpg", "x_c.jpg", "y.webp"}
    assert rows["12_a.jpg"]["period"] == "greek" and rows["x_c.jpg"]["period"] == "unknown"
    assert {rows["x_c.jpg"]["id"], rows["y.webp"]["id"]} == {-1, -2}


def test_class_folders(frame):
    rows = frame("path string", ("c/greek/a.JPG",), ("c/greek/a.gif",), ("c/nope/a.jpg",), ("c/celtic/b.png",))
    assert {(r["period"], r["image_path"]) for r in files.class_folders(rows).collect()} == {
        ("greek", "c/greek/a.JPG"), ("celtic", "c/celtic/b.png"),
    }


def test_suffix_match_is_literal(frame):
    log = frame("filename string", ("a_1.jpg",), ("100%.jpg",))
    rows = frame("id long, image_path string", (1, "x/a_1.jpg"), (2, "x/aX1.jpg"), (3, "x/ba_1.jpg"), (4, "y/100%.jpg"), (5, "y/1000.jpg"))
    pairs = {(r["filename"], r["id"]) for r in feedback.match_by_suffix(log, rows).collect()}
    assert pairs == {("a_1.jpg", 1), ("a_1.jpg", 3), ("100%.jpg", 4)}
    exact = {(r["filename"], r["id"]) for r in feedback.match_by_basename(log, rows).collect()}
    assert exact == {("a_1.jpg", 1), ("100%.jpg", 4)}


def test_decisions(frame):
    rows = frame(
        "id long, period string, subperiod string, needs_review int, is_verified int",
        (1, "a", "s", 1, 0), (2, "a", "s", 1, 0), (3, "a", "s", 1, 0), (4, "a", "s", 1, 0),
    )
    decisions = frame(
        "id long, action string, period string, subperiod string",
        (1, "update", "", ""), (2, "update", "b", None), (3, "delete", None, None),
    )
    got = {r["id"]: tuple(r)[1:] for r in mutate.apply_decisions(rows, decisions, "id").collect()}
    assert got == {1: ("a", "", 0, 1), 2: ("b", "s", 0, 1), 4: ("a", "s", 1, 0)}


def test_excluded_cluster_by_name_else_id(frame):
    named = frame("id long, cluster_id string, visual_cluster string", (1, "5", "cluster_5"), (2, "5", "other"))
    assert [r["id"] for r in clusters.in_cluster(named, "5").collect()] == [1]
    by_id = frame("id long, cluster_id string, visual_cluster string", (1, "5", None), (2, "6", "x"))
    assert [r["id"] for r in clusters.in_cluster(by_id, "5").collect()] == [1]


def test_names_of_clusters(frame):
    rows = [("1", "greek")] * 9 + [("1", "x")] + [("2", "a")] * 6 + [("2", "b")] * 4 + [("3", "a"), ("3", "b"), ("3", "c"), ("-1", "a")]
    table = frame("cluster_id string, parser_period string, cluster_confidence double", *[(c, p, 1.0) for c, p in rows])
    got = {r["cluster_id"]: r["suggested_name"] for r in clusters.suggest_names(clusters.cluster_summary(table)).collect()}
    assert got == {"1": "greek_pure", "2": "a_with_b", "3": "mixed_a_b"}


def test_side_rank(frame):
    rows = frame("side string", ("reverse",), ("obverse",), ("odd",), ("unknown",), (None,))
    ranked = {r["side"]: r["k"] for r in rows.select("side", catalog.side_rank(F.col("side")).alias("k")).collect()}
    assert ranked == {"obverse": 1, "reverse": 2, "unknown": 3, "odd": 0, None: 0}


def test_snapshot_cycle(spark, frame):
    root = scratch_path(spark, "test-store")
    snapshots.write_snapshot(spark.range(100), root, 1)
    assert snapshots.compact(spark, root, 1) == 1
    snapshots.append_delta(spark.range(100, 105), root, 1)
    assert snapshots.compact(spark, root, 1) == 1
    assert snapshots.read_current(spark, root, 1).count() == 105
    snapshots.append_delta(spark.range(105, 120), root, 1)
    assert snapshots.compact(spark, root, 1) == 2
    assert snapshots.read_current(spark, root, 2).count() == 120
    assert spark.read.parquet(snapshots.snapshot_path(root, 1)).count() == 100


def test_stream_counts_repeated_entries_once(spark, frame):
    log, target, state = (scratch_path(spark, f"test-{n}") for n in ("log", "out", "state"))
    dataset = frame("id long, image_path string", (1, "x/a.jpg"), (2, "x/b.jpg"))

    def send(*rows):
        entries = frame("timestamp long, filename string, label string, confidence double", *rows)
        empty = frame(schemas.CORRECTIONS).drop("type")
        sinks.append_feedback(entries, empty, log)
        stream.sync_feedback(spark, log, dataset, target, state).awaitTermination()

    send((1, "a.jpg", "greek", 0.9), (1, "a.jpg", "greek", 0.9))
    send((1, "a.jpg", "greek", 0.9), (2, "b.jpg", "celtic", 0.8))
    rows = spark.read.parquet(target).collect()
    assert sorted((r["ml_dataset_id"], r["human_label"]) for r in rows) == [(1, "greek"), (2, "celtic")]
    batch = stream.feedback_rows(spark.read.schema(schemas.FEEDBACK).json(log), dataset).collect()
    assert len(batch) == 2


def test_vector_checks(frame):
    nan, inf = float("nan"), float("inf")
    rows = frame("v array<float>", ([1.0, 0.0],), ([nan, 0.0],), ([inf, 0.0],), ([3.0, 4.0],), ([1.0],))
    got = audit.vector_quality(rows, "v", 2).first().asDict()
    assert got == {"vectors": 5, "wrong_dimension": 1, "not_finite": 2, "bad_norm": 3}
    unit = frame("v array<float>", ([3.0, 4.0],), ([0.0, 0.0],)).select(vectors.normalize(F.col("v"))).collect()
    assert unit[0][0] == pytest.approx([0.6, 0.8]) and unit[1][0] == [0.0, 0.0]


def test_normalize_computes_the_norm_once(spark):
    rows = spark.range(10).select(F.transform(F.sequence(F.lit(1), F.lit(2000)), lambda x: x.cast("float")).alias("v"))
    assert rows.select(vectors.norm(vectors.normalize(F.col("v"))).alias("n")).where("abs(n - 1) > 1e-9").count() == 0


def test_alignment_is_enforced(frame):
    with pytest.raises(ValueError, match="left_only"):
        tables.check_alignment(frame("k long", (1,), (2,)), frame("k long", (1,)), "k")
    tables.check_alignment(frame("k long", (1,)), frame("k long", (1,)), "k")


def test_paths_prefer_best_spelling(frame):
    records = frame("id long, image_path string", (1, "/root/data/a.jpg"), (2, "zzz.jpg"))
    found = matching.vectors_by_path(
        records, frame("vec_id long, path string", (5, "data/a.jpg"), (6, "root/data/a.jpg"), (7, "a.jpg")),
        [("image_path", "path")], [],
    ).collect()
    assert [(r["id"], r["vec_id"]) for r in found] == [(1, 6)]


def test_report_of_empty_and_missing_classes(frame):
    rows = frame("y_true string, y_pred string", ("a", "a"), ("a", "b"), ("c", "a"))
    got = {r["label"]: r for r in evaluate.classification_report(rows).collect()}
    assert got["b"]["support"] == 0 and got["b"]["recall"] == 0.0 and got["c"]["f1"] == 0.0
    assert got["a"]["precision"] == 0.5 and got["accuracy"]["f1"] == pytest.approx(1 / 3)
    wide = {r["label"]: r for r in evaluate.confusion_pivot(rows, ["a", "b", "c"], normalized=True).collect()}
    assert wide["a"]["b"] == 0.5 and wide["b"]["a"] == 0.0


def test_shared_folder_is_reused(spark):
    assert shared_dir(spark) == shared_dir(spark)
    kept = cut_lineage(spark.range(5).select((F.col("id") + 1).alias("x")))
    assert kept.count() == 5 and "Range" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_shared_folder_falls_back_only_locally():
    def session(master):
        context = SimpleNamespace(master=master, applicationId=f"app-{master}")
        return SimpleNamespace(conf={}, sparkContext=context)

    local = session("local[2]")
    assert shared_dir(local).startswith("/tmp/spark-") and shared_dir(local) == shared_dir(local)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"))
