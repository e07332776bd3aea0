"""File names as patterns against a plain matcher, and audits that read each table once."""

import random
import re

import pytest
from pyspark.sql import functions as F

from hoardline.operators import audit, feedback


def like(pattern):
    """A regular expression for the names that ``%pattern`` matches."""
    out, at = ".*", 0
    while at < len(pattern):
        c = pattern[at]
        if c == "\\" and at + 1 < len(pattern):
            at += 1
            out += re.escape(pattern[at])
        else:
            out += {"_": ".", "%": ".*"}.get(c, re.escape(c))
        at += 1
    return re.compile(out, re.S)


def has_plain(pattern):
    return bool(re.sub(r"[_%]", "", re.sub(r"\\.", "x", pattern)))


@pytest.mark.parametrize("seed", [1, 2])
def test_patterns_against_a_plain_matcher(spark, seed):
    rng = random.Random(seed)
    paths = ["".join(rng.choices("ab_%/\\é.", k=rng.randint(0, 9))) for _ in range(150)] + [None, "", "a", "raw/lot_1.jpg", "raw/lotx1.jpg"]
    names = {"".join(rng.choices("ab_%\\é.", k=rng.randint(0, 6))) for _ in range(120)} | {"lot_1.jpg", "lot\\_1.jpg", "%", "_", "a%", "a%b_%", "\\"}
    rows = spark.createDataFrame(list(enumerate(paths)), "id long, image_path string")
    entries = spark.createDataFrame([(n, i) for i, n in enumerate(sorted(names))] + [(None, -1), ("lot_1.jpg", -2)], "filename string, entry int")
    got = sorted((r.entry, r.id) for r in feedback.match_by_pattern(entries, rows).collect())
    pairs = [(n, i) for i, n in enumerate(sorted(names))] + [("lot_1.jpg", -2)]
    wanted = sorted((e, i) for n, e in pairs if has_plain(n) for i, p in enumerate(paths) if p is not None and like(n).fullmatch(p))
    assert got == wanted and len(got) > 100


def test_patterns_without_cross_joins_and_without_rows(spark, frame):
    rows = frame("id long, image_path string", (1, "raw/lot_1.jpg"))
    none = frame("filename string")
    assert feedback.match_by_pattern(none, rows).count() == 0
    assert feedback.match_by_pattern(frame("filename string", ("lot_1.jpg",)), rows.where("false")).count() == 0
    plan = feedback.match_by_pattern(frame("filename string", ("lot_1.jpg",)), rows)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_feedback_by_pattern(frame):
    log = frame(
        "filename string, predicted string, actual string, confidence double, result string",
        ("lot_1.jpg", "greek", "roman", 0.9, "WRONG"),
    )
    dataset = frame("id long, image_path string", (1, "raw/lot_1.jpg"), (2, "raw/lotx1.jpg"), (3, "raw/lot_2.jpg"))
    found = {match: sorted(r.ml_dataset_id for r in feedback.verified_feedback(log, dataset, match).collect()) for match in ("basename", "suffix", "like")}
    assert found == {"basename": [1], "suffix": [1], "like": [1, 2]}


def test_audit_reads_each_table_once_for_its_rows(spark, frame, tmp_path):
    dataset = frame(
        "id long, period string, label_confidence double, image_path string, image_hash string, coin_detection_id long, needs_review int, is_verified int",
        (1, "greek", 0.0, "a/roman/1.jpg", "h", 10, 1, 1),
        (2, None, 0.9, None, "h", None, 0, None),
        (3, "greek", 0.5, "a/greek/3.jpg", None, 11, None, 1),
        (4, "greek", None, "x.jpg", "", 99, 0, 0),
    )
    detections = frame(
        "id long, auction_record_id long, coin_likelihood double, circularity double, solidity double, edge_support double",
        (10, 5, 0.5, 1.5, 0.5, None), (11, 6, None, None, None, None), (11, None, 0.1, 0.1, 0.1, -0.1),
    )
    tables = []
    for name, table in (("dataset", dataset), ("detections", detections), ("lots", frame("id long", (5,), (5,)))):
        table.write.parquet(f"{tmp_path}/{name}")
        tables.append(spark.read.parquet(f"{tmp_path}/{name}"))
    found = audit.all_issues(*tables)
    assert sorted((r.category, r.id) for r in found.collect()) == [
        ("CONFIDENCE_ZERO_WITH_PERIOD", 1), ("CONFLICTING_FLAGS", 1), ("DUPLICATE_HASH", 1),
        ("INVALID_DETECTION_METRICS", 10), ("INVALID_DETECTION_METRICS", 11),
        ("NULL_PERIOD_HIGH_CONFIDENCE", 2), ("ORPHAN_DETECTION", 11), ("ORPHAN_DETECTION", 11),
        ("ORPHAN_ML_DATASET", 2), ("ORPHAN_ML_DATASET", 4), ("PATH_PERIOD_MISMATCH", 1), ("PATH_PERIOD_MISMATCH", 4),
    ]
    # The dataset twice (rows, repeated hashes), detections twice (rows, parents), lots as parents.
    assert found._jdf.queryExecution().sparkPlan().toString().count("FileScan parquet") == 5


def test_a_shared_ending_is_not_the_key(spark, frame):
    """names that end in ``%jpg`` meet only paths with the characters particular to them."""
    names = frame("filename string", *[(f"doc_{i}%jpg",) for i in range(10, 40)], *[(f"doc_{i}.%",) for i in range(10, 40)], ("_a%1",), ("a_a",))
    described = {r["filename"]: r for r in feedback.with_pattern(names).collect()}
    assert described["doc_12%jpg"]["_key"] == "doc12" and not described["doc_12%jpg"]["_last"]
    assert described["doc_12.%"]["_key"] == "doc12." and described["doc_12.%"]["_head"] == "doc"
    paths = [f"web/en/doc_{i}.jpg" for i in range(60)] + ["aaa", "xaab1", "doc_12/doc_12.jpg"]
    rows = spark.createDataFrame(list(enumerate(paths)), "id long, image_path string")
    got = sorted((r["filename"], r["id"]) for r in feedback.match_by_pattern(names, rows).collect())
    wanted = rows.crossJoin(names).where(F.expr(r"image_path LIKE concat('%', filename) ESCAPE '\\'"))
    assert got == sorted((r["filename"], r["id"]) for r in wanted.collect()) and len(got) > 60
