"""Repeated changes never add rows; word characters and lot numbers as the rules have them."""

import pytest
from pyspark.sql import functions as F

from hoardline.functions import text
from hoardline.operators import dedup, evaluate, knn, mutate, pairing


def test_last_decision_counts(frame):
    data = frame("id long, period string, subperiod string, needs_review int, is_verified int", (1, "greek", None, 1, 0), (2, "greek", None, 1, 0), (3, None, None, 1, 0))
    decisions = frame(
        "id long, action string, period string, subperiod string, at int",
        (1, "keep", "roman", None, 1), (1, "keep", "islamic", None, 2), (2, "delete", None, None, 1), (2, "keep", "roman", None, 2), (None, "keep", "x", None, 3),
    )
    rows = mutate.apply_decisions(data, decisions, order="at").orderBy("id").collect()
    assert [(r.id, r.period, r.is_verified) for r in rows] == [(1, "islamic", 1), (3, None, 0)]


def test_decisions_apply_one_after_the_other(frame):
    data = frame("id long, period string, subperiod string, needs_review int, is_verified int", (1, "greek", "old", 1, 0), (2, "greek", "old", 1, 0), (3, "greek", "old", 1, 0))
    decisions = frame(
        "id long, action string, period string, subperiod string, at int",
        (1, "keep", "roman", None, 1), (1, "keep", "", "late", 2), (1, "keep", None, None, 3),  # the blank keeps roman, the missing keeps late
        (2, "keep", "zeta", "early", 1), (2, "keep", "alpha", "", 2),  # the later one wins although it sorts first; blank clears
        (3, "keep", "roman", None, None), (3, None, "alpha", None, 1),  # a missing place comes first
    )
    rows = mutate.apply_decisions(data, decisions, "at").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "roman", "late", 0, 1), (2, "alpha", "", 0, 1), (3, "alpha", "old", 0, 1)]


def test_repeated_metadata_and_links_keep_row_counts(frame):
    lots = frame("id long, site string, sale_id string", (1, "a", "1"), (2, "b", "2"))
    news = frame("id long, site string, sale_id string, at int", (1, "d", "4", 1), (1, "c", "3", 2))
    assert sorted(map(tuple, mutate.set_lot_metadata(lots, news, "at").collect())) == [(1, "c", "3"), (2, "b", "2")]
    found = frame("id long, coin_id long, side string, side_confidence double", (7, None, None, None), (8, 1, "obverse", 0.5))
    links = frame("detection_id long, coin_id long, side string, side_confidence double", (7, 5, "obverse", 0.9), (7, 6, "reverse", 0.8))
    assert sorted(map(tuple, pairing.link_detections(found, links).collect())) == [(7, 6, "reverse", 0.8), (8, 1, "obverse", 0.5)]


@pytest.mark.parametrize(("value", "wanted"), [("3000000000", 3_000_000_000), ("12\t", 12), (" 7 ", 7), ("12.5", 0), ("A7", 0), (None, 0), ("", 0)])
def test_lot_numbers_are_64_bit(frame, value, wanted):
    assert frame("x string", (value,)).select(text.safe_int(F.col("x"))).first()[0] == wanted


@pytest.mark.parametrize(("value", "found"), [("ric² denarius", False), ("ric denarius", True), ("½ric", False), ("ric-45", True), ("éric", False), ("ric\u0301", True)])
def test_numbers_of_all_kinds_are_word_characters(frame, value, found):
    row = frame("x string", (value,)).select(F.size(text.words_found(F.col("x"), ["ric"])) > 0, F.col("x").rlike(text.word_pattern(["ric"]))).first()
    assert tuple(row) == (found, found)


def test_rows_without_vector_take_no_part(frame):
    rows = frame("id long, embedding array<float>", (1, [1.0, 0.0]), (2, None), (3, [0.9, 0.1]))
    assert [(r.query_id, r.neighbor_id) for r in knn.knn_join(rows, rows, 2).orderBy("query_id").collect()] == [(1, 3), (3, 1)]


def test_pictures_of_another_size_have_no_hash(frame):
    rows = frame("pixels array<double>", ([float(i % 7) for i in range(1024)],), (None,), ([1.0],))
    hashes = [r[0] for r in rows.select(dedup.perceptual_hash(F.col("pixels"))).collect()]
    assert len(hashes[0]) == 16 and hashes[1:] == [None, None]


def test_unlisted_classes_are_counted(frame):
    rows = frame("y_true string, y_pred string", ("a", "a"), ("a", "z"), ("z", "b"), (None, "a"))
    got = {r.label: tuple(r)[1:] for r in evaluate.confusion_pivot(rows, ["a", "b"]).collect()}
    assert got == {"a": (1, 0, 1), "b": (0, 0, 0), "other": (1, 1, 0)}


def test_a_path_of_two_lots_is_stored_for_one(spark):
    """two lots with one path, the file stored for the first only."""
    lots = spark.createDataFrame([(1, "leu_7/Lot_000010.jpg"), (2, "leu_7/Lot_000010.jpg"), (3, "raw/x.jpg")], "id long, image_path string")
    listing = lots.where("id = 1").select("id", F.col("image_path").alias("path"))
    got = {r["id"]: r["migration"] for r in mutate.migrate_paths(lots, listing, owner="id").collect()}
    assert got == {1: "migrated", 2: "missing", 3: None}
    assert {r["migration"] for r in mutate.migrate_paths(lots, listing).where("id < 3").collect()} == {"migrated"}
