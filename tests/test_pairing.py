from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hoardline.functions.geometry import box_with_margin
from hoardline.operators import dedup, export, pairing

DETECTION = (
    "id long, auction_record_id long, detection_index int, coin_id long, side string, side_confidence double, "
    "coin_likelihood double, bbox_x int, bbox_y int, bbox_w int, bbox_h int, normalized_path string"
)
COIN = "id long, auction_record_id long, pairing_method string, pairing_confidence double"


def box(i, lot, index, x, y, w=100, h=100):
    return (i, lot, index, None, "unknown", None, 0.9, x, y, w, h, f"p{i}")


@pytest.mark.parametrize(
    "first, second, layout",
    [
        ((0, 0), (200, 0), "left_right"),
        ((200, 0), (0, 0), "left_right"),
        ((0, 0), (0, 200), "top_bottom"),
        ((0, 0), (30, 0), "ambiguous"),  # exactly the threshold
        ((0, 0), (31, 0), "left_right"),
        ((0, 0), (200, 200), "ambiguous"),  # equal distances
    ],
)
def test_layout(frame, first, second, layout):
    rows = frame(DETECTION, box(1, 1, 0, *first), box(2, 1, 1, *second))
    lot = pairing.lot_layouts(rows, ["detection_index"]).first()
    assert lot["layout"] == layout
    if layout == "ambiguous":
        assert lot["obverse_id"] is None
    else:
        assert lot["obverse_id"] == (1 if first < second else 2)


def test_pairing_links_each_detection_once(frame):
    rows = [box(1, 1, 0, 0, 0), box(2, 2, 0, 0, 0), box(3, 2, 1, 300, 0)]
    rows += [box(10 + i, 3, i, 300 * i, 0) for i in range(5)]
    detections = frame(DETECTION, *rows)
    coins = frame(COIN, (7, 99, "manual", 1.0))
    created, links = pairing.pair_unlinked(detections, coins)
    found = {r["detection_id"]: r for r in links.collect()}
    assert len(found) == len(rows) == links.count()
    assert {r["id"] for r in created.collect()} == {8, 9, 10}
    assert (found[2]["side"], found[3]["side"], found[1]["side"]) == ("obverse", "reverse", "unknown")
    assert Counter(found[10 + i]["side"] for i in range(5)) == {"obverse": 1, "reverse": 1, "unknown": 3}
    assert len({found[10 + i]["coin_id"] for i in range(5)}) == 1
    stats = pairing.pairing_statistics(created).first().asDict()
    assert stats == {
        "records_processed": 3, "coins_created": 3, "detections_linked": 8, "pairs_assigned": 1,
        "singles": 1, "multi_detection": 1,
    }


def test_hot_lot(spark, frame):
    """One lot with a third of all detections gives the same links as a small one."""
    rows = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("long").alias("auction_record_id"),
        F.col("id").cast("int").alias("detection_index"),
        F.lit(None).cast("long").alias("coin_id"),
        F.lit("unknown").alias("side"),
        F.lit(None).cast("double").alias("side_confidence"),
        F.lit(0.9).alias("coin_likelihood"),
        (F.col("id") * 200).cast("int").alias("bbox_x"),
        F.lit(0).alias("bbox_y"), F.lit(100).alias("bbox_w"), F.lit(100).alias("bbox_h"),
        F.lit("p").alias("normalized_path"),
    )
    links = pairing.pair_unlinked(rows, frame(COIN, (7, 99, "m", 1.0)))[1]
    of_lot = Counter(r["side"] for r in links.where("auction_record_id = 0").collect())
    assert links.count() == 3000 and of_lot == {"obverse": 1, "reverse": 1, "unknown": 998}


def test_repair_drops_orphans(frame):
    detections = frame(DETECTION, box(1, 1, 0, 0, 0), box(2, 1, 1, 300, 0), box(3, 2, 0, 0, 0)).withColumn(
        "coin_id", F.col("id")
    )
    coins = frame(COIN, (1, 1, "a", 0.0), (2, 1, "a", 0.0), (3, 2, "a", 0.0))
    created, links, table = pairing.repair_legacy_pairs(detections, coins)
    assert created.count() == 1 and links.count() == 2
    assert {r["id"] for r in table.collect()} == {3, 4}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.sampled_from([None, "", "aa", "zz"]), st.sampled_from([None, "", "aa", "mm"]))
def test_pair_hash_is_symmetric(spark, a, b):
    row = spark.createDataFrame([(a, b)], "a string, b string")
    one, two = row.select(dedup.pair_hash(F.col("a"), F.col("b")), dedup.pair_hash(F.col("b"), F.col("a"))).first()
    sides = sorted(x for x in (a, b) if x)
    assert one == two == ":".join(sides)


def test_blank_hashes_are_never_duplicates(frame):
    rows = frame("coin_id long, pair_hash string", (1, ""), (2, ""), (3, None), (4, "h"), (5, "h"))
    got = {r["coin_id"]: r for r in dedup.mark_duplicates(rows).collect()}
    assert [i for i, r in got.items() if r["is_duplicate"]] == [5]
    assert got[5]["duplicate_of_coin_id"] == 4


def test_new_by_hash(frame):
    rows = frame("id long, image_hash string", (1, ""), (2, ""), (3, "a"), (4, "a"), (5, "b"), (6, None))
    target = frame("image_hash string", ("b",), ("",))
    assert {r["id"] for r in dedup.new_by_hash(rows, target, "image_hash", "id").collect()} == {1, 2, 3, 6}


RANGE = "auction_house string, sale_id string, lot_start int, lot_end int, period string"
LOT = "id long, auction_house string, sale_id string, lot_number string"


def test_overlapping_ranges_repeat_lots(frame):
    ranges = frame(RANGE, ("leu", "1", 1, 900, "greek"), ("leu", "1", 500, 3000, "celtic"), ("leu", "1", 9, 3, "bad"))
    lots = frame(LOT, (1, "leu", "1", "600"), (2, "leu", "1", "10"), (3, "leu", "1", "2999"), (4, "leu", "1", "A6"), (5, "LEU", "1", "5"))
    got = sorted((r["id"], r["auction_period"]) for r in export.with_lot_range(lots, ranges).collect() if r["auction_period"])
    assert got == [(1, "celtic"), (1, "greek"), (2, "greek"), (3, "celtic")]
    assert export.with_lot_range(lots, ranges).count() == 6
    first = {r["id"]: r["auction_period"] for r in export.with_lot_range(lots, ranges, first_range_only=True).collect()}
    assert first == {1: "greek", 2: "greek", 3: "celtic", 4: None, 5: None}
    folded = {r["id"]: r["auction_period"] for r in export.with_lot_range(lots, ranges, ignore_case=True).collect()}
    assert folded[5] == "greek"


def test_missing_side_rules(frame):
    coins = frame(
        "coin_id long, obv_path string, rev_path string, unk_path string",
        (1, "o", "r", None), (2, "o", None, "u"), (3, "", "r", None), (4, None, None, "u"), (5, None, None, None),
    )

    def paths(rule):
        return {r["coin_id"]: (r["obv_path"], r["rev_path"]) for r in export.apply_missing_side_rule(coins, rule, "x").collect()}

    assert paths("skip") == {1: ("o", "r")}
    assert paths("duplicate") == {1: ("o", "r"), 2: ("o", "o"), 3: ("r", "r"), 4: ("u", "u")}
    assert paths("placeholder") == {1: ("o", "r"), 2: ("o", "x"), 3: ("x", "r"), 4: ("u", "x")}
    with pytest.raises(ValueError):
        export.apply_missing_side_rule(coins, "placeholder")


def test_best_detection_ties(frame):
    rows = [
        (1, 1, 0, 5, "obverse", None, 0.9, 0, 0, 1, 1, "a"), (2, 1, 1, 5, "obverse", 0.0, 0.9, 0, 0, 1, 1, "b"),
        (3, 1, 2, 5, "reverse", 0.7, 0.9, 0, 0, 1, 1, "c"), (4, 1, 3, 5, "reverse", 0.9, 0.4, 0, 0, 1, 1, "d"),
        (5, 1, 4, 5, "unknown", 0.9, 0.9, 0, 0, 1, 1, ""),
    ]
    best = export.best_detection_per_side(frame(DETECTION, *rows)).first()
    assert (best["obv_detection_id"], best["rev_detection_id"], best["unk_detection_id"]) == (2, 3, None)
    any_path = export.best_detection_per_side(frame(DETECTION, *rows), skip_blank_paths=False).first()
    assert any_path["unk_detection_id"] == 5


def test_box_is_clamped(frame):
    row = frame("x int", (5,)).select(
        box_with_margin(F.lit(5), F.lit(90), F.lit(50), F.lit(20), F.lit(100), F.lit(100)).alias("b")
    ).first()["b"]
    assert tuple(row) == (0, 84, 61, 16)


def test_ranges_of_any_length(spark, frame):
    import random

    rng = random.Random(7)
    ranges = [("h", "s", 1, 10**12, "wide"), ("h", "s", -5, 3, "low"), ("h", "s", 0, (1 << 63) - 1, "all"), ("g", "s", 9, 8, "none")]
    for i in range(60):
        a = rng.choice([rng.randrange(100), rng.randrange(10**6), rng.randrange(10**13)])
        ranges.append(("h", "s", a, a + rng.choice([0, 31, 32, 1000, 10**5, 10**9]), f"r{i}"))
    numbers = sorted({x for _, _, a, b, _ in ranges for x in (a, b, a - 1, b + 1) if x < 1 << 63} | {0, 31, 32, 33, 1023, 1024})
    lots = [(i, "h", "s", str(n)) for i, n in enumerate(numbers)] + [(900, "h", "s", "x"), (901, "h", "s", None), (902, None, "s", "5"), (903, "g", "s", "8"), (904, "h", "s", "5"), (905, "h", "s", "5")]
    left = frame("id long, auction_house string, sale_id string, lot_number string", *lots)
    right = frame("auction_house string, sale_id string, lot_start long, lot_end long, period string", *ranges)
    wanted = []
    for i, h, s, n in lots:
        n = int(n) if n and n.lstrip("-").isdigit() else None
        hits = [p for rh, rs, a, b, p in ranges if n is not None and h == rh and s == rs and a <= n <= b]
        wanted += [(i, p) for p in hits or [None]]
    got = [(r["id"], r["auction_period"]) for r in export.with_lot_range(left, right).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    first = {r["id"]: r["auction_period"] for r in export.with_lot_range(left, right, first_range_only=True).collect()}
    assert len(first) == len(lots) and first[904] == "all" and first[903] is None
    pieces = right.select(F.size(export.range_pieces(F.col("lot_start"), F.col("lot_end"))).alias("n")).agg(F.max("n")).first()[0]
    assert pieces <= 62 * 13
