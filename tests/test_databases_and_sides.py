"""Database tables read in key ranges; searches by the sides of a picture."""

import uuid

import pytest
from pyspark.sql import functions as F

from hoardline.operators import search
from hoardline.sources import tables

DRIVER = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture
def database(spark):
    spark.sparkContext._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")
    return f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"


def _written(frame, url, *rows):
    columns = frame("id long, site string, price int", *rows)
    columns.coalesce(1).write.mode("append").options(**DRIVER).option("createTableColumnTypes", "site VARCHAR(32)").jdbc(url, "lots")


def test_clustered_keys_make_even_ranges(spark, frame, database):
    dense = [(10**12 + i, f"s{i % 3}", i) for i in range(900)]
    sparse = [(i * 10**9, "far", i) for i in range(1, 101)]
    missing = [(None, "none", 0), (None, "none", 1)]
    _written(frame, database, *dense, *sparse, *missing)
    ranges = tables.key_ranges(spark, database, "lots", "id", 100, DRIVER)
    assert sum(n for _, _, n in ranges) == 1000 and max(n for _, _, n in ranges) <= 100 and len(ranges) <= 20
    assert all(high <= low for (_, high, _), (low, _, _) in zip(ranges, ranges[1:]))
    read = tables.read_jdbc(spark, database, "lots", rows=100, options=DRIVER)
    assert read.rdd.getNumPartitions() == len(ranges)
    assert sorted(map(repr, read.collect())) == sorted(map(repr, frame("id long, site string, price int", *dense, *sparse, *missing).collect()))


def test_filters_and_columns_reach_the_database(spark, frame, database):
    _written(frame, database, *[(i, f"s{i % 3}", i) for i in range(300)])
    read = tables.read_jdbc(spark, database, "lots", rows=50, options=DRIVER).where((F.col("site") == "s1") & (F.col("price") > 200)).select("id")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(site,s1)" in plan and "GreaterThan(price,200)" in plan
    assert sorted(r.id for r in read.collect()) == [i for i in range(201, 300) if i % 3 == 1]


def test_empty_tables_negative_and_repeated_keys(spark, frame, database):
    _written(frame, database)
    assert tables.key_ranges(spark, database, "lots", "id", 10, DRIVER) == []
    assert tables.read_jdbc(spark, database, "lots", options=DRIVER).count() == 0
    _written(frame, database, *[(7, "same", i) for i in range(40)], *[(-i, "below", i) for i in range(1, 30)])
    ranges = tables.key_ranges(spark, database, "lots", "id", 10, DRIVER)
    assert sum(n for _, _, n in ranges) == 69 and (7, 8, 40) in ranges  # one key is never cut
    assert tables.read_jdbc(spark, database, "lots", rows=10, options=DRIVER).count() == 69


SIDES = "image_id long, side string, embedding array<double>"


def test_split_pictures_answer_by_side(frame):
    asked = frame(
        SIDES,
        (1, "obverse", [1.0, 0.0]), (1, "reverse", [0.0, 1.0]), (1, None, [1.0, 1.0]),  # split: the whole is not asked
        (2, "obverse", [1.0, 0.0]), (2, "unknown", [0.0, 1.0]),  # one side only: asked as a whole
        (3, "obverse", [1.0, 0.0]), (3, "obverse", [0.5, 0.0]), (3, "reverse", [0.0, 1.0]),  # two of a side, no whole: nothing
        (4, "obverse", None), (None, "obverse", [1.0, 0.0]),
    )
    corpus = frame("id long, side string, embedding array<double>", (10, "obverse", [0.9, 0.1]), (11, "reverse", [1.0, 0.0]), (12, "reverse", [0.2, 0.9]))
    found = search.search_sides(asked, corpus, 1).orderBy("image_id", "side").collect()
    assert [tuple(r)[:5] for r in found] == [(1, "split", "obverse", 1, 11), (1, "split", "reverse", 1, 12), (2, "single", None, 1, 12)]
    same = search.search_sides(asked, corpus, 1, same_side=True).orderBy("image_id", "side").collect()
    assert [tuple(r)[:5] for r in same] == [(1, "split", "obverse", 1, 10), (1, "split", "reverse", 1, 12), (2, "single", None, 1, 12)]


def test_answers_of_a_picture(frame):
    asked = frame(SIDES, (-5, "obverse", [1.0, 0.0]), (-5, "reverse", [0.0, 1.0]))
    corpus = frame("id long, embedding array<double>", (1, [1.0, 0.0]), (2, [0.0, 1.0]))
    row = search.side_responses(search.search_sides(asked, corpus, 2)).first()
    assert (row.image_id, row.split_status) == (-5, "split")
    assert [(c.side, [(h.rank, h.neighbor_id) for h in c.results]) for c in row.coins] == [("obverse", [(1, 1), (2, 2)]), ("reverse", [(1, 2), (2, 1)])]


def test_no_pictures(frame):
    corpus = frame("id long, side string, embedding array<double>", (1, "obverse", [1.0, 0.0]))
    assert search.search_sides(frame(SIDES), corpus, 2).count() == 0
