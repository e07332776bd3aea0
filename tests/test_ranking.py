"""Ranks of hot groups must equal those of a plain window."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from hoardline.operators import export, ranking, splits


def hot(spark, n=3000):
    """A third of the rows in one class, the others spread over many."""
    label = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 11))
    return spark.range(n).withColumn("period", label)


def test_spread_rank_equals_window(spark):
    rows = hot(spark)
    got = ranking.seeded_row_number(rows, "r", "id", by=["period"], group_size="n")
    window = Window.partitionBy("period").orderBy(ranking.seeded_order("id"), "id")
    wanted = rows.withColumn("r", F.row_number().over(window)).withColumn(
        "n", F.count("*").over(Window.partitionBy("period"))
    )
    columns = ["id", "period", "r", "n"]
    assert sorted(map(tuple, got.select(columns).collect())) == sorted(
        map(tuple, wanted.select(columns).collect())
    )


def test_null_groups_are_ranked(frame):
    rows = frame("id long, g string", (1, None), (2, None), (3, "a"))
    got = ranking.seeded_row_number(rows, "r", "id", by=["g"]).collect()
    assert Counter((r["g"], r["r"]) for r in got) == Counter([(None, 1), (None, 2), ("a", 1)])


def test_ids_are_dense_and_ordered(spark):
    rows = spark.range(1000).select((F.col("id") * 977 - 400_000).alias("id"))
    got = ranking.id_row_number(rows, "r", "id").orderBy("id").collect()
    assert [r["r"] for r in got] == list(range(1, 1001))


def test_first_rows_limits_groups_before_the_shuffle(spark):
    plan = ranking.first_rows(hot(spark), 2, by=["period"], order=[F.col("id")])
    assert "WindowGroupLimit" in plan._jdf.queryExecution().executedPlan().toString()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(["a", "b", "c", "", None]), min_size=1, max_size=60))
def test_split_is_complete_and_exact(spark, labels):
    rows = spark.createDataFrame(list(enumerate(labels)), "id long, period string")
    got = export.stratified_split(rows, F.col("period"), "id").collect()
    assert sorted(r["id"] for r in got) == list(range(len(labels)))
    sizes = Counter(x or "unknown" for x in labels)
    found = defaultdict(Counter)
    for r in got:
        found[r["period"] or "unknown"][r["split"]] += 1
    for name, n in sizes.items():
        train, val = int(n * 0.7), int(n * 0.15)
        assert found[name]["train"] == train and found[name]["val"] == val
        assert found[name]["test"] == n - train - val


def test_identities_never_straddle(spark):
    rows = hot(spark, 600).withColumn("coin", F.col("id") % 40)
    got = splits.split_by_identity(rows, "period", "coin").collect()
    assert len(got) == 600
    sides = defaultdict(set)
    for r in got:
        sides[(r["period"], r["coin"])].add(r["split"])
    assert all(len(s) == 1 for s in sides.values())


def test_single_row_class_stays_in_training(frame):
    rows = frame("id long, period string", (1, "only"), (2, "two"), (3, "two"))
    got = {r["id"]: r["split"] for r in splits.split_by_class(rows, "period", "id").collect()}
    assert got[1] == "train" and sorted([got[2], got[3]]) == ["train", "val"]


def test_balanced_sample_beyond_the_group_limit(spark):
    rows = hot(spark, 6000)
    small = splits.balanced_sample(rows, "period", "id", 50).groupBy("period").count().collect()
    large = splits.balanced_sample(rows, "period", "id", 1500).groupBy("period").count().collect()
    assert {r["count"] for r in small} == {50}
    assert {r["period"]: r["count"] for r in large}["hot"] == 1500


def test_class_weights(frame):
    rows = [(i, "a") for i in range(30)] + [(99, "b")]
    got = {r["period"]: r["weight"] for r in splits.class_weights(frame("id long, period string", *rows), "period").collect()}
    assert got["b"] == 10.0 and abs(got["a"] - 31 / 60) < 1e-12


def test_sparse_keys_are_ranked_without_one_window(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("id"))
    ranked = ranking.id_row_number(rows, "r", "id")
    assert [r["r"] for r in ranked.orderBy("id").collect()] == list(range(1, 5001))
    plan = ranked._jdf.queryExecution().toString()
    assert "windowspecdefinition(id" not in plan.split("Physical Plan")[1] and "_part" in plan
    assert ranking.id_row_number(rows.limit(0), "r", "id").count() == 0


def test_label_indexes(spark):
    from hoardline.operators import export, splits

    rows = spark.createDataFrame([("b", "x"), ("a", "x"), ("b", None), ("", "unknown"), ("c", "w")], "p string, d string")
    assert sorted(map(tuple, splits.label_index(rows, "p").collect())) == [("a", 0), ("b", 1), ("c", 2)]
    got = sorted(map(tuple, export.label_mapping(rows, ["p", "d"]).collect()))
    assert got == [("d", "w", 0), ("d", "x", 1), ("p", "a", 0), ("p", "b", 1), ("p", "c", 2)]


def test_split_of_sizes_whose_share_is_whole(spark):
    """0.7 of 90, 170 or 180 rows is a whole number that doubles fall short of."""
    for size in (90, 170, 180):
        rows = spark.range(size).withColumn("period", F.lit("greek"))
        counts = {r["split"]: r["count"] for r in export.stratified_split(rows, F.col("period"), "id").groupBy("split").count().collect()}
        assert counts["train"] == size * 7 // 10 and counts["val"] == size * 15 // 100
