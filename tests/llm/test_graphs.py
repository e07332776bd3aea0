import numpy as np
import pytest

from hoardline.llm import graphs


def brute(rows, queries, k):
    fine = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, x in {i: v for i, v in fine if i in queries}.items():
        scored = sorted((-(x @ y / np.sqrt((x @ x) * (y @ y))), i) for i, y in fine if i != q and len(y) == len(x))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


def ask(spark, rows, queries, k=5, settings=None):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string").repartition(4)
    return graphs.nearest(df, df.where(df.vec_id.isin(queries)), k, settings).collect()


def same(got, wanted):
    got = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in got)
    assert got == sorted((q, r, i, round(s, 9)) for q, r, i, s in wanted)


def test_small_table_is_exact(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.standard_normal(8)]) for i in range(1, 40)]
    rows += [(100 + i, rows[0][1]) for i in range(12)] + [(200, [2 * x for x in rows[0][1]])]
    rows += [(300, None), (301, [0.0] * 8), (302, [float("inf")] * 8), (303, [None] * 8), (None, rows[0][1]), (304, []), (305, [1.0]), (306, [2.0])]
    queries = [1, 2, 103, 200, 300, 301, 305]
    same(ask(spark, rows, queries), brute(rows, queries, 5))


@pytest.mark.parametrize("rows", [[], [(50, [1.0, 2.0])], [(50, None)], [(50, [1.0, 2.0]), (51, [2.0, 1.0])]])
def test_few_candidates(spark, rows):
    same(ask(spark, rows, [50]), brute(rows, [50], 5))


def test_recall_over_shards(spark):
    """Vectors of the given table: recall of the five nearest against brute force."""
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    queries = [i for i, _ in rows if i % 10 == 0]
    settings = graphs.Settings(shard_rows=600)
    got = graphs.nearest(table, table.where("vec_id % 10 = 0"), 5, settings).collect()
    wanted = {(q, i) for q, _, i, _ in brute(rows, queries, 5)}
    assert len(got) == len(wanted) and len({(r.query_id, r.vec_id) for r in got} & wanted) >= 0.95 * len(wanted)


def test_clumps_are_reached():
    """Tight clumps far from one another: every member of a clump finds its clump."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 32))
    x = graphs.unit_rows(np.repeat(centres, 40, 0) + 0.01 * rng.standard_normal((1200, 32)))
    graph = graphs.Graph(x, graphs.Settings())
    found, near = graph.search(x, graph.entries, 64)
    assert (near[:, 0] > 0.999).mean() > 0.99
    clump = np.arange(1200) // 40
    assert np.mean([(clump[f[:6]] == c).all() for f, c in zip(found, clump)]) > 0.97
