import numpy as np
import pytest
from pyspark.sql import functions as F

from hoardline.operators import cells, components, dedup, grouping, knn, radius, search
from hoardline.session import cut_lineage


def brute(ids, vectors, k, query_ids=None, decimals=6):
    unit = vectors / (np.linalg.norm(vectors, axis=1, keepdims=True) + 1e-12)
    answer = {}
    for i, q in enumerate(ids):
        if query_ids is not None and q not in query_ids:
            continue
        ranked = sorted((-round(float(s), decimals), int(j)) for j, s in zip(ids, unit @ unit[i]) if j != q)
        answer[int(q)] = [j for _, j in ranked[:k]]
    return answer


def table(spark, ids, vectors):
    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, vectors)]
    return spark.createDataFrame(rows, "id long, embedding array<float>")


def found(df):
    answer = {}
    for r in df.orderBy("query_id", "rank").collect():
        answer.setdefault(r["query_id"], []).append(r["neighbor_id"])
    return answer


@pytest.fixture(scope="module")
def clustered():
    """Tight groups, a third of all rows exact copies of one vector, some copies of others."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(12, 16))
    vectors = centers[rng.integers(0, 12, 600)] + 0.05 * rng.normal(size=(600, 16))
    vectors[::3] = vectors[0]
    vectors[1::30] = vectors[1]
    vectors = vectors.astype(np.float32).astype(np.float64)
    return rng.permutation(10_000)[:600], vectors


@pytest.mark.parametrize("strategy", ["broadcast", "blocks"])
def test_knn_equals_brute_force(spark, clustered, strategy):
    ids, vectors = clustered
    rows = table(spark, ids, vectors)
    got = found(knn.knn_join(rows, rows, 4, strategy=strategy, block_rows=40))
    assert got == brute(ids, vectors, 4)


def test_blocks_without_structure(spark):
    rng = np.random.default_rng(1)
    ids, vectors = np.arange(300), rng.normal(size=(300, 24)).astype(np.float32).astype(np.float64)
    rows = table(spark, ids, vectors)
    got = found(knn.knn_join(rows.where("id < 70"), rows, 7, strategy="blocks", block_rows=32))
    assert got == brute(ids, vectors, 7, set(range(70)))


def test_fewer_rows_than_neighbours(spark):
    rows = table(spark, [1, 2, 3], np.eye(3))
    for strategy in ("broadcast", "blocks"):
        got = found(knn.knn_join(rows, rows, 5, strategy=strategy))
        assert got == {1: [2, 3], 2: [1, 3], 3: [1, 2]}


def test_pruning_drops_far_blocks(spark, clustered, monkeypatch):
    ids, vectors = clustered
    rows = table(spark, ids, vectors)
    seen = []
    original = knn.cut_lineage

    def spy(df, purpose="stage"):
        stored = original(df, purpose)
        if purpose == "knn-bounds":
            seen.append(stored)
        return stored

    monkeypatch.setattr(knn, "cut_lineage", spy)
    knn.knn_join(rows, rows, 3, strategy="blocks", block_rows=40)
    sizes = [len(r["targets"]) for r in seen[0].collect()]
    rings = {(t["c_cell"], t["c_ring"]) for r in seen[0].collect() for t in r["targets"]}
    assert sum(sizes) < 0.7 * len(sizes) * len(rings)


def test_top_k_with_filters_equals_joins(spark, clustered, monkeypatch):
    ids, vectors = clustered
    corpus = table(spark, ids, vectors).withColumn(
        "period", F.when(F.col("id") % 2 == 0, "Roman Imperial").when(F.col("id") % 5 == 0, None).otherwise("greek")
    )
    queries = table(spark, [1, 2, 3], vectors[[0, 7, 9]]).select(
        F.col("id").alias("query_id"), "embedding",
        F.when(F.col("id") == 1, "all").when(F.col("id") == 2, "IMPERIAL").otherwise("greek").alias("wanted"),
    )
    one = sorted(map(tuple, knn.top_k(queries, corpus, 6, filters={"period": "wanted"}).collect()))
    assert len(one) == 18
    periods = {r["id"]: r["period"] for r in corpus.collect()}
    assert {periods[n] for q, _, n, _ in one if q == 2} == {"Roman Imperial"}
    original = knn.collect_small
    first = iter([True])
    monkeypatch.setattr(
        knn, "collect_small", lambda df, v, b=knn.BROADCAST_BYTES: None if next(first, False) else original(df, v, b)
    )
    two = sorted(map(tuple, knn.top_k(queries, corpus, 6, filters={"period": "wanted"}).collect()))
    assert one == two


def test_noise_votes(spark):
    vectors = np.array([[1, 0], [1, 0.01], [1, 0.02], [1, 0.03], [0, 1], [0.01, 1], [1, 0.015], [0.5, 1.0]])
    labels = ["1", "1", "1", "2", "3", "3", "-1", "-1"]
    rows = table(spark, range(8), vectors)
    labelled = rows.join(spark.createDataFrame(list(zip(range(8), labels)), "id long, cluster_id string"), "id")
    got = {r["id"]: (r["cluster_id"], r["assignment_method"]) for r in knn.reassign_noise(labelled, 4).collect()}
    assert got[6] == ("1", "knn_assigned")
    assert got[7] == ("-1", "noise")
    assert got[0] == ("1", "clustered")
    near = {r["id"]: r["assignment_method"] for r in knn.reassign_noise(labelled, 4, max_distance=0.00001).collect()}
    assert near[6] == "noise"


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 200, (150, 2))]
    edges += [(500 + i, 501 + i) for i in range(60)] + [(900, i) for i in range(901, 960)]
    vertices = list(range(200)) + list(range(500, 561)) + list(range(900, 960)) + [1000]
    parent = {v: v for v in vertices}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = components.connected_components(
        spark.createDataFrame([(v,) for v in vertices], "id long"), spark.createDataFrame(edges, "u long, v long")
    ).collect()
    assert {r["id"]: r["component"] for r in got} == {v: root(v) for v in vertices}


def test_density_clusters(spark):
    rng = np.random.default_rng(2)
    centers = np.eye(8)[:3]
    vectors = np.concatenate([c + 0.02 * rng.normal(size=(n, 8)) for c, n in zip(centers, (40, 30, 25))])
    vectors = np.concatenate([vectors, rng.normal(size=(5, 8)) - 3 * centers.sum(axis=0)])
    rows = table(spark, range(100), vectors)
    got = {r["id"]: r for r in grouping.density_clusters(rows, eps=0.2, min_samples=4, min_cluster_size=10).collect()}
    labels = [got[i]["cluster_id"] for i in range(100)]
    assert labels[:40] == [0] * 40 and labels[40:70] == [1] * 30 and labels[70:95] == [2] * 25
    assert labels[95:] == [-1] * 5
    assert all(0 < got[i]["cluster_confidence"] <= 1 for i in range(95))
    shuffled = {r["id"]: r["cluster_id"] for r in grouping.density_clusters(rows.orderBy(F.desc("id")).repartition(3), eps=0.2, min_samples=4, min_cluster_size=10, tile_rows=16).collect()}
    assert shuffled == {i: got[i]["cluster_id"] for i in range(100)}


def flat_cut(ids, vectors, eps, k, least):
    """Clusters as sets of ids, with core distances, from the full distance matrix."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    d = np.sqrt(np.maximum(0, 2 - 2 * np.round(unit @ unit.T, 6)))
    np.fill_diagonal(d, 0)
    core = np.array([np.sort(np.delete(d[i], i))[k - 1] for i in range(len(d))])
    dense = core <= eps
    label = np.arange(len(d))
    while True:
        linked = (d <= eps) & dense[:, None] & dense[None, :]
        new = np.array([label[linked[i]].min() if dense[i] else label[i] for i in range(len(d))])
        if (new == label).all():
            break
        label = new
    groups = {frozenset(np.asarray(ids)[(label == c) & dense].tolist()) for c in set(label[dense])}
    return {g for g in groups if len(g) >= least}, dict(zip(ids, core, strict=True))


def clusters_of(rows):
    found = {}
    for r in rows:
        if r["cluster_id"] >= 0:
            found.setdefault(r["cluster_id"], set()).add(r["id"])
    return {frozenset(g) for g in found.values()}


@pytest.mark.parametrize("tile_rows", [7, 1024])
def test_two_dense_clumps_within_reach_are_one_cluster(spark, tile_rows):
    angle = np.array([0.001 * i for i in range(6)] + [0.2 + 0.001 * i for i in range(6)])
    rows = table(spark, range(12), np.stack([np.cos(angle), np.sin(angle)], axis=1))
    got = grouping.density_clusters(rows, eps=0.5, min_samples=2, min_cluster_size=3, tile_rows=tile_rows).collect()
    assert [r["cluster_id"] for r in got] == [0] * 12


def test_half_of_the_rows_are_one_vector(spark):
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(120, 4))
    vectors[:60] = vectors[0]
    vectors[60:75] = vectors[60] + 0.1 * rng.normal(size=(15, 4))
    ids = [int(i) for i in rng.permutation(1000)[:120]]
    rows = table(spark, ids, vectors).unionByName(spark.createDataFrame([(5000, None)], "id long, embedding array<double>"))
    for eps, k, least, tile_rows in ((0.3, 3, 4, 5), (1e-4, 4, 3, 16)):
        got = grouping.density_clusters(rows, eps=eps, min_samples=k, min_cluster_size=least, tile_rows=tile_rows).collect()
        wanted, core = flat_cut(ids, vectors, eps, k, least)
        assert clusters_of(got) == wanted and len(got) == 121
        best = {g: min(core[i] for i in g) for g in wanted}
        for r in got:
            mine = [g for g in wanted if r["id"] in g]
            expected = 0.0 if not mine else best[mine[0]] / core[r["id"]] if core[r["id"]] > 0 else 1.0
            assert abs(r["cluster_confidence"] - expected) < 1e-9


def test_probed_cells(spark):
    """Clustered vectors of 512 dimensions: few cells give nearly all neighbours, all cells give all."""
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(60, 512))
    vectors = centers[rng.integers(0, 60, 4000)] + 0.7 * rng.normal(size=(4000, 512))
    vectors[100:160] = vectors[100]
    rows = cut_lineage(table(spark, range(4000), vectors).select(F.col("id").alias("_id"), F.col("embedding").alias("_v")), "test")
    wanted = brute(np.arange(4000), vectors, 10)
    compared = spark.sparkContext.accumulator(0)
    found = {}
    for r in cells.probed_neighbours(rows, rows, 10, probes=4, compared=compared).collect():
        found.setdefault(r["query_id"], set()).add(r["neighbor_id"])
    recall = np.mean([len(found[i] & set(w)) / 10 for i, w in wanted.items()])
    assert recall >= 0.95 and compared.value <= 0.15 * 4000**2
    few = rows.where("_id < 300")
    exact = {}
    for r in cells.probed_neighbours(few, few, 10, probes=1000, block_rows=16).orderBy("query_id", "rank").collect():
        exact.setdefault(r["query_id"], []).append(r["neighbor_id"])
    assert exact == brute(np.arange(300), vectors[:300], 10)
    assert cells.probed_neighbours(few.limit(0), few.limit(0), 3).count() == 0


def test_boost_reports_but_keeps_order(spark):
    results = spark.createDataFrame(
        [(1, 1, 10, 0.9, "greek"), (1, 2, 11, 0.89, "Celtic "), (1, 3, 12, 0.5, "other")],
        "query_id long, rank long, neighbor_id long, similarity double, period string",
    )
    queries = spark.createDataFrame([(1, [0.1, 0.9])], "query_id long, probs array<double>")
    rows = {r["neighbor_id"]: r for r in search.with_period_boost(results, queries, ["greek", "celtic"]).collect()}
    weight = 0.04 + 0.10 * 0.4 / 0.5
    assert abs(rows[11]["final_score"] - (0.89 + weight * 0.4)) < 1e-12
    assert rows[12]["period_boost"] == 0.0 and rows[10]["rank"] == 1 and rows[10]["query_period"] == "celtic"
    again = {r["neighbor_id"]: r["rank"] for r in search.with_period_boost(results, queries, ["greek", "celtic"], rerank=True).collect()}
    assert again == {11: 1, 10: 2, 12: 3}


def test_perceptual_hash(spark):
    rng = np.random.default_rng(9)
    images = rng.uniform(0, 255, (3, 32, 32)).astype(np.float32)
    rows = spark.createDataFrame([(i, [float(x) for x in im.ravel()]) for i, im in enumerate(images)], "id long, pixels array<float>")
    got = {r["id"]: r["h"] for r in rows.select("id", dedup.perceptual_hash(F.col("pixels")).alias("h")).collect()}
    for i, image in enumerate(images):
        low = np.zeros((8, 8))
        for u in range(8):
            for w in range(8):
                cu = np.sqrt((1 if u == 0 else 2) / 32) * np.cos(np.pi * (2 * np.arange(32) + 1) * u / 64)
                cw = np.sqrt((1 if w == 0 else 2) / 32) * np.cos(np.pi * (2 * np.arange(32) + 1) * w / 64)
                low[u, w] = cu @ image.astype(np.float64) @ cw
        bits = "".join("1" if x > np.median(low) else "0" for x in low.ravel())
        assert got[i] == format(int(bits, 2), "016x")


def test_search_opens_only_wanted_partitions(spark, tmp_path):
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(60, 8))
    periods = ["greek", "greek imperial", "roman", None]
    corpus = spark.createDataFrame([(i, [float(x) for x in v], periods[i % 4]) for i, v in enumerate(vectors)], "id long, embedding array<double>, period string")
    corpus.write.partitionBy("period").parquet(f"file://{tmp_path}/store")
    store = spark.read.parquet(f"file://{tmp_path}/store")
    asked = spark.createDataFrame([(1, [float(x) for x in vectors[0]], "greek"), (2, [float(x) for x in vectors[2]], "roman"), (3, [1.0] * 8, None), (4, [1.0] * 8, "celtic")], "query_id long, embedding array<double>, period string")
    found = {}
    for r in search.search_partitions(asked, store, 50).collect():
        found.setdefault(r["query_id"], set()).add(r["neighbor_id"])
    assert found == {1: set(range(0, 60, 4)), 2: set(range(2, 60, 4))}
    plan = search.wanted_partitions(asked, store, "period", "period")._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_kmeans_confidence_plane_and_variance(spark):
    rng = np.random.default_rng(5)
    spots = rng.normal(size=(3, 6)) * 8
    x = np.concatenate([s + rng.normal(size=(40, 6)) for s in spots])
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, embedding array<double>").repartition(3)
    found = {r.id: r for r in grouping.kmeans_clusters(rows, 3).collect()}
    label = np.array([found[i].cluster_id for i in range(len(x))])
    centres = np.array([x[label == c].mean(0) for c in range(3)])
    far = np.sort(np.sqrt(((x[:, None] - centres) ** 2).sum(2)), 1)
    assert np.allclose([found[i].cluster_confidence for i in range(len(x))], 1 - far[:, 0] / far[:, 1])
    plane = {r.id: (r.x, r.y) for r in grouping.with_plane(rows).collect()}
    _, _, axes = np.linalg.svd(x - x.mean(0), full_matrices=False)
    axes = [a * np.sign(a[np.abs(a).argmax()]) for a in axes[:2]]
    assert np.allclose([plane[i] for i in range(len(x))], x @ np.array(axes).T)
    parts = grouping.variance_parts(rows, grouping.kmeans_clusters(rows, 3)).first()
    within = sum(((x[label == c] - centres[c]) ** 2).sum() for c in range(3))
    assert (parts.rows, parts.clusters) == (120, 3)
    assert np.allclose([parts.within, parts.within + parts.between], [within, ((x - x.mean(0)) ** 2).sum()])


def test_place_by_centres(spark):
    place = grouping.nearest_centre(np.array([[0.0, 0.0], [2.0, 0.0], [0.0, 0.0]]))
    rows = spark.createDataFrame([([0.0, 0.0],), ([2.0, 0.0],), ([1.5, 0.0],)], "v array<double>")
    alone = rows.select(grouping.nearest_centre(np.zeros((1, 2)))("v").alias("p")).select("p.*")
    assert {tuple(r) for r in alone.collect()} == {(0, 1.0)}
    got = [(r.p.cluster_id, r.p.cluster_confidence) for r in rows.select(place("v").alias("p")).collect()]
    assert [g[0] for g in got] == [0, 1, 1] and np.allclose([g[1] for g in got], [0.0, 1.0, 2 / 3])


@pytest.mark.parametrize("probed", [False, True])
def test_rows_are_sent_by_tiles_not_by_blocks(spark, monkeypatch, probed):
    """F1, F2, F8: a row goes to each tile of the other side once, however small the blocks are; results stay exact."""
    rng = np.random.default_rng(4)
    ids, vectors = np.arange(240), rng.normal(size=(240, 16)).astype(np.float32).astype(np.float64)
    vectors[200:] = vectors[:40]
    sent = []
    original = knn.over_tiles

    def spy(queries, corpus, *rest):
        sent.append((queries.select("tile", "slices").collect(), corpus.select("tile").distinct().count()))
        return original(queries, corpus, *rest)

    monkeypatch.setattr(knn, "over_tiles", spy)
    monkeypatch.setattr(knn, "TILE_BYTES", 100 * 8 * 16)
    monkeypatch.setattr(knn, "QUERY_TILES", 4)
    rows = table(spark, ids, vectors)
    if probed:
        named = rows.select(F.col("id").alias("_id"), F.col("embedding").alias("_v"))
        got = found(cells.probed_neighbours(named, named, 5, probes=1 << 20, block_rows=8))
    else:
        got = found(knn.knn_join(rows, rows, 5, strategy="blocks", block_rows=8))
    assert got == brute(ids, vectors, 5)
    asked, tiles = sent[0]
    assert len(asked) > 20 and 1 < tiles <= 4
    assert sum(len(r["slices"]) for r in asked) <= len(asked) * tiles


def test_density_tiles_do_not_multiply_with_the_table(spark, monkeypatch):
    """tiles grow with the table, and are compared in strips; the result is that of small tiles."""
    assert [radius.rows_of_tile(n, 64) for n in (10_000, 100_000, 600_000, 6_000_000)] == [1024, 4167, 25_000, 32_768]
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(150, 4))
    rows = table(spark, range(150), vectors)
    monkeypatch.setattr(radius, "SCORES_AT_ONCE", 150 * 20)
    got = grouping.density_clusters(rows, eps=0.3, min_samples=3, min_cluster_size=4).collect()
    wanted, _ = flat_cut(range(150), vectors, 0.3, 3, 4)
    assert clusters_of(got) == wanted


def test_corpus_copies_in_workers_are_bounded(spark, monkeypatch):
    """a corpus of more than 16 MB in doubles goes to tiles, a smaller one to every worker."""
    monkeypatch.setattr(knn, "_against_broadcast", lambda *a: "sent whole")
    monkeypatch.setattr(knn, "_knn_blocks", lambda *a: "in tiles")
    rows = spark.range(4300).select("id", F.array_repeat(F.col("id").cast("float"), 512).alias("embedding"))
    assert knn.knn_join(rows, rows, 5) == "in tiles"
    few = rows.where("id < 4000")
    assert knn.knn_join(few, few, 5) == "sent whole"
