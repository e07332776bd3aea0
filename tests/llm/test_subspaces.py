import numpy as np
import pytest

from hoardline.llm import subspaces


def brute(rows, threshold):
    fine = [(k, i, np.array(v, float)) for k, (i, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, near = [0] * len(rows), {k: set() for k in range(len(rows))}
    for a, (k, _, x) in enumerate(fine):
        for m, _, y in fine[:a]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[k] += 1
                links[m] += 1
                near[k].add(m)
                near[m].add(k)
    out = []
    for k, (i, _) in enumerate(rows):
        seen, todo = {k}, [k]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        c = min((rows[m][0] for m in seen if rows[m][0] is not None), default=None)
        out.append((i, links[k], c, i is not None and i == c))
    return sorted(out, key=str)


def clumps(n, size, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((8, size))
    rows = []
    for i in range(n):
        noise = rng.standard_normal(size) * rng.choice([0.05, 0.2, 0.33])
        v = centres[rng.integers(8)] + noise if i % 2 else rng.standard_normal(size)
        rows.append((i + 10, [float(np.float32(x)) for x in v * rng.choice([1.0, 3.0])]))
    return rows


@pytest.mark.parametrize(("size", "threshold", "cell_rows"), [(16, 0.95, 16_384), (16, 0.9, 40), (3, 0.99, 16_384), (1, 0.95, 16_384)])
def test_against_all_pairs(spark, size, threshold, cell_rows):
    rows = clumps(300, size)
    rows += [(1, rows[0][1]), (2, rows[0][1]), (2, rows[4][1]), (3, None), (4, [0.0] * size), (5, [float("nan")] * size), (6, [None] * size), (7, []), (None, rows[0][1]), (None, None), (8, [1.0] * (size + 1)), (9, [2.0] * (size + 1))]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, component_id string").repartition(4)
    got = subspaces.linked(df, threshold, cell_rows=cell_rows).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == brute(rows, threshold)


def test_a_pair_at_a_blocks_edge_counts_once():
    """In the first block the squared distance is a millionth above its part: the second block alone has the pair."""
    size, threshold = 4, 0.95
    part = (2 - 2 * threshold) / 2
    a = np.array([0.5, 0.5, 0.5, 0.5])
    turn, goal = np.eye(size), part + 1e-6
    low, high = 0.0, 1.0  # the angle in the first two coordinates that gives the distance
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if 2 * 0.5 * (1 - np.cos(mid)) < goal else (low, mid)
    b = np.array([*(np.sqrt(0.5) * np.array([np.cos(np.pi / 4 + low), np.sin(np.pi / 4 + low)])), 0.5, 0.5])
    x, ones, zeros = np.stack([a, b]), np.ones(2, np.int64), np.zeros(2, np.int64)
    edges = np.array([0, 2, 4])
    links = sum(subspaces._tile_links(block, True, zeros, 0, ones.astype(bool), x, ones, turn, edges, threshold)[0] for block in range(2))
    assert links.tolist() == [1, 1]


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert subspaces.linked(empty).count() == 0
    only = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in subspaces.linked(only).collect()) == [(1, 0, 1, True), (2, 0, 2, True)]
