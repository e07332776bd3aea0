import collections
import random

import pytest

from hoardline.llm import forest


def sets_of(text, words):
    w = "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ")
    w = [x for x in w if x]
    return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set()


def brute(rows, threshold, words):
    sets = [sets_of(t, words) for _, t in rows]
    near = collections.defaultdict(set)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold:
                near[i].add(j)
                near[j].add(i)
    out = []
    for i, (doc, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out.append((doc, min((rows[j][0] for j in seen if rows[j][0] is not None), default=None), len(near[i])))
    return sorted(out, key=str)


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3_000)]
    rows, base = [], []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.choice([3, 6, 30, 120, 300]))
        for _ in range(rng.choice([1, 1, 2, 6])):
            copy = [rng.choice(vocabulary) if rng.random() < rng.choice([0, 0.005, 0.02]) else w for w in words]
            rows.append((len(rows) + 10, rng.choice([" ", "\n", " \t"]).join(copy)))
        base = base or words
    hot = rng.choices(vocabulary, k=200)
    for i in range(40):  # a group of near copies, all different
        copy = list(hot)
        copy[rng.randrange(200)] = f"x{i}"
        rows.append((1_000 + i, " ".join(copy)))
    rows += [(1, None), (2, ""), (3, " \n"), (None, " ".join(hot)), (4, "one two"), (5, "one two"), (5, "one two"), (None, "only null"), (None, "only null"), (6, "z " * 40_000), (7, "z " * 39_990)]
    return rows


@pytest.mark.parametrize(("seed", "threshold", "words", "tile"), [(1, 0.8, 5, 1_024), (2, 0.5, 2, 1_024), (3, 0.8, 5, 7)])
def test_against_all_pairs(spark, monkeypatch, seed, threshold, words, tile):
    if tile < 100:
        monkeypatch.setattr(forest, "GROUP_ROWS", 5)
        monkeypatch.setattr(forest, "BUCKET_ROWS", 50)
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "c", 0) for i, t in rows], "doc_id long, text string, class_id string, row int").repartition(4)
    got = forest.join(df, threshold, words=words, tile=tile).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute(rows, threshold, words)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got if r.class_id is not None)
    assert sum(r.kept for r in got if r.class_id is None) == 2  # equal rows


def test_depths():
    wanted = forest.depths(0.8, 0.999)
    assert wanted == [12, 9, 6] and forest.recall(6, 0.8) >= 0.999 > forest.recall(9, 0.8)


def test_empty_table(spark):
    assert forest.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
