import hashlib
import re

import pytest

from hoardline.llm import mixing


def brute(rows, repeats=3, seed="mix"):
    words = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    size = {s: sum(w for w, r in zip(words, rows) if r[2] == s) for s in sources}
    total = sum(size.values())
    target, capped = {}, set()
    while True:
        free = [s for s in sources if s not in capped]
        rest = total - sum(repeats * size[s] for s in capped)
        target = {s: repeats * size[s] if s in capped else rest * weight[s] / sum(weight[f] for f in free) for s in sources}
        over = [s for s in free if target[s] >= repeats * size[s]]
        if not over or total == 0:
            break
        capped |= set(over)
    entries = []
    for s in sources:
        queue = sorted((hashlib.md5(f"{seed}|{'null' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest(), words[i], i) for i in range(len(rows)) if rows[i][2] == s)
        done = 0
        for p in range(repeats):
            for key, n, i in queue:
                done += n
                if n:
                    entries.append((done / weight[s], key, n, p, i))
    taken, used = [0] * len(rows), 0
    for _, _, n, _, i in sorted(entries):
        used += n
        if used > total:
            break
        taken[i] += n
    return [(r[0], w, size[r[2]], target[r[2]], t) for r, w, t in zip(rows, words, taken)]


def table(n=400):
    rows = [(i, " ".join("w" * (1 + (i * j) % 5) for j in range(i * 7 % 50)), f"s{i % 5}" if i % 3 else "hot") for i in range(n)]
    return rows + [(9001, None, "s1"), (9002, "", None), (9003, " a\tb\x0bc\nd ", None), (None, "one two", "s2"), (5, rows[5][1], rows[5][2]), (9004, "x" * 300_000 + " y", "s4"), (9005, "é b c", "é")]


def got(df):
    return sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=str)


def test_against_a_queue(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_SLICE", 50)
    rows = table()
    df = spark.createDataFrame([(i, t, s, "x", 1) for i, t, s in rows], "doc_id long, text string, source string, target string, size int").repartition(5)
    wanted = sorted(((i, w, z, round(t, 6), k) for i, w, z, t, k in brute(rows)), key=str)
    assert got(mixing.mix(df)) == wanted
    by = {}
    for r in mixing.mix(df).collect():
        assert r.taken <= 3 * r.size
        total = by.setdefault(r.source, [0, r.target])
        total[0] += r.taken
    assert all(abs(t - target) <= 60 or target > 3e5 for t, target in by.values())


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a b", "s"), (1, "a b", "s")]])
def test_small_tables(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert got(mixing.mix(df)) == sorted(((i, w, z, round(t, 6), k) for i, w, z, t, k in brute(rows)), key=str)
