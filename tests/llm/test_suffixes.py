import collections
import hashlib
import random

import pytest

from hoardline.llm import suffixes as sx


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = collections.Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc, _), d in zip(rows, data):
        gone = [False] * len(d)
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((doc, len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(n))


def rows(seed):
    rng = random.Random(seed)
    passages = [words(rng, rng.randint(3, 40)) for _ in range(6)]
    made = []
    for i in range(120):
        parts = [words(rng, rng.randint(0, 30)) + rng.choice(passages) * rng.randint(0, 2) for _ in range(rng.randint(0, 4))]
        made.append((i if i % 11 else None, "".join(parts)))
    base = words(rng, 60)
    made += [(1000 + i, base[: 30 * i] + "X" + base[30 * i + 1 :]) for i in range(8)]
    made += [(2000, None), (2001, ""), (2002, "a" * 5000), (2003, "ab" * 700), (2004, base), (2004, base), (2005, "日本" * 40)]
    return made


@pytest.mark.parametrize(("seed", "length", "variants"), [(1, 40, 50_000), (2, 25, 3), (3, 1, 50_000), (4, 90, 1)])
def test_against_counting_windows(spark, monkeypatch, seed, length, variants):
    monkeypatch.setattr(sx, "PIECE", 700)
    data = rows(seed)
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in data], "doc_id long, text string, row int, key string").repartition(4)
    got = sx.digest(sx.without_repeats(df, length, variants, 4_000)).collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == brute(data, length)


def check_array(s, alphabet):
    sa = sx.suffix_array(s, alphabet)
    assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
    before, lengths = sx.common_prefixes(s, sa, 10)
    for a, b in zip(sa, sa[1:]):
        same = next(k for k in range(len(s)) if s[a + k] != s[b + k])
        assert before[b] == a and lengths[b] == min(same, 10)


@pytest.mark.parametrize("passes", [0, 1 << 40])  # always by buckets, always by steps
def test_suffix_arrays(monkeypatch, passes):
    monkeypatch.setattr(sx, "_bucket_passes", lambda *_: passes)
    rng = random.Random(0)
    for _ in range(400):
        check_array([rng.randint(1, rng.choice([1, 2, 5, 200])) for _ in range(rng.randint(0, 60))] + [0], 201)


def test_suffix_arrays_of_longer_texts():
    rng = random.Random(1)
    passage = [rng.randint(1, 4) for _ in range(300)]
    check_array([x for _ in range(6) for x in passage + [rng.randint(1, 4)]] * 2 + [0], 5)
    check_array([1] * 900 + [2] * 700 + [1] * 900 + [0], 3)
    check_array([x for i in range(400) for x in (2, 1 + i % 3, 3)] + [0], 4)


def test_empty_table(spark):
    assert sx.without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
