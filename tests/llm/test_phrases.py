import random
import re
from collections import Counter

import numpy as np
import pytest

from hoardline.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in range(1, 5):
                f.setdefault(lang, Counter()).update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        hidden = set()
        for q, b in cand.items():
            for size in range(2, len(q)):
                for i in range(len(q) - size + 1):
                    p = q[i : i + size]
                    if 100 * b >= 80 * c[p]:
                        hidden.add(p)
        best = []
        for p, a in cand.items():
            if p not in hidden:
                s, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
                best.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        best.sort()
        out += [(lang, i, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(best[:top], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def table(seed=1, n=400):
    rng = random.Random(seed)
    words = ["the", "Of", "new", "york", "city", "São", "paulo", "x", "É", "co-op", "日本"] + [f"w{i}" for i in range(40)]
    rows = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(0, 60)):
            text.append(rng.choice(["New York City", "new york", "of the", "of  the", "of\tthe"]) if rng.random() < 0.3 else rng.choice(words[: 3 + rng.randrange(48)]))
            text.append(rng.choice([" "] * 12 + ["  ", "\t", ", ", ".", "\n", "\r\n", ";", "\x0b", "  "]))
        rows.append(("".join(text), rng.choice(["en", "en", "en", "fr", None, "und", ""])))
    return rows + [(None, "en"), ("", None), ("a b a b a b a b a b " * 300, "loop"), ("Same Copy here now. " * 3, "fr")] + [("same copy here now", "fr")] * 60


@pytest.mark.parametrize("least,shards,bits", [(5, 3, 24), (30, 1, 24), (8, 4, 6)])  # six bits: nearly all slots are shared
def test_against_all_phrases(spark, least, shards, bits, monkeypatch):
    rows = table()
    df = spark.createDataFrame([(i % 150, t, g, 1, "x") for i, (t, g) in enumerate(rows)], "doc_id long, text string, lang string, n int, phrase string").repartition(6)
    assert got(phrases.collocations(df, least=least, top=25, shards=shards, bits=bits)) == brute(rows, least, 25)


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    rng = random.Random(5)
    long = "".join(rng.choice("ab cd ef").strip() + rng.choice([" ", " ", " ", ". "]) for _ in range(20_000))
    rows = [(long, "en"), ("one two " * 9000, "en"), ("z " * 30, "en")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string")
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 1000)
    assert got(phrases.collocations(df)) == brute(rows, 30, 2000)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, "a b", "en")] * 30, [(1, "a b", "en")] * 29])
def test_small_tables(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert got(phrases.collocations(df)) == brute([r[1:] for r in rows], 30, 2000)


def test_blocks_give_whole_texts():
    import pyarrow as pa

    old = phrases.BLOCK_BYTES
    phrases.BLOCK_BYTES = 50
    try:
        texts = ["a" * 120, "b. " * 60, "", "c", "d", "no break " * 20 + ". then. " * 20]
        batch = pa.RecordBatch.from_arrays([pa.array(["x", "x", "x", "x", "y", "y"]), pa.array(texts)], ["lang", "text"])
        blocks = list(phrases._runs(batch.slice(1)))
        assert b"".join(bytes(b) for _, b, _ in blocks) == "".join(texts[1:]).encode()
        assert all(e is None or e[-1] == len(b) for _, b, e in blocks)
    finally:
        phrases.BLOCK_BYTES = old


def test_only_phrases_of_frequent_parts_are_counted(spark):
    """Dynamic counting leaves out nearly all phrases that all-pairs counting would hold."""
    table = np.full(1 << 20, phrases.NEVER, np.uint8)
    df = spark.createDataFrame([("en", "a b c d e")], "lang string, text string")

    class Held:
        value = table

    assert {r.n for r in phrases._scan(df, 0, 3, Held, 20, 4).collect()} == {1}
    assert phrases._scan(df, 3, 3, Held, 20, 4).count() == 0
    words = phrases.Words(np.frombuffer(b"a b", np.uint8), phrases._seed("en"), [phrases.Powers(b) for b in phrases._BASES])
    for slot in np.concatenate(phrases._slots(words.sums, 1, 20)):
        table[slot] = 1
    assert [(r.phrase, r.since) for r in phrases._scan(df, 2, 3, Held, 20, 4).where("n > 1").collect()] == [("a b", 2)]
    assert phrases._scan(df, 5, 3, Held, 20, 4).count() == 0


def test_slots_reach_the_driver_as_bitmaps(spark):
    """However many phrases are frequent, a step sends the driver one bit a slot."""
    some = spark.range(60_000).selectExpr("'en' AS lang", "CAST(1 + id % 2 AS INT) AS n", "IF(id % 2 = 0, concat('w', id), concat('w', id, ' x')) AS phrase")
    pages = phrases._slots_of(some, 17).collect()
    assert sorted(p.page for p in pages) == [0, 1, 2, 3] and {len(p.marks) for p in pages} == {4096}
    wanted = set()
    for n, end in ((1, ""), (2, " x")):
        raw = ".".join(f"w{i}{end}" for i in range(n - 1, 60_000, 2)).encode()
        words = phrases.Words(np.frombuffer(raw, np.uint8), phrases._seed("en"), [phrases.Powers(b) for b in phrases._BASES])
        sums = next(s for m, _, s in words.grams(n) if m == n)
        wanted |= set(np.concatenate(phrases._slots(sums, n, 17)).tolist())
    table = np.full(1 << 17, phrases.NEVER, np.uint8)
    table[min(wanted)] = 1
    phrases._mark(table, pages, 4)
    assert table[min(wanted)] == 1 and set(np.flatnonzero(table == 4).tolist()) == wanted - {min(wanted)}
    assert phrases._slots_of(some.limit(0), 17).collect() == []
