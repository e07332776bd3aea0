import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hoardline.llm import packing


def plain(lengths, capacity):
    """Best two fit, one piece at a time."""
    left, bins = sorted(lengths), []
    while left:
        taken, room = [], capacity
        while True:
            fits = [x for x in left if x <= room]
            if not fits:
                break
            taken.append(fits[-1])
            left.remove(fits[-1])
            room -= fits[-1]
        if room and len(taken) > 1:
            small = taken[-1]
            pairs = [(a + b, a, b) for i, b in enumerate(left) for a in left[i + 1 :] if small < a + b <= room + small]
            if pairs:
                _, a, b = max(pairs)
                taken[-1:] = [a, b]
                left.remove(a)
                left.remove(b)
                left = sorted([*left, small])
        bins.append(sorted(taken, reverse=True))
    return bins


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.integers(1, 12)), max_size=14))
def test_the_plan_is_best_two_fit(groups):
    lengths = [x for x, n in groups for _ in range(n)]
    counts = np.bincount(lengths, minlength=41) if lengths else np.zeros(41, int)
    fillings = packing.plan(counts, 40)
    assert [b for times, b in fillings for _ in range(times)] == plain(lengths, 40)


def test_the_plan_stays_small_and_tight():
    rng = np.random.default_rng(3)
    lengths = np.minimum(2048, rng.lognormal(6, 1.2, 2_000_000).astype(int) + 1)
    counts = np.bincount(lengths, minlength=2049)
    fillings = packing.plan(counts)
    assert sum(Counter(b * 1)[x] * t for t, b in fillings for x in set(b)) == len(lengths)
    assert sum(t for t, _ in fillings) <= -(-int(lengths.sum()) // 2048) * 1.0005 + 1
    assert len(fillings) < 20_000
    again = packing.plan(counts * 50)  # fifty times the pieces: hardly more fillings
    assert len(again) < 2 * len(fillings) + 2000


TEXTS = ["", None, "Hello, World's  end", "don't\tstop now it's", "é é ́x ΑΣ ΣΑΣ", "12 345 a1b2", "<|endoftext|> x", "<|ENDOFTEXT|> X. <|startoftext|>.", "Well... Or 5. É. ÉA! ok?! no?!x 'S. it'S. (a). K.. ŁÓDŹ. ΣΑΣ. Σ. 1,2. ÷. İstanbul.", "x" * 3000, "lorem ipsum " * 2500, "a b c d " * 512, "😀 👩‍👩‍👧 ok\r\nnext\x0bline\x1cend"]


def test_ids_places_and_sequences(spark):
    tokenizer = Tokenizer.from_file(packing.vocabulary_path())
    rows = [(i, t, 7, 1) for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], 7, 1), (None, "no id", 7, 1)] + [(100 + i, "w " * (i * 37 % 2100), 7, 2) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int, sequence_id int").repartition(5)
    done = packing.packed(df, with_ids=True)
    wanted = Counter()
    for doc, text, *_ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for n, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at : at + 2048]
            wanted[doc, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    got = done.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == wanted
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(by) == len(plain([r.length for r in got], 2048))
    texts = {r.sequence_id: r for r in packing.sequences(done).collect()}
    for r in got:
        assert texts[r.sequence_id].ids[r.offset : r.offset + r.length] == list(r.ids)
        assert r.offset in texts[r.sequence_id].starts


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "a"), (1, "a")]])
def test_small_tables(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.packed(df).collect()
    assert sorted((r.doc_id, r.length) for r in got) == [(d, 2 if t else 1) for d, t in rows]
    assert len({(r.sequence_id, r.offset) for r in got}) == len(rows) and len({r.sequence_id for r in got}) <= 1


def test_a_hot_length(spark):
    df = spark.range(30_000).selectExpr("id AS doc_id", "IF(id % 3 = 0, repeat('w ', id % 900), 'one two three') AS text")
    got = packing.packed(df)
    assert got.select("sequence_id", "offset").distinct().count() == 30_000
    total, used = got.selectExpr("sum(length)", "count(DISTINCT sequence_id)").first()
    assert used <= -(-total // 2048) + 1
