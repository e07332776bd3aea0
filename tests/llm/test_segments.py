import collections
import math

import numpy as np
import pytest

from hoardline.llm import segments as sg


def tiny(weights):
    pieces = {p: i for i, p in enumerate(weights)}
    n = len(pieces)
    raw = tuple([p.encode() for p in weights] + [bytes([b]) for b in range(256)])
    return sg.Vocabulary(pieces, np.array([*weights.values()] + [-6.0] * 256), np.arange(256) + n, raw)


VOCAB = tiny({" ": -1.0, "a": -1.0, "b": -1.5, "ab": -1.2, " a": -0.7, "ba": -2.0, "aba": -2.2})


def every(text, vocab=VOCAB):
    """All segmentations with log-probabilities, by brute force; chunk by chunk like the text itself."""
    def cuts(s):
        if not s:
            return [((), 0.0)]
        out = []
        for k in range(1, len(s) + 1):
            if s[:k] in vocab.pieces:
                p = vocab.pieces[s[:k]]
                out += [((p, *r), vocab.weights[p] + w) for r, w in cuts(s[k:])]
        return out

    found = cuts(" " + text)
    total = math.log(sum(math.exp(w) for _, w in found))
    return {ids: w - total for ids, w in found}


def samples_of(texts, k, seed=1, vocab=VOCAB):
    s = sg.Sampler(vocab, k, 1.0, seed)
    blocks = s.block(texts, np.arange(len(texts), dtype=np.uint64))
    return [[(tuple(s.ids(path).tolist()), *rest) for path, *rest in row] for row in blocks]


def test_probabilities_and_order():
    want = every("aba ab")
    for row in samples_of(["aba ab"] * 200, 4):
        assert len({ids for ids, *_ in row}) == 4
        assert all(abs(want[ids] - logp) < 1e-9 for ids, logp, *_ in row)
        assert all(a[2] > b[2] for a, b in zip(row, row[1:]))


def test_without_replacement_frequencies():
    """First and second draws follow the distribution and the distribution without the first."""
    want = {i: math.exp(w) for i, w in every("aba").items()}
    n = 30_000
    rows = samples_of(["aba"] * n, 2)
    first = collections.Counter(r[0][0] for r in rows)
    pairs = collections.Counter((r[0][0], r[1][0]) for r in rows)
    for ids, p in want.items():
        assert abs(first[ids] / n - p) < 4 * math.sqrt(p / n) + 1e-3
    for (a, b), c in pairs.items():
        p = want[a] * want[b] / (1 - want[a])
        assert a != b and abs(c / n - p) < 5 * math.sqrt(p / n) + 1e-3


def test_third_draws():
    want = {i: math.exp(w) for i, w in every("aba").items()}
    n = 20_000
    third = collections.Counter(r[2][0] for r in samples_of(["aba"] * n, 3, seed=9))
    chance = collections.Counter()
    for a in want:
        for b in want:
            for c in want:
                if len({a, b, c}) == 3:
                    chance[c] += want[a] * want[b] / (1 - want[a]) * want[c] / (1 - want[a] - want[b])
    for ids, p in chance.items():
        assert abs(third[ids] / n - p) < 5 * math.sqrt(p / n) + 2e-3


def test_inclusion_scores_estimate_sums():
    """The sum over samples of value / inclusion is unbiased, here for the value "probability of the segmentation"."""
    n = 20_000
    rows = samples_of(["abab a"] * n, 3, seed=4)
    sums = [sum(math.exp(logp - inc) for _, logp, _, inc in r) for r in rows]
    assert abs(np.mean(sums) - 1) < 0.02


def test_all_segmentations_when_few():
    rows = samples_of(["a", "b"], 50)
    for row, text in zip(rows, ["a", "b"]):
        assert {r[0] for r in row} == set(every(text)) and all(r[3] == 0 for r in row)


@pytest.fixture(scope="module")
def vocab():
    return sg.vocabulary()


def test_round_trip_on_rows(spark, vocab):
    texts = ["Hello  world\nfoo \t bar ", "", None, "日本語 ½ ▁x", "a", " ", "\n\n", "x" * 60_000, "word " * 3_000, "word " * 3_000]
    rows = [(i if i else None, t, "e") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, samples string").repartition(3)
    got = sg.decode(sg.drawn(df, vocab=vocab, samples=3), vocab=vocab).collect()
    per = collections.defaultdict(list)
    for r in got:
        per[r.doc_id].append(r)
    assert set(per) == {None, 3, 4, 5, 6, 7, 8, 9}
    for i, rs in per.items():
        assert all(r.decoded == texts[i or 0] for r in rs) and len({r.sample for r in rs}) == len(rs)
    again = sg.drawn(df.repartition(1), vocab=vocab, samples=3).collect()
    assert {(r.doc_id, r.sample, tuple(r.ids)) for r in again} == {(r.doc_id, r.sample, tuple(r.ids)) for r in sg.drawn(df, vocab=vocab, samples=3).collect()}
    assert sg.drawn(df.limit(0), vocab=vocab).count() == 0


def test_likely_segmentation_is_made_of_long_pieces(vocab):
    s = sg.Sampler(vocab, 1, 8.0, 1)
    path = s.block(["the information about this"], np.zeros(1, np.uint64))[0][0][0]
    assert [vocab.raw[i].decode() for i in s.ids(path)] == [" the", " information", " about", " this"]
