import random
import zlib

import numpy as np
import pytest

from hoardline.llm import toxicity as tx

WORDS = [f"w{i}" for i in range(400)]


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_terms_are_those_of_the_words():
    texts = ["ab cdefgh, ab", "", "é\x00x ab", "a" * 70_000, "cdefgh"]
    data = [t.encode() for t in texts]
    offsets = np.append(0, np.cumsum([len(d) for d in data]))
    terms, cuts = tx.hashed_terms(np.frombuffer(b"".join(data), np.uint8), offsets)
    per = [set(terms[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    assert len(per[0]) == 4 and not per[1] and per[4] < per[0] and len(per[2] & per[0]) == 1 and len(per[3]) == 4
    alone = [set(tx.hashed_terms(np.frombuffer(d, np.uint8), np.array([0, len(d)]))[0]) for d in data]
    assert alone == per
    some = np.zeros(1 << tx.BITS, bool)
    some[list(per[4])] = True
    terms, cuts = tx.hashed_terms(np.frombuffer(b"".join(data), np.uint8), offsets, some)
    assert [cuts[i + 1] - cuts[i] for i in range(5)] == [3, 0, 0, 0, 3]


def test_pairs_decide_where_single_terms_do_not(spark):
    """Toxic only if an insult meets a group: no linear weight separates the four cases."""
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(3_000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words = rng.choices(WORDS, k=12) + ["blorg"] * insult + ["zanians"] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words), 0.5))
        labels.append((i, int(insult == group)))
    documents = spark.createDataFrame(rows, "doc_id long, text string, score double").repartition(3)
    machine = tx.train(documents, spark.createDataFrame(labels, "doc_id long, toxic int"), tx.Settings(steps=3_000, least_chi=0.0))
    got = {r.doc_id: r for r in tx.score(documents, machine).collect()}
    test = [i for i in range(3_000) if held(i)]
    assert all(got[i].held_out == held(i) for i in got)
    assert np.mean([got[i].predicted == labels[i][1] for i in test]) > 0.9


@pytest.mark.parametrize("words", [400, 3_000])
def test_pairs_decide_under_the_settings_in_use(words):
    """Neither word of the pair tells anything alone, and more terms than a thousand tell as little."""
    rng = random.Random(5)
    vocabulary, texts, labels = [f"w{i}" for i in range(words)], [], []
    for _ in range(3_000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        chosen = rng.choices(vocabulary, k=12) + ["blorg"] * insult + ["zanians"] * group
        texts.append(" ".join(chosen).encode())
        labels.append(float(insult == group))
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    terms, cuts = tx.hashed_terms(np.frombuffer(b"".join(texts), np.uint8), offsets)
    machine = tx.fit(terms[: cuts[2_400]], cuts[:2_401], np.array(labels[:2_400]), tx.Settings())
    scores = machine.score(terms[cuts[2_400] :], cuts[2_400:] - cuts[2_400])
    assert np.mean((scores >= 0.5) == np.array(labels[2_400:])) > 0.9


def test_rarer_terms_count_too():
    """2,000 toxic words, each in a few texts: more than any list of a thousand holds."""
    rng = random.Random(7)
    texts, labels = [], []
    for i in range(8_000):
        toxic = i % 2
        chosen = rng.choices(WORDS, k=8) + [f"{'x' if toxic else 'y'}{rng.randrange(2_000)}q" for _ in range(6)]
        texts.append(" ".join(chosen).encode())
        labels.append(float(toxic))
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    terms, cuts = tx.hashed_terms(np.frombuffer(b"".join(texts), np.uint8), offsets)
    machine = tx.fit(terms[: cuts[6_000]], cuts[:6_001], np.array(labels[:6_000]), tx.Settings())
    assert machine.wanted.sum() > 1_024
    scores = machine.score(terms[cuts[6_000] :], cuts[6_000:] - cuts[6_000])
    assert np.mean((scores >= 0.5) == np.array(labels[6_000:])) > 0.9


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    documents, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    machine = tx.train(documents, labels)
    scored = tx.score(documents, machine).join(labels, "doc_id").where("held_out").collect()
    score, truth = np.array([r.score for r in scored]), np.array([r.toxic for r in scored])
    rank = score.argsort().argsort()
    auc = (rank[truth == 1].mean() - (truth.sum() - 1) / 2) / (truth == 0).sum()
    assert auc > 0.96 and (score[truth == 0] >= 0.5).mean() < 0.01 and (score[truth == 1] >= 0.5).mean() > 0.8
    again = {r.doc_id: r.score for r in tx.score(documents, tx.train(documents, labels)).collect()}
    assert all(again[r.doc_id] == r.score for r in scored)


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "x y"), (3, "a" * 300_000), (3, "a" * 300_000)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    for labels in ([], [(1, 1)], [(1, 1), (1, 0), (2, None), (None, 1)]):
        machine = tx.train(documents, spark.createDataFrame(labels, "doc_id long, toxic int"))
        got = tx.score(documents, machine).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got) and got[0].score == got[1].score
    assert tx.score(documents.limit(0), machine).count() == 0
