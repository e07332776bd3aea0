import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hoardline.llm import trie


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            convs.setdefault(conv, []).append(((turn is not None, turn or 0), role, name, text))
    convs = {c: [(r, t) for _, r, _, t in sorted(x)] for c, x in convs.items()}
    members = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        whole = convs.get(base, [])[:h] + own[h:]
        for d in range(len(whole) + 1):
            members.setdefault(tuple(whole[:d]), []).append((c, len(whole)))
    out = []
    for node, who in members.items():
        below = [k for k in members if k[: len(node)] == node]
        kids = [k for k in below if len(k) == len(node) + 1]
        leaves = [k for k in below if not any(len(j) == len(k) + 1 and j[: len(k)] == k for j in below)]
        saved = sum((len(members[k]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) for k in below if k)
        ends = ",".join(map(str, sorted(c for c, n in who if n == len(node))))
        parent = min(c for c, _ in members[node[:-1]]) if node else None
        out.append((min(c for c, _ in who), len(node), parent, len(who), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def got(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


def table(seed, convs=60, vocabulary=3):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(1, 7)):
            rows.append((c + 20 * (c % 7 == 0), t if rng.random() > 0.05 else None, rng.choice(["user", "bot", None]), rng.choice(["a", "b c", "", None, "d\te\x0bf"][:vocabulary])))
    rows += [(500 + i, t, "user", f"copy {t}") for i in range(30) for t in range(5)]
    rows += [(700, t, "user", "long") for t in range(70)] + [(701, t, "user", "long") for t in range(65)]
    rows += [(None, 0, "user", "x"), (-7, 0, "user", "neg"), (901, None, None, None), (901, None, None, None), (43, 5, "u", "beyond")]
    return rows


@pytest.mark.parametrize("shards", [1, 7, None])
def test_against_all_prefixes(spark, shards, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 4)
    rows = table(4)
    df = spark.createDataFrame([(*r, "z", b"q") for r in rows], SCHEMA + ", key string, node binary").repartition(4)
    assert got(trie.prefixes(df, shards)) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(3, 0, None, None)], [(1, 0, "user", "a")], [(20, 0, "u", "a b"), (21, 0, "u", "a b"), (22, 0, "u", "a b"), (20, 1, "u", "c"), (22, 0, "u", "a b")]])
def test_small_tables(spark, rows):
    assert got(trie.prefixes(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_one_key_holds_most_rows_and_shares_its_start(spark):
    rows = [(c, t, "u", "same") for c in range(1000, 1200) for t in range(4)] + [(c, t, "u", "same" if t < 4 else f"own {c % 9}") for c in range(3000, 3060) for t in range(6)]
    assert got(trie.prefixes(spark.createDataFrame(rows, SCHEMA), 5)) == brute(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=4), max_size=400))
def test_the_radix_tree_holds_every_key(sequences):
    keys = {b"".join(hashlib.md5(b"%d" % t).digest() for t in s) for s in sequences}
    keys = list(keys)
    root = trie.Node(b"")
    for i, key in enumerate(keys):
        trie.insert(root, key, i)
    rows = trie.walk(root, keys, [[1] * (len(k) // 16) for k in keys], [1] * len(keys), list(range(len(keys))), ["x"] * len(keys))
    if keys:
        assert len(rows) == len({k[:d] for k in keys for d in range(0, len(k) + 1, 16)})
        assert rows[0][1] == len(keys)
        assert sum(r[7] == "x" for r in rows) == len(keys)


def test_layouts_grow():
    layout, kinds = trie.Sorted(4), []
    for n, byte in enumerate(range(255, -1, -1)):
        layout = layout.put(byte, n)
        kinds.append((type(layout).__name__, getattr(layout, "room", None)))
        assert layout.find(byte) == n and layout.ordered() == list(range(n, -1, -1))
    assert kinds[3] == ("Sorted", 4) and kinds[4] == ("Sorted", 16) and kinds[16] == ("Indexed", None) and kinds[48] == ("Direct", None)
