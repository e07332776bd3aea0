"""Secret scans: all rules run as one automaton, in a single pass over the bytes of each text."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoardline.llm.automaton import Rule, Scanner, compile_rules
from hoardline.llm.common import binary_values, by_batch, text_or_empty

_VALUE = re.compile(rb"""[:=] *["']?(?=[^ "':])""")
SHORTEST_VALUE, SHORTEST_ACCESS, SHORTEST_HEX = 12, 18, 16
BASE = ("assign", "access", "hex")


def long_value(match: bytes) -> bool:
    """Whether the assigned value, which runs to the end of the match, is long enough."""
    return len(match) - _VALUE.search(match).end() >= SHORTEST_VALUE


def at_least(length: int):
    return lambda match: len(match) >= length


def default_rules() -> list[Rule]:
    """The three base rules, then formats of well-known services. Runs of hexadecimal digits are in every text, so
    their length is part of the rule; the other lengths are checked on the rare matches."""
    return [
        Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", long_value),
        Rule("access", r"AKIA[A-Z0-9]+", at_least(SHORTEST_ACCESS)),
        Rule("hex", rf"[0-9a-f]{{{SHORTEST_HEX},}}"),
        Rule("github", r"gh[pousr]_[A-Za-z0-9]+", at_least(40)),
        Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", at_least(20)),
        Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
        Rule("pem", r"-----BEGIN [A-Z\x20]*PRIVATE KEY-----"),
    ]


SCHEMA = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"


def scan(documents: DataFrame, rules: list[Rule] | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: ``doc_id`` and ``spans`` (kind, start, end in code points, end exclusive), ordered by
    start and then by the order of the rules. Null and empty texts have no spans; repeated rows and null ids are
    kept as they are; further columns are ignored. Texts of any length are scanned whole."""
    automaton = compile_rules(rules or default_rules())

    def run(batches):
        scanner = Scanner(automaton)
        kinds = [r.kind for r in automaton.rules]

        def one(data: bytes):
            spans = sorted((begin, kind, end) for kind, begin, end in scanner.matches(data))
            out, byte, point = [], 0, 0
            for begin, kind, end in spans:
                point += len(data[byte:begin].decode("utf-8", "replace"))
                byte = begin  # matches are ASCII, so their bytes are their code points
                out.append({"kind": kinds[kind], "start": point, "end": point + end - begin})
            return out

        def batch_of(batch):
            found = [one(v) for v in binary_values(batch.column(1))]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])

        yield from by_batch(batch_of)(batches)

    source = documents.select(F.col(id_column).cast("long").alias("doc_id"), text_or_empty(text_column).cast("binary").alias("text"))
    return source.mapInArrow(run, SCHEMA)


def joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts per base kind, a digest of the base spans and all spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
