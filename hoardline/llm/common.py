"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def by_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch]):
    """A ``mapInArrow`` function from a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return run


def give_back() -> None:
    """Return freed memory to the system: workers serve one task after the other and keep what the largest one took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, giving memory back when a task ends."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted`` with underscores in front until none is a column of ``df``, whatever the case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def binary_values(column: pa.Array) -> list[bytes]:
    """A binary column as Python bytes; nulls become empty."""
    return [b"" if v is None else v for v in column.to_pylist()]


def list_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets (from zero) of a list column without nulls."""
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
    return values, offsets - offsets[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of every unsigned 64-bit value (wrapping arithmetic)."""
    with np.errstate(over="ignore"):
        x = (x + GOLDEN).astype(np.uint64, copy=False)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def uniforms(key: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1 that depend on nothing but ``key``."""
    return ((mix64(key) >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def span_text(spans: Column) -> Column:
    """``kind:start:end`` by start and then kind order; ``spans`` is an array of (start, kind_no, end, kind)."""
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def row_hash(*values: Column) -> Column:
    """A 64-bit key of texts; null and the text "null" differ as xxhash64 skips nulls in order."""
    return F.xxhash64(*[F.coalesce(v, F.lit("\x00")) for v in values])


def row_key(df: DataFrame, *columns: str) -> Column:
    """:func:`row_hash` of a row's columns."""
    return row_hash(*[F.col(c).cast("string") for c in columns])
