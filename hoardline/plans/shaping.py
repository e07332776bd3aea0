"""Result shaping shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def r6(column: Column | str, name: str | None = None) -> Column:
    """Rounded to six places, as the check compares values exactly."""
    rounded = F.round(F.col(column) if isinstance(column, str) else column, 6)
    return rounded.alias(name or (column if isinstance(column, str) else "value"))


def flag(column: Column | str, name: str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.cast("int").alias(name)


def vector_text(column: Column) -> Column:
    """A vector as text with five places, for value comparison."""
    return F.array_join(
        F.transform(column, lambda x: F.format_string("%.5f", F.round(x, 5) + F.lit(0.0))), ","
    )


def big(column: Column | str, name: str) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c.cast("bigint").alias(name)
