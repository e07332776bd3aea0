"""Vector arithmetic on ``array<float>`` columns, in double precision and inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-12


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also inside nested lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(vector: Column) -> Column:
    return F.sqrt(
        F.aggregate(as_double(vector), F.lit(0.0), lambda total, x: total + x * x)
    )


def normalize(vector: Column) -> Column:
    """Unit-length copy, ``v / (|v| + 1e-12)``."""
    return bind(
        norm(vector),
        lambda length: F.transform(as_double(vector), lambda x: x / (length + F.lit(EPSILON))),
    )


def cosine(a: Column, b: Column) -> Column:
    """Dot product of the two normalised vectors."""
    return dot(a, b) / ((norm(a) + F.lit(EPSILON)) * (norm(b) + F.lit(EPSILON)))


def mean_pair(a: Column, b: Column) -> Column:
    return F.zip_with(as_double(a), as_double(b), lambda x, y: (x + y) / 2)


def joined_pair(obverse: Column, reverse: Column, normalize_sides: bool = True) -> Column:
    """Concatenation of the two sides, normalised as a whole."""
    sides = [normalize(v) if normalize_sides else as_double(v) for v in (obverse, reverse)]
    return bind(F.concat(*sides), normalize)


def halves_average(vector: Column, half: int) -> Column:
    """Average of the two renormalised halves, normalised: the search vector of a pair vector."""
    first = F.slice(vector, 1, half)
    second = F.slice(vector, half + 1, half)
    return bind(
        F.zip_with(normalize(first), normalize(second), lambda x, y: (x + y) / 2), normalize
    )


def is_finite(vector: Column) -> Column:
    return F.forall(
        as_double(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )


def softmax(logits: Column) -> Column:
    """Probabilities of a logits array, shifted by its maximum."""

    def spread(weights: Column) -> Column:
        total = F.aggregate(weights, F.lit(0.0), lambda t, x: t + x)
        return bind(total, lambda t: F.transform(weights, lambda x: x / t))

    shifted = bind(
        F.array_max(as_double(logits)),
        lambda top: F.transform(as_double(logits), lambda x: F.exp(x - top)),
    )
    return bind(shifted, spread)


def ranked_classes(probabilities: Column, n: int = 3) -> Column:
    """The ``n`` most probable classes as (probability, class index); ties go to the lower index."""
    scored = F.transform(
        probabilities, lambda p, i: F.struct((-p).alias("negative"), i.alias("class_index"))
    )
    return F.transform(
        F.slice(F.array_sort(scored), 1, n),
        lambda s: F.struct((-s["negative"]).alias("probability"), s["class_index"].alias("class_index")),
    )
