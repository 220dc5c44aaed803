"""Vectors in columns: validity, products and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def square_norm(v) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))


def is_valid(v) -> Column:
    """Not null, not empty, a finite length other than 0."""
    n = F.sqrt(square_norm(v))
    return F.coalesce((n > 0) & ~F.isnan(n) & (n < F.lit(float("inf"))), F.lit(False))


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a, b) -> Column:
    return dot(a, b) / F.sqrt(square_norm(a) * square_norm(b))


def score(a, b, raw: bool = False) -> Column:
    """Similarity of two vectors: (1 + cosine) / 2, or the cosine itself. Null for vectors of different lengths."""
    c = cosine(a, b)
    value = c if raw else (1 + c) / 2
    return F.when(F.size(a) == F.size(b), value)
