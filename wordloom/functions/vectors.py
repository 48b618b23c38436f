"""Similarity measures between two ``ARRAY<DOUBLE>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine(a: Column, b: Column) -> Column:
    """NULL when either vector is zero."""
    scale = norm(a) * norm(b)
    return F.when(scale > 0, dot(a, b) / scale)


def negative_euclidean(a: Column, b: Column) -> Column:
    """Minus the distance, so that larger still means more similar."""
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return -F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, x: acc + x))
