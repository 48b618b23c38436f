"""Lookups of a dimension keyed by word, where a few words may carry most fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows, and bytes, of a dimension that may be sent to every executor.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


def _row_bytes(dim: DataFrame):
    """About the bytes of one row: eight for each number, the length of each string, the size of each array."""
    parts = []
    for field in dim.schema:
        kind = field.dataType.typeName()
        if kind == "array":
            parts.append(F.size(field.name) * 8)
        elif kind in ("string", "binary"):
            parts.append(F.coalesce(F.octet_length(field.name), F.lit(0)))
        else:
            parts.append(F.lit(8))
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total + 16


def skew_safe_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    weight: str,
    limit: int = BROADCAST_ROWS,
    how: str = "inner",
) -> DataFrame:
    """Inner (or left) join on the unique key of ``dim``, safe when some keys are very hot.

    ``weight`` bounds how many fact rows a key can have.  At most ``limit`` keys can hold
    ``1/limit`` of the total weight each, so that head is broadcast with a proven bound;
    every other key is too rare to overload a task and goes through an ordinary join.
    A dimension of at most ``limit`` rows is all head.  Wide rows lower the limit, so that what is sent stays
    within ``BROADCAST_BYTES``.  ``dim`` should be a written table.
    """
    widest = F.max(_row_bytes(dim))
    size, total, row = dim.agg(F.count(F.lit(1)), F.sum(F.col(weight).cast("double")), widest).first()
    limit = max(1, min(limit, BROADCAST_BYTES // max(row or 1, 1)))
    if size <= limit:
        return fact.join(F.broadcast(dim), key, how)
    is_head = F.col(weight).cast("double") * F.lit(float(limit)) >= F.lit(total)
    head, tail = dim.where(is_head), dim.where(~is_head)
    hot = fact.join(F.broadcast(head), key)
    cold = fact.join(F.broadcast(head.select(key)), key, "left_anti").join(tail, key, how)
    return hot.unionByName(cold)
