"""Columns that are computed once, however often later steps use them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(name: str, value: Column) -> Column:
    """``value`` as a generated column, which later steps read and never compute anew.

    An ordinary column may be computed again for each use: below a generator, in a filter on it, and for every
    element if it is used inside a lambda.
    """
    return F.explode(F.array(value)).alias(name)
