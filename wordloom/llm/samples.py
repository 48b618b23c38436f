"""Labelled documents to learn from, bounded in number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labelled documents that a model is fitted on, about; labels beyond it are thinned by a hash of the id.
SAMPLE_ROWS = 20_000
_GRAINS = 1 << 20


def held_out(key: Column) -> Column:
    """The fifth of ids that is kept for evaluation, crc32 of the id as text modulo 5 being 0; no row without id."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, columns: list[str], keep: Column | None = None, rows: int = SAMPLE_ROWS, key: str = "doc_id"
) -> DataFrame:
    """``docs`` joined to some ``rows`` of their labels (the ``columns``, of several labels of an id the greatest).

    The sample of labels is bounded, so it can be sent to every task; documents are not shuffled.
    """
    wanted = labels.where(keep) if keep is not None else labels
    wanted = wanted.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.max(c).alias(c) for c in columns]).dropna()
    count = max(wanted.count(), 1)
    grain = F.pmod(F.xxhash64(key), F.lit(_GRAINS))
    chosen = wanted.where(grain < F.lit(int(min(1.0, rows / count) * _GRAINS)))
    return docs.join(F.broadcast(chosen), key).withColumn("_order", F.xxhash64(key))
