"""Dense row numbers over a total order, without sending all rows to one task."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.sources.scratch import materialize

_PART, _RANK = "__part", "__rank"


def _task_count(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _running_total(weight: str):
    def add(batches):
        before = 0
        for batch in batches:
            w = batch.column(weight).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = before + np.cumsum(w)
            before = int(ends[-1]) if len(ends) else before
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ends - w, pa.int64())],
                names=[*batch.schema.names, _RANK],
            )

    return add


def with_offsets(
    df: DataFrame,
    order_by: Sequence[Column],
    name: str,
    weight: str | None = None,
    group: str | None = None,
) -> DataFrame:
    """Add ``name``: the number of rows (or summed ``weight``) before each row.

    The order is ``order_by`` within each value of the low-cardinality ``group``.  Rows are
    range-partitioned and written once with their place in the partition; only one
    total per (partition, group) is combined afterwards.  The result is a scratch table.
    """
    keys = ([F.col(group)] if group else []) + list(order_by)
    placed = (
        df.repartitionByRange(_task_count(df), *keys)
        .sortWithinPartitions(*keys)
        .withColumn(_PART, F.spark_partition_id())
    )
    if weight is None:
        in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        placed = placed.withColumn(_RANK, in_part)
    else:
        schema = T.StructType([*placed.schema, T.StructField(_RANK, T.LongType())])
        placed = placed.mapInArrow(_running_total(weight), schema)
    table = materialize(placed, "ordered")

    by = [group] if group else []
    step = F.count(F.lit(1)) if weight is None else F.sum(weight)
    parts = table.groupBy(*by, _PART).agg(F.min(_RANK).alias("__start"), step.alias("__n"))
    w = Window.partitionBy(*by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select(
        *by, _PART, "__start", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__base")
    )
    # one row per (partition, group): bounded by the partition count, not by the data
    return (
        table.join(F.broadcast(bases), [*by, _PART])
        .withColumn(name, F.col("__base") + F.col(_RANK) - F.col("__start"))
        .drop(_PART, _RANK, "__start", "__base")
    )


def dense_index(df: DataFrame, order_by: Sequence[Column], name: str) -> DataFrame:
    """0-based position of each row in ``order_by``, as a written table of ids."""
    return with_offsets(df, order_by, name)
