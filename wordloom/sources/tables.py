"""Documents held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def spread(df: DataFrame, key: str) -> DataFrame:
    """Use every core when a table arrives in fewer partitions than there are cores.

    A small table is often a single row group.  A large one already has enough
    partitions and is left alone, so big text is never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)


def documents_table(
    spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``documents(doc_id, text)`` from Parquet, reading only those two columns."""
    table = spark.read.parquet(path)
    named = table.select(table[id_col].alias("doc_id"), table[text_col].alias("text"))
    return spread(named, "doc_id")
