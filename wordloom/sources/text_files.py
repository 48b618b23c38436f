"""Plain text files as a corpus: one file is one document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wordloom.functions.text import strip
from wordloom.sources.scratch import materialize

# Line counts of this many file splits may be sent to every executor.
BROADCAST_SPLITS = 2_000_000


def read_text_lines(spark: SparkSession, paths: str | list[str], glob: str = "*") -> DataFrame:
    """``lines(doc_id, line_no, line)`` of UTF-8 files; ``doc_id`` is the file path.

    Files split across tasks anywhere, so a line number is its rank within its split plus
    the lines of the file's earlier splits.  The lines are written once with their place in
    the split, because a second scan need not split files the same way.  Line counts per
    split are broadcast, so that text is not shuffled, unless there are very many of them.
    """
    raw = (
        spark.read.option("pathGlobFilter", glob)
        .option("lineSep", "\n")
        .text(paths)
        .select(
            F.input_file_name().alias("doc_id"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"),
            F.col("value").alias("line"),
        )
    )
    raw = materialize(raw, "text-lines")
    splits = raw.groupBy("doc_id", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy("doc_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        "doc_id", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    starts = materialize(starts, "splits")
    if starts.count() <= BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    return (
        raw.join(starts, ["doc_id", "block"])
        .select(
            "doc_id",
            (F.col("start") + F.col("at") - F.col("first")).alias("line_no"),
            strip("line").alias("line"),
        )
        .where(F.col("line") != "")
    )


def list_documents(spark: SparkSession, paths: str | list[str], glob: str = "*") -> DataFrame:
    """``(doc_id)`` of every file, those without any word included."""
    # the file listing is what Spark's file index keeps on the driver for any read
    listed = spark.read.option("pathGlobFilter", glob).text(paths).inputFiles()
    return spark.createDataFrame([(path,) for path in listed], "doc_id string")
