"""Line dedup by site: a line on too large a share of a host's pages is boilerplate and dropped.

Lines are compared without white space at their ends; blank lines are always kept.  A line that
a page repeats counts once for that page.  Null texts stay null and count as pages without
lines; rows without a host belong to no site and keep their text, and so do rows without a key.  Repeated
rows count as a page each.  All columns of the input are returned, under their own names.

On a host with fewer than ``min_pages`` pages, a line on all of them (two at least) is boilerplate, unless
those pages are copies of one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.llm.words import SPACE_CHARS
from wordloom.sources.scratch import materialize

# In the gap of line shares on sf0.1: the most frequent line has 8.6 % of a host's pages and more, the next below 5 %.
RATIO = 0.065
MIN_PAGES = 5


def _stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE_CHARS))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(_stripped(line)))


def boilerplate(lines: DataFrame, totals: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """host, digest of the lines on more than ``ratio`` of the host's pages, and on ``min_pages`` at least,
    or on all pages of a host that has fewer, if its texts differ.

    One page has a bounded share of such lines: their number on a host is below its lines per
    page divided by ``ratio``, however many pages there are.
    """
    counts = lines.groupBy("host", "digest").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(2, min_pages))
    enough = (F.col("n") >= min_pages) | ((F.col("pages") < min_pages) & (F.col("n") == F.col("pages")) & F.col("differ"))
    return counts.join(totals, "host").where(enough & (F.col("n") > F.lit(ratio) * F.col("pages"))).select("host", "digest")


def dedup_lines(
    docs: DataFrame,
    key: str = "doc_id",
    host: str = "source",
    text: str = "text",
    ratio: float = RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text``, plus _n_lines and _n_dropped."""
    pages = docs.select(F.col(key).alias("key"), F.col(host).alias("host"), F.split(text, "\n").alias("lines"))
    pages = pages.where("host IS NOT NULL")
    found = F.filter(F.array_distinct(F.transform("lines", _stripped)), lambda x: x != "")
    lines = pages.select("key", "host", F.explode(found).alias("line")).select("key", "host", F.unhex(F.md5("line")).alias("digest"))
    texts = docs.select(F.col(host).alias("host"), F.md5(F.coalesce(text, F.lit(""))).alias("digest")).where("host IS NOT NULL")
    totals = texts.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), (F.min("digest") < F.max("digest")).alias("differ"))
    bad = materialize(boilerplate(lines, totals, ratio, min_pages), "boilerplate")
    # by host, too: pages of several hosts may share an id
    marked = lines.join(bad, ["host", "digest"]).groupBy("host", "key").agg(F.collect_set("digest").alias("__line_dedup_bad"))
    marked = marked.withColumnsRenamed({"key": "__line_dedup_key", "host": "__line_dedup_host"})
    same = (F.col(key) == F.col("__line_dedup_key")) & (F.col(host) == F.col("__line_dedup_host"))
    joined = docs.join(marked, same, "left").drop("__line_dedup_key", "__line_dedup_host")
    whole = F.split(text, "\n")
    keep = lambda line: (_stripped(line) == "") | ~F.array_contains("__line_dedup_bad", _digest(line))
    left = joined.withColumn("__line_dedup_left", F.when(F.col("__line_dedup_bad").isNotNull(), F.filter(whole, keep)))
    n_lines = F.coalesce(F.size(whole), F.lit(0))
    n_lines = F.when(F.col(text).isNull(), F.lit(0)).otherwise(n_lines)
    dropped = F.when(F.col("__line_dedup_left").isNull(), F.lit(0)).otherwise(n_lines - F.size("__line_dedup_left"))
    result = left.withColumn("_n_lines", n_lines.cast("bigint")).withColumn("_n_dropped", dropped.cast("bigint"))
    rest = F.when(F.col("__line_dedup_left").isNull(), F.col(text)).otherwise(F.array_join("__line_dedup_left", "\n"))
    return result.withColumn(text, rest).drop("__line_dedup_left", "__line_dedup_bad")


def dedup_boilerplate(docs: DataFrame) -> DataFrame:
    """``docs`` with the boilerplate lines taken out of ``text``, all other columns as they are."""
    return dedup_lines(docs).select(docs.columns)
