"""The stateless text operators on a stream of files.

Cleaning, segmenting, tokenising, encoding and phrase merging look at one line at a time,
so the batch operators run unchanged on ``readStream`` frames: files that arrive later
are prepared once, with the vocabulary and phrases learned before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.text import strip
from wordloom.operators.corpus import sentences
from wordloom.operators.encoding import encode_sentences
from wordloom.operators.phrases import phrased


def stream_lines(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Lines of whole files as they appear; each file is one document."""
    files = spark.readStream.option("pathGlobFilter", glob).text(folder, wholetext=True)
    parts = files.select(
        F.input_file_name().alias("doc_id"),
        F.posexplode(F.split("value", "\n")).alias("line_no", "line"),
    )
    return parts.withColumn("line", strip("line")).where(F.col("line") != "")


def stream_encoded(
    lines: DataFrame, vocab: DataFrame, phrase_tables: list[DataFrame] | None = None
) -> DataFrame:
    """Streaming sentences with their phrases merged and their vocabulary ids."""
    return encode_sentences(phrased(sentences(lines), phrase_tables or []), vocab)
