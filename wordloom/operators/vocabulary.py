"""Counting words and giving them dense ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.operators.joins import skew_safe_join
from wordloom.operators.ordering import dense_index
from wordloom.sources.scratch import materialize


def token_counts(sents: DataFrame, col: str = "toks") -> DataFrame:
    """``(tok, n)`` over all sentences; counted map-side before the shuffle."""
    return sents.select(F.explode(col).alias("tok")).groupBy("tok").agg(F.count("*").alias("n"))


def at_least(counts: DataFrame, min_count: int) -> DataFrame:
    return counts.where(F.col("n") >= min_count)


def vocabulary(counts: DataFrame, min_count: int = 1) -> DataFrame:
    """``vocab(tok, id, n)``: most frequent word first, ties in word order.  A written table."""
    ranked = dense_index(at_least(counts, min_count), [F.col("n").desc(), F.col("tok")], "id")
    return materialize(ranked.select("tok", F.col("id").cast("int").alias("id"), "n"), "vocabulary")


def vocabulary_size(vocab: DataFrame) -> DataFrame:
    return vocab.agg(F.count("*").alias("vocab_size"))


def encode_tokens(toks: DataFrame, vocab: DataFrame) -> DataFrame:
    """Token rows with their ids; words outside the vocabulary drop out."""
    return skew_safe_join(toks, vocab, "tok", "n").drop("n")


def in_vocabulary(toks: DataFrame, vocab: DataFrame) -> DataFrame:
    return skew_safe_join(toks, vocab.select("tok", "n"), "tok", "n").drop("n")


def out_of_vocabulary(counts: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(tok, n)`` of the words the vocabulary leaves out; one row per word, so no skew."""
    return counts.join(vocab.select("tok"), "tok", "left_anti")
