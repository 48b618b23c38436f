"""Sparse term-by-document counts and TF-IDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.errors import DocumentNotInCollection, WordNotInVocabulary
from wordloom.operators.joins import skew_safe_join


def term_document_counts(sents: DataFrame, vocab: DataFrame, doc_index: DataFrame) -> DataFrame:
    """``td(id, doc_ix, value)``: occurrences of each vocabulary word in each document.

    Counting per (document, word) comes first, so a word's hot rows shrink to one per
    document before they meet the vocabulary.
    """
    words = sents.select("doc_id", F.explode("toks").alias("tok"))
    counts = words.groupBy("doc_id", "tok").agg(F.count("*").cast("double").alias("value"))
    known = skew_safe_join(counts, vocab, "tok", "n")
    return known.join(doc_index, "doc_id").select("id", "doc_ix", "value")


def log_term_frequency(tf: Column) -> Column:
    return F.when(tf > 0, 1.0 + F.log10(tf)).otherwise(0.0)


def inverse_document_frequency(td: DataFrame, n_documents: int) -> DataFrame:
    """``(id, df, idf)`` with ``idf = N / df``; no logarithm."""
    df = td.where(F.col("value") != 0).groupBy("id").agg(F.count("*").alias("df"))
    return df.withColumn("idf", F.lit(float(n_documents)) / F.col("df"))


def tf_idf(td: DataFrame, n_documents: int) -> DataFrame:
    """Raw counts re-weighted to ``N / df * (1 + log10 tf)``; ``td`` should be a written table."""
    idf = inverse_document_frequency(td, n_documents)
    return skew_safe_join(td, idf, "id", "df").select(
        "id", "doc_ix", (F.col("idf") * log_term_frequency(F.col("value"))).alias("value")
    )


def word_vector(td: DataFrame, vocab: DataFrame, doc_index: DataFrame, word: str) -> DataFrame:
    """``(doc_ix, value)`` of one word for every document, zeros included."""
    found = vocab.where(F.col("tok") == word).first()
    if found is None:
        raise WordNotInVocabulary(word)
    row = td.where(F.col("id") == found["id"]).select("doc_ix", "value")
    return doc_index.select("doc_ix").join(row, "doc_ix", "left").fillna(0.0, ["value"])


def document_vector(td: DataFrame, vocab: DataFrame, doc_index: DataFrame, doc_id) -> DataFrame:
    """``(id, value)`` of one document for every vocabulary word, zeros included."""
    wanted = F.lit(doc_id).try_cast(doc_index.schema["doc_id"].dataType)
    found = doc_index.where(F.col("doc_id") == wanted).first()
    if found is None:
        raise DocumentNotInCollection(doc_id)
    column = td.where(F.col("doc_ix") == found["doc_ix"]).select("id", "value")
    return vocab.select("id").join(column, "id", "left").fillna(0.0, ["value"])


def item_vector(td: DataFrame, vocab: DataFrame, doc_index: DataFrame, item) -> DataFrame:
    """``(kind, ix, value)``: the item's row if it is a word, else its document column."""
    try:
        row = word_vector(td, vocab, doc_index, str(item))
        return row.select(F.lit("word").alias("kind"), F.col("doc_ix").alias("ix"), "value")
    except WordNotInVocabulary:
        column = document_vector(td, vocab, doc_index, item)
        ix = F.col("id").cast("bigint").alias("ix")
        return column.select(F.lit("document").alias("kind"), ix, "value")
