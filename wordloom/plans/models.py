"""The four kinds of model as sets of tables, with what can be asked of each."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.operators import cooccurrence as cooc
from wordloom.operators import decomposition, language_model, phrases, similarity, termdoc
from wordloom.sources.saved import load_tables, save_tables
from wordloom.sources.scratch import materialize


def _check(settings: dict, kind: str) -> None:
    if settings.get("kind") != kind:
        raise ValueError(f"expected a {kind} model, found {settings.get('kind')!r}")


@dataclass(frozen=True)
class TermDocumentModel:
    vocab: DataFrame
    doc_index: DataFrame
    td: DataFrame
    settings: dict = field(default_factory=dict)

    def tf_idf(self) -> TermDocumentModel:
        """Re-weighted copy; weights are never weighted again."""
        if self.settings["weighting"] != "count":
            raise ValueError("the matrix is already weighted")
        td = materialize(termdoc.tf_idf(self.td, self.doc_index.count()), "tfidf")
        return replace(self, td=td, settings={**self.settings, "weighting": "tfidf"})

    def word_vector(self, word: str) -> DataFrame:
        return termdoc.word_vector(self.td, self.vocab, self.doc_index, word)

    def document_vector(self, doc_id) -> DataFrame:
        return termdoc.document_vector(self.td, self.vocab, self.doc_index, doc_id)

    def __getitem__(self, item) -> DataFrame:
        return termdoc.item_vector(self.td, self.vocab, self.doc_index, item)

    def most_similar(self, word: str, top_n: int = 5, measure: str = "cosine") -> DataFrame:
        cells = self.td.select(F.col("id").alias("row"), F.col("doc_ix").alias("col"), "value")
        return similarity.most_similar_sparse(cells, self.vocab, word, top_n, measure)

    def save(self, path: str) -> None:
        tables = {"vocab": self.vocab, "doc_index": self.doc_index, "td": self.td}
        save_tables(self.td.sparkSession, path, tables, self.settings)

    @staticmethod
    def load(spark: SparkSession, path: str) -> TermDocumentModel:
        tables, settings = load_tables(spark, path)
        _check(settings, "term_document")
        return TermDocumentModel(tables["vocab"], tables["doc_index"], tables["td"], settings)


@dataclass(frozen=True)
class WordWordModel:
    vocab: DataFrame
    cells: DataFrame
    settings: dict = field(default_factory=dict)

    def ppmi(self, smoothing: float = 1.0) -> WordWordModel:
        """Re-weighted copy; weights are never weighted again."""
        if self.settings["weighting"] != "count":
            raise ValueError("the matrix is already weighted")
        cells = materialize(cooc.ppmi(self.cells, smoothing), "ppmi")
        return replace(self, cells=cells, settings={**self.settings, "weighting": "ppmi", "smoothing": smoothing})

    def word_vector(self, word: str) -> DataFrame:
        return cooc.word_row(self.cells, self.vocab, word)

    __getitem__ = word_vector

    def most_similar(self, word: str, top_n: int = 5, measure: str = "cosine") -> DataFrame:
        return similarity.most_similar_sparse(self.cells, self.vocab, word, top_n, measure)

    def svd_truncate(self, k: int = 250) -> EmbeddingModel:
        u, sigma = decomposition.svd_truncate(self.cells, self.vocab.count(), k)
        vectors = u.join(self.vocab.select("id", "tok"), "id").select("id", "tok", "vec")
        settings = {**self.settings, "kind": "embeddings", "source": "svd", "k_effective": len(sigma)}
        return EmbeddingModel(materialize(vectors, "svd-vectors"), [], settings)

    def save(self, path: str) -> None:
        tables = {"vocab": self.vocab, "cells": self.cells}
        save_tables(self.cells.sparkSession, path, tables, self.settings)

    @staticmethod
    def load(spark: SparkSession, path: str) -> WordWordModel:
        tables, settings = load_tables(spark, path)
        _check(settings, "word_word")
        return WordWordModel(tables["vocab"], tables["cells"], settings)


@dataclass(frozen=True)
class EmbeddingModel:
    vectors: DataFrame
    phrase_tables: list[DataFrame]
    settings: dict = field(default_factory=dict)

    def most_similar(self, word: str, top_n: int = 5, measure=similarity.vec.cosine) -> DataFrame:
        return similarity.most_similar(self.vectors, word, top_n, measure)

    def vectors_for(self, words: DataFrame | None = None) -> DataFrame:
        return similarity.vectors_for_words(self.vectors, words)

    def pca(self, words: DataFrame | None = None, k: int = 2) -> DataFrame:
        return decomposition.pca(self.vectors_for(words), k, "tok")

    def phrased(self, sents: DataFrame) -> DataFrame:
        return phrases.phrased(sents, self.phrase_tables)

    def save(self, path: str) -> None:
        tables = {"vectors": self.vectors}
        tables |= {f"phrases_{i}": t for i, t in enumerate(self.phrase_tables)}
        settings = {**self.settings, "phrase_passes": len(self.phrase_tables)}
        save_tables(self.vectors.sparkSession, path, tables, settings)

    @staticmethod
    def load(spark: SparkSession, path: str) -> EmbeddingModel:
        tables, settings = load_tables(spark, path)
        _check(settings, "embeddings")
        found = [tables[f"phrases_{i}"] for i in range(settings["phrase_passes"])]
        return EmbeddingModel(tables["vectors"], found, settings)


@dataclass(frozen=True)
class LanguageModel:
    vocab: DataFrame
    params: DataFrame
    stats: DataFrame
    settings: dict = field(default_factory=dict)

    @property
    def layers(self) -> list[dict]:
        return self.settings["layers"]

    def score(self, examples: DataFrame, key: list[str]) -> DataFrame:
        return language_model.score(examples, self.params, self.vocab.count(), key)

    def predict(self, contexts: DataFrame, key: list[str], k: int = 5) -> DataFrame:
        """Most likely next words as ``(key, rank, tok, p)`` for encoded contexts."""
        top = language_model.predict_topk(contexts, self.params, self.vocab.count(), key, k)
        words = self.vocab.select(F.col("id").alias("word_id"), "tok")
        return top.join(words, "word_id").select(*key, "rank", "tok", "p")

    def save(self, path: str) -> None:
        tables = {"vocab": self.vocab, "params": self.params, "stats": self.stats}
        save_tables(self.params.sparkSession, path, tables, self.settings)

    @staticmethod
    def load(spark: SparkSession, path: str, mini_batch_size: int | None = None) -> LanguageModel:
        """Load a saved model, optionally for another batch size."""
        tables, settings = load_tables(spark, path)
        _check(settings, "language_model")
        if mini_batch_size is not None:
            settings = {**settings, "mini_batch_size": mini_batch_size}
        return LanguageModel(tables["vocab"], tables["params"], tables["stats"], settings)
