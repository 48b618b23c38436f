"""Toxicity by a classifier chain.

Categories are predicted one after another by linear (logistic) models; each later model also
sees the log-odds that the earlier ones gave.  While training these come from other folds than the
row's own, so a later model learns how far it can trust its forerunners.

Features are the words of a text and the beginnings of longer words, by how many of its distinct
words have them (as log2(1 + n)).  On a
bounded, hash-ordered sample of labelled documents those are chosen that lean to the last
category more than chance allows; the models are fitted on them with a penalty.  All documents are scored
over their whole texts.  Null and empty texts have no features and get the intercepts' score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.samples import labelled_sample

# Labelled documents that a chain is fitted on, about.
SAMPLE_ROWS = 10_000
PREFIXES = (4, 5, 6, 7)
LETTERS = re.compile(r"[^\W\d_]+")
WORD_MEMO = 1 << 18
# Features that a fitted chain uses at most, the strongest first; at least so many rows must have one.
FEATURES, LEAST_ROWS, LEAST_Z = 4096, 3, 4.0
FOLDS = 4
# Log-odds that a later model sees lie within this.
MOST_ODDS = 6.0
# Categories by language, the most frequent of the sample; then all together.
LANGUAGES = 6


def word_features(word: str) -> list[int]:
    names = {word, *(f"^{word[:k]}" for k in PREFIXES if len(word) > k)}
    return [xxhash.xxh3_64_intdigest(name) >> 1 for name in names]


def words_of(text: str | None) -> set[str]:
    return set(LETTERS.findall(text.lower())) if text else set()


def text_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features of a text and how many of its distinct words have each."""
    return np.unique(np.array([f for w in words_of(text) for f in word_features(w)], np.int64), return_counts=True)


@dataclass
class Chain:
    """Fitted models: ``features`` to columns, for each category weights, weights of earlier log-odds and an intercept."""

    categories: list[str]
    features: dict[int, int]
    weights: np.ndarray
    earlier: np.ndarray
    intercept: np.ndarray
    threshold: float

    def __post_init__(self) -> None:
        self.memo: dict[str, list[int]] = {}

    def columns(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Columns of the features of ``text`` and their values."""
        memo, found = self.memo, []
        if len(memo) > WORD_MEMO:
            memo.clear()
        for word in words_of(text):
            at = memo.get(word)
            if at is None:
                at = memo[word] = [c for f in word_features(word) if (c := self.features.get(f)) is not None]
            found += at
        at, n = np.unique(np.array(found, np.intp), return_counts=True)
        return at, np.log2(1 + n)

    def probabilities(self, text: str | None) -> list[float]:
        (at, value), odds = self.columns(text), np.zeros(len(self.categories))
        for k in range(len(odds)):
            odds[k] = self.intercept[k] + self.weights[k, at] @ value + self.earlier[k, :k] @ odds[:k].clip(-MOST_ODDS, MOST_ODDS)
        return (1 / (1 + np.exp(-odds.clip(-30, 30)))).tolist()


def _logistic(cells: tuple[np.ndarray, np.ndarray, np.ndarray], dense: np.ndarray, y: np.ndarray, width: int, l2: float, steps: int = 150):
    """Weights of a penalised logistic model of sparse cells (rows, columns, values) and ``dense`` columns,
    by steps that shrink with each coordinate's own past gradients."""
    rows, cols, values = cells
    n = len(y)
    at, past = np.zeros(width + dense.shape[1] + 1), np.full(width + dense.shape[1] + 1, 1e-9)
    for _ in range(steps):
        odds = np.bincount(rows, at[cols] * values, n) + dense @ at[width:-1] + at[-1]
        gap = 1 / (1 + np.exp(-odds.clip(-30, 30))) - y
        slope = np.concatenate([np.bincount(cols, gap[rows] * values, width), dense.T @ gap, [gap.sum()]])
        slope[:-1] += l2 * at[:-1]
        past += slope * slope
        at -= 0.5 * slope / np.sqrt(past)
    return at[:width], at[width:-1], at[-1]


def _log_odds(p: float) -> float:
    return float(np.log(p / (1 - p)))


def fit_chain(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, categories: list[str], l2: float = 0.2) -> Chain:
    """A chain from ``text_features`` of texts and their labels (rows x categories, 0 or 1)."""
    n = len(texts)
    if not n:
        return Chain(categories, {}, *(np.zeros((len(categories), k)) for k in (0, len(categories))), np.full(len(categories), -30.0), 0.5)
    sizes = np.array([len(f) for f, _ in texts])
    names, codes = np.unique(np.concatenate([f for f, _ in texts]), return_inverse=True)
    values = np.log2(1 + np.concatenate([c for _, c in texts]))
    owner = np.repeat(np.arange(n), sizes)
    seen = np.bincount(codes, minlength=len(names))
    # chosen by the last category, which holds the others: by a narrower one every word of its language would lean
    rate = (labels[:, -1].sum() + 0.5) / (n + 1)
    hits = np.bincount(codes, labels[owner, -1], len(names))
    strength = (hits - seen * rate) / np.sqrt(seen * rate * (1 - rate))
    strength[seen < LEAST_ROWS] = 0
    chosen = np.argsort(-strength, kind="stable")[:FEATURES]
    chosen = chosen[strength[chosen] >= LEAST_Z]
    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))
    used = place[codes] >= 0
    cells, width = (owner[used], place[codes][used], values[used]), len(chosen)

    fold = np.arange(n) % FOLDS
    odds = np.zeros((n, len(categories)))
    weights, earlier = np.zeros((len(categories), width)), np.zeros((len(categories), len(categories)))
    intercept = np.zeros(len(categories))
    for k, y in enumerate(labels.T):
        if y.min() == y.max():  # a category that never or always applies
            intercept[k] = odds[:, k] = _log_odds((y.sum() + 0.5) / (n + 1))
            continue
        for f in range(FOLDS if n >= FOLDS else 0):
            train, test = fold != f, fold == f
            renumber = np.cumsum(train) - 1
            inside = train[cells[0]]
            part = (renumber[cells[0][inside]], cells[1][inside], cells[2][inside])
            w, e, b = _logistic(part, odds[train, :k], y[train], width, l2)
            odds[test, k] = (np.bincount(cells[0], w[cells[1]] * cells[2], n) + odds[:, :k] @ e + b)[test]
        odds[:, k] = odds[:, k].clip(-MOST_ODDS, MOST_ODDS)
        weights[k], earlier[k, :k], intercept[k] = _logistic(cells, odds[:, :k], y, width, l2)
    # the cut with the best F1 of the last category, out of fold; halfway to the next lower score
    y, p = labels[:, -1], 1 / (1 + np.exp(-odds[:, -1]))
    threshold = 0.5
    if y.min() != y.max():
        order = np.argsort(-p, kind="stable")
        hits = np.cumsum(y[order])
        f1 = 2 * hits / (np.arange(1, n + 1) + y.sum())
        f1[:-1][p[order][1:] == p[order][:-1]] = 0
        best = int(np.argmax(f1))
        threshold = float((p[order][best] + p[order][min(best + 1, n - 1)]) / 2)
    kept = {int(names[c]): i for i, c in enumerate(chosen)}
    return Chain(categories, kept, weights, earlier, intercept, threshold)


def train(docs: DataFrame, labels: DataFrame, categories: list[str], rows: int = SAMPLE_ROWS) -> Chain:
    """Fit a chain on ``docs`` (doc_id, text) and ``labels`` (doc_id and a 0/1 column per category), in one task."""

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [text_features(x) for x in batch["text"]]
            yield batch[["_order", *categories]].assign(features=[f for f, _ in found], counts=[n for _, n in found])

    def learned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        texts = [(f, n) for part in parts for f, n in zip(part["features"], part["counts"])]
        y = np.concatenate([p[categories].to_numpy(float) for p in parts]) if parts else np.zeros((0, len(categories)))
        chain = fit_chain(texts, y, categories)
        out = [("threshold", -1, 0, chain.threshold)]
        for k in range(len(categories)):
            out.append(("intercept", k, 0, float(chain.intercept[k])))
            out += [("earlier", k, j, float(chain.earlier[k, j])) for j in range(k)]
            out += [("weight", k, f, float(chain.weights[k, c])) for f, c in chain.features.items()]
        yield pd.DataFrame(out, columns=["part", "category", "feature", "value"])

    sample = labelled_sample(docs.select("doc_id", "text"), labels, categories, rows=rows)
    kinds = ", ".join(f"`{c}` int" for c in categories)
    found = sample.mapInPandas(featured, f"_order bigint, {kinds}, features array<bigint>, counts array<int>")
    found = found.repartition(1).sortWithinPartitions("_order")
    model = found.mapInPandas(learned, "part string, category int, feature bigint, value double").toPandas()
    names = sorted(set(model.loc[model["part"] == "weight", "feature"].tolist()))
    at = {f: i for i, f in enumerate(names)}
    size = len(categories)
    # without labels nothing is toxic
    chain = Chain(categories, at, np.zeros((size, len(at))), np.zeros((size, size)), np.full(size, -30.0), 0.5)
    for part, k, f, value in model.itertuples(index=False):
        if part == "threshold":
            chain.threshold = value
        elif part == "intercept":
            chain.intercept[k] = value
        elif part == "earlier":
            chain.earlier[k, f] = value
        else:
            chain.weights[k, at[f]] = value
    return chain


def language_categories(docs: DataFrame, labels: DataFrame, languages: int = LANGUAGES) -> tuple[DataFrame, list[str]]:
    """Labels with a column for each of the most frequent languages (toxic and in it), and for all: toxic.

    Language only names the categories to learn; it is no input of a score.
    """
    labelled = labels.select("doc_id", "toxic").join(docs.select("doc_id", "lang"), "doc_id")
    counts = labelled.where("lang IS NOT NULL").groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    found = sorted(r["lang"] for r in counts.collect())
    names = [f"toxic_{k}" for k in range(len(found))]
    columns = [(F.col("lang").eqNullSafe(x) & (F.col("toxic") == 1)).cast("int").alias(n) for n, x in zip(names, found)]
    return labelled.select("doc_id", *columns, F.col("toxic").cast("int").alias("toxic")), [*names, "toxic"]


def score(docs: DataFrame, chain: Chain) -> DataFrame:
    """doc_id, toxic (over the threshold), p_toxic and the probabilities of all categories, in the chain's order."""

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [chain.probabilities(x) for x in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "p": found})

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInPandas(scored, f"doc_id {kind}, p array<double>")
    last = F.element_at("p", -1)
    return found.select("doc_id", (last >= chain.threshold).alias("toxic"), last.alias("p_toxic"), F.col("p").alias("p_categories"))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labelled documents and score all."""
    marked, categories = language_categories(docs, labels)
    return score(docs, train(docs, marked, categories))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the chain does not reject, each judged by its own text, whatever its doc_id."""
    marked, categories = language_categories(docs, labels)
    return clean_rows(docs, train(docs, marked, categories))


def clean_rows(docs: DataFrame, chain: Chain) -> DataFrame:
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield batch.filter(pa.array([chain.probabilities(x)[-1] < chain.threshold for x in texts], pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
