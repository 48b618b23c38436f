"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A text is read as a stream of marks: lower-cased words, runs of symbols, and marks for shouted,
numeric and repeated words.  Its features are the hashes of the single marks and of two in a row,
each present or not, scaled to unit length; the score is the logistic of a sparse dot product with
the weights.  Nothing but the text is an input.

The per-coordinate update runs over a bounded, hash-ordered sample of the labelled documents in one
task; every document is scored.  Null and empty texts have the bias alone.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.samples import SAMPLE_ROWS, held_out, labelled_sample

BITS = 18
THRESHOLD = 0.3
WORD_MEMO = 1 << 18
PART = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")


@dataclass(frozen=True)
class Ftrl:
    """Step size, smoothing, the two penalties and the passes over the sample."""

    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 0.05
    l2: float = 0.0
    passes: int = 6


def _marks(word: str) -> tuple[int, ...]:
    """Hashes of the marks of one word."""
    parts = []
    for part in PART.findall(word):
        if part[0].isalpha():
            parts.append(part.lower())
            if len(part) > 2 and part.isupper():
                parts.append("<shout>")
        else:
            parts.append("<number>" if part.isdigit() else part)
    return tuple(zlib.crc32(p.encode()) for p in parts)


AGAIN = zlib.crc32(b"<again>")


class Hasher:
    """Sorted distinct features of a text, below 2**BITS; feature 0 is the bias."""

    def __init__(self) -> None:
        self.memo: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words, memo = (text or "").split(), self.memo
        if len(memo) > WORD_MEMO:
            memo.clear()
        for word in set(words):
            if word not in memo:
                memo[word] = _marks(word)
        marks = np.fromiter(chain.from_iterable(map(memo.__getitem__, words)), np.uint64)
        if len(marks) > 1:
            marks[1:][marks[1:] == marks[:-1]] = AGAIN
        two = marks[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ marks[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
        both = np.concatenate([marks * np.uint64(0xFF51AFD7ED558CCD), two * np.uint64(0x94D049BB133111EB)])
        return np.unique(np.concatenate([np.zeros(1, np.uint64), (both >> np.uint64(64 - BITS)).clip(1)])).astype(np.int32)


def fit(rows: list[tuple[np.ndarray, int]], how: Ftrl) -> np.ndarray:
    """Weights after ``how.passes`` passes over (features, label) in their order; both labels weigh the same in total."""
    ones = sum(label for _, label in rows)
    share = [len(rows) / (2 * max(k, 1)) for k in (len(rows) - ones, ones)]
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for _ in range(how.passes):
        for features, label in rows:
            own, square = z[features], n[features]
            root = np.sqrt(square)
            weight = np.where(np.abs(own) > how.l1, -(own - np.sign(own) * how.l1) / ((how.beta + root) / how.alpha + how.l2), 0.0)
            size = len(features) ** -0.5
            slope = (1 / (1 + np.exp(-size * weight.sum())) - label) * size * share[label]
            z[features] = own + slope - (np.sqrt(square + slope * slope) - root) / how.alpha * weight
            n[features] = square + slope * slope
    return np.where(np.abs(z) > how.l1, -(z - np.sign(z) * how.l1) / ((how.beta + np.sqrt(n)) / how.alpha + how.l2), 0.0)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", how: Ftrl = Ftrl(), rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights learned from the labelled documents that are not held out."""

    def featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for batch in batches:
            yield pd.DataFrame({"order": batch["_order"], "label": batch[label], "features": [hasher(x) for x in batch["text"]]})

    def learned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample = [(f, int(y)) for batch in batches for f, y in zip(batch["features"], batch["label"])]
        weights = fit(sample, how)
        at = np.flatnonzero(weights)
        yield pd.DataFrame({"feature": at, "weight": weights[at]})

    sample = labelled_sample(docs.select("doc_id", "text"), labels, [label], ~held_out(F.col("doc_id")), rows)
    found = sample.mapInPandas(featured, "order bigint, label int, features array<int>")
    found = found.repartition(1).sortWithinPartitions("order").mapInPandas(learned, "feature int, weight double").toPandas()
    weights = np.zeros(1 << BITS)
    weights[found["feature"]] = found["weight"]
    return weights


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    sent = weights.astype(np.float32)

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for batch in batches:
            sums = [float(sent[f].sum(dtype=np.float64)) * len(f) ** -0.5 for f in map(hasher, batch["text"])]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": 1 / (1 + np.exp(-np.array(sums)))})

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInPandas(scored, f"doc_id {kind}, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
