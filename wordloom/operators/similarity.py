"""Nearest words to one word or to a table of words."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordloom.errors import WordNotInVocabulary
from wordloom.functions import vectors as vec
from wordloom.functions.arrays import stack_vectors
from wordloom.operators.joins import BROADCAST_ROWS
from wordloom.sources.scratch import materialize

MEASURES = ("cosine", "dot", "euclidean")
Similarity = Callable[[Column, Column], Column]
# Query vectors sent to the workers at a time, in bytes.
PROBE_BYTES = 64 << 20
# Scores that a task holds at a time.
TILE_CELLS = 1 << 21


def cosine_pairs(pairs: DataFrame, left: str, right: str) -> DataFrame:
    """Add ``similarity`` of two vector columns of each row."""
    return pairs.withColumn("similarity", vec.cosine(F.col(left), F.col(right)))


def most_similar(
    vectors: DataFrame, word: str, top_n: int = 5, similarity: Similarity = vec.cosine
) -> DataFrame:
    """``neighbors(word, neighbor, similarity, rank)`` of one word under any similarity.

    The word's own vector travels as a literal; the rest is one scan and a bounded top-n.
    Equal similarities rank by id.
    """
    if top_n < 1:
        raise ValueError("top_n must be at least 1")
    probe = vectors.where(F.col("tok") == word).select("id", "vec").first()
    if probe is None:
        raise WordNotInVocabulary(word)
    target = F.array(*[F.lit(float(x)) for x in probe["vec"]])
    scored = (
        vectors.where(F.col("id") != probe["id"])
        .select("id", "tok", similarity(F.col("vec"), target).alias("similarity"))
        .where(F.col("similarity").isNotNull())
    )
    best = scored.orderBy(F.col("similarity").desc(), "id").limit(top_n)
    return _ranked(best.withColumn("word", F.lit(word)))


def _ranked(scored: DataFrame) -> DataFrame:
    order = Window.partitionBy("word").orderBy(F.col("similarity").desc(), "id")
    return scored.select(
        "word", F.col("tok").alias("neighbor"), "similarity", F.row_number().over(order).alias("rank")
    )


def most_similar_sparse(
    cells: DataFrame, vocab: DataFrame, word: str, top_n: int = 5, measure: str = "cosine"
) -> DataFrame:
    """Neighbours of one word over the rows of a sparse matrix ``cells(row, col, value)``.

    Only the columns the word itself fills can add to a dot product, so its row is joined on the
    column; norms need the whole matrix.  ``measure`` is cosine, dot or (negative) euclidean.  A word without
    a cell is a zero vector: it has no cosine, but a dot product and a distance.
    """
    if top_n < 1:
        raise ValueError("top_n must be at least 1")
    if measure not in MEASURES:
        raise ValueError(f"unknown measure {measure!r}")
    probe = vocab.where(F.col("tok") == word).first()
    if probe is None:
        raise WordNotInVocabulary(word)
    own = cells.where(F.col("row") == probe["id"]).select("col", F.col("value").alias("own"))
    own_square, filled = own.agg(F.coalesce(F.sum(F.col("own") ** 2), F.lit(0.0)), F.count("*")).first()
    if filled <= BROADCAST_ROWS:
        own = F.broadcast(own)
    sums = (
        cells.where(F.col("row") != probe["id"])
        .join(own, "col", "left")
        .groupBy(F.col("row").alias("id"))
        .agg(
            F.sum(F.col("value") * F.coalesce("own", F.lit(0.0))).alias("dot"),
            F.sum(F.col("value") ** 2).alias("square"),
        )
    )
    others = vocab.where(F.col("id") != probe["id"]).select("id", "tok").join(sums, "id", "left")
    dot, square = F.coalesce("dot", F.lit(0.0)), F.coalesce("square", F.lit(0.0))
    size = F.sqrt(square) * F.lit(float(own_square) ** 0.5)
    similarity = {
        "cosine": F.when(size > 0, dot / size),
        "dot": dot,
        "euclidean": -F.sqrt(F.greatest(square + F.lit(float(own_square)) - 2 * dot, F.lit(0.0))),
    }[measure]
    scored = others.select("id", "tok", similarity.alias("similarity")).where(F.col("similarity").isNotNull())
    best = scored.orderBy(F.col("similarity").desc(), "id").limit(top_n)
    return _ranked(best.withColumn("word", F.lit(word)))


def most_similar_batch(
    vectors: DataFrame,
    words: DataFrame,
    top_n: int = 5,
    measure: str = "cosine",
    probe_bytes: int = PROBE_BYTES,
) -> DataFrame:
    """``neighbors`` of every word in ``words(tok)``; unknown words drop out.

    Tasks hold a bounded block of query vectors, score tiles of a fixed number of cells against it
    and pass on only their own best ``top_n`` per query.  More queries than fit one block take
    further scans, one block after the other.
    """
    if top_n < 1:
        raise ValueError("top_n must be at least 1")
    if measure not in MEASURES:
        raise ValueError(f"unknown measure {measure!r}")
    wanted = vectors.join(words.select("tok").distinct(), "tok", "left_semi")
    n, width = wanted.agg(F.count("*"), F.max(F.size("vec"))).first()
    blocks = max(1, -(-n * max(width or 1, 1) * 8 // probe_bytes))
    parts = []
    for block in range(blocks):
        mine = wanted
        if blocks > 1:
            mine = wanted.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block)
        parts.append(_best_of_block(vectors, mine, top_n, measure))
    best = parts[0]
    for part in parts[1:]:
        best = best.unionByName(part)
    return _ranked(best)


def _best_of_block(vectors: DataFrame, probes: DataFrame, top_n: int, measure: str) -> DataFrame:
    """The best of one block of queries, as a written table: the next block is only sent when it is done."""
    found = probes.select("id", "tok", "vec").toArrow().combine_chunks()
    names = found.column("tok").to_pylist()
    ids = found.column("id").to_numpy()
    if not names:
        return vectors.where("false").select(
            F.col("tok").alias("word"), "id", "tok", F.lit(0.0).alias("similarity")
        )
    shared = vectors.sparkSession.sparkContext.broadcast(
        (names, ids, stack_vectors(found.column("vec")))
    )

    def best(batches):
        names, ids, queries = shared.value
        kept = _Best(top_n)
        for batch in batches:
            other_ids = batch.column("id").to_numpy(zero_copy_only=False)
            others = stack_vectors(batch.column("vec"))
            for a, b in tiles(len(queries), len(others)):
                scores = _scores(queries[a], others[b], measure)
                scores[ids[a][:, None] == other_ids[b][None, :]] = np.nan
                kept.add(a.start, scores, other_ids[b])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([names[i] for i in kept.query], pa.string()),
                pa.array(kept.other, pa.int32()),
                pa.array(kept.score, pa.float64()),
            ],
            names=["word", "id", "similarity"],
        )

    narrow = vectors.select(F.col("id").cast("int").alias("id"), "vec")
    scored = narrow.mapInArrow(best, "word string, id int, similarity double")
    w = Window.partitionBy("word").orderBy(F.col("similarity").desc(), "id")
    top = scored.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= top_n).drop("__rn")
    words = vectors.select(F.col("id").cast("int").alias("id"), "tok")
    written = materialize(top.join(words, "id").select("word", "id", "tok", "similarity"), "neighbors")
    shared.unpersist()
    return written


def tiles(queries: int, others: int, cells: int = TILE_CELLS):
    """Slices of queries and of other rows that meet in at most ``cells`` scores."""
    wide = max(1, min(others, 1024))
    tall = max(1, cells // wide)
    for b in range(0, others, wide):
        for a in range(0, queries, tall):
            yield slice(a, min(a + tall, queries)), slice(b, min(b + wide, others))


class _Best:
    """The best ``top_n`` of each query so far; equal scores go by id."""

    def __init__(self, top_n: int) -> None:
        self.top_n = top_n
        self.query, self.other, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray) -> None:
        valid = np.where(np.isnan(scores), -np.inf, scores)
        if valid.shape[1] > self.top_n:
            # every score that ties with the last of the best is still a candidate
            least = np.partition(valid, -self.top_n, axis=1)[:, -self.top_n]
            q, j = np.nonzero((valid >= least[:, None]) & (valid > -np.inf))
        else:
            q, j = np.nonzero(valid > -np.inf)
        query = np.concatenate([self.query, q + first])
        other = np.concatenate([self.other, ids[j]])
        score = np.concatenate([self.score, valid[q, j]])
        order = np.lexsort((other, -score, query))
        query, other, score = query[order], other[order], score[order]
        begin = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.empty(0, np.int64)
        rank = np.arange(len(query)) - np.repeat(begin, np.diff(np.r_[begin, len(query)]))
        keep = rank < self.top_n
        self.query, self.other, self.score = query[keep], other[keep], score[keep]


def _scores(queries: np.ndarray, others: np.ndarray, measure: str) -> np.ndarray:
    if measure == "euclidean":
        return np.stack([-np.sqrt(((q - others) ** 2).sum(axis=1)) for q in queries])
    scores = queries @ others.T
    if measure == "cosine":
        scale = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(others, axis=1)[None, :]
        scores = np.where(scale > 0, scores / np.where(scale > 0, scale, 1.0), np.nan)
    return scores


def vectors_for_words(vectors: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """The vectors of ``words(tok)``, or of the whole vocabulary; unknown words are an error."""
    if words is None:
        return vectors
    wanted = words.select("tok").distinct()
    unknown = wanted.join(vectors, "tok", "left_anti").limit(1).collect()
    if unknown:
        raise WordNotInVocabulary(unknown[0]["tok"])
    return vectors.join(wanted, "tok", "left_semi")
