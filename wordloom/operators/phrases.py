"""Collocations: counting, scoring and merging adjacent words."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.functions.arrays import flatten_lists, lookup_words, row_numbers
from wordloom.operators.corpus import SENTENCE_KEY
from wordloom.operators.joins import skew_safe_join
from wordloom.operators.vocabulary import token_counts
from wordloom.sources.scratch import materialize

# A phrase table up to this many phrases is sent to the workers as a whole.
BROADCAST_PHRASES = 1_000_000
DELIMITER = "_"
SALTS = 32
# Fixed values of the collocation scorer.
MIN_COUNT, THRESHOLD = 5, 10.0


def _neighbours(toks: Column) -> Column:
    left = F.slice(toks, F.lit(1), F.size(toks) - 1)
    right = F.slice(toks, F.lit(2), F.size(toks) - 1)
    return F.zip_with(left, right, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def bigram_counts(sents: DataFrame) -> DataFrame:
    """``(a, b, n)``: adjacent pairs within sentences, counted map-side first."""
    pairs = sents.where(F.size("toks") > 1).select(F.inline(_neighbours(F.col("toks"))))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n"))


def phrase_scores(
    sents: DataFrame, min_count: int = MIN_COUNT, threshold: float = THRESHOLD
) -> DataFrame:
    """``phrases(a, b, score)`` with ``(n_ab - min_count) * L / (n_a * n_b) > threshold``.

    ``L`` is the number of distinct words and pairs.  Pairs seen ``min_count`` times or
    less score at most zero: they are counted towards ``L`` on the way to the written
    table of candidates and never joined.
    """
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    kinds = [Observation(), Observation()]
    counted = []
    for seen, counts in zip(kinds, (token_counts(sents), bigram_counts(sents))):
        frequent = counts.observe(seen, F.count(F.lit(1)).alias("kinds")).where(F.col("n") > min_count)
        counted.append(materialize(frequent, "phrase-counts"))
    words, pairs = counted
    distinct = sum(seen.get["kinds"] for seen in kinds)
    n_a = words.select(F.col("tok").alias("a"), F.col("n").alias("n_a"))
    n_b = words.select(F.col("tok").alias("b"), F.col("n").alias("n_b"))
    scored = skew_safe_join(skew_safe_join(pairs, n_a, "a", "n_a"), n_b, "b", "n_b")
    score = (F.col("n") - F.lit(min_count)) / F.col("n_a") / F.col("n_b") * F.lit(float(distinct))
    return scored.select("a", "b", score.alias("score")).where(F.col("score") > threshold)


def _merged(toks: pa.Array, starts_pair: np.ndarray) -> pa.Array:
    """Merge pairs greedily from the left; ``starts_pair`` flags tokens opening a phrase.

    In a run of consecutive flags the 1st, 3rd, 5th ... open a merge.
    """
    words, offsets = flatten_lists(toks)
    n = len(words)
    if n == 0:
        return toks
    at = np.arange(n)
    fresh = starts_pair.copy()
    fresh[1:] &= ~starts_pair[:-1]
    fresh[offsets[:-1]] = starts_pair[offsets[:-1]]
    run_start = np.maximum.accumulate(np.where(fresh, at, 0))
    opens = starts_pair & ((at - run_start) % 2 == 0)
    closes = np.zeros(n, bool)
    closes[1:] = opens[:-1]
    # only the words of phrases are copied one by one
    first = np.flatnonzero(opens)
    following = words.take(pa.array(np.minimum(first + 1, n - 1)))
    joined = pc.binary_join_element_wise(words.take(pa.array(first)), following, DELIMITER)
    merged = pc.replace_with_mask(words, pa.array(opens), joined).filter(pa.array(~closes))
    kept = np.concatenate([[0], np.cumsum(~closes)])[offsets]
    return pa.ListArray.from_arrays(pa.array(kept.astype(np.int32)), merged)


def apply_phrases(
    sents: DataFrame,
    phrases: DataFrame,
    key: list[str] = SENTENCE_KEY,
    limit: int = BROADCAST_PHRASES,
) -> DataFrame:
    """Replace ``toks`` by the sentence with its phrases merged into ``a_b``.

    A bounded phrase table goes to the workers and sentences stay where they are.  Beyond
    the bound, adjacent pairs are joined with the table and only the positions that open a
    phrase travel back to their sentence.
    """
    if phrases.count() <= limit:
        return _apply_broadcast(sents, phrases)
    pairs = sents.select(*key, F.posexplode(_neighbours(F.col("toks"))).alias("pos", "ab"))
    # a common pair that is no phrase can be hot: spread each pair over a fixed set of salts
    salt = F.pmod(F.hash(*key, "pos"), F.lit(SALTS)).alias("salt")
    every_salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    opening = (
        pairs.select(*key, "pos", "ab.a", "ab.b", salt)
        .join(phrases.select("a", "b", every_salt), ["a", "b", "salt"], "left_semi")
        .groupBy(*key)
        .agg(F.collect_list("pos").alias("__opens"))
    )

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def merge(toks: pa.Array, opens: pa.Array) -> pa.Array:
        words, offsets = flatten_lists(toks)
        places, place_offsets = flatten_lists(opens)
        flags = np.zeros(len(words), bool)
        base = np.repeat(offsets[:-1], np.diff(place_offsets))
        flags[base + places.to_numpy(zero_copy_only=False)] = True
        return _merged(toks, flags)

    none = F.array().cast("array<int>")
    joined = sents.join(opening, key, "left").withColumn("__opens", F.coalesce("__opens", none))
    return joined.withColumn("toks", merge("toks", "__opens")).drop("__opens")


def _apply_broadcast(sents: DataFrame, phrases: DataFrame) -> DataFrame:
    found = phrases.select("a", "b").toArrow()
    words = pc.unique(pa.chunked_array(found.column("a").chunks + found.column("b").chunks, pa.string()))
    number = {w: i for i, w in enumerate(words.to_pylist())}
    pair_keys = np.sort(
        lookup_words(found.column("a").combine_chunks(), number) * len(number)
        + lookup_words(found.column("b").combine_chunks(), number)
    )
    shared = sents.sparkSession.sparkContext.broadcast((number, pair_keys))

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def merge(toks: pa.Array) -> pa.Array:
        number, pair_keys = shared.value
        words, offsets = flatten_lists(toks)
        n = len(words)
        flags = np.zeros(n, bool)
        if n > 1 and len(pair_keys):
            ids = lookup_words(words, number)
            rows = row_numbers(offsets)
            near = (rows[:-1] == rows[1:]) & (ids[:-1] >= 0) & (ids[1:] >= 0)
            keys = ids[:-1] * len(number) + ids[1:]
            at = np.minimum(np.searchsorted(pair_keys, keys), len(pair_keys) - 1)
            flags[:-1] = near & (pair_keys[at] == keys)
        return _merged(toks, flags)

    return sents.withColumn("toks", merge("toks"))


def learn_phrases(
    sents: DataFrame,
    passes: int,
    min_count: int = MIN_COUNT,
    threshold: float = THRESHOLD,
) -> list[DataFrame]:
    """One written phrase table per pass, each learned on the output of the passes before.

    A phrase may hold up to ``2 ** passes`` words.  ``sents`` should be a written table; the
    corpus itself is not rewritten between passes because merging is a narrow step.
    """
    tables: list[DataFrame] = []
    for _ in range(passes):
        tables.append(materialize(phrase_scores(sents, min_count, threshold), "phrases"))
        sents = apply_phrases(sents, tables[-1])
    return tables


def phrased(sents: DataFrame, tables: Sequence[DataFrame]) -> DataFrame:
    """The corpus with the phrase tables applied in order."""
    for table in tables:
        sents = apply_phrases(sents, table)
    return sents
