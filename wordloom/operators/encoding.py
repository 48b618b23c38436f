"""Sentences of words to sentences of vocabulary ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.functions.arrays import flatten_lists, lookup_words
from wordloom.operators.corpus import SENTENCE_KEY
from wordloom.operators.joins import BROADCAST_ROWS, skew_safe_join

# A word table up to this many words is sent to the workers as a whole.
BROADCAST_WORDS = 1_000_000


def word_table(vocab: DataFrame, limit: int = BROADCAST_WORDS):
    """Broadcast ``{word: id}`` if the vocabulary has at most ``limit`` words, else None."""
    if vocab.count() > limit:
        return None
    words = vocab.select("tok", "id").toArrow()
    table = dict(zip(words.column("tok").to_pylist(), words.column("id").to_pylist()))
    return vocab.sparkSession.sparkContext.broadcast(table)


def encode_sentences(
    sents: DataFrame,
    vocab: DataFrame,
    key: list[str] = SENTENCE_KEY,
    limit: int = BROADCAST_WORDS,
) -> DataFrame:
    """Add ``ids``: the id of each token, NULL outside the vocabulary, positions kept.

    With a bounded vocabulary this is a narrow step: no token leaves its partition.  Beyond
    the bound tokens are joined with the vocabulary (hot words by broadcast, the rest by
    shuffle) and gathered again per sentence, which is part of one text cell.
    """
    table = word_table(vocab, limit)
    if table is not None:

        @F.arrow_udf(T.ArrayType(T.IntegerType()))
        def ids_of(toks: pa.Array) -> pa.Array:
            words, offsets = flatten_lists(toks)
            ids = lookup_words(words, table.value)
            flat = pa.array(ids.astype(np.int32), pa.int32(), mask=ids < 0)
            return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), flat)

        return sents.withColumn("ids", ids_of("toks"))
    placed = sents.select(*key, F.posexplode("toks").alias("pos", "tok"))
    known = skew_safe_join(placed, vocab.select("tok", "id", "n"), "tok", "n", min(limit, BROADCAST_ROWS))
    by_pos = known.groupBy(*key).agg(
        F.map_from_entries(F.collect_list(F.struct("pos", "id"))).alias("__known")
    )
    # every position is listed, so the array keeps its length and order
    return (
        sents.join(by_pos, key, "left")
        .withColumn("ids", _ids_in_place(F.size("toks"), F.col("__known")))
        .drop("__known")
    )


def _ids_in_place(size, known):
    """NULL-padded array of ids from a (pos -> id) map, in one sort of the entries."""
    gaps = F.transform(
        F.array_except(F.sequence(F.lit(0), size - 1), F.coalesce(F.map_keys(known), F.array())),
        lambda p: F.struct(p.alias("pos"), F.lit(None).cast("int").alias("id")),
    )
    found = F.coalesce(F.map_entries(known), F.array())
    entries = F.transform(
        found, lambda e: F.struct(e["key"].alias("pos"), e["value"].cast("int").alias("id"))
    )
    return F.transform(F.array_sort(F.concat(entries, gaps)), lambda e: e["id"])
