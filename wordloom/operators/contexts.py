"""Context windows that skip out-of-vocabulary words, and language-model examples."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.functions.columns import once
from wordloom.functions.hashing import hash32
from wordloom.operators.corpus import SENTENCE_KEY
from wordloom.operators.ordering import with_offsets
from wordloom.sources.scratch import materialize


def target_context_pairs(encoded: DataFrame, before: int = 2, after: int = 2) -> DataFrame:
    """``pairs(.., pos, target, ctx)``: one row per in-vocabulary word.

    Words outside the vocabulary are dropped before the windows are cut, so a window
    reaches past them; it ends with the sentence and may be empty.
    """
    keep = [c for c in encoded.columns if c not in ("toks", "ids")]
    # narrow: the words of a sentence are two array cells, their places and themselves
    spots = F.filter(F.sequence(F.lit(0), F.size("toks") - 1), lambda p: F.get("ids", p).isNotNull())
    words = F.filter("toks", lambda t, p: F.get("ids", p).isNotNull())
    # outer, so that no filter on the places is made below, where they would be found anew
    each = encoded.select(*keep, words.alias("__words"), F.posexplode_outer(spots).alias("__i", "pos"))
    i = F.col("__i")
    ctx = F.slice("__words", F.greatest(i - before, F.lit(0)) + 1, F.least(i, F.lit(before)))
    if after:
        ctx = F.concat(ctx, F.slice("__words", i + 2, F.lit(after)))
    return each.where(F.col("pos").isNotNull()).select(*keep, "pos", F.get("__words", i).alias("target"), ctx.alias("ctx"))


def lm_examples(
    encoded: DataFrame,
    vocab_size: int,
    context_size: int = 4,
    group: str | None = None,
) -> DataFrame:
    """``examples(.., ex_id, x_idx, y)``: words with a full context, numbered in corpus order.

    Context slot ``i`` holding word ``w`` becomes position ``i * V + w`` of the concatenated
    one-hot vector, which is never built.  Numbering sorts sentences, not examples, and
    restarts for each value of ``group`` (the data split).
    """
    keep = [*SENTENCE_KEY, *([group] if group else [])]
    known = F.filter("ids", lambda w: w.isNotNull())
    sized = encoded.select(*keep, once("__ids", known)).withColumn(
        "__n", F.greatest(F.size("__ids") - context_size, F.lit(0))
    )
    # numbering reads its rows twice: once for the ranges, once to sort them
    coded = materialize(sized.where(F.col("__n") > 0), "coded")
    placed = with_offsets(coded, [F.col(c) for c in SENTENCE_KEY], "__first", weight="__n", group=group)
    # plain expressions for each word of a window: a function over arrays would be interpreted
    grams = placed.select(*keep, "__first", "__ids", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)).alias("__i"))
    x_idx = F.array(*[
        (F.get("__ids", F.col("__i") + j) + F.lit(j * vocab_size)).cast("bigint") for j in range(context_size)
    ])
    return grams.select(
        *keep,
        (F.col("__first") + F.col("__i")).alias("ex_id"),
        x_idx.alias("x_idx"),
        F.get("__ids", F.col("__i") + context_size).alias("y"),
    )


def one_hot_positions(examples: DataFrame, vocab_size: int, key: list[str]) -> DataFrame:
    """``(key, slot, word_id)``: the words behind the one-positions."""
    words = F.transform("x_idx", lambda x: x % vocab_size)
    return examples.select(*key, F.posexplode(words).alias("slot", "word_id"))


def one_hot_vectors(examples: DataFrame, vocab_size: int, context_size: int) -> DataFrame:
    """Add ``x``: the concatenated one-hot input as a sparse vector, for use with ``pyspark.ml``."""
    slots = [f"__slot{i}" for i in range(context_size)]
    hots = [f"{slot}_hot" for slot in slots]
    # the largest category fixes the width of a slot, so the examples are not read to find it
    widest = examples.sparkSession.range(1).select(*[F.lit(vocab_size - 1).alias(slot) for slot in slots])
    encoder = OneHotEncoder(inputCols=slots, outputCols=hots, dropLast=False).fit(widest)
    words = [(F.col("x_idx")[i] % vocab_size).cast("int").alias(slot) for i, slot in enumerate(slots)]
    encoded = encoder.transform(examples.select("*", *words))
    return VectorAssembler(inputCols=hots, outputCol="x").transform(encoded).drop(*slots, *hots)


def minibatches(
    examples: DataFrame,
    batch_size: int = 64,
    per_file: int = 100,
    group: str | None = None,
) -> DataFrame:
    """Add ``mb_id`` and ``file_ix``; drop the last batch if incomplete, keep the last file."""
    by = [group] if group else []
    sizes = examples.groupBy(*by).agg(F.count(F.lit(1)).alias("__total"))
    if group:
        joined = examples.join(F.broadcast(sizes), group)  # one row per split
    else:
        joined = examples.withColumn("__total", F.lit(sizes.first()["__total"]))
    full = F.floor(F.col("__total") / batch_size)
    numbered = joined.withColumn("mb_id", F.floor(F.col("ex_id") / batch_size))
    return (
        numbered.where(F.col("mb_id") < full)
        .withColumn("file_ix", F.floor(F.col("mb_id") / per_file).cast("int"))
        .drop("__total")
    )


def shuffle_in_batch(batched: DataFrame, seed: int, group: str | None = None) -> DataFrame:
    """Add ``slot``: a repeatable shuffle of the examples inside each mini-batch."""
    by = [*([group] if group else []), "mb_id"]
    mixed = [hash32(seed, F.col("ex_id")), F.col("ex_id")]
    return batched.withColumn(
        "slot", F.row_number().over(Window.partitionBy(*by).orderBy(*mixed)) - 1
    )


def shuffle_in_file(batched: DataFrame, seed: int, group: str | None = None) -> DataFrame:
    """Add ``file_slot``: a repeatable shuffle of the mini-batches inside each file.

    Ranked on one row per mini-batch; the window holds one file's batches.
    """
    by = [group] if group else []
    batches = batched.groupBy(*by, "file_ix", "mb_id").agg(F.count("*").alias("n_examples"))
    mixed = [hash32(seed, F.col("mb_id")), F.col("mb_id")]
    window = Window.partitionBy(*by, "file_ix").orderBy(*mixed)
    return batches.withColumn("file_slot", F.row_number().over(window) - 1)


def fixed(examples: DataFrame) -> DataFrame:
    """The examples as a written table, read again by every epoch."""
    return materialize(examples, "examples")
