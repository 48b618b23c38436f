"""Phrase collocation mining with counting quotient filters.

Texts are split into pieces and words per language; words that occur often enough get codes, unique over languages.
Phrases of two words are counted first, then of three and so on: each task counts its part of the corpus in
counting quotient filters, one per shard, and the sorted filters of a shard are merged.  A phrase can only be frequent if
both phrases it contains of one word less are, so a bitmap of the frequent ones, bounded in size, tells which places
need counting at all.  A bit that is set by chance costs a counter, never a result.

While the frequent words fit into ``TABLE_WORDS``, codes are dense numbers from a table sent to the workers.  Beyond, a code is
a 64-bit hash and a bitmap of frequent words stands for the table; the hash is first checked to part
every frequent word from all other words of the corpus, and drawn anew if it does not, so codes are exact either way.

Scores are computed in whole numbers of up to 38 digits.  A null text is empty, a null language is ``und``, repeated
rows count each time, other columns are never read.  Empty tables give no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.quotient import CountingQuotientFilter, Shape, U, merge, mix, shards
from wordloom.operators.joins import skew_safe_join
from wordloom.operators.ordering import dense_index
from wordloom.sources.scratch import materialize

MIN_COUNT, LONGEST, TOP = 100, 5, 2000
TABLE_WORDS = 1_000_000
BITMAP_BITS = 28  # a bitmap has 2**28 bits (32 MB) at most
FLUSH = 1 << 19  # n-grams counted at once in a task
STRETCH = 1 << 18  # codes in a row of the encoded corpus
MERGE = 1 << 22  # entries of waiting filters
SHARD_TOKENS = 1 << 22
NO_LANG = "und"

# Piece ends become full stops, which no word holds, and A-Z small letters.
_TABLE = bytes(ord(".") if chr(b) in ".,;:!?\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))


def pieces_of(text: bytes | None) -> list[bytes]:
    """The words of ``text``, with a full stop wherever a piece ends."""
    return (text or b"").translate(_TABLE).replace(b".", b" . ").split()


class Bits(NamedTuple):
    """A bitmap over the first ``width`` bits of 64-bit hashes."""

    words: np.ndarray
    width: int

    def test(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> U(64 - self.width)
        return (self.words[(at >> U(6)).astype(np.int64)] >> (at & U(63))) & U(1) == 1


def _bitmap(table: DataFrame, size: int) -> Bits:
    """Bits of the column ``hash`` of ``size`` rows.  What reaches the driver is bounded by the bitmap, not by the rows."""
    width = min(BITMAP_BITS, max(16, (64 * size).bit_length()))
    at = F.shiftrightunsigned("hash", 64 - width)
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int"))
    rows = table.select(at.alias("at")).groupBy((F.col("at") / 64).cast("bigint").alias("word")).agg(F.bit_or(one).alias("bits")).toArrow()
    words = np.zeros(1 << (width - 6), U)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().astype(np.int64).view(U)
    return Bits(words, width)


def _hash_windows(codes: np.ndarray, words: int) -> np.ndarray:
    """A hash of each window of ``words`` codes; also of a single one."""
    n = len(codes) - words + 1
    total = np.zeros(max(n, 0), U)
    for i in range(words if n > 0 else 0):
        total = mix(total * U(0xD6E8FEB86659FD93) + codes[i : i + n] + U(1))
    return total


def _bodies(docs: DataFrame, text: str, lang: str) -> DataFrame:
    return docs.select(F.coalesce(docs[lang].cast("string"), F.lit(NO_LANG)).alias("lang"), docs[text].cast("binary").alias("body"))


def word_counts(bodies: DataFrame) -> DataFrame:
    """``(lang, word, n)`` of all words, counted in the tasks before they are shuffled.  A written table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}

        def give() -> pa.RecordBatch:
            langs = [lang for lang, words in found.items() for _ in words]
            words = [word for counter in found.values() for word in counter]
            numbers = [n for counter in found.values() for n in counter.values()]
            found.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(words, pa.binary()).view(pa.string()), pa.array(numbers, pa.int64())],
                names=["lang", "word", "n"],
            )

        for batch in batches:
            for lang, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                counter = found.setdefault(lang, Counter())
                counter.update(pieces_of(body.as_py()))
                counter.pop(b".", None)
                if sum(map(len, found.values())) > STRETCH:
                    yield give()
        yield give()

    partial = bodies.mapInArrow(count, "lang string, word string, n bigint")
    return materialize(partial.groupBy("lang", "word").agg(F.sum("n").alias("n")), "word_counts")


class Coding(NamedTuple):
    """Codes of the frequent words: ``vocabulary(code, lang, word, f)``, their bits, and what turns words into codes in a task."""

    vocabulary: DataFrame
    bits: int
    lookup: Callable[[], Callable[[str], Callable[[bytes], int]]]


def _table_codes(frequent: DataFrame, size: int) -> Coding:
    order = [F.col("f").desc(), F.col("lang"), F.col("word")]
    vocabulary = dense_index(frequent, order, "at").select((F.col("at") + 1).cast("bigint").alias("code"), "lang", "word", "f")
    vocabulary = materialize(vocabulary, "phrase_words")
    rows = vocabulary.select("lang", F.col("word").cast("binary").alias("word"), "code").toArrow().to_pydict()
    table: dict[str, dict[bytes, int]] = {}
    for lang, word, code in zip(rows["lang"], rows["word"], rows["code"]):
        table.setdefault(lang, {})[word] = code
    sent: Broadcast = frequent.sparkSession.sparkContext.broadcast(table)
    return Coding(vocabulary, max(size.bit_length(), 1), lambda: lambda lang: lambda word, known=sent.value.get(lang, {}): known.get(word, 0))


class _HashCodes(dict):
    """word to code, 0 for words whose bit is not set; forgets all when it has grown too large."""

    def __init__(self, prefix: bytes, bits: Bits) -> None:
        self.prefix, self.bits = prefix, bits

    def __missing__(self, word: bytes) -> int:
        import xxhash

        code = 0
        if word != b".":
            code = xxhash.xxh64_intdigest(self.prefix + word, 42)
            at = code >> (64 - self.bits.width)
            if not int(self.bits.words[at >> 6]) >> (at & 63) & 1:
                code = 0
        if len(self) > STRETCH:
            self.clear()
        self[word] = code
        return code


def _hash_codes(counts: DataFrame, size: int, min_count: int) -> Coding:
    """Codes by a hash that no frequent word shares with any other word."""
    for seed in range(100):
        code = F.xxhash64(F.concat(F.lit(f"{seed} "), "lang", F.lit(" "), "word"))
        coded = counts.withColumn("code", code)
        shared = coded.groupBy("code").agg(F.count("*").alias("words"), F.max("n").alias("n"))
        if shared.where((F.col("words") > 1) & (F.col("n") >= min_count) | (F.col("code") == 0)).isEmpty():
            break
    else:
        raise RuntimeError("no hash parts the words")
    vocabulary = coded.where(F.col("n") >= min_count).select("code", "lang", "word", F.col("n").alias("f"))
    vocabulary = materialize(vocabulary, "phrase_words")
    bits = counts.sparkSession.sparkContext.broadcast(_bitmap(vocabulary.select(F.col("code").alias("hash")), size))

    def lookup() -> Callable[[str], Callable[[bytes], int]]:
        known: dict[str, _HashCodes] = {}
        return lambda lang: known.setdefault(lang, _HashCodes(f"{seed} {lang} ".encode(), bits.value)).__getitem__

    return Coding(vocabulary, 64, lookup)


def encode(bodies: DataFrame, coding: Coding) -> DataFrame:
    """The corpus as stretches of word codes with a 0 wherever a phrase cannot go on; words that stand alone are left out.  A written table."""
    kind, lookup = "<u4" if coding.bits <= 32 else "<u8", coding.lookup

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code_of, parts, held = lookup(), [], 0

        def give() -> pa.RecordBatch:
            codes = np.concatenate(parts) if parts else np.empty(0, kind)
            some = codes != 0
            before, behind = np.concatenate(([False], some[:-1])), np.concatenate((some[1:], [False]))
            codes = np.where(some & (before | behind), codes, 0).astype(kind)
            codes = codes[(codes != 0) | np.concatenate(([False], codes[:-1] != 0))]
            return pa.RecordBatch.from_arrays([pa.array([codes.tobytes()], pa.binary()), pa.array([len(codes)], pa.int64())], names=["codes", "n"])

        for batch in batches:
            for lang, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = pieces_of(body.as_py())
                words.append(b".")
                parts.append(np.fromiter(map(code_of(lang), words), kind, len(words)))
                held += len(words)
                if held > STRETCH:
                    yield give()
                    parts, held = [], 0
        yield give()

    return materialize(bodies.mapInArrow(run, "codes binary, n bigint"), "phrase_codes")


def _codes(raw: bytes, bits: int) -> np.ndarray:
    return np.frombuffer(raw, "<u4" if bits <= 32 else "<u8").astype(U)


def count_phrases(corpus: DataFrame, shape: Shape, shard_bits: int, min_count: int, shorter: Bits | None) -> DataFrame:
    """``(codes, f, hash)`` of the phrases of ``shape`` that occur ``min_count`` times.  A written table."""
    k = shape.words
    sent = corpus.sparkSession.sparkContext.broadcast(shorter)

    def shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, places = [], 0

        def give() -> pa.RecordBatch:
            filters = shards(shape, np.concatenate(held), shard_bits) if held else []
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([f.shard for f in filters], pa.int32()), pa.array([f.to_bytes() for f in filters], pa.binary())], names=["shard", "filter"]
            )

        for batch in batches:
            for raw in batch.column(0):
                codes = _codes(raw.as_py(), shape.bits)
                n = len(codes) - k + 1
                if n <= 0:
                    continue
                good = np.logical_and.reduce([codes[i : i + n] != 0 for i in range(k)])
                if sent.value is not None:
                    part = sent.value.test(_hash_windows(codes, k - 1))
                    good &= part[:n] & part[1 : n + 1]
                at = np.flatnonzero(good)
                for first in range(0, len(at), FLUSH):
                    some = at[first : first + FLUSH]
                    held.append(np.stack([codes[some + i] for i in range(k)], 1))
                    places += len(some)
                    if places >= FLUSH:
                        yield give()
                        places = 0
        yield give()

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[CountingQuotientFilter] = []

        def give() -> pa.RecordBatch:
            codes, counts = np.empty((0, k), U), np.empty(0, np.int64)
            if waiting:
                whole = merge(waiting)
                often = whole.counts >= min_count
                codes, counts = shape.unpack(shape.restore(whole.keys()[often])), whole.counts[often]
                waiting.clear()
            hashes = _hash_windows(codes.reshape(-1), k)[::k] if len(codes) else np.empty(0, U)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1, dtype=np.int32) * k), pa.array(codes.reshape(-1).view(np.int64)))
            return pa.RecordBatch.from_arrays([lists, pa.array(counts, pa.int64()), pa.array(hashes.view(np.int64))], names=["codes", "f", "hash"])

        for batch in batches:
            for number, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if waiting and waiting[0].shard != number:
                    yield give()
                waiting.append(CountingQuotientFilter.from_bytes(data.as_py(), shape, number, shard_bits))
                if len(waiting) > 1 and sum(map(len, waiting[1:])) > max(MERGE, len(waiting[0])):
                    waiting[:] = [merge(waiting)]
        yield give()

    filters = corpus.select("codes").mapInArrow(shard, "shard int, filter binary")
    together = filters.repartition("shard").sortWithinPartitions("shard")
    return materialize(together.mapInArrow(unite, "codes array<bigint>, f bigint, hash bigint"), f"phrases_{k}")


def frequent_phrases(bodies: DataFrame, coding: Coding, min_count: int, longest: int) -> list[DataFrame]:
    """Tables ``(codes, f, hash)`` of the frequent phrases of 2, 3, ... words, as far as there are any."""
    corpus = encode(bodies, coding)
    tokens = corpus.agg(F.sum("n")).first()[0] or 0
    tasks = int(corpus.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    wanted = max(2 * tasks, tokens // SHARD_TOKENS)
    levels, shorter = [], None
    for k in range(2, longest + 1):
        shape = Shape(k, coding.bits)
        level = count_phrases(corpus, shape, min(wanted.bit_length(), shape.width, 30), min_count, shorter)
        levels.append(level)
        size = level.count()
        if not size:
            break
        shorter = _bitmap(level, size)
    return levels


def _named(phrases: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Add ``lang`` and ``phrase``, the words of ``codes`` joined by spaces."""
    placed = phrases.select("codes", "a", F.posexplode("codes").alias("at", "code"))
    words = skew_safe_join(placed, vocabulary, "code", "f")
    found = words.groupBy("codes", "a").agg(F.min("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("_words"))
    return found.withColumn("phrase", F.array_join(F.col("_words.word"), " ")).drop("_words")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP,
    table_words: int = TABLE_WORDS,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of each language.

    ``a``, ``l``, ``r`` and ``n`` are the occurrences of the phrase, of its two parts and of all words; the cut into parts is the one of least
    score ``floor(1000 a n / (l r))``, the first of equal ones.  Phrases inside a longer one that occurs as often are left out.
    Order: score, then a, both descending, then the phrase's bytes.
    """
    bodies = _bodies(docs, text, lang)
    counts = word_counts(bodies)
    totals = materialize(counts.groupBy("lang").agg(F.sum("n").alias("n")), "phrase_totals")
    frequent = counts.where(F.col("n") >= min_count).withColumnRenamed("n", "f")
    size = frequent.count()
    coding = _table_codes(frequent, size) if size <= table_words else _hash_codes(counts, size, min_count)
    levels = frequent_phrases(bodies, coding, min_count, longest)
    phrases = reduce(DataFrame.unionByName, levels).select("codes", F.col("f").alias("a"))
    # one word more and as frequent: enough to look at, for what stands between two equally frequent phrases is as frequent
    longer = reduce(DataFrame.unionByName, levels[1:], levels[0].limit(0)).select("codes", F.col("f").alias("a"))
    inner = [F.slice("codes", F.lit(1), F.size("codes") - 1), F.slice("codes", F.lit(2), F.size("codes") - 1)]
    shadowed = longer.select("a", F.explode(F.array(*inner)).alias("codes")).distinct()
    named = materialize(_named(phrases.join(shadowed, ["codes", "a"], "left_anti"), coding.vocabulary), "phrases_named")
    parts = coding.vocabulary.select(F.array("code").alias("codes"), "f").unionByName(phrases.select("codes", F.col("a").alias("f")))
    parts = materialize(parts, "phrase_parts")
    cuts = named.select("codes", "a", F.explode(F.sequence(F.lit(1), F.size("codes") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("codes", F.lit(1), F.col("k"))).withColumn("right", F.slice("codes", F.col("k") + 1, F.size("codes") - F.col("k")))
    cuts = skew_safe_join(cuts, parts.select(F.col("codes").alias("left"), F.col("f").alias("l")), "left", "l")
    cuts = skew_safe_join(cuts, parts.select(F.col("codes").alias("right"), F.col("f").alias("r")), "right", "r")
    whole = skew_safe_join(cuts.join(named, ["codes", "a"]), totals, "lang", "n")
    wide = {c: F.col(c).cast("decimal(18,0)") for c in ("a", "n", "l", "r")}
    score = F.call_function("div", wide["a"] * wide["n"] * F.lit(1000).cast("decimal(4,0)"), wide["l"] * wide["r"])
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = whole.groupBy("lang", "phrase", "a", "n").agg(best)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= top).select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
