"""Periodic runs: stretches of words that repeat themselves at least four times over.

A run is a stretch with smallest period ``p`` and at least ``max(6, 4 * p)`` words that no neighbouring
word extends keeping ``p``.  Runs are found by string synchronising sets.  At the scale ``t`` (8, 16, 32, ...)
a position is chosen if the least hash of the ``t + 1`` windows of ``t`` words that begin at it and after it
stands first or last among them.  The choice depends on the next ``2 * t`` words only, so equal contexts
are chosen alike, and each ``t`` positions in a row hold a chosen one unless the words there have a period of
``t / 4`` or less.  In a run of period ``p``, ``t <= p < 2 * t``, some chosen position therefore returns ``p`` words
later as the next one with the same context: neighbouring equal contexts propose all periods.  Windows of highly
periodic regions would be chosen too often and take no part; those regions are the runs of period ``t / 4`` or
less, known from smaller scales.  Periods under 8 come from comparing the words with themselves 1 to 7 places on.

Proposals are stretched and compared word by word, so each run given out is exact; 64-bit hashes only decide
which positions are looked at, and equal words never differ in them.

A null or empty text has no words and no runs.  Rows are judged one by one: repeated rows, shared or null ids and
further columns of any name make no difference.  A text of n words takes memory of order n and
time of order n log² n, whatever it holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.llm.words import let, space_words

MIN_WORDS, MIN_TIMES = 6, 4
FIRST_SCALE = 8
# Words that are searched together; a longer text is searched alone.
CHUNK_WORDS = 1 << 18
NEW = "n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _least_length(period):
    return np.maximum(MIN_WORDS, MIN_TIMES * period)


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).view(np.int8)))
    return edges[::2], edges[1::2]


def _runs_of_period(x: np.ndarray, period: int) -> np.ndarray:
    """Rows (start, end, period) of the stretches of ``x`` that are long enough for a run."""
    a, b = _stretches(x[:-period] == x[period:])
    long = b + period - a >= _least_length(period)
    return np.stack([a[long], b[long] + period, np.full(long.sum(), period)], 1)


def _highly_periodic(runs: np.ndarray, scale: int, size: int) -> np.ndarray:
    """Which windows of ``scale`` words have a period of ``scale / 4`` or less."""
    inside = runs[(runs[:, 2] * 4 <= scale) & (runs[:, 1] - runs[:, 0] >= scale)]
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, inside[:, 0], 1)
    np.add.at(edge, inside[:, 1] - scale + 1, -1)
    return np.cumsum(edge[:-1]) > 0


def synchronising_set(window: np.ndarray, scale: int, skip: np.ndarray) -> np.ndarray:
    """Positions whose least window hash, of ``scale + 1`` windows from there, is their first or last; ``skip`` never counts."""
    key = np.where(skip, _NEVER, window)
    least, width = key, 1
    while width < scale:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(key) - scale], key[scale:])
    return np.flatnonzero(((key[: len(least)] == least) | (key[scale:] == least)) & (least != _NEVER))


def _proposals(place: np.ndarray, context: np.ndarray, scale: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, period): ``x[i] == x[i + period]`` from start to end, joined where neighbours touch."""
    order = np.argsort(context, kind="stable")
    place, context = place[order], context[order]
    step = np.diff(place)
    near = (context[1:] == context[:-1]) & (step >= scale) & (step < 2 * scale)
    start, period = place[:-1][near], step[near]
    order = np.lexsort((start, period))
    start, period = start[order], period[order]
    if not len(start):
        return
    new = np.concatenate(([True], (np.diff(period) != 0) | (np.diff(start) > 2 * scale)))
    last = np.concatenate((new[1:], [True]))
    yield from zip(start[new].tolist(), (start[last] + 2 * scale).tolist(), period[new].tolist())


def _stretch_out(x: np.ndarray, a: int, b: int, period: int) -> tuple[int, int]:
    """The stretch ``x[a:b] == x[a + period:b + period]`` made as long as it goes, in growing steps."""
    step = period
    while b + period < len(x):
        n = min(step, len(x) - period - b)
        same = x[b : b + n] == x[b + period : b + period + n]
        if not same.all():
            b += int(np.argmin(same))
            break
        b, step = b + n, 2 * step
    step = period
    while a > 0:
        n = min(step, a)
        same = (x[a - n : a] == x[a - n + period : a + period])[::-1]
        if not same.all():
            a -= int(np.argmin(same))
            break
        a, step = a - n, 2 * step
    return a, b


def find_runs(x: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs of the integers ``x``, by start, then period.

    Texts may stand one after another, parted by numbers that occur once: no run holds such a number.
    """
    x = np.asarray(x, np.int64)
    single = np.flatnonzero(np.bincount(x)[x] == 1) if len(x) else np.empty(0, np.int64)
    longest = int(np.diff(np.concatenate(([-1], single, [len(x)]))).max(initial=0)) - 1
    found = [_runs_of_period(x, p) for p in range(1, min(FIRST_SCALE, len(x) // MIN_TIMES + 1))]
    runs = np.concatenate([np.empty((0, 3), np.int64), *found])
    scale, window = 1, _mix(x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    while scale * MIN_TIMES <= longest:
        double = _mix(window[:-scale] * np.uint64(0xD6E8FEB86659FD93) + (window[scale:] ^ (window[scale:] >> np.uint64(32))))
        if scale >= FIRST_SCALE:
            place = synchronising_set(window, scale, _highly_periodic(runs, scale, len(window)))
            more = []
            for a, b, period in _proposals(place, double[place], scale):
                a, b = _stretch_out(x, a, b, period)
                if b + period - a >= _least_length(period):
                    exact = _runs_of_period(x[a : b + period], period)
                    more += (exact + [a, a, 0]).tolist()
            runs = np.concatenate([runs, np.array(more, np.int64).reshape(-1, 3)])
        scale, window = 2 * scale, double
    # one stretch has one smallest period, which divides the others found for it
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.concatenate(([True], (np.diff(runs[:, :2], axis=0) != 0).any(axis=1)))[: len(runs)]
    runs = runs[first]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return np.stack([runs[:, 0], runs[:, 1] - runs[:, 0], runs[:, 2]], 1)


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers, each text followed by a number of its own; where each text starts."""
    known: dict[bytes, int] = {}
    for words in texts:
        known |= dict.fromkeys(words, 0)
    known = dict(zip(known, range(len(known))))
    starts = np.concatenate(([0], np.cumsum([len(w) + 1 for w in texts])))
    x = np.empty(starts[-1], np.int64)
    for i, words in enumerate(texts):
        x[starts[i] : starts[i + 1] - 1] = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        x[starts[i + 1] - 1] = len(known) + i
    return x, starts


def _collapsed(texts: list[list[bytes]], starts: np.ndarray, runs: np.ndarray) -> list[bytes]:
    """Each text without the words that a run holds after its first period, joined by one space."""
    edge = np.zeros(starts[-1] + 1, np.int32)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(edge[:-1]) == 0
    touched = set((np.searchsorted(starts, runs[:, 0], "right") - 1).tolist())
    return [
        b" ".join(compress(words, kept[starts[i] : starts[i + 1] - 1].tolist()) if i in touched else words)
        for i, words in enumerate(texts)
    ]


def _chunks(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of about ``CHUNK_WORDS`` words together, alike in length so that they need the same scales."""
    order = np.argsort(sizes, kind="stable")
    chunk, words = [], 0
    for i in order.tolist():
        if chunk and words + sizes[i] > CHUNK_WORDS:
            yield np.array(chunk)
            chunk, words = [], 0
        chunk.append(i)
        words += int(sizes[i]) + 1
    if chunk:
        yield np.array(chunk)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, last = batch.column(0), batch.column(1)
        names = [f.name for f in kept.type]
        # rough word counts first, so that words are held for one chunk at a time
        rough = np.array([0 if v is None else v // 4 for v in pa.compute.binary_length(last).to_pylist()], np.int64)
        for rows in _chunks(rough):
            taken = pa.array(rows)
            texts = [(t or b"").split() for t in last.take(taken).to_pylist()]
            x, starts = _numbered(texts)
            runs = find_runs(x)
            text_of = np.searchsorted(starts, runs[:, 0], "right") - 1
            offsets = np.searchsorted(text_of, np.arange(len(texts) + 1)).astype(np.int32)
            fields = [runs[:, 0] - starts[text_of], runs[:, 1], runs[:, 2]]
            struct = pa.StructArray.from_arrays([pa.array(f, pa.int64()) for f in fields], ["start", "length", "period"])
            new = [
                pa.array([len(w) for w in texts], pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), struct),
                pa.array(_collapsed(texts, starts, runs), pa.binary()).view(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays([*kept.take(taken).flatten(), *new], names=[*names, "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, n_words, ``runs`` (start, length and period in words, by start, then period) and ``collapsed``.

    Words are what stands between ASCII white space.  ``collapsed`` is the text of the words that no run holds after its
    first period, joined by one space; never null.  ``keep`` must not name the three new columns or hold one twice.
    """
    schema = T.StructType([*(docs.schema[c] for c in keep), *T.StructType.fromDDL(NEW)])
    return docs.select(F.struct(*keep).alias("kept"), docs[text].cast("binary").alias("body")).mapInArrow(_search, schema)


def repeat_tail(doc_id: Column, text: Column) -> Column:
    """``text``, or for one id in ten (by its checksum) its words with the tail repeated from a place and at a period that follow from the checksum.

    A null id keeps its text.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        start = F.pmod(g, F.greatest(n, F.lit(1)))
        period = F.lit(1) + F.floor((n - start) / (F.lit(3) + g % 8))
        cells = F.transform(F.array(F.struct(start.alias("a"), period.alias("p"))), lambda c: F.transform(
            words, lambda w, i: F.when(i < c["a"], w).otherwise(F.get(words, (c["a"] + (i - c["a"]) % c["p"]).cast("int")))))
        return F.array_join(cells[0], " ")

    return F.when(h % 10 == 0, let(space_words(text), repeated)).otherwise(text)


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, number of runs, the longest one (ties: first start, then least period) and digests of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"), longest.alias("_best"),
    ).select(
        "doc_id", "n_runs", (-F.col("_best.s")).alias("start"), F.col("_best.l").alias("length"), (-F.col("_best.p")).alias("period"),
        F.floor(F.lit(1000) * F.col("_best.l") / -F.col("_best.p")).cast("bigint").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )
