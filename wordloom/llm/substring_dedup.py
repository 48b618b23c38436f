"""Substring dedup: repeated lines or paragraphs are kept where they rank first and removed elsewhere.

A unit is normalised to its lower-cased words, so case, punctuation and spacing do not matter,
and named by a 128-bit digest.  Units of fewer than ``min_words`` words (by default: without a word) are left alone.  The
occurrence with the least (rank, row key, offset) stays; repeats inside one text go, too.

Digests are reduced to their first occurrence by an aggregation that combines before its
shuffle, and the survivors are regrouped by document: no group of equal units ever stands in
one task.  Null texts stay null, without units.  Rows without a key keep their text and are no
earlier occurrence of any other; rows that repeat a key and a text are one occurrence.  The other
columns of the input are not returned.

``unit="both"`` compares lines and paragraphs at once and removes lines: one goes if it stood
earlier as a line or if its paragraph's words stood earlier as a unit, however they were broken
into lines.  This is the default, so passages made of short lines go, too.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 1
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
BREAKS = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[ \t\r]*\n[ \t\r\n]*")}


def units(text: str, unit: str) -> Iterator[tuple[int, int]]:
    """Start and end of each unit, in code points, without the break behind it."""
    start = 0
    for found in BREAKS[unit].finditer(text):
        yield start, found.start()
        start = found.end()
    yield start, len(text)


def in_units(text: str, unit: str, min_words: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Place, start, end and digest of the units with enough words; places order by start, lines before paragraphs."""
    lines = []
    for start, end in units(text, "line" if unit == "both" else unit):
        if (named := digest(text[start:end], min_words)) is not None:
            yield 2 * start, start, end, named
        lines.append((start, end))
    if unit != "both":
        return
    at = 0
    for start, end in units(text, "paragraph"):
        while at < len(lines) and lines[at][1] <= start:
            at += 1
        stop = at
        while stop < len(lines) and lines[stop][0] < end:
            stop += 1
        # one line with words is the paragraph itself
        if sum(WORD.search(text[a:b].encode().lower()) is not None for a, b in lines[at:stop]) > 1:
            if (named := digest(text[start:end], min_words)) is not None:
                yield 2 * start + 1, start, end, named


def digest(piece: str, min_words: int) -> bytes | None:
    words = WORD.findall(piece.encode().lower())
    return hashlib.md5(b" ".join(words), usedforsecurity=False).digest() if len(words) >= min_words else None


def inside(lines: list[tuple[int, int]], spans: list[tuple[int, int]]) -> set[tuple[int, int]]:
    """The lines that share a character with one of ``spans``, which nest or stand apart."""
    found, at, reach = set(), 0, 0
    ordered = sorted(spans)
    for line in lines:
        while at < len(ordered) and ordered[at][0] < line[1]:
            reach = max(reach, ordered[at][1])
            at += 1
        if line[0] < min(line[1], reach):
            found.add(line)
    return found


def dedup_units(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    unit: str = "both",
    min_words: int = MIN_WORDS,
    rank: str | None = None,
) -> DataFrame:
    """Per row: key, n_units, n_removed, removed and kept (spans ``start:end`` of the original), text (what is left)."""
    if unit not in (*BREAKS, "both"):
        raise ValueError(f"unit is {' or '.join(BREAKS)} or both")

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (named, order, row, tag, place)
                for row, order, tag, body in zip(batch["key"], batch["rank"], batch["tag"], batch["text"])
                if body is not None
                for place, _, _, named in in_units(body, unit, min_words)
            ]
            yield pd.DataFrame(rows, columns=["digest", "rank", "key", "tag", "place"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for row, free, body, first in zip(batch["key"], batch["free"], batch["text"], batch["first"]):
                if body is None:
                    rows.append((row, 0, 0, "", "", None))
                    continue
                spans = list(units(body, "line" if unit == "both" else unit))
                stay = set() if first is None else set(first)
                again = [] if free else [(a, b) for place, a, b, _ in in_units(body, unit, min_words) if place not in stay]
                dropped = set(again) if unit != "both" else inside(spans, again)
                gone = [s for s in spans if s in dropped]
                left = [s for s in spans if s not in dropped]
                # each unit left keeps the break that stood behind it
                after = dict(zip((s[0] for s in spans), [s[0] for s in spans[1:]] + [len(body)]))
                rest = "".join(body[a : after[a]] for a, _ in left) if gone else body
                show = lambda found: ",".join(f"{a}:{b}" for a, b in found)
                rows.append((row, len(spans), len(gone), show(gone), show(left), rest))
            yield pd.DataFrame(rows, columns=["key", "n_units", "n_removed", "removed", "kept", "text"])

    kind = docs.schema[key].dataType.simpleString()
    order = F.col(rank) if rank else F.lit(0)
    order_kind = docs.schema[rank].dataType.simpleString() if rank else "int"
    source = docs.select(F.col(key).alias("key"), order.alias("rank"), F.col(text).alias("text"))
    # rows of one key are told apart by their texts
    keyed = source.where("key IS NOT NULL").withColumn("tag", F.xxhash64("text"))
    occurrences = keyed.mapInPandas(hashed, f"digest binary, rank {order_kind}, key {kind}, tag bigint, place bigint")
    first = occurrences.groupBy("digest").agg(F.min(F.struct("rank", "key", "tag", "place")).alias("at"))
    kept = first.groupBy(F.col("at.key").alias("key"), F.col("at.tag").alias("tag")).agg(F.collect_list("at.place").alias("first"))
    joined = keyed.select("key", "tag", F.lit(False).alias("free"), "text").join(kept, ["key", "tag"], "left").drop("tag")
    lost = source.where("key IS NULL").select("key", F.lit(True).alias("free"), "text", F.lit(None).cast("array<bigint>").alias("first"))
    shape = f"key {kind}, n_units bigint, n_removed bigint, removed string, kept string, text string"
    return joined.mapInPandas(cut, shape).unionByName(lost.mapInPandas(cut, shape)).withColumnRenamed("key", key)
