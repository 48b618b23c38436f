"""Packing token ids into sequences of one length by first-fit decreasing.

Documents are dealt out at random and packed in groups of ``GROUP_DOCS``, each group by itself.  A document longer
than a sequence first gives whole sequences; what is left of it goes, longest first, into the first sequence with
room for it.  A tournament tree over the free room finds that sequence: each node holds the greatest room below it, so the
search walks from the root to the leftmost leaf that is large enough.  Room that then stays free is filled by cutting up
the pieces of the least filled sequences, and the last tokens of a group become sequences whose lengths are powers
of two, which need no padding.

Words of a text are encoded once and remembered: no rule of the tokenizer looks across white space.

Each row is a document of its own, whatever its id: null, shared and repeated ids are packed like others.  A null or empty
text has the closing id only.  Columns that are not kept are never read.  A task holds the open pieces of one group
(less than a sequence each) and one batch of texts.
"""

from __future__ import annotations

import json
import string
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEQUENCE, CLOSING_ID = 2048, 1
GROUP_DOCS = 4096
MEMO, MEMO_BYTES = 1 << 18, 64
# Fixed value: how the tokenizer at hand parts a text.
WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BATCH_BYTES = 4 << 20
PIECES = "start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def _byte_chars() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = (b for b in range(256) if b not in plain)
    return {b: chr(256 + i) for i, b in enumerate(other)} | {b: chr(b) for b in plain}


BYTE_CHARS, MARKS = _byte_chars(), string.punctuation.encode()


def _numbers(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """A tokenizer whose rules keep to words between white space, with a memory for short words.

    The memory has two generations: when the young one is full it becomes the old one, and words met again move
    up, so frequent words stay.  If the tokenizer splits by ``WORD_RULE``, Latin letters are one unit of it and ASCII marks
    behind them another, so such words skip its rules and go to its merges at once.
    """

    def __init__(self, model: str) -> None:
        from tokenizers import Tokenizer

        self.model, self.tokenizer = model, Tokenizer.from_str(model)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        rules = json.loads(model)
        steps = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        lowers = {"type": "Lowercase"} in ((rules.get("normalizer") or {}).get("normalizers") or [])
        self.known_rules = lowers and (steps[0].get("pattern") or {}).get("Regex") == WORD_RULE

    def __reduce__(self):
        return WordEncoder, (self.model,)

    def _ruled(self, word: bytes) -> bytes:
        return _numbers(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids)

    def _search(self, word: bytes) -> bytes:
        stem = word.rstrip(MARKS)
        letters = stem.decode("utf-8", "replace")
        # up to U+024F one letter is one code point and small letters are one too, but for that of U+0130
        if not (self.known_rules and letters.isalpha() and max(letters) < "\u0250" and "\u0130" not in letters):
            return self._ruled(word)
        ids = self.young.get(stem) if len(stem) < len(word) else None
        if ids is None:
            units = letters.lower().encode().decode("latin-1").translate(BYTE_CHARS)
            ids = _numbers([t.id for t in self.tokenizer.model.tokenize(units)])
        if len(stem) < len(word):
            marks = word[len(stem) :]
            if marks not in self.young:
                self.young[marks] = self._ruled(marks)
            ids += self.young[marks]
        return ids

    def encode(self, text: bytes) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit numbers."""
        words = text.split()
        missing = set(words).difference(self.young)
        if missing:
            if len(self.young) + len(missing) > MEMO:
                self.old, self.young, missing = self.young, {}, set(words)
            for word in missing:
                ids = self.old.get(word)
                self.young[word] = self._search(word) if ids is None else ids
        ids = b"".join(map(self.young.__getitem__, words))
        for word in missing:
            if len(word) > MEMO_BYTES:
                del self.young[word]
        return ids


class RoomTree:
    """Tournament tree over the free room of ``n`` sequences, all empty at first."""

    def __init__(self, n: int, room: int) -> None:
        self.leaves = 1 << max(n - 1, 0).bit_length()
        self.most = [room] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Take ``size`` from the first sequence with as much room and return its number."""
        most, at = self.most, 1
        while at < self.leaves:
            at *= 2
            if most[at] < size:
                at += 1
        leaf = at - self.leaves
        most[at] -= size
        while at > 1:
            at //= 2
            best = max(most[2 * at], most[2 * at + 1])
            if most[at] == best:
                break
            most[at] = best
        return leaf


def first_fit_decreasing(sizes: Sequence[int], room: int) -> list[list[int]]:
    """Numbers of the items in each sequence; longest items first, ties in their order."""
    tree, bins = RoomTree(len(sizes), room), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.place(sizes[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


def pack(sizes: Sequence[int], room: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start in it, length): all of length ``room`` but some whose lengths are powers of two.

    Items are no longer than ``room``.  They stay whole but for those that fill gaps or the last sequences.
    """
    bins = first_fit_decreasing(sizes, room)
    fill = [sum(sizes[i] for i in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda b: -fill[b])
    whole, rest = divmod(sum(fill), room)
    # what stands in the least filled sequences, longest last so that long pieces fill long gaps
    loose = sorted(((sizes[i], i, 0) for b in order[whole:] for i in bins[b]), key=lambda p: p[0])

    def take(amount: int) -> Iterator[tuple[int, int, int]]:
        while amount:
            size, item, start = loose.pop()
            used = min(size, amount)
            if used < size:
                loose.append((size - used, item, start + used))
            amount -= used
            yield item, start, used

    packed = [[(i, 0, sizes[i]) for i in bins[b]] + list(take(room - fill[b])) for b in order[:whole]]
    packed += [list(take(1 << bit)) for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]
    return packed


class _Packer:
    """The open group of one task and the rows it has packed."""

    def __init__(self, room: int, group: int) -> None:
        self.room, self.group = room, group
        self.next_sequence = TaskContext.get().partitionId() << 40
        self.open: list[tuple[tuple, int, bytes, int]] = []
        self.rows: list[tuple] = []
        self.bytes = 0

    def _give(self, kept: tuple, start: int, ids: bytes, tokens: int, offset: int) -> None:
        self.rows.append((*kept, start, len(ids) // 4, ids, tokens, self.next_sequence, offset))
        self.bytes += len(ids) + 64

    def add(self, kept: tuple, ids: bytes) -> None:
        tokens, step = len(ids) // 4, 4 * self.room
        whole = len(ids) // step * step
        for at in range(0, whole, step):
            self._give(kept, at // 4, ids[at : at + step], tokens, 0)
            self.next_sequence += 1
        if whole < len(ids):
            self.open.append((kept, whole // 4, ids[whole:], tokens))
            if len(self.open) >= self.group:
                self.close()

    def close(self) -> None:
        for sequence in pack([len(p[2]) // 4 for p in self.open], self.room):
            offset = 0
            for item, start, length in sequence:
                kept, begin, ids, tokens = self.open[item]
                self._give(kept, begin + start, ids[4 * start : 4 * (start + length)], tokens, offset)
                offset += length
            self.next_sequence += 1
        self.open.clear()

    def take(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = zip(*self.rows) if self.rows else [()] * len(schema)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
        self.rows, self.bytes = [], 0
        return batch


def pack_documents(
    docs: DataFrame, model: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    room: int = SEQUENCE, closing: int = CLOSING_ID, group: int = GROUP_DOCS, seed: int = 1,
) -> DataFrame:
    """One row per piece: the columns ``keep``, start (ids of its document before it), length, ids (binary, little-endian
    unsigned 32-bit numbers), doc_tokens (with the closing id), sequence_id and offset in that sequence.

    ``model`` is the path of a tokenizer file, read on the driver.  Sequences are filled without gaps, to ``room`` or to a power
    of two.  ``keep`` must not name the new columns or hold one twice.
    """
    spark = docs.sparkSession
    with open(model, encoding="utf-8") as file:
        encoder = spark.sparkContext.broadcast(WordEncoder(file.read()))
    last = np.array([closing], "<u4").tobytes()
    schema = T.StructType([*(docs.schema[c] for c in keep), *T.StructType.fromDDL(PIECES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, types, encode = _Packer(room, group), None, encoder.value.encode
        for batch in batches:
            if types is None:
                names = [(f.name, f.type) for f in batch.column(0).type]
                numbers = [("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())]
                types = pa.schema([*names, *numbers, ("sequence_id", pa.int64()), ("offset", pa.int64())])
            rows = zip(*(c.to_pylist() for c in batch.column(0).flatten()))
            for row, body in zip(rows, batch.column(1)):
                packer.add(row, encode(body.as_py() or b"") + last)
                if packer.bytes > BATCH_BYTES:
                    yield packer.take(types)
        if types is not None:
            packer.close()
            yield packer.take(types)

    # dealt round robin, so equal rows spread; sorted by a hash, so that a lost task packs the same again
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    source = docs.select(F.struct(*keep).alias("kept"), docs[text].cast("binary").alias("body")).repartition(parts)
    mixed = source.sortWithinPartitions(F.xxhash64(F.lit(seed), *source.columns))
    return mixed.mapInArrow(run, schema)
