"""SentencePiece encoding and decoding by a streaming Viterbi search.

The best path is the one of greatest total piece score.  The search reads a text block by block and keeps, from the
last boundary whose ids are given out, one score and one backpointer per character, and as many again as the longest piece has
characters ahead.  When that has grown to twice what the last look left, it goes back from all boundaries ahead at
once; where their paths meet, the ids up to there are final and given out.  So each character is worked on a bounded number of
times.  In prose paths meet within a few characters and the window stays at its least size, ``WINDOW``; in a run of one
character, where paths of different phase may never meet, it grows with the run.

Between two characters that no piece holds side by side every path has a boundary.  The stretches between such
boundaries are searched on their own, all by the same search, and short ones are remembered.

A model of unigram type gives its own log-probabilities.  A merge (BPE) model only ranks its
pieces; they get the probability of their rank under Zipf's law, which is a parameter.  Ids then
differ in places from what merging would give, but always decode to the same text.

Characters without a piece become their UTF-8 bytes, so does the space mark itself where a text
contains it: decoding returns every text exactly.  A null text has null ids, an empty text none.  Rows are encoded one
by one: repeated rows, null or shared ids and columns of any name make no difference, an empty table gives none.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import log
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
MODEL = "piece_bpe_32k.model"
MEMO, MEMO_CHARS = 1 << 18, 48
WINDOW = 64
END, NEVER = "\uffff", float("-inf")  # behind the last character; of a boundary not reached
ROWS = 256  # rows encoded before they are handed on


@dataclass
class Pieces:
    """The pieces of a model.  ``scores``: piece to (id, log-probability); ``bytes``: id of each byte."""

    scores: dict[str, tuple[int, float]]
    bytes: list[int]
    unknown: float
    young: dict[str, bytes] = field(default_factory=dict, repr=False)
    old: dict[str, bytes] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        self.longest = max(map(len, self.scores))
        # every beginning of a piece, with the piece if it is one
        self.table = {piece[:i]: None for piece in self.scores for i in range(1, len(piece) + 1)} | self.scores
        self.table = {start: own and ((own[0],), own[1]) for start, own in self.table.items()}
        known = {c for piece in self.scores for c in piece}
        self.pairs = {piece[i : i + 2] for piece in self.scores for i in range(len(piece) - 1)}
        if any(MARK in piece.lstrip(MARK) for piece in self.scores):
            raise ValueError("a piece has the space mark behind another character")
        if END in known:
            raise ValueError("a piece holds the end mark")
        # a word with the marks before it: no piece goes on from it into the next
        self.cut = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n" if "\n" not in known else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.parts = {i: piece.replace(MARK, " ").encode() for piece, (i, _) in self.scores.items()}
        self.parts |= {i: bytes([b]) for b, i in enumerate(self.bytes)}

    def __reduce__(self):
        return Pieces, (self.scores, self.bytes, self.unknown)


def load_pieces(path: str | None = None, zipf: bool = True) -> Pieces:
    """Read a model file on the driver, by default the public one.  ``zipf``: score pieces by rank, as merge models need."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    size = model.get_piece_size()
    plain = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    total = log(sum(1 / r for r in range(1, len(plain) + 1)))
    rank = {i: r for r, i in enumerate(sorted(plain, key=lambda i: -model.get_score(i)), 1)}
    scores = {model.id_to_piece(i): (i, -log(rank[i]) - total if zipf else model.get_score(i)) for i in plain}
    single = {int(model.id_to_piece(i)[3:5], 16): i for i in range(size) if model.is_byte(i)}
    if len(single) != 256:
        raise ValueError("the model has no byte pieces")
    return Pieces(scores, [single[b] for b in range(256)], min(s for _, s in scores.values()) - 10)


class Search:
    """The search over one stretch: ``feed`` its blocks in order, then ``end`` it; both return ids that are final."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        self.base = 0  # the boundary up to which ids are given out; the lists begin there
        self.off, self.limit = 0, WINDOW  # characters searched since then, and when to look for a common boundary
        self.ahead = ""  # the text that is not searched yet
        self.best = [0.0] + [NEVER] * pieces.longest
        self.back: list[tuple[int, tuple[int, ...]]] = [(0, ())] * (pieces.longest + 1)

    def held(self) -> int:
        """Boundaries in the window."""
        return self.off + self.pieces.longest + 1

    def feed(self, block: str) -> list[int]:
        self.ahead += block
        return self._search(len(self.ahead) - self.pieces.longest + 1)

    def end(self) -> list[int]:
        return self._search(len(self.ahead)) + self._give(self.off)

    def _give(self, meet: int) -> list[int]:
        """The ids up to ``meet``, from where the window now begins."""
        path, at = [], meet
        while at:
            before, ids = self.back[at]
            path.append(ids)
            at = before - self.base
        self.best, self.back = self.best[meet:], self.back[meet:]
        self.base, self.off = self.base + meet, self.off - meet
        return [i for ids in reversed(path) for i in ids]

    def _meet(self) -> list[int]:
        """Give out what all paths to the boundaries ahead agree on."""
        last = self.off + self.pieces.longest
        live = {at for at in range(self.off, last + 1) if self.best[at] != NEVER}
        for at in range(last, -1, -1):
            if at in live:
                if len(live) == 1:
                    break
                live.remove(at)
                live.add(self.back[at][0] - self.base)
        found = self._give(at)
        self.limit = max(WINDOW, 2 * self.off)
        return found

    def _search(self, count: int) -> list[int]:
        pieces, out, text = self.pieces, [], self.ahead + END
        get, base, off, best, back = pieces.table.get, self.base, self.off, self.best, self.back
        best += [NEVER] * max(count, 0)
        back += [(0, ())] * max(count, 0)
        for first in range(count):
            score, end = best[off], first + 1
            own = get(text[first:end], False)
            if not own:
                raw = text[first].encode()
                total = score + pieces.unknown * len(raw)
                if total > best[off + 1]:
                    best[off + 1], back[off + 1] = total, (base + off, tuple(pieces.bytes[b] for b in raw))
            to = off
            while own is not False:
                to += 1
                if own:
                    ids, gain = own
                    gain += score
                    if gain > best[to]:
                        best[to], back[to] = gain, (base + off, ids)
                end += 1
                own = get(text[first:end], False)
            off += 1
            if off >= self.limit:
                self.off = off
                out += self._meet()
                base, off, best, back = self.base, self.off, self.best, self.back
        self.off, self.ahead = off, text[max(count, 0) : -1]
        return out


def stream(blocks: Iterable[str], pieces: Pieces) -> Iterator[list[int]]:
    """Ids of the best path through the text of ``blocks``, in lists that are final when given out."""
    search = Search(pieces)
    for block in blocks:
        if ids := search.feed(block):
            yield ids
    if ids := search.end():
        yield ids


def _ids(text: str, pieces: Pieces) -> bytes:
    return array("i", [i for ids in stream((text,), pieces) for i in ids]).tobytes()


def _search_stretch(text: str, pieces: Pieces) -> bytes:
    """The ids of ``text``, searched between the boundaries that every path passes."""
    joined = list(map(pieces.pairs.__contains__, map(add, text, text[1:])))
    if False not in joined:
        return _ids(text, pieces)
    found, a = [], 0
    for b in [*(i for i, one in enumerate(joined, 1) if not one), len(text)]:
        part = text[a:b]
        ids = pieces.young.get(part) or pieces.old.get(part)
        if ids is None:
            ids = _ids(part, pieces)
        if b - a <= MEMO_CHARS:
            pieces.young[part] = ids
        found.append(ids)
        a = b
    return b"".join(found)


def encode_bytes(text: str, pieces: Pieces) -> bytes:
    """The ids of ``text`` as 32-bit numbers, with a space mark in front as the format has it."""
    if not text:
        return b""
    stretches: list[str] = []
    for i, part in enumerate(text.split(MARK)):
        if i:
            stretches.append("")  # a space mark of the text itself
        marked = part.replace(" ", MARK)
        stretches += pieces.cut.findall(marked if i else MARK + marked)
    missing = set(stretches).difference(pieces.young)
    if missing:
        if len(pieces.young) + len(missing) > MEMO:
            # frequent stretches come back from the old generation
            pieces.old, pieces.young, missing = pieces.young, {}, set(stretches)
        for stretch in missing:
            ids = pieces.old.get(stretch)
            if ids is None:
                ids = _search_stretch(stretch, pieces) if stretch else np.array([pieces.bytes[b] for b in MARK.encode()], np.int32).tobytes()
            pieces.young[stretch] = ids
    found = b"".join(map(pieces.young.__getitem__, stretches))
    for stretch in missing:
        if len(stretch) > MEMO_CHARS:
            del pieces.young[stretch]
    return found


def encode(text: str, pieces: Pieces) -> np.ndarray:
    """The ids of ``text``."""
    return np.frombuffer(encode_bytes(text, pieces), np.int32)


def _decode_bytes(ids: Iterable[int], pieces: Pieces) -> bytes:
    return b"".join(map(pieces.parts.__getitem__, ids))[1:]


def decode(ids: Iterable[int], pieces: Pieces) -> str:
    """The text of ``ids``, without the space that encoding put in front."""
    return _decode_bytes(ids, pieces).decode()


def _with_kept(kept: pa.Array, new: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*kept.flatten(), *new.values()], names=[*(f.name for f in kept.type), *new])


def encode_column(docs: DataFrame, pieces: Pieces, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, n_tokens, ids and round_trip (decoding gives the text back).

    ``keep`` must not name the new columns or hold one twice.  The pieces are sent to each worker once and keep their memory
    of stretches from task to task.
    """
    sent = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for whole in batches:
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                texts = batch.column(1).to_pylist()
                found = [None if t is None else encode_bytes(t.decode("utf-8", "replace"), known) for t in texts]
                ids = np.frombuffer(b"".join(f or b"" for f in found), np.int32)
                counts = np.array([len(f or b"") // 4 for f in found], np.int64)
                edges = np.concatenate(([0], np.cumsum(counts)))
                numbers = ids.tolist()
                same = [t is None or _decode_bytes(numbers[a:b], known) == t for t, a, b in zip(texts, edges[:-1].tolist(), edges[1:].tolist())]
                lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids), mask=pa.array([f is None for f in found]))
                yield _with_kept(batch.column(0), {"n_tokens": pa.array(counts), "ids": lists, "round_trip": pa.array(same, pa.bool_())})

    source = docs.select(F.struct(*keep).alias("kept"), docs[text].cast("binary").alias("body"))
    new = T.StructType.fromDDL("n_tokens bigint, ids array<int>, round_trip boolean")
    return source.mapInArrow(run, T.StructType([*(docs.schema[c] for c in keep), *new]))


def decode_column(encoded: DataFrame, pieces: Pieces, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and text, decoded from ``ids``."""
    sent = encoded.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if i is None else decode(i, sent.value) for i in batch.column(1).to_pylist()]
            yield _with_kept(batch.column(0), {"text": pa.array(texts, pa.string())})

    source = encoded.select(F.struct(*keep).alias("kept"), encoded[ids].alias("numbers"))
    return source.mapInArrow(run, T.StructType([*(encoded.schema[c] for c in keep), *T.StructType.fromDDL("text string")]))
