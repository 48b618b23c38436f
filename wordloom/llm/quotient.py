"""Counting quotient filters: exact counters of word-id n-grams, sorted, compact and mergeable.

An n-gram's word codes are packed into one or more limbs of at most 64 bits.  An invertible permutation of
each limb's bits spreads the n-grams evenly.  The first bits of the result name the shard, the next ones are the quotient, all
others the remainder, kept in full.  Entries are sorted; a quotient is stored as one bit per entry and one per run, so only
remainders and counters take room.  Nothing is lost: the permutation is undone to read the n-grams back.
Filters of one shard are merged like sorted lists, counters of equal entries are summed.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

U = np.uint64
# Odd multipliers of the permutation.
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
SPILL = 255  # counters from here on stand in full behind the others


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@dataclass(frozen=True)
class Shape:
    """n-grams of ``words`` codes of ``bits`` bits each."""

    words: int
    bits: int

    @property
    def per_limb(self) -> int:
        return -(-self.words // self.limbs)

    @property
    def limbs(self) -> int:
        return -(-self.words // (64 // self.bits))

    @property
    def width(self) -> int:
        """Bits of a limb."""
        return self.per_limb * self.bits

    @property
    def mask(self) -> np.uint64:
        return U((1 << self.width) - 1)

    def pack(self, codes: np.ndarray) -> np.ndarray:
        """Rows of limbs of the rows of ``codes``."""
        out = np.zeros((len(codes), self.limbs), U)
        for i in range(self.words):
            limb = i // self.per_limb
            out[:, limb] = (out[:, limb] << U(self.bits % 64)) | codes[:, i] if self.bits < 64 else codes[:, i]
        return out

    def unpack(self, limbs: np.ndarray) -> np.ndarray:
        out = np.empty((len(limbs), self.words), U)
        rest = limbs.copy()
        for i in reversed(range(self.words)):
            limb = i // self.per_limb
            out[:, i] = rest[:, limb] & U((1 << self.bits) - 1)
            if self.bits < 64:
                rest[:, limb] >>= U(self.bits)
        return out

    def _turn(self, x: np.ndarray) -> np.ndarray:
        half = U(self.width - self.width // 2)
        for odd in ODD:
            x = (x * U(odd)) & self.mask
            x = x ^ (x >> half)
        return x

    def _turn_back(self, x: np.ndarray) -> np.ndarray:
        half = U(self.width - self.width // 2)
        for odd in reversed(ODD):
            x = x ^ (x >> half)
            x = (x * U(pow(odd, -1, 1 << self.width))) & self.mask
        return x

    def _others(self, limbs: np.ndarray) -> np.ndarray:
        total = np.zeros(len(limbs), U)
        for i in range(1, self.limbs):
            total = mix(total + limbs[:, i] + U(1))
        return total & self.mask

    def permute(self, limbs: np.ndarray) -> np.ndarray:
        out = np.stack([self._turn(limbs[:, i]) for i in range(self.limbs)], 1)
        if self.limbs > 1:
            out[:, 0] = self._turn(out[:, 0] ^ self._others(out))
        return out

    def restore(self, limbs: np.ndarray) -> np.ndarray:
        out = limbs.copy()
        if self.limbs > 1:
            out[:, 0] = self._turn_back(out[:, 0]) ^ self._others(out)
        return np.stack([self._turn_back(out[:, i]) for i in range(self.limbs)], 1)


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``keys`` in order, each once, with its count."""
    if not len(keys):
        return keys, np.empty(0, np.int64)
    if keys.shape[1] == 1:
        if counts is None:
            order, keys = None, np.sort(keys, axis=0)
        else:
            order = np.argsort(keys[:, 0], kind="stable")
    else:
        order = np.lexsort(keys.T[::-1])
    if order is not None:
        keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
    if counts is None:
        return keys[first], np.diff(np.concatenate((first, [len(keys)])))
    return keys[first], np.add.reduceat(counts[order], first)


def _narrow(x: np.ndarray, bits: int) -> bytes:
    """Numbers of ``bits`` bits in as few whole bytes each."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : -(-bits // 8)].tobytes()


def _widen(raw: memoryview, n: int, bits: int) -> tuple[np.ndarray, memoryview]:
    size = -(-bits // 8)
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(raw[: n * size], np.uint8).reshape(n, size)
    return out.view("<u8").reshape(n).astype(U), raw[n * size :]


class CountingQuotientFilter:
    """Sorted distinct permuted keys of one shard and their counters."""

    def __init__(self, shape: Shape, shard: int, shard_bits: int, keys: np.ndarray, counts: np.ndarray) -> None:
        self.shape, self.shard, self.shard_bits, self.counts = shape, shard, shard_bits, counts
        n = len(keys)
        self.quotient_bits = min(shape.width - shard_bits, max(n.bit_length() - 1, 0))
        self.remainder_bits = shape.width - shard_bits - self.quotient_bits
        inside = keys[:, 0] & U((1 << (shape.width - shard_bits)) - 1)
        # one true bit per entry, one false bit behind each quotient's run
        self.runs = np.zeros(n + (1 << self.quotient_bits), bool)
        self.runs[(inside >> U(self.remainder_bits)).astype(np.int64) + np.arange(n)] = True
        self.remainders = inside & U((1 << self.remainder_bits) - 1)
        self.others = keys[:, 1:]

    def __len__(self) -> int:
        return len(self.counts)

    def keys(self) -> np.ndarray:
        """The permuted keys, in order."""
        at = np.flatnonzero(self.runs)
        quotient = (at - np.arange(len(at))).astype(U)
        top = U(self.shard << (self.shape.width - self.shard_bits))
        first = top | (quotient << U(self.remainder_bits)) | self.remainders if self.remainder_bits < 64 else self.remainders
        return np.concatenate([first[:, None], self.others], 1)

    def count(self, codes: tuple[int, ...]) -> int:
        """The counter of one n-gram, found by its quotient's run and its remainder; 0 if it is not there."""
        key = self.shape.permute(self.shape.pack(np.array([codes], U)))[0]
        if int(key[0]) >> (self.shape.width - self.shard_bits) != self.shard:
            return 0
        inside = int(key[0]) & ((1 << (self.shape.width - self.shard_bits)) - 1)
        gaps = np.flatnonzero(~self.runs)
        quotient = inside >> self.remainder_bits
        start = int(gaps[quotient - 1]) - quotient + 1 if quotient else 0
        for i in range(start, int(gaps[quotient]) - quotient):
            if int(self.remainders[i]) == inside & ((1 << self.remainder_bits) - 1) and (self.others[i] == key[1:]).all():
                return int(self.counts[i])
        return 0

    def to_bytes(self) -> bytes:
        small = np.minimum(self.counts, SPILL).astype(np.uint8)
        parts = [struct.pack("<q", len(self)), np.packbits(self.runs).tobytes(), _narrow(self.remainders, self.remainder_bits)]
        parts += [_narrow(self.others[:, i], self.shape.width) for i in range(self.others.shape[1])]
        return b"".join([*parts, small.tobytes(), self.counts[small == SPILL].astype("<i8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes, shape: Shape, shard: int, shard_bits: int) -> CountingQuotientFilter:
        self = cls.__new__(cls)
        self.shape, self.shard, self.shard_bits = shape, shard, shard_bits
        (n,) = struct.unpack_from("<q", data)
        self.quotient_bits = min(shape.width - shard_bits, max(n.bit_length() - 1, 0))
        self.remainder_bits = shape.width - shard_bits - self.quotient_bits
        raw, bits = memoryview(data)[8:], n + (1 << self.quotient_bits)
        self.runs = np.unpackbits(np.frombuffer(raw[: -(-bits // 8)], np.uint8), count=bits).view(bool)
        self.remainders, raw = _widen(raw[-(-bits // 8) :], n, self.remainder_bits)
        others = []
        for _ in range(shape.limbs - 1):
            limb, raw = _widen(raw, n, shape.width)
            others.append(limb)
        self.others = np.stack(others, 1) if others else np.empty((n, 0), U)
        small = np.frombuffer(raw[:n], np.uint8)
        self.counts = small.astype(np.int64)
        self.counts[small == SPILL] = np.frombuffer(raw[n:], "<i8")
        return self


def shards(shape: Shape, codes: np.ndarray, shard_bits: int) -> list[CountingQuotientFilter]:
    """The rows of ``codes`` counted, one filter for each shard that holds any."""
    keys, counts = summed(shape.permute(shape.pack(codes)))
    shard_of = (keys[:, 0] >> U(shape.width - shard_bits)) if shard_bits else np.zeros(len(keys), U)
    edges = np.flatnonzero(np.concatenate(([True], shard_of[1:] != shard_of[:-1], [True]))) if len(keys) else []
    return [
        CountingQuotientFilter(shape, int(shard_of[a]), shard_bits, keys[a:b], counts[a:b]) for a, b in zip(edges[:-1], edges[1:])
    ]


def merge(filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
    """One filter of the same shard with the counters of all."""
    one = filters[0]
    if len(filters) == 1:
        return one
    keys, counts = summed(np.concatenate([f.keys() for f in filters]), np.concatenate([f.counts for f in filters]))
    return CountingQuotientFilter(one.shape, one.shard, one.shard_bits, keys, counts)
