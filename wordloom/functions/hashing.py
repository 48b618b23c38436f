"""Seeded pseudo-random columns: hashes of a stable row key, never of row placement."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


# The published constants of md5.
_SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0**32).astype(np.uint32)
_TURNS = [turn for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for turn in four * 4]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
# Bytes that fit one block with its padding, and texts that are hashed together.
_ONE_BLOCK, _TOGETHER = 55, 8192
# The value of each hexadecimal digit of md5, by its code.
_DIGITS = np.zeros(256, np.uint8)
_DIGITS[np.frombuffer(b"0123456789abcdef", np.uint8)] = np.arange(16)


def hash_digits(seed: int, *keys: Column) -> Column:
    """``hash32`` as eight hexadecimal digits, for ``from_digits``."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.substring(F.md5(text), 1, 8)


def from_digits(texts: pa.Array, each: int) -> np.ndarray:
    """The ``each`` numbers of every text that joins so many ``hash_digits`` (none null), by text and number."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    digits = _DIGITS[data].reshape(-1, 2)
    return (digits[:, 0] << 4 | digits[:, 1]).view(">u4").reshape(len(texts), each).astype(np.int64)


def hash32(seed: int, *keys: Column) -> Column:
    """First 32 bits of ``md5('seed|key|key...')`` as BIGINT; also available in plain SQL."""
    return F.conv(hash_digits(seed, *keys), 16, 10).cast("bigint")


def hash_uniform(seed: int, *keys: Column) -> Column:
    """``hash32`` scaled to [0, 1)."""
    return hash32(seed, *keys) / F.lit(4294967296.0)


def _md5_heads(blocks: np.ndarray) -> np.ndarray:
    """First 32 bits of the md5 of padded one-block messages, ``(n, 64)`` bytes."""
    words = np.ascontiguousarray(blocks.view("<u4").T)
    a, b, c, d = (np.full(len(blocks), x, np.uint32) for x in _START)
    mixed, turned = np.empty_like(a), np.empty_like(a)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=mixed)
            mixed &= b
            mixed ^= d
            at = i
        elif i < 32:
            np.bitwise_xor(b, c, out=mixed)
            mixed &= d
            mixed ^= c
            at = (5 * i + 1) % 16
        elif i < 48:
            np.bitwise_xor(b, c, out=mixed)
            mixed ^= d
            at = (3 * i + 5) % 16
        else:
            np.invert(d, out=mixed)
            mixed |= b
            mixed ^= c
            at = 7 * i % 16
        mixed += a
        mixed += words[at]
        mixed += _SINES[i]
        np.right_shift(mixed, np.uint32(32 - _TURNS[i]), out=turned)
        mixed <<= np.uint32(_TURNS[i])
        mixed |= turned
        mixed += b
        # the array of the oldest part takes the next mix
        a, d, c, b, mixed = d, c, b, mixed, a
    a += np.uint32(_START[0])
    return a.byteswap().astype(np.int64)


def fits_arrays(seed: int, keys: list[str], text: Column) -> Column:
    """Whether ``hash32_of`` can hash ``text`` with all ``keys``."""
    return F.octet_length(text) <= _ONE_BLOCK - max((len(f"{seed}|{key}|".encode()) for key in keys), default=0)


def hash32_of(seed: int, keys: list[str], texts: pa.Array) -> np.ndarray:
    """``hash32(seed, key, text)`` of each text and each of ``keys``, by text and key; anything for texts of null."""
    texts = texts.cast(pa.large_binary())
    out = np.empty((len(texts), len(keys)), np.int64)
    for lo in range(0, len(texts), _TOGETHER):
        some = texts.slice(lo, _TOGETHER)
        ends = np.frombuffer(some.buffers()[1], np.int64)[some.offset : some.offset + len(some) + 1]
        data = np.frombuffer(some.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        length, row = np.diff(ends), np.arange(len(some))
        inside = np.arange(len(data)) - np.repeat(ends[:-1] - ends[0], length)
        blocks, size = None, -1
        for j, key in enumerate(keys):
            head = np.frombuffer(f"{seed}|{key}|".encode(), np.uint8)
            if len(head) != size:
                size, blocks = len(head), np.zeros((len(some), 64), np.uint8)
                blocks[np.repeat(row, length), size + inside] = data
                blocks[row, size + length] = 0x80
                blocks.view("<u4")[:, 14] = (size + length) * 8
            blocks[:, :size] = head
            out[lo : lo + len(some), j] = _md5_heads(blocks)
    return out
