"""Small Arrow/numpy helpers for list columns, used inside tasks on whole batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def flatten_lists(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All elements in one array, and the ``n + 1`` offsets of the rows in it."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten(), offsets - offsets[0]


def row_numbers(offsets: np.ndarray) -> np.ndarray:
    """For each flattened element, the row it belongs to."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def lookup_words(words: pa.Array, table: dict, missing: int = -1) -> np.ndarray:
    """``table[word]`` for each word; only the distinct words of the batch are looked up."""
    encoded = words.dictionary_encode()
    found = np.fromiter(
        (table.get(w, missing) for w in encoded.dictionary.to_pylist()),
        np.int64,
        len(encoded.dictionary),
    )
    if len(found) == 0:
        return np.empty(0, np.int64)
    return found[encoded.indices.to_numpy(zero_copy_only=False)]


def stack_vectors(vectors: pa.Array, dtype=np.float64) -> np.ndarray:
    """A list column of equally long vectors as a 2-d array."""
    flat, offsets = flatten_lists(vectors)
    width = int(offsets[1]) if len(offsets) > 1 else 0
    return flat.to_numpy(zero_copy_only=False).astype(dtype).reshape(len(offsets) - 1, width)


def vector_list(rows: np.ndarray) -> pa.Array:
    """A 2-d array as a list column."""
    n, d = rows.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * d)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(rows).ravel()))
