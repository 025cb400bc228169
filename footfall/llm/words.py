"""Texts as bytes, in slices of bounded size, and their words as numbers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in pieces whose ``column`` holds at most so many bytes, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        start = 0
        while start < len(sizes):
            before = ends[start - 1] if start else 0
            stop = max(int(np.searchsorted(ends, before + most_bytes, side="right")), start + 1)
            yield batch.slice(start, stop - start)
            start = stop


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; a null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def coded(words: list[bytes]) -> np.ndarray:
    """A number for each word, equal for equal words."""
    found = pa.array(words, pa.large_binary()).dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def split(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(first, code, word): text t has the words of places first[t] to first[t + 1], numbered by code in the array word.

    Words are maximal stretches of bytes other than 0x20 and 0x09 to 0x0D.
    """
    texts = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer if buffer is not None else b"", np.uint8)[offsets[0] : offsets[-1]]
    bounds = offsets - offsets[0]
    solid = ~_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    inner = bounds[:-1][np.diff(bounds) > 0]
    begins[inner] = solid[inner]
    starts = np.flatnonzero(begins)
    first = np.searchsorted(starts, bounds)
    stops = solid.copy()
    stops[:-1] &= begins[1:] | ~solid[1:]
    # with the spaces taken out, a word ends where the next one begins
    places = np.concatenate([[0], np.cumsum(np.flatnonzero(stops) + 1 - starts)])
    packed = data[solid]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(packed)])
    found = words.dictionary_encode()
    return first, found.indices.to_numpy(zero_copy_only=False), found.dictionary
