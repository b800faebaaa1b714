"""UTF-8 bytes of the texts of an Arrow array, without a Python string for each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def spans(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, offsets): text i is bytes[offsets[i]:offsets[i + 1]]; nulls are empty."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    flat = texts.cast(pa.large_binary()).fill_null(b"")
    _, at, data = flat.buffers()
    offsets = np.frombuffer(at, np.int64)[flat.offset : flat.offset + len(flat) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def each_text(texts: pa.Array) -> Iterator[bytes]:
    data, offsets = spans(texts)
    cuts = offsets.tolist()
    for a, b in zip(cuts, cuts[1:], strict=False):
        yield data[a:b].tobytes()


def text_runs(texts: pa.Array, at_most: int = 1 << 22) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of some at_most bytes (a longer text is a run of its own): (first, after last, bytes, offsets)."""
    data, offsets = spans(texts)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + at_most, side="right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j
