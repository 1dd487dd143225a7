"""Whole text columns as flat byte arrays, for numpy inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 21

#: ASCII white space; no byte of a longer UTF-8 character is among them.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, white space to one blank.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
LOWER[SPACE] = 0x20
POWERS = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and ``n + 1`` offsets into them; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text_col: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``size`` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(text_col))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased texts with single blanks, and where their words start and end.

    Returns the bytes, the starts, the (exclusive) ends and the first word of each text
    (``n + 1`` entries). Within a text, words stand one blank apart.
    """
    solid = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    first = first[:-1]
    after_solid = np.zeros(len(data), bool)
    after_solid[1:] = solid[:-1]
    after_solid &= ~first
    keep = solid | after_solid
    at = np.cumsum(keep) - 1
    begin = solid & ~after_solid
    last = np.zeros(len(data), bool)
    last[:-1] = ~solid[1:] | first[1:]
    last[-1:] = True
    last &= solid
    starts, ends = at[begin], at[last] + 1
    count = np.zeros(len(data) + 1, np.int64)
    np.cumsum(begin, out=count[1:])
    return LOWER[data[keep]], starts, ends, count[offsets]


def run_hashes(data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the byte runs, which are in order and do not overlap."""
    if not len(start):
        return np.empty(0, np.uint64)
    data, start, stop = data[start[0]:], start - start[0], stop - start[0]
    reach = np.diff(np.append(start, len(data)))
    inside = np.arange(len(data)) - np.repeat(start, reach)
    mixed = (data.astype(np.uint64) + np.uint64(1) + (inside >> 6).astype(np.uint64) * np.uint64(257)) * POWERS[inside & 63]
    mixed ^= mixed >> np.uint64(29)
    mixed *= POWERS[1]
    mixed ^= mixed >> np.uint64(32)
    mixed[inside >= np.repeat(stop - start, reach)] = 0
    return np.add.reduceat(mixed, start)
