"""Helpers for operators that work on whole batches of texts as byte arrays (inside tasks only)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one step of a task works on; one text may be longer and is then a step of its own.
STEP_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base ** 0..n-1 modulo 2**64; kept and grown in the worker."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        grown = np.full(max(n, 1 << 16), base, np.uint64)
        grown[0] = 1
        have = _powers[base] = np.multiply.accumulate(grown)
    return have[:n]


def range_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit polynomial hashes of data[start:end] for many ranges; equal content gives equal hashes."""
    n = len(data)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(n), out=total[1:])
    raw = (total[end] - total[start]) * powers(n + 1, _INVERSE)[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text or binary column; a null is an empty text."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(batches: Iterator[pa.RecordBatch], text: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text, so that a task's memory is bounded."""
    for batch in batches:
        if not batch.num_rows:
            continue
        offsets = utf8(batch.column(text))[1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


class Words:
    """Words of a batch of texts: byte ranges, 64-bit hashes and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = is_word[data]
        step = np.diff(inside)
        cuts = offsets[1:-1]
        cuts = np.unique(cuts[(cuts > 0) & (cuts < len(data))])
        cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]  # a text ends and the next starts inside a run
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        if len(cuts):
            starts, ends = np.sort(np.append(starts, cuts)), np.sort(np.append(ends, cuts))
        self.start, self.end = starts, ends
        self.hash = range_hash(LOWER[data], starts, ends)
        self.first = np.searchsorted(starts, offsets)  # words of text k: first[k] .. first[k + 1]
        self.count = np.diff(self.first)


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, position in the row) of every cell of rows with these lengths."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
