"""Texts of an Arrow batch as one flat byte array, cut and hashed without a Python object per word."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space of one byte: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_powers = {}


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches again, in pieces whose texts come to about `max_bytes`; a longer text is a piece of its own."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        yield from pieces(batch, sizes.astype(np.int64), max_bytes)


def pieces(batch: pa.RecordBatch, sizes: np.ndarray, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batch in pieces whose rows, of the given sizes, come to `max_bytes` at most; a larger row is a piece of its own."""
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, done + max_bytes, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def flat_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, and where each begins (one entry more than texts). Null is empty."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word (bytes other than one-byte white space), and each text's first word."""
    inside = ~SPACE[data]
    begin, end = inside.copy(), inside.copy()
    if len(data):
        begin[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        begin[edges] = inside[edges]
        end[edges - 1] = inside[edges - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def powers(n: int, base: int = _MULTIPLIER) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        table = np.full(max(n, 1024), base, np.uint64)
        table[0] = 1
        _powers[base] = table = np.cumprod(table, dtype=np.uint64)
    return table[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """64 bits stirred, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes in each span; the spans are in order, not empty and don't overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    used = data if len(place) == len(data) else data[place + np.repeat(starts, lengths)]
    weighted = (used.astype(np.uint64) + np.uint64(1)) * powers(int(lengths.max()))[place]
    sums = np.add.reduceat(weighted, np.cumsum(lengths) - lengths)
    return mixed(sums + mixed(lengths.astype(np.uint64)))


def rolling_hash(values: np.ndarray, width: int, base: int = 0xD6E8FEB86659FD93) -> np.ndarray:
    """A 64-bit hash of every `width` consecutive values, by Horner's rule in logarithmically many steps."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, done = np.zeros(n, np.uint64), 0
    part, size = values, 1
    scale = pow(base, 1, 1 << 64)
    while True:
        if width & size:
            total = total * np.uint64(pow(base, size, 1 << 64)) + part[done : done + n]
            done += size
        if size * 2 > width:
            return mixed(total)
        part = part[:-size] * np.uint64(scale) + part[size:]
        size *= 2
        scale = pow(base, size, 1 << 64)


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the given runs, one run after the other."""
    total = int(lengths.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on after a task, and keeps what the task used."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
