"""Bytes, words and n-gram hashes of whole columns of text, as arrays.

A block is a run of consecutive rows of about ``BLOCK`` bytes; a row is never cut, so a very
long text makes one large block of its own. A word is a run of bytes other than 0x20 and
0x09 to 0x0D.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
BASE = 0x9E3779B97F4A7C15
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def byte_blocks(column: pa.Array, target: int = BLOCK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets of its rows, bytes) of each block; null counts as empty."""
    column = column.fill_null("").cast(pa.large_binary())
    rows = len(column)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + rows + 1] if rows else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if rows and buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + target, "right")) - 1)
        end = min(end, rows)
        yield at, offsets[at : end + 1] - offsets[at], data[offsets[at] : offsets[end]]
        at = end


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (in place on a copy)."""
    out = values ^ (values >> np.uint64(31))
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(32)
    return out


def byte_table(seed: int = 1, lower: bool = False) -> np.ndarray:
    """A random odd 64-bit number for each byte; with ``lower`` A-Z share those of a-z."""
    table = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed * 0x632BE59B)) | np.uint64(1)
    if lower:
        table[65:91] = table[97:123]
    return table


def powers(count: int, inverse: bool = False) -> np.ndarray:
    """BASE to the power 0 … count-1 modulo 2^64, or of its inverse."""
    base = pow(BASE, -1, 1 << 64) if inverse else BASE
    out = np.full(max(count, 1), np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Both tables of powers, kept at the largest length asked for."""

    def __init__(self) -> None:
        self.up, self.down = powers(1), powers(1, True)

    def upto(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < count:
            size = max(count, 2 * len(self.up))
            self.up, self.down = powers(size), powers(size, True)
        return self.up[:count], self.down[:count]


def prefix_hashes(data: np.ndarray, table: np.ndarray, tables: Powers) -> np.ndarray:
    """Running polynomial hash: entry i covers the first i bytes."""
    up, _ = tables.upto(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(table[data] * up[: len(data)], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, tables: Powers) -> np.ndarray:
    """Hash of each span, the same wherever it stands."""
    _, down = tables.upto(len(prefix))
    return mixed((prefix[ends] - prefix[starts]) * down[starts])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word of a block; words never cross rows."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    space = np.zeros(256, bool)
    space[list(SPACES)] = True
    inside = ~space[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    before[firsts] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    after[lasts] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray, tables: Powers) -> np.ndarray:
    return span_hashes(prefix_hashes(data, table, tables), starts, ends, tables)


def gram_hashes(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every run of ``size`` words of one row."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = words[:count].copy()
    for k in range(1, size):
        out *= np.uint64(0x9FB21C651E98DF25)
        out += words[k : k + count]
        out ^= out >> np.uint64(28)
    inside = rows[:count] == rows[size - 1 : size - 1 + count]
    return mixed(out[inside]), rows[:count][inside]


def row_sums(values: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Sum of 64-bit values per row (modulo 2^64); ``rows`` is in order."""
    running = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=running[1:])
    edges = np.searchsorted(rows, np.arange(count + 1))
    return running[edges[1:]] - running[edges[:-1]]


def sequence_hashes(words: np.ndarray, rows: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each row's sequence of words."""
    first = np.searchsorted(rows, np.arange(count))
    place = (np.arange(len(words)) - first[rows]).astype(np.uint64)
    one = row_sums(mixed(words + place * np.uint64(0xA0761D6478BD642F)), rows, count)
    two = row_sums(mixed(words * np.uint64(0xE7037ED1A0B428DB) ^ (place + np.uint64(1)) * np.uint64(0x8EBC6AF09C88C6E3)), rows, count)
    return one, two
