"""Vectorised word hashing for Arrow batches of texts.

Whole columns of texts are cut into words and hashed with a handful of numpy
passes over the raw UTF-8 bytes; no Python object is made per word. A word's
hash is a polynomial over its bytes in 64-bit arithmetic, so equal words have
equal hashes in every task and on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes hashed at once; a longer text is hashed in one piece of its own.
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUE = np.random.default_rng(20).integers(1, 1 << 63, 256).astype(np.uint64) | np.uint64(1)
_powers: dict[str, np.ndarray] = {}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: `[^\x20\x09-\x0D]+`
SPACED = np.ones(256, dtype=np.uint8)
SPACED[[9, 10, 11, 12, 13, 32]] = 0
#: Runs of letters, digits and bytes over 0x7F, and runs of other visible characters.
WORDS_AND_MARKS = np.full(256, 2, dtype=np.uint8)
WORDS_AND_MARKS[: 0x21] = 0
WORDS_AND_MARKS[0x7F] = 0
WORDS_AND_MARKS[0x30:0x3A] = 1
WORDS_AND_MARKS[0x41:0x5B] = 1
WORDS_AND_MARKS[0x61:0x7B] = 1
WORDS_AND_MARKS[0x80:] = 1


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers.get(kind)
    if have is None or len(have) < n:
        table = np.full(max(n, CHUNK + 1), _BASE if kind == "up" else _INVERSE, dtype=np.uint64)
        table[0] = 1
        have = np.cumprod(table, dtype=np.uint64)
        if n <= 8 * CHUNK:  # one giant text must not leave its tables behind
            _powers[kind] = have
    return have


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix finaliser: spreads any 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Tokens:
    """Words of consecutive rows: ``hashes[bounds[i]:bounds[i + 1]]`` are row ``first + i``'s."""

    first: int
    hashes: np.ndarray
    bounds: np.ndarray
    #: If asked for: bit 0, the word has bytes over 0x7F; bit 1, its last byte is an ASCII mark.
    forms: np.ndarray | None = None

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    def row_of(self) -> np.ndarray:
        """The row, from 0, of every word."""
        return np.repeat(np.arange(self.rows), np.diff(self.bounds))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and each row's offsets; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if column.null_count:
        column = column.fill_null("")
        _, offsets, data = column.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8), at


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Consecutive rows of at most ``CHUNK`` bytes: first row, bytes, offsets from 0."""
    if len(column) == 0:
        return
    data, at = raw(column)
    row = 0
    while row < len(at) - 1:
        last = int(np.searchsorted(at, at[row] + CHUNK, side="right")) - 1
        last = max(last, row + 1)
        yield row, data[at[row] : at[last]], at[row : last + 1] - at[row]
        row = last


def tokens(column: pa.Array, classes: np.ndarray = SPACED, forms: bool = False):
    """Hashes of the words of a text column, A-Z lower-cased, chunk by chunk."""
    for first, data, at in chunks(column):
        n = len(data)
        if n == 0:
            yield Tokens(first, np.zeros(0, np.uint64), np.zeros(len(at), np.int64), np.zeros(0, np.uint8))
            continue
        kind = classes[data]
        edge = np.empty(n, dtype=bool)
        edge[0] = True
        np.not_equal(kind[1:], kind[:-1], out=edge[1:])
        inner = at[(at > 0) & (at < n)]
        edge[inner] = True
        starts = np.flatnonzero(edge)
        ends = np.append(starts[1:], n)
        keep = kind[starts] != 0
        starts, ends = starts[keep], ends[keep]
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[_LOWER[data]] * _power("up", n)[:n], out=total[1:])
        hashes = mixed((total[ends] - total[starts]) * _power("down", n)[starts])
        form = None
        if forms:
            high = np.concatenate([[0], np.cumsum(data >= 0x80, dtype=np.int64)])
            form = (high[ends] > high[starts]).astype(np.uint8) | (WORDS_AND_MARKS[data[ends - 1]] == 2).astype(np.uint8) << 1
        yield Tokens(first, hashes, np.searchsorted(starts, at), form)


def shingles(t: Tokens, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words in order, and bounds by row.

    A row with fewer words has its whole sequence as one; a row without words none.
    """
    h, b = t.hashes, t.bounds
    counts = np.diff(b)
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate([[0], np.cumsum(made)])
    starts = np.arange(bounds[-1]) + np.repeat(b[:-1] - bounds[:-1], made)
    length = np.repeat(np.minimum(counts, size), made)
    out = np.zeros(len(starts), dtype=np.uint64)
    for k in range(size):
        live = length > k
        at = np.minimum(starts + k, max(len(h) - 1, 0))
        step = mixed(out * np.uint64(0x2545F4914F6CDD1D) + h[at] + np.uint64(k)) if len(h) else out
        out = step if live.all() else np.where(live, step, out)
    return out, bounds
