"""Vectorised scanning of text batches inside tasks (numpy over Arrow buffers).

An Arrow string column is one byte buffer plus offsets. These helpers cut a batch
into slices of bounded bytes and compute, for a whole slice at once, word bounds,
word hashes, n-gram hashes and sliding minima, never crossing a row boundary.
A single row longer than the bound forms a slice of its own, so memory is bounded by
``max(bound, longest text)``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
SLICE_BYTES = 512 << 10      # a dozen 8-byte arrays hold a slice
_MULT = 0x9E3779B97F4A7C15 | 1
_MULT_INV = pow(_MULT, -1, 1 << 64)


def splitmix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads the bits of a uint64 array (a bijection)."""
    x = x + U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def byte_codes(fold_case: bool) -> np.ndarray:
    """A 64-bit code for each byte value; ``A-Z`` share the code of ``a-z`` if folded."""
    values = np.arange(256, dtype=np.uint64)
    if fold_case:
        values[65:91] += U64(32)
    return splitmix(values * U64(0xD1342543DE82EF95) + U64(7))


class Powers:
    """Powers of the rolling multiplier and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up = np.full(size, _MULT, np.uint64)
            self.down = np.full(size, _MULT_INV, np.uint64)
            self.up[0] = self.down[0] = 1
            np.cumprod(self.up, out=self.up)
            np.cumprod(self.down, out=self.down)
        return self.up[:n], self.down[:n]


class Slice:
    """Rows ``lo..hi`` of a batch: their bytes and ``offsets`` (hi - lo + 1 entries)."""

    def __init__(self, lo: int, hi: int, data: np.ndarray, offsets: np.ndarray) -> None:
        self.lo, self.hi, self.data, self.offsets = lo, hi, data, offsets

    @property
    def rows(self) -> int:
        return self.hi - self.lo


def text_slices(column: pa.Array, bound: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a string column into slices of at most ``bound`` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    _, off_buf, data_buf = column.buffers()
    offsets = np.frombuffer(off_buf, np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None and data_buf.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + bound, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield Slice(lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


class Rolling:
    """Hashes of any substring of a slice in constant time."""

    def __init__(self, data: np.ndarray, codes: np.ndarray, powers: Powers) -> None:
        n = len(data)
        up, self.down = powers.get(n + 1)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(codes[data] * up[:n], out=self.total[1:])

    def all(self, size: int) -> np.ndarray:
        n = len(self.total) - size
        return splitmix((self.total[size:] - self.total[:n]) * self.down[:n])

    def at(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return splitmix((self.total[end] - self.total[start]) * self.down[start] + (end - start).astype(np.uint64))


class Words:
    """Words of a slice: byte bounds, owning row and 64-bit hashes.

    ``is_word`` gives each byte value's class: 0 (or False) is outside words, and a word
    is a run of one class within a row. ``counts`` has the number of words of each row and ``first`` the index of its first.
    """

    def __init__(self, part: Slice, is_word: np.ndarray, codes: np.ndarray, powers: Powers) -> None:
        data, offsets = part.data, part.offsets
        n = len(data)
        kind = np.zeros(n + 2, np.uint8)
        kind[1:-1] = is_word[data]
        cut = kind[1:] != kind[:-1]
        cut[offsets] = True
        starts = np.flatnonzero(cut & (kind[1:] != 0))
        ends = np.flatnonzero(cut & (kind[:-1] != 0))
        self.starts, self.ends = starts, ends
        up, down = powers.get(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(codes[data] * up[:n], out=total[1:])
        raw = (total[ends] - total[starts]) * down[starts]
        self.hashes = splitmix(raw + (ends - starts).astype(np.uint64))
        self.first = np.searchsorted(starts, offsets[:-1], "left")
        bounds = np.append(self.first, len(starts))
        self.counts = np.diff(bounds)
        self.row = np.repeat(np.arange(part.rows), self.counts)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive entries (length ``len - k + 1``, or 0)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for j in range(1, k):
        out = (out ^ (out >> U64(32))) * U64(0xD6E8FEB86659FD93) + hashes[j:j + n]
    return splitmix(out + U64(k))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` entries, by doubling (length ``len - width + 1``)."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    best, have = values, 1
    while have * 2 <= width:
        best = np.minimum(best[:-have], best[have:])
        have *= 2
    rest = width - have
    return np.minimum(best[:n], best[rest:rest + n]) if rest else best[:n]
