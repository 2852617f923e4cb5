"""Words, windows and their hashes over Arrow text, by numpy inside Spark tasks.

Words are the maximal runs of bytes outside 0x20 and 0x09-0x0D; the separators
are ASCII, so cutting UTF-8 bytes equals cutting characters.  A hash of a run is
``(C[end] - C[start]) * R**-start`` over a running polynomial sum ``C`` modulo
2**64 (``R`` odd), then mixed: it depends on content alone, not on place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer document is a slice of its own.
SLICE = 2_000_000

_U = np.uint64
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A 64-bit finaliser (murmur3's), elementwise."""
    x = x ^ _U(salt)
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


_BYTE = mixed(np.arange(1, 257, dtype=_U), 0x9E3779B97F4A7C15)
_R = 0x9E3779B97F4A7C15
_R_INV = pow(_R, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``R**i`` and ``R**-i`` for i < n."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_R, _R_INV)):
            p = np.full(n + 1024, base, _U)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=_U)
    return _powers[0][:n], _powers[1][:n]


def running(values: np.ndarray) -> np.ndarray:
    """``C``: C[i] sums ``values[j] * R**j`` for j < i."""
    c = np.zeros(len(values) + 1, _U)
    np.cumsum(values * powers(len(values))[0], out=c[1:])
    return c


def run_hashes(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hashes of the runs [start, end); runs of different length differ."""
    inv = powers(len(c))[1]
    return mixed((c[end] - c[start]) * inv[start], 0x5851F42D4C957F2D) ^ mixed((end - start).astype(_U), 0x14057B7EF767814F)


class Words:
    """The words of some documents: ``buf`` bytes, ``offs`` document bounds in
    bytes, ``start``/``end`` of words, ``first`` document bounds in words."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, lower: bool = False):
        self.buf = LOWER[buf] if lower else buf
        self.offs = offs
        n = len(buf)
        sep = SEPARATOR[buf]
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = sep[:-1], sep[1:]
        full = offs[1:] > offs[:-1]
        before[offs[:-1][full]] = True
        after[offs[1:][full] - 1] = True
        self.sep = sep
        self.start = np.flatnonzero(~sep & before)
        self.end = np.flatnonzero(~sep & after) + 1
        self.first = np.searchsorted(self.start, offs)
        self._hash = None

    def __len__(self) -> int:
        return len(self.offs) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = run_hashes(running(_BYTE[self.buf]), self.start, self.end)
        return self._hash

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``width`` words from each word on, and whether they lie in one document."""
        m = len(self.start)
        c = running(self.hash)
        i = np.arange(m)
        stop = np.minimum(i + width, m)
        limit = np.repeat(self.first[1:], self.counts)
        return run_hashes(c, i, stop), i + width <= limit

    def shingles(self, width: int) -> Iterator[np.ndarray]:
        """Per document its sorted distinct ``width``-word shingles; a shorter one is one shingle."""
        h, whole = self.windows(width)
        c = None
        for a, b in zip(self.first[:-1].tolist(), self.first[1:].tolist(), strict=True):
            if b - a >= width:
                yield np.unique(h[a : b - width + 1])
            elif b > a:
                c = running(self.hash) if c is None else c
                yield run_hashes(c, np.array([a]), np.array([b]))
            else:
                yield np.empty(0, _U)


def text_buffer(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document bounds of a text column; a null is an empty text."""
    a = pc.fill_null(column, "").cast(pa.large_string())
    a = a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a
    if isinstance(a, pa.ChunkedArray):
        a = a.chunk(0) if a.num_chunks else pa.array([], pa.large_string())
    if len(a) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = a.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.empty(0, np.uint8)
    return buf, offs - offs[0]


def slices(column: pa.ChunkedArray | pa.Array, size: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) over runs of documents of about ``size`` bytes."""
    buf, offs = text_buffer(column)
    n, a = len(offs) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + size, "right")) - 1)
        yield a, b, buf[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b
