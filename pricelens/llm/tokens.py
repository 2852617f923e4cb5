"""Byte-level BPE ids of whole texts, by the tokenizers library inside Spark tasks.

The merges of this tokenizer never cross the pieces that its published pattern
cuts a text into, so a task cuts its texts with numpy, lets the library encode
each distinct piece once, and gathers the ids.  A text with a code point whose
class is not settled since Unicode 3.2 goes to the library whole.
"""

from __future__ import annotations

import functools
import itertools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pricelens.llm.words import mixed, run_hashes, running, slices

#: Distinct pieces a worker remembers before it starts afresh; bounds its memory only.
REMEMBERED = 2_000_000
_L, _N, _S, _O = range(4)
_LEAD = (np.arange(256) & 0xC0) != 0x80


#: The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on.
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_ALPHABET = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def _byte_letters(s: str) -> str:
    if s.isascii() and s.isprintable():
        return s.replace(" ", chr(_ALPHABET[0x20]))
    return s.encode().decode("latin-1").translate(_ALPHABET)


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def _classes() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point: its class, whether that is settled, and a random number."""
    n = 0x110000
    white = {*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}
    old = unicodedata.ucd_3_2_0.category
    kind = {"L": _L, "N": _N}
    now = np.fromiter((kind.get(unicodedata.category(chr(i))[0], _O) for i in range(n)), np.uint8, n)
    settled = np.fromiter((old(chr(i))[0] != "C" and kind.get(old(chr(i))[0], _O) == now[i] for i in range(n)), bool, n)
    settled[:0xA0] = True
    settled[0x180E] = False
    now[list(white)] = _S
    settled[list(white - {0x205F})] = True
    return now, settled, mixed(np.arange(1, n + 1, dtype=np.uint64), 0xA0761D6478BD642F)


def cuts(cp: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces begin in code points ``cp`` of documents that begin at ``bounds``."""
    n = len(cp)
    c = _classes()[0][cp]
    doc = np.zeros(n + 3, bool)
    doc[bounds] = True
    doc[n:] = True
    b = np.ones(n + 3, bool)
    b[1:n] = c[1:] != c[:-1]
    b |= doc
    # the last white space before a word opens a piece; a plain space joins the word
    last = np.flatnonzero((c == _S) & b[1 : n + 1] & ~doc[1 : n + 1])
    b[last] = True
    b[last + 1] = cp[last] != 0x20
    # contractions, where an apostrophe opens a piece
    at = np.flatnonzero((cp == 0x27) & b[:n])
    wide = np.concatenate([cp, np.zeros(3, cp.dtype)])
    p, q = wide[at + 1], wide[at + 2]
    one = np.isin(p, np.frombuffer("stmd".encode("utf-32-le"), np.uint32)) & ~doc[at + 1]
    two = (((p == 0x72) | (p == 0x76)) & (q == 0x65) | (p == 0x6C) & (q == 0x6C)) & ~doc[at + 1] & ~doc[at + 2]
    for hit, k in ((at[one], 2), (at[two], 3)):
        b[hit + 1] = False
        b[hit + k] = True
    return np.flatnonzero(b[:n])


class Encoder:
    """Encodes texts; remembers the ids of the pieces it has met."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.forget()

    def forget(self) -> None:
        self.keys, self.off, self.num = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0

    def _encode(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after another, and how many each has."""
        merge = self.library.model.tokenize
        ids = [[t.id for t in merge(_byte_letters(s))] for s in new]
        return np.fromiter(itertools.chain.from_iterable(ids), np.uint32), np.fromiter(map(len, ids), np.int64, len(ids))

    def _learn(self, keys: np.ndarray, new: list[str]) -> None:
        flat, num = self._encode(new)
        if self.used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.empty(max(len(flat), self.used), np.uint32)])
        self.flat[self.used : self.used + len(flat)] = flat
        at = np.searchsorted(self.keys, keys)
        self.off = np.insert(self.off, at, self.used + np.concatenate([[0], np.cumsum(num)[:-1]]))
        self.num = np.insert(self.num, at, num)
        self.keys = np.insert(self.keys, at, keys)
        self.used += len(flat)

    def slice(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the documents (UTF-8 bytes and their bounds), and the bounds in ids."""
        text = buf.tobytes().decode("utf-8")
        cp = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lead = np.concatenate([[0], np.cumsum(_LEAD[buf])])
        bounds = lead[offs]
        if not len(cp):
            return np.empty(0, np.uint32), np.zeros(len(offs), np.int64)
        _, settled, number = _classes()
        start = cuts(cp, bounds[:-1][bounds[:-1] < len(cp)])
        end = np.append(start[1:], len(cp))
        h = run_hashes(running(number[cp]), start, end)
        keys, first, inv = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > REMEMBERED:
            self.forget()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if not known.all():
            f = first[~known]
            self._learn(keys[~known], [text[a:b] for a, b in zip(start[f].tolist(), end[f].tolist(), strict=True)])
            at = np.searchsorted(self.keys, keys)
        num, off = self.num[at][inv], self.off[at][inv]
        done = np.concatenate([[0], np.cumsum(num)])
        ids = self.flat[np.repeat(off - done[:-1], num) + np.arange(done[-1])]
        out = done[np.searchsorted(start, bounds)]
        if not settled[cp].all():
            odd = np.unique(np.searchsorted(bounds, np.flatnonzero(~settled[cp]), "right") - 1)
            parts = [ids[a:b] for a, b in zip(out[:-1], out[1:], strict=True)]
            for k in odd.tolist():
                parts[k] = np.array(self.library.encode(text[bounds[k] : bounds[k + 1]], add_special_tokens=False).ids, np.uint32)
            ids = np.concatenate(parts)
            out = np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        return ids, out


@functools.cache
def encoder(path: str) -> Encoder:
    """One per Python worker, kept between tasks."""
    return Encoder(path)


def encoded(column: pa.Array, path: str, end_id: int | None = None, size: int = 1_000_000) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, ids, bounds in ids) over slices of a text column; a null is empty."""
    e = encoder(path)
    for a, b, buf, offs in slices(column, size):
        ids, bounds = e.slice(buf, offs)
        if end_id is not None:
            ids = np.insert(ids, bounds[1:], np.uint32(end_id))
            bounds = bounds + np.arange(len(bounds))
        yield a, b, ids, bounds
