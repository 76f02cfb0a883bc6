"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of bytes other than the six white-space bytes; A-Z is lower-cased first. A word's
hash is a polynomial of its bytes modulo 2**64, read off running sums, then mixed; the odd
multiplier has an inverse, so the place of a word in its text does not matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SHINGLE_WORDS = 5
_WINDOW = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_ASCII_PUNCTUATION = np.zeros(256, dtype=bool)
_ASCII_PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_tables: dict[int, np.ndarray] = {}


def _powers(base: int, size: int) -> np.ndarray:
    table = _tables.get(base)
    if table is None or len(table) < size:
        table = np.full(max(size, _WINDOW + 1), base, dtype=np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        _tables[base] = table
    return table


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finishing step of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of consecutive texts: ``hash`` per word and, for text i, words first[i]:first[i+1]."""

    hash: np.ndarray
    first: np.ndarray
    core: np.ndarray | None = None  # without ASCII punctuation at both ends
    parts: list[np.ndarray] | None = None  # of the first so many bytes of the core
    tails: list[np.ndarray] | None = None  # of its last so many bytes
    start: np.ndarray | None = None  # place of the core in the joined bytes
    end: np.ndarray | None = None


def scan(texts: list[bytes], prefixes: tuple[int, ...] = (), suffixes: tuple[int, ...] = ()) -> Words:
    """Hash the words of ``texts``; with ``prefixes`` or ``suffixes`` also the parts of words.

    The texts are joined by line ends and walked in windows that end at white space, so that memory
    is some bytes per byte of one window besides the results.
    """
    data = b"\n".join(texts).lower() + b"\n"
    buf = np.frombuffer(data, dtype=np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    begins = np.concatenate([[0], np.cumsum(lengths)])
    parts_wanted = bool(prefixes or suffixes)
    hashes, starts_all, cores, cs, ce = [], [], [], [], []
    parts = [[] for _ in prefixes]
    tails = [[] for _ in suffixes]
    at = 0
    while at < len(buf):
        stop = min(at + _WINDOW, len(buf))
        space = _SPACE[buf[at:stop]]
        while not space[-1]:  # end the window at white space; the data ends with one
            cut = np.flatnonzero(space)
            if len(cut):
                stop = at + int(cut[-1]) + 1
                space = space[: stop - at]
            else:
                stop = min(stop + _WINDOW, len(buf))
                space = _SPACE[buf[at:stop]]
        window = buf[at:stop]
        n = len(window)
        before = np.empty(n, dtype=bool)
        before[0] = True
        before[1:] = space[:-1]
        start = np.flatnonzero(~space & before)
        end = np.flatnonzero(space & ~before)
        power, inverse = _powers(_MULTIPLIER, n + 1), _powers(_INVERSE, n + 1)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((window.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])

        def code(a, b, sums=sums, inverse=inverse):
            return mixed((sums[b] - sums[a]) * inverse[a])

        hashes.append(code(start, end))
        starts_all.append(start + at)
        if parts_wanted:
            a, b = start.copy(), end.copy()
            for _ in range(4):  # up to four signs at each end belong to the punctuation
                b -= _ASCII_PUNCTUATION[window[b - 1]] & (b > a + 1)
                a += _ASCII_PUNCTUATION[window[a]] & (b > a + 1)
            cores.append(code(a, b))
            cs.append(a + at)
            ce.append(b + at)
            for out, k in zip(parts, prefixes, strict=True):
                out.append(np.where(b - a >= k, code(a, np.minimum(a + k, b)), np.uint64(0)))
            for out, k in zip(tails, suffixes, strict=True):
                out.append(np.where(b - a >= k, code(np.maximum(b - k, a), b), np.uint64(0)))
        at = stop
    starts = np.concatenate(starts_all)
    words = Words(np.concatenate(hashes), np.searchsorted(starts, begins))
    if parts_wanted:
        words.core = np.concatenate(cores)
        words.start, words.end = np.concatenate(cs), np.concatenate(ce)
        words.parts = [np.concatenate(p) for p in parts]
        words.tails = [np.concatenate(p) for p in tails]
    return words


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; for many short arrays several times faster than ``np.unique``."""
    values = np.sort(values)
    keep = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def rolled_shingles(words: Words, size: int = SHINGLE_WORDS) -> np.ndarray:
    """The hash of the ``size`` words from each place on, whatever text they belong to."""
    h = words.hash
    rolled = np.zeros(max(len(h) - size + 1, 0), dtype=np.uint64)
    for k in range(size):
        rolled += h[k : k + len(rolled)] * np.uint64(pow(_MULTIPLIER, k + 3, 1 << 64))
    return mixed(rolled)


def shingle_sets(words: Words, size: int = SHINGLE_WORDS, only: int | None = None) -> list[np.ndarray]:
    """For each text, or for text ``only``, the sorted distinct hashes of its ``size``-word shingles.

    A text with fewer words has one shingle, the whole sequence; one without words has none.
    """
    bounds = list(zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True))
    if only is not None:
        a, b = bounds[only]
        words = Words(words.hash[a:b], np.array([0, b - a]))
        bounds = [(0, b - a)]
    h = words.hash
    rolled = rolled_shingles(words, size)
    out = []
    for a, b in bounds:
        if b - a >= size:
            out.append(distinct(rolled[a : b - size + 1]))
        elif b > a:
            factors = np.array([pow(_MULTIPLIER, k + 3, 1 << 64) for k in range(b - a)], dtype=np.uint64)
            out.append(mixed((h[a:b] * factors).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out
