"""Word and shingle hashes of many texts at once, in numpy, the same in every process.

A batch of texts is one UTF-8 buffer. The hash of a byte range is a difference
of prefix sums of ``byte * P^position``, scaled back by the inverse power, so
all words of the batch are hashed without a Python object per word.
"""

from __future__ import annotations

import numpy as np

P = 0x9E3779B97F4A7C15
P_INVERSE = pow(P, -1, 1 << 64)
SHINGLE = 5

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
#: Powers that a worker keeps; more are made for one use and dropped.
HELD = 1 << 20
#: Bytes of a batch hashed at once.
WINDOW = 1 << 19


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """P^0 .. P^(n-1) modulo 2^64, or the inverse powers."""
    held = _powers[inverse]
    if len(held) < n:
        a = np.full(n if n > HELD else min(HELD, max(n, 2 * len(held))), P_INVERSE if inverse else P, np.uint64)
        a[0] = 1
        held = np.multiply.accumulate(a)
        if n <= HELD:
            _powers[inverse] = held
    return held[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ``values[start:end]`` (uint64), depending on contents and length only."""
    n = len(values)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((values + np.uint64(1)) * powers(n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(n + 1, True)[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """The words of a batch of texts: byte ranges, hashes, and each text's range of words."""

    def __init__(self, texts: list[str]):
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
        sizes = np.array([len(p) + 1 for p in parts], np.int64)
        self.text_ends = np.cumsum(sizes)
        starts, ends, hashes = [], [], []
        for base, part in self._windows():
            word = ~_SPACE[part]
            edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0))
            first, last = edge[0::2], edge[1::2]
            starts.append(first + base)
            ends.append(last + base)
            hashes.append(range_hashes(part.astype(np.uint64), first, last))
        self.starts, self.ends, self.hashes = (np.concatenate(x) for x in (starts, ends, hashes))
        self.last = np.searchsorted(self.starts, self.text_ends)  # past each text's last word
        self.first = np.append(0, self.last[:-1])

    def _windows(self):
        """The bytes in parts that end with white space, and where each part starts."""
        start, n = 0, len(self.data)
        while start < n:
            stop = min(start + WINDOW, n)
            while stop < n and not _SPACE[self.data[stop - 1]]:
                blank = np.flatnonzero(_SPACE[self.data[stop:stop + WINDOW]])
                stop = stop + int(blank[0]) + 1 if len(blank) else min(stop + WINDOW, n)
            yield start, self.data[start:stop]
            start = stop


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``size`` words; a shorter text is one shingle of all its words.

    Later occurrences of a shingle are labelled with their number, so that
    all shingles of a text differ.
    """
    n = len(words)
    if n == 0:
        return words
    k = min(n, size)
    at = np.arange(n - k + 1)
    s = range_hashes(words, at, at + k)
    order = np.argsort(s, kind="stable")
    ordered = s[order]
    same = ordered[1:] == ordered[:-1]
    if same.any():
        start = np.flatnonzero(np.append(True, ~same))
        number = np.arange(len(s)) - np.repeat(start, np.diff(np.append(start, len(s))))
        s[order] = np.where(number > 0, mix(ordered + number.astype(np.uint64) * np.uint64(P)), ordered)
    return s
