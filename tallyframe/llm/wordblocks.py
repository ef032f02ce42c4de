"""Vectorised words of a block of texts: positions, documents and hashes without a Python loop."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

#: Bytes that end a word: space and 0x09 to 0x0D.
BLANKS = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Bytes that end a word when punctuation does not count; bytes of other scripts belong to words.
NOT_ALNUM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


_POWERS: dict[int, np.ndarray] = {}


def powers(base: np.uint64, size: int) -> np.ndarray:
    """base**0, base**1, ... modulo 2**64; a worker keeps the longest row it has needed of each base."""
    if int(base) not in _POWERS or len(_POWERS[int(base)]) < size:
        have = np.full(size + (size >> 3) + 1024, base, np.uint64)
        have[0] = 1
        _POWERS[int(base)] = np.multiply.accumulate(have, out=have)
    return _POWERS[int(base)][:size]


def forget_powers() -> None:
    """Drop the rows of powers this worker keeps."""
    _POWERS.clear()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole 64-bit value."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sliding(values: np.ndarray, size: int, best=np.minimum) -> np.ndarray:
    """Minimum of each ``size`` neighbouring values, in log(size) passes."""
    out, have = values, 1
    while have < size:
        step = min(have, size - have)
        out, have = best(out[:-step], out[step:]), have + step
    return out


class WordBlock:
    """Words of a block of texts.

    ``data`` holds all words, each with one blank behind it; word i is ``data[starts[i]:ends[i]]``.
    The words of text j are ``first[j]`` up to ``first[j + 1]``. Null texts have no words.
    """

    def __init__(self, texts: pa.Array, separators: np.ndarray = BLANKS):
        empty, stop = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())
        joined = pc.binary_join_element_wise(pc.fill_null(texts.cast(pa.large_string()), empty), empty, stop)
        bounds = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset:joined.offset + len(joined) + 1]
        raw = np.frombuffer(joined.buffers()[2] or b"", np.uint8)[:bounds[-1]] if len(joined) else np.zeros(0, np.uint8)
        blank = separators[raw]
        keep = ~blank
        keep[1:] |= ~blank[:-1]
        stops = np.flatnonzero(keep & blank)
        self.data = raw[keep]
        self.data[blank[keep]] = 0x20
        self.ends = np.flatnonzero(blank[keep])
        self.starts = np.concatenate([[0], self.ends[:-1] + 1]) if len(self.ends) else self.ends
        self.first = np.searchsorted(stops, bounds)
        self.n_words = np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes."""
        n = len(self.data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers(BASE, n), out=sums[1:])
        return mixed((sums[self.ends] - sums[self.starts]) * powers(INVERSE, n)[self.starts])

    def text_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.n_words)), self.n_words)


def run_hashes(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` neighbouring values (uint64); empty when there are fewer."""
    n = len(values)
    if n < size:
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((values + np.uint64(1)) * powers(BASE, n), out=sums[1:])
    return mixed((sums[size:] - sums[:-size]) * powers(INVERSE, n)[:n - size + 1])
