"""Content-defined samples of all fixed-length byte windows, as array operations over many texts.

Every window of ``length`` bytes has an anchor: of the grams that lie in it, the one with the least
hash, the first if equal. Windows with equal bytes have equal anchors at equal places, and
neighbouring windows mostly share theirs; a run is a stretch of windows with one anchor.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from flowmetrics.llm.batches import mixed

GRAM = 24
_PLACE_BITS = 28
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


@dataclass(frozen=True)
class Runs:
    """Runs of windows in one buffer: first and last window start, the anchor gram's hash, a hash
    of all bytes the run's windows cover and of where in them the anchor is."""

    first: np.ndarray
    last: np.ndarray
    gram: np.ndarray
    whole: np.ndarray


class Buffer:
    """Bytes of several texts, one after the other; text i is ``starts[i]`` to ``starts[i + 1]``."""

    def __init__(self, data: np.ndarray, starts: np.ndarray) -> None:
        if len(data) >= 1 << _PLACE_BITS:
            raise ValueError("a buffer has 256 MB or more: cut it into overlapping ones")
        self.data, self.starts = data, starts
        powers = np.full(len(data) + 1, _BASE, np.uint64)
        powers[0] = 1
        np.cumprod(powers, out=powers)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data] * powers[:-1], out=self._sums[1:])

    def hashes(self, first: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Hashes of the bytes from ``first`` up to ``after``."""
        scaled = (self._sums[after] - self._sums[first]) * _inverse_powers(first)
        return mixed(scaled ^ (after - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def _grams(self) -> np.ndarray:
        """A hash of the gram at every place."""
        n = len(self.data)
        padded = np.concatenate((self.data, np.zeros(GRAM, np.uint8)))
        eight = np.ndarray(n + GRAM - 7, "<u8", padded, strides=(1,))
        gram = eight[: n - GRAM + 1] * np.uint64(0xBF58476D1CE4E5B9)
        gram ^= gram >> np.uint64(29)
        gram += eight[8 : n - GRAM + 9]
        gram *= np.uint64(0x94D049BB133111EB)
        gram ^= gram >> np.uint64(32)
        gram += eight[16 : n - GRAM + 17]
        gram *= np.uint64(0xD6E8FEB86659FD93)
        gram ^= gram >> np.uint64(31)
        return gram

    def anchors(self, length: int) -> np.ndarray:
        """Where the anchor of each window is, by the window's start, texts not told apart."""
        return self._anchors(self._grams(), length)

    @staticmethod
    def _anchors(gram: np.ndarray, length: int) -> np.ndarray:
        places = np.arange(len(gram), dtype=np.uint64)
        low = np.uint64((1 << _PLACE_BITS) - 1)
        least = gram & ~low | places
        width, done = length - GRAM + 1, 1
        while 2 * done <= width:
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        if done < width:
            least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
        return (least & low).astype(np.int64)

    def runs(self, length: int) -> Runs:
        """The runs of all windows that lie within a text."""
        n = len(self.data)
        none = np.zeros(0, np.int64)
        if n < length:
            return Runs(none, none, none.astype(np.uint64), none.astype(np.uint64))
        gram = self._grams()
        anchor = self._anchors(gram, length)
        steps = np.zeros(len(anchor) + 1, np.int32)
        begin, end = self.starts[:-1], self.starts[1:] - length + 1
        real = end > begin
        np.add.at(steps, begin[real], 1)
        np.add.at(steps, end[real], -1)
        valid = np.cumsum(steps)[:-1] > 0
        changed = np.ones(len(anchor), bool)
        changed[1:] = anchor[1:] != anchor[:-1]
        edge = np.zeros(len(anchor) + 1, bool)
        edge[self.starts[:-1][self.starts[:-1] < len(anchor)]] = True
        first = np.flatnonzero(valid & (changed | edge[:-1]))
        # A run ends before the next one or before windows that reach out of their text.
        ends = np.flatnonzero(valid & ~np.append(valid[1:], False))
        stop = np.minimum(np.append(first[1:] - 1, n), ends[np.searchsorted(ends, first)])
        where = anchor[first]
        whole = self.hashes(first, stop + length)
        whole = mixed(whole + (where - first).astype(np.uint64))
        return Runs(first, stop, gram[where], whole)


def _inverse_powers(exponents: np.ndarray) -> np.ndarray:
    """The inverse of the base to each exponent, modulo 2**64, by squaring."""
    out = np.ones(len(exponents), np.uint64)
    square, left = _INVERSE, exponents.astype(np.uint64)
    while left.any():
        odd = (left & np.uint64(1)).astype(bool)
        out[odd] *= np.uint64(square)
        square = square * square & (1 << 64) - 1
        left = left >> np.uint64(1)
    return out
