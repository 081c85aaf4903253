"""The subword lattice of a word: every way to spell it in pieces of a unigram vocabulary.

A word, with the vocabulary's word mark before it, is a path from its first to its last
character; each piece that matches is an arc. Characters without a piece of their own get an arc
through their UTF-8 bytes' pieces. Words of equal length are worked on together, one array
operation per place and piece length, in log space.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

from flowmetrics.llm.batches import mixed

MARK = "▁"
_NONE = -1
_BASE = np.uint64(0x100000001B3)
#: Characters of words that are worked on together, times piece lengths.
_CELLS = 400_000
_TABLE_BITS = 20


@dataclass(frozen=True)
class Vocabulary:
    """Existing pieces and their scores: places 0 to 255 are the byte pieces, 256 ends a text."""

    pieces: tuple[str, ...]
    scores: np.ndarray  # natural logs, for bytes, end and pieces in this order

    END = 256
    FIRST = 257

    @staticmethod
    def from_file(path: str) -> Vocabulary:
        """Pieces of a sentencepiece file that lie within a word.

        Scores of merge order are ranks, not probabilities; they start as a Zipf law of the rank.
        """
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, weights = [], np.zeros(Vocabulary.FIRST)
        taken = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or MARK in piece[1:]:
                continue
            pieces.append(piece)
            taken.append(1.0 / (10.0 - model.get_score(i)))
        weights[:] = min(taken, default=1.0)
        every = np.concatenate((weights, taken))
        return Vocabulary(tuple(pieces), np.log(every / every.sum()))

    def with_counts(self, counts: np.ndarray, smoothing: float = 0.01) -> Vocabulary:
        """The same pieces, scored by their shares of ``counts``."""
        smooth = counts + smoothing
        return Vocabulary(self.pieces, np.log(smooth / smooth.sum()))


class Lattice:
    """Forward and backward recursions over words under one vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self._scores = np.append(vocabulary.scores, -np.inf)  # the last one is for no piece
        self.longest = max((len(p) for p in vocabulary.pieces), default=1)
        hashes = np.array([_hash(p) for p in vocabulary.pieces], np.uint64)
        self._places(hashes)

    def _places(self, hashes: np.ndarray) -> None:
        """Two tables by hash: a piece whose place in the first is taken is put in the second."""
        ids = np.arange(len(hashes), dtype=np.int64) + Vocabulary.FIRST
        self._tables = []
        salts = iter(range(1, 1 << 30))
        while len(hashes):
            salt = mixed(np.array([next(salts)], np.uint64))[0]
            slot = (mixed(hashes ^ salt) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
            _, first = np.unique(slot, return_index=True)
            keys = np.zeros(1 << _TABLE_BITS, np.uint64)
            values = np.full(1 << _TABLE_BITS, _NONE, np.int32)
            keys[slot[first]], values[slot[first]] = hashes[first], ids[first]
            self._tables.append((salt, keys, values))
            left = np.setdiff1d(np.arange(len(hashes)), first)
            hashes, ids = hashes[left], ids[left]

    def _look_up(self, hashes: np.ndarray) -> np.ndarray:
        found = np.full(hashes.shape, _NONE, np.int32)
        for salt, keys, values in self._tables:
            slot = (mixed(hashes ^ salt) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)
            hit = (keys[slot] == hashes) & (values[slot] != _NONE)
            found = np.where(hit, values[slot], found)
        return found

    def groups(self, words: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Indices of words of one length, and their characters, the mark first."""
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        order = np.argsort(lengths, kind="stable")
        at = 0
        while at < len(order):
            length = int(lengths[order[at]])
            end = int(np.searchsorted(lengths[order], length, side="right"))
            step = max(1, _CELLS // (length * min(length, self.longest)))
            for a in range(at, end, step):
                rows = order[a : min(end, a + step)]
                joined = "".join(MARK + words[i] for i in rows)
                coded = joined.encode("utf-32-le", "surrogatepass")
                yield rows, np.frombuffer(coded, "<u4").reshape(len(rows), length)
            at = end

    def _arcs(self, chars: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, list]:
        """Pieces by length and start; scores of single characters; those spelled in bytes."""
        codes = chars.astype(np.uint64)
        hashed = np.zeros(chars.shape, np.uint64)
        pieces = []
        for size in range(1, min(self.longest, chars.shape[1]) + 1):
            width = chars.shape[1] - size + 1
            hashed = (hashed[:, :width] + codes[:, size - 1 :] + np.uint64(1)) * _BASE
            pieces.append(self._look_up(hashed))
        single = self._scores[pieces[0]]
        missing = pieces[0] == _NONE
        spelled = []
        if missing.any():
            for code in np.unique(chars[missing]):
                raw = np.frombuffer(chr(code).encode("utf-8", "surrogatepass"), np.uint8)
                where = missing & (chars == code)
                single[where] = self._scores[raw].sum()
                spelled.append((raw, where))
        return pieces, single, spelled

    def _forward(self, arcs: list[np.ndarray]) -> np.ndarray:
        """Log probability of all spellings of the first j characters, for every j."""
        rows, length = arcs[0].shape
        alpha = np.full((length + 1, rows), -np.inf)
        alpha[0] = 0.0
        for j in range(1, length + 1):
            ways = np.array([alpha[j - k] + arcs[k - 1][:, j - k] for k in range(1, min(j, len(arcs)) + 1)])
            alpha[j] = _log_sum(ways)
        return alpha

    def _scored(self, pieces: list[np.ndarray], single: np.ndarray) -> list[np.ndarray]:
        return [single, *(self._scores[p] for p in pieces[1:])]

    def log_marginals(self, words: Sequence[str]) -> np.ndarray:
        """The natural log of each word's probability, summed over all its spellings."""
        out = np.zeros(len(words))
        for rows, chars in self.groups(words):
            pieces, single, _ = self._arcs(chars)
            out[rows] = self._forward(self._scored(pieces, single))[-1]
        return out

    def expected_counts(self, words: Sequence[str], counts: np.ndarray) -> np.ndarray:
        """How often each piece is used in spelling the words, each so many times, on average."""
        total = np.zeros(len(self._scores) - 1)
        for rows, chars in self.groups(words):
            pieces, single, spelled = self._arcs(chars)
            arcs = self._scored(pieces, single)
            alpha = self._forward(arcs)
            backwards = [a[:, ::-1] for a in arcs]
            beta = self._forward(backwards)[::-1]
            whole = np.log(counts[rows]) - alpha[-1]
            length = chars.shape[1]
            for k, (piece, score) in enumerate(zip(pieces, arcs), start=1):
                used = score + alpha[: length - k + 1].T + beta[k:].T + whole[:, None]
                used = np.exp(used)
                hit = piece != _NONE
                total += np.bincount(piece[hit], used[hit], len(total))
                if k == 1:
                    for raw, where in spelled:
                        np.add.at(total, raw, used[where].sum())
        return total


def _hash(piece: str) -> int:
    value = 0
    for char in piece:
        value = (value + ord(char) + 1) * int(_BASE) & (1 << 64) - 1
    return value


def _log_sum(ways: np.ndarray) -> np.ndarray:
    top = ways.max(axis=0)
    base = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return base + np.log(np.exp(ways - base).sum(axis=0))
