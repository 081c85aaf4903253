"""Token ids of whole texts by a public tokenizer, each distinct word encoded once.

The tokenizer must drop white space before it forms tokens, as the word-end BPE vocabulary does:
the ids of a text are then those of its words, one after the other. So a task encodes the distinct
words of a slice of texts and puts the ids together by index. A word of plain letters with
punctuation at its end is taken apart further, since the tokenizer separates the two itself.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa

from flowmetrics.llm.batches import split_words

#: Words whose ids a process keeps before it lets go of those that it did not meet again.
CACHED_WORDS = 300_000
# Letters that are lower-cased one by one and never composed, then punctuation.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)").fullmatch


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed public tokenizer file is; the same on every executor."""
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Encodes texts with the tokenizer file at ``path``, without special tokens added."""

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self._tokenizer = Tokenizer.from_file(path)
        self._byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _learn(self, plain: set[str], others: set[str]) -> None:
        """Ids of words by the whole tokenizer, of plain parts by its model alone.

        A plain part is one pre-token in normal form already, so the model is all it goes through.
        """
        known, tokenize = self._known, self._tokenizer.model.tokenize
        for word in plain:
            mapped = word if word.isascii() else self._bytes(word)
            known[word] = np.array([t.id for t in tokenize(mapped)], "<u4").tobytes()
        listed = sorted(others)
        for at in range(0, len(listed), 4096):
            part = listed[at : at + 4096]
            coded = self._tokenizer.encode_batch_fast(part, add_special_tokens=False)
            for word, got in zip(part, coded):
                known[word] = np.array(got.ids, "<u4").tobytes()

    def _bytes(self, word: str) -> str:
        """The word as the tokenizer's byte-level step spells it."""
        return self._byte_level.pre_tokenize_str(word)[0][0]

    def _pieces(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as bytes."""
        if len(self._known) > CACHED_WORDS:
            self._known, self._older = {}, self._known
        known, older = self._known, self._older
        parts = []
        for word in words:
            plain = _PLAIN(word)
            parts.append((plain[1].lower(), plain[2], True) if plain else (word, "", False))
        plain = {p for a, b, is_plain in parts if is_plain for p in (a, b) if p not in known}
        others = {a for a, _, is_plain in parts if not is_plain and a not in known}
        plain.discard("")
        if older:  # words met again stay for longer
            for new in (plain, others):
                again = new & older.keys()
                known.update((w, older[w]) for w in again)
                new -= again
        if plain or others:
            self._learn(plain, others)
        get = known.__getitem__
        return [get(a) + get(b) if b else get(a) for a, b, _ in parts]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32), and where each text's ids end (int64); NULL counts as empty."""
        word_ends, words = split_words(column, lower=False)
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(word_ends), np.int64)
        coded = words.dictionary_encode()
        pieces = self._pieces(coded.dictionary.to_pylist())
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) // 4
        flat = np.frombuffer(b"".join(pieces), "<u4")
        first = np.cumsum(sizes) - sizes
        codes = coded.indices.to_numpy(zero_copy_only=False)
        lengths = sizes[codes]
        ends = np.cumsum(lengths)
        shift = np.repeat(first[codes] - (ends - lengths), lengths)
        ids = flat[shift + np.arange(len(shift))]
        return ids, np.concatenate(([0], ends))[word_ends]


@lru_cache(maxsize=1)
def process_encoder(path: str) -> WordEncoder:
    """The encoder of this worker process, which later tasks find with its words."""
    return WordEncoder(path)


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same, each text's ids followed by ``end_id``."""
    return np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)
