"""Arrow batches inside tasks: bounded slices, words and their hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes looked at together in a task. One longer text is looked at by itself.
SLICE_BYTES = 8 << 20


def texts(column: pa.Array) -> pa.Array:
    """The texts, NULL as empty."""
    return pc.fill_null(column, "")


def slices(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches with about ``limit`` bytes of text, whatever came in.

    Small batches are joined and large ones cut, so memory does not depend on row counts.
    """
    held: list[pa.RecordBatch] = []
    held_bytes = 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            room = max(1, limit - held_bytes)
            cut = int(np.searchsorted(ends, done + room, side="left")) + 1
            cut = min(max(cut, at + 1), batch.num_rows)
            held.append(batch.slice(at, cut - at))
            held_bytes += int(ends[cut - 1] - done)
            at = cut
            if held_bytes >= limit:
                yield _joined(held)
                held, held_bytes = [], 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    return held[0] if len(held) == 1 else pa.concat_batches(held)


def split_words(column: pa.Array, lower: bool) -> tuple[np.ndarray, pa.Array]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text: where each text's words end, and the words.

    ``lower`` lower-cases A-Z only.
    """
    whole = texts(column)
    if lower:
        whole = pc.ascii_lower(whole)
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(whole))
    words = lists.flatten()
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    # A text without words is split into one empty word.
    real = pc.greater(pc.binary_length(words), 0)
    if len(words) and not pc.all(real).as_py():
        first = np.cumsum(counts) - counts
        empty = ~real.to_numpy(zero_copy_only=False)
        counts = counts - np.add.reduceat(np.append(empty, False).astype(np.int64), first)
        words = words.filter(real)
    return np.cumsum(counts), words


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters their bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight of them at a time."""
    if not len(words):
        return np.zeros(0, np.uint64)
    words = pa.concat_arrays([words])  # offsets from 0
    ends = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1).astype(np.int64)
    padded = np.empty(ends[-1] + 8, np.uint8)
    padded[: ends[-1]] = np.frombuffer(words.buffers()[2], np.uint8, ends[-1])
    padded[ends[-1] :] = 0
    # The eight bytes from every place on, as one integer.
    eight = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    at, left = ends[:-1], np.diff(ends)
    out = mixed(left.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    rows = np.arange(len(words))
    while len(rows):
        chunk = eight[at]
        short = left < 8
        chunk[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
        out[rows] = mixed(out[rows] ^ chunk) + np.uint64(0xD6E8FEB86659FD93)
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    return out


def window_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` neighbours; run i begins at neighbour i."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mixed(out ^ h[k : k + n]) + np.uint64(0x9E3779B97F4A7C15)
    return out
