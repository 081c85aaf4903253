"""Documents packed into fixed windows by minimum bin slack.

A document's ids are cut into full windows and a remainder. What is left to place is a multiset of
remainder lengths: at most ``capacity`` distinct ones, however many documents there are. For one
window after the other, the longest length left is set, and a subset-sum over the others, its
states the bits of one integer, finds the multiset that comes closest to the capacity; the counts
it takes are traced back through the states. The window is then repeated as often as the counts
allow, so the plan is short and made on the driver from counts alone. Tasks read each piece's
window off the plan by its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowmetrics.llm.batches import slices
from flowmetrics.llm.tokens import process_encoder, vocabulary_path, with_end
from flowmetrics.sources.scratch import scratch_path, written

CAPACITY = 2048
_RANKS = 1 << 48  # more than any number of pieces of one length


def closest_fill(counts: Mapping[int, int], space: int) -> dict[int, int]:
    """How many of each length to take so that their sum is as near below ``space`` as can be.

    Bit s of the state says that a sum s can be made. Copies of a length are offered in powers of
    two, longest length first, until the space is met exactly; taking is traced back through the
    states before each offer.
    """
    state, mask = 1, (1 << (space + 1)) - 1
    offers: list[tuple[int, int, int]] = []
    for length in sorted((n for n in counts if n <= space and counts[n]), reverse=True):
        left = min(counts[length], space // length)
        copies = 1
        while left:
            copies = min(copies, left)
            offers.append((state, length, copies))
            state |= (state << (length * copies)) & mask
            left -= copies
            copies *= 2
        if state >> space & 1:
            break
    total = state.bit_length() - 1
    taken: dict[int, int] = {}
    for before, length, copies in reversed(offers):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + copies
            total -= length * copies
    return taken


@dataclass(frozen=True)
class PackingPlan:
    """Rows by (length, first rank): the pieces from there on go, ``per_window`` to a window and
    one after the other, to windows from ``window`` on, the first at ``offset``."""

    keys: np.ndarray
    first_rank: np.ndarray
    per_window: np.ndarray
    window: np.ndarray
    offset: np.ndarray
    windows: int

    def place(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The window and the offset in it of each piece."""
        row = np.searchsorted(self.keys, lengths * _RANKS + ranks, side="right") - 1
        nth = ranks - self.first_rank[row]
        window = self.window[row] + nth // self.per_window[row]
        return window, self.offset[row] + nth % self.per_window[row] * lengths


def plan_windows(counts: Mapping[int, int], capacity: int = CAPACITY) -> PackingPlan:
    """Minimum bin slack over a multiset of lengths, each at most ``capacity``."""
    left = {n: c for n, c in counts.items() if c}
    used = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int, int]] = []
    window = 0
    while left:
        longest = max(left)
        others = left | {longest: left[longest] - 1}
        fill = closest_fill(others, capacity - longest)
        fill[longest] = fill.get(longest, 0) + 1
        repeat = min(left[n] // k for n, k in fill.items())
        offset = 0
        for n in sorted(fill, reverse=True):
            k = fill[n]
            rows.append((n * _RANKS + used[n], used[n], k, window, offset, n))
            used[n] += k * repeat
            offset += k * n
            left[n] -= k * repeat
            if not left[n]:
                del left[n]
        window += repeat
    rows.sort()
    columns = [np.array(c, np.int64) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * 6
    return PackingPlan(*columns[:5], window)


def token_pieces(
    docs: DataFrame, end_id: int, capacity: int = CAPACITY, tokenizer: str | None = None
) -> DataFrame:
    """Full windows and remainder of each document: ``doc_id``, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens``, and ``block`` and ``rank``: the piece's place among those of its
    length that one task made."""
    vocabulary = tokenizer or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = process_encoder(vocabulary)
        block = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, "text"):
            ids, ends = with_end(*encoder.encode(batch.column("text")), end_id)
            tokens = np.diff(np.concatenate(([0], ends)))
            pieces = -(-tokens // capacity)
            row = np.repeat(np.arange(len(tokens)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = nth * capacity
            length = np.minimum(capacity, tokens[row] - start)
            at = (ends - tokens)[row] + start
            raw = memoryview(ids.astype("<u4")).cast("B")
            crcs = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
            rank, seen = _ranks(length, seen)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)),
                    *map(pa.array, (start, length)),
                    pa.array(crcs, pa.int64()),
                    pa.array(tokens[row]),
                    pa.array(np.full(len(row), block, np.int64)),
                    pa.array(rank),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "block", "rank"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        cut,
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "block bigint, rank bigint",
    )


def _ranks(lengths: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each piece among equal lengths, counted on from ``seen``."""
    order = np.argsort(lengths, kind="stable")
    sizes = np.bincount(lengths, minlength=len(seen))
    rank = np.empty(len(lengths), np.int64)
    rank[order] = np.arange(len(lengths)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return rank + seen[lengths], seen + sizes


def pack_documents(
    docs: DataFrame, end_id: int = 1, capacity: int = CAPACITY, tokenizer: str | None = None
) -> DataFrame:
    """Where each piece of each document goes.

    ``doc_id``, ``start`` (ids of the document before the piece), ``length``, ``ids_crc32``
    (unsigned, of the piece's ids as little-endian 32-bit integers), ``doc_tokens`` (with the end
    id), ``sequence_id`` (from 0) and ``offset`` in it. Sequences hold at most ``capacity`` ids and
    are gapless. A NULL or empty text is its end id alone; NULL ids and repeated rows are packed
    as any; an empty table gives no rows. A text of any length is encoded whole, by itself if it is
    long, and cut into as many pieces as it needs. Columns besides ``doc_id`` and ``text`` are not used.

    Texts are read once, into a narrow table of pieces in the shared folder. The driver sees one
    count per length. Ranks within a length are a task's own plus those of the tasks before it, so
    a length that most pieces have needs no common task.
    """
    spark = docs.sparkSession
    made = token_pieces(docs, end_id, capacity, tokenizer)
    pieces = written(made, scratch_path(spark, "pieces"))
    by_block = pieces.groupBy("length", "block").agg(F.count(F.lit(1)).alias("_n"))
    # One row per task and length, at most `capacity` times the number of tasks.
    by_block = written(by_block, scratch_path(spark, "piece-counts"))
    totals = by_block.groupBy("length").agg(F.sum("_n").alias("n")).collect()
    plan = plan_windows({r["length"]: r["n"] for r in totals}, capacity)
    earlier = Window.partitionBy("length").orderBy("block")
    before = F.sum("_n").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    starts = by_block.select("length", "block", F.coalesce(before, F.lit(0)).alias("_before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            window, offset = plan.place(length, batch.column("rank").to_numpy())
            kept = [batch.column(i) for i in range(5)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(window), pa.array(offset)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    ranked = pieces.join(starts, ["length", "block"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("rank") + F.col("_before")).alias("rank"),
    )
    return ranked.mapInArrow(
        place,
        "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint",
    )
