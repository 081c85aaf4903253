"""How filters overlap: what each removes at each step of every order they can be applied in.

A document's failures are a mask, one bit per filter. The mask alone decides where each order
removes the document, so every mask is mapped to one wide integer with a field per (order, step),
1 where the order removes it, and a last field that counts the document. Integers of a part are
added up; a field has more bits than the table has rows, so no sum overflows into the next. The
fields are then read back: what an order keeps, what a filter fails alone or after others, and its
share over all orders all follow from them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import blake2b
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmetrics.llm.batches import slices, split_words, texts, word_hashes
from flowmetrics.sources.scratch import scratch_path, written

#: Filters by letter, in the order of the mask's bits.
LETTERS = "ABCDE"
#: Parts whose sums a task holds before it hands them on.
HELD_PARTS = 512
#: Fixed by the filters: characters that D looks for.
SYMBOLS = b"#$%&*|"

_COUNTS = (
    "kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, "
    "toxic_lost bigint, shapley bigint"
)


@dataclass(frozen=True)
class Fields:
    """The layout of the integers: orders of the letters, steps within, ``width`` bits a field."""

    letters: str
    width: int

    @property
    def orders(self) -> list[tuple[int, ...]]:
        return list(permutations(range(len(self.letters))))

    def packed(self, mask: int) -> int:
        """The integer of a mask: the step at which each order removes it, and one document."""
        steps = len(self.letters)
        orders = self.orders
        out = 1 << (len(orders) * steps * self.width)
        for i, order in enumerate(orders):
            step = next((s for s, f in enumerate(order) if mask >> f & 1), None)
            if step is not None:
                out |= 1 << ((i * steps + step) * self.width)
        return out

    def unpacked(self, total: int) -> tuple[np.ndarray, int]:
        """Counts by order and step, and the number of documents."""
        orders, steps = len(self.orders), len(self.letters)
        low = (1 << self.width) - 1
        counts = [total >> (i * self.width) & low for i in range(orders * steps + 1)]
        return np.array(counts[:-1], np.int64).reshape(orders, steps), counts[-1]


def _spaced(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each text begins and ends in them."""
    whole = pa.concat_arrays([column])
    ends = np.frombuffer(whole.buffers()[1], np.int32, len(whole) + 1).astype(np.int64)
    data = whole.buffers()[2]
    return np.frombuffer(data, np.uint8, ends[-1]) if ends[-1] else np.zeros(0, np.uint8), ends


def _per_text(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many of the bytes flagged lie in each text."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[ends[1:]] - sums[ends[:-1]]


def _distinct_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Words and distinct words of each text."""
    ends, words = split_words(column, lower=False)
    counts = np.diff(np.concatenate(([0], ends)))
    owner = np.repeat(np.arange(len(counts)), counts)
    hashes = word_hashes(words)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return counts, np.bincount(owner[new], minlength=len(counts))


def text_masks(column: pa.Array) -> np.ndarray:
    """The failures A to D of each text as bits 0 to 3."""
    column = texts(column)
    words, distinct = _distinct_words(column)
    data, ends = _spaced(column)
    points = _per_text((data & 0xC0) != 0x80, ends)
    capitals = _per_text((data >= 65) & (data <= 90), ends)
    marked = np.zeros(256, bool)
    marked[list(SYMBOLS)] = True
    failed = [
        words < 200,
        100 * distinct < 50 * words,
        100 * capitals > 3 * points,
        _per_text(marked[data], ends) > 0,
    ]
    return sum(f.astype(np.int32) << i for i, f in enumerate(failed))


def failure_masks(docs: DataFrame, part: str = "lang") -> DataFrame:
    """``doc_id``, ``part``, ``mask`` of each document, all five failures in it.

    A: under 200 words. B: fewer distinct words than half. C: more than 3 % of the characters are
    A-Z. D: any of ``#$%&*|``. E: the text of a smaller ``doc_id``, anywhere in the table. Words
    are ``[^\\x20\\x09-\\x0D]+`` of the whole text, case-sensitive; NULL text is empty, a NULL part is
    the empty one. A NULL id is smaller than none and has none smaller, so it never fails E; rows
    that repeat an id and its text all fail E, or none. An empty table gives no rows; other
    columns, whatever their names, are not read. Texts are compared by hashes of 128 bits.

    Spread: hashes are grouped with partial sums, and joined back by hash and id together, so a
    text that most documents share is no task's own.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            column = texts(batch.column("text"))
            raw = column.cast(pa.binary()).to_pylist()
            digests = b"".join(blake2b(t, digest_size=16).digest() for t in raw)
            halves = np.frombuffer(digests, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("part"),
                    pa.array(text_masks(column), pa.int32()),
                    pa.array(halves[:, 0].copy()),
                    pa.array(halves[:, 1].copy()),
                ],
                names=["doc_id", "part", "mask", "h", "k"],
            )

    read = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
    )
    made = read.mapInArrow(measure, "doc_id bigint, part string, mask int, h bigint, k bigint")
    rows = written(made, scratch_path(docs.sparkSession, "audit-rows"))
    first = rows.where("doc_id IS NOT NULL").groupBy("h", "k").agg(F.min("doc_id").alias("doc_id"))
    first = first.withColumn("first", F.lit(True))
    marked = rows.join(first, ["h", "k", "doc_id"], "left")
    same = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), 16).otherwise(0)
    return marked.select("doc_id", "part", (F.col("mask") + same).alias("mask"))


def with_labels(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part`` and ``mask`` with ``good`` (quality 1) and ``toxic`` (toxic 1), else false.

    Several labels of one id count as one that says what any of them says. NULL ids have none.
    """
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.col("quality").eqNullSafe(1)).alias("good"),
        F.max(F.col("toxic").eqNullSafe(1)).alias("toxic"),
    )
    no = F.lit(False)
    return masks.join(known, "doc_id", "left").select(
        "part", "mask", F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic")
    )


def _row(part: str, sums: Sequence[int]) -> tuple[str, list[bytes]]:
    return part, [n.to_bytes(n.bit_length() // 8 + 1, "little") for n in sums]


_SUMS = ["every", "good", "toxic"]


def packed_sums(rows: DataFrame, fields: Fields) -> DataFrame:
    """Per task and part the sums of the masks' integers: of all rows, good ones, toxic ones."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        integers = [fields.packed(m) for m in range(1 << len(fields.letters))]
        held: dict[str, list[int]] = {}
        for batch in batches:
            parts = batch.column("part").dictionary_encode()
            names = parts.dictionary.to_pylist()
            key = parts.indices.to_numpy().astype(np.int64) << len(fields.letters)
            key = (key + batch.column("mask").to_numpy()) << 2
            key += batch.column("good").to_numpy(zero_copy_only=False).astype(np.int64) << 1
            key += batch.column("toxic").to_numpy(zero_copy_only=False)
            for code, n in zip(*(x.tolist() for x in np.unique(key, return_counts=True))):
                name = names[code >> (len(fields.letters) + 2)]
                times = n * integers[code >> 2 & (1 << len(fields.letters)) - 1]
                sums = held.setdefault(name, [0, 0, 0])
                sums[0] += times
                sums[1] += times if code & 2 else 0
                sums[2] += times if code & 1 else 0
            if len(held) >= HELD_PARTS:
                yield _batch(held)
                held = {}
        if held:
            yield _batch(held)

    def _batch(held: dict[str, list[int]]) -> pa.RecordBatch:
        made = [_row(part, sums) for part, sums in held.items()]
        columns = [pa.array([p for p, _ in made])]
        columns += [pa.array([s[i] for _, s in made], pa.binary()) for i in range(3)]
        return pa.RecordBatch.from_arrays(columns, names=["part", *_SUMS])

    return rows.select("part", "mask", "good", "toxic").mapInArrow(
        add, "part string, every binary, good binary, toxic binary"
    )


def step_rows(part: str, sums: Sequence[int], fields: Fields) -> pa.RecordBatch:
    """One row per order and step of a part, from its three sums."""
    orders, steps = np.array(fields.orders), len(fields.letters)
    removed, documents = fields.unpacked(sums[0])
    good, _ = fields.unpacked(sums[1])
    toxic, _ = fields.unpacked(sums[2])
    # A filter that goes first removes all that fail it; one that goes last, what only it fails.
    fails, alone, share = (np.zeros(steps, np.int64) for _ in range(3))
    fails[orders[:, 0]] = removed[:, 0]
    alone[orders[:, -1]] = removed[:, -1]
    np.add.at(share, orders, removed)
    names = ["".join(fields.letters[f] for f in order) for order in orders]
    n = orders.size
    columns = {
        "part": pa.array([part] * n),
        "filter_order": pa.array(np.repeat(names, steps)),
        "step": pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(orders))),
        "kept": documents - np.cumsum(removed, axis=1),
        "removed": removed,
        "redundant": fails[orders] - removed,
        "unique_fails": alone[orders],
        "good_lost": good,
        "toxic_lost": toxic,
        "shapley": share[orders],
    }
    arrays = [c if isinstance(c, pa.Array) else pa.array(c.ravel()) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def filter_interactions(rows: DataFrame, letters: str = LETTERS) -> DataFrame:
    """What each filter does at each step of every order, per part: zeros included.

    ``rows`` has ``part`` (not NULL), ``mask`` (bit i: fails filter i of ``letters``), ``good`` and
    ``toxic``. Per ``part``, ``filter_order`` and ``step`` (from 1): documents ``kept`` after the step,
    ``removed`` in it, ``redundant`` (fail its filter, but were removed earlier), ``unique_fails`` (fail
    its filter only), ``good_lost`` and ``toxic_lost`` (removed here), ``shapley`` (what its filter
    removes, summed over all orders). Orders are factorial in the filters, so at most six. An
    empty table gives no rows.

    Each task sends one row per part, some kB; those of a part are added in a stream, so neither
    holds a part's documents. The table is read twice (once to count it): pass a written one.
    """
    if not 1 <= len(letters) <= 6:
        raise ValueError("one to six filters")
    fields = Fields(letters, rows.count().bit_length() + 1)
    sums = packed_sums(rows, fields)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, [0, 0, 0]
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ["part", *_SUMS]]
            for name, *binaries in zip(*columns):
                if name != part:
                    if part is not None:
                        yield step_rows(part, held, fields)
                    part, held = name, [0, 0, 0]
                held = [a + int.from_bytes(b, "little") for a, b in zip(held, binaries)]
        if part is not None:
            yield step_rows(part, held, fields)

    by_part = sums.repartition("part").sortWithinPartitions("part")
    return by_part.mapInArrow(merge, f"part string, filter_order string, step int, {_COUNTS}")


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """:func:`filter_interactions` of the five filters of :func:`failure_masks`, by ``part``."""
    rows = with_labels(failure_masks(docs, part), labels)
    return filter_interactions(written(rows, scratch_path(docs.sparkSession, "audit-masks")))
