"""Documents drawn so that their features come to resemble a target's.

Features are hashed to buckets, counted over the corpus and over the target, and each bucket's
gain, the log of how much more frequent it is in the target, stands in one bounded array. A
document's weight is the mean of its features' gains; Gumbel noise from a hash of its id makes the
highest scores a draw without replacement in proportion to the exponential of the weights.

The cut between drawn and undrawn is found exactly without sorting all: every partition names the
median of the keys it has left, the median of these weighted by what is left lies above and below
guaranteed quarters of all, and the side that cannot hold the cut is discarded. Only the winners
are sorted.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmetrics.llm.batches import slices, texts
from flowmetrics.llm.ordering import numbered, range_ranked
from flowmetrics.sources.scratch import scratch_path, written

BUCKETS = 10_000
#: Words longer than this are hashed one by one, all others together.
LONG_WORD = 48
#: Text bytes looked at together in a task.
FEATURE_BYTES = 4 << 20
#: Keys left that are fetched and ordered at once.
FEW = 256

_POLYNOMIAL = 0xEDB88320


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


_CRC = _crc_table()
#: Bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased.
_IN_WORD = np.zeros(256, bool)
_IN_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[0x41:0x5B] += 32


def feature_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes of all texts, begin and length of each word in them, and where each
    text's words end."""
    whole = pa.concat_arrays([texts(column)])
    ends = np.frombuffer(whole.buffers()[1], np.int32, len(whole) + 1).astype(np.int64)
    raw = np.frombuffer(whole.buffers()[2], np.uint8, ends[-1]) if ends[-1] else np.zeros(0, np.uint8)
    data = _LOWERED[raw]
    word = _IN_WORD[data]
    # One place more than bytes, so that the last word ends, too.
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    begins = np.flatnonzero(word & (edge[:-1] | ~np.append(False, word[:-1]))) if len(data) else ends[:0]
    after = np.append(word[1:], False) if len(data) else word
    stops = np.flatnonzero(word & (edge[1:] | ~after)) + 1 if len(data) else ends[:0]
    return data, begins, stops - begins, np.searchsorted(begins, ends[1:])


def _crc_on(
    state: np.ndarray, data: np.ndarray, begins: np.ndarray, lengths: np.ndarray
) -> np.ndarray:
    """Raw CRC-32 states carried on over ``lengths`` bytes from ``begins``, all at once."""
    order = np.argsort(-lengths, kind="stable")
    out, at, left = state[order], begins[order], lengths[order]
    short = np.searchsorted(-left, -LONG_WORD, side="left")
    for i in range(short):
        piece = data[at[i] : at[i] + left[i]]
        out[i] = ~np.uint32(zlib.crc32(piece, int(~out[i])))
    most = int(left[short]) if short < len(left) else 0
    for k in range(most):
        n = np.searchsorted(-left, -k, side="left")  # those longer than k
        place = slice(short, n)
        out[place] = (out[place] >> np.uint32(8)) ^ _CRC[(out[place] ^ data[at[place] + k]) & np.uint32(255)]
    back = np.empty_like(out)
    back[order] = out
    return back


def feature_buckets(column: pa.Array, runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all texts' features, where each text's end, and how many words it has.

    Features are all runs of 1 to ``runs`` neighbouring words, joined by a space; a bucket is the
    CRC-32 of its bytes modulo ``buckets``.
    """
    data, begins, lengths, ends = feature_words(column)
    counts = np.diff(np.concatenate(([0], ends)))
    text = np.repeat(np.arange(len(counts)), counts)
    made, owners = [], []
    state = np.full(len(begins), 0xFFFFFFFF, np.uint32)
    first = np.arange(len(begins))
    for k in range(runs):
        if k:  # runs that end at a text's last word go no further
            more = first + k < ends[text[first]]
            first, state = first[more], state[more]
            state = (state >> np.uint32(8)) ^ _CRC[(state ^ np.uint32(32)) & np.uint32(255)]
        state = _crc_on(state, data, begins[first + k], lengths[first + k])
        made.append((~state % np.uint32(buckets)).astype(np.int32))
        owners.append(text[first])
    found, owner = np.concatenate(made), np.concatenate(owners)
    if runs > 1:
        order = np.argsort(owner, kind="stable")
        found, owner = found[order], owner[order]
    return found, np.searchsorted(owner, np.arange(len(counts)), side="right"), counts


def bucket_rows(docs: DataFrame, runs: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``doc_id``, ``n_words`` and ``buckets`` (one per feature, repeats kept) of each document."""

    def hash_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", FEATURE_BYTES):
            found, ends, words = feature_buckets(batch.column("text"), runs, buckets)
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(words),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(found)),
                ],
                names=["doc_id", "n_words", "buckets"],
            )

    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return read.mapInArrow(hash_features, "doc_id bigint, n_words bigint, buckets array<int>")


def bucket_counts(rows: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features by bucket: each task counts its own, and sends at most one row per bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(buckets, np.int64)
        for batch in batches:
            held += np.bincount(batch.column("buckets").flatten().to_numpy(), minlength=buckets)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[some])], names=["bucket", "n"])

    counted = rows.select("buckets").mapInArrow(count, "bucket bigint, n bigint")
    table = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floor of 1000 times the log of a bucket's smoothed share in the target over the corpus's."""
    buckets, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (s_all + buckets) / ((s + 1) * (t_all + buckets))))
            for s, t in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def gumbel(seed: int, key: int | None) -> int:
    """Noise of one document in thousandths, from its id alone; NULL counts as no digits."""
    digits = sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8]
    return math.floor(-1000 * math.log(-math.log((int(digits, 16) + 0.5) / 4294967296)))


def scored(rows: DataFrame, gains: np.ndarray, seed: int) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight`` and ``score`` of :func:`bucket_rows`."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("buckets")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            sums = np.concatenate(([0], np.cumsum(gains[lists.values.to_numpy()])))
            n = np.diff(offsets)
            total = sums[offsets[1:]] - sums[offsets[:-1]]
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            noise = [gumbel(seed, key) for key in batch.column("doc_id").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("n_words"),
                    *map(pa.array, (n, weight, weight + np.array(noise, np.int64))),
                ],
                names=["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return rows.mapInArrow(
        weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"
    )


# --- the exact cut ----------------------------------------------------------------------------

Key = tuple[int, ...]


def _literal(key: Key) -> Column:
    return F.struct(*[F.lit(x).cast("bigint") for x in key])


def _before(keys: Sequence[np.ndarray], bound: Key) -> np.ndarray:
    """Which keys come before the bound, column after column."""
    less = np.zeros(len(keys[0]), bool)
    equal = np.ones(len(keys[0]), bool)
    for column, limit in zip(keys, bound):
        less |= equal & (column < limit)
        equal &= column == limit
    return less


@dataclass(frozen=True)
class Half:
    """What a partition has left on one side of a pivot: how many keys, and their median."""

    n: int
    median: Key | None


def _half(keys: Sequence[np.ndarray], chosen: np.ndarray) -> Half:
    left = [c[chosen] for c in keys]
    n = len(left[0])
    if not n:
        return Half(0, None)
    order = np.lexsort(left[::-1])
    return Half(n, tuple(int(c[order[(n - 1) // 2]]) for c in left))


def weighted_median(halves: Sequence[Half]) -> Key:
    """The least median with at least half of all keys in partitions whose medians reach up to it."""
    real = sorted((h for h in halves if h.n), key=lambda h: h.median)
    half, seen = sum(h.n for h in real), 0
    for h in real:
        seen += h.n
        if 2 * seen >= half:
            return h.median
    raise ValueError("no keys left")


def cut_key(keys: DataFrame, columns: Sequence[str], count: int, few: int = FEW) -> Key | None:
    """The ``count``-th least key of a written table, or None if it has fewer (or none is sought).

    Keys are distinct tuples of long columns without NULLs. Each round is one job that returns a
    row per partition; a median of medians has a quarter of all that is left on either side, so
    rounds grow with the logarithm of the rows. The last ``few`` keys are fetched and ordered.
    """
    width = len(columns)
    none = [-(1 << 63)] * width
    schema = "n bigint, m array<bigint>, k bigint, l array<bigint>"

    def look(low: Key | None, pivot: Key | None, high: Key | None) -> list[tuple[Half, Half]]:
        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = []
            for batch in batches:
                got = [batch.column(c).to_numpy() for c in columns]
                inside = np.ones(batch.num_rows, bool)
                if low is not None:
                    inside &= ~_before(got, (*low[:-1], low[-1] + 1))
                if high is not None:
                    inside &= _before(got, high)
                held.append([c[inside] for c in got])
            if not held:
                return
            all_ = [np.concatenate(c) for c in zip(*held)]
            upto = np.ones(len(all_[0]), bool)
            if pivot is not None:
                upto = _before(all_, (*pivot[:-1], pivot[-1] + 1))
            a, b = _half(all_, upto), _half(all_, ~upto)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([a.n], pa.int64()), pa.array([a.median or none], pa.list_(pa.int64())),
                    pa.array([b.n], pa.int64()), pa.array([b.median or none], pa.list_(pa.int64())),
                ],
                names=["n", "m", "k", "l"],
            )

        # The first column bounds the scan.
        left = keys.select(*columns)
        if low is not None:
            left = left.where(F.col(columns[0]) >= low[0])
        if high is not None:
            left = left.where(F.col(columns[0]) <= high[0])
        found = left.mapInArrow(measure, schema).collect()
        return [(Half(r["n"], tuple(r["m"])), Half(r["k"], tuple(r["l"]))) for r in found]

    low = high = None
    halves = [a for a, _ in look(None, None, None)]
    left = sum(h.n for h in halves)
    if not 0 < count <= left:
        return None
    while left > max(few, 1):
        pivot = weighted_median(halves)
        both = look(low, pivot, high)
        upto = sum(a.n for a, _ in both)
        if count <= upto:
            # The pivot may itself be the key sought, so it stays.
            high, halves, left = (*pivot[:-1], pivot[-1] + 1), [a for a, _ in both], upto
            if upto == count:
                return pivot
        else:
            low, halves, left, count = pivot, [b for _, b in both], left - upto, count - upto
    rest = keys.select(*columns)
    if low is not None:
        rest = rest.where(F.struct(*columns) > _literal(low))
    if high is not None:
        rest = rest.where(F.struct(*columns) < _literal(high))
    return tuple(rest.orderBy(*columns).limit(count).collect()[-1])


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    runs: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
    few: int = FEW,
) -> DataFrame:
    """Every document's ``doc_id``, ``n_features``, ``weight``, ``score`` and ``rank``, all long.

    Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the whole text with A-Z lower-cased. Of the
    documents with ``least_words`` words, ``percent`` in a hundred (rounded down) with the highest
    scores are drawn and ranked from 1; others have no rank. Ties go to the smaller ``doc_id``, a
    NULL one last; rows that repeat an id then go by ``n_features``, and are interchangeable if that
    is equal, too. A NULL or empty text has no features and the weight 0. Further columns are not
    read. An empty table, or an empty target (all counts 0), is no error.

    Texts are read once, into a table of bucket numbers. What the driver holds: two arrays of
    ``buckets`` counts, one row per partition and round of the selection, ``few`` keys at its end.
    """
    spark = docs.sparkSession
    rows = written(bucket_rows(docs, runs, buckets), scratch_path(spark, "feature-buckets"))
    wanted = bucket_counts(bucket_rows(target.select(F.lit(0).alias("doc_id"), "text"), runs, buckets), buckets)
    gains = bucket_gains(bucket_counts(rows, buckets), wanted)
    made = scored(rows, gains, seed).select(
        "*",
        (-F.col("score")).alias("down"),
        F.when(F.col("doc_id").isNull(), 1).otherwise(0).cast("bigint").alias("unnamed"),
        F.coalesce("doc_id", F.lit(0).cast("bigint")).alias("name"),
        (F.col("n_words") >= least_words).alias("enough"),
    )
    table = numbered(made, "at", "scored-documents")
    order = ["down", "unnamed", "name", "n_features", "at"]
    able = table.where("enough")
    cut = cut_key(able, order, percent * able.count() // 100, few)
    results = ["doc_id", "n_features", "weight", "score"]
    if cut is None:
        return table.select(*results, F.lit(None).cast("bigint").alias("rank"))
    drawn = F.col("enough") & (F.struct(*order) <= _literal(cut))
    winners = range_ranked(
        table.where(drawn).select(*results, *[c for c in order if c not in results]),
        [F.col(c) for c in order], "place", "drawn-documents",
    )
    others = table.where(~drawn).select(*results, F.lit(None).cast("bigint").alias("rank"))
    return winners.select(*results, (F.col("place") + 1).alias("rank")).union(others)
