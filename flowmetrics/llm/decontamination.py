"""Documents that hold a benchmark item, its passages in any order, by greedy string tiling.

Runs of ``seed`` tokens that a document shares with an item make a candidate pair. On a pair, the
longest common run of unmarked tokens is marked again and again until none of the least length is
left; since tiles do not overlap and may lie in any order, moved passages count like unmoved ones.
The share of the item's tokens under tiles decides.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmetrics.llm.batches import slices, split_words, window_hashes, word_hashes
from flowmetrics.llm.bits import filter_bits, passes
from flowmetrics.llm.columns import apart, together
from flowmetrics.sources.scratch import scratch_path, written

#: Tokens of the shortest tile, and of a seed; an item of fewer is one tile and one seed.
LEAST_TILE = 5
COVERAGE = 0.6
_BASE = 1_000_003
_MASK = (1 << 64) - 1

# Bytes as they are compared, once in lower case: ASCII punctuation and controls are white space.
_SEEN_AS = np.array([c if c >= 128 or chr(c).isalnum() else 32 for c in range(256)], np.uint8)


def plain_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the texts' words without case and punctuation, and where each text's end."""
    whole = pa.concat_arrays([pc.utf8_lower(pc.fill_null(column, ""))])
    _, offsets, data = whole.buffers()
    seen = _SEEN_AS[np.frombuffer(data or b"", np.uint8)]
    plain = pa.StringArray.from_buffers(len(whole), offsets, pa.py_buffer(seen.tobytes()))
    ends, words = split_words(plain, lower=False)
    return word_hashes(words), ends


def greedy_tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two token sequences: (place in doc, place in item, length).

    Runs of ``least`` tokens of the item are put in a table by their Karp-Rabin hash, and the
    document's runs, whose hash is rolled from token to token, are looked up in it; what they
    agree on is extended to the longest common run. Runs are marked by length, then by place; one
    that marked tokens cut is put back as what is left of it.
    """
    a, b = doc.tolist(), item.tolist()
    table: dict[int, list[int]] = {}
    for place, value in _rolled(b, least):
        table.setdefault(value, []).append(place)
    heap = []
    reached: dict[int, int] = {}  # by diagonal, where its last run ended
    for i, value in _rolled(a, least):
        for j in table.get(value, ()):
            if reached.get(i - j, -1) > i or a[i : i + least] != b[j : j + least]:
                continue
            n = least
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                n += 1
            reached[i - j] = i + n
            heap.append((-n, i, j))
    heapq.heapify(heap)
    in_doc, in_item = np.zeros(len(a), bool), np.zeros(len(b), bool)
    tiles = []
    while heap:
        size, i, j = heapq.heappop(heap)
        taken = in_doc[i : i - size] | in_item[j : j - size]
        if not taken.any():
            tiles.append((i, j, -size))
            in_doc[i : i - size] = in_item[j : j - size] = True
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([True], taken, [True]))))
        for first, last in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if last - first >= least:
                heapq.heappush(heap, (first - last, i + first, j + first))
    return tiles


def _rolled(tokens: list[int], width: int) -> Iterator[tuple[int, int]]:
    """The Karp-Rabin hash of each run of ``width`` tokens."""
    if len(tokens) < width:
        return
    top = pow(_BASE, width - 1, 1 << 64)
    value = 0
    for t in tokens[:width]:
        value = (value * _BASE + t) & _MASK
    yield 0, value
    for i in range(width, len(tokens)):
        value = ((value - tokens[i - width] * top) * _BASE + tokens[i]) & _MASK
        yield i - width + 1, value


def _item_seeds(items: DataFrame, least: int) -> DataFrame:
    """``seed``, ``item``, how often the item has it (``times``), the item's ``n_tokens``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, ends = plain_words(batch.column("text"))
            start = 0
            for item, end in zip(batch.column("item").to_pylist(), ends.tolist()):
                width = min(least, end - start)
                runs = window_hashes(hashes[start:end], width) if width else hashes[:0]
                seeds, times = np.unique(runs, return_counts=True)
                n = len(seeds)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(seeds.view(np.int64)), pa.array(np.full(n, item, np.int64)),
                        pa.array(times), pa.array(np.full(n, end - start, np.int64)),
                    ],
                    names=["seed", "item", "times", "n_tokens"],
                )
                start = end

    return items.mapInArrow(rows, "seed bigint, item bigint, times bigint, n_tokens bigint")


def contaminated(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = LEAST_TILE
) -> DataFrame:
    """One row per document and item it covers: ``doc_id``, ``text_key`` (xxhash64 of the text),
    ``item_id``, ``item_tokens``, ``covered_tokens``, ``coverage``, ``n_tiles``, ``longest_tile``.

    Words are compared without case and ASCII punctuation. An item of fewer than ``least`` words
    is found where all of them stand in a row; NULL and empty texts, and texts without a word, on
    either side match nothing; repeated rows of documents give repeated rows, repeated items one. An empty table on either side gives no rows; further
    columns are not used. A text of any length is hashed whole, by itself if it is long, in memory
    that grows with its words; a pair of a long text and an item goes to one task.

    Documents are read once, against a bit filter of the items' seeds whose size is bounded;
    those that pass it are written, and seeds are joined, so neither side is held whole anywhere.
    A pair is tiled only if the item places of its shared seeds could add up to the coverage.
    """
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").where("text IS NOT NULL").distinct()
    items = items.withColumn("item", F.xxhash64("item_id", "text"))
    items = written(items, scratch_path(spark, "items"))
    seeds = written(_item_seeds(items, least), scratch_path(spark, "item-seeds"))
    filled = filter_bits(seeds.select(F.col("seed").alias("key")))
    width = F.least(F.lit(least), F.col("n_tokens"))
    # At most ``least`` rows; a run's hash tells its length.
    widths = [int(r[0]) for r in seeds.select(width).distinct().collect()]

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches, "text"):
            hashes, ends = plain_words(batch.column("text"))
            docs_hit, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for n in widths:
                runs = window_hashes(hashes, n)
                at = np.flatnonzero(passes(runs, filled))
                doc = np.searchsorted(ends, at, side="right")
                inside = at + n <= ends[doc] if len(at) else np.zeros(0, bool)
                docs_hit.append(doc[inside])
                found.append(runs[at[inside]])
            doc = np.concatenate(docs_hit)
            by_doc = np.argsort(doc, kind="stable")
            which, first = np.unique(doc[by_doc], return_index=True)
            hit_seeds = np.concatenate(found)[by_doc]
            lists = [np.unique(x).view(np.int64) for x in np.split(hit_seeds, first[1:])]
            lists = lists if len(which) else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + which), batch.column("doc_id").take(pa.array(which)),
                    batch.column("text").take(pa.array(which)),
                    pa.array(lists, pa.list_(pa.int64())),
                ],
                names=["row", "doc_id", "text", "seeds"],
            )
            row += batch.num_rows

    hits = docs.select("doc_id", "text").mapInArrow(
        hit, "row bigint, doc_id bigint, text string, seeds array<bigint>"
    )
    hits = written(hits, scratch_path(spark, "seed-hits"))
    shared = hits.select("row", F.explode("seeds").alias("seed")).join(seeds, "seed")
    pairs = shared.groupBy("row", "item").agg(
        F.sum("times").alias("places"), F.first("n_tokens").alias("n_tokens")
    )
    pairs = pairs.where(F.col("places") * width >= coverage * F.col("n_tokens"))
    texts = hits.select("row", "doc_id", "text")
    item_texts = items.select("item", "item_id", F.col("text").alias("item_text"))
    both = pairs.select("row", "item").join(texts, "row").join(item_texts, "item")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for part in slices([batch], "text"):
                doc, doc_ends = plain_words(part.column("text"))
                item, item_ends = plain_words(part.column("item_text"))
                a = b = 0
                for a_end, b_end in zip(doc_ends.tolist(), item_ends.tolist()):
                    tiles = greedy_tiles(doc[a:a_end], item[b:b_end], min(least, b_end - b))
                    sizes = [n for _, _, n in tiles]
                    out.append((b_end - b, sum(sizes), len(sizes), max(sizes, default=0)))
                    a, b = a_end, b_end
            columns = [pa.array(c, pa.int64()) for c in zip(*out)] or [pa.array([], pa.int64())] * 4
            kept = batch.select(["doc_id", "text_key", "item_id"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *columns],
                names=[*kept.schema.names, "item_tokens", "covered_tokens", "n_tiles", "longest_tile"],
            )

    keyed = both.select("doc_id", F.xxhash64("text").alias("text_key"), "item_id", "text", "item_text")
    tiled = keyed.mapInArrow(
        tile,
        "doc_id bigint, text_key bigint, item_id bigint, item_tokens bigint, covered_tokens bigint, "
        "n_tiles bigint, longest_tile bigint",
    )
    share = (F.col("covered_tokens") / F.col("item_tokens")).alias("coverage")
    return tiled.select("*", share).where(F.col("coverage") >= coverage)


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = LEAST_TILE
) -> DataFrame:
    """The documents that no item is found in, all columns as they are, whatever their names."""
    named = apart(docs, "doc_id", "text")
    found = contaminated(named, benchmark, coverage, least)
    keys = found.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_key"))
    return together(named.join(keys, same, "left_anti"), docs)
