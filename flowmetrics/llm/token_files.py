"""Token ids as Parquet list columns that are read by need: ids, or only counts and places.

Ids are dictionary-encoded (integers without repeats, such as document ids, fall back to delta
encoding under writer version 2), row groups and pages are bounded, and Parquet's page index lets
a filter on the document id skip pages. Rows stand in document order across the files: the table
is range-partitioned, and each row tells its partition and the ids before it there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmetrics.llm.batches import slices
from flowmetrics.llm.tokens import process_encoder, vocabulary_path, with_end
from flowmetrics.sources.scratch import scratch_path, written

FILE_OPTIONS = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.enable.dictionary": "true",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(1 << 20),
}
SCHEMA = "doc_id bigint, part int, part_start bigint, n_tokens bigint, ids array<int>"


def write_token_files(
    docs: DataFrame, path: str, end_id: int, tokenizer: str | None = None
) -> None:
    """Encode ``text`` of each document, append ``end_id`` and write the rows by rising ``doc_id``.

    A text of any length is encoded whole, by itself if it is long, and is one cell of the file.

    Texts are range-partitioned by document id (then by a hash of the text, so rows that share an
    id spread too), which is the one shuffle. A NULL text is empty and gives the end id alone; a
    NULL id sorts first. Repeated rows are all written. An empty table gives a file without rows.
    Other columns are left out.
    """
    vocabulary = tokenizer or vocabulary_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = process_encoder(vocabulary)
        part = TaskContext.get().partitionId()
        before = 0
        for batch in slices(batches, "text"):
            ids, ends = with_end(*encoder.encode(batch.column("text")), end_id)
            offsets = np.concatenate(([0], ends))
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(rows, part, np.int32)),
                    pa.array(before + offsets[:-1]),
                    pa.array(np.diff(offsets)),
                    pa.ListArray.from_arrays(
                        pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32))
                    ),
                ],
                names=["doc_id", "part", "part_start", "n_tokens", "ids"],
            )
            before += int(offsets[-1])

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    dealt = keyed.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    rows = dealt.mapInArrow(encode, SCHEMA)
    rows.write.options(**FILE_OPTIONS).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``.

    The starts come from one row per partition of the write, 12 bytes, which stand in a small file:
    Spark broadcasts it for its size, so ids are read where they lie and not shuffled. Only columns
    that are used are read.
    """
    files = spark.read.schema(SCHEMA).parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    # One row per partition of the write, in one task.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = files.join(written(starts, scratch_path(spark, "token-starts")), "part")
    start = (F.col("_before") + F.col("part_start")).alias("start")
    return placed.select("doc_id", start, "n_tokens", "ids")


def read_document(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """The rows of one document; page statistics of ``doc_id`` tell which pages to open."""
    return spark.read.schema(SCHEMA).parquet(path).where(F.col("doc_id") == doc_id)


def with_crc32(rows: DataFrame) -> DataFrame:
    """``ids`` replaced by ``ids_crc32``: unsigned, over ids as little-endian 32-bit integers."""
    kept = [c for c in rows.columns if c != "ids"]
    kinds = dict(rows.dtypes)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4").data.cast("B")
            offsets = lists.offsets.to_pylist()
            crcs = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:])]
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(crcs, pa.int64())], names=[*kept, "ids_crc32"]
            )

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept)
    return rows.mapInArrow(digest, f"{schema}, ids_crc32 bigint")
