"""Documents scored by a subword unigram model: the probability of a text over all spellings.

A text is its words (A-Z lower-cased) and an end. No piece reaches over white space, so the
lattice of a text is the chain of its words' lattices and its log probability the sum of theirs:
each distinct word is scored once. Piece scores start from the existing vocabulary's and are
fitted to the training documents' word counts by expectation-maximisation over the same lattices.

Flow: one pass over the texts numbers the words of each block of texts and writes the documents as
word numbers beside the block's words; words are counted over all blocks, scored, joined to the
blocks' words, and each block's documents are added up. No word's occurrences meet in one task,
only one row per block that has it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmetrics.llm.batches import slices, split_words
from flowmetrics.llm.lattice import Lattice, Vocabulary
from flowmetrics.llm.tokens import vocabulary_path
from flowmetrics.sources.scratch import scratch_path, written

#: Text bytes whose words are numbered together.
BLOCK_BYTES = 16 << 20
ROUNDS = 3
_LN10 = math.log(10)

_BLOCKS = (
    "kind string, block bigint, doc_id bigint, held_out boolean, codes array<int>, "
    "word_no int, word string, n_train bigint"
)
_SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


def held_out(doc_id: int | None, folds: int = 10) -> bool:
    """Whether a document is kept from training: crc32 of its id as text, a NULL id as none."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds == 0


def numbered_blocks(docs: DataFrame) -> DataFrame:
    """Rows of kind ``doc`` (word numbers of a document) and ``word`` (a block's words)."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 24
        for batch in slices(batches, "text", BLOCK_BYTES):
            ends, words = split_words(batch.column("text"), lower=True)
            coded = words.dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int32)
            held = np.array([held_out(i) for i in batch.column("doc_id").to_pylist()], bool)
            starts = np.concatenate(([0], ends))
            train = ~np.repeat(held, np.diff(starts))
            counts = np.bincount(codes[train], minlength=len(coded.dictionary))
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(codes))
            yield _rows("doc", block, len(held), batch.column("doc_id"), pa.array(held), lists)
            numbers = pa.array(np.arange(len(counts), dtype=np.int32))
            yield _rows("word", block, len(counts), words=(numbers, coded.dictionary, pa.array(counts)))
            block += 1

    return docs.select("doc_id", "text").mapInArrow(number, _BLOCKS)


def _rows(
    kind: str, block: int, n: int, ids: pa.Array | None = None, held: pa.Array | None = None,
    lists: pa.Array | None = None, words: tuple | None = None,
) -> pa.RecordBatch:
    number, word, count = words or (None, None, None)
    columns = [
        (pa.array([kind]).take(pa.array(np.zeros(n, np.int64))), pa.string()),
        (pa.array(np.full(n, block, np.int64)), pa.int64()),
        (ids, pa.int64()), (held, pa.bool_()), (lists, pa.list_(pa.int32())),
        (number, pa.int32()), (word, pa.string()), (count, pa.int64()),
    ]
    arrays = [pa.nulls(n, kind_) if a is None else a for a, kind_ in columns]
    names = ["kind", "block", "doc_id", "held_out", "codes", "word_no", "word", "n_train"]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def fit_vocabulary(
    counts: DataFrame, texts: int, start: Vocabulary, rounds: int = ROUNDS
) -> Vocabulary:
    """Expectation-maximisation over all words (``word``, ``c``) of the ``texts`` trained on.

    Each task sums what its words use and sends one row per piece; the driver sees one sum per
    piece of the fixed vocabulary.
    """
    for _ in range(rounds if texts else 0):

        def expect(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary = start) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(vocabulary)
            total = np.zeros(len(vocabulary.scores))
            for batch in batches:
                c = batch.column("c").to_numpy()
                total += lattice.expected_counts(batch.column("word").to_pylist(), c)
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(total[used])], names=["piece", "uses"]
            )

        sums = counts.mapInArrow(expect, "piece bigint, uses double").groupBy("piece")
        total = np.zeros(len(start.scores))
        for row in sums.agg(F.sum("uses").alias("uses")).collect():
            total[row["piece"]] = row["uses"]
        total[Vocabulary.END] = texts
        start = start.with_counts(total)
    return start


def score_documents(
    docs: DataFrame, vocabulary: Vocabulary | None = None, rounds: int = ROUNDS
) -> DataFrame:
    """Per document ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (smoothed word unigram) and ``score``, log10 of the text's probability.

    Tokens are the words and one end. NULL or empty text is its end alone; a NULL id is held out;
    repeated rows count, and are scored, as often as they come. Without training documents the
    vocabulary keeps its scores. Other columns are not used. An empty table gives no rows.
    """
    spark = docs.sparkSession
    start = vocabulary or Vocabulary.from_file(vocabulary_path("piece_bpe_32k.model"))
    path = scratch_path(spark, "word-blocks")
    numbered_blocks(docs).write.partitionBy("kind").option("compression", "zstd").parquet(path)
    blocks = spark.read.schema(_BLOCKS).parquet(path)
    texts = blocks.where("kind = 'doc'").select("block", "doc_id", "held_out", "codes")
    words = blocks.where("kind = 'word'").select("block", "word_no", "word", "n_train")
    summed = words.groupBy("word").agg(F.sum("n_train").alias("c"))
    counts = written(summed, scratch_path(spark, "word-counts"))
    seen = counts.where("c > 0")
    known = seen.agg(F.sum("c"), F.count(F.lit(1))).first()
    trained = texts.where("NOT held_out").count()
    train_tokens = (known[0] or 0) + trained
    distinct = known[1] + (1 if trained else 0)
    fitted = fit_vocabulary(seen, trained, start, rounds)
    bottom = train_tokens + 0.1 * (distinct + 1)

    def score_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(fitted)
        for batch in batches:
            logs = lattice.log_marginals(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("c"), pa.array(logs / _LN10)],
                names=["word", "c", "score"],
            )

    scored = counts.mapInArrow(score_words, "word string, c bigint, score double")
    looked_up = words.join(scored, "word").select(
        F.col("block").alias("of_block"), "word_no", "c", "score"
    )
    end_base = math.log10((trained + 0.1) / bottom)
    end_score = float(fitted.scores[Vocabulary.END]) / _LN10

    def add_up(block: pa.Table, values: pa.Table) -> pa.Table:
        number = values.column("word_no").to_numpy()
        c, score = np.zeros(len(number)), np.zeros(len(number))
        c[number] = values.column("c").to_numpy()
        score[number] = values.column("score").to_numpy()
        base = np.log10((c + 0.1) / bottom)
        lists = block.column("codes").combine_chunks()
        ends = np.concatenate(([0], np.cumsum(np.diff(lists.offsets.to_numpy()))))
        codes = lists.flatten().to_numpy()
        n = np.diff(ends)

        def sums(each: np.ndarray) -> np.ndarray:
            # A running sum loses digits over a block; sums by text do not.
            filled = np.append(each[codes], 0.0)
            return np.where(n > 0, np.add.reduceat(filled, ends[:-1]), 0.0)

        known_words = sums((c > 0).astype(float)).astype(np.int64)
        return pa.table(
            {
                "doc_id": block.column("doc_id"),
                "held_out": block.column("held_out"),
                "n_tokens": n + 1,
                "n_known": known_words + (1 if trained else 0),
                "train_tokens": np.full(len(n), train_tokens, np.int64),
                "base_score": sums(base) + end_base,
                "score": sums(score) + end_score,
            }
        )

    return texts.groupBy("block").cogroup(looked_up.groupBy("of_block")).applyInArrow(add_up, _SCORES)
