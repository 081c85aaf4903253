"""Byte runs that already stood earlier in the corpus, by a sampled suffix order.

All windows of ``length`` bytes are compared, but not one by one: neighbouring windows share an
anchor (see ``windows``), and a run of them is one entry. Entries are ranged by their anchor's
leading bytes, then by all bytes of the run, then by place, over partitions whose borders Spark
samples; each partition sorts its own, equal entries stand together, and what touches a border is
compared once more. Of equal entries all but the first are repeats.

Where runs with one anchor differ, they may still share some windows. Their bytes are fetched, cut
into runs of at most eight windows around the same place of the anchor, compared in the same
order, and where these still differ, window by window. So hashes of every window are made only
around the edges of repeats. Anchors, runs and windows are told apart by two 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmetrics.llm.batches import mixed, slices, texts
from flowmetrics.llm.columns import apart, together
from flowmetrics.llm.windows import Buffer
from flowmetrics.sources.scratch import scratch_path, written

LENGTH = 100
#: Texts hashed together in a task.
HASHED_BYTES = 2 << 20
#: Windows of a long text that are looked at together.
LONG_BYTES = 4 << 20
#: Windows of one entry of the second comparison.
_STEP = 8

_KEYS = ["gram", "whole", "doc", "tie", "first"]
#: ``windows``: how many start from ``first`` on; ``home``: the run whose bytes were fetched.
_ENTRY = "gram bigint, whole bigint, doc bigint, tie int, first bigint, windows int, home bigint"
_NAMES = [*_KEYS, "windows", "home"]


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc``, ``tie`` and ``text``: a NULL id comes before all others, rows that share an id are
    ordered by a hash of their text."""
    whole = F.coalesce("text", F.lit(""))
    return docs.select(_doc(), _tie(), whole.alias("text"))


def _doc() -> Column:
    return F.coalesce("doc_id", F.lit(-(1 << 63)).cast("bigint")).alias("doc")


def _tie() -> Column:
    whole = F.coalesce("text", F.lit(""))
    return F.shiftright(F.xxhash64(whole), 33).cast("int").alias("tie")


def _buffer(column: pa.Array) -> Buffer:
    whole = pa.concat_arrays([texts(column)])
    starts = np.frombuffer(whole.buffers()[1], np.int32, len(whole) + 1).astype(np.int64)
    data = whole.buffers()[2]
    return Buffer(np.frombuffer(data if data is not None else b"", np.uint8)[: starts[-1]], starts)


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _in_bounds(
    batch: pa.RecordBatch, length: int, longest: int
) -> Iterator[tuple[pa.RecordBatch, int, Buffer]]:
    """The rows in buffers of bounded size, each with the byte place at which its texts begin.

    A text of more than ``longest`` windows is cut into buffers that overlap, so that every window
    is in one of them.
    """
    sizes = pc.binary_length(texts(batch.column("text"))).to_numpy(zero_copy_only=False)
    long = sizes >= longest + length
    if not long.any():
        yield batch, 0, _buffer(batch.column("text"))
        return
    short = batch.filter(pa.array(~long))
    if short.num_rows:
        yield short, 0, _buffer(short.column("text"))
    for i in np.flatnonzero(long).tolist():
        data = np.frombuffer(batch.column("text")[i].as_buffer(), np.uint8)
        for at in range(0, len(data) - length + 1, longest):
            piece = data[at : at + longest + length - 1]
            yield batch.slice(i, 1), at, Buffer(piece, np.array([0, len(piece)], np.int64))


def run_entries(docs: DataFrame, length: int, longest: int = LONG_BYTES) -> DataFrame:
    """One entry per run of windows of every text; long texts cut runs at bounded distances."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in slices(batches, "text", HASHED_BYTES):
            for batch, before, buffer in _in_bounds(whole, length, longest):
                yield _run_rows(batch, before, buffer)

    def _run_rows(batch: pa.RecordBatch, before: int, buffer: Buffer) -> pa.RecordBatch:
        runs = buffer.runs(length)
        row = np.searchsorted(buffer.starts, runs.first, side="right") - 1
        at = pa.array(row)
        first = pa.array(runs.first - buffer.starts[row] + before)
        return pa.RecordBatch.from_arrays(
            [
                _signed(runs.gram), _signed(runs.whole),
                batch.column("doc").take(at), batch.column("tie").take(at), first,
                pa.array((runs.last - runs.first + 1).astype(np.int32)), first,
            ],
            names=_NAMES,
        )

    return _keyed(docs).mapInArrow(entries, _ENTRY)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted entries: those equal to an earlier one (``repeat``), the first ones of anchors
    with several different entries (``open``), all first ones of the outer anchors (``edge``).

    The first entries of an anchor that may go on are held and put before the next batch.
    """
    held: pa.RecordBatch | None = None
    outer = True  # the partition's first anchor may have begun in another one
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        columns = {c: rows.column(c).to_numpy() for c in _KEYS}
        new_gram = np.ones(rows.num_rows, bool)
        new_gram[1:] = columns["gram"][1:] != columns["gram"][:-1]
        new_entry = new_gram.copy()
        new_entry[1:] |= columns["whole"][1:] != columns["whole"][:-1]
        lead = np.maximum.accumulate(np.where(new_entry, np.arange(rows.num_rows), 0))
        # Equal rows of the table have equal places; they do not repeat one another here.
        elsewhere = np.zeros(rows.num_rows, bool)
        for c in ("doc", "tie", "first"):
            elsewhere |= columns[c] != columns[c][lead]
        yield from _kind(rows.filter(pa.array(~new_entry & elsewhere)), "repeat")
        firsts = rows.filter(pa.array(new_entry))
        bounds = np.flatnonzero(new_gram[new_entry])
        sizes = np.diff(bounds)
        many = np.repeat(sizes > 1, sizes)
        if outer and len(sizes):
            yield from _kind(firsts.slice(0, sizes[0]), "edge")
            many[: sizes[0]] = False
            outer = False
        yield from _kind(firsts.slice(0, bounds[-1]).filter(pa.array(many)), "open")
        held = firsts.slice(bounds[-1])
    if held is not None:
        yield from _kind(held, "edge")


def _kind(batch: pa.RecordBatch, kind: str) -> Iterator[pa.RecordBatch]:
    if batch.num_rows:
        yield batch.append_column("kind", pa.array([kind] * batch.num_rows))


def compare_entries(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The entries that repeat an earlier one, and the first entries of anchors that differ."""
    spark = entries.sparkSession
    path = scratch_path(spark, "entries")
    ranged = entries.repartitionByRange(*_KEYS).sortWithinPartitions(*_KEYS)
    found = ranged.mapInArrow(_compared, f"{_ENTRY}, kind string")
    found.write.partitionBy("kind").option("compression", "zstd").parquet(path)
    found = spark.read.schema(f"{_ENTRY}, kind string").parquet(path)
    repeat, open_, edge = (
        found.where(F.col("kind") == k).drop("kind") for k in ("repeat", "open", "edge")
    )
    # A few anchors per partition: across borders the first of equal entries is found again.
    place = F.struct("doc", "tie", "first")
    leads = edge.groupBy("gram", "whole").agg(F.min(place).alias("lead"))
    several = leads.groupBy("gram").agg((F.count(F.lit(1)) > 1).alias("several"))
    checked = edge.join(leads, ["gram", "whole"]).join(several, "gram")
    is_lead = place == F.col("lead")
    more = checked.where(~is_lead).select(*_NAMES)
    # Equal rows lead together; one of them stands for all.
    leading = checked.where(is_lead & F.col("several")).select(*_NAMES).dropDuplicates(_KEYS)
    return repeat.unionByName(more), open_.unionByName(leading)


def run_bytes(docs: DataFrame, entries: DataFrame, length: int) -> DataFrame:
    """The bytes that each entry's windows cover, as ``gram, doc, tie, first, windows, bytes``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", HASHED_BYTES):
            out: list[tuple] = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("doc", "tie", "runs")))
            raw = batch.column("text").cast(pa.binary())
            for (doc, tie, runs), data in zip(rows, raw):
                view = data.as_buffer()
                for r in runs:
                    piece = view.slice(r["first"], r["windows"] + length - 1).to_pybytes()
                    out.append((r["gram"], doc, tie, r["first"], r["windows"], piece))
            names = ["gram", "doc", "tie", "first", "windows", "bytes"]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.binary()]
            columns = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

    by_doc = entries.groupBy("doc", "tie").agg(
        F.collect_list(F.struct("gram", "first", "windows")).alias("runs")
    )
    # Equal rows of the table give the same bytes; one is enough.
    found = by_doc.join(_keyed(docs), ["doc", "tie"]).select("doc", "tie", "runs", "text")
    made = found.mapInArrow(
        cut, "gram bigint, doc bigint, tie int, first bigint, windows int, bytes binary"
    )
    return made.dropDuplicates(["doc", "tie", "first"])


def _from_bytes(
    rows: DataFrame, length: int, split: Callable[[Buffer, dict, int], tuple]
) -> DataFrame:
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = batch.column("bytes")
            sizes = pc.binary_length(pieces).to_numpy().astype(np.int64)
            starts = np.concatenate(([0], np.cumsum(sizes)))
            data = np.frombuffer(b"".join(pieces.to_pylist()), np.uint8)
            columns = {c: batch.column(c).to_numpy() for c in batch.schema.names if c != "bytes"}
            row, gram, whole, first, windows = split(Buffer(data, starts), columns, length)
            yield pa.RecordBatch.from_arrays(
                [
                    _signed(gram), _signed(whole), pa.array(columns["doc"][row]),
                    pa.array(columns["tie"][row]), pa.array(columns["first"][row] + first),
                    pa.array(windows.astype(np.int32)), pa.array(columns["first"][row]),
                ],
                names=_NAMES,
            )

    return rows.mapInArrow(entries, _ENTRY)


def _small_runs(buffer: Buffer, columns: dict, length: int) -> tuple:
    """Runs cut where the window's distance to its anchor passes a multiple of the step.

    All windows of such a cut hold the bytes that its eight possible windows have in common; these
    and the anchor are the entry's leading bytes.
    """
    starts, windows = buffer.starts[:-1], columns["windows"].astype(np.int64)
    anchor = _anchors(buffer, columns, length)
    row = np.repeat(np.arange(len(windows)), windows)
    p = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    block = (anchor[row] - p) // _STEP
    edge = np.ones(len(row), bool)
    edge[1:] = (row[1:] != row[:-1]) | (block[1:] != block[:-1])
    at = np.flatnonzero(edge)
    count = np.diff(np.append(at, len(row)))
    row, first, block = row[at], p[at], block[at]
    base = starts[row]
    core = base + anchor[row] - block * _STEP
    gram = buffer.hashes(core, core + length - _STEP + 1)
    gram = mixed(gram ^ mixed(columns["gram"][row].view(np.uint64) + block.astype(np.uint64)))
    whole = buffer.hashes(base + first, base + first + count + length - 1)
    whole = mixed(whole + (anchor[row] - first).astype(np.uint64))
    return row, gram, whole, first, count


def _anchors(buffer: Buffer, columns: dict, length: int) -> np.ndarray:
    """Where in each run's bytes its anchor is: all its windows share one, so any finds it."""
    begin = buffer.starts[:-1]
    return buffer.anchors(length)[begin] - begin if len(begin) else begin


def _single_windows(buffer: Buffer, columns: dict, length: int) -> tuple:
    """Every window by itself; its bytes are the leading bytes and the whole."""
    n = columns["count"].astype(np.int64)
    row = np.repeat(np.arange(len(n)), n)
    first = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + columns["offset"][row]
    begin = buffer.starts[row] + first
    whole = buffer.hashes(begin, begin + length)
    gram = mixed(whole ^ columns["gram"][row].view(np.uint64))
    return row, gram, whole, first, np.ones(len(row), np.int64)


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, longest: int = LONG_BYTES
) -> DataFrame:
    """``doc``, ``tie`` and ``spans``: what to remove, as (from, to) byte places, unordered."""
    spark = docs.sparkSession
    repeats, differing = compare_entries(run_entries(docs, length, longest))
    bytes_ = written(run_bytes(docs, differing, length), scratch_path(spark, "run-bytes"))
    repeats_2, differing_2 = compare_entries(_from_bytes(bytes_, length, _small_runs))
    wanted = differing_2.select(
        "doc", "tie", F.col("gram").alias("block_gram"), F.col("windows").alias("count"),
        F.col("first").alias("from"), F.col("home"),
    )
    held = wanted.join(
        bytes_.withColumnRenamed("first", "home"), ["doc", "tie", "home"]
    ).select(
        F.col("block_gram").alias("gram"), "doc", "tie", F.col("home").alias("first"), "count",
        (F.col("from") - F.col("home")).alias("offset"), "bytes",
    )
    repeats_3, _ = compare_entries(_from_bytes(held, length, _single_windows))
    span = F.struct(
        F.col("first").alias("from"), (F.col("first") + F.col("windows") + length - 1).alias("to")
    )
    every = repeats.unionByName(repeats_2).unionByName(repeats_3)
    return every.groupBy("doc", "tie").agg(F.collect_set(span).alias("spans"))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs; spans that touch are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def marked_documents(
    docs: DataFrame, length: int = LENGTH, longest: int = LONG_BYTES
) -> DataFrame:
    """All rows and columns of ``docs`` with ``spans``, byte runs to remove, and ``twin``.

    A byte goes if some ``length`` bytes that cover it also start earlier: in a row of a smaller
    id, or earlier in the same text. Texts are judged as given, in UTF-8; a NULL text is empty and
    has no repeats, like any text of fewer bytes. A NULL id is the smallest. Rows that share an id
    are ordered by a hash of their text; rows equal in both are numbered by ``twin``, from 1, and
    all but one are whole repeats. An empty table gives no rows. Input columns named ``spans``,
    ``twin``, ``doc`` or ``tie`` are dropped. A text of any length is looked at whole, in buffers of
    ``longest`` windows.
    """
    spans = repeated_spans(docs, length, longest)
    kept = [c for c in docs.columns if c not in ("spans", "twin", "doc", "tie")]
    keyed = docs.select(*[F.col(f"`{c}`") for c in kept], _doc(), _tie())
    same = ["doc", "tie", F.xxhash64("text")]
    joined = keyed.join(spans, ["doc", "tie"], "left")
    twins = keyed.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Numbering moves whole rows once more; without twins there is nothing to number.
    number = F.lit(1)
    if not twins.isEmpty():
        number = F.row_number().over(Window.partitionBy(*same).orderBy("doc"))
    return joined.withColumn("twin", number).select(*[F.col(f"`{c}`") for c in kept], "spans", "twin")


def _removed(batch: pa.RecordBatch, length: int) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    """Each row's bytes and the maximal runs to remove."""
    raw = texts(batch.column("text")).cast(pa.binary()).to_pylist()
    for data, spans, twin in zip(raw, batch.column("spans").to_pylist(), batch.column("twin").to_pylist()):
        if twin > 1:
            yield data, [(0, len(data))] if len(data) >= length else []
        else:
            yield data, merged([(x["from"], x["to"]) for x in spans or ()])


def _kept(data: bytes, gone: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in gone for x in span), len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def repeat_digests(
    docs: DataFrame, length: int = LENGTH, longest: int = LONG_BYTES
) -> DataFrame:
    """Per row ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", HASHED_BYTES):
            out = []
            for data, gone in _removed(batch, length):
                sha = hashlib.sha256(_kept(data, gone)).hexdigest()
                out.append((len(data), sum(b - a for a, b in gone), len(gone), sha))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *map(pa.array, zip(*out))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    marked = marked_documents(docs.select("doc_id", "text"), length, longest)
    return marked.mapInArrow(
        digest, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeats cut from ``text`` (characters that lie in them whole), all columns.

    ``n_chars``, if there is such a column, is counted anew where text was cut. Documents of which
    nothing but white space is left by that are dropped; others, empty ones too, stay. Other
    columns, whatever their names, stay as they are.
    """
    named = apart(docs, "doc_id", "text", "n_chars")
    schema = named.schema
    names = named.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", HASHED_BYTES):
            new, stay, counts = [], [], []
            for data, gone in _removed(batch, length):
                left = _kept(data, [_whole_characters(data, a, b) for a, b in gone]).decode()
                new.append(left)
                counts.append(len(left))
                stay.append(not gone or bool(left.strip()))
            cut_ = pa.array([bool(x) for x in (g for _, g in _removed(batch, length))])
            columns = {c: batch.column(c) for c in names}
            columns["text"] = pc.if_else(cut_, pa.array(new, pa.string()), columns["text"])
            if "n_chars" in columns:
                kind = columns["n_chars"].type
                columns["n_chars"] = pc.if_else(cut_, pa.array(counts).cast(kind), columns["n_chars"])
            out = pa.RecordBatch.from_arrays(list(columns.values()), names=names)
            yield out.filter(pa.array(stay, pa.bool_()))

    return together(marked_documents(named, length).mapInArrow(cut, schema), docs)


def _whole_characters(data: bytes, a: int, b: int) -> tuple[int, int]:
    """The part of a byte run that begins and ends between characters."""
    while a < b and data[a] & 0xC0 == 0x80:
        a += 1
    while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
        b -= 1
    return a, b
