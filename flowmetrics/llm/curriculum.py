"""A training mix whose sources' shares change over time as their weight schedules say.

Each source's schedule is a polygon over training time 0 to 1. Its integral is the source's weight
in the mix: the words wanted are shared out by weight, and a source that would be repeated too
often stops at its limit while the rest is shared out again. A source's documents stand in a seeded
order, repeated as often as its target needs; the words before a copy are demanded by the time at
which the integral of the schedule, scaled to the target, has grown to them. That time, found by
inverting the integral piece by piece, is the copy's training position, and the mix is range-sorted
by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmetrics.llm.ordering import numbered, range_bucketed, range_ranked
from flowmetrics.sources.scratch import scratch_path, written

WORD = "[^\\x20\\x09-\\x0D]+"


def sized_documents(docs: DataFrame, seed: int, name: str = "mix-documents") -> DataFrame:
    """``doc_id``, ``source``, ``size`` (words) and ``hash`` of each document, and ``at``, a number of
    its row: the one read of the texts."""
    text = F.coalesce("text", F.lit(""))
    own = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
        F.md5(own).alias("hash"),
    )
    return numbered(rows, "at", name)


def named(column: Column) -> Column:
    """A source as a key that is never NULL, in code point order with NULL last."""
    return F.when(column.isNull(), "1").otherwise(F.concat(F.lit("0"), column))


def schedule_pieces(schedule: DataFrame) -> DataFrame:
    """Per source ``key`` its integral ``whole`` and the pieces of its polygon in order of time.

    ``schedule`` has ``source``, ``time`` (0 to 1, rising) and ``weight`` (not negative) of the
    polygon's corners; before the first and after the last the weight stays as it is there. A piece
    has its begin, weight and slope there, and the integral before and after it.
    """
    corners = F.array_sort(F.collect_list(F.struct("time", "weight")))
    ends = F.expr("""concat(array(named_struct('time', 0D, 'weight', corners[0].weight)), corners,
        array(named_struct('time', 1D, 'weight', element_at(corners, -1).weight)))""")
    pieces = F.expr("""
        filter(zip_with(slice(ends, 1, size(ends) - 1), slice(ends, 2, size(ends) - 1), (a, b) ->
            named_struct('begin', a.time, 'weight', a.weight,
                         'slope', coalesce(try_divide(b.weight - a.weight, b.time - a.time), 0D),
                         'area', (a.weight + b.weight) / 2D * (b.time - a.time))), p -> p.area > 0)""")
    summed = F.expr("""
        aggregate(pieces, named_struct('upto', 0D, 'out', CAST(array() AS array<struct<
                begin: double, weight: double, slope: double, before: double, upto: double>>)),
            (s, p) -> named_struct('upto', s.upto + p.area, 'out', concat(s.out, array(named_struct(
                'begin', p.begin, 'weight', p.weight, 'slope', p.slope,
                'before', s.upto, 'upto', s.upto + p.area)))))""")
    typed = schedule.select(
        named(F.col("source")).alias("key"),
        F.col("time").cast("double").alias("time"), F.col("weight").cast("double").alias("weight"),
    )
    made = typed.groupBy("key").agg(corners.alias("corners")).withColumn("ends", ends)
    made = made.withColumn("pieces", pieces).withColumn("summed", summed)
    return made.select("key", F.col("summed.upto").alias("whole"), F.col("summed.out").alias("pieces"))


def targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """Add ``target``: words wanted of each source, doubles.

    ``sources`` (written) has ``source_size`` and ``whole``, the weight. All targets sum to ``share``
    times all sizes, unless the limits (``most`` times a source's size) do not allow it. Each round
    shares what is left among the sources below their limit; the driver sees three sums.
    """
    limit = F.col("source_size") * F.lit(float(most))
    weighted = sources.where("whole > 0")
    wanted = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    rate, stopped = None, -1
    while True:
        full = F.lit(False) if rate is None else limit <= rate
        n, size, free = weighted.agg(
            F.count_if(full), F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("whole")))
        ).first()
        if n == stopped:
            break
        stopped = n
        # As one quotient, in the order that the equivalent SQL has.
        left = F.lit(wanted - (size or 0.0))
        rate = left * F.col("whole") / F.lit(free) if free else F.lit(float("inf"))
    target = F.when(F.col("whole") > 0, F.least(limit, rate)).otherwise(0.0)
    return sources.withColumn("target", target)


_TIME = """
transform(filter(pieces, p -> p.upto > {a} OR p.upto >= whole), p ->
    p.begin + coalesce(try_divide(2 * greatest({a} - p.before, 0D),
        p.weight + sqrt(greatest(p.weight * p.weight + 2 * p.slope * greatest({a} - p.before, 0D), 0D))), 0D))[0]
"""


def mixed_documents(
    docs: DataFrame,
    schedule: DataFrame,
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 29,
    sized: DataFrame | None = None,
) -> DataFrame:
    """The mix: a row per copy of a document taken, and one per document not taken.

    ``at`` (a number of the input row), ``doc_id``, ``source``, ``size`` (words, ``[^\\x20\\x09-\\x0D]+``),
    ``source_size``, ``target`` (words wanted of the source), ``copy`` (0 first), ``words`` taken of
    the copy, ``position`` (training time at which the copy begins) and ``place``, its 0-based rank in
    the mix; the last four are NULL for documents not taken. Copies are whole but for the last of a
    source, which ends where the target, rounded down, does. A source without a schedule (or with the
    weight 0) is not taken from. NULL sources form one of their own; NULL text and text without words
    have the size 0 and are never taken. Rows that repeat an id are rows of their own; the order in a
    source is by a seeded hash of id and text, and rows that are equal in both are interchangeable.
    An empty table gives no rows; further columns are not read.

    Spread: a source's documents are range-partitioned by hash, running sums are those of a
    partition and of the partitions before it, so no task holds a source. Texts are read once
    (``sized`` takes :func:`sized_documents` made before); all shuffles are of narrow rows.
    """
    spark = docs.sparkSession
    rows = (sized_documents(docs, seed) if sized is None else sized).withColumn("key", named(F.col("source")))
    order = [F.col(c) for c in ("key", "hash", "doc_id", "at")]
    dealt = range_bucketed(rows, order, "part", "mix-order")
    sums = dealt.groupBy("key", "part").agg(F.sum("size").alias("part_size"))
    sums = written(sums, scratch_path(spark, "mix-parts"))
    sizes = sums.groupBy("key").agg(F.sum("part_size").alias("source_size"))
    planned = sizes.join(schedule_pieces(schedule), "key", "left").fillna(0.0, ["whole"])
    planned = targets(written(planned, scratch_path(spark, "mix-sources")), share, most)
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("key", "part", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("start"))
    plan = starts.join(planned, "key")
    within = Window.partitionBy("key", "part").orderBy(*order[1:]).rowsBetween(Window.unboundedPreceding, -1)
    local = dealt.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    placed = local.join(plan, ["key", "part"]).withColumn("first", F.col("start") + F.col("before"))
    # Copy k of a document begins k times the source's size after the first.
    last = f"CAST(greatest(ceil({float(most)}D), 1) - 1 AS bigint)"
    copies = F.expr(f"""
        filter(transform(sequence(0L, {last}), k -> named_struct(
            'copy', k, 'begin', k * source_size + first,
            'words', least(size, CAST(floor(target) AS bigint) - k * source_size - first))), c -> c.words > 0)""")
    taken = placed.select(
        "at", "doc_id", "source", "size", "source_size", "target", "whole", "pieces", "key", "hash",
        F.explode_outer(copies).alias("c"),
    )
    position = F.expr(_TIME.format(a="(c.begin / target * whole)"))
    timed = taken.select(
        "at", "doc_id", "source", "size", "source_size", "target",
        F.col("c.copy").alias("copy"), F.col("c.words").alias("words"),
        F.when(F.col("c").isNotNull(), position).alias("position"), "key", "hash",
    )
    by_time = [F.asc_nulls_last("position"), *[F.col(c) for c in ("key", "copy", "hash", "doc_id", "at")]]
    ranked = range_ranked(timed, by_time, "rank", "mix-positions")
    place = F.when(F.col("position").isNotNull(), F.col("rank")).alias("place")
    return ranked.select(*[c for c in timed.columns if c not in ("key", "hash")], place)


def taken_by_document(mix: DataFrame) -> DataFrame:
    """A row per document of :func:`mixed_documents`: ``taken`` words, ``copies``, ``first_place``."""
    return mix.groupBy("at", "doc_id", "source", "size", "source_size", "target").agg(
        F.coalesce(F.sum("words"), F.lit(0)).alias("taken"),
        F.count("copy").alias("copies"),
        F.min("place").alias("first_place"),
    )


def cycled_schedule(
    sized: DataFrame, cycle: Sequence[Sequence[tuple[float, float]]]
) -> DataFrame:
    """A schedule for all sources of :func:`sized_documents`: the n-th in code point order, NULL
    last, has the n-th of the polygons, which repeat."""
    spark = sized.sparkSession
    sources = sized.select("source").distinct().withColumn("key", named(F.col("source")))
    ranked = range_ranked(sources, [F.col("key")], "nth", "mix-names")
    shapes = [(i, t, w) for i, shape in enumerate(cycle) for t, w in shape]
    corners = spark.createDataFrame(shapes, "shape bigint, time double, weight double")
    return ranked.withColumn("shape", F.col("nth") % len(cycle)).join(
        F.broadcast(corners), "shape"  # as many rows as the caller listed
    ).select("source", "time", "weight")


def write_mix(docs: DataFrame, mix: DataFrame, path: str, key: str = "doc_id") -> None:
    """The texts in training order as Parquet: ``place``, ``copy``, ``words`` and the document's columns.

    Meant for tables whose ids are distinct. Files are range-partitioned by place and sorted, so
    reading them by name is reading the mix.
    """
    placed = mix.where("place IS NOT NULL").select(
        F.col("doc_id").alias("mix_doc"), F.col("place").alias("mix_place"),
        F.col("copy").alias("mix_copy"), F.col("words").alias("mix_words"),
    )
    joined = placed.join(docs, F.col("mix_doc") == F.col(key)).drop("mix_doc")
    joined.repartitionByRange("mix_place").sortWithinPartitions("mix_place").write.parquet(path)
