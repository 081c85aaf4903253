"""Exact order statistics per group without gathering a group in one task.

A first count of rows by logarithmic slots keeps, per group, the slots that ranks sought fall in.
Inside these a double is mapped to a 64-bit integer of the same order, the one its bits spell, and
further rounds count by ranges of these integers, until each range kept holds one value or few rows.
Two scans of the input at most, whatever the number of rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from flowmetrics.sources.scratch import scratch_path, written

#: Slots per e-fold in the first count: about 0.1 % wide at every magnitude.
LOG_SLOTS = 1024
#: Slots of a range in each further count, as a power of two.
SLOT_BITS = 16
#: Rows of a range that are ordered by value instead of being counted by slots once more.
FEW_ROWS = 1 << 16

# The exponent of a positive double, from a logarithm that may be off by one at powers of two;
# all doubles below the normal ones share the least exponent.
_POWER = "pow(2D, greatest(-1022, least(1023, floor(log2(a)))))"
_EXPONENT = f"""CAST(greatest(-1022, least(1023, greatest(-1022, least(1023, floor(log2(a))))
    - CASE WHEN a < {_POWER} THEN 1 WHEN a >= 2 * {_POWER} THEN -1 ELSE 0 END)) AS bigint)"""
_ONE = 1 << 52
_INFINITE = 2047 << 52


def ordered_bits(value: str) -> Column:
    """A bigint that rises with the double, and differs wherever the double does.

    The bits of the number without its sign, negative where the number is; both zeros are 0, and
    NaN comes after infinity, as everywhere in Spark. NULL stays NULL.
    """
    a = f"abs({value})"
    exponent = _EXPONENT.replace("(a)", f"({a})").replace("N a ", f"N {a} ")
    bits = f"""({exponent} + 1023) * {_ONE}
        + CAST(({a} / pow(2D, {exponent}) - 1) * {_ONE} AS bigint)"""
    return F.expr(f"""
        CASE WHEN isnan({value}) THEN {_INFINITE + 1}
             WHEN {value} = 0 THEN 0L
             WHEN {a} = double('Infinity') THEN CAST(sign({value}) AS bigint) * {_INFINITE}
             ELSE CAST(sign({value}) AS bigint) * ({bits}) END""")


def first_slot(value: str) -> Column:
    """The slot of the first count that a value falls in, rising with the value; 0 by itself.

    One logarithm a row, which never falls as its argument rises; outliers do not widen the slots.
    The offset puts the least positive double above 0.
    """
    far = 1000 * LOG_SLOTS
    return F.expr(f"""
        CASE WHEN isnan({value}) THEN {4 * far}
             WHEN {value} = 0 THEN 0L
             WHEN abs({value}) = double('Infinity') THEN CAST(sign({value}) AS bigint) * {3 * far}
             ELSE CAST(sign({value}) AS bigint) * (floor(ln(abs({value})) * {LOG_SLOTS}) + {far}) END""")


def first_cut(df: DataFrame, group: str, value: str) -> DataFrame:
    """Counts by (group, slot): ``g``, ``slot``, ``n``, ``total``, ``lo``, ``hi``."""
    readings = df.select(F.col(group).alias("g"), F.col(value).alias("v"))
    return readings.groupBy("g", first_slot("v").alias("slot")).agg(
        F.count("v").alias("n"), F.sum("v").alias("total"),
        F.min("v").alias("lo"), F.max("v").alias("hi"),
    )


#: Of the ranks sought, counted from the first row of a group or range, those in a slot that ends at
#: ``upto`` and holds ``n`` rows, counted from the slot's first row.
_SEEK = """
filter(transform({ranks}, s -> named_struct('j', s.j, 'rank', s.rank - (upto - n))),
       s -> s.rank > 0 AND s.rank <= n) AS seek"""
_UPTO = "sum(n) OVER (PARTITION BY {keys} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS upto"
_KEYS = ["g", "lo", "hi", "seek"]


def _crossed(slots: DataFrame, order: str, *keep: str) -> DataFrame:
    """The slots of each range that ranks in ``seek`` fall in, with the ranks from the slot's start."""
    placed = slots.selectExpr("*", _UPTO.format(keys="g, lo", order=order))
    return placed.selectExpr("g", *keep, _SEEK.format(ranks="seek")).where("size(seek) > 0")


def _inside(df: DataFrame, ranges: DataFrame, count: str) -> DataFrame:
    """Rows of open ranges. Spark broadcasts the ranges, a small file, where its size allows."""
    open_ = ranges.where("lo < hi").selectExpr("g AS range_g", "lo", "hi", "seek")
    met = df.join(open_, F.expr("g <=> range_g AND v >= lo AND v <= hi"))
    return met.selectExpr(*_KEYS, "v", count)


def _kept(ranges: DataFrame) -> tuple[DataFrame, int]:
    """The ranges as written, and the rows of the fullest one that holds several values, or 0."""
    seen = Observation()
    most = F.expr("max(CASE WHEN lo < hi THEN n END) AS most")
    ranges = written(ranges.observe(seen, most), scratch_path(ranges.sparkSession, "ranges"))
    return ranges, seen.get["most"] or 0


def order_statistics(
    df: DataFrame, group: str, value: str, ranks: str, cut: DataFrame | None = None
) -> DataFrame:
    """Per group ``g``: ``rows`` (values), ``mean`` and ``found``, the values of the ranks sought.

    ``ranks`` is an array of 1-based ranks as an expression of ``rows``; ``found`` has their values in
    the same order. NULL values are skipped; a group without others keeps its row, with 0 rows, a
    NULL mean and no values. NULL is a group; NaN is the largest value.

    1. Count rows by (group, slot) (``cut`` takes :func:`first_cut` made before), and keep the slots
       that ranks fall in.
    2. End if every range kept holds one value. Else scan again, for rows in open ranges. If one has
       more than ``FEW_ROWS``, they are counted by value and written, and these counts cut by
       bits of the values' integers: the span of a range falls by ``SLOT_BITS`` a round, so four
       rounds leave one value to a slot.

    Counts combine before their shuffles and spread a group over all tasks; windows see slots, or
    the values of one small range. The ranges of all groups stand in a small file between rounds,
    and the driver sees one number a round. Returns after the first rounds have run.
    """
    spark = df.sparkSession
    sought = f"transform({ranks}, (r, j) -> named_struct('j', j, 'rank', CAST(r AS bigint)))"
    slots = (first_cut(df, group, value) if cut is None else cut).selectExpr(
        "g", "n", "lo", "hi", "sum(n) OVER (PARTITION BY g) AS rows",
        "try_divide(sum(total) OVER (PARTITION BY g), sum(n) OVER (PARTITION BY g)) AS mean",
        _UPTO.format(keys="g", order="slot"),
    )
    kept = slots.selectExpr("g", "n", "lo", "hi", "rows", "mean", _SEEK.format(ranks=sought))
    first, most = _kept(kept.where("rows = 0 OR size(seek) > 0"))
    ranges, closed, counts = first, [], None
    if most:
        readings = df.select(F.col(group).alias("g"), F.col(value).alias("v"))
        counts = _inside(readings, ranges, "1L AS n")
    while most > FEW_ROWS:
        closed.append(ranges.where("lo = hi"))
        if len(closed) == 1:
            counts = counts.groupBy(*_KEYS, "v").agg(F.sum("n").alias("n"))
            counts = written(counts, scratch_path(spark, "range-values"))
        placed = counts.select(
            "*", (ordered_bits("v") - ordered_bits("lo")).alias("distance"),
            F.length(F.bin(ordered_bits("hi") - ordered_bits("lo"))).alias("bits"),
        ).selectExpr(*_KEYS, "v", "n", f"shiftright(distance, greatest(0, bits - {SLOT_BITS})) AS slot")
        cuts = placed.groupBy(*_KEYS, "slot").agg(
            F.sum("n").alias("n"), F.min("v").alias("least"), F.max("v").alias("most")
        )
        ranges, most = _kept(_crossed(cuts, "slot", "least AS lo", "most AS hi", "n"))
        counts = _inside(counts.select("g", "v", "n"), ranges, "n")
    closed.append(ranges.where("lo = hi"))
    # Beside the answers a row per group, or per range of it, with the group's numbers.
    kind = first.schema["seek"].dataType.simpleString()
    every = first.selectExpr("g", "rows", "mean", f"CAST(array() AS {kind}) AS seek", "CAST(NULL AS double) AS v")
    nothing = ["g", "CAST(NULL AS bigint) AS rows", "CAST(NULL AS double) AS mean", "seek"]
    for r in closed:
        every = every.union(r.selectExpr(*nothing, "lo AS v"))
    if most:
        every = every.union(_crossed(counts, "v", "v").selectExpr(*nothing, "v"))
    pairs = "flatten(collect_list(transform(seek, s -> named_struct('j', s.j, 'v', v)))) AS pairs"
    whole = every.groupBy("g").agg(F.expr("max(rows) AS rows"), F.expr("max(mean) AS mean"), F.expr(pairs))
    return whole.selectExpr("g", "rows", "mean", "array_sort(pairs).v AS found")


def mean_and_quantile(
    df: DataFrame,
    group: str,
    value: str,
    mean_alias: str,
    quantile_alias: str,
    q: float = 0.5,
    cut: DataFrame | None = None,
) -> DataFrame:
    """Mean and discrete quantile per group: the least value with ``q`` of the rows up to it.

    See :func:`order_statistics` for how, and for NULLs.
    """
    rank = f"array(greatest(1, ceil(rows * {float(q)}D)))"
    found = order_statistics(df, group, value, rank, cut)
    return found.selectExpr("g", "mean", "get(found, 0)").toDF(group, mean_alias, quantile_alias)


def interpolated_quantiles(
    df: DataFrame, group: str, value: str, probabilities: Sequence[float], cut: DataFrame | None = None
) -> DataFrame:
    """Per group ``g``: ``rows``, ``mean`` and ``q``, quantiles by linear interpolation.

    A quantile p lies at the place (rows - 1) * p, counted from 0, between two neighbours in order.
    NULL for a group without values.
    """
    places = [f"(rows - 1) * {float(p)}D" for p in probabilities]
    ranks = ", ".join(f"floor({p}) + 1, ceil({p}) + 1" for p in places)
    found = order_statistics(df, group, value, f"array({ranks})", cut)
    between = ", ".join(
        f"found[{2 * i}] + ({p} - floor({p})) * (found[{2 * i + 1}] - found[{2 * i}])"
        for i, p in enumerate(places)
    )
    return found.selectExpr("g", "rows", "mean", f"CASE WHEN rows > 0 THEN array({between}) END AS q")
