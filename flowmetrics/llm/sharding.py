"""Shards that all hold the sources in the corpus's proportions.

Each source's rows are shuffled by a seeded hash and ranked; a row's fractional rank in its
source, ``(rank + phase) / size``, is its place in the interleaved order. The phase, of 0 up to 1, is
the source's own: sources in order of size and name take the multiples of the golden section, so
those of one size, and of one row, are spread evenly. The order is cut into shards of equal row
counts, so every stretch of it, and every shard, holds each source in proportion, to within about
one row per source, and all small sources together as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmetrics.llm.ordering import range_ranked, ranked_in_buckets
from flowmetrics.sources.scratch import scratch_path, written

#: Expected rows of one ranking task.
ROWS_PER_BUCKET = 20_000
_PHASE_BITS = 20
_GOLDEN = "0.6180339887498949D"


def stratified_shards(
    rows: DataFrame,
    shards: int,
    key: str = "doc_id",
    source: str = "source",
    seed: int = 17,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``rows`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 in its shard).

    Shard sizes differ by one row at most. NULL sources form a source of their own. Rows that
    share a key are all kept; equal hashes are ordered by key, then by all other columns that
    can be ordered, so only rows that are equal in all of them are interchangeable. An empty
    table gives an empty table. Input columns named ``shard`` or ``slot`` are replaced, and
    those beginning with ``_shard_`` are reserved.

    Spread: ranking runs in buckets of about ``rows_per_bucket`` rows, first by hash within a
    source, then by fractional rank over all; a source with most of the rows has most of the
    buckets. Two narrow shuffles of the rows given; pass the columns that are to be carried.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    spark = rows.sparkSession
    kept = [c for c in rows.columns if c not in ("shard", "slot")]
    rest = [c for c, kind in rows.dtypes if c in kept and c != key and not kind.startswith("map")]
    hashed = rows.select(
        *kept,
        F.xxhash64(F.lit(seed), F.col(key)).alias("_shard_hash"),
        F.when(F.col(source).isNull(), "n")
        .otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))
        .alias("_shard_source"),
    )
    hashed = written(hashed, scratch_path(spark, "shard-rows"))
    total = hashed.count()
    bits = max(0, (total // rows_per_bucket).bit_length())
    buckets = 1 << bits
    # Java's >>> takes its distance modulo 64, so no bits means bucket 0 spelled out.
    top = F.shiftrightunsigned("_shard_hash", 64 - bits) if bits else F.lit(0).cast("long")
    # Buckets are by unsigned hash, so rows are, too: negative ones last.
    ties = [F.col("_shard_hash") < 0, F.col("_shard_hash"), F.col(key), *[F.col(c) for c in rest]]
    keyed = hashed.withColumn("_shard_bucket", top)
    ranked = ranked_in_buckets(
        keyed, ["_shard_source"], "_shard_bucket", ties, "_shard_rank", "_shard_size",
    )
    sources = keyed.groupBy("_shard_source").agg(F.count(F.lit(1)).alias("_shard_rows"))
    by_size = [F.col("_shard_rows"), F.col("_shard_source")]
    named = range_ranked(sources, by_size, "_shard_nth", "shard-sources")
    section = F.expr(f"(_shard_nth + 1) * {_GOLDEN} - floor((_shard_nth + 1) * {_GOLDEN})")
    phase = F.floor(section * (1 << _PHASE_BITS)).cast("bigint").alias("_shard_phase")
    buckets_of = keyed.select("_shard_source", "_shard_bucket").distinct()
    phases = buckets_of.join(named.select("_shard_source", phase), "_shard_source")
    # On the bucket, too, as the rows lie after ranking: no source is one task's.
    ranked = ranked.join(phases, ["_shard_source", "_shard_bucket"])
    # In units of a 2**_PHASE_BITS-th row: exact, and less than the size in the same units.
    part = F.col("_shard_rank") * (1 << _PHASE_BITS) + F.col("_shard_phase")
    whole = F.col("_shard_size") * (1 << _PHASE_BITS)
    stripe = F.floor(part.cast("double") / whole * buckets).cast("bigint")
    place = ranked.withColumn("_shard_fraction", part.cast("double") / whole).withColumn(
        "_shard_stripe", F.least(stripe, F.lit(buckets - 1).cast("bigint"))
    )
    place = written(place.drop("_shard_bucket", "_shard_phase"), scratch_path(spark, "shard-places"))
    order = [F.col("_shard_fraction"), F.col("_shard_source"), F.col("_shard_rank")]
    placed = ranked_in_buckets(place, [], "_shard_stripe", order, "_shard_at", "_shard_total")
    shard = F.expr(f"_shard_at * {shards} div _shard_total")
    first = F.expr(f"(_shard_no * _shard_total + {shards - 1}) div {shards}")
    return placed.withColumn("_shard_no", shard).select(
        *kept,
        F.col("_shard_no").cast("int").alias("shard"),
        (F.col("_shard_at") - first).alias("slot"),
    )


def write_shards(rows: DataFrame, path: str, shards: int, **how: object) -> None:
    """Write the rows as Parquet, one folder per shard, each file in slot order."""
    placed = stratified_shards(rows, shards, **how)
    dealt = placed.repartitionByRange(shards, "shard", "slot").sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(path)
