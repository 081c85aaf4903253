"""Five stages from raw documents to packed training sequences, each one operator's decisions.

A stage gets the documents that the stage before it kept and returns documents, the last one the
pieces of the packed sequences. Each result is written before the next stage reads it, so a lost
executor costs tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmetrics.llm import decontamination, jaccard_join, packing, quality, repeats
from flowmetrics.llm.shipping import ship_package
from flowmetrics.sources.scratch import scratch_path, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the learned vote of the quality rules keeps, all columns as they are.

    The whole row stands in one column beside the signals, so none of its names is replaced.
    """
    rows = docs.select(F.struct("*").alias("row"), "text")
    return quality.judged_documents(rows, drop_text=True).where("kept").select("row.*")


def jaccard_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles: five words, a similarity of 0.8 or more."""
    ship_package(spark)
    return jaccard_join.one_per_component(docs, num=80, den=100, width=5)


def suffix_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without byte runs that stood earlier; documents of which nothing is left go."""
    ship_package(spark)
    return repeats.without_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship_package(spark)
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontamination.without_contaminated(docs, benchmark)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences of 2048 ids."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", jaccard_groups),
    ("suffix-array dedup", suffix_repeats),
    ("benchmark decontamination", benchmark_leaks),
    ("packing", packed_sequences),
]

#: Learned votes, byte runs and a tokenizer: no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each but the last is written, and the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    *stages, (_, last) = STAGES
    for name, stage in stages:
        path = scratch_path(spark, name.lower().replace(" ", "-"))
        docs = written(stage(spark, docs, sf_dir), path)
    return last(spark, docs, sf_dir)
