"""Fresh paths for intermediate tables in the folder all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or the checkpoint folder set on the context.

    Without either it is an error: a folder of one machine is out of reach for the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the application's own folder below the shared one.

    What is written there outlives the call, since frames that read it are lazy; the application's
    folder is deleted when the application ends.
    """
    context = spark.sparkContext
    own = f"{_shared_folder(spark)}/flowmetrics/{context.applicationId}"
    folder = context._jvm.org.apache.hadoop.fs.Path(own)
    files = folder.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(folder):
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return f"{own}/{name}-{uuid4().hex}"


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A scratch path of its own, deleted with all it holds when the block ends."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        discard(spark, path)


def written(df: DataFrame, path: str, tidy: bool = False) -> DataFrame:
    """Write a table as Parquet and read it back: its lineage ends at the files.

    ``tidy`` asks Spark to remove the write's shuffle files when it is done, which otherwise stay
    until the driver's garbage collector finds their plan.
    """
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, "false")
    if tidy:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if tidy:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing will read again."""
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
