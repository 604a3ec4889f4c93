"""Tables that a plan reads several times, written once in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a folder of our own, but only under a local master: a cluster's executors would not see it."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="kinfold-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(at)
    return at


#: With it a query's shuffle files go as it ends, not when the driver's collector comes to them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Queries made and run in here drop their shuffle files as they end."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(df: DataFrame) -> DataFrame:
    """The rows, computed once, as a columnar table without lineage; later reads take single columns. It goes when the driver ends, the shuffles that made it at once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kinfold-{uuid.uuid4().hex}"
    with swept(spark):
        df.write.parquet(path)
    spark._jvm.System.gc()  # what ended queries hold would otherwise stay till the heap is full
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)
