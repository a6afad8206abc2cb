"""Shared storage: checkpoints and written tables that survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's own settings to delete the shuffle files of an action when it has ended, and for the bytes of a batch sent to Python.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, as a URI.

    It is the cluster's ``spark.checkpoint.dir``.  Where that is unset, local mode (as
    in tests) gets a temporary folder of this machine; a cluster is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="shared-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A folder name of its own under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def released(spark: SparkSession) -> AbstractContextManager[None]:
    """Actions inside give their shuffle files back when they end."""
    return _setting(spark, CLEANUP, "true")


def small_batches(spark: SparkSession, size: int) -> AbstractContextManager[None]:
    """Actions inside send rows to Python in batches of about ``size`` bytes, or of one row."""
    return _setting(spark, BATCH, f"{size}b")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage ends there."""
    path = fresh_dir(df.sparkSession, name)
    with released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` is called so, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
