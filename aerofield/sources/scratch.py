"""A folder for files that a query writes and reads again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder's name below the one that the driver and all executors share (``spark.checkpoint.dir``).

    Where that is unset, local mode gets a temporary folder of this machine, which goes when Python ends; a
    cluster is refused.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return f"{named.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix=f"{name}-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    return f"{own}/{name}"
