"""Small helpers around a session that the caller owns."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Scratch folders of the ``scratch_released`` blocks that are open, innermost last.
_OPEN: list[list[str]] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the cluster's shared folder for tables that a query writes itself.

    The folder is the session's ``spark.checkpoint.dir``, else the checkpoint folder set on
    its context. A local session that has neither gets a temporary one.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="orgtrail-"))
        shared = context.getCheckpointDir()
    path = f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder where Spark's own readers and writers reach it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_released(spark: SparkSession) -> Iterator[None]:
    """Scratch folders taken inside the block are deleted at its end, when nothing reads them any more."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            drop_dir(spark, path)


def label_jobs(spark: SparkSession, group: str, description: str) -> None:
    """Name the Spark jobs that follow."""
    spark.sparkContext.setJobGroup(group, description)
