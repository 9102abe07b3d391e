"""Lineage cuts in the folder that all executors share.

A cut is a Parquet table written under ``spark.checkpoint.dir``.  Unlike ``checkpoint()`` it is compressed and
columnar, so later reads prune columns, and it gives the planner a size.  The folder is only chosen here when the
session names none, which is the case in tests on one machine.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one on a single machine that has none set."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="tamis-")
    atexit.register(shutil.rmtree, own, True)
    sc.setCheckpointDir(f"file://{own}")
    return sc._jsc.sc().getCheckpointDir().get()


class Scratch:
    """Tables cut from their lineage; superseded ones can be dropped so that loops need constant disk."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark).rstrip('/')}/tamis-{uuid.uuid4().hex}"
        self.n = 0

    def cut(self, df: DataFrame, **measures: Column) -> DataFrame:
        """``df`` written and read again.  Measures are aggregates over it, found in ``last`` at no extra pass."""
        self.n += 1
        path = f"{self.root}/{self.n}"
        watch = Observation()
        if measures:
            df = df.observe(watch, *[m.alias(k) for k, m in measures.items()])
        df.write.option("compression", "zstd").parquet(path)
        self.last = watch.get if measures else {}
        self.path = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, path: str) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)


#: Most rows of a table that is sent to all executors; at 64 bytes a row that is 6.4 MB.
BROADCAST_ROWS = 100_000


def small(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint if ``rows``, counted by the caller, is within the bound; else the plain table."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def spread(df: DataFrame) -> DataFrame:
    """The table in at least as many partitions as there are cores, for steps that cost much for their bytes.

    It is only moved where its files give fewer splits than that, which large tables never do.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
