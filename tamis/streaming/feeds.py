"""Change feeds applied once: micro-batches against a ledger, unmatched events kept for later."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamis.scratch import Scratch


def unseen(events: DataFrame, ledger: DataFrame, key: list[str]) -> DataFrame:
    """Events not in the ledger, each once.  The ledger is unbounded, so this is a join and no watermark."""
    return events.dropDuplicates(key).join(ledger.select(*key), key, "left_anti")


def watermark(events: DataFrame, at: str, complete: bool, before: int, overlap_ms: int = 1) -> int:
    """The next read position: the newest event less the overlap, or the old position if something was lost."""
    newest = events.agg(F.max(F.unix_millis(at)).alias("m")).first()["m"]
    return before if not complete or newest is None else max(before, newest - overlap_ms)


def push_batches(dirty: DataFrame, order: list[Column], size: int = 200) -> DataFrame:
    """Adds batch: rows in order, ``size`` to a batch.  Ranks come from range partitions, not from one sorted task."""
    scratch = Scratch(dirty.sparkSession)
    ranged = scratch.cut(dirty.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offset = ranged.groupBy("_p").agg(F.count("*").alias("_c")).select("_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    inside = F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1
    ranked = ranged.withColumn("_i", inside).join(F.broadcast(offset), "_p")
    return ranked.withColumn("batch", F.floor((F.col("_o") + F.col("_i")) / size)).drop("_p", "_o", "_i")


def stream_with_ledger(spark: SparkSession, source: DataFrame, key: list[str], ledger_path: str, apply: Callable[[DataFrame], None], checkpoint: str):
    """A streaming query that gives ``apply`` each event once, also when batches are repeated after a failure.

    A batch's keys go to a folder of the batch's number, so a repeated batch overwrites its own entry and is judged
    against all other batches only.
    """
    def batch(df: DataFrame, n: int) -> None:
        done = spark.read.parquet(ledger_path) if _exists(spark, ledger_path) else None
        fresh = df.dropDuplicates(key) if done is None else unseen(df, done.where(F.col("batch") != n), key)
        fresh = fresh.persist()
        apply(fresh)
        fresh.select(*key).write.mode("overwrite").parquet(f"{ledger_path}/batch={n}")
        fresh.unpersist()

    return source.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)
