"""The driver's tables and the views that several operators start from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.scratch import small


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def file_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file_ref_id -> chapter_id over the containment chain; files that lead to no chapter are absent."""
    f = table(spark, sf_dir, "files").select(F.col("id").alias("file_ref_id"), "book_id")
    b = table(spark, sf_dir, "books").select(F.col("id").alias("book_id"), "chapter_id")
    c = table(spark, sf_dir, "chapters").select(F.col("id").alias("chapter_id"))
    return f.join(b, "book_id").join(c, "chapter_id").select("file_ref_id", F.col("chapter_id").cast("bigint").alias("chapter_id"))


def live_questions(spark: SparkSession, sf_dir: str, *columns: str | Column, how: str = "inner") -> DataFrame:
    """Live questions (canonical_id NULL) with their chapter_id; ``how="left"`` keeps those without one.

    The questions stay where they are while the files, counted first, are few; else both sides shuffle.
    """
    chapters = small(file_chapters(spark, sf_dir), table(spark, sf_dir, "files").count())
    q = table(spark, sf_dir, "questions").where(F.col("canonical_id").isNull())
    q = q.select(F.col("file_ref_id").alias("_file"), *columns)
    chapters = chapters.withColumnRenamed("file_ref_id", "_file")
    return q.join(chapters, "_file", how).drop("_file")
