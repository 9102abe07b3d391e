"""Queries of problem 6 and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.operators import orphans
from tamis.tables import table


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All non-NULL references of the three fields, each delivery counted once."""
    r = table(spark, sf_dir, "reported_questions").select(F.col("id").alias("row_id"), F.col("qid").alias("key"), F.col("reported_at").alias("at")).distinct()
    a = table(spark, sf_dir, "admin_corrections").select(F.col("id").cast("string").alias("row_id"), F.col("question_id").alias("key"), F.col("created_at").alias("at"))
    q = table(spark, sf_dir, "questions").select(F.col("id").cast("string").alias("row_id"), F.col("canonical_id").alias("key"), F.col("created_at").alias("at"))
    named = lambda df, name, late: df.where(F.col("key").isNotNull()).withColumns({"ref_table": F.lit(name), "checks_late": F.lit(late)})
    return named(r, "reported_questions", True).unionByName(named(a, "admin_corrections", True)).unionByName(named(q, "questions", False))


def _state(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    refs = references(spark, sf_dir)
    q = table(spark, sf_dir, "questions")
    d = table(spark, sf_dir, "dedup_deletions")
    state = orphans.fold(
        orphans.deltas(refs, "key", refs=1),
        orphans.deltas(q, "id", alive=1, since=F.col("created_at")),
        orphans.deltas(d, "deleted_id", deleted=1),
    )
    return refs, state


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.report(*_state(spark, sf_dir))


def p6_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.per_period(p6_found(spark, sf_dir))


def p6_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orphans.orphan_keys(_state(spark, sf_dir)[1])


QUERIES = {"p6_found": p6_found, "p6_periods": p6_periods, "p6_keys": p6_keys}

_FOUND = """
WITH refs AS (
  SELECT 'reported_questions' AS ref_table, id AS row_id, qid AS k, reported_at AS ref_at, true AS checks FROM reported_questions
  UNION SELECT 'admin_corrections', id::VARCHAR, question_id, created_at, true FROM admin_corrections
  UNION SELECT 'questions', id::VARCHAR, canonical_id, created_at, false FROM questions),
fate AS (
  SELECT r.*, q.id AS qid, q.created_at AS since, r.k IN (SELECT deleted_id FROM dedup_deletions WHERE deleted_id IS NOT NULL) AS gone
  FROM refs r LEFT JOIN questions q ON q.id = r.k WHERE r.k IS NOT NULL)
SELECT DISTINCT ref_table, row_id,
  CASE WHEN qid IS NOT NULL THEN 'late' WHEN gone THEN 'deleted' ELSE 'missing' END AS problem,
  coalesce(strftime(ref_at::TIMESTAMP, '%Y-%m'), 'unknown') AS period
FROM fate WHERE qid IS NULL OR (checks AND since > ref_at)"""

SQL = {
    "p6_found": _FOUND,
    "p6_periods": f"SELECT ref_table, period, problem, count(*) AS n FROM ({_FOUND}) GROUP BY ALL",
    "p6_keys": """
WITH refs AS (
  SELECT DISTINCT id, qid AS k, reported_at FROM reported_questions
  UNION ALL SELECT id::VARCHAR, question_id, created_at FROM admin_corrections
  UNION ALL SELECT id::VARCHAR, canonical_id, created_at FROM questions)
SELECT k AS key, count(*) AS refs,
  CASE WHEN k IN (SELECT deleted_id FROM dedup_deletions WHERE deleted_id IS NOT NULL) THEN 'deleted' ELSE 'missing' END AS problem
FROM refs WHERE k IS NOT NULL AND k NOT IN (SELECT id FROM questions WHERE id IS NOT NULL) GROUP BY k""",
}
