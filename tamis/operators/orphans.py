"""References to records that do not exist, kept from signed change deltas.

Every change adds signed counts to a key: a reference made (+1) or withdrawn (-1), a record created (+1) or
deleted (-1), a deletion logged (+1).  The state of a key is the sum of its deltas, so batches can be folded in any
order, late ones too, and partial sums combine before the shuffle: however hot a key is, it leaves each map task as
one row.  A key with references > 0 and existence <= 0 is an orphan.

Nulls: a NULL key is no reference and is left out; a NULL time gives the period ``unknown`` and is never late.
Repeated deliveries of the same row count once.  Empty inputs give an empty report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = ("refs", "alive", "deleted")


def deltas(df: DataFrame, key: str, refs: Column | int = 0, alive: Column | int = 0, deleted: Column | int = 0, since: Column | None = None) -> DataFrame:
    """Signed counts of one change source: (key, refs, alive, deleted, since)."""
    as_long = lambda x: (x if isinstance(x, Column) else F.lit(x)).cast("bigint")
    when = F.lit(None).cast("timestamp") if since is None else since.cast("timestamp")
    return df.where(F.col(key).isNotNull()).select(
        F.col(key).cast("bigint").alias("key"), as_long(refs).alias("refs"), as_long(alive).alias("alive"), as_long(deleted).alias("deleted"), when.alias("since")
    )


def fold(*changes: DataFrame) -> DataFrame:
    """State per key: summed counts and the first time the record existed.  A former state may be among the changes."""
    whole = changes[0]
    for c in changes[1:]:
        whole = whole.unionByName(c)
    return whole.groupBy("key").agg(*[F.sum(c).alias(c) for c in STATE], F.min("since").alias("since"))


def orphan_keys(state: DataFrame) -> DataFrame:
    """The current orphan report by key: positive references, no existence."""
    return state.where((F.col("refs") > 0) & (F.col("alive") <= 0)).select(
        "key", "refs", F.when(F.col("deleted") > 0, "deleted").otherwise("missing").alias("problem")
    )


def report(references: DataFrame, state: DataFrame) -> DataFrame:
    """Rows (ref_table, row_id, problem, period) for references (ref_table, row_id, key, at, checks_late).

    ``deleted`` or ``missing`` for orphan keys, ``late`` where the record came after the reference.  Only keys that
    can matter are kept on the state's side: orphans, and records with a time for references that check it.
    """
    suspect = state.where(F.col("refs") > 0).select(
        "key", "since", F.when(F.col("alive") > 0, "alive").when(F.col("deleted") > 0, "deleted").otherwise("missing").alias("fate")
    )
    late = F.col("checks_late") & (F.col("since") > F.col("at"))
    return (
        references.where(F.col("key").isNotNull())
        .join(suspect, "key")
        .where((F.col("fate") != "alive") | late)
        .select(
            "ref_table",
            F.col("row_id").cast("string").alias("row_id"),
            F.when(F.col("fate") == "alive", "late").otherwise(F.col("fate")).alias("problem"),
            F.coalesce(F.date_format(F.col("at"), "yyyy-MM"), F.lit("unknown")).alias("period"),
        )
        .distinct()
    )


def per_period(found: DataFrame) -> DataFrame:
    """Counts of the report per table, month and problem."""
    return found.groupBy("ref_table", "period", "problem").agg(F.count("*").alias("n"))
