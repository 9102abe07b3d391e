"""Snapshots compared, edits matched to records by tiers, corrections laid over imports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def diff(old: DataFrame, new: DataFrame, key: list[str], content: Column | str) -> DataFrame:
    """(key, action): new, deleted, changed or same, by a full outer join on the key and null-safe content."""
    c = content if isinstance(content, Column) else F.col(content)
    o, n = old.select(*key, c.alias("o"), F.lit(True).alias("in_old")), new.select(*key, c.alias("n"), F.lit(True).alias("in_new"))
    both = o.join(n, key, "full")
    return both.select(*key, F.when(F.col("in_old").isNull(), "new").when(F.col("in_new").isNull(), "deleted").when(F.col("o").eqNullSafe(F.col("n")), "same").otherwise("changed").alias("action"))


def guard_deletes(actions: DataFrame, most: int = 25, share: float = 0.1) -> bool:
    """False if a diff deletes more than ``most`` and more than ``share`` of what was there."""
    r = actions.agg(F.count_if(F.col("action") == "deleted").alias("d"), F.count_if(F.col("action") != "new").alias("n")).first()
    return not (r["d"] > most and r["d"] > share * r["n"])


def tiered_match(edits: DataFrame, records: DataFrame, tiers: list[tuple[str, list[str]]]) -> DataFrame:
    """(edit_id, tier, record_id, reason): the first tier that finds anything decides; several found is ambiguous.

    ``tiers`` are (name, equal columns), present in both tables; edits has edit_id, records has record_id.
    """
    found = []
    for rank, (name, on) in enumerate(tiers):
        hits = edits.select("edit_id", *on).dropna(subset=on).join(records.select("record_id", *on).distinct(), on)
        found.append(hits.groupBy("edit_id").agg(F.count_distinct("record_id").alias("n"), F.min("record_id").alias("r")).select("edit_id", F.struct(F.lit(rank).alias("rank"), F.lit(name).alias("tier"), "n", "r").alias("m")))
    first = reduce(DataFrame.unionByName, found).groupBy("edit_id").agg(F.min("m").alias("m"))
    out = edits.select("edit_id").distinct().join(first, "edit_id", "left")
    return out.select(
        "edit_id", F.col("m.tier").alias("tier"), F.when(F.col("m.n") == 1, F.col("m.r")).alias("record_id"),
        F.when(F.col("m").isNull(), "no_match").when(F.col("m.n") > 1, "ambiguous").otherwise("matched").alias("reason"),
    )


def overlay(rows: DataFrame, edits: DataFrame, key: str, fields: list[str], newest: str) -> DataFrame:
    """Rows with the fields of their newest edit in place of their own."""
    last = edits.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(newest, *fields)).alias("e"))
    out = rows.join(last, key, "left")
    return out.select(*[F.coalesce(F.col(f"e.{c}"), F.col(c)).alias(c) if c in fields else F.col(c) for c in rows.columns])
