"""Immutable public ids: level, chapter, code, file and sequence, zero-padded and joined."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.functions.canon import pad


def prefix(level: Column, chapter: Column, code: Column, file: Column) -> Column:
    return F.concat(level.cast("string"), pad(chapter.cast("string"), 3), pad(code.cast("string"), 3), file.cast("string"))


def allocate(wanted: DataFrame, taken: DataFrame, probes: int = 200) -> DataFrame:
    """wanted (group_id, prefix, seq), taken (public_id) -> (group_id, public_id).

    Greedy by group_id within a prefix: a group takes its sequence, or the next free one of ``probes``; a group that
    finds none is an error.  A prefix holds one file part (50 items), so its groups are few.
    """

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        used = {*(x for x in pdf["public_id"] if isinstance(x, str))}
        out = []
        for row in pdf[pdf["group_id"].notna()].sort_values("group_id").itertuples():
            free = (f"{key[0]}{int(row.seq) + k:04d}" for k in range(probes))
            got = next((x for x in free if x not in used), None)
            if got is None:
                raise ValueError(f"no free sequence from {int(row.seq)} on under {key[0]} for group {int(row.group_id)}")
            used.add(got)
            out.append((int(row.group_id), got))
        return pd.DataFrame(out, columns=["group_id", "public_id"])

    heads = wanted.select("prefix").distinct()
    held = taken.where("public_id IS NOT NULL").withColumn("prefix", F.expr("left(public_id, length(public_id) - 4)")).join(heads, "prefix", "left_semi")
    none = lambda t: F.lit(None).cast(t)
    both = wanted.select("prefix", "group_id", "seq", none("string").alias("public_id")).unionByName(held.select("prefix", none("bigint").alias("group_id"), none("int").alias("seq"), "public_id"))
    return both.groupBy("prefix").applyInPandas(one, "group_id bigint, public_id string")


def layout(q: DataFrame, size: int = 50) -> DataFrame:
    """(id, level, chapter, code, ...) in order of (chapter, code, number, id): adds part and seq within the part."""
    n = F.row_number().over(Window.partitionBy("level", "chapter", "code").orderBy(F.col("number").asc_nulls_last(), "id"))
    return q.withColumn("n", n).withColumns({"part": F.ceil(F.col("n") / size).cast("int"), "seq": ((F.col("n") - 1) % size + 1).cast("int")}).drop("n")


def plan(q: DataFrame, taken: DataFrame, size: int = 50) -> DataFrame:
    """(group_id, public_id, reused) of every identity of a level; group_id is the id of its keeper.

    q: live questions (id, level, chapter, code, number, key, stable_qn_id, corrected_at, quality_score); key is the
    identity.  taken (id, public_id, live): all ids ever given.  The keeper is the best of an identity (one that has an id,
    the latest correction, quality, smallest id).  Its id is reused, else one is allocated at its place, the identity of
    the smallest question id first.  An id held by a live question of another identity is an error.
    """
    at = layout(q, size).withColumn("held", F.nullif(F.col("stable_qn_id"), F.lit("")))
    order = F.struct(F.col("held").isNotNull(), F.col("corrected_at").isNotNull(), "corrected_at", F.coalesce("quality_score", F.lit(0.0)), -F.col("id"))
    keep = F.max_by(F.struct("id", "held", "seq", prefix(F.col("level"), F.col("chapter"), F.col("code"), F.col("part")).alias("prefix")), order)
    group = at.groupBy("level", "key").agg(F.min("id").alias("first"), keep.alias("k")).select("first", "k.*")
    new = allocate(group.where("held IS NULL").select(F.col("first").alias("group_id"), "prefix", "seq"), taken.select("public_id"))
    new = new.withColumnRenamed("group_id", "first").join(group.select("first", "id"), "first")
    whose = taken.where("live AND public_id IS NOT NULL").select("id", "public_id").join(at.select("id", "level", "key"), "id", "left")
    owners = whose.groupBy("public_id").agg(F.count_distinct(F.struct("level", "key")).alias("owners"))
    old = group.where("held IS NOT NULL").select("id", F.col("held").alias("public_id")).join(owners, "public_id", "left")
    clash = F.concat(F.lit("public id "), F.col("public_id"), F.lit(" is held by several identities"))
    old = old.where(F.when(F.col("owners") > 1, F.raise_error(clash).cast("boolean")).otherwise(True))
    out = lambda df, reused: df.select(F.col("id").alias("group_id"), "public_id", F.lit(reused).alias("reused"))
    return out(new, False).unionByName(out(old, True))
