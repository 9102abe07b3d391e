"""Exact duplicates: agreement buckets, keepers, merge plan, and the cascade of a merge over other tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.functions import canon
from tamis.scratch import Scratch, spread


def with_identity(q: DataFrame) -> DataFrame:
    """Adds identity and answer to question rows.

    Each canonical form is a column of its own before it is used, so it is made once a row.
    """
    c = spread(q).withColumn("_c", canon.composed("question_text", "correct_text", "options"))
    option = canon.indexed_option(F.col("correct_index"), F.col("_c.options"))
    forms = {
        "_stem": canon.canonical_stem(F.col("_c.text")), "_opts": canon.sorted_options(F.col("_c.options")),
        "_said": canon.canonical_answer(F.col("_c.answer")), "_option": F.when(option.isNotNull(), canon.canonical_answer(option)),
    }
    return c.withColumns(forms).select(
        *q.columns,
        canon.identity_of(F.col("_stem"), F.col("_opts")).alias("identity"),
        canon.answer_of(F.col("_c.answer"), F.col("_said"), F.col("correct_index"), F.col("_option")).alias("answer"),
    )


def keeper_order() -> Column:
    """Least for the keeper: latest correction, best quality, smallest id; NULL as the least of each."""
    return F.struct((-F.coalesce(F.unix_micros("corrected_at"), F.lit(0))).alias("a"), (-F.coalesce("quality_score", F.lit(0.0))).alias("b"), F.col("id").alias("id"))


def groups(q: DataFrame) -> DataFrame:
    """Per chapter and identity: copies and answer buckets, of groups of two or more.  Sentinels are buckets too."""
    return q.groupBy("chapter_id", "identity").agg(F.count("*").alias("n"), F.count_distinct("answer").alias("answers")).where("n > 1")


def merge_plan(q: DataFrame) -> DataFrame:
    """(chapter_id, identity, keeper_id, duplicate_id): within agreeing answers only; sentinels never merge.

    The keeper of a bucket is an aggregate with partial sums and is joined back, so a hot bucket never sits in one
    sorted window.
    """
    bucket = ["chapter_id", "identity", "answer"]
    able = Scratch(q.sparkSession).cut(q.where(~F.col("answer").startswith("__")).select(*bucket, "id", keeper_order().alias("k")))
    keep = able.groupBy(*bucket).agg(F.min("k")["id"].alias("keeper_id"), F.count("*").alias("n")).where("n > 1")
    return able.join(keep, bucket).where("id <> keeper_id").select("chapter_id", "identity", "keeper_id", F.col("id").alias("duplicate_id"))


def within_cap(plan: DataFrame, live: int, least: int = 500, share: float = 0.05) -> bool:
    """False if a plan merges more than its cap and should be refused."""
    return plan.count() <= max(least, live * share)


def cascade(plan: DataFrame, children: dict[str, tuple[DataFrame, str, list[str]]]) -> dict[str, DataFrame]:
    """Child tables repointed from duplicates to keepers in one pass each.

    children: name -> (table, foreign key, columns that with the key must stay unique).
    """
    to = plan.select(F.col("duplicate_id").alias("_dup"), "keeper_id")
    out = {}
    for name, (child, fk, unique) in children.items():
        moved = child.join(to, child[fk] == to["_dup"], "left").withColumn(fk, F.coalesce("keeper_id", fk)).drop("_dup", "keeper_id")
        out[name] = moved.dropDuplicates([fk, *unique]) if unique else moved
    return out


def tombstones(q: DataFrame, plan: DataFrame) -> DataFrame:
    """Source and content keys of merged rows, so that a later import does not bring them back."""
    gone = q.join(plan.select(F.col("duplicate_id").alias("id"), "keeper_id"), "id")
    return gone.select("file_ref_id", "source_question_key", F.col("identity").alias("identity_key"), F.col("id").alias("deleted_question_id"), "keeper_id")


def rejected(plan: DataFrame, pairs: DataFrame) -> DataFrame:
    """(id, status, review_note) of the pending review pairs (id, q1_id, q2_id, status) that name a merged row."""
    pending = pairs.where("lower(trim(status)) = 'pending'").select("id", F.explode(F.array_distinct(F.array("q1_id", "q2_id"))).alias("duplicate_id"))
    hit = pending.join(plan.select("duplicate_id"), "duplicate_id", "left_semi").select("id").distinct()
    return hit.select("id", F.lit("rejected").alias("status"), F.lit("question merged").alias("review_note"))


def cleared(plan: DataFrame, pointers: DataFrame) -> DataFrame:
    """(id, duplicate_id, canonical_id) of rows (id, canonical_id) that pointed to a merged row; canonical_id is NULL now."""
    to = pointers.select("id", F.col("canonical_id").alias("duplicate_id")).join(plan.select("duplicate_id"), "duplicate_id", "left_semi")
    return to.select("id", "duplicate_id", F.lit(None).cast("bigint").alias("canonical_id"))


def audit(plan: DataFrame, questions: DataFrame, reason: str = "exact") -> DataFrame:
    """One row for each merge, with the merged row as it is stored in the snapshot; rows of child tables aren't."""
    q = questions.select(F.col("id").alias("duplicate_id"), F.struct(*questions.columns).alias("question"))
    both = plan.join(q, "duplicate_id").withColumns({"child_rows": F.create_map().cast("map<string,string>"), "keeper_before": F.lit(None).cast("string")})
    return both.select(
        F.col("identity").alias("signature"), F.col("keeper_id").alias("canonical_id"), F.col("duplicate_id").alias("deleted_id"),
        *[f"question.{c}" for c in ("question_text", "options", "correct_index", "correct_text")], F.lit(reason).alias("reason"),
        F.to_json(F.struct("question", "child_rows", "keeper_before"), {"ignoreNullFields": "false"}).alias("snapshot"),
    )


def resolve(pointers: DataFrame, hops: int = 10) -> DataFrame:
    """(id, target) -> (id, root, hops): pointers followed at most ``hops`` steps; a loop or a longer chain gives NULL.

    Each step is an equi-join of the open rows only, written so that the next starts from it; the steps end when none is open.
    """
    scratch = Scratch(pointers.sparkSession)
    p = scratch.cut(pointers.where("target IS NOT NULL").select(F.col("id").alias("at"), F.col("target").alias("next")))
    done = [pointers.where("target IS NULL").select("id", F.col("id").alias("root"), F.lit(0).alias("hops"))]
    now = p.select(F.col("at").alias("id"), F.col("next").alias("root"))
    for k in range(1, hops + 1):
        step = scratch.cut(now.join(p, now["root"] == p["at"], "left").select("id", "root", "next"), open=F.count("next"))
        done.append(step.where("next IS NULL").select("id", "root", F.lit(k).alias("hops")))
        if not scratch.last["open"]:
            return reduce(DataFrame.unionByName, done)
        now = step.where("next IS NOT NULL").select("id", F.col("next").alias("root"))
    return reduce(DataFrame.unionByName, [*done, now.select("id", F.lit(None).cast("bigint").alias("root"), F.lit(hops + 1).alias("hops"))])


def latest(df: DataFrame, key: str, *order: Column) -> DataFrame:
    """The last row per key; partial maxima combine before the shuffle."""
    cols = df.columns
    return df.groupBy(key).agg(F.max_by(F.struct(*cols), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])).alias("r")).select("r.*")


def upsert(old: DataFrame, new: DataFrame, key: str, keep_old: Column | None = None, held: list[str] | None = None, own: list[str] = ()) -> DataFrame:
    """Rows of both, new ones over old ones of the same key; where ``keep_old`` (over the old row) holds, the old stays.

    With ``held`` only these columns stay then, and the others are the new ones.  Columns in ``own`` are never overwritten.
    """
    cols = old.columns
    flag = F.lit(False) if keep_old is None else F.coalesce(keep_old, F.lit(False))
    o, n = old.select(F.struct(*cols).alias("o"), flag.alias("_held"), F.col(key).alias("_k")), new.select(F.struct(*cols).alias("n"), F.col(key).alias("_k"))

    def of(c: str) -> Column:
        there = F.col("o").isNotNull()
        stays = there if c in own else there & F.coalesce("_held", F.lit(False)) if held is None or c in held else F.lit(False)
        return F.when(F.col("n").isNull() | stays, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c)

    return o.join(n, "_k", "full").select(*[of(c) for c in cols])


def parts(df: DataFrame, group: list[str], order: list[Column], size: int = 50) -> DataFrame:
    """Adds part (1-based) and place in the part, by position in the group."""
    n = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("n", n).withColumns({"part": F.ceil(F.col("n") / size).cast("int"), "place": ((F.col("n") - 1) % size + 1).cast("int")}).drop("n")
