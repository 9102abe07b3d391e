"""One surviving record per group of duplicates, under a two-sided model of source quality.

A source asserts values of a field for a group.  Each value of a group's field is latently true or not, several of them
can be.  A source has a sensitivity (where it says something, it is a true value) and a specificity (it doesn't assert
false ones); expectation-maximisation infers both with the truth of every value.  All values judged true are retained.
One of them becomes the survivor's: the one whose first member ranks first, by the caller's ranking; where the model
judges no value of a field true, the first of all.

A record has one place per field, so a source that asserts one of T true values is no witness against the others:
it asserts a given true value with sensitivity / T, and a given one of the field's M values, if false, with
(1 - specificity) / M.  T is the expected number of true values, M the number of values of the group's field.  Values
are judged by their log odds, which neither over- nor underflow however many sources a group has.

Negative observations are never listed.  A value's log odds are a sum over the sources of its group as if none asserted
it (one number per group and field) and a correction for the sources that do, so each step is linear in the assertions
and every sum combines before its shuffle; a hot group or source leaves each task as one row.  Rounds end when no
parameter moves by more than TOLERANCE.

Nulls: a NULL source is the source ``unknown``; a value without a letter or digit is no assertion; NULL rank fields
come last.  Groups without any value of a field get -1 for it.  Repeated members count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.scratch import BROADCAST_ROWS, Scratch

#: Pseudo-counts (for, against) of a source before any data: sensitive by three quarters, specific by nine tenths.
SENSITIVITY, SPECIFICITY = (6.0, 2.0), (18.0, 2.0)
#: Log odds of a value before any assertion; the most a parameter may still move; rounds after which this is an error.
PRIOR, TOLERANCE, MOST_ROUNDS = 0.0, 0.005, 60


def content(text: Column) -> Column:
    """The text if it holds a letter or digit, else NULL."""
    return F.when(text.rlike(r"[\p{L}\p{N}]"), text)


def rank_key(corrected_at: str = "corrected_at", quality: str = "quality_score", id_: str = "id") -> Column:
    """Least for the first member: latest correction, then highest quality, NULLs last, then smallest id."""
    q, at = F.col(quality).cast("double"), F.unix_micros(corrected_at)
    return F.struct(at.isNull().alias("a"), (-at).alias("b"), q.isNull().alias("c"), (-q).alias("d"), F.col(id_).alias("id"))


def infer(claims: DataFrame, scratch: Scratch) -> DataFrame:
    """claims (group_id, field, value, source, first) -> (group_id, field, value, first, odds).

    ``value`` is a hash of the asserted text; ``first`` the rank key of its first member; ``odds`` the log odds of truth.
    """
    item, slot = ["group_id", "field", "value"], ["group_id", "field"]
    asserted = scratch.cut(claims.groupBy(*item, "source").agg(F.min("first").alias("first")))
    covered = scratch.cut(asserted.select(*slot, "source").distinct())
    made = asserted.select(*item).distinct().groupBy(*slot).agg(F.count("*").alias("m"))
    start = [SENSITIVITY[0] / sum(SENSITIVITY), SPECIFICITY[0] / sum(SPECIFICITY)]
    params = scratch.cut(covered.select("source").distinct().select("source", F.lit(start[0]).alias("sens"), F.lit(start[1]).alias("spec")), n=F.count("*"))
    sized = F.broadcast if scratch.last["n"] <= BROADCAST_ROWS else (lambda df: df)
    state = made.withColumn("t", F.col("m").cast("double"))  # at first all values may be true
    m, t = F.col("m"), F.col("t")
    false = (1 - F.col("spec")) / m
    absent = F.log((1 - F.col("sens") / t) / (1 - false))
    present = F.log((F.col("sens") / t) / false)
    old = []
    for _ in range(MOST_ROUNDS):
        base = covered.join(state, slot).join(sized(params), "source").groupBy(*slot).agg(F.sum(absent).alias("base"), F.first("m").alias("m"))
        lift = asserted.join(state, slot).join(sized(params), "source").groupBy(*item).agg(F.sum(present - absent).alias("lift"), F.min("first").alias("first"))
        judged = lift.join(base, slot).select(*item, "first", "m", (F.lit(PRIOR) + F.col("base") + F.col("lift")).alias("odds"))
        judged = scratch.cut(judged)
        old.append(scratch.path)
        p = 1 / (1 + F.exp(F.least(-F.col("odds"), F.lit(700.0))))
        sums = judged.groupBy(*slot).agg(F.sum(p).alias("t"), F.first("m").alias("m"))
        # one of t true values stands in a record, or none if there is none
        state = scratch.cut(sums.select(*slot, "m", F.least(F.greatest("t", F.lit(1.0)), "m").alias("t"), F.least("t", F.lit(1.0)).alias("some")))
        old.append(scratch.path)
        said = asserted.join(judged.select(*item, p.alias("p")), item).groupBy(*slot, "source").agg(F.max("p").alias("p"), F.avg("p").alias("mean"))
        seen = said.join(state, slot).groupBy("source").agg(F.sum(F.least("p", "some")).alias("tp"), F.sum("some").alias("t"), F.sum(1 - F.col("mean")).alias("fp"), F.count("*").alias("n"))
        new = seen.select(
            "source",
            ((F.col("tp") + SENSITIVITY[0]) / (F.col("t") + sum(SENSITIVITY))).alias("sens"),
            (1 - (F.col("fp") + SPECIFICITY[1]) / (F.col("n") + sum(SPECIFICITY))).alias("spec"),
        )
        before = params.select("source", F.col("sens").alias("sens0"), F.col("spec").alias("spec0"))
        moved = new.join(sized(before), "source").withColumn("moved", F.greatest(F.abs(F.col("sens") - F.col("sens0")), F.abs(F.col("spec") - F.col("spec0"))))
        params = scratch.cut(moved.select("source", "sens", "spec", "moved"), moved=F.max("moved"))
        old.append(scratch.path)
        still = scratch.last["moved"]
        for path in old[:-3]:
            scratch.drop(path)
        old = old[-3:]
        if still is None or still <= TOLERANCE:
            return judged.drop("m")
    raise RuntimeError(f"sources' quality not stable after {MOST_ROUNDS} rounds")


def judge(members: DataFrame, fields: list[str], scratch: Scratch) -> DataFrame:
    """members (group_id, id, source, rank, <fields>) -> posterior of every value of every group's field."""
    said = F.array(*[F.struct(F.lit(f).alias("field"), content(F.col(f)).alias("text")) for f in fields])
    claims = (
        members.select("group_id", "rank", F.coalesce(F.col("source").cast("string"), F.lit("unknown")).alias("source"), F.inline(said))
        .where("text IS NOT NULL")
        .select("group_id", "field", F.xxhash64("text").alias("value"), "source", F.col("rank").alias("first"))
    )
    return infer(claims, scratch)


def survivors(members: DataFrame, judged: DataFrame, fields: list[str]) -> DataFrame:
    """(group_id, best_id, <field>_id, <field>_first, ...): the first member, and per field the first with a true value.

    Where the model judges no value of a field true, the first one stands.  ``first`` is the first member with any value;
    where it differs, the model passed over a value that ranks before the one taken.
    """
    best = members.select("group_id", F.lit("").alias("field"), F.col("rank").alias("first"), F.lit(True).alias("true"))
    every = best.unionByName(judged.select("group_id", "field", "first", (F.col("odds") >= 0).alias("true")))
    first = lambda f, c=True: F.min(F.when((F.col("field") == f) & c, F.col("first")))["id"]
    picked = every.groupBy("group_id").agg(first("").alias("best_id"), *[x for f in fields for x in (first(f).alias(f"{f}_any"), first(f, F.col("true")).alias(f"{f}_true"))])
    or_none = lambda *c: F.coalesce(*c, F.lit(-1)).cast("bigint")
    return picked.select("group_id", "best_id", *[x for f in fields for x in (or_none(f"{f}_true", f"{f}_any").alias(f"{f}_id"), or_none(f"{f}_any").alias(f"{f}_first"))])


def by_order(members: DataFrame, fields: list[str]) -> DataFrame:
    """(group_id, best_id, <field>_id, ...): the first member, and per field the first with any value, -1 if there is none."""
    first = lambda f: F.coalesce(F.min(F.when(content(F.col(f)).isNotNull(), F.col("rank")))["id"], F.lit(-1)).cast("bigint").alias(f"{f}_id")
    return members.groupBy("group_id").agg(F.min("rank")["id"].alias("best_id"), *[first(f) for f in fields])
