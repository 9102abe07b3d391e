"""Pairs consolidated into groups: hash-to-min over rows.

Each vertex v holds a cluster C(v), at first itself and its neighbours.  In a round it sends C(v) to the smallest
member m of C(v), and m to all the others; what arrives is the new cluster.  The rounds end when nothing changes:
then every vertex but the smallest holds just that smallest, in a number of rounds logarithmic in the path length.

A cluster is kept as rows (v, u), never as one set, so no task or row holds a whole group: minima combine before the
shuffle, duplicates are removed by the pair (which spreads a hot vertex over all tasks), and the join of a cluster's
rows with its minimum has one row per vertex on the other side, which the skew join splits.

Nulls and self pairs link nothing and are left out; repeated or reversed pairs count once.  An empty input gives an
empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.scratch import Scratch

MAX_ROUNDS = 64


def groups(pairs: DataFrame, a: str, b: str, scratch: Scratch | None = None) -> DataFrame:
    """(member, group_id): every id in a pair of two different ids, with the smallest id it is linked to."""
    scratch = scratch or Scratch(pairs.sparkSession)
    links = pairs.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b")).where("a <> b")
    sent = F.array(*[F.struct(F.col(x).alias("v"), F.col(y).alias("u")) for x, y in (("a", "b"), ("b", "a"), ("a", "a"), ("b", "b"))])
    state = links.select(F.inline(sent)).distinct()
    measures = {"rows": F.count("*"), "sum": F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))}
    state = scratch.cut(state, **measures)
    before, old = scratch.last, scratch.path
    for _ in range(MAX_ROUNDS):
        least = state.groupBy("v").agg(F.min("u").alias("m"))
        mail = state.join(least, "v").select(
            F.inline(F.array(F.struct(F.col("m").alias("v"), "u"), F.struct(F.col("u").alias("v"), F.col("m").alias("u"))))
        )
        state = scratch.cut(mail.distinct(), **measures)
        scratch.drop(old)
        old = scratch.path
        if scratch.last == before:
            return state.groupBy(F.col("v").alias("member")).agg(F.min("u").alias("group_id"))
        before = scratch.last
    raise RuntimeError(f"not stable after {MAX_ROUNDS} rounds")
