"""Sources mixed to target shares of all tokens.

Each source's documents, in a pseudorandom order, form one stream of tokens that is cut into blocks of fixed length.
The mixture is a row of slots, each for one block; slots are cut into output shards of SHARD_SLOTS.  How many slots of a
shard each source gets is a multinomial draw, conditional on the exact totals, so shards vary and the whole meets the
targets.  The draws split a tree of shards: the slots of a node's left half are drawn from the node's, seeded by the node,
so every task finds the counts of its own shards by itself, whatever their number.  The slots of a source are numbered
through all shards; a keyed permutation of the numbers 0 .. blocks x max_repeats - 1 turns each into a block, so no block
is used more than max_repeats times and all are used about equally.  Slots and blocks meet by an equi-join on
(source, block).

Without a wanted size the mixture is as large as the scarcest source allows.  NULL, unknown and empty sources and
documents without tokens are not used; the shares of the other targets are scaled to sum 1.  Rows with the same doc_id
lie side by side in the stream and are used as rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tamis.scratch import Scratch

BLOCK_TOKENS, SHARD_SLOTS, MAX_SOURCES, BUCKET_ROWS = 256, 4096, 10_000, 5_000
#: From this many slots on, draws without replacement are by their limits: binomial for rare sources, else normal.
MANY, RARE = 10**9, 10**6


def permute(k: np.ndarray, size: int, key: int) -> np.ndarray:
    """A keyed permutation of 0 .. size-1: four Feistel rounds, walked until inside the range."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    rng = np.random.default_rng(key)
    keys = rng.integers(1, 2**63, 4, dtype=np.uint64)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for c in keys:
            mixed = (right + c) * np.uint64(0xBF58476D1CE4E5B9)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((mixed >> np.uint64(33)) & mask)
        return (left << np.uint64(half)) | right

    x = once(k.astype(np.uint64))
    while (out := x >= np.uint64(size)).any():
        x[out] = once(x[out])
    return x.astype(np.int64)


def stream(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """docs (doc_id, source, tokens) -> with ``start``, the place of the document in its source's stream.

    Running sums go over buckets of about BUCKET_ROWS rows, then over the buckets' totals, so no source is one task.
    """
    n = docs.count()
    buckets = max(1, -(-n // BUCKET_ROWS))
    h = docs.withColumn("h", F.xxhash64("doc_id", F.lit(7))).withColumn("bucket", F.pmod("h", F.lit(buckets)))
    totals = h.groupBy("source", "bucket").agg(F.sum("tokens").alias("t"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("source", "bucket", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = h.withColumn("inside", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    return placed.join(offsets, ["source", "bucket"]).select("doc_id", "source", "tokens", (F.col("offset") + F.col("inside")).alias("start"))


def plan(sources: list[tuple[str, float, int, int]], slots: int | None) -> dict[str, int]:
    """Slots per source from (source, share, max_repeats, blocks), largest remainders first."""
    shares = {s: share / sum(x[1] for x in sources) for s, share, _, _ in sources}
    most = min((r * b / shares[s] for s, _, r, b in sources if shares[s] > 0), default=0)
    total = int(most + 1e-9) if slots is None else min(slots, int(most + 1e-9))
    exact = {s: shares[s] * total for s in shares}
    got = {s: int(x) for s, x in exact.items()}
    room = {s: r * b for s, _, r, b in sources}
    for s in sorted(exact, key=lambda s: (got[s] - exact[s], s))[: total - sum(got.values())]:
        got[s] = min(got[s] + 1, room[s])
    return got


def without_replacement(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws out of good + bad are good; every n - bad at least, n and good at most."""
    all_ = good + bad
    if n <= 0 or good <= 0:
        return 0
    if bad <= 0 or n >= all_:
        return min(good, n)
    if all_ < MANY:
        return int(rng.hypergeometric(good, bad, n))
    share = n / all_
    if good < RARE:
        k = int(rng.binomial(good, share))
    elif n < RARE:
        k = int(rng.binomial(n, good / all_))
    else:
        k = round(rng.normal(good * share, (good * share * (bad / all_) * (1 - share)) ** 0.5))
    return min(max(k, n - bad, 0), n, good)


def draw(totals: list[int], n: int, seed: tuple[int, ...]) -> list[int]:
    """Counts per source of ``n`` slots drawn from ``totals`` without replacement."""
    rng, left, out = np.random.default_rng(seed), sum(totals), []
    for t in totals:
        left -= t
        out.append(without_replacement(rng, t, left, n))
        n -= out[-1]
    return out


def shard_counts(totals: list[int], shards: int, first: int, last: int, seed: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """(shard, slots of each source before it, slots of each source in it) of the shards first .. last - 1."""
    slots = sum(totals)
    at = lambda shard: slots * shard // shards
    todo = [(0, shards, totals, [0] * len(totals))]
    while todo:
        lo, hi, own, before = todo.pop()
        if hi <= first or lo >= last:
            continue
        if hi - lo == 1:
            yield lo, before, own
            continue
        middle = (lo + hi) // 2
        left = draw(own, at(middle) - at(lo), (seed, lo, hi))
        todo.append((middle, hi, [a - b for a, b in zip(own, left)], [a + b for a, b in zip(before, left)]))
        todo.append((lo, middle, left, before))


def _slots(names: list[str], totals: list[int], blocks: list[int], repeats: list[int], shards: int, seed: int):
    """Shard numbers -> (shard, slot, source, block); the sources of a shard's slots are shuffled."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ids = np.sort(pdf["id"].to_numpy())
            for run_ in np.split(ids, np.flatnonzero(np.diff(ids) != 1) + 1) if len(ids) else ():
                for shard, before, own in shard_counts(totals, shards, int(run_[0]), int(run_[-1]) + 1, seed):
                    s = np.repeat(np.arange(len(own)), own)
                    block = [permute(np.arange(b, b + n), blocks[i] * repeats[i], seed * 1_000_003 + i) % blocks[i] for i, (b, n) in enumerate(zip(before, own)) if n]
                    order = np.random.default_rng((seed, shard)).permutation(len(s))
                    block = np.concatenate(block) if block else np.zeros(0, np.int64)
                    yield pd.DataFrame({"shard": shard, "slot": np.arange(len(s)), "source": np.array(names, object)[s[order]], "block": block[order]})

    return run


def planned(docs: DataFrame, targets: DataFrame, total_tokens: int | None, seed: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The used documents with their places in the streams, and the slots (shard, slot, source, block) of the mixture."""
    spark = docs.sparkSession
    rows = targets.select("source", "target_share", "max_repeats").where("source IS NOT NULL AND target_share > 0 AND max_repeats > 0").limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    names = F.array(*[F.lit(r["source"]) for r in rows]).cast("array<string>") if rows else F.array().cast("array<string>")
    used = docs.select("doc_id", "source", F.col("tokens").cast("bigint").alias("tokens")).where(F.array_contains(names, F.col("source")) & (F.col("tokens") > 0))
    used = scratch.cut(used)
    raw = scratch.path
    placed = scratch.cut(stream(used, scratch))
    scratch.drop(raw)
    size = {r["source"]: r["t"] for r in placed.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}  # a row per target
    known = [(r["source"], r["target_share"], r["max_repeats"], -(-size[r["source"]] // BLOCK_TOKENS)) for r in sorted(rows, key=lambda r: r["source"]) if size.get(r["source"])]
    got = plan(known, None if total_tokens is None else -(-total_tokens // BLOCK_TOKENS))
    totals = [got[k[0]] for k in known]
    shards = -(-sum(totals) // SHARD_SLOTS)
    run = _slots([k[0] for k in known], totals, [k[3] for k in known], [k[2] for k in known], shards, seed)
    tasks = min(max(shards, 1), max(spark.sparkContext.defaultParallelism, min(20_000, shards // 64)))
    return placed, spark.range(0, shards, 1, tasks).mapInPandas(run, "shard bigint, slot bigint, source string, block bigint")


def ordered_slots(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 0, scratch: Scratch | None = None) -> DataFrame:
    """(shard, slot, source, block): which block of which source's stream stands in each slot of the mixture."""
    return planned(docs, targets, total_tokens, seed, scratch or Scratch(docs.sparkSession))[1]


def mix(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 0, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """docs (doc_id, source, tokens), targets (source, target_share, max_repeats) -> two tables:

    (doc_id, source, uses, used_tokens): chosen documents; ``uses`` is the most times any part of it is used;
    (source, target_share, actual_share, used_tokens, docs): the shares reached, one row per target.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    placed, slots = planned(docs, targets, total_tokens, seed, scratch)
    times = slots.groupBy("source", "block").agg(F.count("*").alias("times"))
    first, last = F.floor(F.col("start") / BLOCK_TOKENS), F.floor((F.col("start") + F.col("tokens") - 1) / BLOCK_TOKENS)
    parts = placed.select("*", F.explode(F.sequence(first, last)).alias("block"))
    inside = F.least(F.col("start") + F.col("tokens"), (F.col("block") + 1) * BLOCK_TOKENS) - F.greatest(F.col("start"), F.col("block") * BLOCK_TOKENS)
    chosen = parts.join(times, ["source", "block"]).groupBy("doc_id", "source", "start").agg(F.max("times").alias("uses"), F.sum(inside * F.col("times")).alias("used_tokens"))
    chosen = scratch.cut(chosen.select("doc_id", "source", "uses", "used_tokens"))
    by_source = chosen.groupBy("source").agg(F.sum("used_tokens").alias("used_tokens"), F.count("*").alias("docs"))
    everything = chosen.agg(F.sum("used_tokens").alias("all")).first()["all"] or 1
    wanted = targets.select("source", "target_share").where("source IS NOT NULL")
    shares = wanted.join(by_source, "source", "left").select(
        "source", "target_share", (F.coalesce("used_tokens", F.lit(0)) / F.lit(everything)).alias("actual_share"), F.coalesce("used_tokens", F.lit(0)).alias("used_tokens"), F.coalesce("docs", F.lit(0)).alias("docs")
    )
    return chosen, shares
