"""Set-similarity join by size-aware heavy and light keys.

Sets are the distinct words of records of one scope, as 64-bit hashes of (scope, word).  With Jaccard similarity >= t a
set of n words shares at least a = ceil(t n) of them with any partner, so under one global order (rare words first) the
first n - a + k words of both share at least k.  Two ways to meet follow:

* small sets list the 2-subsets of their first n - a + 2 words and meet on a subset;
* large sets scan the inverted lists of their first n - a + 1 words, in which all sets large enough to match stand.

The boundary between small and large is the size at which the summed costs, subsets listed below it and postings
scanned above it, are least; both are measured on all sets.  Words that occur in one set only lead nowhere: they take
the front places of the order and list no key.  Pairs that meet are thinned by size, place and a 128-bit signature
(its Hamming distance is at most the symmetric difference), made distinct, and verified on the whole sets.

Word counts combine before their shuffle; frequent words (at least 1/50,000 of all word places, so at most 50,000 of
them) go to executors as one bounded array and never shuffle per row.  Sets that are equal are joined once by their
representative.  No key, list or candidate is capped.

NULL texts and options count as empty; records without words match nothing.  Equal rows are members like others.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.text import WS
from tamis.scratch import Scratch, small

FREQUENT = 50_000
#: Cost of one listed 2-subset (a row shuffled and sorted) in postings scanned.
SUBSET_COST = 6


def words(text: Column, scope: Column) -> Column:
    """Distinct words: pieces between white space, lower case, letters and digits only; hashed and sorted."""
    kept = F.regexp_replace(F.lower(text), rf"[^\p{{L}}\p{{N}}{WS}]+", "")
    pieces = F.filter(F.split(kept, rf"[{WS}]+"), lambda w: w != "")
    return F.array_sort(F.array_distinct(F.transform(pieces, lambda w: F.xxhash64(scope, w))))


def _places(frequent: tuple[np.ndarray, np.ndarray], t: Fraction):
    """Per set: signature, words that aren't frequent, and the frequent ones that its first n - a + 2 places need."""
    keys, counts = frequent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            lists = b.column("words")
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy().cumsum()
            n = lists.value_lengths().to_numpy().astype(np.int64)
            starts = ends - n
            bit = (flat.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(57)).astype(np.uint64)
            one = np.uint64(1) << (bit & np.uint64(63))
            low, high = np.where(bit < 64, one, np.uint64(0)), np.where(bit >= 64, one, np.uint64(0))
            sig = [np.bitwise_or.reduceat(x, starts).view(np.int64) for x in (low, high)]
            at = np.searchsorted(keys, flat).clip(max=max(0, len(keys) - 1))
            df = np.where(keys[at] == flat, counts[at], 0) if len(keys) else np.zeros(len(flat), np.int64)
            row = np.repeat(np.arange(len(n)), n)
            rare = df == 0
            n_rare = np.bincount(row[rare], minlength=len(n))
            need = np.maximum(0, n - -(-n * t.numerator // t.denominator) + 2 - n_rare)
            order = np.lexsort((flat, df, row))
            order = order[df[order] > 0]
            rank = np.arange(len(order)) - np.searchsorted(row[order], np.arange(len(n)))[row[order]]
            order = order[rank < need[row[order]]]
            cut = lambda mask_rows, values: pa.ListArray.from_arrays(np.concatenate([[0], np.bincount(mask_rows, minlength=len(n)).cumsum()]).astype(np.int32), values)
            yield pa.RecordBatch.from_arrays(
                [b.column("sid"), pa.array(n.astype(np.int32)), pa.array(n_rare.astype(np.int32)), pa.array(sig[0]), pa.array(sig[1]),
                 cut(row[rare], pa.array(flat[rare])),
                 cut(row[order], pa.StructArray.from_arrays([pa.array(df[order].astype(np.int64)), pa.array(flat[order])], ["df", "w"]))],
                names=["sid", "n", "n_rare", "s0", "s1", "rare", "frequent"],
            )

    return run


def boundary(by_size: list[tuple[int, int, int]]) -> int:
    """Largest size of small sets, from (size, subsets, postings) summed over sets of that size."""
    by_size = sorted(by_size)
    scan = sum(p for _, _, p in by_size)
    best, at, listed = scan, 0, 0
    for size, subsets, postings in by_size:
        listed, scan = listed + SUBSET_COST * subsets, scan - postings
        if listed + scan < best:
            best, at = listed + scan, size
    return at


def similar_sets(sets: DataFrame, threshold: float = 0.8, scratch: Scratch | None = None, split: int | None = None) -> DataFrame:
    """sets (sid, words), unequal and not empty -> pairs (a, b), a < b, of Jaccard similarity >= threshold.

    ``split`` sets the boundary in place of the measured one (for tests).
    """
    spark = sets.sparkSession
    scratch = scratch or Scratch(spark)
    t = Fraction(threshold).limit_denominator(1000)
    at_least = lambda n: F.ceil((n * t.numerator) / F.lit(float(t.denominator)) - 1e-9)
    each = sets.select("sid", F.explode("words").alias("w"))
    freq = scratch.cut(each.groupBy("w").agg(F.count("*").alias("df")).where("df > 1"), places=F.sum("df"))
    floor = max(2, -(-(scratch.last["places"] or 0) // FREQUENT))
    top = freq.where(F.col("df") >= floor).toPandas().sort_values("w")  # at most FREQUENT rows
    frequent = (top["w"].to_numpy(np.int64), top["df"].to_numpy(np.int64))
    schema = "sid bigint, n int, n_rare int, s0 bigint, s1 bigint, rare array<bigint>, frequent array<struct<df:bigint,w:bigint>>"
    placed = scratch.cut(sets.mapInArrow(_places(frequent, t), schema))
    met = placed.select("sid", F.explode("rare").alias("w")).join(freq.where(F.col("df") < floor), "w")
    shared = met.groupBy("sid").agg(F.array_sort(F.collect_list(F.struct("df", "w"))).alias("shared"))
    none = F.array().cast("array<struct<df:bigint,w:bigint>>")
    full = placed.drop("rare").join(shared, "sid", "left").withColumn("shared", F.coalesce("shared", none))
    first = F.col("n_rare") - F.size("shared")  # places of words that no other set has
    order = F.transform(F.concat("shared", "frequent"), lambda x, i: F.struct((first + i).cast("int").alias("p"), x["w"].alias("w"), x["df"].alias("df")))
    room = F.col("n") - at_least(F.col("n"))
    full = full.select("sid", "n", "s0", "s1", F.filter(order, lambda x: x["p"] < room + 2).alias("keys")).where(F.size("keys") > 0)
    m = F.size("keys")
    postings = F.aggregate("keys", F.lit(0).cast("bigint"), lambda acc, x: acc + F.when(x["p"] < room + 1, x["df"]).otherwise(0))
    full = scratch.cut(full)
    if split is None:
        # sizes are binned to steps of an eighth, so the table of costs has some 200 rows however long texts get
        bin_ = F.when(F.col("n") < 64, F.col("n").cast("double")).otherwise(F.ceil(F.pow(F.lit(1.125), F.ceil(F.log(1.125, F.col("n"))))))
        costs = full.groupBy(bin_.cast("bigint").alias("size")).agg(F.sum(m * (m - 1) / 2).cast("bigint").alias("subsets"), F.sum(postings).alias("postings")).collect()
        split = boundary([tuple(c) for c in costs])
    base = ["sid", "n", "s0", "s1"]
    x = full.where(F.col("n") <= split).select(*base, F.posexplode("keys").alias("i", "x"), "keys")
    subsets = x.select(*base, "x", F.explode(F.slice("keys", F.col("i") + 2, F.greatest(F.size("keys") - F.col("i") - 1, F.lit(0)))).alias("y")).select(
        *base, F.xxhash64("x.w", "y.w").alias("key"), F.col("x.p").alias("p0"), F.col("y.p").alias("p")
    )
    lists = full.select(*base, F.explode(F.filter("keys", lambda k: k["p"] < room + 1)).alias("x")).select(*base, F.col("x.w").alias("key"), F.lit(0).alias("p0"), F.col("x.p").alias("p"))
    lists = lists.where(F.col("n") * t.denominator >= split * t.numerator)

    def meet(a: DataFrame, b: DataFrame, k: int, distinct_sides: Column) -> DataFrame:
        a = a.select("key", *[F.col(c).alias(f"a_{c}") for c in (*base, "p0", "p")])
        b = b.select("key", *[F.col(c).alias(f"b_{c}") for c in (*base, "p0", "p")])
        n, o = F.col("a_n"), F.col("b_n")
        overlap = at_least_pair = F.ceil((n + o) * t.numerator / F.lit(float(t.numerator + t.denominator)) - 1e-9)
        rest = F.least(n - F.col("a_p"), o - F.col("b_p")) - 1
        before = F.least(F.col("a_p"), F.col("b_p")) if k == 1 else F.least(F.col("a_p0"), F.col("b_p0")) + F.least(F.col("a_p") - F.col("a_p0"), F.col("b_p") - F.col("b_p0")) - 1
        apart = F.bit_count(F.col("a_s0").bitwiseXOR(F.col("b_s0"))) + F.bit_count(F.col("a_s1").bitwiseXOR(F.col("b_s1")))
        return a.join(b, "key").where(
            distinct_sides & (n * t.denominator >= o * t.numerator) & (o * t.denominator >= n * t.numerator)
            & (rest + before + k >= overlap) & (apart <= n + o - 2 * at_least_pair)
        ).select(F.least("a_sid", "b_sid").alias("a"), F.greatest("a_sid", "b_sid").alias("b"))

    pairs = meet(subsets, subsets, 2, F.col("a_sid") < F.col("b_sid"))
    heavy = meet(lists.where(F.col("n") > split), lists, 1, (F.col("a_sid") < F.col("b_sid")) | ((F.col("a_sid") != F.col("b_sid")) & (F.col("b_n") <= split)))
    met = scratch.cut(pairs.unionByName(heavy).distinct(), n=F.count("*"))
    asked = met.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    whole = sets.select("sid", "words").join(small(asked, 2 * scratch.last["n"]), "sid", "left_semi")
    side = lambda c: whole.select(F.col("sid").alias(c), F.col("words").alias(f"w{c}"))
    both = met.join(side("a"), "a").join(side("b"), "b")
    common = F.size(F.array_intersect("wa", "wb"))
    return both.where(common * (t.numerator + t.denominator) >= (F.size("wa") + F.size("wb")) * t.numerator).select("a", "b")


def near_pairs(records: DataFrame, threshold: float = 0.8, scratch: Scratch | None = None, split: int | None = None) -> DataFrame:
    """records (id, words, c1, c2) -> pairs (q1_id, q2_id), q1_id < q2_id, similar but not copies.

    Records with equal (c1, c2) are copies of each other and aren't paired.  The scope is in the words' hashes.
    """
    scratch = scratch or Scratch(records.sparkSession)
    records = scratch.cut(records.where(F.size("words") > 0))
    keyed = records.select("id", "c1", "c2", F.xxhash64(F.lit(1), "words").alias("h1"), F.xxhash64(F.lit(2), "words").alias("h2"))
    sets = keyed.groupBy("h1", "h2").agg(F.min("id").alias("sid"), F.count("*").alias("members"))
    members = scratch.cut(keyed.join(sets, ["h1", "h2"]).select("id", "sid", "c1", "c2", "members"), spare=F.count_if(F.col("id") != F.col("sid")))
    spare = members.where("id <> sid").select("id")
    reps = records.join(small(spare, scratch.last["spare"]), "id", "left_anti").select(F.col("id").alias("sid"), "words")
    pairs = similar_sets(reps, threshold, scratch, split)
    units = members.select("sid", "c1", "c2").distinct()
    own = members.where("members > 1").select("sid", "c1", "c2").distinct().groupBy("sid").agg(F.count("*").alias("k")).where("k > 1")
    pairs = scratch.cut(pairs.unionByName(own.select(F.col("sid").alias("a"), F.col("sid").alias("b"))), n=F.count("*"))
    asked = small(pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct(), 2 * scratch.last["n"])
    units, members = units.join(asked, "sid", "left_semi"), members.join(asked, "sid", "left_semi")
    as_ = lambda df, c, *more: df.select(F.col("sid").alias(c), *[F.col(x).alias(f"{c}_{x}") for x in ("c1", "c2", *more)])
    u = pairs.join(as_(units, "a"), "a").join(as_(units, "b"), "b")
    u = u.where(~(F.col("a_c1").eqNullSafe(F.col("b_c1")) & F.col("a_c2").eqNullSafe(F.col("b_c2"))))
    u = u.where((F.col("a") != F.col("b")) | (F.struct("a_c1", "a_c2") < F.struct("b_c1", "b_c2")))
    full = u.join(as_(members, "a", "id"), ["a", "a_c1", "a_c2"]).join(as_(members, "b", "id"), ["b", "b_c1", "b_c2"])
    return full.select(F.least("a_id", "b_id").alias("q1_id"), F.greatest("a_id", "b_id").alias("q2_id"))
