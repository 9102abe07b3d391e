"""Items packed into containers of fixed capacity by a grouping genetic algorithm on islands.

Items longer than the capacity are split: whole containers first, the rest is an item.  The others are spread by hash
over blocks of about MAX_ITEMS items or BINS containers' worth of tokens, so a block is bounded however large or uneven
the table is, and the same on any cluster.  A block is first filled by best fit, largest first.  Where that needs more
containers than the tokens do, the block is searched on ISLANDS islands, each a row of its own that any task can take:
an island evolves a small population, and between epochs its best solution also moves to the next island (a ring).
Blocks leave as soon as a solution meets the bound.

Well-filled containers of a block are final.  The poorly filled ones, at most a quarter, are opened again and their items
packed together with those of the other blocks in a further round, with fewer blocks each time; the last round is one block.

A solution is a grouping of items into containers.  Crossover injects well-filled containers of one parent into the
other, removes the other's containers that hold injected items, and places the displaced items by best fit, largest
first.  Fitness is the mean squared fill.

NULL and empty texts have no tokens; they lie in some container with others and fill nothing.  Repeated rows are items
of their own.  An empty table gives an empty result.  Every item is in exactly one container.
"""

from __future__ import annotations

import random
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tamis.scratch import Scratch

MAX_ITEMS, BINS, ISLANDS, EPOCHS, POPULATION, OFFSPRING = 2048, 192, 3, 4, 6, 16
#: Containers filled less than this are opened again while there are other blocks.
WELL_FILLED = 0.99
#: Copies of one row made by one task at a time.
COPIES = 10_000
ITEM = "pack_id int, capacity int, block bigint, doc_id bigint, piece int, copy bigint, tokens int, bin int, bins int, fill double, passed boolean"

Bins = list[list[int]]


def best_fit(items: list[int], sizes: list[int], bins: Bins, capacity: int) -> Bins:
    """The items, largest first, each into the fullest container that still takes it; new ones as needed."""
    left = sorted((capacity - sum(sizes[i] for i in b), k) for k, b in enumerate(bins))
    for i in sorted(items, key=lambda i: -sizes[i]):
        at = bisect_left(left, (sizes[i], -1))
        if at == len(left):
            bins.append([i])
            insort(left, (capacity - sizes[i], len(bins) - 1))
        else:
            room, k = left.pop(at)
            bins[k].append(i)
            insort(left, (room - sizes[i], k))
    return bins


def least_bins(sizes: list[int], capacity: int) -> int:
    """Containers that the tokens need at least; one for items without tokens."""
    return max(1, -(-sum(sizes) // capacity))


def fitness(bins: Bins, sizes: list[int], capacity: int) -> float:
    return sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / len(bins) if bins else 0.0


def crossover(one: Bins, other: Bins, sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """Well-filled containers of ``other`` injected into ``one``."""
    full = sorted(other, key=lambda b: -sum(sizes[i] for i in b))
    top = full[: max(1, len(full) * 2 // 3)]
    given = [list(b) for b in rng.sample(top, max(1, len(top) // 2))]
    inside = {i for b in given for i in b}
    kept, displaced = given, []
    for b in one:
        if any(i in inside for i in b):
            displaced += [i for i in b if i not in inside]
        else:
            kept.append(list(b))
    return best_fit(displaced, sizes, kept, capacity)


def laid_at_random(sizes: list[int], capacity: int, rng: random.Random) -> Bins:
    """Half of the items as they come, the rest by best fit, so that parents differ."""
    order = rng.sample(range(len(sizes)), len(sizes))
    half, room, bins = len(order) // 2, 0, []
    for i in order[:half]:
        if not bins or sizes[i] > room:
            bins.append([])
            room = capacity
        bins[-1].append(i)
        room -= sizes[i]
    return best_fit(order[half:], sizes, bins, capacity)


def evolve(sizes: list[int], capacity: int, seeds: list[Bins], rng: random.Random, offspring: int = OFFSPRING) -> Bins:
    """Best solution of one epoch from the given solutions and random ones; no search where the bound is met."""
    floor = least_bins(sizes, capacity)
    people = [*seeds] or [best_fit([*range(len(sizes))], sizes, [], capacity)]
    for p in people:
        if len(p) <= floor:
            return p
    while len(people) < POPULATION:
        people.append(laid_at_random(sizes, capacity, rng))
    ranked = sorted(((-len(p), fitness(p, sizes, capacity), k, p) for k, p in enumerate(people)), reverse=True)
    for k in range(offspring):
        if len(ranked[0][3]) <= floor:
            break
        a, b = rng.sample(ranked, 2)
        child = crossover(a[3], b[3], sizes, capacity, rng)
        ranked = sorted([*ranked, (-len(child), fitness(child, sizes, capacity), POPULATION + k, child)], reverse=True)[:POPULATION]
    return ranked[0][3]


def _genes(bins: Bins, n: int) -> np.ndarray:
    out = np.zeros(n, np.int32)
    for k, b in enumerate(bins):
        out[b] = k
    return out


def _bins(genes: np.ndarray) -> Bins:
    out: Bins = [[] for _ in range(int(genes.max(initial=-1)) + 1)]
    for i, k in enumerate(genes):
        out[k].append(i)
    return out


def reopened(fill: np.ndarray) -> np.ndarray:
    """Which containers of a block are opened again: the poorly filled ones, at most a quarter of all."""
    out = fill < WELL_FILLED
    out[np.argsort(fill, kind="stable")[max(1, len(fill) // 4) :]] = False
    return out


def _placed(pdf: pd.DataFrame, genes: np.ndarray, several: bool) -> pd.DataFrame:
    fill = np.bincount(genes, weights=pdf["tokens"]) / pdf["capacity"].iloc[0]
    passed = reopened(fill) if several else np.zeros(len(fill), bool)
    return pdf.assign(bin=genes, bins=len(fill), fill=fill[genes], passed=passed[genes])


def _first(blocks: dict[int, int]):
    """Best fit of one block, as rows with their container."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece", "copy", "tokens"], kind="stable")
        sizes = pdf["tokens"].tolist()
        bins = best_fit([*range(len(sizes))], sizes, [], int(pdf["capacity"].iloc[0]))
        return _placed(pdf, _genes(bins, len(sizes)), blocks[int(key[0])] > 1)

    return run


def _epoch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(block, island, epoch, tokens, elites) -> the island's best as (pack_id, block, island, genes, bins, score)."""
    for pdf in batches:
        for row in pdf.itertuples():
            sizes = [int(x) for x in row.tokens]
            rng = random.Random(f"{row.pack_id}/{row.block}/{row.island}/{row.epoch}")
            best = evolve(sizes, row.capacity, [_bins(np.asarray(g)) for g in row.elites], rng)
            yield pd.DataFrame({"pack_id": [row.pack_id], "block": [row.block], "island": [row.island], "genes": [_genes(best, len(sizes))], "bins": [len(best)], "score": [fitness(best, sizes, row.capacity)]})


def _unpack(blocks: dict[int, int]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for row in pdf.itertuples():
                rows = pd.DataFrame([r.asDict() if hasattr(r, "asDict") else r for r in row.items])
                yield _placed(rows, np.asarray(row.genes), blocks[int(row.pack_id)] > 1)

    return run


def search(open_rows: DataFrame, scratch: Scratch, blocks: dict[int, int], n: int) -> DataFrame:
    """The rows of blocks whose best fit misses the bound, placed by the islands' best solution."""
    cols = ["pack_id", "capacity", "block", "doc_id", "piece", "copy", "tokens"]
    item = F.struct(*[c for c in ("doc_id", "piece", "copy", "tokens", "pack_id", "capacity", "block", "bin")])
    block = scratch.cut(open_rows.groupBy("pack_id", "capacity", "block").agg(F.array_sort(F.collect_list(item)).alias("items")))
    tasks = min(10_000, max(1, n * ISLANDS))  # few islands a task: they are costly for their bytes
    start = F.array(F.col("items.bin"))
    at = block.select("pack_id", "capacity", "block", F.col("items.tokens").alias("tokens"), start.alias("elites"))
    state = at.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    best = None
    for epoch in range(EPOCHS):
        task = state.withColumn("epoch", F.lit(epoch)).repartition(tasks, "pack_id", "block", "island")
        bound = F.ceil(F.aggregate("tokens", F.lit(0).cast("bigint"), lambda a, x: a + x) / F.col("capacity"))
        got = scratch.cut(task.mapInPandas(_epoch, "pack_id int, block bigint, island int, genes array<int>, bins int, score double"))
        best = got if best is None else best.unionByName(got)
        # the best of an island and of the one before it seed its next epoch; solved blocks are left out
        done = got.groupBy("pack_id", "block").agg(F.min("bins").alias("least"))
        moved = got.select("pack_id", "block", F.explode(F.array("island", (F.col("island") + 1) % ISLANDS)).alias("island"), "genes")
        moved = moved.groupBy("pack_id", "block", "island").agg(F.collect_list("genes").alias("elites"))  # two at most
        state = scratch.cut(at.drop("elites").join(moved, ["pack_id", "block"]).join(done, ["pack_id", "block"]).where(F.col("least") > bound).drop("least"), n=F.count("*"))
        if not scratch.last["n"]:
            break
    won = best.groupBy("pack_id", "block").agg(F.max_by("genes", F.struct(-F.col("bins"), "score", -F.col("island"))).alias("genes"))
    return block.join(won, ["pack_id", "block"]).select("pack_id", "block", "items", "genes").repartition(tasks, "pack_id", "block").mapInPandas(_unpack(blocks), ITEM)


def pack(docs: DataFrame, sizes: DataFrame, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """docs (doc_id, tokens), sizes (pack_id, capacity) -> two tables:

    (pack_id, doc_id, piece, container, tokens, fill): ``fill`` is the used share of the row's container;
    (pack_id, capacity, tokens, bound, best_fit, containers, searched, fill): what best fit alone over the blocks needs,
    what is needed in the end, and how many blocks were searched.  ``sizes`` is a configuration of at most 100 rows.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    wanted = [tuple(r) for r in sizes.select("pack_id", "capacity").where("capacity > 0 AND pack_id IS NOT NULL").distinct().limit(101).collect()]
    if len(wanted) > 100:
        raise ValueError("more than 100 container sizes")
    if len({p for p, _ in wanted}) < len(wanted):
        raise ValueError("a pack_id has two capacities")
    # equal rows are counted and numbered, a stretch at a time, so that no group of them is one task's array
    equal = docs.select("doc_id", F.coalesce("tokens", F.lit(0)).cast("int").alias("size")).groupBy("doc_id", "size").agg(F.count("*").alias("n"))
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("n") - 1), F.lit(COPIES).cast("bigint"))).alias("from")
    copy = F.explode(F.sequence(F.col("from"), F.least(F.col("from") + COPIES, F.col("n")) - 1)).alias("copy")
    docs = scratch.cut(equal.select("doc_id", "size", "n", start).select("doc_id", "size", copy))
    caps = F.array(*[F.struct(F.lit(p).cast("int").alias("pack_id"), F.lit(c).cast("int").alias("capacity")) for p, c in wanted]) if wanted else F.array().cast("array<struct<pack_id:int,capacity:int>>")
    each = docs.select("doc_id", "copy", "size", F.inline(caps))
    whole = F.floor(F.col("size") / F.col("capacity")).cast("int")
    rest = (F.col("size") % F.col("capacity")).cast("int")
    name = F.concat_ws("-", F.concat(F.lit("w"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), F.col("copy").cast("string"), F.col("piece").cast("string"))
    full = each.where(whole > 0).select("pack_id", "doc_id", "capacity", "copy", F.explode(F.sequence(F.lit(1), whole)).alias("piece"))
    full = full.select("pack_id", "doc_id", "piece", name.alias("container"), F.col("capacity").cast("bigint").alias("tokens"), F.lit(1.0).alias("fill"))
    todo = each.where((rest > 0) | (whole == 0)).select("pack_id", "capacity", "doc_id", F.when(whole == 0, 0).otherwise(whole + 1).alias("piece"), "copy", rest.alias("tokens"))
    parts, first, searched, level = [full], None, [], 0
    while True:
        counts = todo.groupBy("pack_id").agg(F.count("*").alias("n"), F.sum("tokens").alias("t"), F.max("capacity").alias("c")).collect()  # a row per capacity
        if not counts:
            break
        blocks = {r["pack_id"]: max(1, -(-r["n"] // MAX_ITEMS), -(-r["t"] // (BINS * r["c"]))) for r in counts}
        of_pack = F.element_at(F.create_map(*[F.lit(x) for p, b in blocks.items() for x in (p, b)]), F.col("pack_id")).cast("bigint")
        spread = todo.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "copy", F.lit(level)), of_pack))
        placed = scratch.cut(spread.groupBy("pack_id", "block").applyInPandas(_first(blocks), ITEM))
        need = placed.groupBy("pack_id", "block").agg(F.max("bins").alias("bins"), F.greatest(F.lit(1), F.ceil(F.sum("tokens") / F.max("capacity"))).alias("least"))
        need = scratch.cut(need.withColumn("open", F.col("bins") > F.col("least")), n=F.count_if("open"))
        first = need if first is None else first
        searched.append(need.groupBy("pack_id").agg(F.count_if("open").alias("open")))
        if scratch.last["n"]:
            opened = need.where("open").select("pack_id", "block")
            found = search(placed.join(opened, ["pack_id", "block"], "left_semi"), scratch, blocks, scratch.last["n"])
            placed = scratch.cut(placed.join(opened, ["pack_id", "block"], "left_anti").unionByName(found))
        container = F.concat_ws("-", F.lit(level).cast("string"), F.col("block").cast("string"), F.col("bin").cast("string"))
        parts.append(placed.where("NOT passed").select("pack_id", "doc_id", "piece", container.alias("container"), F.col("tokens").cast("bigint").alias("tokens"), "fill"))
        todo, level = placed.where("passed").select("pack_id", "capacity", "doc_id", "piece", "copy", "tokens"), level + 1
        if max(blocks.values()) == 1:
            break
    out = reduce(DataFrame.unionByName, parts)
    used = out.groupBy("pack_id", "container").agg(F.sum("tokens").alias("t")).groupBy("pack_id").agg(F.count("*").alias("containers"), F.sum("t").alias("tokens"))
    plain = full.groupBy("pack_id").agg(F.count("*").alias("b"))
    if first is not None:
        plain = plain.unionByName(first.groupBy("pack_id").agg(F.sum("bins").alias("b")))
        tried = reduce(DataFrame.unionByName, searched).groupBy("pack_id").agg(F.sum("open").alias("searched"))
    else:
        tried = plain.select("pack_id", F.lit(0).cast("bigint").alias("searched")).distinct()
    report = used.join(plain.groupBy("pack_id").agg(F.sum("b").alias("best_fit")), "pack_id").join(tried, "pack_id", "left").join(spark.createDataFrame(wanted, "pack_id int, capacity int"), "pack_id")
    return out, report.select(
        "pack_id", "capacity", "tokens", F.ceil(F.col("tokens") / F.col("capacity")).alias("bound"), "best_fit", "containers",
        F.coalesce("searched", F.lit(0)).alias("searched"), (F.col("tokens") / (F.col("containers") * F.col("capacity"))).alias("fill"),
    )
