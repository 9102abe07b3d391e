"""Near-duplicate candidates for review: blocking on rare words with edit-ratio scores, and a trigram join."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tamis.functions import canon
from tamis.functions.canon import STOPWORDS
from tamis.functions.text import hash128
from tamis.scratch import Scratch, small
from tamis.scratch import spread as spread_files


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bits of one large number."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for i, ch in enumerate(a):
        at[ch] = at.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & at.get(ch, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def ratio(a: str, b: str) -> float:
    """100 * 2 LCS / (|a| + |b|); 100 for two empty texts."""
    return 100.0 * 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def best_ratio(a: str, b: str) -> float:
    """The better of the plain ratio and that of the sorted words."""
    return max(ratio(a, b), ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))))


def options_score(a: list[str], b: list[str]) -> float:
    """Mean of the better ratios of the sorted options; 0 if their numbers differ."""
    if not len(a) or len(a) != len(b):
        return 0.0
    return sum(best_ratio(x, y) for x, y in zip(sorted(a), sorted(b))) / len(a)


def pair_scores(a_text: str, b_text: str, a_opts: list[str], b_opts: list[str]) -> tuple[float, float]:
    return best_ratio(a_text, b_text), options_score(a_opts, b_opts)


def bound(a: str, b: str) -> float:
    """At least the ratio of the texts and of their sorted words: as if all characters in common stood in order."""
    return 100.0 * 2 * sum((Counter(a) & Counter(b)).values()) / (len(a) + len(b)) if a or b else 100.0


BINS = 64


def _characters(texts: list[str]) -> np.ndarray:
    """Counts of each text's characters in BINS classes."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    return np.bincount(row * BINS + codes % BINS, minlength=BINS * len(texts)).reshape(-1, BINS).astype(np.uint16 if max(map(len, texts), default=0) < 1 << 16 else np.uint32)


def _bounds(counts: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """At least the characters that texts i and j have in common, from their counts."""
    return np.minimum(counts[i], counts[j]).sum(1, dtype=np.int64)


def _sorted_words(t: str) -> str:
    return " ".join(sorted(t.split()))


class _Postings:
    """Rows (chapter_id, w, id, identity, text, opts) in order of chapter_id, w and id; every pair of a posting is scored where it stands."""

    STEP = 100_000

    def __init__(self, pdf: pd.DataFrame, min_stem: float, min_options: float):
        self.pdf, self.min_stem, self.min_options = pdf, min_stem, min_options
        self.id, self.key = pdf["id"].to_numpy(), pd.factorize(pdf["identity"])[0]
        self.text, self.opts = pdf["text"].tolist(), [sorted(o) for o in pdf["opts"]]
        self.n, self.k = np.array([len(t) for t in self.text]), np.array([len(o) for o in self.opts])
        self.at = np.cumsum(self.k) - self.k
        flat = [x for o in self.opts for x in o]
        self.counts, self.opt_counts, self.opt_n = _characters(self.text), _characters(flat), np.array([len(x) for x in flat])
        self.text_words, self.opt_words = [*map(_sorted_words, self.text)], [*map(_sorted_words, flat)]
        self.flat = flat

    def near(self, ends: np.ndarray) -> pd.DataFrame:
        """``ends``: for each row, the place after the last row of its posting."""
        follow, parts = ends - 1 - np.arange(len(ends)), []
        total = np.cumsum(follow)
        a = 0
        while a < len(ends):
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + self.STEP, "right")))
            i = np.repeat(np.arange(a, b), follow[a:b])
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(follow[a:b]) - follow[a:b], follow[a:b])
            parts += self._scored(i, j)
            a = b
        chapter = self.pdf["chapter_id"].to_numpy()
        got = np.array([(i, j) for i, j, _, _ in parts], np.int64).reshape(-1, 2)
        return pd.DataFrame({
            "chapter_id": chapter[got[:, 0]], "q1_id": self.id[got[:, 0]], "q2_id": self.id[got[:, 1]],
            "stem_score": np.array([x[2] for x in parts], float), "options_score": np.array([x[3] for x in parts], float),
        })

    def _scored(self, i: np.ndarray, j: np.ndarray) -> list[tuple[int, int, float, float]]:
        n, out = self.n, []
        fits = (self.id[i] < self.id[j]) & (self.k[i] == self.k[j]) & (self.key[i] != self.key[j]) & (200 * np.minimum(n[i], n[j]) >= self.min_stem * (n[i] + n[j]))
        i, j = i[fits], j[fits]
        fits = 200 * _bounds(self.counts, i, j) >= self.min_stem * (n[i] + n[j]) - 1e-6
        i, j = i[fits], j[fits]
        for k in np.unique(self.k[i]):
            x, y = (e[self.k[i] == k] for e in (i, j))
            most = np.empty((len(x), k))
            for o in range(k):
                u, v = self.at[x] + o, self.at[y] + o
                length = self.opt_n[u] + self.opt_n[v]
                most[:, o] = np.where(length > 0, 200.0 * _bounds(self.opt_counts, u, v) / np.maximum(length, 1), 100.0)
            fits = most.sum(1) >= self.min_options * k - 1e-6
            for p, q, m in zip(x[fits].tolist(), y[fits].tolist(), most[fits].tolist()):
                # options are short, so they are compared first and the texts only where they pass
                if (score := self._options(p, q, m)) >= self.min_options:
                    stem = max(ratio(self.text[p], self.text[q]), ratio(self.text_words[p], self.text_words[q]))
                    if stem >= self.min_stem:
                        out.append((p, q, stem, score))
        return out

    def _options(self, p: int, q: int, most: list[float]) -> float:
        """options_score, or -1 as soon as the bounds of the options left can't bring it to the least."""
        u, v, left, least = self.at[p], self.at[q], sum(most), self.min_options * len(most) - 1e-6
        exact = []
        for o, bound_ in enumerate(most):
            s = max(ratio(self.flat[u + o], self.flat[v + o]), ratio(self.opt_words[u + o], self.opt_words[v + o]))
            exact.append(s)
            left += s - bound_
            if left < least:
                return -1.0
        return sum(exact) / len(exact)


def _score(min_stem: float, min_options: float):
    """Scores postings that stand together; at most a batch and a posting are held."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def scored(pdf: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
            ends = np.repeat(np.append(starts[1:], len(pdf)), np.diff(np.append(starts, len(pdf))))
            return _Postings(pdf, min_stem, min_options).near(ends)

        rest = None
        for pdf in batches:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            starts = np.flatnonzero(((pdf["chapter_id"] != pdf["chapter_id"].shift()) | (pdf["w"] != pdf["w"].shift())).to_numpy())
            if len(starts) < 2:
                rest = pdf
                continue
            rest = pdf.iloc[starts[-1] :].reset_index(drop=True)
            yield scored(pdf.iloc[: starts[-1]].reset_index(drop=True), starts[:-1])
        if rest is not None and len(rest):
            yield scored(rest, np.array([0]))

    return run


def spread(df: DataFrame) -> int:
    """Tasks for steps whose rows are small and costly."""
    spark = df.sparkSession
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def words_of(text) -> object:
    """Words of letters and digits, lower case, one space between."""
    return F.array_join(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)), " ")


def candidates(q: DataFrame, min_stem: float = 80, min_options: float = 65, rare: int = 8, posting: int = 1000, kept: int = 50) -> DataFrame:
    """q (chapter_id, id, identity, question_text, options) -> (chapter_id, q1_id, q2_id, stem_score, options_score).

    Pairs share one of the ``rare`` rarest words of both, in postings of at most ``posting`` (the operator's own
    bounds, part of its meaning), have different identities, and stand among the best ``kept`` of either side.
    """
    norm = q.select("chapter_id", "id", "identity", words_of(F.col("question_text")).alias("text"), F.transform(F.coalesce("options", F.array().cast("array<string>")), words_of).alias("opts"))
    tokens = norm.select("chapter_id", "id", F.explode(F.array_distinct(F.split("text", " "))).alias("w")).where((F.length("w") > 2) & ~F.col("w").isin(STOPWORDS))
    df = tokens.groupBy("chapter_id", "w").agg(F.count("*").alias("df"))
    first = F.row_number().over(Window.partitionBy("chapter_id", "id").orderBy("df", "w"))
    # a word that stands in one question has its rank but makes no pair
    block = tokens.join(df, ["chapter_id", "w"]).withColumn("r", first).where((F.col("r") <= rare) & (F.col("df") > 1) & (F.col("df") <= posting)).select("chapter_id", "w", "id")
    full = block.join(norm.where(F.size("opts") > 0), ["chapter_id", "id"]).select("chapter_id", "w", "id", "identity", "text", "opts")
    schema = "chapter_id bigint, q1_id bigint, q2_id bigint, stem_score double, options_score double"
    # few bytes but much work: not to be merged into few tasks.  Pairs are made and judged there, so only those that pass move on
    postings = full.repartition(spread(q), "chapter_id", "w").sortWithinPartitions("chapter_id", "w", "id")
    scored = postings.mapInPandas(_score(min_stem, min_options), schema).distinct()
    best = F.row_number().over(Window.partitionBy("side").orderBy(F.desc(F.col("stem_score") + F.col("options_score")), F.desc("stem_score"), "q1_id", "q2_id"))
    ranked = scored.withColumn("side", F.explode(F.array("q1_id", "q2_id"))).withColumn("r", best).where(F.col("r") <= kept)
    return ranked.select("chapter_id", "q1_id", "q2_id", F.round("stem_score", 2).alias("stem_score"), F.round("options_score", 2).alias("options_score")).distinct()


_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the 64-bit numbers depends on all of the given ones."""
    x = x + _MIX[0]
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def _classes(most: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least size, largest size, parts) of the classes of sizes up to the one after ``most``'s.

    A set's partners, by size alone, are in its own class or the next one.  Parts are one more than the elements in which a pair
    of the class can differ.
    """
    reach = lambda n: max(n, int(n / threshold + 1e-6))
    low, high = [1], [reach(reach(1))]
    while low[-1] <= most:
        low.append(high[-1] + 1)
        high.append(reach(reach(low[-1])))
    return np.array(low), np.array(high), np.array([int(2 * h * (1 - threshold) / (1 + threshold) + 1e-6) + 1 for h in high])


def _parts(threshold: float):
    """(id, g) -> (w, id, n, own, s1, s2): a row for each part of each set, as a member of its own class and as a guest of the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            if not len(ids):
                continue
            n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            g = _mixed(lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            row = np.repeat(np.arange(len(n)), n)
            # two of these sketches differ in no more bits than their sets in elements
            bit = (g & np.uint64(127)).astype(np.int64)
            odd = (np.bincount(row * 128 + bit, minlength=128 * len(n)) & 1).astype(np.uint8).reshape(-1, 128)
            sketch = np.packbits(odd, axis=1).view(np.int64)
            low, high, parts = _classes(int(n.max()), threshold)
            own = np.searchsorted(low, n, "right") - 1
            for up in (0, 1):
                takes = (n / threshold + 1e-6 >= low[own + 1]) if up else np.ones(len(n), bool)
                c = own[takes] + up
                m = parts[c]
                start = np.concatenate(([0], np.cumsum(m)))
                base = np.full(len(n), -1, np.int64)
                base[takes] = start[:-1]
                inside = takes[row]
                at = base[row[inside]] + ((g[inside] >> np.uint64(7)) % np.repeat(m, n[takes]).astype(np.uint64)).astype(np.int64)
                sums = np.zeros(start[-1], np.uint64)
                np.add.at(sums, at, _mixed(g[inside]))
                which = np.arange(start[-1]) - np.repeat(start[:-1], m)
                w = _mixed(sums ^ _mixed((np.repeat(c, m) << 32 | which).astype(np.uint64)))
                of = np.repeat(np.flatnonzero(takes), m)
                for k in range(0, len(w), 50_000):
                    r = of[k : k + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(w[k : k + 50_000].view(np.int64)), pa.array(ids[r]), pa.array(n[r].astype(np.int32)), pa.array(np.full(len(r), not up)), pa.array(sketch[r, 0]), pa.array(sketch[r, 1])],
                        ["w", "id", "n", "own", "s1", "s2"],
                    )

    return run


def trigram_pairs(df: DataFrame, key: str, text: str, threshold: float = 0.9) -> DataFrame:
    """Pairs (a, b, similarity), a < b, of trigram similarity >= threshold, by an exact filter.

    Sets are cut into parts by a hash of the trigram, one part more than a pair of their class of sizes can have trigrams
    that differ, so similar sets agree in a whole part and meet on it.  Each row has the parities of the set's trigrams in
    128 bins, which drop nearly all other pairs inside the join.  Texts of the same words are one set until the end.
    """
    scratch = Scratch(df.sparkSession)
    q = df.select(F.col(key).alias("id"), F.col(text).alias("text")).where("id IS NOT NULL")
    words = scratch.cut(q.select("id", words_of(F.col("text")).alias("words")).where("words <> ''").select("id", *hash128("words")))
    first = words.groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("n")).where("n > 1").select("h1", "h2", "rep")
    copies = scratch.cut(words.join(first, ["h1", "h2"]).select("rep", "id"), n=F.count("*"))
    known = scratch.last["n"]
    sets = spread_files(q).join(small(copies.where("id <> rep").select("id"), known), "id", "left_anti")
    sets = sets.select("id", F.transform(canon.trigrams(F.col("text")), lambda g: F.xxhash64(g)).alias("g")).where(F.size("g") > 0)
    parts = sets.mapInArrow(_parts(threshold), "w bigint, id bigint, n int, own boolean, s1 bigint, s2 bigint")
    side = lambda c: parts.select("w", *[F.col(x).alias(f"{x}{c}") for x in ("id", "n", "own", "s1", "s2")])
    na, nb = F.col("na"), F.col("nb")
    differ = F.bit_count(F.col("s1a").bitwiseXOR(F.col("s1b"))) + F.bit_count(F.col("s2a").bitwiseXOR(F.col("s2b")))
    fits = (F.col("ida") < F.col("idb")) & (F.col("owna") | F.col("ownb")) & (na >= threshold * nb - 1e-9) & (nb >= threshold * na - 1e-9)
    met = side("a").hint("merge").join(side("b"), "w").where(fits & (differ <= (na + nb) * ((1 - threshold) / (1 + threshold)) + 1e-6))
    met = scratch.cut(met.select(F.col("ida").alias("a"), F.col("idb").alias("b")).distinct(), n=F.count("*"))
    texts = only(q, met, 2 * scratch.last["n"], "a", "b")
    whole = lambda c: texts.select(F.col("id").alias(c), F.transform(canon.trigrams(F.col("text")), lambda g: F.xxhash64(g)).alias(f"g{c}"))
    sim = canon.set_similarity(F.col("ga"), F.col("gb"))
    near = met.join(whole("a"), "a").join(whole("b"), "b").select("a", "b", sim.alias("similarity")).where(F.col("similarity") >= threshold - 1e-12)
    of = lambda c: small(copies.select(F.col("rep").alias(c), F.col("id").alias(f"{c}_id")), known)
    a, b = F.coalesce("a_id", "a"), F.coalesce("b_id", "b")
    spelt = near.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), "similarity")
    same = copies.select("rep", F.col("id").alias("a")).join(copies.select("rep", F.col("id").alias("b")), "rep").where("a < b")
    return spelt.unionByName(same.select("a", "b", F.lit(1.0).alias("similarity")))


def only(q: DataFrame, pairs: DataFrame, rows: int, *ends: str) -> DataFrame:
    """The rows of q that a pair names, so that no others move; ``rows`` is the most ids that the pairs hold."""
    ids = pairs.select(F.explode(F.array(*ends)).alias("id")).distinct()
    return q.join(small(ids, rows), "id", "left_semi")


def answer_status(a: Column, b: Column) -> Column:
    """Of two answer texts: none if one is missing, same but for case and punctuation, or CONFLICT."""
    key = lambda c: F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}]+", " "))
    missing = (F.coalesce(a, F.lit("")) == "") | (F.coalesce(b, F.lit("")) == "")
    return F.when(missing, "none").when(key(a) == key(b), "same").otherwise("CONFLICT")


def near_duplicates(q: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Pairs a < b of like text and like options, both by trigrams, with every column of both as ``a_`` and ``b_``.

    q: (id, question_text, options, correct_text, ...).  Adds q_sim, opt_sim and the status of the two answers.  Questions
    without words in their options are like none.
    """
    side = lambda s: q.select(F.col("id").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in q.columns if c != "id"])
    scratch = Scratch(q.sparkSession)
    pair = scratch.cut(trigram_pairs(q.select("id", "question_text"), "id", "question_text", threshold).withColumnRenamed("similarity", "q_sim"), n=F.count("*"))
    q = only(q, pair, 2 * scratch.last["n"], "a", "b")
    both = pair.join(side("a"), "a").join(side("b"), "b")
    opts = lambda s: canon.trigrams(F.array_join(f"{s}_options", " "))
    both = both.withColumn("opt_sim", canon.set_similarity(opts("a"), opts("b"))).where(F.col("opt_sim") >= threshold - 1e-12)
    return both.withColumn("answer", answer_status(F.col("a_correct_text"), F.col("b_correct_text")))
