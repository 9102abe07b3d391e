import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamis.llm import abuse, components, formatting, lookalikes, mixing, packing, simjoin, survivors, tokens
from tamis.scratch import Scratch


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# ------------------------------------------------------------- components


def brute_groups(pairs):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in up}


@pytest.mark.parametrize("pairs", [
    [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], [(3, 3), (None, 4), (5, None), (7, 6), (6, 7), (7, 6)], [(None, None)],
    [(random.Random(i).randrange(60), random.Random(i + 999).randrange(60)) for i in range(40)],
])
def test_groups(spark, pairs):
    df = spark.createDataFrame([(*p, "x") for p in pairs], "a bigint, b bigint, v string")
    assert {tuple(r) for r in components.groups(df, "a", "b").collect()} == brute_groups(pairs)


# ------------------------------------------------------------- formatting


def test_copies(spark):
    q = [(1, 1, "Q3. The value, is 3.5 kN", ["A-b", "c"]), (2, 1, "the VALUE is 3.5 kn!", ["C", "ab"]), (3, 1, "the value is 35 kn", ["c", "ab"]), (4, 2, "the value is 3.5 kn", ["c", "ab"]),
         (5, 1, None, None), (6, 1, "", []), (7, 1, "x -5", [None]), (8, 1, "x 5", [""]), (9, 1, "3.5 kN", None), (10, 1, "kN", None)]
    df = spark.createDataFrame(q, "id bigint, scope bigint, question_text string, options array<string>")
    got = {r["first_id"]: r["copies"] for r in formatting.copies(df, "scope").collect()}
    assert got == {1: 2, 3: 1, 4: 1, 5: 2, 7: 1, 8: 1, 9: 1, 10: 1}
    assert formatting.copies(df.limit(0), "scope").count() == 0


# ------------------------------------------------------------- look-alikes


def test_character_form():
    assert lookalikes.character_form("Ｃａｆｅ́​ ﬁx K m² – ‘a’…") == "Café fix K m² – ‘a’…"
    assert lookalikes.character_form("​ \t") == ""


def test_candidates():
    assert lookalikes.candidates("mаin") == [("mаin", "main")]
    assert lookalikes.candidates("это слово") == []
    assert dict(lookalikes.candidates("the сор is"))["сор"] == "cop"


def test_disguised_pairs(spark):
    t = [(1, 1, "the mаin  beam"), (2, 1, "the main beam"), (3, 1, "the  main\nbeam "), (4, 2, "the mаin beam"), (5, 1, "the mаin beam²"), (6, 1, "the main beam2"), (7, 1, None), (8, 1, "​"), (9, 1, ""),
         (10, 1, "Zеlu"), (11, 1, "Zelu‍"), (12, 1, "Zelu" * 5000)]
    df = spark.createDataFrame(t, "key bigint, scope bigint, text string").withColumns({"part": F.lit(0), "stored": F.col("text")})
    shown = lookalikes.one_form(df)
    assert rows(lookalikes.disguised_pairs(shown, "scope")) == [(1, 2), (1, 3), (10, 11)]
    assert shown.count() == len(t)


# ------------------------------------------------------------- similarity join


def record_frame(spark, texts):
    df = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(texts)], "id bigint, scope bigint, t string")
    return df.select("id", simjoin.words(F.col("t"), F.col("scope")).alias("words"), F.xxhash64("t").alias("c1"), F.xxhash64("t").alias("c2"))


@pytest.mark.parametrize("split", [None, 0, 8, 10_000])
@pytest.mark.parametrize("t", [0.7, 0.8])
def test_near_pairs_against_all_pairs(spark, split, t):
    rng = random.Random(7)
    base = [[f"w{rng.randrange(40)}" for _ in range(rng.choice([1, 2, 3, 8, 14]))] for _ in range(60)]
    texts = [(rng.randrange(2), " ".join(w)) for w in base]
    for w in base[:40]:
        v = list(w)
        v[rng.randrange(len(v))] = f"w{rng.randrange(50)}"
        rng.shuffle(v)
        texts.append((rng.randrange(2), " ".join(v)))
    texts += [texts[0]] * 5 + [(0, ""), (1, None), (0, "?!")] + [(1, "Same, set of words"), (1, "set of same words")]
    sets = [{"".join(c for c in w if c.isalnum()).lower() for w in (x or "").split()} - {""} for _, x in texts]
    want = {(a, b) for a, b in combinations(range(len(texts)), 2) if texts[a][0] == texts[b][0] and sets[a] and sets[b] and texts[a][1] != texts[b][1] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t}
    got = simjoin.near_pairs(record_frame(spark, texts), t, split=split).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_boundary_takes_the_cheaper_side():
    assert simjoin.boundary([(5, 1, 100), (50, 10_000, 100)]) == 5
    assert simjoin.boundary([]) == 0


# ------------------------------------------------------------- survivors


def test_survivors(spark):
    m = [(1, 1, "s", None, 5.0, "why", "-"), (1, 2, "t", "2024-01-02 00:00:00", None, None, "B"), (1, 3, None, "2024-01-01 00:00:00", 9.0, "because", None), (4, 4, None, None, None, None, None), (4, 5, "s", None, None, "", "​")]
    df = spark.createDataFrame(m, "group_id bigint, id bigint, source string, at string, quality_score double, explanation string, correct_text string")
    df = df.withColumn("corrected_at", F.to_timestamp("at")).select("group_id", "id", "source", survivors.rank_key().alias("rank"), "explanation", "correct_text")
    judged = survivors.judge(df, ["explanation", "correct_text"], Scratch(spark))
    assert rows(survivors.survivors(df, judged, ["explanation", "correct_text"]).drop("explanation_first", "correct_text_first")) == [(1, 2, 3, 2), (4, 4, -1, -1)]
    assert rows(survivors.survivors(df.limit(0), survivors.judge(df.limit(0), ["explanation"], Scratch(spark)), ["explanation"])) == []


def test_model_tells_good_sources_from_bad(spark):
    rng, said = random.Random(1), []
    for g in range(60):
        said += [(g, "f", 1, s) for s in ("good1", "good2", "good3") if rng.random() < 0.95]
        said += [(g, "f", 100 + rng.randrange(50), "bad")]
    claims = spark.createDataFrame(said, "group_id bigint, field string, value bigint, source string").withColumn("first", F.struct(F.lit(1).alias("id")))
    p = {(r["group_id"], r["value"]): 1 / (1 + np.exp(-r["odds"])) for r in survivors.infer(claims, Scratch(spark)).collect()}
    right = [v for (g, x), v in p.items() if x == 1]
    wrong = [v for (g, x), v in p.items() if x != 1]
    assert np.mean(right) > 0.9 > 0.3 > np.mean(wrong)


def test_many_sources_of_different_values(spark):
    said = [(1, "f", i, f"s{i}") for i in range(1500)]
    claims = spark.createDataFrame(said, "group_id bigint, field string, value bigint, source string").withColumn("first", F.struct(F.col("value").alias("id")))
    judged = survivors.infer(claims, Scratch(spark))
    assert judged.where("odds >= 0").count() == 1500
    members = claims.select("group_id", F.struct(F.col("value").alias("id")).alias("rank"))
    assert rows(survivors.survivors(members, judged, ["f"])) == [(1, 0, 0, 0)]
    none = judged.withColumn("odds", F.lit(-1e9))
    assert rows(survivors.survivors(members, none, ["f"])) == [(1, 0, 0, 0)]
    late = judged.withColumn("odds", F.when(F.col("value") > 7, 1.0).otherwise(-1.0))
    assert rows(survivors.survivors(members, late, ["f"])) == [(1, 0, 8, 0)]


# ------------------------------------------------------------- packing and mixing


def test_tokens():
    path = tokens.default_vocabulary()
    assert tokens.count_tokens(None, path) == tokens.count_tokens("", path) == 0
    text = "the girder carries 12.5 kN and no more " * 9000
    assert tokens.count_tokens(text, path) == len(tokens.encoding(path).encode_ordinary(text))


def test_crossover_keeps_every_item():
    rng = random.Random(4)
    sizes = [rng.randrange(60) for _ in range(80)]
    a, b = packing.evolve(sizes, 100, [], rng), packing.best_fit(rng.sample(range(80), 80), sizes, [], 100)
    child = packing.crossover(a, b, sizes, 100, rng)
    assert sorted(i for x in child for i in x) == [*range(80)]
    assert all(sum(sizes[i] for i in x) <= 100 for x in (*child, *a))


def test_packing(spark):
    rng = random.Random(6)
    docs = [(i, rng.randrange(1, 90)) for i in range(300)] + [(500, 0), (501, None), (502, 1005), (502, 1005), (503, 100)]
    df, sizes = spark.createDataFrame(docs, "doc_id bigint, tokens bigint"), spark.createDataFrame([(1, 100), (2, 400)], "pack_id int, capacity int")
    placed, report = packing.pack(df, sizes)
    out = placed.toPandas()
    assert {r["pack_id"]: r["containers"] for r in report.collect()} == out.groupby("pack_id")["container"].nunique().to_dict()
    for pack_id, cap in ((1, 100), (2, 400)):
        p = out[out["pack_id"] == pack_id]
        assert p["tokens"].sum() == sum(t or 0 for _, t in docs)
        assert p.groupby("container")["tokens"].sum().max() <= cap
        assert p.groupby("container")["fill"].first().max() <= 1 and len(p) == sum(max(1, -(-(t or 0) // cap)) for _, t in docs)
        assert {*p["doc_id"]} == {d for d, _ in docs}
        whole = p["container"].str.startswith("w")
        assert p[~whole]["container"].nunique() <= 1.1 * p[~whole]["tokens"].sum() / cap + 2
    assert [x.count() for x in packing.pack(df.limit(0), sizes)] == [0, 0]


def test_packing_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(packing, "BINS", 6)
    rng = random.Random(2)
    docs = [(i, rng.randrange(20, 70)) for i in range(400)] + [(7777, 40)] * 300
    placed, report = packing.pack(spark.createDataFrame(docs, "doc_id bigint, tokens bigint"), spark.createDataFrame([(1, 100)], "pack_id int, capacity int"))
    out, r = placed.toPandas(), report.first()
    assert len(out) == 700 and out.groupby("container")["tokens"].sum().max() <= 100
    assert r["containers"] == out["container"].nunique() <= r["best_fit"] and r["searched"] > 0 and {*out["container"].str[0]} >= {"0", "1"}


def test_search_improves_a_poor_start():
    sizes = [50, 30, 20, 60, 40] * 12 + [35, 33, 32] * 6
    n = packing.least_bins(sizes, 100)
    bad = [[i] for i in range(len(sizes))]
    found = bad
    for k in range(6):
        found = packing.evolve(sizes, 100, [found], random.Random(k))
    assert n <= len(found) < len(bad) and sorted(i for b in found for i in b) == [*range(len(sizes))]


def test_permutation():
    for n in (1, 2, 7, 100, 1000):
        assert sorted(mixing.permute(np.arange(n), n, 3)) == [*range(n)]


def test_mixture(spark):
    rng = random.Random(8)
    docs = [(i, rng.choice("aaaaab"), rng.randrange(1, 900)) for i in range(600)] + [(900, None, 5), (901, "zz", 5), (902, "a", None), (903, "b", 0)]
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.4, 3), ("none", 0.1, 2), (None, 0.3, 1)], "source string, target_share double, max_repeats int")
    df = spark.createDataFrame(docs, "doc_id bigint, source string, tokens bigint")
    chosen, shares = mixing.mix(df, t)
    most = {r["source"]: r["m"] for r in chosen.groupBy("source").agg(F.max("uses").alias("m")).collect()}
    assert most["a"] == 1 and most["b"] <= 3
    share = {r["source"]: r["actual_share"] for r in shares.collect()}
    assert abs(share["a"] - 5 / 9) < 0.01 and abs(share["b"] - 4 / 9) < 0.01 and share["none"] == 0
    slots = [tuple(r) for r in mixing.ordered_slots(df, t).collect()]
    assert len({x[:2] for x in slots}) == len(slots) and {x[2] for x in slots} == {"a", "b"}
    empty, s = mixing.mix(df.limit(0), t)
    assert empty.count() == 0 and s.count() == 3


def test_shard_counts_of_two_thousand_million_blocks():
    totals = [1_999_000_000, 700_000, 299_999, 1, 0]
    shards, slots = -(-sum(totals) // mixing.SHARD_SLOTS), sum(totals)
    for lo, hi in ((0, 40), (shards // 3, shards // 3 + 40), (shards - 40, shards)):
        got = [*mixing.shard_counts(totals, shards, lo, hi, 5)]
        assert [g[0] for g in got] == [*range(lo, hi)]
        for (i, before, own), after in zip(got, [*[g[1] for g in got[1:]], None]):
            assert sum(own) == slots * (i + 1) // shards - slots * i // shards and min(own) >= 0
            assert after is None or [a + b for a, b in zip(before, own)] == after
            assert 4000 < own[0] <= 4096
    assert [a + b for a, b in zip(*got[-1][1:])] == totals and [*mixing.shard_counts(totals, shards, 7, 8, 5)] == [[*mixing.shard_counts(totals, shards, 0, 40, 5)][7]]


@pytest.mark.parametrize("totals", [[5, 3, 0, 9], [1], [4096, 4096]])
def test_shard_counts_add_up(totals):
    for shards in (1, 2, 3, min(17, sum(totals))):
        got = [*mixing.shard_counts(totals, shards, 0, shards, 1)]
        assert [sum(x) for x in zip(*[g[2] for g in got])] == totals


# ------------------------------------------------------------- abuse


def test_disguises_give_the_same_terms():
    lexicon = abuse.Lexicon()
    terms = lambda t: {*(b := lexicon.read([t])).term} | {*b.pair}
    for t in ("you 1d1ot", "you i d i o t", "you idi​ot", "you ｉｄｉｏｔ", "you id#iot", "You IDIIOT"):
        assert {abuse._hash("w idiot", 0, abuse.PARTS), abuse._hash("<idi", abuse.PARTS, abuse.PARTS)} <= terms(t) & terms("you idiot")


def test_reading_keeps_sentences_and_texts_apart():
    b = abuse.Lexicon().read(["One two. Three 4.5 five", None, "", "..", "six\nseven"])
    assert [*b.owner] == [0, 0, 4, 4] and [*np.bincount(b.sentence)] == [2, 4, 1, 1] and len(b.pair) == 1
    n = b.documents(np.ones(5))
    assert n[abuse._hash("w two", 0, abuse.PARTS)] == 1 and abuse.Lexicon().read([None]).texts == 1
    double = abuse.Lexicon().read(["ha ha. ha", "ha"])
    assert double.documents(np.ones(2))[double.first[0]] == 2 and double.spread(np.ones(3))[double.first[0]] == 4


def test_evidence_leaves_out_the_own_share():
    b = abuse.Lexicon().read(["a b", "a c"])
    n, total = b.documents(np.ones(2)), b.documents(np.array([1.0, -1.0]))
    e = b.evidence(n, total, np.array([1.0, -1.0]), 0.0, 3.0, False)
    assert e[0].tolist() == pytest.approx([0, -0.25, -0.125, 0, 0, 0]) and e[1].tolist() == pytest.approx([0.25, 0, 0.125, 0, 0, 0])


def test_valley():
    z, n = np.arange(-400, 401) / 8, np.zeros(801)
    n[400 - 40], n[400 + 16], n[400 + 64] = 1000, 20, 50
    assert 4 < abuse.valley(z, n, 8.0) < 6
    assert abuse.valley(z, n, -3.0) == 0.0


def test_training_on_held_out_texts(spark):
    rng = random.Random(3)
    calm = ["Read the question twice.", "The beam carries 12 kN.", "Close the stop cock by hand.", "The gate is idiot-proof.", "Thanks, that helps."]
    bad = ["You are a stupid {}.", "Only a {} like you would ask.", "Get lost, {}."]
    made = []
    for i in range(300):
        s = rng.sample(calm, 3)
        case = i % 4 == 0
        if case:
            s.insert(rng.randrange(3), rng.choice(bad).format(rng.choice(["moron", "clown", "pig", "halfwit"])))
        made.append((i, " ".join(s), int(case)))
    df = spark.createDataFrame([(*m, rng.choice("ab" if m[2] else "aaab")) for m in made], "doc_id bigint, text string, unfit int, source string")
    docs, labels = df.select("doc_id", "text", "source"), df.select("doc_id", "unfit").where("doc_id < 200")
    odd = spark.createDataFrame([(1000, None, "a"), (1001, "", None), (1002, "word " * 40_000, None), (1003, "?!", "z")], docs.schema)
    scored = abuse.score(docs.unionByName(odd), labels)
    out = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert all((out[i] >= 0.5) == bool(c) for i, _, c in made[200:])
    assert out[1000] == out[1001] == out[1003] == 0.0 and out[1002] < 0.5 and scored.columns == ["doc_id", "source", "score"]
    for l in (labels.limit(0), labels.where("unfit = 1")):
        assert {r["score"] for r in abuse.score(docs, l).collect()} == {0.0}
    assert abuse.score(docs.limit(0), labels).count() == 0
