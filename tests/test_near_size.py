"""What the near-duplicate queries shuffle; their texts are long, of one wording, and few are alike."""

import random

import pytest

from tamis.operators import near
from tamis.plans import reference_queries


def shuffled(spark):
    sc = spark.sparkContext._jsc.sc()
    sc.listenerBus().waitUntilEmpty(30_000)
    return sum(e.totalShuffleWrite() for e in (sc.statusStore().executorList(False).apply(i) for i in range(sc.statusStore().executorList(False).size())))


@pytest.fixture(scope="module")
def bank(spark, tmp_path_factory):
    """600 texts of about 190 characters; 40 differ from another by a digit and 40 by case only."""
    d, rng = str(tmp_path_factory.mktemp("bank")), random.Random(6)
    name = lambda: "".join(rng.choice("bdgklmnprstvz") + rng.choice("aeiou") for _ in range(4))
    made = [f"During the duty of {name()} inspection at {name()}, the crew of {name()} noted {rng.randint(10000, 99999)} days beside marker {rng.randint(100000, 999999)} "
            f"and {rng.randint(1000, 9999)}.{rng.randint(10, 99)} days beside marker {rng.randint(100000, 999999)}; which {name()} figure should {name()} report?" for _ in range(520)]  # fmt: skip
    made += [t[:-1] + " 7?" for t in made[:40]] + [t.upper() for t in made[:40]]
    data = [(i, 30, t, [f"{name()} {i}", name()] if i < 520 else ["one beam"], "a") for i, t in enumerate(made)]
    spark.createDataFrame(data, "id bigint, file_ref_id bigint, question_text string, options array<string>, correct_text string").write.parquet(f"{d}/questions.parquet")
    for n, row, kind in [("files", (30, 20), "id bigint, book_id bigint"), ("books", (20, 10), "id bigint, chapter_id bigint"), ("chapters", (10, 1, "1"), "id bigint, level_id bigint, chapter_key string")]:
        spark.createDataFrame([row], kind).write.parquet(f"{d}/{n}.parquet")
    return d


@pytest.mark.parametrize("name,rows", [("near_duplicates", 40), ("trigram_pairs", 120), ("near_duplicate_summary", 1), ("near_duplicate_chapters", 0)])
def test_shuffle_is_small(spark, bank, name, rows):
    before = shuffled(spark)
    got = reference_queries.QUERIES[name](spark, bank).collect()
    assert len(got) == rows
    assert shuffled(spark) - before < 1_500_000  # a tenth of a megabyte of text


@pytest.mark.parametrize("name", ["trigram_histogram", "trigram_pairs", "near_duplicate_summary", "near_duplicate_chapters"])
def test_shuffle_is_below_that_of_shared_trigrams(spark, bank, name):
    """A join on single trigrams shuffled 1.2 MB here."""
    before = shuffled(spark)
    got = reference_queries.QUERIES[name](spark, bank).collect()
    if name == "trigram_histogram":
        assert {r["similarity"]: r["pairs"] for r in got} == {0.99: 80, 1.0: 40}
    assert shuffled(spark) - before < 600_000


def test_near_candidates_shuffle_no_pairs(spark):
    """Every pair shares a word, few are alike: only texts may move, and the bounds lose none of the pairs."""
    rng = random.Random(8)
    words = ["".join(rng.choice("bdgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(60)]
    option = lambda: f"{rng.randint(100, 99999)} {rng.choice(["mm", "kn", "days"])}"
    made = [(rng.sample(words, 20), [option() for _ in range(rng.choice([0, 4, 4, 4, 4, 4, 4]))]) for _ in range(400)]
    made += [(rng.sample(t[:18], 18) + rng.sample(words, 2), [o + rng.choice(["", "s", "1"]) for o in opts]) for t, opts in made[:30]]
    q = [(i, 1, rng.choice([f"k{i}", f"k{i}", "k", None]), " ".join(t), opts) for i, (t, opts) in enumerate(made)]
    want = {}
    for a in q:
        for b in q:
            if a[0] < b[0] and a[2] != b[2] and near.options_score(a[4], b[4]) >= 65 and near.best_ratio(a[3], b[3]) >= 80:
                want[a[0], b[0]] = tuple(round(x, 2) for x in near.pair_scores(a[3], b[3], a[4], b[4]))
    df = spark.createDataFrame(q, "id bigint, chapter_id bigint, identity string, question_text string, options array<string>")
    before = shuffled(spark)
    got = {(r["q1_id"], r["q2_id"]): (r["stem_score"], r["options_score"]) for r in near.candidates(df, rare=30).collect()}
    used = shuffled(spark) - before
    assert got.keys() == want.keys() and len(want) > 15 and all(abs(x - y) < 0.011 for k in want for x, y in zip(got[k], want[k]))
    assert used < 1_500_000, used
