import hashlib
import json
import random
import re
import subprocess
import sys
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tamis.functions import canon
from tamis.operators import classify, dedupe, ids, near, orphans, sync
from tamis.plans import reference_queries
from tamis.plans.store import Pipeline, Store
from tamis.sources import json_files
from tamis.streaming import feeds


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize(("text", "want"), [("  12) The “Beam”  is​  5–10% … ", "the beam is 5-10%"), (None, ""), ("", ""), ("A" * 50_000, "a" * 50_000)])
def test_canonical(spark, text, want):
    assert one(spark, canon.canonical(canon.strip_number(F.col("t"))), t=("string", text)) == want


def test_identity_ignores_number_case_and_option_order_but_not_word_order(spark):
    q = [(1, "3. What is Stress?", ["B", "a"]), (2, "what is  stress", ["A", "b"]), (3, "stress is what", ["a", "b"]), (4, None, None)]
    got = {r[0]: r[1] for r in spark.createDataFrame(q, "id int, t string, o array<string>").select("id", canon.identity(F.col("t"), F.col("o"))).collect()}
    assert got[1] == got[2] != got[3]
    assert got[1] == hashlib.sha256(json.dumps({"opts": ["a", "b"], "stem": "what is stress"}, sort_keys=True).encode()).hexdigest()
    assert got[4] == hashlib.sha256(b'{"opts": [], "stem": ""}').hexdigest()


@pytest.mark.parametrize(("a", "b", "same", "merge"), [("gnattchart", "ganttchart", True, True), ("increase", "decrease", False, False), ("5-10%", "10-15%", False, False), ("cat", "cut", False, False),
    ("perfomance", "performance", True, True), ("__unanswered__", "__unanswered__", False, False), ("2-3%ofestmatedamount", "2-3%ofestimatedamount", True, True), ("", "", False, False), (None, "x", False, False)])
def test_answers(spark, a, b, same, merge):
    got = spark.createDataFrame([(a, b)], "a string, b string").select(canon.answers_equivalent(F.col("a"), F.col("b")), canon.answers_mergeable(F.col("a"), F.col("b"))).first()
    assert tuple(got) == (same, merge)


def test_answer_identity(spark):
    q = [("Back - sight", 0, ["back-sight", "x"]), (None, 5, ["a"]), ("b", 0, ["a"]), (" ", None, None), ("40°", None, None), (None, 1, ["a", None])]
    got = [r[0] for r in spark.createDataFrame(q, "t string, i int, o array<string>").coalesce(1).select(canon.answer_identity(F.col("t"), F.col("i"), F.col("o"))).collect()]
    assert got[:5] == ["backsight", "__answer_conflict__", "__answer_conflict__", "__unanswered__", "40°"]


@pytest.mark.parametrize(("a", "b"), [("Young’s modulus", "Young's modulus"), ("2…", "2..."), ("5′", "5'"), ("“beam”", "beam"), ("a\u202fb", "a b")])
def test_typographic_marks_do_not_tell_answers_apart(spark, a, b):
    got = spark.createDataFrame([(a, b)], "a string, b string").select(canon.canonical_answer(F.col("a")), canon.canonical_answer(F.col("b"))).first()
    assert got[0] == got[1] != ""


def test_degrees_and_roots_tell_answers_apart(spark):
    got = spark.createDataFrame([("40°", "40"), ("l/√2", "l/2")], "a string, b string").select(canon.canonical_answer(F.col("a")), canon.canonical_answer(F.col("b"))).collect()
    assert all(r[0] != r[1] for r in got)


def test_decomposed_text_options_and_answers_are_composed(spark):
    q = [(1, "the café", ["café", None], "café", 0), (2, "the cafe\u0301", ["", "cafe\u0301"], "cafe\u0301", 1), (3, None, None, None, None), (4, None, [], " ", 0)]
    got = {r["id"]: (r["identity"], r["answer"], r["question_text"]) for r in dedupe.with_identity(spark.createDataFrame(q, "id int, question_text string, options array<string>, correct_text string, correct_index int")).collect()}
    assert got[1][:2] == got[2][:2] and got[1][1] == "café" and got[2][2] == q[1][1] and got[3][0] == got[4][0]
    assert (got[3][1], got[4][1]) == ("__unanswered__", "__answer_conflict__")


QUESTIONS = "id bigint, chapter_id bigint, identity string, answer string, corrected_at timestamp, quality_score float"


def test_merge_plan_joins_agreeing_answers_only(spark):
    q = spark.sql("""SELECT * FROM VALUES (1L, 1L, 'k', 'a', NULL, 1f), (2L, 1L, 'k', 'a', timestamp'2024-01-01', NULL), (3L, 1L, 'k', 'b', NULL, 9f),
      (4L, 2L, 'k', 'a', NULL, 1f), (5L, 1L, 'k', '__unanswered__', NULL, 1f), (6L, 1L, 'k', '__unanswered__', NULL, 1f) AS t(id, chapter_id, identity, answer, corrected_at, quality_score)""")
    assert rows(dedupe.merge_plan(q)) == [(1, "k", 2, 1)]
    assert rows(dedupe.groups(q)) == [(1, "k", 5, 3)]
    assert dedupe.merge_plan(q.limit(0)).count() == 0


def test_resolve_stops_at_loops_and_long_chains(spark):
    p = [(1, None), (2, 1), (3, 2), (4, 5), (5, 4), (9, 77)] + [(100 + i, 101 + i) for i in range(12)]
    got = {r[0]: r[1] for r in dedupe.resolve(spark.createDataFrame(p, "id bigint, target bigint")).collect()}
    assert got[1] == 1 and got[3] == 1 and got[4] is None and got[9] == 77 and got[100] is None and got[105] == 112


def test_upsert_keeps_held_rows(spark):
    old, new = spark.createDataFrame([(1, "a", True), (2, "b", False)], "k int, v string, dirty boolean"), spark.createDataFrame([(1, "x", False), (2, "y", False), (3, "z", None)], "k int, v string, dirty boolean")
    assert rows(dedupe.upsert(old, new, "k", F.col("dirty")).select("k", "v")) == [(1, "a"), (2, "y"), (3, "z")]


def brute_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_lcs():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rng.choices("abc ", k=rng.randint(0, 15))) for _ in range(2))
        assert near.lcs(a, b) == brute_lcs(a, b)
        a, b = " ".join(a.split()), " ".join(b.split())  # as words_of gives them
        assert near.bound(a, b) >= near.best_ratio(a, b) - 1e-9


def test_near_candidates_against_all_pairs(spark):
    rng = random.Random(2)
    words = ["girder", "culvert", "stress", "bitumen", "canal", "levee", "gabion", "truss"]
    q = [(i, 1, f"k{i}", " ".join(rng.sample(words, 5)), ["one beam", "two beams"]) for i in range(25)] + [(99, 2, "z", None, None)]
    got = {(r[1], r[2]) for r in near.candidates(spark.createDataFrame(q, "id bigint, chapter_id bigint, identity string, question_text string, options array<string>")).collect()}
    want = {(a[0], b[0]) for a in q for b in q if a[0] < b[0] and a[1] == b[1] and near.pair_scores(a[3], b[3], a[4], b[4])[0] >= 80}
    assert got == want


def test_trigram_pairs_against_all_pairs(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta", "12.5", "kN"], k=8)) for _ in range(25)]
    texts = [(i, t) for i, t in enumerate(base + [t + " x" for t in base] + base[:4] + ["", None, "a"])]
    df = spark.createDataFrame(texts, "id bigint, t string")
    g = {r[0]: {*r[1]} for r in df.select("id", canon.trigrams(F.col("t"))).collect()}
    want = {(a, b) for a in g for b in g if a < b and g[a] and len(g[a] & g[b]) / len(g[a] | g[b]) >= 0.9}
    assert {(r[0], r[1]) for r in near.trigram_pairs(df, "id", "t", 0.9).collect()} == want


def test_keywords_cover_longest_first_and_ties_abstain(spark):
    d = spark.createDataFrame([(1, "A", "principal stress"), (1, "A", "stress"), (1, "B", "stress"), (1, "C", "Young's modulus"), (1, "D", "is")], "chapter_id bigint, code string, keyword string")
    q = spark.createDataFrame([(1, 1, "The principal stress is"), (2, 1, "stress"), (3, 1, "young's modulus"), (4, 1, "stressed"), (5, 1, None)], "id bigint, chapter_id bigint, question_text string")
    got = {r["id"]: (r["code"], r["score"], r["decided"]) for r in classify.classify(q, classify.dictionary(d)).collect()}
    assert got == {1: ("A", 2, True), 2: ("mixedqn", 1, False), 3: ("C", 3, True), 4: ("mixedqn", 0, False), 5: ("mixedqn", 0, False)}


def test_ids_probe_for_the_next_free_one(spark):
    w = spark.createDataFrame([(1, "5001", 1), (2, "5001", 1), (3, "5001", 2)], "group_id bigint, prefix string, seq int")
    taken = spark.createDataFrame([("50010002",), (None,)], "public_id string")
    assert rows(ids.allocate(w, taken)) == [(1, "50010001"), (2, "50010003"), (3, "50010004")]


def test_orphans_fold_in_any_order(spark):
    refs = spark.createDataFrame([("r", "1", 7, None, True), ("r", "2", 8, None, True), ("r", "3", None, None, True)], "ref_table string, row_id string, key bigint, at timestamp, checks_late boolean")
    made = spark.createDataFrame([(7,)], "id bigint")
    a, b, c = orphans.deltas(refs, "key", refs=1), orphans.deltas(made, "id", alive=1), orphans.deltas(made, "id", alive=-1, deleted=1)
    assert rows(orphans.orphan_keys(orphans.fold(a, b))) == [(8, 1, "missing")]
    assert rows(orphans.orphan_keys(orphans.fold(orphans.fold(c, a), b))) == [(7, 1, "deleted"), (8, 1, "missing")]
    assert rows(orphans.report(refs, orphans.fold(a, b))) == [("r", "2", "missing", "unknown")]


def test_diff_and_tiers(spark):
    old, new = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "k int, h string"), spark.createDataFrame([(1, "b"), (2, None), (4, "d")], "k int, h string")
    assert rows(sync.diff(old, new, ["k"], "h")) == [(1, "changed"), (2, "same"), (3, "deleted"), (4, "new")]
    e = spark.createDataFrame([(1, 10, "x"), (2, None, "y"), (3, None, "z")], "edit_id int, qid int, t string")
    r = spark.createDataFrame([(10, 10, "q"), (11, 11, "y"), (12, 12, "y")], "record_id int, qid int, t string")
    assert rows(sync.tiered_match(e, r, [("id", ["qid"]), ("text", ["t"])])) == [(1, "id", 10, "matched"), (2, "text", None, "ambiguous"), (3, None, None, "no_match")]


def test_store_commits_all_or_nothing(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    assert s.commit({"a": spark.range(3), "b": spark.range(2)}) == 1
    assert s.commit({"a": spark.range(9)}, dry_run=True) == 1 and s.read("a").count() == 3
    assert s.migrate([("1", "x", lambda st: {"a": spark.range(5)})]) == ["1"] and s.migrate([("1", "x", None)]) == []
    with pytest.raises(ValueError):
        s.migrate([("1", "changed", None)])
    state, log = Pipeline([("bad", lambda st: 1 / 0), ("next", lambda st: {})], fatal={"bad"}).run({})
    assert [x[0] for x in log] == ["bad"]


def test_store_keeps_the_other_writers_commit_and_half_a_commit_shows_nothing(spark, tmp_path, monkeypatch):
    one, two = Store(spark, str(tmp_path)), Store(spark, str(tmp_path))
    one.commit({"a": spark.range(1)})
    stale = one.current()
    two.commit({"b": spark.range(2)})
    assert one.commit({"a": spark.range(3)}) == 3 > stale["version"] and one.read("b").count() == 2 and two.read("a").count() == 3
    with one.lock(), pytest.raises(FileExistsError):
        two.commit({"a": spark.range(4)})
    monkeypatch.setattr(one, "_replace", lambda state: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        one.migrate([("1", "x", lambda st: {"a": spark.range(5)})])
    assert two.read("a").count() == 3 and two.current()["migrations"] == {} and two.migrate([("1", "x", lambda st: {"a": spark.range(5)})]) == ["1"]


def test_json_folder(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x/a.json").write_text('{"questions": [{"q": "1"}, 5, {"q": "2"}]}')
    (tmp_path / "b.json").write_text(r'[{"q": "\sigma"}]')
    (tmp_path / "c.json").write_text("no json")
    got = json_files.read_folder(spark, str(tmp_path))
    assert sorted(str(r["item"]) for r in got.collect()) == ["None", '{"q":"1"}', '{"q":"2"}', r'{"q":"\\sigma"}']


def test_ledger_stream_applies_once(spark, tmp_path):
    src, ledger = str(tmp_path / "src"), f"{tmp_path}/ledger"
    seen = []
    for n in range(2):
        spark.range(5).selectExpr("id % 3 AS k").write.mode("append").parquet(src)
        stream = spark.readStream.schema("k bigint").parquet(src)
        feeds.stream_with_ledger(spark, stream, ["k"], ledger, lambda df: seen.extend(r[0] for r in df.collect()), f"{tmp_path}/cp").awaitTermination()
    assert sorted(seen) == [0, 1, 2]


def test_core_does_not_need_the_llm_folder():
    code = "import sys; sys.modules['tamis.llm'] = None; import __spark_entry__ as e; assert e.queries() and not [q for q in e.queries() if q.startswith('p1_')]"
    subprocess.run([sys.executable, "-c", code], check=True)


def test_dirty_upsert_inserts_new_ids_and_holds_six_columns(spark, tmp_path):
    schema = "id string, uid string, status string, resolved_at timestamp, resolved_by string, corrected boolean, corrected_snapshot string, migrated_at timestamp, backend_dirty boolean, backend_synced_at timestamp, correction_audit_id bigint"
    at = lambda n: datetime(2024, 1, n)
    spark.createDataFrame([
        ("dirty", "old", "waiting", None, None, True, "s", at(1), True, at(1), 7), ("dirty", "new", "resolved", at(3), "b", False, None, at(3), False, at(3), None),
        ("clean", "old", "open", None, None, False, None, at(1), False, None, 8), ("clean", "new", "dismissed", at(3), "b", True, "t", at(4), False, at(4), None),
        ("clean", "mid", "resolved", at(2), "a", False, None, at(2), False, at(2), None),
        ("came", "new", None, at(3), "b", True, "t", at(3), True, at(3), 9), ("here", "old", None, None, None, False, None, None, None, None, None),
    ], schema).write.parquet(f"{tmp_path}/reported_questions.parquet")
    got = {r["id"]: r for r in reference_queries.QUERIES["dirty_upsert"](spark, str(tmp_path)).collect()}
    assert set(got) == {"dirty", "clean", "came", "here"}
    assert tuple(got["dirty"]) == ("dirty", "new", "waiting", None, None, True, "s", at(3), True, at(1), 7)
    assert tuple(got["clean"]) == ("clean", "new", "dismissed", at(3), "b", True, "t", at(4), False, at(4), 8)
    assert tuple(got["came"])[2:] == ("open", at(3), "b", True, "t", at(3), False, at(3), None)
    assert got["here"]["uid"] == "old" and got["here"]["status"] is None


def test_pending_candidates_take_pairs_turned_round(spark, tmp_path):
    at = lambda n: datetime(2024, 1, n)
    spark.createDataFrame([
        (1, 10, 20, 80.0, "pending", at(1)), (2, 20, 10, 85.0, " Pending", at(2)), (3, 40, 30, 90.0, "PENDING", at(1)), (4, 50, 50, 99.0, "pending", at(1)),
        (5, 60, None, 99.0, "pending", at(1)), (6, 80, 70, 99.0, "merged", at(1)), (7, 90, 91, 70.0, "pending", None), (8, 93, 92, None, "pending", at(2)), (9, 92, 93, 60.0, "pending", at(1)),
    ], "id bigint, q1_id bigint, q2_id bigint, stem_score double, status string, created_at timestamp").write.parquet(f"{tmp_path}/dedupe_review_candidates.parquet")
    assert rows(reference_queries.QUERIES["pending_candidates"](spark, str(tmp_path))) == [(10, 20, 85.0), (30, 40, 90.0), (90, 91, 70.0), (92, 93, None)]


def test_ids_of_an_identity_are_reused_and_a_full_file_is_an_error(spark):
    schema = "id bigint, level int, chapter string, code string, number int, key string, stable_qn_id string, corrected_at timestamp, quality_score float"
    q = [(1, 5, "1", "7", 1, "a", None, None, 9.0), (2, 5, "1", "7", 2, "a", "X1", None, 1.0), (3, 5, "1", "7", 3, "b", None, None, 9.0), (4, 5, "1", "7", 4, "b", None, datetime(2024, 1, 1), 1.0),
        (5, 6, "1", "7", 1, "a", None, None, None), (6, 5, "1", "7", 5, "c", None, None, 2.0), (7, 5, "2", "8", 1, "c", None, None, 2.0)]
    df = spark.createDataFrame(q, schema)
    held = "id bigint, public_id string, live boolean"
    got = ids.plan(df, spark.createDataFrame([(2, "X1", True), (90, "500100710005", False)], held))
    assert rows(got) == [(2, "X1", True), (4, "500100710004", False), (5, "600100710001", False), (6, "500100710006", False)]
    with pytest.raises(Exception, match="several identities"):
        ids.plan(df, spark.createDataFrame([(2, "X1", True), (91, "X1", True)], held)).collect()
    with pytest.raises(Exception, match="no free sequence"):
        ids.allocate(spark.createDataFrame([(1, "5001", 1)], "group_id bigint, prefix string, seq int"), spark.createDataFrame([("50010001",), ("50010002",)], "public_id string"), probes=2).collect()


def test_stable_ids_groups_by_content_not_by_stored_keys(spark, tmp_path):
    schema = "id bigint, question_number int, question_text string, options array<string>, correct_index int, correct_text string, explanation string, quality_score float, corrected_at timestamp, source_question_key string, canonical_id bigint, stable_qn_id string, file_ref_id bigint"
    q = lambda i, text, src, held=None, number=None: (i, number, text, ["a", "b"] if text else None, 0, "a", None, 1.0, None, src, None, held, 30)
    data = [q(1, "1. What is stress?", "n:1"), q(2, "What is Stress", "n:2", "5X"), q(3, "Other", "n:1"), q(4, None, None), q(5, None, None), q(6, "y", "i:z"), q(7, "z", "i:z")]
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/questions.parquet")
    for name, row, kind in [("files", (30, 20), "id bigint, book_id bigint"), ("books", (20, 10), "id bigint, chapter_id bigint"), ("chapters", (10, 5, "1"), "id bigint, level_id bigint, chapter_key string")]:
        spark.createDataFrame([row], kind).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {r["group_id"]: (r["public_id"], r["reused"]) for r in reference_queries.QUERIES["stable_ids"](spark, str(tmp_path)).collect()}
    assert got == {2: ("5X", True), 3: ("500103010003", False), 4: ("500103010004", False), 5: ("500103010005", False), 6: ("500103010006", False)}


def test_near_duplicates_against_all_pairs(spark, tmp_path):
    rng = random.Random(4)
    base = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta", "12.5", "kN"], k=9)) for _ in range(8)]
    opts = [["one beam", "two beams"], ["One beam,", "two-beams"], ["three", "piers"], None, [], ["one beam", None]]
    answers = ["One  beam", "one beam.", "two", "", None]
    data = [(i, 30 + i % 4 if i % 7 else None, t + rng.choice(["", " *", "!"]), rng.choice(opts), rng.choice(answers)) for i, t in enumerate(base * 5)] + [(98, 30, None, ["x"], "x"), (99, 30, None, ["x"], "x")]
    spark.createDataFrame(data, "id bigint, file_ref_id bigint, question_text string, options array<string>, correct_text string").write.parquet(f"{tmp_path}/questions.parquet")
    spark.createDataFrame([(30, 20), (31, 20), (32, 21), (33, 22)], "id bigint, book_id bigint").write.parquet(f"{tmp_path}/files.parquet")
    spark.createDataFrame([(20, 10), (21, 10), (22, 11)], "id bigint, chapter_id bigint").write.parquet(f"{tmp_path}/books.parquet")
    spark.createDataFrame([(10, 1, "1"), (11, 2, "1")], "id bigint, level_id bigint, chapter_key string").write.parquet(f"{tmp_path}/chapters.parquet")
    chapter = {30: 10, 31: 10, 32: 10, 33: 11}

    def grams(t):
        return {f"  {w} "[i : i + 3] for w in re.findall(r"[^\W_]+", (t or "").lower()) for i in range(len(w) + 1)}

    def like(x, y):
        return len(x & y) / len(x | y) if x | y else 0.0

    def status(x, y):
        x, y = (re.sub(r"[\W_]+", " ", (t or "").lower()) for t in (x, y))
        return "none" if not x or not y else "same" if x == y else "CONFLICT"

    want, counts, files = set(), [0, 0, 0, 0], {}
    for a in data:
        for b in data:
            if a[0] < b[0] and a[1] and b[1]:
                q, o = like(grams(a[2]), grams(b[2])), like(*[grams(" ".join(v for v in x[3] or [] if v)) for x in (a, b)])
                if q >= 0.9 and o >= 0.9:
                    same = chapter[a[1]] == chapter[b[1]]
                    want.add((a[0], b[0], same, round(q, 3), round(o, 3), status(a[4], b[4])))
                    counts = [n + k for n, k in zip(counts, (1, q >= 0.95 and o >= 0.95, q >= 0.99 and o >= 0.99, q >= 0.99 and same))]
                    if same and a[1] != b[1]:
                        files[chapter[a[1]]] = files.get(chapter[a[1]], 0) + 1
    got = lambda name: reference_queries.QUERIES[name](spark, str(tmp_path))
    assert {*map(tuple, got("near_duplicates").select("id_a", "id_b", "same_chapter", "q_sim", "opt_sim", "answer").collect())} == want
    assert {w[5] for w in want} == {"none", "same", "CONFLICT"} and {w[2] for w in want} == {True, False}
    assert rows(got("near_duplicate_summary")) == [tuple(counts)]
    assert rows(got("near_duplicate_chapters")) == [("1", 1, files[10])] and len(files) == 1


def test_merge_rejects_pairs_clears_pointers_and_leaves_an_audit_row(spark):
    plan = spark.createDataFrame([(1, "k", 10, 11), (1, "k", 10, 12)], "chapter_id bigint, identity string, keeper_id bigint, duplicate_id bigint")
    pairs = spark.createDataFrame([(1, 11, 12, "pending"), (2, 30, 11, " Pending"), (3, 11, 30, "merged"), (4, 10, 30, "pending"), (5, 12, None, "pending"), (6, 11, 40, None)], "id bigint, q1_id bigint, q2_id bigint, status string")
    assert rows(dedupe.rejected(plan, pairs)) == [(i, "rejected", "question merged") for i in (1, 2, 5)]
    pointers = spark.createDataFrame([(20, 11), (21, 10), (22, None), (11, None)], "id bigint, canonical_id bigint")
    assert rows(dedupe.cleared(plan, pointers)) == [(20, 11, None)]
    q = [(i, f"t{i}", ["a", None], 0, None, None) for i in (10, 11, 12, 20)]
    got = dedupe.audit(plan, spark.createDataFrame(q, "id bigint, question_text string, options array<string>, correct_index int, correct_text string, raw string")).orderBy("deleted_id").collect()
    assert [tuple(r)[:8] for r in got] == [("k", 10, i, f"t{i}", ["a", None], 0, None, "exact") for i in (11, 12)]
    seen = json.loads(got[0]["snapshot"])
    assert seen["question"] == {"id": 11, "question_text": "t11", "options": ["a", None], "correct_index": 0, "correct_text": None, "raw": None}
    assert seen["child_rows"] == {} and seen["keeper_before"] is None
