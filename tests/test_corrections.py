import pytest
from pyspark.sql import functions as F

from tamis.operators import corrections

QUESTIONS = "id bigint, stable_qn_id string, canonical_id bigint, file_id string, source_question_key string, question_number int, question_text string, options array<string>, corrected_at timestamp, explanation string, source_identity string"
EDITS = "edit_id bigint, ref string, file_id string, question_text string, options array<string>, after_text string, after_options array<string>, after_index int, after_explanation string, corrected_at timestamp"


def question(id_, text, options=("a", "b"), file_id="f", key=None, number=None, canonical=None, public=None, at=None):
    return (id_, public, canonical, file_id, key, number, text, None if options is None else [*options], at, "old", None)


@pytest.fixture(scope="module")
def questions(spark):
    q = [
        question(1, "What is stress", public="5001A"), question(2, "merged", canonical=1), question(3, "loop", canonical=4), question(4, "loop", canonical=3),
        question(10, "Twice here"), question(11, "Twice here"), question(12, "Once fixed"), question(13, "Once fixed"), question(20, "Numbered", key="n:7"), question(21, "Other", number=8),
        question(30, "the stress of it", file_id="g"), question(40, None, None, file_id=None), question(41, "tail", canonical=999),
    ]
    df = spark.createDataFrame(q, QUESTIONS)
    return df.withColumn("corrected_at", F.when(F.col("id") == 13, F.timestamp_seconds(F.lit(9))).otherwise(F.col("corrected_at")))


def edit(id_, ref=None, file_id=None, text=None, options=("b", "A"), after="new text", after_options=("x", "y"), index=1, expl="", at=None):
    return (id_, ref, file_id, text, None if options is None else [*options], after, None if after_options is None else [*after_options], index, expl, at)


def test_match_by_id_then_by_content(spark, questions):
    e = [
        edit(1, "1"), edit(2, " 5001a "), edit(3, "2"), edit(4, "3"), edit(5, "77"), edit(6, "41"),
        edit(7, None, "f", "7. Anything"), edit(8, None, "f", "8) anything"), edit(9, None, "f", "Twice here"), edit(10, None, "f", "once  FIXED"), edit(11, None, "g", "what is stress"),
        edit(12, None, "", "What is stress?"), edit(13, None, None, "twice here"), edit(14, None, None, "stress is it"), edit(15, None, None, None, None),
    ]
    got = {r["edit_id"]: (r["record_id"], r["reason"]) for r in corrections.match(spark.createDataFrame(e, EDITS), questions).collect()}
    assert got == {
        1: (1, "qid"), 2: (1, "qid"), 3: (1, "qid"), 4: (None, "not_found"), 5: (None, "not_found"), 6: (None, "not_found"),
        7: (20, "source_number_file"), 8: (21, "source_number_file"), 9: (None, "ambiguous_identity_in_source_file(2)"), 10: (13, "identity_file_corrected"), 11: (None, "not_found_in_source_file"),
        12: (1, "identity"), 13: (None, "ambiguous_identity(2)"), 14: (30, "legacy_identity"), 15: (40, "identity"),
    }
    empty = spark.createDataFrame([], EDITS)
    assert corrections.match(empty, questions).count() == 0 and corrections.match(spark.createDataFrame(e, EDITS), questions.limit(0)).where("record_id IS NOT NULL").count() == 0


def test_references_that_lead_nowhere_have_reasons(spark, questions):
    refs = spark.createDataFrame([(1, None), (2, "3"), (3, "99"), (4, "41"), (5, "nobody"), (6, "2")], "edit_id bigint, ref string")
    got = {r["edit_id"]: (r["record_id"], r["reason"]) for r in corrections.resolve_refs(refs, questions).collect()}
    assert got == {1: (None, "qid_missing"), 2: (None, "qid_canonical_loop"), 3: (None, "qid_not_found"), 4: (None, "qid_not_found"), 5: (None, "qid_not_found"), 6: (1, "qid")}


def test_one_bad_correction_does_not_stop_the_others(spark, questions):
    e = [edit(1, "1", text="What is stress"), edit(2, "1", text=""), edit(3, "1", text="t", after_options=None), edit(4, "1", text="t", index=2), edit(5, "88", text="t"), edit(6, "1", text="t", index=None), edit(7, "1", text="t")]
    df = spark.createDataFrame(e, EDITS)
    done = corrections.process(df, questions, spark.createDataFrame([(7,)], "edit_id bigint"))
    got = {r["edit_id"]: (r["reason"], r["state"]) for r in done.collect()}
    assert got == {
        1: ("qid", "applied"), 2: ("missing_before_after", "skipped"), 3: ("invalid_after_options", "skipped"), 4: ("invalid_after_correct_index", "skipped"),
        5: ("not_found", "queued"), 6: ("invalid_after_correct_index", "skipped"), 7: ("already_applied", "skipped"),
    }
    backlog = spark.createDataFrame([(5, "old", 2, 1), (7, "old", 1, 1), (50, "waits", 1, 0)], "edit_id bigint, reason string, attempts int, updated_at int")
    left = corrections.requeue(backlog, done, F.lit(9))
    assert sorted(map(tuple, left.collect())) == [(5, "not_found", 3, 9), (50, "waits", 1, 0)]
    assert [r["edit_id"] for r in corrections.retry_order(left, 1).collect()] == [50]


def test_apply_takes_the_latest_and_keeps_an_explanation(spark, questions):
    e = [edit(1, "1", text="What is stress", after="9. Newer  text", expl="", at=None), edit(2, "2", text="What is stress", after="older", expl="why", at=None)]
    df = spark.createDataFrame(e, EDITS).withColumn("corrected_at", F.timestamp_seconds(F.when(F.col("edit_id") == 1, 20).otherwise(10)))
    r = corrections.apply(df, corrections.process(df, questions), questions).collect()
    assert len(r) == 1 and (r[0]["id"], r[0]["question_text"], r[0]["correct_text"], r[0]["explanation"]) == (1, "Newer  text", "y", "old")


def test_revert_only_the_newest_and_only_unchanged(spark):
    audits = [(1, 5, "a", ["x"], 0, "b", ["x"], 0, None), (2, 5, "b", ["x"], 0, "c", ["x"], 0, None), (3, 6, "b", ["x"], 0, "c", ["x"], None, None), (4, 7, "b", None, 0, "c", None, 0, None), (5, 8, "b", None, 0, "gone", None, 0, None), (6, 5, "z", None, 0, "z", None, 0, 1), (7, None, "z", None, 0, "z", None, 0, None)]
    a = spark.createDataFrame(audits, "id bigint, question_id bigint, before_text string, before_options array<string>, before_index int, after_text string, after_options array<string>, after_index int, reverted_at int")
    q = spark.createDataFrame([(5, "c", ["x"], 0), (6, "c", ["x"], None), (7, "c", ["y"], 0)], "id bigint, question_text string, options array<string>, correct_index int")
    got = {r["id"]: (r["reason"], r["question_text"]) for r in corrections.revert(a, q).collect()}
    assert got == {1: ("newer_correction", None), 2: ("revertible", "b"), 3: ("revertible", "b"), 4: ("changed_since", None), 5: ("no_question", None), 6: ("already_reverted", None), 7: ("no_question", None)}


def test_reports_close_only_after_a_later_correction(spark):
    q = spark.createDataFrame([(1, None, 100), (2, 1, None), (3, None, None), (4, 9, None)], "id bigint, canonical_id bigint, corrected_at int")
    r = spark.createDataFrame([("a", 1, "open", 90), ("b", 2, None, 100), ("c", 1, "open", 101), ("d", 1, "resolved", 1), ("e", 3, "open", 1), ("f", 2, "open", None), ("g", 4, "open", 1), ("h", None, "open", 1)], "id string, qid bigint, status string, reported_at int")
    assert sorted(map(tuple, corrections.reconcile(r, q).collect())) == [("a", 1, 100), ("b", 1, 100), ("f", 1, 100)]


@pytest.mark.parametrize(("text", "options", "index", "answered", "why"), [
    ("t", ["a", "b"], 1, True, None), (" ", ["a", "b"], 1, True, "empty_text"), ("t", ["a"], 0, True, "fewer_than_two_options"), ("t", None, 0, True, "fewer_than_two_options"), ("t", ["a", None], 0, True, "empty_option"),
    ("t", ["a", "b"], None, True, "index_required"), ("t", ["a", "b"], None, False, None), ("t", ["a", "b"], 2, True, "index_outside_options"), (None, ["a", "b"], 0, True, "empty_text"),
])
def test_console_rules(spark, text, options, index, answered, why):
    df = spark.createDataFrame([(text, options, index, answered)], "t string, o array<string>, i int, a boolean")
    assert df.select(corrections.console_problem(F.col("t"), F.col("o"), F.col("i"), F.col("a"))).first()[0] == why
