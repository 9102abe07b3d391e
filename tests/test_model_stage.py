import pytest
from pyspark.sql import functions as F

from tamis.operators import classify, model_stage

CODES = {"3.1": "Soil tests", "3.2": "Bearing capacity", "4": "Canals", "G1": "General  Knowledge"}


def test_question_block(spark):
    df = spark.createDataFrame([(1, " Why? ", [" a", None, "c "]), (2, None, None), (3, "x", [])], "n int, t string, o array<string>")
    got = [r[0] for r in df.select(model_stage.question_block(F.col("n"), F.col("t"), F.col("o"))).collect()]
    assert got == ["Q1. Why?\n    A) a\n    B) \n    C) c", "Q2. ", "Q3. x"]


@pytest.mark.parametrize(("reply", "want"), [
    ('{"answers": [{"q": 1, "code": "3.1", "conf": 0.9}, {"q": "2", "subtopic": "4"}, {"q": 3}]}', {"1": ("3.1", 0.9), "2": ("4", None)}),
    ('```json\n{"1": "3.1", "2": {"code": "4", "confidence": 1}, "3": 7}\n```', {"1": ("3.1", None), "2": ("4", 1.0), "3": ("mixedqn", None)}),
    ('Sure! ["3.1", "4"] as asked', {"1": ("3.1", None), "2": ("4", None)}), ("no", {}), (None, {}), ("", {}), ("{broken", {}), ("7", {}),
    ('Here: {"result": {"5": "G1"}} done', {"5": ("G1", None)}),
])
def test_replies(reply, want):
    assert model_stage.answers(model_stage.read_reply(reply)) == want


@pytest.mark.parametrize(("raw", "want"), [
    ("3.1", "3.1"), ("g1", "G1"), ("3.2 Bearing capacity", "3.2"), ("3.2.5", "3.2"), ("4.9.1 x", "4"), ("bearing  CAPACITY", "3.2"), ("canals and weirs", "4"), ("knowledge", "G1"),
    ("zz", "mixedqn"), ("", "mixedqn"), (None, "mixedqn"), ("a", "mixedqn"),
])
def test_codes(raw, want):
    assert model_stage.valid_code(raw, CODES) == want


def test_run_asks_by_chapter_and_reports_missing_answers(spark):
    q = [(i, 1 + i % 2, f"text {i}", ["a", "b"]) for i in range(7)] + [(50, None, None, None)]
    codes = spark.createDataFrame([(1, "3.1", "Soil"), (2, "4", None)], "chapter_id bigint, code string, title string")

    def model(prompts):
        n = prompts[0].count("\nQ") - 1  # without the heading
        code = "3.1" if "3.1" in prompts[0] else "4"
        return ["[" + ", ".join(f'{{"q": {k}, "code": "{code}", "conf": 0.5}}' for k in range(1, n)) + "]"]  # the last one is left out

    got = {r["id"]: (r["code"], r["error"]) for r in model_stage.run(spark.createDataFrame(q, "id bigint, chapter_id bigint, question_text string, options array<string>").coalesce(1), codes, model, 3).collect()}
    assert len(got) == 8 and got[50][0] == "mixedqn"
    assert {v for k, v in got.items() if k % 2 == 0 and k < 50} <= {("3.1", None), ("mixedqn", "no answer")} and sum(v[1] is not None for v in got.values()) == 4
    none = model_stage.run(spark.createDataFrame(q[:2], "id bigint, chapter_id bigint, question_text string, options array<string>"), codes, lambda p: [None])
    assert {r["error"] for r in none.collect()} == {"no answer"}


def test_fallback_needs_two_points(spark):
    d = classify.dictionary(spark.createDataFrame([(1, "A", "principal stress"), (1, "B", "stress"), (1, "C", "canal"), (1, "D", "canal")], "chapter_id bigint, code string, keyword string"))
    q = spark.createDataFrame([(1, 1, "which", ["principal stress"]), (2, 1, "stress", None), (3, 1, "canal canal", []), (4, 1, None, None)], "id bigint, chapter_id bigint, question_text string, options array<string>")
    got = {r["id"]: (r["code"], round(r["confidence"], 2)) for r in model_stage.fallback(q, d).collect()}
    assert got == {1: ("A", 0.45), 2: (None, 0.0), 3: (None, 0.0), 4: (None, 0.0)}


def test_second_stage_with_a_stub(spark):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(20)], "id bigint, text string")
    got = {r["id"]: (r["code"], r["confidence"]) for r in classify.second_stage(df, lambda texts: [(t.upper(), 0.5) for t in texts], 8).collect()}
    assert got == {i: (f"T{i}", 0.5) for i in range(20)}
