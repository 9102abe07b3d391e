from datetime import datetime

from tamis.llm import queries, survivors


def test_p1_found_runs_no_model_that_cannot_change_it(spark, tmp_path, monkeypatch):
    def never(*_):
        raise AssertionError("the rule needs no model")

    monkeypatch.setattr(survivors, "judge", never)
    q = [(1, None, 5.0, "x", "--", 30), (2, datetime(2024, 1, 1), None, "...", "b", 31), (3, None, 9.0, None, "c", 31), (7, None, None, None, "", 30), (8, None, 1.0, "?", None, 30)]
    spark.createDataFrame(q, "id bigint, corrected_at timestamp, quality_score float, explanation string, correct_text string, file_ref_id bigint").write.parquet(f"{tmp_path}/questions.parquet")
    d = [(1, 1, 2, None, None), (2, 1, 3, None, None), (3, 8, 7, None, None)]
    spark.createDataFrame(d, "id bigint, canonical_id bigint, deleted_id bigint, snapshot string, merged_at timestamp").write.parquet(f"{tmp_path}/dedup_deletions.parquet")
    assert sorted(map(tuple, queries.QUERIES["p1_found"](spark, str(tmp_path)).collect())) == [(1, 2, 1, 2), (7, 8, -1, -1)]
