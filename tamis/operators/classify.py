"""Keyword classification: greedy cover of matched phrases, abstaining on ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions.canon import STOPWORDS


def normal(text: Column) -> Column:
    """Lower case ASCII words with - and /, single spaces, a space at both ends."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^a-z0-9\s\-/]", " "), r"\s+", " ")), F.lit(" "))


def dictionary(df: DataFrame) -> DataFrame:
    """(chapter_id, code, keyword) -> with phrase and weight; repeated and contentless keywords are dropped."""
    phrase = F.trim(normal(F.col("keyword")))
    tokens = F.filter(F.split(phrase, " "), lambda t: (t != "") & ~t.isin(STOPWORDS))
    d = df.select("chapter_id", "code", phrase.alias("phrase"), F.size(tokens).alias("weight")).where("weight > 0 AND phrase <> ''")
    return d.dropDuplicates(["chapter_id", "code", "phrase"])


def cover(spans: Column) -> Column:
    """Score of spans (start, -end, weight): in order, a span scores if it begins where the covered part ends or later."""
    zero = F.struct(F.lit(0).alias("score"), F.lit(-1).alias("to"))
    step = lambda acc, s: F.struct(
        (acc["score"] + F.when(s["start"] >= acc["to"], s["weight"]).otherwise(0)).alias("score"),
        F.greatest(acc["to"], -s["neg_end"]).alias("to"),
    )
    return F.aggregate(F.array_sort(spans), zero, step)["score"]


def scores(questions: DataFrame, words: DataFrame) -> DataFrame:
    """questions (id, chapter_id, question_text), words from ``dictionary`` -> (id, chapter_id, code, score).

    A phrase is looked up by its words: the text's runs of 1..k words (k the longest phrase) meet the dictionary in an
    equi-join on (chapter, phrase), so texts and dictionary are never compared pair by pair.
    """
    longest = words.agg(F.max(F.size(F.split("phrase", " "))).alias("k")).first()["k"] or 0
    t = questions.select("id", "chapter_id", F.split(F.trim(normal(F.col("question_text"))), " ").alias("w"))
    i = F.explode(F.sequence(F.lit(1), F.size("w"))).alias("i")
    at = t.select("id", "chapter_id", "w", i).select("id", "chapter_id", "w", "i", (F.length(F.array_join(F.slice("w", 1, F.col("i") - 1), " ")) + F.when(F.col("i") > 1, 1).otherwise(0)).alias("start"))
    runs = [at.where(F.size("w") >= F.col("i") + k - 1).select("id", "chapter_id", F.array_join(F.slice("w", F.col("i"), F.lit(k)), " ").alias("phrase"), "start") for k in range(1, longest + 1)]
    if not runs:
        return questions.select("id", "chapter_id", F.lit(None).cast("string").alias("code"), F.lit(0).alias("score")).limit(0)
    every = runs[0]
    for r in runs[1:]:
        every = every.unionByName(r)
    hit = every.join(words, ["chapter_id", "phrase"])
    span = F.struct(F.col("start").cast("int").alias("start"), (-(F.col("start") + F.length("phrase"))).cast("int").alias("neg_end"), F.col("weight").cast("int").alias("weight"))
    return hit.groupBy("id", "chapter_id", "code").agg(cover(F.collect_list(span)).alias("score"))


def classify(questions: DataFrame, words: DataFrame, sentinel: str = "mixedqn") -> DataFrame:
    """(id, code, score, decided): the best code, or the sentinel where none scores or the best two tie."""
    s = scores(questions, words)
    best = s.groupBy("id").agg(F.max("score").alias("score"), F.max_by("code", F.struct("score", "code")).alias("code"), F.array_sort(F.collect_list("score")).alias("all"))
    tie = F.coalesce(F.try_element_at("all", F.lit(-2)) == F.col("score"), F.lit(False))
    out = questions.select("id").join(best.select("id", "score", "code", tie.alias("tie")), "id", "left")
    ok = (F.coalesce("score", F.lit(0)) > 0) & ~F.coalesce("tie", F.lit(True))
    return out.select("id", F.when(ok, F.col("code")).otherwise(sentinel).alias("code"), F.coalesce("score", F.lit(0)).alias("score"), ok.alias("decided"))


def second_stage(undecided: DataFrame, model, batch: int = 8) -> DataFrame:
    """(id, text) -> (id, code, confidence) by a callable from a list of texts to (code, confidence) pairs, in batches."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            out = [r for i in range(0, len(pdf), batch) for r in model([*pdf["text"].iloc[i : i + batch]])]
            yield pd.DataFrame({"id": pdf["id"], "code": [c for c, _ in out], "confidence": [float(p) for _, p in out]})

    return undecided.select("id", "text").mapInPandas(run, "id bigint, code string, confidence double")
