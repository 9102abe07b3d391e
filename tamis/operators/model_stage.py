"""The second stage of classification: questions as prompts, a model's reply read leniently, codes made valid, a fallback.

The model is a callable from a list of prompts to a list of replies, so the stage runs with any provider, or a stub.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.operators import classify

SENTINEL = "mixedqn"
#: Names under which replies hold the list of answers, a code, a confidence, and the number of a question.
WRAPPERS = ("answers", "result", "results", "questions", "mapping", "response")
CODES, CONFIDENCES, NUMBERS = ("code", "subtopic", "answer", "label"), ("conf", "confidence"), ("q", "question", "number", "id")


def question_block(number: Column, text: Column, options: Column) -> Column:
    """A question as lines: its number and text, then a lettered line for each option."""
    lines = F.transform(F.coalesce(options, F.array().cast("array<string>")), lambda o, i: F.concat(F.lit("    "), F.char(F.lit(65) + i), F.lit(") "), F.trim(F.coalesce(o, F.lit("")))))
    head = F.concat(F.lit("Q"), number.cast("string"), F.lit(". "), F.trim(F.coalesce(text, F.lit(""))))
    return F.array_join(F.concat(F.array(head), lines), "\n")


def read_reply(reply: str | None) -> object | None:
    """The JSON value of a reply: all of it, what a code fence holds, or the first object or list inside; None if there is none."""
    if reply is None:
        return None
    text = re.sub(r"\s*```\s*$", "", re.sub(r"^\s*```\w*\s*", "", reply)).strip()
    decoder = json.JSONDecoder()
    for at in (0, *(k for k in (text.find("{"), text.find("[")) if k > 0)):
        try:
            value, end = decoder.raw_decode(text, at)
        except ValueError:
            continue
        if at or not text[end:].strip():
            return value
    return None


def _first(item: dict, names: tuple[str, ...]) -> object | None:
    return next((item[n] for n in names if item.get(n)), None)


def answers(value: object | None) -> dict[str, tuple[str, float | None]]:
    """Number of a question -> (code, confidence), from any of the shapes that models reply in."""
    if isinstance(value, dict):
        value = next((value[w] for w in WRAPPERS if isinstance(value.get(w), (dict, list))), value)

    def confidence(item: dict) -> float | None:
        c = next((item[n] for n in CONFIDENCES if n in item), None)
        return float(c) if isinstance(c, (int, float)) else None

    out: dict[str, tuple[str, float | None]] = {}
    if isinstance(value, dict):
        for number, item in value.items():
            code = _first(item, CODES) if isinstance(item, dict) else item if isinstance(item, str) else None
            out[str(number)] = (SENTINEL if code is None else str(code), confidence(item) if isinstance(item, dict) else None)
    elif isinstance(value, list):
        plain = all(isinstance(x, str) for x in value)
        for place, item in enumerate(value, 1):
            if plain:
                out[str(place)] = (item, None)
            elif isinstance(item, dict) and (code := _first(item, CODES)) is not None:
                out[str(_first(item, NUMBERS) or place)] = (str(code), confidence(item))
    return out


def valid_code(raw: str | None, codes: dict[str, str]) -> str:
    """The code meant by a reply, of ``codes`` (code -> title): as it is, in any case, its first word, a shorter dotted
    number, its title, or the one title that holds it or is held by it; else the sentinel."""
    said = " ".join((raw or "").split())
    if not said:
        return SENTINEL
    by_case = {c.lower(): c for c in codes}
    first = re.split(r"[\s,;:]", said)[0].strip(" .,;:-")
    dotted = re.match(r"\d+(\.\d+)*", said)
    parts = dotted[0].split(".") if dotted else []
    for guess in (said, first, *(".".join(parts[:k]) for k in range(len(parts), 0, -1))):
        if guess in codes or guess.lower() in by_case:
            return guess if guess in codes else by_case[guess.lower()]
    titles = {" ".join((t or "").split()).lower(): c for c, t in codes.items()}
    titles.pop("", None)
    low = said.lower()
    if low in titles:
        return titles[low]
    near = [c for t, c in titles.items() if low in t or t in low]
    return near[0] if len(near) == 1 else SENTINEL


def fallback(questions: DataFrame, words: DataFrame, least: int = 2) -> DataFrame:
    """(id, code, confidence) by keywords in text and options, where the model abstains; ties and weak scores give NULL."""
    text = F.concat_ws(" ", "question_text", "options")
    best = classify.classify(questions.select("id", "chapter_id", text.alias("question_text")), words)
    ok = F.col("decided") & (F.col("score") >= least)
    return best.select("id", F.when(ok, F.col("code")).alias("code"), F.when(ok, F.least(F.lit(0.6), 0.25 + 0.1 * F.col("score"))).otherwise(0.0).alias("confidence"))


def run(questions: DataFrame, codes: DataFrame, model: Callable[[list[str]], list[str | None]], batch: int = 8) -> DataFrame:
    """questions (id, chapter_id, question_text, options), codes (chapter_id, code, title) -> (id, code, confidence, error).

    Questions of one chapter go to the model ``batch`` at a time with the chapter's codes, which ride along as a map of a
    few entries.  A reply without an answer for a question gives the sentinel and the error.
    """
    of_chapter = codes.groupBy("chapter_id").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("code", F.coalesce("title", F.lit("")).alias("title"))))).alias("codes"))
    rows = questions.select("id", "chapter_id", "question_text", "options").join(F.broadcast(of_chapter), "chapter_id", "left")

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, chapter in pdf.groupby("chapter_id", dropna=False, sort=False):
                known = dict(chapter["codes"].iloc[0] or {})
                for at in range(0, len(chapter), batch):
                    some = chapter.iloc[at : at + batch]
                    lines = [f"{c}: {t}" for c, t in known.items()]
                    prompt = "\n".join(["Codes:", *lines, "Questions:", *some["block"].str.replace(r"^Q0\.", "", regex=True).radd([f"Q{k}." for k in range(1, len(some) + 1)])])
                    got = answers(read_reply((model([prompt]) or [None])[0]))
                    out = [got.get(str(k)) for k in range(1, len(some) + 1)]
                    yield pd.DataFrame({
                        "id": some["id"], "code": [valid_code(o[0], known) if o else SENTINEL for o in out],
                        "confidence": [o[1] if o else None for o in out], "error": [None if o else "no answer" for o in out],
                    })

    asked = rows.select("id", "chapter_id", question_block(F.lit(0), F.col("question_text"), F.col("options")).alias("block"), "codes")
    return asked.mapInPandas(ask, "id bigint, code string, confidence double, error string")
