"""Canonical text, content hashes and answer comparison as column functions.

All of it runs in the JVM but Unicode composition, for which Spark has no built-in: an Arrow function that passes
ASCII through.  NULL text counts as empty everywhere.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from tamis.functions.text import WS

#: Words that carry no content.
STOPWORDS = """
a an the
is are was were be been being am
do does did doing done
will would shall should can could may might must
have has had having
of in on at to for with by from into onto upon about
and or but so yet if then than
that this these those
it its they them their theirs
he she him her his hers
we us our you your i me my
""".split()
#: Invisible characters, dashes and minus signs.
INVISIBLE = "­​‌‍‎‏⁠﻿"
DASHES = "‐‑‒–—―−"
#: Typographic quotes, primes and the ellipsis, which count as ASCII punctuation.
QUOTES = "‘’‚‛′‵“”„‟″‶…"
CONFLICT, UNANSWERED = "__answer_conflict__", "__unanswered__"
STRICT, LOOSE = rf"[^\p{{L}}\p{{N}}{WS}+*/=<>^%~\-]", rf"[\x{{00}}-\x{{7f}}&&[^a-z0-9{WS}+*/=<>^%~\-]]|[{QUOTES}]"


def _compose(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def nfc(text: Column | str) -> Column:
    """Composed text."""
    return F.pandas_udf(_compose, "string")(text)


def _composed(text: pd.Series, answer: pd.Series, options: pd.Series) -> pd.DataFrame:
    one = lambda t: "" if t is None else t if t.isascii() else unicodedata.normalize("NFC", t)
    every = lambda o: None if o is None else [one(x) for x in o]
    return pd.DataFrame({"text": _compose(text), "answer": _compose(answer), "options": options.map(every)})


def composed(text: Column | str, answer: Column | str, options: Column | str) -> Column:
    """Composed (text, answer, options) by one call; a NULL option is an empty one."""
    return F.pandas_udf(_composed, "text string, answer string, options array<string>")(text, answer, options)


def _plain(text: Column, dropped: str) -> Column:
    t = F.regexp_replace(F.coalesce(text, F.lit("")), f"[{INVISIBLE}]", "")
    t = F.lower(F.translate(t, DASHES, "-" * len(DASHES)))
    return F.trim(F.regexp_replace(F.regexp_replace(t, dropped, ""), rf"[{WS}]+", " "))


def canonical(text: Column) -> Column:
    """Lower case, letters, digits and ``+-*/=<>^%~``, single spaces; expects composed text."""
    return _plain(text, STRICT)


def sorted_options(options: Column) -> Column:
    return F.array_sort(F.transform(F.coalesce(options, F.array().cast("array<string>")), canonical))


def json_list(items: Column) -> Column:
    """Canonical texts as a JSON list; they hold nothing that JSON escapes."""
    return F.when(F.size(items) == 0, "[]").otherwise(F.concat(F.lit('["'), F.array_join(items, '", "'), F.lit('"]')))


def strip_number(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), rf"^[{WS}]*\p{{Nd}}+[{WS}]*[.)][{WS}]*", "")


def canonical_stem(text: Column) -> Column:
    return F.regexp_replace(canonical(strip_number(text)), r"\s+(%)", "$1")


def identity_of(stem: Column, options: Column) -> Column:
    """sha256 of a canonical stem and sorted canonical options."""
    return F.sha2(F.concat(F.lit('{"opts": '), json_list(options), F.lit(', "stem": "'), stem, F.lit('"}')), 256)


def identity(text: Column, options: Column) -> Column:
    return identity_of(canonical_stem(text), sorted_options(options))


def content_words(text: Column) -> Column:
    """Distinct ASCII words without stop words, sorted."""
    words = F.regexp_extract_all(canonical(text), F.lit("([a-z0-9]+)"), F.lit(1))
    return F.array_sort(F.array_except(F.array_distinct(words), F.array(*[F.lit(w) for w in STOPWORDS])))


def legacy_identity_of(words: Column, options: Column) -> Column:
    """The older identity, of content words and sorted canonical options."""
    return F.sha2(F.concat(F.lit('{"cw": '), json_list(words), F.lit(', "opts": '), json_list(options), F.lit("}")), 256)


def legacy_identity(text: Column, options: Column) -> Column:
    return legacy_identity_of(content_words(text), sorted_options(options))


def source_question_key(number: Column, text: Column, options: Column) -> Column:
    """The printed number where there is one, else the content."""
    n = F.trim(F.coalesce(number.cast("string"), F.lit("")))
    return F.when(n != "", F.concat(F.lit("n:"), n)).otherwise(F.concat(F.lit("i:"), legacy_identity(strip_number(text), options)))


def location_key(book: Column, subtopic: Column) -> Column:
    return F.sha2(F.concat(F.lit('["'), canonical(book), F.lit('","'), canonical(subtopic), F.lit('"]')), 256)


def canonical_answer(text: Column) -> Column:
    """Answer text without spaces and without hyphens between letters; symbols beyond ASCII stay."""
    t = F.regexp_replace(_plain(text, LOOSE), r"\s*-\s*", "-")
    return F.replace(F.regexp_replace(t, "(?<=[a-z])-(?=[a-z])", ""), F.lit(" "), F.lit(""))


def indexed_option(index: Column, options: Column) -> Column:
    """The option at the index; NULL where there is none."""
    valid = F.coalesce((index >= 0) & (index < F.size(options)) & options.isNotNull(), F.lit(False))
    return F.when(valid, F.coalesce(F.get(options, index), F.lit("")))


def answer_of(text: Column, said: Column, index: Column, by_index: Column) -> Column:
    """The verified answer from a text, its canonical form, the index, and the canonical option there."""
    given = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), rf"[{WS}]+", " ")) != ""
    return (
        F.when(index.isNotNull() & by_index.isNull(), CONFLICT)
        .when(given & by_index.isNotNull() & (said != by_index), CONFLICT)
        .when(given, said)
        .otherwise(F.coalesce(by_index, F.lit(UNANSWERED)))
    )


def answer_identity(text: Column, index: Column, options: Column) -> Column:
    """The verified answer of a record, or a sentinel where text, index and options disagree or say nothing."""
    option = indexed_option(index, options)
    return answer_of(text, canonical_answer(text), index, F.when(option.isNotNull(), canonical_answer(option)))


def _usable(a: Column, b: Column) -> Column:
    return F.coalesce((a != "") & (b != "") & ~a.startswith("__") & ~b.startswith("__"), F.lit(False))


def answers_equivalent(a: Column, b: Column) -> Column:
    """Equal, or a misspelling: all but letters equal, same ends, 5 letters or more, 1 edit (2 from 9 letters)."""
    x, y = (F.regexp_replace(c, "[^a-z]", "") for c in (a, b))
    rest = F.regexp_replace(a, "[a-z]", "") == F.regexp_replace(b, "[a-z]", "")
    limit = F.when(F.greatest(F.length(x), F.length(y)) >= 9, 2).otherwise(1)
    typo = (F.least(F.length(x), F.length(y)) >= 5) & (F.left(x, F.lit(1)) == F.left(y, F.lit(1))) & (F.right(x, F.lit(1)) == F.right(y, F.lit(1))) & (F.levenshtein(x, y) <= limit)
    return _usable(a, b) & ((a == b) | rest & ((x == y) | typo))


def answer_similarity(a: Column, b: Column) -> Column:
    return F.when(_usable(a, b), 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b))).otherwise(0.0)


def answers_mergeable(a: Column, b: Column, threshold: float = 0.8) -> Column:
    ends = (F.left(a, F.lit(1)) == F.left(b, F.lit(1))) & (F.right(a, F.lit(1)) == F.right(b, F.lit(1)))
    return answers_equivalent(a, b) | _usable(a, b) & ends & (answer_similarity(a, b) >= threshold)


def quality_score(explanation: Column, options: Column, length: Column) -> Column:
    n = F.coalesce(F.size(options), F.lit(0))
    return (
        F.when(F.trim(F.regexp_replace(F.coalesce(explanation, F.lit("")), rf"[{WS}]+", " ")) != "", 20.0).otherwise(0.0)
        + F.when(n == 4, 10.0).when(n == 3, 5.0).when(n >= 5, 8.0).otherwise(0.0)
        + F.when(F.coalesce(length, F.lit(0)).between(40, 200), 3.0).otherwise(0.0)
    )


def trigrams(text: Column) -> Column:
    """Distinct padded trigrams of the words of a text."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(F.flatten(F.transform(padded, lambda p: F.transform(F.sequence(F.lit(1), F.length(p) - 2), lambda i: F.substring(p, i, F.lit(3))))))


def set_similarity(a: Column, b: Column) -> Column:
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union > 0, common / union).otherwise(0.0)


def qid_hash(qid: Column) -> Column:
    return F.conv(F.left(F.md5(qid.cast("string")), F.lit(8)), 16, 10).cast("bigint")


def pad(text: Column, n: int) -> Column:
    """Zero-padded to n characters; longer texts stay whole."""
    return F.when(F.length(text) < n, F.lpad(text, n, "0")).otherwise(text)


def safe_filename(name: Column) -> Column:
    t = F.regexp_replace(F.trim(F.regexp_replace(name, r'[<>:"/\\|?*\x{00}-\x{1f}]', "_")), r"^[.]+|[.]+$", "")
    return F.when(t == "", "unnamed").otherwise(t)
