"""Queries over the question bank, and the SQL that checks them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tamis.functions import canon
from tamis.operators import classify, corrections, dedupe, ids, near, sync
from tamis.sources import json_files
from tamis.scratch import small
from tamis.streaming import feeds
from tamis.tables import file_chapters, live_questions, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def both(name: str, text: str, check: str | None = None) -> None:
    """A query that is SQL itself; ``{table}`` names a table.  ``check`` is its form for the other engine if that differs."""
    names = {*re.findall(r"\{(\w+)\}", text)}
    QUERIES[name] = lambda spark, d: spark.sql(text, **{n: table(spark, d, n) for n in names})
    SQL[name] = re.sub(r"\{(\w+)\}", r"\1", check or text)


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return keep


# ---------------------------------------------------------------- SQL pieces for the check

_S = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"
_IN = r"\s\p{Z}\x{1c}-\x{1f}\x{85}"


def _plain(t: str, dropped: str) -> str:
    inv = f"regexp_replace(nfc_normalize(coalesce({t}, '')), '[{canon.INVISIBLE}]', '', 'g')"
    return f"trim(regexp_replace(regexp_replace(lower(translate({inv}, '{canon.DASHES}', '{'-' * len(canon.DASHES)}')), '{dropped}', '', 'g'), '{_S}+', ' ', 'g'))"


def _canon(t: str) -> str:
    return _plain(t, rf"[^\p{{L}}\p{{N}}{_IN}+*/=<>^%~-]")


def _opts(o: str) -> str:
    return f"list_sort(list_transform(coalesce({o}, []), lambda x: {_canon('x')}))"


def _json(x: str) -> str:
    return f"""CASE WHEN len({x}) = 0 THEN '[]' ELSE '["' || array_to_string({x}, '", "') || '"]' END"""


def _strip(t: str) -> str:
    return rf"regexp_replace(nfc_normalize(coalesce({t}, '')), '^{_S}*\p{{Nd}}+{_S}*[.)]{_S}*', '')"


def _identity(t: str = "question_text", o: str = "options") -> str:
    stem = f"regexp_replace({_canon(_strip(t))}, '\\s+(%)', '\\1', 'g')"
    return f"""sha256('{{"opts": ' || {_json(_opts(o))} || ', "stem": "' || {stem} || '"}}')"""


def _answer(t: str) -> str:
    loose = _plain(t, "[\\x{00}-\\x{08}\\x{0e}-\\x{1b}\\x{7f}!\"#$&''(),.:;?@_`|{}\\[\\]\\\\\\x{2018}-\\x{201f}\\x{2026}\\x{2032}\\x{2033}\\x{2035}\\x{2036}]")
    tight = f"regexp_replace({loose}, '\\s*-\\s*', '-', 'g')"
    once = f"regexp_replace({tight}, '([a-z])-([a-z])', '\\1\\2', 'g')"
    return f"replace(regexp_replace({once}, '([a-z])-([a-z])', '\\1\\2', 'g'), ' ', '')"


_ANSWER_ID = f"""CASE WHEN correct_index IS NOT NULL AND NOT coalesce(correct_index >= 0 AND correct_index < len(options), false) THEN '__answer_conflict__'
 WHEN trim(regexp_replace(coalesce(correct_text, ''), '{_S}+', ' ', 'g')) <> '' THEN
   CASE WHEN correct_index IS NOT NULL AND {_answer('correct_text')} <> {_answer('options[correct_index + 1]')} THEN '__answer_conflict__' ELSE {_answer('correct_text')} END
 WHEN correct_index IS NOT NULL THEN {_answer('options[correct_index + 1]')} ELSE '__unanswered__' END"""

_CHAPTER = "JOIN files f ON q.file_ref_id = f.id JOIN books b ON f.book_id = b.id JOIN chapters c ON b.chapter_id = c.id"
_LIVE = f"SELECT q.*, c.id AS chapter_id FROM questions q {_CHAPTER} WHERE q.canonical_id IS NULL"
_WITH = f"WITH live AS ({_LIVE}), ident AS (SELECT *, {_identity()} AS identity, {_ANSWER_ID} AS answer FROM live)"
_QUESTION = ("id", "question_number", "question_text", "options", "correct_index", "correct_text", "explanation", "quality_score", "corrected_at", "source_question_key")


def identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.with_identity(live_questions(spark, sf_dir, *_QUESTION))


# ---------------------------------------------------------------- text


@query(f"SELECT id, {_canon('question_text')} AS canon FROM questions")
def canonical_text(spark, d):
    return table(spark, d, "questions").select("id", canon.canonical(canon.nfc("question_text")).alias("canon"))


@query(f"SELECT id, {_identity()} AS identity FROM questions")
def identity_hash(spark, d):
    return dedupe.with_identity(table(spark, d, "questions").select("id", "question_text", "options", "correct_text", "correct_index")).select("id", "identity")


_STOP = "[" + ", ".join(f"'{w}'" for w in canon.STOPWORDS) + "]"
_WORDS = lambda t: f"list_sort(list_filter(list_distinct(regexp_extract_all({_canon(t)}, '[a-z0-9]+')), lambda w: NOT list_contains({_STOP}, w)))"


@query(f"SELECT id, array_to_string({_WORDS('question_text')}, ' ') AS words, len({_WORDS('question_text')}) AS n FROM questions")
def content_words(spark, d):
    q = table(spark, d, "questions").select("id", canon.content_words(canon.nfc("question_text")).alias("w"))
    return q.select("id", F.array_join("w", " ").alias("words"), F.size("w").cast("bigint").alias("n"))


_KEY_BODY = f"""sha256('{{"cw": ' || {_json(_WORDS(_strip('question_text')))} || ', "opts": ' || {_json(_opts('options'))} || '}}')"""


@query(f"SELECT id, CASE WHEN question_number IS NOT NULL THEN 'n:' || question_number ELSE 'i:' || {_KEY_BODY} END AS source_key FROM questions")
def source_keys(spark, d):
    q = table(spark, d, "questions").select("id", "question_number", canon.composed("question_text", "correct_text", "options").alias("c"))
    return q.select("id", canon.source_question_key(F.col("question_number"), F.col("c.text"), F.col("c.options")).alias("source_key"))


@query(f"""SELECT f.id, sha256('["' || {_canon('b.book_name')} || '","' || {_canon('f.subtopic')} || '"]') AS location FROM files f JOIN books b ON f.book_id = b.id""")
def source_locations(spark, d):
    f = table(spark, d, "files").select("id", "book_id", "subtopic").join(table(spark, d, "books").select(F.col("id").alias("book_id"), "book_name"), "book_id")
    return f.select("id", canon.location_key(canon.nfc("book_name"), canon.nfc("subtopic")).alias("location"))


@query(f"SELECT id, {_ANSWER_ID} AS answer FROM questions")
def answer_key(spark, d):
    return dedupe.with_identity(table(spark, d, "questions").select("id", "question_text", "options", "correct_text", "correct_index")).select("id", "answer")


@query(f"""SELECT id, (CASE WHEN trim(regexp_replace(coalesce(explanation, ''), '{_S}+', ' ', 'g')) <> '' THEN 20.0 ELSE 0.0 END
 + CASE WHEN len(options) = 4 THEN 10.0 WHEN len(options) = 3 THEN 5.0 WHEN len(options) >= 5 THEN 8.0 ELSE 0.0 END
 + CASE WHEN coalesce(length(question_text), 0) BETWEEN 40 AND 200 THEN 3.0 ELSE 0.0 END)::DOUBLE AS score FROM questions""")
def quality_scores(spark, d):
    return table(spark, d, "questions").select("id", canon.quality_score(F.col("explanation"), F.col("options"), F.length("question_text")).alias("score"))


@query(r"""SELECT id, try_cast(nullif(regexp_extract(trim(coalesce(question_text, ''), ' '), '^(\d+)\s*[.)]\s*', 1), '') AS INT) AS number,
 trim(regexp_replace(trim(coalesce(question_text, ''), ' '), '^\d+\s*[.)]\s*', ''), ' ') AS rest FROM questions""")
def printed_numbers(spark, d):
    n, rest = json_files.number_and_text(F.col("question_text"))
    return table(spark, d, "questions").select("id", n.alias("number"), rest.alias("rest"))


_PAIRS = f"""WITH k AS (SELECT id, {_ANSWER_ID} AS answer FROM questions),
 p AS (SELECT DISTINCT c.q1_id, c.q2_id, a.answer AS a, b.answer AS b FROM dedupe_review_candidates c JOIN k a ON c.q1_id = a.id JOIN k b ON c.q2_id = b.id),
 x AS (SELECT *, a <> '' AND b <> '' AND NOT starts_with(a, '__') AND NOT starts_with(b, '__') AS ok, regexp_replace(a, '[^a-z]', '', 'g') AS la, regexp_replace(b, '[^a-z]', '', 'g') AS lb FROM p),
 y AS (SELECT *, ok AND (a = b OR (regexp_replace(a, '[a-z]', '', 'g') = regexp_replace(b, '[a-z]', '', 'g') AND (la = lb OR (least(length(la), length(lb)) >= 5
   AND left(la, 1) = left(lb, 1) AND right(la, 1) = right(lb, 1) AND levenshtein(la, lb) <= CASE WHEN greatest(length(la), length(lb)) >= 9 THEN 2 ELSE 1 END)))) AS same FROM x)
SELECT q1_id, q2_id, same FROM y"""


def _answers_of_pairs(spark, d):
    k = dedupe.with_identity(table(spark, d, "questions").select("id", "question_text", "options", "correct_text", "correct_index"))
    side = lambda q, c: k.select(F.col("id").alias(q), F.col("answer").alias(c))
    return table(spark, d, "dedupe_review_candidates").select("q1_id", "q2_id").distinct().join(side("q1_id", "a"), "q1_id").join(side("q2_id", "b"), "q2_id")


@query(_PAIRS)
def answer_pairs(spark, d):
    """Whether the answers of every candidate pair are the same but for misspellings."""
    return _answers_of_pairs(spark, d).select("q1_id", "q2_id", canon.answers_equivalent(F.col("a"), F.col("b")).alias("same"))


@query()
def answer_similarity(spark, d):
    """Similarity by characters, which the other engine counts in bytes; tests hold it against brute force."""
    a, b = F.col("a"), F.col("b")
    return _answers_of_pairs(spark, d).select("q1_id", "q2_id", canon.answer_similarity(a, b).alias("similarity"), canon.answers_mergeable(a, b).alias("mergeable"))

_TRI = lambda t: f"list_distinct(flatten(list_transform(regexp_extract_all(lower(coalesce({t}, '')), '[\\p{{L}}\\p{{N}}]+'), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


@query(f"""WITH g AS (SELECT id, {_TRI('question_text')} AS g FROM questions),
 p AS (SELECT DISTINCT q1_id, q2_id FROM dedupe_review_candidates)
SELECT q1_id, q2_id, round(CASE WHEN len(a.g) + len(b.g) = 0 THEN 0.0 ELSE len(list_intersect(a.g, b.g))::DOUBLE / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) END, 6)::DOUBLE AS similarity
FROM p JOIN g a ON q1_id = a.id JOIN g b ON q2_id = b.id""")
def trigram_scores(spark, d):
    g = table(spark, d, "questions").select("id", canon.trigrams(F.col("question_text")).alias("g"))
    side = lambda q, c: g.select(F.col("id").alias(q), F.col("g").alias(c))
    p = table(spark, d, "dedupe_review_candidates").select("q1_id", "q2_id").distinct().join(side("q1_id", "a"), "q1_id").join(side("q2_id", "b"), "q2_id")
    return p.select("q1_id", "q2_id", F.round(canon.set_similarity(F.col("a"), F.col("b")), 6).alias("similarity"))


_TRI_PAIRS = f"""WITH g AS (SELECT id, {_TRI('question_text')} AS g FROM questions), n AS (SELECT id, len(g) AS n, unnest(g) AS t FROM g),
 p AS (SELECT a.id AS a, b.id AS b, count(*) AS c, any_value(a.n + b.n) AS s FROM n a JOIN n b ON a.t = b.t AND a.id < b.id AND a.n >= 0.9 * b.n - 1e-9 AND b.n >= 0.9 * a.n - 1e-9 GROUP BY 1, 2)
SELECT a, b, c::DOUBLE / (s - c) AS similarity FROM p WHERE c::DOUBLE / (s - c) >= 0.9 - 1e-12"""


@query(_TRI_PAIRS)
def trigram_pairs(spark, d):
    """All pairs of questions with trigram similarity of 0.9 or more, over the whole table."""
    return near.trigram_pairs(table(spark, d, "questions").select("id", "question_text"), "id", "question_text", 0.9)


@query(f"SELECT round(similarity, 2) AS similarity, count(*) AS pairs FROM ({_TRI_PAIRS}) GROUP BY 1")
def trigram_histogram(spark, d):
    return trigram_pairs(spark, d).groupBy(F.round("similarity", 2).alias("similarity")).agg(F.count("*").alias("pairs"))


@query(
    r"""SELECT DISTINCT c.q1_id, c.q2_id, CASE WHEN coalesce(a.correct_text, '') = '' OR coalesce(b.correct_text, '') = '' THEN 'none'
 WHEN lower(regexp_replace(a.correct_text, '[^\p{L}\p{N}]+', ' ', 'g')) = lower(regexp_replace(b.correct_text, '[^\p{L}\p{N}]+', ' ', 'g')) THEN 'same' ELSE 'CONFLICT' END AS answer
FROM dedupe_review_candidates c JOIN questions a ON c.q1_id = a.id JOIN questions b ON c.q2_id = b.id"""
)
def pair_answer_status(spark, d):
    q = table(spark, d, "questions").select("id", F.coalesce("correct_text", F.lit("")).alias("t"))
    side = lambda k, c: q.select(F.col("id").alias(k), F.col("t").alias(c))
    p = table(spark, d, "dedupe_review_candidates").select("q1_id", "q2_id").distinct().join(side("q1_id", "a"), "q1_id").join(side("q2_id", "b"), "q2_id")
    return p.select("q1_id", "q2_id", near.answer_status(F.col("a"), F.col("b")).alias("answer"))


def _near_duplicates(spark, d):
    """Near duplicates among all questions with a chapter, merged ones too."""
    chapters = small(file_chapters(spark, d), table(spark, d, "files").count())
    c = table(spark, d, "chapters").select(F.col("id").alias("chapter_id"), F.col("level_id").alias("level"), "chapter_key")
    q = table(spark, d, "questions").select("id", "file_ref_id", "question_text", "options", "correct_text")
    return near.near_duplicates(q.join(chapters, "file_ref_id").join(F.broadcast(c), "chapter_id"))


@query()
def near_duplicates(spark, d):
    """All pairs of like text and options, of all chapters, with the status of their answers; stored or not."""
    of = lambda c, name: [F.col(f"{s}_{c}").alias(f"{name}_{s}") for s in "ab"]
    return _near_duplicates(spark, d).select(
        F.col("a").alias("id_a"), F.col("b").alias("id_b"), *of("level", "level"), *of("chapter_key", "chapter"), (F.col("a_chapter_id") == F.col("b_chapter_id")).alias("same_chapter"),
        F.round("q_sim", 3).alias("q_sim"), F.round("opt_sim", 3).alias("opt_sim"), "answer", *of("question_text", "question"), *of("options", "options"),
    )


@query()
def near_duplicate_summary(spark, d):
    """Near duplicates at the usual thresholds of text and options."""
    at = lambda q, o: (F.col("q_sim") >= q - 1e-12) & (F.col("opt_sim") >= o - 1e-12)
    counts = [F.count_if(at(x / 100, x / 100)).alias(f"pairs_{x}_{x}") for x in (90, 95, 99)]
    return _near_duplicates(spark, d).agg(*counts, F.count_if(at(0.99, 0.9) & (F.col("a_chapter_id") == F.col("b_chapter_id"))).alias("same_chapter_99"))


@query()
def near_duplicate_chapters(spark, d):
    """Near duplicates in two files of one chapter, counted by chapter."""
    n = _near_duplicates(spark, d).where("a_chapter_id = b_chapter_id AND a_file_ref_id <> b_file_ref_id")
    return n.groupBy(F.col("a_chapter_key").alias("chapter_key"), F.col("a_level").alias("level")).agg(F.count("*").alias("duplicate_pairs"))


# ---------------------------------------------------------------- exact duplicates


@query(f"{_WITH} SELECT chapter_id, identity, count(*) AS n, count(DISTINCT answer) AS answers FROM ident GROUP BY ALL HAVING count(*) > 1")
def exact_dup_groups(spark, d):
    return dedupe.groups(identified(spark, d))


@query(f"{_WITH}, g AS (SELECT chapter_id, identity, count(*) AS n, count(DISTINCT answer) AS k FROM ident GROUP BY ALL HAVING count(*) > 1) SELECT count(*) AS dup_groups, sum(n - 1)::BIGINT AS extra, count(*) FILTER (WHERE k > 1) AS conflicts FROM g")
def dup_summary(spark, d):
    return dedupe.groups(identified(spark, d)).agg(F.count("*").alias("dup_groups"), F.sum(F.col("n") - 1).alias("extra"), F.count_if(F.col("answers") > 1).alias("conflicts"))


_PLAN = f"""{_WITH}, r AS (SELECT *, first_value(id) OVER w AS keeper_id, count(*) OVER (PARTITION BY chapter_id, identity, answer) AS n FROM ident WHERE NOT starts_with(answer, '__')
 WINDOW w AS (PARTITION BY chapter_id, identity, answer ORDER BY coalesce(epoch_us(corrected_at), 0) DESC, coalesce(quality_score, 0) DESC, id))"""


@query(f"{_PLAN} SELECT chapter_id, identity, keeper_id, id AS duplicate_id FROM r WHERE n > 1 AND id <> keeper_id")
def merge_plan(spark, d):
    return dedupe.merge_plan(identified(spark, d))


@query(f"{_PLAN} SELECT file_ref_id, source_question_key, identity AS identity_key, id AS deleted_question_id, keeper_id FROM r WHERE n > 1 AND id <> keeper_id")
def merge_tombstones(spark, d):
    q = dedupe.with_identity(live_questions(spark, d, *_QUESTION, "file_ref_id"))
    return dedupe.tombstones(q, dedupe.merge_plan(q))


@query(f"{_PLAN}, m AS (SELECT id AS dup, keeper_id FROM r WHERE n > 1 AND id <> keeper_id) SELECT x.id, coalesce(m.keeper_id, x.qid) AS qid FROM (SELECT DISTINCT id, qid FROM reported_questions) x LEFT JOIN m ON x.qid = m.dup")
def merge_cascade(spark, d):
    """Reports repointed from merged questions to their keepers."""
    q = identified(spark, d)
    child = table(spark, d, "reported_questions").select("id", "qid").distinct()
    return dedupe.cascade(dedupe.merge_plan(q), {"reports": (child, "qid", [])})["reports"]


@query()
def merge_rejected(spark, d):
    """Pending review pairs that a merge rejects."""
    return dedupe.rejected(dedupe.merge_plan(identified(spark, d)), table(spark, d, "dedupe_review_candidates").select("id", "q1_id", "q2_id", "status"))


@query()
def merge_cleared(spark, d):
    """Questions whose canonical_id names a merged question and is cleared."""
    return dedupe.cleared(dedupe.merge_plan(identified(spark, d)), table(spark, d, "questions").select("id", "canonical_id"))


@query()
def merge_audit(spark, d):
    """The audit row of every merge."""
    return dedupe.audit(dedupe.merge_plan(identified(spark, d)), table(spark, d, "questions"))


@query(f"{_PLAN} SELECT count(*) AS merges, greatest(500, 0.05 * (SELECT count(*) FROM ident))::DOUBLE AS cap, count(*) <= greatest(500, 0.05 * (SELECT count(*) FROM ident)) AS allowed FROM r WHERE n > 1 AND id <> keeper_id")
def merge_guard(spark, d):
    q = identified(spark, d)
    live = q.agg(F.count("*").alias("live"))
    m = dedupe.merge_plan(q).agg(F.count("*").alias("merges"))
    cap = F.greatest(F.lit(500.0), F.col("live") * 0.05)
    return m.join(live).select("merges", cap.alias("cap"), (F.col("merges") <= cap).alias("allowed"))


@query("""WITH RECURSIVE w(id, root, hops) AS (SELECT id, coalesce(canonical_id, id), CASE WHEN canonical_id IS NULL THEN 0 ELSE 1 END FROM questions
 UNION ALL SELECT w.id, q.canonical_id, w.hops + 1 FROM w JOIN questions q ON q.id = w.root AND q.canonical_id IS NOT NULL WHERE w.hops BETWEEN 1 AND 10),
 z AS (SELECT id, max(hops) AS hops, arg_max(root, hops) AS root FROM w GROUP BY id)
SELECT id, CASE WHEN hops > 10 THEN NULL ELSE root END AS root, hops FROM z""")
def canonical_resolve(spark, d):
    return dedupe.resolve(table(spark, d, "questions").select("id", F.col("canonical_id").alias("target")))


@query()
def near_candidates(spark, d):
    return near.candidates(identified(spark, d))


@query("""WITH o AS (SELECT least(q1_id, q2_id) AS q1_id, greatest(q1_id, q2_id) AS q2_id, stem_score, row_number() OVER (PARTITION BY least(q1_id, q2_id), greatest(q1_id, q2_id) ORDER BY created_at DESC NULLS LAST, id DESC) AS k
 FROM dedupe_review_candidates WHERE q1_id <> q2_id AND lower(trim(status)) = 'pending') SELECT q1_id, q2_id, stem_score FROM o WHERE k = 1""")
def pending_candidates(spark, d):
    """Pending pairs of different questions, however turned, with the score of the newest row; rows without a time are the oldest."""
    c = table(spark, d, "dedupe_review_candidates").where("q1_id <> q2_id AND lower(trim(status)) = 'pending'")
    pair = c.groupBy(F.least("q1_id", "q2_id").alias("q1_id"), F.greatest("q1_id", "q2_id").alias("q2_id"))
    return pair.agg(F.max_by("stem_score", F.struct("created_at", "id")).alias("stem_score"))


# ---------------------------------------------------------------- the reviewer's questions

both("dashboard_summary", """SELECT count(*) AS total, count(*) FILTER (WHERE canonical_id IS NULL) AS live, count(*) FILTER (WHERE canonical_id IS NULL AND explanation IS NULL) AS no_explanation,
 count(*) FILTER (WHERE corrected_at IS NOT NULL) AS corrected, round(avg(CAST(quality_score AS DOUBLE)), 2) AS quality, min(created_at) AS first_at, max(created_at) AS last_at,
 (SELECT count(*) FROM {dedup_deletions}) AS merges, (SELECT count(*) FROM {files}) AS files FROM {questions}""")
both("unanswered", "SELECT id FROM {questions} WHERE canonical_id IS NULL AND correct_index IS NULL AND trim(coalesce(correct_text, '')) = ''")
both("index_issues", "SELECT id, CASE WHEN options IS NULL OR size(options) = 0 THEN 'no options' ELSE 'out of range' END AS issue FROM {questions} WHERE canonical_id IS NULL AND (options IS NULL OR size(options) = 0 OR correct_index < 0 OR correct_index >= size(options))",
     "SELECT id, CASE WHEN options IS NULL OR len(options) = 0 THEN 'no options' ELSE 'out of range' END AS issue FROM questions WHERE canonical_id IS NULL AND (options IS NULL OR len(options) = 0 OR correct_index < 0 OR correct_index >= len(options))")
both("orphan_probes", """SELECT 'question_file' AS edge, count(*) AS n FROM {questions} q WHERE file_ref_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {files} f WHERE f.id = q.file_ref_id)
 UNION ALL SELECT 'file_book', count(*) FROM {files} f WHERE book_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {books} b WHERE b.id = f.book_id)
 UNION ALL SELECT 'book_chapter', count(*) FROM {books} b WHERE chapter_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {chapters} c WHERE c.id = b.chapter_id)
 UNION ALL SELECT 'report_question', count(*) FROM {reported_questions} r WHERE qid IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {questions} q WHERE q.id = r.qid)
 UNION ALL SELECT 'canonical', count(*) FROM {questions} a WHERE canonical_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {questions} q WHERE q.id = a.canonical_id)""")
both("issues_verdict", """WITH checks AS (SELECT 'text' AS name, 'FAIL' AS level, count(*) FILTER (WHERE question_text IS NULL OR trim(question_text) = '') AS n FROM {questions}
 UNION ALL SELECT 'no_file', 'WARN', count(*) FILTER (WHERE file_ref_id IS NULL) FROM {questions}
 UNION ALL SELECT 'self_pointer', 'FAIL', count(*) FILTER (WHERE canonical_id = id) FROM {questions}
 UNION ALL SELECT 'no_score', 'WARN', count(*) FILTER (WHERE quality_score IS NULL) FROM {questions}
 UNION ALL SELECT 'self_pair', 'WARN', count(*) FILTER (WHERE q1_id = q2_id) FROM {dedupe_review_candidates}
 UNION ALL SELECT 'no_snapshot', 'WARN', count(*) FILTER (WHERE snapshot IS NULL) FROM {dedup_deletions})
SELECT name, n, CASE WHEN n = 0 THEN 'PASS' ELSE level END AS verdict FROM checks""")
both("report_facets", "SELECT coalesce(status, '') AS status, coalesce(reason, '') AS reason, count(*) AS n, count(DISTINCT uid) AS users FROM {reported_questions} GROUP BY coalesce(status, ''), coalesce(reason, '')")
both("search_page", """SELECT id, question_text, quality_score FROM {questions} WHERE canonical_id IS NULL AND (question_text ILIKE '%handbook%' OR explanation ILIKE '%handbook%')
 ORDER BY quality_score DESC NULLS LAST, id LIMIT 50 OFFSET 50""")
both("keyset_page", """SELECT chapter_id, id FROM {books} WHERE struct(chapter_id, id) > struct(CAST(3 AS BIGINT), CAST(30 AS BIGINT)) ORDER BY chapter_id, id LIMIT 20""", "SELECT chapter_id, id FROM books WHERE (chapter_id, id) > (3, 30) ORDER BY chapter_id, id LIMIT 20")
both("level_breakdown", """SELECT c.level_id, count(DISTINCT c.id) AS chapters, count(DISTINCT b.id) AS books, count(DISTINCT f.id) AS files, count(DISTINCT q.id) AS questions
FROM {chapters} c LEFT JOIN {books} b ON b.chapter_id = c.id LEFT JOIN {files} f ON f.book_id = b.id LEFT JOIN {questions} q ON q.file_ref_id = f.id GROUP BY c.level_id""")
both("largest_file", """WITH n AS (SELECT b.chapter_id, f.id AS file_ref_id, count(q.id) AS n FROM {files} f JOIN {books} b ON f.book_id = b.id JOIN {questions} q ON q.file_ref_id = f.id WHERE q.canonical_id IS NULL GROUP BY b.chapter_id, f.id)
SELECT chapter_id, max_by(file_ref_id, struct(n, file_ref_id)) AS file_ref_id, max(n) AS n FROM n GROUP BY chapter_id""",
     """WITH n AS (SELECT b.chapter_id, f.id AS file_ref_id, count(q.id) AS n FROM files f JOIN books b ON f.book_id = b.id JOIN questions q ON q.file_ref_id = f.id WHERE q.canonical_id IS NULL GROUP BY b.chapter_id, f.id)
SELECT chapter_id, arg_max(file_ref_id, (n, file_ref_id)) AS file_ref_id, max(n) AS n FROM n GROUP BY chapter_id""")  # fmt: skip
both("loose_conflicts", f"""WITH q AS (SELECT q.id, b.chapter_id, q.identity_key, lower(regexp_replace(q.correct_text, '\\\\s+', '')) AS answer FROM {{questions}} q JOIN {{files}} f ON q.file_ref_id = f.id JOIN {{books}} b ON f.book_id = b.id WHERE q.canonical_id IS NULL AND identity_key IS NOT NULL)
SELECT chapter_id, identity_key, count(*) AS n FROM q GROUP BY chapter_id, identity_key HAVING count(DISTINCT CASE WHEN answer <> '' THEN answer END) > 1""",
     r"""WITH q AS (SELECT q.id, b.chapter_id, q.identity_key, lower(regexp_replace(q.correct_text, '\s+', '', 'g')) AS answer FROM questions q JOIN files f ON q.file_ref_id = f.id JOIN books b ON f.book_id = b.id WHERE q.canonical_id IS NULL AND identity_key IS NOT NULL)
SELECT chapter_id, identity_key, count(*) AS n FROM q GROUP BY chapter_id, identity_key HAVING count(DISTINCT CASE WHEN answer <> '' THEN answer END) > 1""")  # fmt: skip
@query("""SELECT id, chapter_key, row_number() OVER (ORDER BY level_id, regexp_full_match(chapter_key, '\\d+(\\.\\d+)*') DESC NULLS LAST, list_transform(string_split(chapter_key, '.'), lambda x: try_cast(x AS INT)), chapter_key, id) AS natural_place,
 row_number() OVER (ORDER BY level_id, length(chapter_key) - length(replace(chapter_key, '.', '')), chapter_key, id) AS export_place FROM chapters""")
def chapter_order(spark, d):
    """Chapters of a level by the numbers of their key (1.2 before 1.10; keys that are no numbers last), and in export order."""
    c = table(spark, d, "chapters").select("id", "chapter_key", "level_id")
    numbers = F.transform(F.split("chapter_key", r"\\."), lambda x: x.try_cast("int"))
    other = ~F.coalesce(F.col("chapter_key").rlike(r"^\\d+(\\.\\d+)*$"), F.lit(False))
    dots = F.length("chapter_key") - F.length(F.replace("chapter_key", F.lit("."), F.lit("")))
    place = lambda *by: F.row_number().over(Window.partitionBy("level_id").orderBy(*by))
    before = c.groupBy("level_id").agg(F.count("*").alias("n"))
    before = before.join(before.select(F.col("level_id").alias("lower"), F.col("n").alias("m")), F.col("lower") < F.col("level_id"), "left").groupBy("level_id").agg(F.coalesce(F.sum("m"), F.lit(0)).alias("before"))
    out = c.join(F.broadcast(before), "level_id")
    natural, export = place(other, numbers, "chapter_key", "id"), place(dots, "chapter_key", "id")
    return out.select("id", "chapter_key", (F.col("before") + natural).alias("natural_place"), (F.col("before") + export).alias("export_place"))


# ---------------------------------------------------------------- reports and corrections

_LAST = "(SELECT * FROM reported_questions QUALIFY row_number() OVER (PARTITION BY id ORDER BY migrated_at DESC NULLS LAST, resolved_at DESC NULLS LAST, status DESC NULLS LAST) = 1)"


def last_reports(spark, d):
    r = table(spark, d, "reported_questions").select("id", "uid", "qid", "status", "reported_at", "resolved_at", "migrated_at", "backend_dirty")
    return dedupe.latest(r, "id", F.coalesce("migrated_at", F.timestamp_micros(F.lit(0))), F.coalesce("resolved_at", F.timestamp_micros(F.lit(0))), F.coalesce("status", F.lit("")))


@query(f"SELECT id, qid, status, resolved_at FROM {_LAST}")
def reports_latest(spark, d):
    return last_reports(spark, d).select("id", "qid", "status", "resolved_at")


@query(f"""WITH a AS (SELECT question_id, max(created_at) AS corrected_at FROM admin_corrections WHERE reverted_at IS NULL AND question_id IS NOT NULL GROUP BY 1)
SELECT r.id, a.corrected_at FROM {_LAST} r JOIN a ON r.qid = a.question_id WHERE r.status = 'open' AND (r.reported_at IS NULL OR a.corrected_at >= r.reported_at)""")
def reports_reconcile(spark, d):
    """Open reports that a later correction of their question settles."""
    a = table(spark, d, "admin_corrections").where("reverted_at IS NULL AND question_id IS NOT NULL").groupBy(F.col("question_id").alias("qid")).agg(F.max("created_at").alias("corrected_at"))
    r = last_reports(spark, d).where("status = 'open'").join(a, "qid")
    return r.where("reported_at IS NULL OR corrected_at >= reported_at").select("id", "corrected_at")


@query(f"SELECT id, (row_number() OVER (ORDER BY reported_at NULLS FIRST, id) - 1) // 200 AS batch FROM {_LAST} WHERE backend_dirty")
def push_batches(spark, d):
    return feeds.push_batches(last_reports(spark, d).where("backend_dirty").select("id", "reported_at"), [F.col("reported_at").asc_nulls_first(), F.col("id")]).select("id", "batch")


@query("""WITH a AS (SELECT id, question_id AS qid, json_extract_string(before_snapshot, '$.question') AS text, before_identity_key AS key FROM admin_corrections),
 t AS (SELECT a.id, 0 AS rank, 'id' AS tier, count(DISTINCT q.id) AS n, min(q.id) AS r FROM a JOIN questions q ON q.id = a.qid GROUP BY a.id
  UNION ALL SELECT a.id, 1, 'identity', count(DISTINCT q.id), min(q.id) FROM a JOIN questions q ON q.identity_key = a.key GROUP BY a.id
  UNION ALL SELECT a.id, 2, 'text', count(DISTINCT q.id), min(q.id) FROM a JOIN questions q ON q.question_text = a.text GROUP BY a.id),
 b AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY id ORDER BY rank) = 1)
SELECT a.id AS edit_id, tier, CASE WHEN n = 1 THEN r END AS record_id, CASE WHEN tier IS NULL THEN 'no_match' WHEN n > 1 THEN 'ambiguous' ELSE 'matched' END AS reason FROM a LEFT JOIN b ON a.id = b.id""")
def tiered_match(spark, d):
    e = table(spark, d, "admin_corrections").select(F.col("id").alias("edit_id"), F.col("question_id").alias("qid"), F.get_json_object("before_snapshot", "$.question").alias("text"), F.col("before_identity_key").alias("key"))
    r = table(spark, d, "questions").select(F.col("id").alias("record_id"), F.col("id").alias("qid"), F.col("question_text").alias("text"), F.col("identity_key").alias("key"))
    return sync.tiered_match(e, r, [("id", ["qid"]), ("identity", ["key"]), ("text", ["text"])])


@query("SELECT reason, count(*) AS n FROM (" + SQL["tiered_match"] + ") GROUP BY reason")
def backlog_reasons(spark, d):
    return tiered_match(spark, d).groupBy("reason").agg(F.count("*").alias("n"))


@query("""WITH e AS (SELECT question_id, arg_max(json_extract_string(after_snapshot, '$.question'), (created_at, json_extract_string(after_snapshot, '$.question'))) AS t FROM admin_corrections
 WHERE question_id IS NOT NULL AND created_at IS NOT NULL AND reverted_at IS NULL AND json_extract_string(after_snapshot, '$.question') IS NOT NULL GROUP BY 1)
SELECT q.id, coalesce(e.t, q.question_text) AS question_text FROM questions q LEFT JOIN e ON q.id = e.question_id""")
def alias_overlay(spark, d):
    a = table(spark, d, "admin_corrections").where("question_id IS NOT NULL AND created_at IS NOT NULL AND reverted_at IS NULL").select(F.col("question_id").alias("id"), F.get_json_object("after_snapshot", "$.question").alias("question_text"), "created_at").where("question_text IS NOT NULL")
    return sync.overlay(table(spark, d, "questions").select("id", "question_text"), a, "id", ["question_text"], "created_at")


# corrections end to end: edits are the console's corrections, taken by the id they name or else by their content, and reports
# taken by the content of their snapshots within their file

_SNAP = "question STRING, options ARRAY<STRING>, correctIndex INT, explanation STRING"


def _edits(spark, d):
    """Corrections as edits, of the question they name by id or public id."""
    a = table(spark, d, "admin_corrections")
    b, e = F.from_json("before_snapshot", _SNAP), F.from_json("after_snapshot", _SNAP)
    a = a.select(F.col("id").alias("edit_id"), F.coalesce(F.col("question_id").cast("string"), "stable_qn_id").alias("ref"), F.lit(None).cast("string").alias("file_id"), b.alias("b"), e.alias("a"), F.col("created_at").alias("corrected_at"))
    return a.select(
        "edit_id", "ref", "file_id", F.col("b.question").alias("question_text"), F.col("b.options").alias("options"), F.col("a.question").alias("after_text"),
        F.col("a.options").alias("after_options"), F.col("a.correctIndex").alias("after_index"), F.col("a.explanation").alias("after_explanation"), "corrected_at",
    )


def _records(spark, d):
    f = table(spark, d, "files").select(F.col("id").alias("file_ref_id"), "file_id")
    cols = ("id", "stable_qn_id", "canonical_id", "source_question_key", "question_number", "question_text", "options", "corrected_at", "explanation", "source_identity", "correct_index")
    return table(spark, d, "questions").select(*cols, "file_ref_id").join(small(f, f.count()), "file_ref_id", "left").drop("file_ref_id")


_BARE = lambda t: rf"trim(regexp_replace(coalesce({t}, ''), '^\s*\d+\s*[.)]\s*', ''), ' ')"
_LEGACY = lambda t, o: f"""sha256('{{"cw": ' || {_json(_WORDS(t))} || ', "opts": ' || {_json(_opts(o))} || '}}')"""
_ROOTS = """WITH RECURSIVE w(id, root, hops) AS (SELECT id, coalesce(canonical_id, id), CASE WHEN canonical_id IS NULL THEN 0 ELSE 1 END FROM questions
 UNION ALL SELECT w.id, q.canonical_id, w.hops + 1 FROM w JOIN questions q ON q.id = w.root AND q.canonical_id IS NOT NULL WHERE w.hops BETWEEN 1 AND 10),
 z AS (SELECT id, CASE WHEN max(hops) > 10 THEN NULL ELSE arg_max(root, hops) END AS root FROM w GROUP BY id)"""
_RECORD_SQL = rf""" rec AS (SELECT q.id, f.file_id, {_identity('q.question_text', 'q.options')} AS ident, {_LEGACY('q.question_text', 'q.options')} AS legacy, {_BARE('q.question_text')} AS bare,
  coalesce(q.options, []) AS opts, q.corrected_at IS NOT NULL AS fixed, CASE WHEN q.source_question_key IS NULL THEN q.question_number::VARCHAR ELSE regexp_extract(q.source_question_key, '^n:(.*)$', 1) END AS num
  FROM questions q LEFT JOIN files f ON q.file_ref_id = f.id WHERE q.canonical_id IS NULL)"""


def _found(edit: str, on: str) -> str:
    """Per edit: records found, the least, how many of them were corrected, and the least of these."""
    return f"SELECT e.edit_id, count(DISTINCT r.id) AS n, min(r.id) AS r, count(DISTINCT r.id) FILTER (WHERE r.fixed) AS c, min(r.id) FILTER (WHERE r.fixed) AS rc FROM {edit} e JOIN rec r ON {on} GROUP BY 1"


_PICK = "CASE WHEN n = 1 THEN r WHEN c = 1 THEN rc END"
_E_SQL = rf"""e AS (SELECT id AS edit_id, coalesce(question_id::VARCHAR, trim(stable_qn_id), '') AS ref, json_extract_string(before_snapshot, '$.question') AS t,
  CAST(json_extract(before_snapshot, '$.options') AS VARCHAR[]) AS o, json_extract_string(after_snapshot, '$.question') AS nt, CAST(json_extract(after_snapshot, '$.options') AS VARCHAR[]) AS ao,
  CAST(json_extract(after_snapshot, '$.correctIndex') AS INT) AS ai, json_extract_string(after_snapshot, '$.explanation') AS ax, created_at FROM admin_corrections)"""
_MATCH_SQL = rf"""{_ROOTS}, {_E_SQL}, {_RECORD_SQL},
 byid AS (SELECT e.edit_id, coalesce(l.id, CASE WHEN NOT regexp_matches(e.ref, '^\d{{1,18}}$') THEN (SELECT min(x.id) FROM questions x WHERE lower(x.stable_qn_id) = lower(e.ref) AND x.canonical_id IS NULL) END) AS r
  FROM e LEFT JOIN z ON z.id = try_cast(e.ref AS BIGINT) LEFT JOIN questions l ON l.id = z.root AND l.canonical_id IS NULL),
 k AS (SELECT e.edit_id, {_identity('e.t', 'e.o')} AS ident, {_LEGACY('e.t', 'e.o')} AS legacy, {_BARE('e.t')} AS bare, coalesce(e.o, []) AS opts FROM e JOIN byid USING (edit_id) WHERE byid.r IS NULL),
 i AS ({_found('k', 'e.ident = r.ident')}), l AS ({_found('k', 'e.legacy = r.legacy')}), b AS ({_found('k', 'e.bare = r.bare AND e.opts = r.opts')}),
 m AS (SELECT k.edit_id,
   CASE WHEN i.n IS NOT NULL THEN CASE WHEN i.n = 1 THEN i.r WHEN i.c = 1 THEN i.rc END WHEN b.n = 1 THEN b.r END AS r1,
   CASE WHEN i.n = 1 THEN 'identity' WHEN i.c = 1 THEN 'identity_corrected' WHEN b.n = 1 THEN 'text_options' END AS w1,
   CASE WHEN l.n IS NOT NULL THEN CASE WHEN l.n = 1 THEN l.r WHEN l.c = 1 THEN l.rc END WHEN b.n = 1 THEN b.r END AS r2,
   CASE WHEN l.n = 1 THEN 'legacy_identity' WHEN l.c = 1 THEN 'legacy_identity_corrected' WHEN l.n > 1 THEN 'ambiguous_identity(' || l.n || ')'
        WHEN b.n = 1 THEN 'legacy_text_options' WHEN b.n > 1 THEN 'ambiguous_text(' || b.n || ')' ELSE 'not_found' END AS w2
   FROM k LEFT JOIN i USING (edit_id) LEFT JOIN l USING (edit_id) LEFT JOIN b USING (edit_id)),
 matched AS (SELECT byid.edit_id, coalesce(byid.r, m.r1, m.r2) AS record_id, CASE WHEN byid.r IS NOT NULL THEN 'qid' WHEN m.r1 IS NOT NULL THEN m.w1 ELSE m.w2 END AS reason FROM byid LEFT JOIN m USING (edit_id))"""


@query(f"{_MATCH_SQL} SELECT edit_id, record_id, reason FROM matched")
def correction_match(spark, d):
    """The record of every correction: by id, then by content, with the reason where there is none."""
    return corrections.match(_edits(spark, d), _records(spark, d))


def _reports_as_edits(spark, d):
    r = table(spark, d, "reported_questions").where("question_snapshot IS NOT NULL").groupBy(F.col("id").alias("edit_id"))
    r = r.agg(F.max(F.struct("question_snapshot", "options_snapshot", "file_id")).alias("s"))
    return r.select("edit_id", F.lit(None).cast("string").alias("ref"), F.col("s.file_id").alias("file_id"), F.col("s.question_snapshot").alias("question_text"), F.from_json("s.options_snapshot", "ARRAY<STRING>").alias("options"))


@query(rf"""WITH s AS (SELECT id AS edit_id, max(row(question_snapshot, coalesce(options_snapshot, ''), coalesce(file_id, ''))) AS s FROM reported_questions WHERE question_snapshot IS NOT NULL GROUP BY id),
 e AS (SELECT edit_id, s[1] AS t, try_cast(json(nullif(s[2], '')) AS VARCHAR[]) AS o, s[3] AS file_id FROM s), {_RECORD_SQL},
 k AS (SELECT edit_id, file_id, regexp_extract(t, '^\s*(\d+)\s*[.)]', 1) AS num, {_identity('t', 'o')} AS ident, {_LEGACY('t', 'o')} AS legacy, {_BARE('t')} AS bare, coalesce(o, []) AS opts FROM e),
 t0 AS ({_found("(SELECT * FROM k WHERE file_id <> '' AND num <> '')", 'e.file_id = r.file_id AND e.num = r.num')}),
 i AS ({_found('k', "e.ident = r.ident AND e.file_id IN ('', r.file_id)")}), l AS ({_found('k', "e.legacy = r.legacy AND e.file_id IN ('', r.file_id)")}),
 b AS ({_found('k', "e.bare = r.bare AND e.opts = r.opts AND e.file_id IN ('', r.file_id)")}),
 m AS (SELECT k.edit_id, t0.n AS n0, CASE WHEN t0.n = 1 THEN t0.r END AS r0, i.n AS ni, CASE WHEN i.n = 1 THEN i.r WHEN i.c = 1 THEN i.rc END AS ri, l.n AS nl, CASE WHEN l.n = 1 THEN l.r WHEN l.c = 1 THEN l.rc END AS rl,
   CASE WHEN b.n = 1 THEN b.r WHEN b.c = 1 AND k.file_id <> '' THEN b.rc END AS rb FROM k LEFT JOIN t0 USING (edit_id) LEFT JOIN i USING (edit_id) LEFT JOIN l USING (edit_id) LEFT JOIN b USING (edit_id))
SELECT edit_id, CASE WHEN n0 IS NOT NULL THEN r0 ELSE coalesce(CASE WHEN ni IS NOT NULL THEN ri ELSE rb END, CASE WHEN nl IS NOT NULL THEN rl ELSE rb END) END AS record_id FROM m""")
def report_match(spark, d):
    """The record that a report's snapshot shows, by number, content and text within the file it names."""
    return corrections.match(_reports_as_edits(spark, d), _records(spark, d)).select("edit_id", "record_id")


@query(f"""{_MATCH_SQL}, p AS (SELECT edit_id, CASE WHEN coalesce(t, '') = '' OR coalesce(nt, '') = '' THEN 'missing_before_after' WHEN ao IS NULL OR len(ao) = 0 THEN 'invalid_after_options'
 WHEN NOT coalesce(ai >= 0 AND ai < len(ao), false) THEN 'invalid_after_correct_index' END AS why FROM e)
SELECT m.edit_id, CASE WHEN why IS NULL THEN record_id END AS record_id, coalesce(why, reason) AS reason, CASE WHEN why IS NOT NULL THEN 'skipped' WHEN record_id IS NULL THEN 'queued' ELSE 'applied' END AS state FROM matched m JOIN p USING (edit_id)""")
def correction_states(spark, d):
    """What comes of every correction: applied to a record, queued, or skipped as invalid."""
    return corrections.process(_edits(spark, d), _records(spark, d))


@query(f"""{_MATCH_SQL}, last AS (SELECT record_id AS id, arg_max(edit_id, row(created_at IS NOT NULL, created_at, edit_id)) AS edit_id FROM matched JOIN e USING (edit_id)
 WHERE record_id IS NOT NULL AND coalesce(t, '') <> '' AND coalesce(nt, '') <> '' AND len(ao) > 0 AND ai >= 0 AND ai < len(ao) GROUP BY 1)
SELECT q.id, {_BARE('nt')} AS question_text, ao AS options, ai AS correct_index, ao[ai + 1] AS correct_text, coalesce(nullif(ax, ''), q.explanation) AS explanation, {_identity('nt', 'ao')} AS identity_key,
 (CASE WHEN trim(coalesce(ax, '')) <> '' THEN 20.0 ELSE 0.0 END + CASE WHEN len(ao) = 4 THEN 10.0 WHEN len(ao) = 3 THEN 5.0 WHEN len(ao) >= 5 THEN 8.0 ELSE 0.0 END + CASE WHEN length({_BARE('nt')}) BETWEEN 40 AND 200 THEN 3.0 ELSE 0.0 END)::DOUBLE AS quality_score,
 e.created_at AS corrected_at, coalesce(q.source_identity, {_identity('t', 'o')}) AS source_identity FROM last JOIN e USING (edit_id) JOIN questions q ON q.id = last.id""")
def corrections_applied(spark, d):
    """The questions as the corrections leave them."""
    edits, records = _edits(spark, d), _records(spark, d)
    return corrections.apply(edits, corrections.process(edits, records), records)


@query(f"""WITH s AS (SELECT a.*, {', '.join(f"json_extract_string({w}_snapshot, '$.question') AS {w}_t, CAST(json_extract({w}_snapshot, '$.options') AS VARCHAR[]) AS {w}_o, CAST(json_extract({w}_snapshot, '$.correctIndex') AS INT) AS {w}_i" for w in ('before', 'after'))} FROM admin_corrections a),
 r AS (SELECT s.*, CASE WHEN s.reverted_at IS NOT NULL THEN 'already_reverted' WHEN EXISTS (SELECT 1 FROM admin_corrections n WHERE n.question_id = s.question_id AND n.id > s.id AND n.reverted_at IS NULL) THEN 'newer_correction'
  WHEN q.id IS NULL THEN 'no_question' WHEN q.question_text IS DISTINCT FROM after_t OR q.options IS DISTINCT FROM after_o OR q.correct_index IS DISTINCT FROM after_i THEN 'changed_since' ELSE 'revertible' END AS reason FROM s LEFT JOIN questions q ON q.id = s.question_id)
SELECT id, question_id, reason, CASE WHEN reason = 'revertible' THEN before_t END AS question_text, CASE WHEN reason = 'revertible' THEN before_o END AS options, CASE WHEN reason = 'revertible' THEN before_i END AS correct_index FROM r""")
def revert_plan(spark, d):
    """Which corrections can be taken back, and what the question then holds."""
    side = lambda w: [F.from_json(f"{w}_snapshot", _SNAP)[f].alias(f"{w}_{n}") for f, n in (("question", "text"), ("options", "options"), ("correctIndex", "index"))]
    a = table(spark, d, "admin_corrections").select("id", "question_id", "reverted_at", *side("before"), *side("after"))
    return corrections.revert(a, table(spark, d, "questions").select("id", "question_text", "options", "correct_index"))


@query(f"""{_ROOTS} SELECT r.id, z.root, q.corrected_at FROM {_LAST} r JOIN z ON z.id = r.qid JOIN questions q ON q.id = z.root
 WHERE r.status IS DISTINCT FROM 'resolved' AND q.canonical_id IS NULL AND q.corrected_at IS NOT NULL AND (r.reported_at IS NULL OR q.corrected_at >= r.reported_at)""")
def reports_resolved(spark, d):
    """Reports that a correction of their question, or of the one it was merged into, settles."""
    q = table(spark, d, "questions").select("id", "canonical_id", "corrected_at")
    return corrections.reconcile(last_reports(spark, d).select("id", "qid", "status", "reported_at"), q)


both("tombstone_anti", "SELECT q.id FROM {questions} q WHERE NOT EXISTS (SELECT 1 FROM {dedup_deletions} d WHERE d.deleted_id = q.id)")

#: Columns of a report that a change made here and not yet pushed holds against the incoming state, and those that an incoming state never has.
_HELD = ["status", "resolved_at", "resolved_by", "corrected", "corrected_snapshot", "backend_synced_at"]
_OWN = ["backend_dirty", "correction_audit_id"]


_SIDE = lambda where: f"(SELECT * FROM reported_questions WHERE {where} QUALIFY row_number() OVER (PARTITION BY id ORDER BY coalesce(migrated_at, make_timestamp(0)) DESC, coalesce(resolved_at, make_timestamp(0)) DESC, coalesce(status, '') DESC) = 1)"

_STAYS = {"status": "coalesce(nullif(n.status, ''), 'open')", "resolved_at": "n.resolved_at", "resolved_by": "n.resolved_by", "corrected": "coalesce(n.corrected, false)", "corrected_snapshot": "n.corrected_snapshot", "backend_synced_at": "n.backend_synced_at"}
_COMES = "uid qid file_id question_snapshot options_snapshot correct_index chosen_index reason note reported_by reported_at section app_version migrated_at".split()


@query(f"""SELECT coalesce(n.id, o.id) AS id, {', '.join(f'CASE WHEN n.id IS NULL OR o.backend_dirty THEN o.{c} ELSE {x} END AS {c}' for c, x in _STAYS.items())},
 {', '.join(f'CASE WHEN n.id IS NULL THEN o.{c} ELSE n.{c} END AS {c}' for c in _COMES)}, CASE WHEN o.id IS NULL THEN false ELSE o.backend_dirty END AS backend_dirty, o.correction_audit_id
FROM {_SIDE('resolved_at IS NULL')} o FULL JOIN {_SIDE('resolved_at IS NOT NULL')} n ON o.id = n.id""")
def dirty_upsert(spark, d):
    """The reports after the resolved deliveries came in over the unresolved ones: six columns held where dirty, new ids inserted."""
    r = table(spark, d, "reported_questions")
    zero = F.timestamp_micros(F.lit(0))
    newest = [F.coalesce("migrated_at", zero), F.coalesce("resolved_at", zero), F.coalesce("status", F.lit("")), F.xxhash64(*r.columns)]
    last = lambda where: dedupe.latest(r.where(where), "id", *newest)
    sent = last("resolved_at IS NOT NULL").withColumns({
        "status": F.coalesce(F.nullif(F.col("status"), F.lit("")), F.lit("open")), "corrected": F.coalesce("corrected", F.lit(False)),
        "backend_dirty": F.lit(False), "correction_audit_id": F.lit(None).cast(r.schema["correction_audit_id"].dataType),
    })
    return dedupe.upsert(last("resolved_at IS NULL"), sent, "id", F.col("backend_dirty"), _HELD, _OWN)


@query("""WITH o AS (SELECT id, drive_md5 AS h FROM files WHERE last_synced_at IS NULL OR id % 7 <> 0), n AS (SELECT id, CASE WHEN id % 5 = 0 THEN md5(coalesce(drive_md5, '')) ELSE drive_md5 END AS h FROM files WHERE id % 11 <> 0)
SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN 'new' WHEN n.id IS NULL THEN 'deleted' WHEN o.h IS NOT DISTINCT FROM n.h THEN 'same' ELSE 'changed' END AS action FROM o FULL JOIN n ON o.id = n.id""")
def file_diff(spark, d):
    """Two made-up states of the file list compared."""
    f = table(spark, d, "files").select("id", "drive_md5", "last_synced_at")
    old = f.where("last_synced_at IS NULL OR id % 7 <> 0").select("id", F.col("drive_md5").alias("h"))
    new = f.where("id % 11 <> 0").select("id", F.when(F.col("id") % 5 == 0, F.md5(F.coalesce("drive_md5", F.lit("")))).otherwise(F.col("drive_md5")).alias("h"))
    return sync.diff(old, new, ["id"], "h")


@query("""SELECT id, json_extract_string(raw, '$.q') AS q, json_extract(raw, '$') IS NOT NULL AS parsed FROM questions WHERE raw IS NOT NULL""")
def parse_source_json(spark, d):
    j = json_files.lenient(F.col("raw"))
    return table(spark, d, "questions").where("raw IS NOT NULL").select("id", F.get_json_object(j, "$.q").alias("q"), j.isNotNull().alias("parsed"))


# ---------------------------------------------------------------- classification, ids, export


def _dictionary(spark, d):
    """Keywords of a chapter: the subtopics of its files without their last two words."""
    f = table(spark, d, "files").select("book_id", "subtopic").join(table(spark, d, "books").select(F.col("id").alias("book_id"), "chapter_id"), "book_id")
    k = F.regexp_replace("subtopic", r"\s+\S+(\s+\S+)?$", "")
    return classify.dictionary(f.where("subtopic IS NOT NULL").select(F.col("chapter_id").cast("bigint").alias("chapter_id"), k.alias("code"), k.alias("keyword")).distinct())


@query()
def keyword_scores(spark, d):
    return classify.scores(live_questions(spark, d, "id", "question_text"), _dictionary(spark, d))


@query()
def keyword_classify(spark, d):
    return classify.classify(live_questions(spark, d, "id", "question_text"), _dictionary(spark, d))


@query(f"""SELECT chapter_id, file_ref_id, id, ceil(n / 50.0)::INT AS part, ((n - 1) % 50 + 1)::INT AS place FROM (SELECT chapter_id, file_ref_id, id, row_number() OVER (PARTITION BY file_ref_id ORDER BY question_number NULLS LAST, id) AS n FROM ({_LIVE}))""")
def export_layout(spark, d):
    q = live_questions(spark, d, "id", "question_number", "file_ref_id")
    return dedupe.parts(q, ["file_ref_id"], [F.col("question_number").asc_nulls_last(), F.col("id")]).select("chapter_id", "file_ref_id", "id", "part", "place")


@query("""WITH n AS (SELECT id, file_ref_id, ceil(count(*) OVER (PARTITION BY file_ref_id) / 50.0)::BIGINT AS parts FROM questions WHERE file_ref_id IS NOT NULL AND canonical_id IS NULL)
SELECT id, file_ref_id, ('0x' || substr(md5(id::VARCHAR), 1, 8))::BIGINT % parts AS part FROM n""")
def stable_hash_parts(spark, d):
    q = table(spark, d, "questions").where("file_ref_id IS NOT NULL AND canonical_id IS NULL").select("id", "file_ref_id")
    n = q.groupBy("file_ref_id").agg(F.ceil(F.count("*") / 50).cast("bigint").alias("parts"))
    return q.join(n, "file_ref_id").select("id", "file_ref_id", (canon.qid_hash(F.col("id")) % F.col("parts")).alias("part"))


@query("""SELECT id, lpad(level_id::VARCHAR, 1, '0') || CASE WHEN length(chapter_key) < 3 THEN lpad(chapter_key, 3, '0') ELSE chapter_key END AS prefix,
 trim(regexp_replace(trim(regexp_replace(chapter_name, '[<>:"/\\\\|?*]', '_', 'g')), '^[.]+|[.]+$', '', 'g')) AS folder FROM chapters""")
def id_prefixes(spark, d):
    return table(spark, d, "chapters").select("id", F.concat(F.col("level_id").cast("string"), canon.pad(F.col("chapter_key"), 3)).alias("prefix"), canon.safe_filename(F.col("chapter_name")).alias("folder"))


@query()
def stable_ids(spark, d):
    """The public id of every identity of a level, on its keeper: the one it has, else a new one; none given twice.

    An identity is the source key, unless that is only a number within its file; then it is the content, computed anew
    as stored keys are partly old or missing.  Questions without any content stand alone.
    """
    q = dedupe.with_identity(live_questions(spark, d, *_QUESTION, "stable_qn_id", F.col("file_ref_id").cast("string").alias("code")))
    c = table(spark, d, "chapters").select(F.col("id").alias("chapter_id"), F.col("level_id").alias("level"), F.col("chapter_key").alias("chapter"))
    source, content = F.col("source_question_key"), F.concat(F.coalesce("question_text", F.lit("")), F.coalesce(F.array_join("options", ""), F.lit("")))
    key = F.when((source != "") & ~source.rlike(r"^n:\d+$"), F.concat(F.lit("s:"), source)).when(F.trim(content) == "", F.concat(F.lit("q:"), F.col("id"))).otherwise(F.concat(F.lit("i:"), F.col("identity")))
    q = q.withColumn("key", key).join(F.broadcast(c), "chapter_id")
    taken = table(spark, d, "questions").select("id", F.col("stable_qn_id").alias("public_id"), F.col("canonical_id").isNull().alias("live"))
    return ids.plan(q.select("id", "level", "chapter", "code", F.col("question_number").alias("number"), "key", "stable_qn_id", "corrected_at", "quality_score"), taken)


@query(rf"""SELECT id, json_object('id', id, 'question', regexp_replace(coalesce(question_text, ''), '^{_S}*\p{{Nd}}+{_S}*[.)]{_S}*', ''), 'options', options, 'correctIndex', correct_index, 'explanation', explanation)::VARCHAR AS json FROM ({_LIVE})""")
def question_json(spark, d):
    """Every live question as the JSON object of an export file."""
    q = live_questions(spark, d, "id", "question_text", "options", "correct_index", "explanation")
    return q.select("id", F.to_json(F.struct("id", canon.strip_number(F.col("question_text")).alias("question"), "options", F.col("correct_index").alias("correctIndex"), "explanation"), {"ignoreNullFields": "false"}).alias("json"))


@query("""SELECT c.level_id, c.chapter_key, b.book_name, f.subtopic, min(f.file_id) AS file_id, count(*) AS files FROM chapters c JOIN books b ON b.chapter_id = c.id JOIN files f ON f.book_id = b.id GROUP BY ALL""")
def chapter_index(spark, d):
    f = table(spark, d, "files").select("book_id", "subtopic", "file_id")
    b = table(spark, d, "books").select(F.col("id").alias("book_id"), "book_name", "chapter_id")
    c = table(spark, d, "chapters").select(F.col("id").alias("chapter_id"), "level_id", "chapter_key")
    return f.join(b, "book_id").join(c, "chapter_id").groupBy("level_id", "chapter_key", "book_name", "subtopic").agg(F.min("file_id").alias("file_id"), F.count("*").alias("files"))


@query()
def chapter_index_json(spark, d):
    """One nested JSON object per level: chapter -> book -> subtopic -> file id."""
    i = chapter_index(spark, d).where("book_name IS NOT NULL AND subtopic IS NOT NULL AND chapter_key IS NOT NULL")
    m = lambda k, v: F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, v))))
    subs = i.groupBy("level_id", "chapter_key", "book_name").agg(m("subtopic", "file_id").alias("s"))
    rows = subs.groupBy("level_id", "chapter_key").agg(F.map_from_entries(F.collect_list(F.struct("book_name", "s"))).alias("b"))
    return rows.groupBy("level_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("chapter_key", "b")))).alias("index"))
