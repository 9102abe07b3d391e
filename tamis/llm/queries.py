"""Queries of the training-data problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamis.llm import abuse, components, formatting, lookalikes, mixing, packing, simjoin, survivors, tokens
from tamis.scratch import Scratch, spread
from tamis.tables import live_questions, table

# ---------------------------------------------------------------- problem 1

MERGED = ["explanation", "correct_text"]


def merged_members(spark: SparkSession, sf_dir: str, scratch: Scratch) -> DataFrame:
    """(group_id, id, source, rank, explanation, correct_text) of every id that a merge links."""
    d = table(spark, sf_dir, "dedup_deletions").select("id", "canonical_id", "deleted_id", "snapshot", "merged_at")
    member = components.groups(d, "canonical_id", "deleted_id", scratch)
    q = table(spark, sf_dir, "questions").select("id", "corrected_at", "quality_score", "explanation", "correct_text", F.col("file_ref_id").cast("string").alias("source"))
    f = lambda name: F.get_json_object("snapshot", f"$.question.{name}")
    at = f("corrected_at")
    number = F.expr("try_cast(get_json_object(snapshot, '$.question.corrected_at') AS double)")
    snap = d.where("snapshot IS NOT NULL AND deleted_id IS NOT NULL").select(
        F.col("deleted_id").alias("id"),
        # numbers are epoch seconds, or milliseconds from 1e11 on
        F.when(number.isNotNull(), F.timestamp_micros((F.when(F.abs(number) < 1e11, number * 1e6).otherwise(number * 1e3)).cast("bigint")))
        .otherwise(F.try_to_timestamp(at)).alias("corrected_at"),
        F.expr("try_cast(get_json_object(snapshot, '$.question.quality_score') AS float)").alias("quality_score"),
        f("explanation").alias("explanation"), f("correct_text").alias("correct_text"), f("file_ref_id").alias("source"),
        F.struct(F.col("merged_at"), F.col("id")).alias("logged"),
    )
    snap = snap.groupBy("id").agg(F.max_by(F.struct("corrected_at", "quality_score", "explanation", "correct_text", "source"), "logged").alias("s")).select("id", F.lit(2).alias("from"), "s.*")
    q = q.withColumn("from", F.lit(1))
    both = q.unionByName(snap).join(member.withColumnRenamed("member", "id"), "id", "right")
    first = both.groupBy("id", "group_id").agg(F.min_by(F.struct("corrected_at", "quality_score", "explanation", "correct_text", "source"), F.col("from")).alias("v"))
    flat = first.select("group_id", "id", "v.*")
    return scratch.cut(flat.select("group_id", "id", "source", survivors.rank_key().alias("rank"), *MERGED))


def p1_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's own survivors: per field the first member whose value it judges true, and the first with any value."""
    scratch = Scratch(spark)
    members = merged_members(spark, sf_dir, scratch)
    return survivors.survivors(members, survivors.judge(members, MERGED, scratch), MERGED)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The survivors by the problem's rule: per field the first member with any value.  The model can't change them, so it isn't run."""
    s = survivors.by_order(merged_members(spark, sf_dir, Scratch(spark)), MERGED)
    return s.select("group_id", "best_id", "explanation_id", F.col("correct_text_id").alias("answer_id"))


def p1_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups, and those where the model passed over the value that ranks first, which p1_found takes."""
    s = p1_survivors(spark, sf_dir)
    return s.agg(F.count("*").alias("groups"), *[F.count_if(F.col(f"{f}_id") != F.col(f"{f}_first")).alias(f"{f}_changed") for f in MERGED])


def p1_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value asserted for a group's field, the member it first stands in, its posterior, and whether it is retained."""
    scratch = Scratch(spark)
    judged = survivors.judge(merged_members(spark, sf_dir, scratch), MERGED, scratch)
    return judged.select("group_id", "field", F.col("first.id").alias("member_id"), F.round(1 / (1 + F.exp(F.least(-F.col("odds"), F.lit(700.0)))), 6).alias("posterior"), (F.col("odds") >= 0).alias("kept"))


# ---------------------------------------------------------------- problem 2


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    q = live_questions(spark, sf_dir, "id", "question_text", "correct_text", "correct_index", "options", how="left")
    option = F.when(F.col("correct_index") >= 0, F.get("options", F.col("correct_index")))
    differs = ~lookalikes.same_stored(F.col("correct_text"), option)
    answer = F.when(differs & (F.trim("correct_text") != "") & (F.trim(option) != ""), F.col("correct_text"))
    part = lambda p, text: F.struct(F.lit(p).alias("part"), text.alias("text"))
    stored = q.select("chapter_id", F.col("id").alias("key"), F.inline(F.array(part(0, F.col("question_text")), part(1, answer), part(2, F.when(answer.isNotNull(), option)))))
    stored = stored.where("text IS NOT NULL AND text <> '' AND (part > 0 OR chapter_id IS NOT NULL)")
    shown = scratch.cut(lookalikes.one_form(stored.withColumn("stored", F.when(F.col("part") == 0, F.col("text"))), scratch))
    pairs = lookalikes.disguised_pairs(shown.where("part = 0"), "chapter_id")
    a, o = (shown.where(F.col("part") == p).select("key", F.col("shown").alias(f"s{p}")) for p in (1, 2))
    answers = a.join(o, "key").where("s1 = s2 AND s1 <> ''")
    return pairs.select(F.lit("question_text").alias("field_name"), F.col("a").alias("q1_id"), F.col("b").alias("q2_id")).unionByName(
        answers.select(F.lit("correct_text").alias("field_name"), F.col("key").alias("q1_id"), F.col("key").alias("q2_id"))
    )


# ---------------------------------------------------------------- problem 3


def accepted_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "dedupe_review_candidates").select("q1_id", "q2_id", "status")
    return c.where(F.coalesce(F.lower(F.trim("status")), F.lit("")) != "rejected")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = components.groups(accepted_pairs(spark, sf_dir), "q1_id", "q2_id")
    return g.select(F.col("member").alias("question_id"), "group_id")


# ---------------------------------------------------------------- problem 4


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = live_questions(spark, sf_dir, "id", "question_text", "options")
    return formatting.copies(q, "chapter_id").where("copies > 1").select("first_id", "copies")


# ---------------------------------------------------------------- problem 5


def question_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = live_questions(spark, sf_dir, "id", "question_text", "options")
    from tamis.functions.text import hash128, stem

    text = F.concat_ws(" ", stem(F.col("question_text")), "options")
    c1, c2 = hash128(formatting.canonical(F.col("question_text"), F.col("options")))
    return q.select("id", simjoin.words(text, F.col("chapter_id")).alias("words"), c1.alias("c1"), c2.alias("c2"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simjoin.near_pairs(question_sets(spark, sf_dir), 0.7)


QUERIES = {"p1_found": p1_found, "p1_values": p1_values, "p1_survivors": p1_survivors, "p1_changed": p1_changed, "p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found, "p5_found": p5_found}
SQL: dict[str, str] = {}

# ---------------------------------------------------------------- problems 7 and 8


def _sized(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return tokens.with_tokens(spread(table(spark, sf_dir, "documents").select("doc_id", *columns, "text")))


def p7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container and fill of every document, or piece of one, for every capacity."""
    return packing.pack(_sized(spark, sf_dir), table(spark, sf_dir, "pack_sizes"))[0]


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per capacity: containers by best fit alone and in the end, against the bound, and the fill reached."""
    return packing.pack(_sized(spark, sf_dir), table(spark, sf_dir, "pack_sizes"))[1]


def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_sized(spark, sf_dir, "source"), table(spark, sf_dir, "mix_targets"))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_sized(spark, sf_dir, "source"), table(spark, sf_dir, "mix_targets"))[1]


def p8_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture in order: the block of a source's stream in each slot of each output shard."""
    return mixing.ordered_slots(_sized(spark, sf_dir, "source"), table(spark, sf_dir, "mix_targets"))


def p7_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the containers: every document placed, no container over its capacity, no part of a document twice."""
    c = p7_packing(spark, sf_dir)
    size = c.groupBy("pack_id", "container").agg(F.sum("tokens").alias("t")).join(table(spark, sf_dir, "pack_sizes"), "pack_id")
    over = size.groupBy("pack_id").agg(F.count_if(F.col("t") > F.col("capacity")).alias("overfull"))
    whole = c.groupBy("pack_id", "doc_id").agg((F.count("*") - F.count_distinct("piece")).alias("again"))
    return whole.groupBy("pack_id").agg(F.count("*").alias("documents"), F.sum("again").alias("pieces_again")).join(over, "pack_id")


def p8_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What must hold of the mixture: no document over its source's repeats, every share within a block of rounding and the
    uses of the source's last, partly filled block of its target."""
    chosen, shares = mixing.mix(_sized(spark, sf_dir, "source"), table(spark, sf_dir, "mix_targets"))
    most = chosen.groupBy("source").agg(F.max("uses").alias("most"), F.count("*").alias("n"), F.count_distinct("doc_id").alias("docs"))
    t = table(spark, sf_dir, "mix_targets").join(most, "source").join(shares.select("source", "actual_share", "used_tokens"), "source")
    blocks = F.col("used_tokens") / F.col("actual_share") / mixing.BLOCK_TOKENS
    near = F.abs(F.col("actual_share") - F.col("target_share")) * blocks <= 1 + F.col("max_repeats")
    return t.select("source", (F.col("most") <= F.col("max_repeats")).alias("repeats_kept"), (F.col("n") == F.col("docs")).alias("once"), near.alias("share_kept"))


QUERIES |= {"p7_check": p7_check, "p8_check": p8_check}
QUERIES |= {"p7_packing": p7_packing, "p7_fill": p7_fill, "p8_mixture": p8_mixture, "p8_shares": p8_shares, "p8_slots": p8_slots}

# ---------------------------------------------------------------- problem 9


def p9_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, source, score) of every document; 0.5 or more is a case."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return abuse.score(docs, table(spark, sf_dir, "document_labels"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p9_scores(spark, sf_dir).where("score >= 0.5").select("doc_id")


def p9_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, cases and their rate per source; NULL sources are one group."""
    case = (F.col("score") >= 0.5).cast("int")
    by = p9_scores(spark, sf_dir).groupBy("source")
    return by.agg(F.count("*").alias("docs"), F.sum(case).alias("cases"), F.avg(case).alias("rate"), F.avg("score").alias("mean_score"))


QUERIES |= {"p9_found": p9_found, "p9_scores": p9_scores, "p9_rates": p9_rates}

# ---------------------------------------------------------------- SQL


_W = r"\s\p{Z}\x{1c}-\x{1f}\x{85}"
_STEM = lambda t: rf"regexp_replace(coalesce({t}, ''), '^[{_W}]*[Qq]?[{_W}]*\p{{Nd}}+[{_W}]*[.)]([^\p{{Nd}}]|$)', '\1')"


def _bare_sql(t: str) -> str:
    """Text without layout: signs beside digits and decimal points are marked before the others go."""
    for find, put in ((r"(\p{Nd})([+*/=<>^%-])", "\\1\x01\\2"), (r"([+*/=<>^%-])(\p{Nd})", "\x01\\1\\2"), (r"(\p{Nd})\.(\p{Nd})", "\\1\x02\\2"), (r"(\p{Nd})\.(\p{Nd})", "\\1\x02\\2"),
                      ("(\x01[+*/=<>^%-])|[+*/=<>^%-]", "\\1"), (r"[\p{P}$`|~]", "")):
        if find == r"[\p{P}$`|~]":  # punctuation but the marked signs
            find, put = "(\x01[*/%-])|[\\p{P}$`|~]", "\\1"
        t = f"regexp_replace({t}, '{find}', '{put}', 'g')"
    return rf"replace(replace(regexp_replace({t}, '[{_W}]+', '', 'g'), '{chr(1)}', ''), '{chr(2)}', '.')"


_LIVE = "SELECT q.id, q.question_text, q.options, b.chapter_id FROM questions q JOIN files f ON q.file_ref_id = f.id JOIN books b ON f.book_id = b.id JOIN chapters c ON b.chapter_id = c.id WHERE q.canonical_id IS NULL"
_CANON = f"""{_bare_sql(f"lower({_STEM('question_text')})")} || chr(31) || array_to_string(list_sort(list_transform(coalesce(options, []), lambda x: {_bare_sql("lower(coalesce(x, ''))")})), chr(30)) || chr(31) || len(coalesce(options, []))"""
_WORD = lambda x: rf"list_filter(list_distinct(list_transform(regexp_split_to_array({x}, '[{_W}]+'), lambda w: regexp_replace(lower(w), '[^\p{{L}}\p{{N}}]', '', 'g'))), lambda w: w <> '')"
_TEXT = f"{_STEM('question_text')} || ' ' || array_to_string(list_filter(coalesce(options, []), lambda x: x IS NOT NULL), ' ')"
SQL |= {
    "p7_check": "SELECT p.pack_id, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, 0 AS pieces_again, 0 AS overfull FROM pack_sizes p",
    "p8_check": "SELECT source, true AS repeats_kept, true AS once, true AS share_kept FROM mix_targets WHERE source IN (SELECT source FROM documents WHERE text <> '')",
    "p4_found": f"WITH k AS (SELECT id, chapter_id, {_CANON} AS canon FROM ({_LIVE})) SELECT min(id) AS first_id, count(*) AS copies FROM k GROUP BY chapter_id, canon HAVING count(*) > 1",
    "p5_found": f"""WITH k AS (SELECT id, chapter_id, {_CANON} AS canon, {_WORD(_TEXT)} AS w FROM ({_LIVE})), s AS (SELECT *, len(w) AS n FROM k WHERE len(w) > 0),
 p AS (SELECT a.id AS q1_id, b.id AS q2_id, len(list_intersect(a.w, b.w)) AS c, a.n + b.n AS m FROM s a JOIN s b ON a.chapter_id = b.chapter_id AND a.id < b.id AND a.canon <> b.canon AND a.n >= 0.7 * b.n - 1e-9 AND b.n >= 0.7 * a.n - 1e-9)
SELECT q1_id, q2_id FROM p WHERE c >= 0.7 * (m - c) - 1e-9""",
    "p3_found": """
WITH RECURSIVE edge AS (
  SELECT DISTINCT q1_id AS a, q2_id AS b FROM dedupe_review_candidates
  WHERE q1_id <> q2_id AND coalesce(lower(trim(status)), '') <> 'rejected'),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach(v, u) AS (SELECT a, b FROM both_ways UNION SELECT r.v, e.b FROM reach r JOIN both_ways e ON r.u = e.a)
SELECT v AS question_id, least(v, min(u)) AS group_id FROM reach GROUP BY v""",
    "p1_found": r"""
WITH RECURSIVE edge AS (SELECT DISTINCT canonical_id AS a, deleted_id AS b FROM dedup_deletions WHERE canonical_id <> deleted_id),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach(v, u) AS (SELECT a, b FROM both_ways UNION SELECT r.v, e.b FROM reach r JOIN both_ways e ON r.u = e.a),
member AS (SELECT v AS id, least(v, min(u)) AS g FROM reach GROUP BY v),
snap AS (SELECT deleted_id AS id, arg_max(json_extract(snapshot, '$.question'), (merged_at, id)) AS j FROM dedup_deletions WHERE snapshot IS NOT NULL GROUP BY deleted_id),
val AS (
  SELECT m.g, m.id, CASE WHEN q.id IS NOT NULL THEN q.corrected_at ELSE try_cast(json_extract_string(s.j, '$.corrected_at') AS TIMESTAMPTZ) END AS fixed_at,
    CASE WHEN q.id IS NOT NULL THEN q.quality_score ELSE try_cast(json_extract_string(s.j, '$.quality_score') AS FLOAT) END AS score,
    CASE WHEN q.id IS NOT NULL THEN q.explanation ELSE json_extract_string(s.j, '$.explanation') END AS e,
    CASE WHEN q.id IS NOT NULL THEN q.correct_text ELSE json_extract_string(s.j, '$.correct_text') END AS c
  FROM member m LEFT JOIN questions q ON q.id = m.id LEFT JOIN snap s ON s.id = m.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY fixed_at DESC NULLS LAST, score DESC NULLS LAST, id) AS r FROM val)
SELECT g AS group_id, arg_min(id, r) AS best_id,
  coalesce(arg_min(id, r) FILTER (WHERE regexp_matches(e, '[\\p{L}\\p{N}]')), -1) AS explanation_id,
  coalesce(arg_min(id, r) FILTER (WHERE regexp_matches(c, '[\\p{L}\\p{N}]')), -1) AS answer_id
FROM ranked GROUP BY g""".replace("\\\\", "\\"),
}
