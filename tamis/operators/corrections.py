"""Corrections: matched to records by tiers, checked, applied, queued, taken back; reports closed by them.

Everything is a plan over whole tables: nothing is written here.  A bad correction never stops the others, it comes out
with its reason.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.functions import canon
from tamis.operators import dedupe

NUMBER = r"^\s*(\d+)\s*[.)]"


def bare_text(text: Column) -> Column:
    """The text without a printed number and outer spaces; NULL as empty."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s*\d+\s*[.)]\s*", ""))


def with_keys(rows: DataFrame, text: str = "question_text", options: str = "options") -> DataFrame:
    """Adds number (printed), identity, legacy and body (text and options as they are), by which rows are matched."""
    c = rows.withColumn("_c", canon.composed(text, F.lit(None).cast("string"), options))
    c = c.withColumns({"_stem": canon.canonical_stem(F.col("_c.text")), "_opts": canon.sorted_options(F.col("_c.options")), "_words": canon.content_words(F.col("_c.text"))})
    return c.select(
        *rows.columns,
        F.regexp_extract(F.coalesce(text, F.lit("")), NUMBER, 1).alias("number"),
        canon.identity_of(F.col("_stem"), F.col("_opts")).alias("identity"),
        canon.legacy_identity_of(F.col("_words"), F.col("_opts")).alias("legacy"),
        F.sha2(F.to_json(F.struct(bare_text(F.col(text)).alias("t"), F.coalesce(options, F.array().cast("array<string>")).alias("o"))), 256).alias("body"),
    )


def resolve_refs(refs: DataFrame, questions: DataFrame, hops: int = 10) -> DataFrame:
    """refs (edit_id, ref) -> (edit_id, record_id, reason): a number is an id, anything else a public id, whatever its case.

    Pointers to the surviving record are followed.  Reasons: qid, qid_missing, qid_not_found, qid_canonical_loop.
    """
    ref = F.trim(F.coalesce("ref", F.lit("")))
    asked = refs.select("edit_id", ref.alias("ref"))
    by_name = questions.where("stable_qn_id IS NOT NULL").groupBy(F.lower("stable_qn_id").alias("name")).agg(F.min("id").alias("named"))
    start = asked.join(by_name, F.lower("ref") == F.col("name"), "left")
    start = start.select("edit_id", "ref", F.when(F.col("ref").rlike(r"^\d{1,18}$"), F.expr("try_cast(ref AS bigint)")).otherwise(F.col("named")).alias("at"))
    root = dedupe.resolve(questions.select("id", F.col("canonical_id").alias("target")), hops).select(F.col("id").alias("at"), "root", F.lit(True).alias("there"))
    live = questions.where("canonical_id IS NULL").select(F.col("id").alias("root"), F.lit(True).alias("live"))
    out = start.join(root, "at", "left").join(live, "root", "left")
    found = F.col("live").isNotNull()
    return out.select(
        "edit_id", F.when(found, F.col("root")).alias("record_id"),
        F.when(F.col("ref") == "", "qid_missing").when(found, "qid").when(F.col("there").isNotNull() & F.col("root").isNull(), "qid_canonical_loop").otherwise("qid_not_found").alias("reason"),
    )


def _tier(edits: DataFrame, records: DataFrame, rank: int, name: str, clash: str, on: list[str], corrected: bool) -> DataFrame:
    """(edit_id, m): how many records a tier finds, and what that decides; edits that find none are absent."""
    r = records.select(F.col("id").alias("_id"), F.col("corrected_at").isNotNull().alias("_corrected"), *on)
    hit = edits.select("edit_id", *on).dropna(subset=on).join(r, on)
    one = lambda c: F.min(F.when(c, F.col("_id")))
    n = hit.groupBy("edit_id").agg(F.count_distinct("_id").alias("n"), F.min("_id").alias("r"), F.count_distinct(F.when(F.col("_corrected"), F.col("_id"))).alias("c"), one(F.col("_corrected")).alias("rc"))
    sole, fixed = F.col("n") == 1, F.lit(corrected) & (F.col("c") == 1)
    m = F.struct(
        F.lit(rank).alias("rank"), F.when(sole, F.col("r")).when(fixed, F.col("rc")).alias("record_id"),
        F.when(sole, F.lit(name)).when(fixed, F.lit(f"{name}_corrected")).otherwise(F.concat(F.lit(f"{clash}("), F.col("n"), F.lit(")"))).alias("reason"),
    )
    return n.select("edit_id", m.alias("m"))


def _by_content(edits: DataFrame, records: DataFrame, key: str, prefix: str) -> DataFrame:
    """(edit_id, record_id, reason) by number, identity and text within the named file, or by identity and text anywhere."""
    scoped, free = edits.where("file_id <> ''"), edits.where("coalesce(file_id, '') = ''")
    tiers = [
        _tier(scoped.where("number <> ''"), records.where("number <> ''"), 0, "source_number_file", "ambiguous_source_number_file", ["file_id", "number"], False),
        _tier(scoped, records, 1, "identity_file", "ambiguous_identity_in_source_file", ["file_id", key], True),
        _tier(scoped, records, 2, "text_options_file", "ambiguous_text_in_source_file", ["file_id", "body"], True),
        _tier(free, records, 1, "identity", "ambiguous_identity", [key], True),
        _tier(free, records, 2, "text_options", "ambiguous_text", ["body"], False),
    ]
    first = reduce(DataFrame.unionByName, tiers).groupBy("edit_id").agg(F.min("m").alias("m"))
    out = edits.select("edit_id", "file_id").join(first, "edit_id", "left")
    none = F.when(F.coalesce("file_id", F.lit("")) != "", "not_found_in_source_file").otherwise("not_found")
    reason = F.when(F.col("m.record_id").isNotNull(), F.concat(F.lit(prefix), F.col("m.reason"))).otherwise(F.coalesce("m.reason", none))
    return out.select("edit_id", F.col("m.record_id").alias("record_id"), reason.alias("reason"))


def match(edits: DataFrame, questions: DataFrame) -> DataFrame:
    """(edit_id, record_id, reason) of every edit: the first tier that finds anything decides, several found is ambiguous.

    edits: (edit_id unique, ref, file_id, question_text, options); questions: (id, stable_qn_id, canonical_id, file_id,
    source_question_key, question_number, question_text, options, corrected_at).  An id in ``ref`` outranks all content;
    where content as identified now finds none, the older identity is tried.
    """
    live = with_keys(questions.where("canonical_id IS NULL"))
    printed = F.when(F.col("source_question_key").isNull(), F.col("question_number").cast("string")).otherwise(F.regexp_extract("source_question_key", r"^n:(.*)$", 1))
    live = live.withColumn("number", printed)
    e = with_keys(edits)
    by_id = resolve_refs(edits.select("edit_id", "ref"), questions)
    rest = e.join(by_id.where("record_id IS NULL").select("edit_id"), "edit_id", "left_semi")
    now = _by_content(rest, live, "identity", "")
    then = _by_content(rest, live, "legacy", "legacy_").select("edit_id", F.col("record_id").alias("r2"), F.col("reason").alias("w2"))
    hit = F.col("record_id").isNotNull()
    content = now.join(then, "edit_id").select("edit_id", F.coalesce("record_id", "r2").alias("record_id"), F.when(hit, F.col("reason")).otherwise(F.col("w2")).alias("reason"))
    return by_id.where("record_id IS NOT NULL").unionByName(content)


def problem(before: Column, after: Column, options: Column, index: Column) -> Column:
    """Why a correction can't be applied, or NULL: it must name both texts and never blank an answer."""
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    inside = F.coalesce((index >= 0) & (index < F.size(options)), F.lit(False))
    return (
        F.when(blank(before) | blank(after), "missing_before_after")
        .when(options.isNull() | (F.size(options) == 0), "invalid_after_options")
        .when(~inside, "invalid_after_correct_index")
    )


def console_problem(text: Column, options: Column, index: Column, answered: Column) -> Column:
    """The stricter rules for a correction made by hand; ``answered`` tells whether the question has an answer."""
    empty = F.coalesce(F.exists(options, lambda o: F.coalesce(F.trim(o), F.lit("")) == ""), F.lit(False))
    return (
        F.when(F.trim(F.coalesce(text, F.lit(""))) == "", "empty_text")
        .when(options.isNull() | (F.size(options) < 2), "fewer_than_two_options")
        .when(empty, "empty_option")
        .when(index.isNull() & answered, "index_required")
        .when(index.isNotNull() & ~F.coalesce((index >= 0) & (index < F.size(options)), F.lit(False)), "index_outside_options")
    )


def process(edits: DataFrame, questions: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """Every edit with what comes of it: (edit_id, record_id, reason, state), state one of applied, queued, skipped.

    edits as in ``match`` with after_text, after_options, after_index; ledger (edit_id): those applied before.
    """
    why = edits.select("edit_id", problem(F.col("question_text"), F.col("after_text"), F.col("after_options"), F.col("after_index")).alias("why"))
    if ledger is not None:
        why = why.join(ledger.select("edit_id", F.lit(True).alias("old")).distinct(), "edit_id", "left").select("edit_id", F.when(F.col("old"), "already_applied").otherwise(F.col("why")).alias("why"))
    ok = edits.join(why.where("why IS NULL").select("edit_id"), "edit_id", "left_semi")
    done = match(ok, questions).withColumn("state", F.when(F.col("record_id").isNotNull(), "applied").otherwise("queued"))
    bad = why.where("why IS NOT NULL").select("edit_id", F.lit(None).cast("bigint").alias("record_id"), F.col("why").alias("reason"), F.lit("skipped").alias("state"))
    return done.unionByName(bad)


def apply(edits: DataFrame, processed: DataFrame, questions: DataFrame) -> DataFrame:
    """The questions that applied edits change, as they are afterwards; of several edits of one, the latest stands.

    edits also has after_explanation and corrected_at.  An empty explanation keeps the old one.  Source keys that are
    there are kept, so that later imports still find the question.
    """
    hit = processed.where("state = 'applied'").select("edit_id", F.col("record_id").alias("id"))
    new = edits.join(hit, "edit_id")
    when = F.struct(F.col("corrected_at").isNotNull().alias("a"), F.col("corrected_at").alias("b"), F.col("edit_id").alias("c"))
    fields = ["after_text", "after_options", "after_index", "after_explanation", "corrected_at", "question_text", "options"]
    last = new.groupBy("id").agg(F.max_by(F.struct(*fields), when).alias("e"))
    text = bare_text(F.col("e.after_text"))
    changed = questions.join(last, "id").withColumns({"_text": text, "_expl": F.coalesce(F.nullif(F.col("e.after_explanation"), F.lit("")), F.col("explanation"))})
    changed = changed.withColumn("_c", canon.composed(F.col("e.after_text"), F.lit(None).cast("string"), F.col("e.after_options")))
    changed = changed.withColumn("_b", canon.composed(F.col("e.question_text"), F.lit(None).cast("string"), F.col("e.options")))
    return changed.select(
        "id", F.col("_text").alias("question_text"), F.col("e.after_options").alias("options"), F.col("e.after_index").alias("correct_index"),
        F.get("e.after_options", F.col("e.after_index")).alias("correct_text"), F.col("_expl").alias("explanation"),
        canon.identity(F.col("_c.text"), F.col("_c.options")).alias("identity_key"),
        canon.quality_score(F.col("e.after_explanation"), F.col("e.after_options"), F.length("_text")).alias("quality_score"),
        F.col("e.corrected_at").alias("corrected_at"), F.coalesce("source_identity", canon.identity(F.col("_b.text"), F.col("_b.options"))).alias("source_identity"),
    )


def requeue(backlog: DataFrame, processed: DataFrame, now: Column) -> DataFrame:
    """backlog (edit_id, reason, attempts, updated_at) after a run: applied and stale ones leave, others count an attempt."""
    state = processed.select("edit_id", F.col("reason").alias("why"), "state")
    both = backlog.join(state, "edit_id", "full")
    kept = F.col("state").isNull() | (F.col("state") == "queued")
    return both.where(kept).select(
        "edit_id", F.coalesce("why", "reason").alias("reason"),
        F.when(F.col("state").isNull(), F.col("attempts")).otherwise(F.coalesce(F.col("attempts") + 1, F.lit(1))).alias("attempts"),
        F.when(F.col("state").isNull(), F.col("updated_at")).otherwise(now).alias("updated_at"),
    )


def retry_order(backlog: DataFrame, limit: int = 100) -> DataFrame:
    """The next ones to try again: the oldest first."""
    return backlog.orderBy("updated_at", "edit_id").limit(limit)


def revert(audits: DataFrame, questions: DataFrame) -> DataFrame:
    """(id, question_id, reason, question_text, options, correct_index): which corrections can be taken back, and to what.

    audits: (id, question_id, before_*, after_* with text, options, index, reverted_at).  Only the newest of a question that
    isn't taken back yet, and only while the question still holds what it wrote.
    """
    newest = audits.where("reverted_at IS NULL AND question_id IS NOT NULL").groupBy("question_id").agg(F.max("id").alias("newest"))
    q = questions.select(F.col("id").alias("question_id"), F.col("question_text").alias("_t"), F.col("options").alias("_o"), F.col("correct_index").alias("_i"), F.lit(True).alias("_there"))
    a = audits.join(newest, "question_id", "left").join(q, "question_id", "left")
    same = F.col("_t").eqNullSafe(F.col("after_text")) & F.col("_o").eqNullSafe(F.col("after_options")) & F.col("_i").eqNullSafe(F.col("after_index"))
    reason = (
        F.when(F.col("reverted_at").isNotNull(), "already_reverted").when(F.col("newest") > F.col("id"), "newer_correction")
        .when(F.col("_there").isNull(), "no_question").when(~same, "changed_since").otherwise("revertible")
    )
    ok = lambda c: F.when(reason == "revertible", F.col(c))
    return a.select("id", "question_id", reason.alias("reason"), ok("before_text").alias("question_text"), ok("before_options").alias("options"), ok("before_index").alias("correct_index"))


def reconcile(reports: DataFrame, questions: DataFrame, hops: int = 10) -> DataFrame:
    """(id, root, corrected_at) of the reports not yet resolved whose question, or the one it was merged into, was corrected since.

    reports: (id unique, qid, status, reported_at).  Reports without a time count as earlier.
    """
    root = dedupe.resolve(questions.select("id", F.col("canonical_id").alias("target")), hops).where("root IS NOT NULL").select(F.col("id").alias("qid"), "root")
    fixed = questions.where("canonical_id IS NULL AND corrected_at IS NOT NULL").select(F.col("id").alias("root"), "corrected_at")
    open_ = reports.where("NOT (status <=> 'resolved') AND qid IS NOT NULL").join(root, "qid").join(fixed, "root")
    return open_.where("reported_at IS NULL OR corrected_at >= reported_at").select("id", "root", "corrected_at")
