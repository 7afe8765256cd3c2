"""Which candidates are valid: remembered verdicts, exact match, lemma, judge.

A surface's first decisive event in order fixes it for the forum. So every row's own event is computed without state, the
first one of each surface is found by an aggregate that combines before the shuffle, and joined back: a later row takes the
first event's verdict. Terms seen before the run decide before any row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termforge.operators.judge import Judge, NoJudge
from termforge.operators.lemmas import Lemmatizer, lemmas_of
from termforge.operators.shared import checked, materialize

ORDER = ("topic_seq", "sent_seq", "entry_seq", "value_seq", "occ_seq")


class UnsupportedRule(ValueError):
    pass


def judged_candidates(candidates: DataFrame, judge: Judge | None = None, lemmas: DataFrame | Lemmatizer | None = None) -> DataFrame:
    """Candidates with ``own`` (valid, invalid or null for no label), ``event`` (POS, NEG or null) and ``lemma``.

    ``lemmas`` is a lemmatizer, or a table (word, lemma) that lacks words whose lemma is the word itself. Dual values with a rule other than
    CASE_SENSITIVE, and questions that the judge cannot put (``set_aside``), give ``bad_rule``; their topics are to be set aside.
    """
    judge = judge or NoJudge()
    if isinstance(lemmas, Lemmatizer):
        candidates = materialize(candidates, "candidates")
        lemmas = lemmas_of(candidates, lemmas)
    rows = candidates.withColumns({"surf": F.lower("surface"), "val": F.lower("value"), "seq": F.struct(*ORDER)})
    if lemmas is not None:
        rows = rows.join(lemmas.select(F.col("word").alias("surf"), F.col("lemma")), "surf", "left").withColumn("lemma", F.coalesce("lemma", "surf"))
    else:
        rows = rows.withColumn("lemma", F.col("surf"))
    dual = F.col("duality").isNotNull()
    bad = dual & ~F.coalesce(F.col("duality.rule") == "CASE_SENSITIVE", F.lit(False))
    other_case = dual & (F.length("surface") == F.length("value")) & (F.col("surface") != F.col("value"))
    exact = F.col("val") == F.col("surf")
    foreign = ~F.contains(F.col("lemma"), F.col("val"))
    same = F.length("lemma") == F.length("val")
    rows = rows.withColumn("open", F.when(bad, None).when(other_case, "relevance").when(dual | exact | foreign | same, None).otherwise("form"))
    rows = judge.judge(rows)  # adds answer: true, false, or null without a judge
    if "set_aside" in rows.columns:
        bad = bad | F.col("set_aside")
    answer = F.col("answer")
    own = F.when(bad, None).when(other_case, F.coalesce(answer, F.lit(False))).when(dual | exact, True).when(foreign, False).when(same, True).otherwise(answer)
    event = F.when(bad | other_case, None).when(dual | exact, "POS").when(foreign, None).when(same, "POS").when(answer, "POS").when(~answer, "NEG")
    keeps_lemma = ~dual & ~exact & ~foreign & (same | F.coalesce(answer, F.lit(False)))
    return rows.withColumns({"own": own, "event": event, "keeps_lemma": keeps_lemma, "bad_rule": F.coalesce(bad, F.lit(False)), "dual": dual, "seen_by_dual": dual & ~bad & ~F.coalesce(other_case, F.lit(False))})


def resolve(candidates: DataFrame, judge: Judge | None = None, lemmas: DataFrame | Lemmatizer | None = None, seen: DataFrame | None = None, locked: DataFrame | None = None) -> DataFrame:
    """Candidates with ``is_valid``; those without a verdict are left out. ``seen`` (value): terms accepted earlier."""
    return decide(materialize(judged_candidates(candidates, judge, lemmas), "judged"), seen, locked)


def decide(judged: DataFrame, seen: DataFrame | None = None, locked: DataFrame | None = None) -> DataFrame:
    """The verdicts of ``judged`` candidates, a written table: it is read for the topics set aside, the first events, and its rows.

    ``locked`` (forum_url, surf, event): first events of earlier runs over the same forums. Forums without a url are one forum.
    """
    broken = materialize(set_aside(judged), "broken")
    rows = judged
    if not broken.isEmpty():
        gone = broken.select(F.col("topic_seq").alias("_t"), F.col("forum_url").alias("_f"))
        rows = rows.join(gone, F.col("topic_seq").eqNullSafe(F.col("_t")) & F.col("forum_url").eqNullSafe(F.col("_f")), "left_anti")
    first = rows.where("event is not null").groupBy("forum_url", "surf").agg(F.min_by("event", "seq").alias("locked"), F.min("seq").alias("lock_seq"))
    rows = _with_forum(rows, materialize(first, "first"))
    before = F.when(F.col("lock_seq") < F.col("seq"), F.col("locked"))
    if locked is not None:
        rows = _with_forum(rows, materialize(locked.select("forum_url", "surf", F.col("event").alias("earlier")), "earlier"))
        before = F.coalesce("earlier", before)
    if seen is not None:
        known = materialize(seen.select(F.col("value").alias("surf"), F.lit("POS").alias("known")).distinct(), "seen")
        rows = rows.join(checked(known, 100), "surf", "left")
        before = F.coalesce("known", before)
    valid = F.when(F.col("dual") | before.isNull(), F.col("own")).otherwise(before == "POS")
    decided = F.col("dual") | before.isNull()
    settled = F.coalesce(F.col("earlier"), F.col("locked")) if locked is not None else F.col("locked")
    return rows.withColumns({"is_valid": valid, "keeps_lemma": F.col("keeps_lemma") & decided, "locked": settled}).where("is_valid is not null")


def _with_forum(rows: DataFrame, table: DataFrame) -> DataFrame:
    """``rows`` with what ``table`` (forum_url, surf, ...) has for their forum and surface; a null forum meets a null forum."""
    table = checked(table.withColumnsRenamed({"forum_url": "_f", "surf": "_s"}), 200)
    return rows.join(table, F.col("forum_url").eqNullSafe(F.col("_f")) & (F.col("surf") == F.col("_s")), "left").drop("_f", "_s")


def first_events(judged: DataFrame, locked: DataFrame | None = None) -> DataFrame:
    """(forum_url, surf, event): what fixes each surface of a forum, earlier runs first."""
    new = judged.where("event is not null and not bad_rule").groupBy("forum_url", "surf").agg(F.min_by("event", "seq").alias("event"))
    if locked is None:
        return new
    both = locked.select("forum_url", "surf", "event", F.lit(0).alias("_n")).unionByName(new.withColumn("_n", F.lit(1)))
    return both.groupBy("forum_url", "surf").agg(F.min_by("event", "_n").alias("event"))


def set_aside(judged: DataFrame) -> DataFrame:
    """Topics of ``judged`` candidates with a rule that is not supported or a question that the judge cannot put."""
    return judged.where("bad_rule").select("topic_seq", "forum_url", "topic_url").distinct()


def quarantined(candidates: DataFrame) -> DataFrame:
    """Topics with a dual value whose rule is not supported."""
    return candidates.where("duality is not null and coalesce(duality.rule, '') != 'CASE_SENSITIVE'").select("topic_seq", "forum_url", "topic_url").distinct()


def terms_seen(resolved: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """(value): the terms accepted so far, the ``seen`` ones included."""
    new = resolved.where("seen_by_dual or (not dual and locked = 'POS')").select(F.col("surf").alias("value"))
    return (new if seen is None else new.union(seen.select("value"))).distinct()


def lemmas_seen(resolved: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    new = resolved.where("keeps_lemma and is_valid").select(F.col("lemma").alias("value"))
    return (new if seen is None else new.union(seen.select("value"))).distinct()


def seen_counts(resolved: DataFrame, seen: DataFrame | None = None, lemmas: DataFrame | None = None) -> DataFrame:
    """(terms, lemmas): how many distinct ones are known."""
    return terms_seen(resolved, seen).agg(F.count("*").alias("terms")).crossJoin(lemmas_seen(resolved, lemmas).agg(F.count("*").alias("lemmas")))  # one row each


def questions(judged: DataFrame) -> DataFrame:
    """(question, surf, val, answer): what the judge was asked and said, each distinct question once; the rows of its log."""
    return judged.where("open is not null").select(F.col("open").alias("question"), "surf", "val", "answer").distinct()


def tally(asked: DataFrame) -> DataFrame:
    """How many questions of each kind were answered yes and no."""
    return asked.groupBy("question").agg(F.count_if("answer").alias("yes"), F.count_if(~F.col("answer")).alias("no"))
