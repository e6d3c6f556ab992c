"""Merging answers back: corrections, grades, holes, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import NO_ANSWER
from .runs import last_wins


def apply_corrections(segments: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """segments with changed texts; a changed segment loses its words.

    changes: keys, i (a seg_no), text, src; the last change of a segment counts
    and those of no segment do not matter.
    """
    c = last_wins(changes, [*keys, "i"], "src").select(*keys, F.col("i").alias("seg_no"), F.col("text").alias("new_text"), F.lit(True).alias("changed_"))
    out = segments.join(c, [*keys, "seg_no"], "left")
    changed = F.coalesce("changed_", F.lit(False))
    return out.withColumn("text", F.when(changed, F.col("new_text")).otherwise(F.col("text"))).withColumn("words", F.when(~changed, F.col("words"))).select(*segments.columns)


def best_transcript(raw: DataFrame, corrected: DataFrame, keys: list[str]) -> DataFrame:
    """Per video the corrected segments if there are any, else the raw ones."""
    return raw.join(corrected.select(*keys).distinct(), keys, "left_anti").unionByName(corrected)


def scores(questions: DataFrame, grades: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, correct, total, ungraded, score): grade rows that say correct over questions.

    Grades that repeat or match no question count as they are; `ungraded` tells
    how many questions have none.
    """
    per = lambda df, **aggs: df.groupBy(*keys).agg(*(v.alias(k) for k, v in aggs.items()))
    q = per(questions, total=F.count("*"))
    g = per(grades, correct=F.count_if(F.col("verdict") == "correct"))
    bare = per(questions.join(grades.select(*keys, "i").distinct(), [*keys, "i"], "left_anti"), ungraded=F.count("*"))
    out = q.join(g, keys, "left").join(bare, keys, "left").na.fill(0, ["correct", "ungraded"])
    return out.withColumn("score", F.concat_ws("/", F.col("correct").cast("string"), F.col("total").cast("string")))


def holes(questions: DataFrame, grades: DataFrame, keys: list[str], position: str = "src") -> DataFrame:
    """Questions whose last grade is not correct; without a grade a question is no hole."""
    g = last_wins(grades, [*keys, "i"], position).select(*keys, "i", "verdict", F.coalesce("hole", F.lit("")).alias("hole"))
    return questions.join(g, [*keys, "i"]).where("verdict <> 'correct'")


def graded_rows(questions: DataFrame, answers: DataFrame, keys: list[str], position: str = "src") -> DataFrame:
    """Each question with the last answer to it, or a fixed text for none."""
    a = last_wins(answers, [*keys, "i"], position).select(*keys, "i", "answer")
    return questions.join(a, [*keys, "i"], "left").withColumn("answer", F.coalesce("answer", F.lit(NO_ANSWER)))


def claim_index(claims: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Add `i`, the place of each claim among all of its video's chunks, from 0."""
    return claims.withColumn("i", (F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1).cast("long"))


def unsupported(reverse: DataFrame) -> DataFrame:
    """Claims that the reverse check does not support; a missing verdict supports."""
    return reverse.where(~F.coalesce("supported", F.lit(True)))


def claim_counts(chunks: DataFrame, keys: list[str], claims: str = "claims") -> DataFrame:
    """(keys, n_claims) over nested chunks; no list counts as none."""
    return chunks.groupBy(*keys).agg(F.sum(F.coalesce(F.when(F.col(claims).isNotNull(), F.size(claims)), F.lit(0))).cast("long").alias("n_claims"))


def next_iterations(done: DataFrame, keys: list[str], number: str = "iteration") -> DataFrame:
    """(keys, iteration): the number after the largest one, as iter_NN."""
    return done.groupBy(*keys).agg(F.format_string("iter_%02d", F.coalesce(F.max(number), F.lit(0)) + 1).alias("iteration"))


def artifact_text(distilled: DataFrame, resolved: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, text): what a reader gets, either part alone if the other is missing."""
    d = distilled.select(*keys, F.concat(F.lit("## distilled.yaml\n\n"), F.col("text")).alias("d_"))
    r = resolved.select(*keys, F.concat(F.lit("## resolved.md\n\n"), F.col("text")).alias("r_"))
    return d.join(r, keys, "full").select(*keys, F.concat_ws("\n\n", "d_", "r_").alias("text"))


def latest_reports(reports: DataFrame, keys: list[str], number: str = "iteration") -> DataFrame:
    return last_wins(reports, keys, number)


def status_ranked(claims: DataFrame, status: str = "status") -> DataFrame:
    """Add `status_rank`: shown on screen, then asserted, then speculated; what is cited is someone else's."""
    return claims.withColumn("status_rank", F.when(F.col(status) == "demonstrated_on_screen", 0).when(F.col(status) == "asserted", 1).when(F.col(status) == "speculated", 2).otherwise(3))


def stage_status(expected: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """expected (keys, stage) with `done`: whether present has the row."""
    return expected.join(present.select(*keys, "stage", F.lit(True).alias("done")).distinct(), [*keys, "stage"], "left").withColumn("done", F.coalesce("done", F.lit(False)))
