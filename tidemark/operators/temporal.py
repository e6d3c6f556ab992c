"""Joins in time: overlapping intervals, windows of speech, chunks by the last boundary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import ordered_text, parse_ts, stripped
from ..schemas import SPEECH_RADIUS

#: A line's leading stamp. Fixed value.
STAMP = r"^\[((?:\d+:)?\d+:\d+)"


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], bucket: float, how: str = "inner") -> DataFrame:
    """Rows of left and right of equal keys whose closed intervals overlap.

    left has lo and hi, right has r_lo and r_hi (seconds). Both sides enter every
    bucket of time they touch and meet by (keys, bucket), an equi-join that no
    single key's size turns into one task; a pair that meets in several buckets
    counts in the first common one. how: inner or left; `left` needs a unique
    `left_id`.
    """
    buckets = lambda lo, hi: F.sequence(F.floor(F.col(lo) / bucket), F.floor(F.col(hi) / bucket))
    a = left.where("lo <= hi").withColumn("bucket", F.explode(buckets("lo", "hi")))
    b = right.where("r_lo <= r_hi").withColumn("bucket", F.explode(buckets("r_lo", "r_hi")))
    met = a.join(b, [*keys, "bucket"]).where("r_hi >= lo AND r_lo <= hi")
    met = met.where(F.col("bucket") == F.greatest(F.floor(F.col("lo") / bucket), F.floor(F.col("r_lo") / bucket))).drop("bucket")
    if how == "inner":
        return met
    return left.join(met.drop(*(c for c in left.columns if c != "left_id" and c not in keys)), [*keys, "left_id"], "left")


def speech_windows(centers: DataFrame, segments: DataFrame, keys: list[str], radius: float = SPEECH_RADIUS, default: str = "") -> DataFrame:
    """(keys, left_id, window) of every center: texts of the segments within the radius, in order, or the default.

    centers: keys, left_id, center; segments: keys, seg_no, start, end, text. Both ends are closed.
    """
    left = centers.select(*keys, "left_id", (F.col("center") - radius).alias("lo"), (F.col("center") + radius).alias("hi"))
    right = segments.select(*keys, F.col("start").alias("r_lo"), F.col("end").alias("r_hi"), "seg_no", "text")
    found = interval_join(left, right, keys, 2 * radius).groupBy(*keys, "left_id").agg(ordered_text(F.col("text"), F.col("seg_no"), " ").alias("window"))
    return left.select(*keys, "left_id").join(found, [*keys, "left_id"], "left").withColumn("window", F.coalesce(F.nullif("window", F.lit("")), F.lit(default)))


def line_time(line: Column) -> Column:
    """Seconds of a line's leading stamp; null without one."""
    return parse_ts(F.nullif(F.regexp_extract(stripped(line), STAMP, 1), F.lit("")))


def assign_chunks(lines: DataFrame, keys: list[str], time: Column, boundaries: Column, position: str = "line_no") -> DataFrame:
    """Add `chunk`, from 1: the boundaries passed by the latest stamp so far, chunks of blank lines alone left out.

    boundaries: an array of sorted seconds, equal for a video's lines. The
    number never goes back; lines without a stamp stay where they are.
    """
    upto = Window.partitionBy(*keys).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    passed = F.coalesce(F.size(F.filter(boundaries, lambda b: b <= F.col("at_"))), F.lit(0))
    out = lines.withColumn("at_", time).withColumn("slot_", F.max(F.when(F.col("at_").isNotNull(), passed).otherwise(0)).over(upto))
    whole = Window.partitionBy(*keys, "slot_")
    out = out.withColumn("full_", F.max((stripped(F.col("text")) != "").cast("int")).over(whole)).where("full_ = 1")
    return out.withColumn("chunk", F.dense_rank().over(Window.partitionBy(*keys).orderBy("slot_")).cast("long")).drop("at_", "slot_", "full_")


def chunk_spans(lines: DataFrame, keys: list[str], time: Column) -> DataFrame:
    """(keys, chunk, t_lo, t_hi): first and last stamp of each chunk, 0 and 0 without stamps."""
    return lines.groupBy(*keys, "chunk").agg(F.coalesce(F.min(time), F.lit(0.0)).alias("t_lo"), F.coalesce(F.max(time), F.lit(0.0)).alias("t_hi"))


def durations(segments: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, duration): the end of each video's last segment."""
    return segments.groupBy(*keys).agg(F.max_by("end", "seg_no").alias("duration"))


def inner_boundaries(proposed: Column, duration: Column) -> Column:
    """Sorted boundaries strictly between 0 and the duration."""
    return F.sort_array(F.filter(proposed, lambda b: (b > 0) & (b < duration)))
