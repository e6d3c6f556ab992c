"""Stable intervals of frame sequences: consecutive differences, classes, gaps and islands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.pixels import array_diffs, pixel_diffs
from ..functions.text import fmt_ts, frame_file, frame_time
from ..schemas import BUILD_FRACTION, CUT_THRESHOLD, FPS, GRID, TILE_THRESHOLD


def _in_order(keys: list[str]) -> Window:
    return Window.partitionBy(*keys).orderBy("idx")


def median(values: Column) -> Column:
    """Median of an array; of an even number the mean of the middle two."""
    s, n = F.sort_array(values), F.size(values)
    low, high = F.get(s, F.floor((n - 1) / 2).cast("int")), F.get(s, F.floor(n / 2).cast("int"))
    return F.when(low == high, low).otherwise((low + high) / 2)


def transition_kind(diffs: Column, tile_threshold: float = TILE_THRESHOLD, build_fraction: float = BUILD_FRACTION, cut_threshold: float = CUT_THRESHOLD) -> Column:
    """cut, stable or build from tile differences and their median (column `med`)."""
    changed = F.size(F.filter(diffs, lambda d: d - F.col("med") > tile_threshold))
    return F.when(F.col("med") > cut_threshold, "cut").when(changed == 0, "stable").when(changed / F.size(diffs) <= build_fraction, "build").otherwise("cut")


def transitions(frames: DataFrame, keys: list[str], tiles: str | None = None, scale: float = 1.0, grid: int = GRID, **limits) -> DataFrame:
    """(keys, idx, diffs, med, kind) of every frame but a sequence's first.

    tiles names an array column of tile values; without it, `pixels`, `width`
    and `height` are compared in Arrow batches.
    """
    w = _in_order(keys)
    value = tiles or "pixels"
    pairs = frames.withColumn("before", F.lag(value).over(w)).where("before IS NOT NULL")
    diffs = array_diffs(F.col("before"), F.col(value), scale) if tiles else pixel_diffs(grid)("before", value, "width", "height")
    pairs = pairs.select(*keys, "idx", diffs.alias("diffs")).withColumn("med", median(F.col("diffs")))
    return pairs.withColumn("kind", transition_kind(F.col("diffs"), **limits))


def intervals(kinds: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, start_idx, end_idx, grp, entered_by, exited_by) from (keys, idx, kind) of every frame.

    The first frame of a sequence has a null kind. What is not stable begins an
    interval; a cut begins a group.
    """
    w = _in_order(keys).rowsBetween(Window.unboundedPreceding, 0)
    kind = F.coalesce("kind", F.lit("start"))
    marked = kinds.withColumn("kind", kind).withColumn("no", F.sum((F.col("kind").isin("build", "cut")).cast("long")).over(w)).withColumn("grp", F.sum((F.col("kind") == "cut").cast("long")).over(w))
    found = marked.groupBy(*keys, "no").agg(F.min("idx").alias("start_idx"), F.max("idx").alias("end_idx"), F.min("grp").alias("grp"), F.min_by("kind", "idx").alias("entered_by"))
    return found.withColumn("exited_by", F.coalesce(F.lead("entered_by").over(Window.partitionBy(*keys).orderBy("no")), F.lit("end"))).drop("no")


def frame_intervals(frames: DataFrame, keys: list[str], **options) -> DataFrame:
    """intervals() of frames by their transitions()."""
    found = transitions(frames, keys, **options).select(*keys, "idx", "kind")
    return intervals(frames.select(*keys, "idx").join(found, [*keys, "idx"], "left"), keys)


def keepers(found: DataFrame) -> DataFrame:
    """Without single frames between two cuts."""
    return found.where(~((F.col("start_idx") == F.col("end_idx")) & (F.col("entered_by") == "cut") & (F.col("exited_by") == "cut")))


def manifest(found: DataFrame, keys: list[str], fps: float = FPS) -> DataFrame:
    """The kept frame of each interval, its last one, with times and file name."""
    t = frame_time(F.col("end_idx"), fps)
    return found.select(*keys, t.alias("t"), fmt_ts(t).alias("ts"), frame_time(F.col("start_idx"), fps).alias("interval_start"), t.alias("interval_end"), frame_file(t).alias("file"), "grp", "entered_by")
