"""Ranked context under fixed budgets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import LINE_BREAKS, stripped
from ..schemas import SOURCE_IMAGES, VOCABULARY_BUDGET


def line_frequencies(texts: DataFrame, keys: list[str], position: str, text: str = "text") -> DataFrame:
    """(keys, line, n, first_pos, first_line) of every line of more than two characters.

    first_pos and first_line tell where it stands first: ties keep that order.
    """
    lines = texts.select(*keys, F.col(position).alias("pos_"), F.posexplode(F.split(text, LINE_BREAKS, -1)).alias("no_", "line")).withColumn("line", stripped(F.col("line"))).where("length(line) > 2")
    first = F.min(F.struct("pos_", "no_"))
    return lines.groupBy(*keys, "line").agg(F.count("*").alias("n"), first["pos_"].alias("first_pos"), first["no_"].alias("first_line"))


def prefix_budget(counted: DataFrame, keys: list[str], budget: int = VOCABULARY_BUDGET, reach: int = 4) -> DataFrame:
    """The most frequent lines up to the first that the budget does not hold, with `rank` from 1.

    A line costs its length, and one more for the break after it. Each line
    takes at least reach - 1 characters more than none, so of the sorted lines
    only a bounded number can matter: lines are cut to that number in each
    partition before they meet, and the running sum sees few rows.
    """
    most = budget // reach + 2
    order = [F.col("n").desc(), "first_pos", "first_line", "line"]
    if keys:
        w = Window.partitionBy(*keys).orderBy(*order)
        top = counted.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)
    else:
        w = Window.orderBy(*order)
        top = counted.orderBy(*order).limit(most).withColumn("rank", F.row_number().over(w))
    before = F.coalesce(F.sum(F.length("line") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    top = top.withColumn("over_", (before + F.length("line") > budget).cast("int"))
    return top.withColumn("stop_", F.max("over_").over(w.rowsBetween(Window.unboundedPreceding, 0))).where("stop_ = 0").drop("over_", "stop_")


def sample_frames(frames: DataFrame, keys: list[str], most: int = SOURCE_IMAGES) -> DataFrame:
    """At most `most` frames of each video: rich ones first, the others at an even stride, then the first by time.

    frames: keys, t, src, rich. With up to `most` frames all stay.
    """
    whole = Window.partitionBy(*keys)
    by_time = Window.partitionBy(*keys, "rich").orderBy("t", "src")
    f = frames.withColumn("rich", F.coalesce("rich", F.lit(False))).withColumn("all_", F.count("*").over(whole)).withColumn("rich_", F.count_if("rich").over(whole)).withColumn("place_", F.row_number().over(by_time) - 1)
    rest = F.col("all_") - F.col("rich_")
    room = most - F.least(F.col("rich_"), F.lit(most))
    stride = F.when(room > 0, F.greatest(F.floor(rest / F.greatest(room, F.lit(1))), F.lit(1))).otherwise(rest + 1)
    chosen = F.when(F.col("rich"), F.col("place_") < most).otherwise(F.col("place_") % stride == 0)
    f = f.where((F.col("all_") <= most) | chosen).withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("t", ~F.col("rich"), "src")).cast("long"))
    return f.where((F.col("all_") <= most) | (F.col("rank") <= most)).drop("all_", "rich_", "place_")
