"""One timeline of frames and speech."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import frame_line, ordered_text, speech_line
from .runs import last_wins


def merged(frames: DataFrame, segments: DataFrame, keys: list[str]) -> DataFrame:
    """Events in order: (keys, pos, kind, t, src) with pos from 0; at equal times frames come first, then input order.

    frames: keys, t, src; segments: keys, t, src; src is the row's position in its table.
    """
    both = frames.select(*keys, F.lit("frame").alias("kind"), "t", "src").unionByName(segments.select(*keys, F.lit("speech").alias("kind"), "t", "src"))
    w = Window.partitionBy(*keys).orderBy("t", F.col("kind") == "speech", "src")
    return both.withColumn("pos", (F.row_number().over(w) - 1).cast("long"))


def coalesced_runs(events: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, run, kind, text): speech between frames as one text of lines, every frame a row of its own.

    events: keys, pos, kind, line.
    """
    w = Window.partitionBy(*keys).orderBy("pos")
    new = ((F.col("kind") == "frame") | (F.lag("kind").over(w) == "frame") | (F.row_number().over(w) == 1)).cast("long")
    marked = events.withColumn("new_", new).withColumn("run", F.sum("new_").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "run", "kind").agg(ordered_text(F.col("line"), F.col("pos"), "\n").alias("text"))


def rendered(manifest: DataFrame, segments: DataFrame, descriptions: DataFrame | None, keys: list[str]) -> DataFrame:
    """(keys, pos, kind, line): a frame's line is followed by its description, if there is one.

    manifest: keys, src and the frame columns; segments: keys, src, start, end,
    text; descriptions: keys, file, src, description, pointer_target, the last of a file counting.
    """
    frames = manifest.withColumn("t", F.col("interval_start"))
    line = frame_line(F.col("interval_start"), F.col("ts"), F.col("file"), F.col("entered_by"), F.col("grp"))
    if descriptions is not None:
        d = last_wins(descriptions, [*keys, "file"], "src").select(*keys, "file", F.coalesce("description", F.lit("")).alias("d_"), F.nullif("pointer_target", F.lit("")).alias("p_"))
        frames = frames.join(d, [*keys, "file"], "left")
        line = F.concat_ws("\n", line, F.when(F.col("d_").isNotNull(), F.concat(F.lit("    frame content: "), F.col("d_"))), F.when(F.col("p_").isNotNull(), F.concat(F.lit("    pointer on: "), F.col("p_"))))
    frames = frames.select(*keys, F.lit("frame").alias("kind"), "t", "src", line.alias("line"))
    speech = segments.select(*keys, F.lit("speech").alias("kind"), F.col("start").alias("t"), "src", speech_line(F.col("start"), F.col("end"), F.col("text")).alias("line"))
    w = Window.partitionBy(*keys).orderBy("t", F.col("kind") == "speech", "src")
    return frames.unionByName(speech).withColumn("pos", (F.row_number().over(w) - 1).cast("long")).select(*keys, "pos", "kind", "line")


def document(lines: DataFrame, keys: list[str], heading: str = "# Aligned multimodal context") -> DataFrame:
    """(keys, document): heading, blank line, lines in order, each ended by a line break."""
    return lines.groupBy(*keys).agg(ordered_text(F.col("line"), F.col("pos"), "\n").alias("body")).select(*keys, F.concat(F.lit(heading + "\n\n"), F.col("body"), F.lit("\n")).alias("document"))
