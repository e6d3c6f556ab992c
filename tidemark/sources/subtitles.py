"""Subtitle files (.vtt, .srt) and speech recognition JSON as segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import BLANKS, LINE_BREAKS, clean_cue, collapsed, parse_ts, stripped
from ..operators.runs import merge_repeats
from ..schemas import SCHEMAS, WORD, EngineError

#: A time line of a cue, anywhere in a line. Fixed value.
TIME_LINE = r"(\d{1,2}:)?\d{1,2}:\d{2}[.,]\d{1,3}\s*-->\s*(\d{1,2}:)?\d{1,2}:\d{2}[.,]\d{1,3}"
SPEECH_JSON = "struct<segments:array<struct<start:double,end:double,text:string,words:array<struct<start:double,end:double,word:string,text:string>>>>>"


def cues(files: DataFrame, key: str = "video_id", value: str = "value") -> DataFrame:
    """(key, cue_no, start, end, text) of subtitle texts, one row a file.

    Lines before a first time line and after a blank one belong to no cue; lines
    of digits alone are cue numbers while a cue has no body yet; cues without
    text are dropped.
    """
    lines = files.select(key, F.posexplode(F.split(F.col(value), LINE_BREAKS, -1)).alias("line_no", "line"))
    lines = lines.withColumn("line", F.rtrim(F.trim(F.col("line"), F.lit("﻿")), F.lit(BLANKS)))
    is_time = F.col("line").rlike(TIME_LINE)
    w = Window.partitionBy(key).orderBy("line_no")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumn("is_time", is_time).withColumn("cue_no", F.sum(is_time.cast("long")).over(upto))
    lines = lines.withColumn("open", F.coalesce(F.last(F.when(F.col("is_time"), True).when(F.col("line") == "", False), ignorenulls=True).over(upto), F.lit(False)))
    lines = lines.where("open")
    number = F.col("line").rlike(r"^\d+$")
    before = Window.partitionBy(key, "cue_no").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    accepted = F.coalesce(F.max((~F.col("is_time") & ~number).cast("int")).over(before), F.lit(0)) == 1
    lines = lines.withColumn("body", ~F.col("is_time") & (~number | accepted))
    arrow = F.split("line", "-->")
    times = F.when(F.col("is_time"), F.struct(parse_ts(F.get(arrow, F.lit(0))).alias("start"), parse_ts(F.get(F.split(F.ltrim(F.get(arrow, F.lit(1)), F.lit(BLANKS)), r"\s"), F.lit(0))).alias("end")))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("body"), F.struct("line_no", "line")))), lambda x: x["line"]), " ")
    found = lines.groupBy(key, "cue_no").agg(F.first(times, ignorenulls=True).alias("times"), clean_cue(body).alias("text"))
    return found.where("text <> ''").select(key, "cue_no", "times.start", "times.end", "text")


def parse_subtitles(files: DataFrame, key: str = "video_id", value: str = "value") -> DataFrame:
    """Segments of subtitle texts; adjacent cues of equal text are one segment."""
    merged = merge_repeats(cues(files, key, value), [key], "cue_no", "text")
    return merged.withColumn("words", F.lit(None).cast(f"array<{WORD}>")).select(key, "seg_no", "start", "end", "text", "words")


def parse_speech_json(files: DataFrame, key: str = "video_id", value: str = "value") -> DataFrame:
    """Segments of recogniser output: empty texts and repeats stay, empty word lists become null."""
    found = files.select(key, F.posexplode(F.from_json(value, SPEECH_JSON)["segments"]).alias("seg_no", "s"))
    words = F.when(F.size("s.words") > 0, F.transform("s.words", lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), stripped(F.coalesce(w["word"], w["text"], F.lit(""))).alias("word"))))
    return found.select(key, F.col("seg_no").cast("long").alias("seg_no"), F.col("s.start").alias("start"), F.col("s.end").alias("end"), collapsed(F.col("s.text")).alias("text"), words.alias("words"))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Segments of all .vtt, .srt and .json files below a path; the file's stem is the video.

    Any other suffix is an error, raised when it is read.
    """
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path).select("value", F.col("_metadata.file_name").alias("name"))
    suffix = F.lower(F.regexp_extract("name", r"(\.[^.]*)$", 1))
    bad = F.raise_error(F.concat(F.lit("neither .vtt, .srt nor .json: "), F.col("name")))
    files = files.select(F.regexp_replace("name", r"\.[^.]*$", "").alias("video_id"), F.when(suffix.isin(".vtt", ".srt", ".json"), suffix).otherwise(bad).alias("suffix"), "value")
    return parse_subtitles(files.where("suffix <> '.json'")).unionByName(parse_speech_json(files.where("suffix = '.json'")))


def read_thumbs(spark: SparkSession, path: str) -> DataFrame:
    """Thumbs of grey maps <path>/<video_id>/<number>.pgm, numbers from 1."""
    from ..functions.pixels import pgm_udf

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.pgm").load(path)
    number = F.regexp_extract("path", r"(\d+)\.pgm$", 1).cast("long") - 1
    found = files.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("video_id"), number.alias("idx"), pgm_udf()("content").alias("p"))
    return found.select("video_id", "idx", "p.width", "p.height", "p.pixels")


def read_table(spark: SparkSession, name: str, path: str, missing_ok: bool = True) -> DataFrame:
    """A stage table of the declared schema; where it does not exist an empty one, or an error if that is not allowed."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(SCHEMAS[name]).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        if not missing_ok:
            raise EngineError(f"no table {name} at {path}") from e
        return spark.createDataFrame([], SCHEMAS[name])
