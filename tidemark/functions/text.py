"""Column functions over text and times; all run in the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import EXTENSIONS, MEDIA_TYPES, NO_TEXT

#: Characters that strip() takes off and that end lines. Fixed values.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK_CLASS = r"[\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
LINE_BREAKS = r"\r\n|[\n\r\x0B\f\x1C-\x1E\x{85}\x{2028}\x{2029}]"


def stripped(c: Column) -> Column:
    return F.trim(c, F.lit(BLANKS))


def collapsed(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, BLANK_CLASS + "+", " "))


def fmt_ts(seconds: Column) -> Column:
    """MM:SS, or H:MM:SS from an hour on; halves round to even and negatives count as 0."""
    s = F.greatest(F.bround(seconds.cast("double"), 0), F.lit(0.0)).cast("long")
    hours, minutes, rest = F.floor(s / 3600), F.floor(s / 60) % 60, s % 60
    return F.when(hours > 0, F.format_string("%d:%02d:%02d", hours, minutes, rest)).otherwise(F.format_string("%02d:%02d", minutes, rest))


def parse_ts(stamp: Column) -> Column:
    """Seconds of a stamp; a bare number takes no comma; null where it is not a stamp.

    Parts beyond the last three do not count.
    """
    parts = F.split(stripped(stamp), ":")
    n = F.size(parts)
    part = lambda back: F.replace(F.get(parts, n - back), F.lit(","), F.lit(".")).try_cast("double")
    hours = F.when(n > 2, part(3)).otherwise(0.0)
    return F.when(n == 1, F.get(parts, F.lit(0)).try_cast("double")).otherwise(hours * 3600 + part(2) * 60 + part(1))


def clean_cue(text: Column) -> Column:
    """Cue text without tags; entities stay as they are."""
    return collapsed(F.regexp_replace(text, "<[^>]+>", ""))


def normalized(text: Column) -> Column:
    """Lower case, punctuation as blanks, single blanks: the form in which quotes are compared."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}_]+", " "))  # white space is no letter, number or underscore


def frame_time(idx: Column, fps: float = 1.0) -> Column:
    return idx.cast("double") / F.lit(float(fps))


def frame_file(t: Column) -> Column:
    """Name of the frame at t, with tenths of seconds; halves round to even."""
    return F.concat(F.lit("frames/"), F.format_string("frame_%08.1f.jpg", F.bround(t, 1)))


def extension(content_type: Column) -> Column:
    return reduce(lambda otherwise, x: F.when(content_type == x[0], x[1]).otherwise(otherwise), EXTENSIONS.items(), F.lit(".md"))


def reconstruction_file(frame: Column, content_type: Column) -> Column:
    """reconstructions/<stem of the frame><extension by type>; no type counts as `other`."""
    stem = F.regexp_extract(frame, r"([^/]*?)(\.[^./]*)?$", 1)
    return F.concat(F.lit("reconstructions/"), stem, extension(F.coalesce(content_type, F.lit("other"))))


def media_type(path: Column) -> Column:
    """Media type by suffix; null for a suffix that is none of an image."""
    suffix = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    return reduce(lambda otherwise, x: F.when(suffix == x[0], x[1]).otherwise(otherwise), MEDIA_TYPES.items(), F.lit(None).cast("string"))


def base64_text(content: Column) -> Column:
    """Base64 without line breaks."""
    return F.regexp_replace(F.base64(content), "[\r\n]", "")


def ocr_text(text: Column) -> Column:
    """On-screen text; the sentinel for none is the empty string."""
    return F.when(stripped(text) == NO_TEXT, "").otherwise(stripped(text))


def falsy_to(c: Column, default: Column | str) -> Column:
    """Default where the text is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), default if isinstance(default, Column) else F.lit(default))


def speech_line(start: Column, end: Column, text: Column) -> Column:
    return F.concat(F.lit("["), fmt_ts(start), F.lit("–"), fmt_ts(end), F.lit('] "'), text, F.lit('"'))


def stamped_line(start: Column, text: Column) -> Column:
    return F.concat(F.lit("["), fmt_ts(start), F.lit("] "), text)


def frame_line(interval_start: Column, ts: Column, file: Column, entered_by: Column, grp: Column) -> Column:
    mark = F.when(entered_by == "build", F.concat(F.lit("  <!-- build step, accretion group "), grp.cast("string"), F.lit(" -->"))).otherwise("")
    return F.concat(F.lit("["), fmt_ts(interval_start), F.lit("–"), ts, F.lit("] ![frame at "), ts, F.lit("]("), file, F.lit(")"), mark)


def json_text(answer: Column, array: bool) -> Column:
    """The JSON inside a model's answer: a fenced block if any, else the outermost brackets.

    Brackets of the expected kind (array or object) are looked for first, so an
    array of objects in prose is found whole. Null if nothing parses.
    """
    fenced = F.regexp_extract(answer, r"(?s)```(?:json|yaml)?[ \t]*\n(.*?)\n```", 1)
    text = stripped(F.when(fenced != "", fenced).otherwise(answer))
    valid = lambda c: F.when(F.try_parse_json(c).isNotNull(), c)
    kinds = [r"(?s)(\[.*\])", r"(?s)(\{.*\})"]
    return F.coalesce(valid(text), *(valid(F.nullif(F.regexp_extract(text, k, 1), F.lit(""))) for k in (kinds if array else kinds[::-1])))


def ordered_text(text: Column, position: Column, separator: str) -> Column:
    """Aggregate: texts in order of position, joined."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(position.alias("p"), text.alias("t")))), lambda x: x["t"]), separator)
